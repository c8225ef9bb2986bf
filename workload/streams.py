"""Streams over the driver's tables, run to completion."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from saldo.schemas import BRONZE, STREAMS
from saldo.session import scratch
from saldo.sources.bronze import conform
from workload import adapters as W

ONCE = {"availableNow": True}
#: Compressed text is read by one task a file, so files are many rather than large.
ROWS_PER_FILE = 500_000


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's files as a stream."""
    file = f"{name}.parquet"
    schema = spark.read.parquet(f"{sf_dir}/{file}").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", file).parquet(sf_dir)


def _over_stream(spark: SparkSession, sf_dir: str, source: str, text: str) -> DataFrame:
    view = f"{source}_{uuid.uuid4().hex[:8]}"
    table_stream(spark, sf_dir, source).createOrReplaceTempView(view)
    return spark.sql(text.format(events=view, orders=view).replace('"interval"', "`interval`"))


def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(_over_stream(spark, sf_dir, "events", W.BRONZE_SQL), BRONZE)


def typed_table_stream(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return conform(_over_stream(spark, sf_dir, "orders", W.STREAM_SQL[kind]), STREAMS[kind])


def raw_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = spark.readStream.schema(W.RAW_SCHEMA).parquet(W.raw_landing(spark, sf_dir))
    return landed.select("value", "topic", "partition", "offset")


def json_files(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """A typed stream's rows as compressed JSON files with ISO-8601 timestamps."""
    path = scratch(spark, f"json-{kind}")
    W.stream_table(spark, sf_dir, kind).write.option("maxRecordsPerFile", ROWS_PER_FILE).json(path, compression="gzip")
    return path


def finish(query) -> None:
    query.awaitTermination()


def collect_stream(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Everything a stream emits, read back from Parquet."""
    spark = stream.sparkSession
    path = scratch(spark, label)
    finish(
        stream.writeStream.format("parquet").outputMode(mode).option("path", path)
        .option("checkpointLocation", scratch(spark, f"{label}-checkpoint")).trigger(**ONCE).start())
    return spark.read.schema(stream.schema).parquet(path)
