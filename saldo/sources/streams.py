"""Streaming sources: raw webhook topics and the four typed payment streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo import constants as C
from saldo.schemas import STREAMS

WATERMARK = "5 seconds"


def raw_topics() -> list[str]:
    return list(C.RAW_TOPICS)


def kafka_options(servers: str, topics: list[str], starting: str = "earliest") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": starting,
    }


def read_kafka(spark: SparkSession, servers: str, topics: list[str], starting: str = "earliest") -> DataFrame:
    """Raw messages as a stream. Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topics, starting)).load()


def decode(messages: DataFrame, kind: str) -> DataFrame:
    """Typed rows from JSON messages with ISO-8601 timestamps."""
    parsed = F.from_json(F.col("value").cast("string"), STREAMS[kind])
    return messages.select(parsed.alias("_m")).select("_m.*")


def with_watermark(stream: DataFrame) -> DataFrame:
    return stream.withWatermark("created_at", WATERMARK)


def typed_stream(spark: SparkSession, kind: str, *, servers: str | None = None,
                 json_path: str | None = None, starting: str = "earliest") -> DataFrame:
    """One typed stream from its Kafka topic, or from a folder of JSON files of the same shape."""
    if json_path is not None:
        rows = spark.readStream.schema(STREAMS[kind]).json(json_path)
    else:
        rows = decode(read_kafka(spark, servers, [C.STREAM_TOPICS[kind]], starting), kind)
    return with_watermark(rows)
