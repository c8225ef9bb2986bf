"""Batch and streaming sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo import constants as C
from saldo.plans.features import CUSTOMER_COLUMNS, MERCHANT_COLUMNS


EXPORT_COLUMNS = {"customer": CUSTOMER_COLUMNS, "merchant": MERCHANT_COLUMNS}


def export_features(spark: SparkSession, table: str, entity: str, path: str) -> dict:
    """Column-pruned dump of one feature table; reports rows, emptiness or a missing table.

    The row count comes from the files just written, not from a second run of the query.
    """
    if not spark.catalog.tableExists(table):
        return {"status": "skipped", "reason": "table_not_found"}
    spark.table(table).select(*EXPORT_COLUMNS[entity]).write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path).count()
    if rows == 0:
        return {"status": "empty", "rows": 0}
    return {"status": "success", "rows": rows, "path": path}


def normalized_messages(valid: DataFrame) -> DataFrame:
    """(topic, key, value) of accepted events."""
    return valid.select(
        F.lit(C.NORMALIZED_TOPIC).alias("topic"), F.col("event_id").alias("key"),
        F.to_json(F.struct(*valid.columns)).alias("value"))


def dlq_messages(dlq: DataFrame) -> DataFrame:
    """(topic, key, value) of dead-letter records, keyed by the provider's own event id."""
    return dlq.select(
        F.lit(C.DLQ_TOPIC).alias("topic"), F.col("provider_event_id").alias("key"),
        F.to_json(F.struct(*dlq.columns)).alias("value"))


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One micro-batch into its own folder: a replayed batch overwrites itself, so delivery is exactly once."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def write_normalized(valid: DataFrame, path: str, batch_id: int = 0) -> None:
    write_batch(normalized_messages(valid), f"{path}/{C.NORMALIZED_TOPIC}", batch_id)


def write_dlq(dlq: DataFrame, path: str, batch_id: int = 0) -> None:
    write_batch(dlq_messages(dlq), f"{path}/{C.DLQ_TOPIC}", batch_id)


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table written batch by batch."""
    return spark.read.schema(schema).parquet(f"{path}/batch=*")


def passthrough(stream: DataFrame, path: str, checkpoint: str, **trigger):
    """Unvalidated copy of a stream into Parquet, exactly once."""
    return (
        stream.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"})).start()
    )
