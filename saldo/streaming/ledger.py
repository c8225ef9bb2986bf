"""Keys a streaming job has handled, so that a message delivered again in a later batch is recognised.

The ledger is a table of keys cut by day and batch. A batch reads the days of its own rows only, and never its
own entries: a replayed batch sees what its first run saw and overwrites what that run filed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.session import subfolders

SCHEMA = "key string, event_day date, batch bigint"


def unseen(rows: DataFrame, key: str, day: Column, ledger: str, batch_id: int) -> DataFrame:
    """Rows whose key no earlier batch has filed. Rows without a day are looked up among keys without one."""
    spark = rows.sparkSession
    if not subfolders(spark, ledger):
        return rows
    days = [r[0] for r in rows.select(day.alias("d")).distinct().collect()]  # one value per calendar day
    own_day = F.col("event_day").isin([d for d in days if d is not None])
    if None in days:
        own_day |= F.col("event_day").isNull()
    filed = spark.read.schema(SCHEMA).parquet(ledger).filter(own_day & (F.col("batch") < batch_id))
    return rows.join(filed.select(F.col("key").alias(key)), key, "left_anti").select(*rows.columns)


def file_keys(rows: DataFrame, key: str, day: Column, ledger: str, batch_id: int) -> None:
    """Files the keys of a batch. The rebalance leaves one file for most days."""
    keys = rows.select(F.col(key).alias("key"), day.cast("date").alias("event_day"), F.lit(batch_id).cast("bigint").alias("batch"))
    (
        keys.hint("rebalance", "event_day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_day", "batch").parquet(ledger)
    )
