"""Reading, conforming and profiling the row store's payment tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldo.schemas import BRONZE, QUARANTINE
from saldo.session import TIMES, exists, settings, workspace


def read_row_store(spark, url: str, table: str, column: str, lower, upper, partitions: int,
                   properties: dict | None = None) -> DataFrame:
    """Parallel JDBC read, split on a numeric or timestamp column."""
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=properties or {})


def read_unloaded(events: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows not loaded yet; with a limit the oldest `limit` of them (a distributed top-k)."""
    rows = events.filter(~F.col("loaded_to_iceberg"))
    return rows if limit is None else rows.orderBy("ingested_at", "event_id").limit(limit)


def read_by_date(events: DataFrame, day: date, limit: int | None = None) -> DataFrame:
    """Backfill of one ingestion day. A range on the raw column, so it can be pushed to the scan."""
    ts = F.col("ingested_at")
    low, high = (F.lit(d.isoformat()).cast("timestamp") for d in (day, day + timedelta(days=1)))
    rows = events.filter((ts >= low) & (ts < high))
    return rows if limit is None else rows.orderBy("ingested_at", "event_id").limit(limit)


def mark_loaded(events: DataFrame, ids: DataFrame, loaded_at) -> DataFrame:
    """Sets the loaded flag and time for the given event ids."""
    hits = ids.select("event_id").distinct().withColumn("_hit", F.lit(True))
    hit = F.col("_hit").isNotNull()
    return (
        events.join(hits, "event_id", "left")
        .withColumn("loaded_to_iceberg", hit | F.col("loaded_to_iceberg"))
        .withColumn("loaded_at", F.when(hit, F.lit(loaded_at).cast("timestamp")).otherwise(F.col("loaded_at")))
        .drop("_hit")
    )


def not_in_ledger(events: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows whose id the append-only ledger of loaded ids lacks."""
    return events.join(ledger.select("event_id"), "event_id", "left_anti")


def event_count(events: DataFrame, loaded: bool | None = None) -> DataFrame:
    rows = events
    if loaded is not None:
        rows = events.filter(F.col("loaded_to_iceberg") if loaded else ~F.col("loaded_to_iceberg"))
    return rows.agg(F.count(F.lit(1)).alias("event_count"))


def _fit(name: str, have: T.DataType, want: T.DataType) -> Column:
    col = F.col(f"`{name}`")
    if isinstance(have, (T.StructType, T.ArrayType, T.MapType)) and isinstance(want, T.StringType):
        col = F.to_json(col)
    elif have != want:
        col = col.try_cast(want)
    return col.alias(name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns: typed NULLs for missing ones, nested values as JSON text."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        _fit(f.name, have[f.name], f.dataType) if f.name in have
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def ingest_events(raw: DataFrame, limit: int | None = None) -> DataFrame:
    """Unloaded rows in the bronze schema."""
    return conform(read_unloaded(raw, limit).drop("id", "loaded_to_iceberg", "loaded_at"), BRONZE)


def ingest_quarantine(raw: DataFrame, limit: int | None = None) -> DataFrame:
    """Unreviewed quarantine rows in the bronze quarantine schema, oldest first when limited."""
    rows = raw.filter(~F.coalesce("reviewed", F.lit(False)))
    if limit is not None:
        rows = rows.orderBy("quarantined_at", "kafka_partition", "kafka_offset").limit(limit)
    return conform(rows, QUARANTINE)


def append_bronze(df: DataFrame, path: str) -> None:
    """Appends to the bronze table, one folder per ingestion day.

    The rebalance keeps files few; adaptive execution splits a day that holds most of the rows.
    """
    by_day = df.withColumn("ingested_date", F.to_date("ingested_at")).hint("rebalance", "ingested_date")
    with settings(df.sparkSession, **TIMES):
        by_day.write.mode("append").partitionBy("ingested_date").parquet(path)


def ingest(store: DataFrame, bronze_path: str, ledger_path: str, limit: int | None = None,
           then: Callable[[datetime], object] | None = None) -> int:
    """Loads the row store's unloaded events into bronze, then files their ids in the ledger; returns how many.

    May be repeated at any time: ids of the ledger are left out, and a run that failed between the two writes finds
    its events in bronze, on the ingestion days it looks at, and only files them. `then` runs between the writes with
    the oldest ingestion time of these events, so what it does is repeated as well until it succeeds.
    """
    spark = store.sparkSession
    if exists(spark, ledger_path):
        store = not_in_ledger(store, spark.read.schema("event_id string").parquet(ledger_path))
    with workspace(spark, "ingest") as keep:
        events = keep("events", ingest_events(store, limit).withColumn("ingested_date", F.to_date("ingested_at")))
        days = [r[0] for r in events.select("ingested_date").distinct().collect()]  # one value per calendar day
        new = events
        if exists(spark, bronze_path):
            on_days = F.col("ingested_date").isin([d for d in days if d is not None])
            if None in days:
                on_days |= F.col("ingested_date").isNull()
            stored = spark.read.schema(BRONZE).parquet(bronze_path).filter(on_days)
            new = events.join(stored.select("event_id"), "event_id", "left_anti")
        append_bronze(new.select(*BRONZE.names), bronze_path)
        oldest = events.agg(F.min("ingested_at")).first()[0]
        if then is not None and oldest is not None:
            then(oldest)
        events.select("event_id").write.mode("append").parquet(ledger_path)
        return events.count()


def ingest_profile(events: DataFrame) -> DataFrame:
    """Value counts of event type and provider and the ingestion range, as (metric, value, n)."""
    counts = events.groupingSets(
        [[F.col("event_type")], [F.col("provider")], []], F.col("event_type"), F.col("provider")
    ).agg(
        F.grouping("event_type").alias("_no_type"), F.grouping("provider").alias("_no_provider"),
        F.count(F.lit(1)).alias("n"),
        F.min("ingested_at").cast("string").alias("_min"), F.max("ingested_at").cast("string").alias("_max"),
    )
    row = lambda metric, value, n: F.struct(
        F.lit(metric).alias("metric"), value.alias("value"), n.alias("n"))
    is_total = (F.col("_no_type") == 1) & (F.col("_no_provider") == 1)
    rows = F.when(is_total, F.array(
        row("min_ingested_at", F.col("_min"), F.col("n")), row("max_ingested_at", F.col("_max"), F.col("n")),
    )).when(F.col("_no_type") == 0, F.array(row("event_type", F.col("event_type"), F.col("n")))
    ).otherwise(F.array(row("provider", F.col("provider"), F.col("n"))))
    return counts.select(F.inline(rows))


def failure_profile(quarantine: DataFrame, n: int = 10) -> DataFrame:
    """The n most frequent failure reasons."""
    return quarantine.groupBy("failure_reason").agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.desc("n"), "failure_reason").limit(n)
