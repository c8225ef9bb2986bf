"""Table maintenance: upserts, history merge, versioned snapshots, dedupe."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.session import subfolders, workspace


def newest_per_key(df: DataFrame, keys: list[str], *order: Column, oldest: bool = False) -> DataFrame:
    """One row per key, the newest (or oldest) by `order`.

    An aggregate rather than a ranking window: copies of one key are combined on the map side, so a
    heavily duplicated key never gathers in one task. The keys stay the aggregate's own, so a join on
    them finds its rows where they are; the rows travel without them.
    """
    whole = F.struct(*([c for c in df.columns if c not in keys] or keys))
    pick = (F.min_by if oldest else F.max_by)(whole, F.struct(*order))
    best = df.groupBy(*keys).agg(pick.alias("_row"))
    return best.select(*[F.col(f"`{c}`") if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns])


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], newest: str = "ingested_at", cut: str | None = None) -> DataFrame:
    """Matched keys are replaced, others inserted; repeated keys in the batch keep their newest row.

    With `cut` the batch is stored by that column and holds each key once: its rows stay where they are, only
    the target's are dealt by the column, and the result can be written by it without a further shuffle.
    """
    batch = (updates if cut else newest_per_key(updates, keys, F.col(newest))).select(*target.columns)
    others = target.join(batch.select(*keys), keys, "left_anti")
    return (others.hint("rebalance", cut) if cut else others).unionByName(batch)


def upsert_partitions(spark: SparkSession, path: str, updates: DataFrame, keys: list[str],
                      partition: str, newest: str = "ingested_at", most: int = 10_000) -> None:
    """Upsert into a partitioned table, rewriting only the partitions the batch touches.

    Assumes a key never moves between partitions, and a partition column as coarse as a day: a batch that touches
    more than `most` partitions is refused. The merged rows are written out before the overwrite, because a table
    cannot be overwritten while it is being read.
    """
    values = [r[0] for r in updates.select(partition).distinct().limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"the batch touches more than {most} partitions of {path}")
    hit = F.col(partition).isin([v for v in values if v is not None])
    if None in values:
        hit = hit | F.col(partition).isNull()
    current = spark.read.parquet(path).filter(hit)
    with workspace(spark, "upsert") as keep:
        (
            keep("merged", upsert(current, updates, keys, newest)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
        )


# Columns a repeated event may change; everything else keeps its first value.
ENRICHMENT_COLUMNS = [
    "fraud_score", "risk_level", "retry_strategy", "retry_delay_seconds", "churn_score",
    "churn_risk_level", "days_to_churn_estimate", "validation_status", "validation_errors",
    "processed_at", "ingested_at", "metadata",
]
QUARANTINE_COLUMNS = [
    "original_payload", "validation_errors", "failure_reason", "source_topic", "kafka_partition",
    "kafka_offset", "schema_version", "updated_at",
]


def upsert_columns(target: DataFrame, updates: DataFrame, key: str, changing: list[str],
                   newest: str) -> DataFrame:
    """On a key conflict only `changing` columns take the new value, NULLs included.

    A batch may repeat a key: its first row supplies the kept columns, its newest the changing ones.
    """
    row = lambda df: F.struct(*[F.col(c) for c in df.columns])
    batch = updates.groupBy(key).agg(
        F.min_by(row(updates), F.col(newest)).alias("_first"),
        F.max_by(row(updates), F.col(newest)).alias("_last"),
    )
    old = target.select(F.col(key), row(target).alias("_old"))
    both = old.join(batch, key, "full")
    cols = []
    for name in target.columns:
        if name == key:
            cols.append(F.col(key))
        elif name in changing:
            value = F.when(F.col("_last").isNotNull(), F.col("_last")[name]).otherwise(F.col("_old")[name])
            cols.append(value.alias(name))
        else:
            value = F.when(F.col("_old").isNotNull(), F.col("_old")[name]).otherwise(F.col("_first")[name])
            cols.append(value.alias(name))
    return both.select(*cols)


def upsert_enrichment(target: DataFrame, updates: DataFrame) -> DataFrame:
    """Conflicting events refresh their twelve enrichment columns only."""
    return upsert_columns(target, updates, "event_id", ENRICHMENT_COLUMNS, "ingested_at")


def upsert_quarantine(target: DataFrame, updates: DataFrame) -> DataFrame:
    """Conflicting quarantine rows take the new payload, errors, reason and source position.

    Rows are matched on the dead-letter key, which exists even when the event id is missing.
    """
    return upsert_columns(target, updates, "dlq_key", QUARANTINE_COLUMNS, "updated_at")


def scd2_merge(dim: DataFrame, snapshot: DataFrame, key: str, tracked: list[str], as_of) -> DataFrame:
    """History merge: changed current rows are closed, their new state and new keys are opened.

    `dim` has the snapshot's columns plus valid_from, valid_to and is_current.
    """
    now = F.lit(as_of).cast("timestamp")
    state = lambda: F.sha2(F.to_json(F.struct(*tracked), {"ignoreNullFields": "false"}), 256)
    payload = [c for c in dim.columns if c not in ("valid_from", "valid_to", "is_current")]
    new = snapshot.select(
        F.col(key), F.struct(*payload).alias("_new"), state().alias("_new_state"))
    old = dim.filter("is_current").select(
        F.col(key), F.struct(*dim.columns).alias("_old"), state().alias("_old_state"))
    j = old.join(new, key, "full")
    changed = F.col("_new_state").isNotNull() & ~F.col("_new_state").eqNullSafe(F.col("_old_state"))
    was = F.col("_old").isNotNull()
    kept_or_closed = F.when(was, F.struct(
        *[F.col("_old")[c].alias(c) for c in payload],
        F.col("_old")["valid_from"].alias("valid_from"),
        F.when(changed, now).otherwise(F.col("_old")["valid_to"]).alias("valid_to"),
        (~changed).alias("is_current"),
    ))
    opened = F.when(changed, F.struct(
        *[F.col("_new")[c].alias(c) for c in payload],
        now.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    ))
    merged = j.select(F.inline(F.array_compact(F.array(kept_or_closed, opened))))
    history = dim.filter(~F.col("is_current"))
    return history.unionByName(merged.select(*dim.columns))


def write_version(df: DataFrame, path: str, committed_at: str) -> None:
    """Store a full copy of a table under its commit time (any sortable ISO text)."""
    df.write.mode("errorifexists").parquet(f"{path}/committed_at={committed_at}")


def snapshot_as_of(spark: SparkSession, path: str, schema, as_of: str) -> DataFrame:
    """The table as committed last at or before `as_of`: versions are found by listing, one folder is read."""
    prefix = "committed_at="
    versions = [unquote(f.removeprefix(prefix)) for f in subfolders(spark, path) if f.startswith(prefix)]
    known = [v for v in versions if v <= as_of]
    if not known:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{prefix}{max(known)}")
