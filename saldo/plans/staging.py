"""Staging model: bronze payment events plus their category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.functions.macros import staging_category
from saldo.operators.incremental import newer_than
from saldo.operators.tables import newest_per_key
from saldo.schemas import BRONZE


def stg_payment_events(bronze: DataFrame, loaded_until=None) -> DataFrame:
    """Identified events with `event_category`; only rows from the high-water mark on when one is given."""
    rows = newer_than(bronze, "ingested_at", loaded_until).filter(F.col("event_id").isNotNull())
    return rows.select(
        *[F.col(f.name) for f in BRONZE.fields],
        staging_category(F.col("event_type")).alias("event_category"),
    )


def arrival_order() -> Column:
    """Order of an event's rows: by ingestion time, then by content, so that full and incremental builds agree."""
    return F.struct(F.col("ingested_at"), F.xxhash64(*[F.col(f.name) for f in BRONZE.fields]))


def newest_events(stg: DataFrame) -> DataFrame:
    """One row per event id, the last one ingested."""
    return newest_per_key(stg, ["event_id"], arrival_order())
