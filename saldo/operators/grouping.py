"""Grouped aggregates that also need exact distinct counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_counts(rows: DataFrame, keys: list[str], distinct: dict[str, Column]) -> DataFrame:
    """Exact distinct counts per key.

    The values are stacked as (keys, which, value) and reduced to distinct rows first, on the map side
    too, so the shuffle carries narrow rows spread over all values: a hot key is many small groups.
    """
    return distinct_values(rows, keys, distinct).groupBy(*keys).agg(
        *[F.count_if(F.col("which") == name).alias(name) for name in distinct])


def aggregate(
    rows: DataFrame,
    keys: list[str],
    measures: list[Column],
    distinct: dict[str, Column],
    approx: bool = False,
    null_keys: bool = False,
) -> DataFrame:
    """Groups by `keys` with additive measures and distinct counts.

    One aggregate holding both would shuffle every measure's buffer beside every distinct value. Here
    the measures are combined on the map side to one row per key and task, the distinct values travel
    alone, and two results of one row per key are joined. `approx` uses sketches in a single pass.
    """
    if approx:
        sketches = [F.approx_count_distinct(c).alias(name) for name, c in distinct.items()]
        return rows.groupBy(*keys).agg(*measures, *sketches)
    totals = rows.groupBy(*keys).agg(*measures)
    counts = distinct_counts(rows, keys, distinct)
    if null_keys:
        renamed = counts.select(
            *[F.col(k).alias(f"_{k}") for k in keys], *list(distinct))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        joined = totals.join(renamed, same, "left")
    else:
        joined = totals.join(counts, keys, "left")
    return joined.select(
        *totals.columns, *[F.coalesce(name, F.lit(0)).alias(name) for name in distinct])


def distinct_values(rows: DataFrame, keys: list[str], distinct: dict[str, Column]) -> DataFrame:
    """Distinct rows (keys, which, value): what distinct counts are taken of."""
    narrow = rows.select(*keys, *[c.cast("string").alias(name) for name, c in distinct.items()])
    return narrow.unpivot(keys, list(distinct), "which", "value").filter(F.col("value").isNotNull()).distinct()


def merged(parts: DataFrame, values: DataFrame, key: str, measures: dict[str, str], distinct: list[str]) -> DataFrame:
    """One row per key from partial measures and distinct values of its days.

    `measures` names how each partial measure is merged: sum, min or max.
    """
    types = {f.name: f.dataType for f in parts.schema.fields}
    totals = parts.groupBy(key).agg(*[getattr(F, how)(name).cast(types[name]).alias(name) for name, how in measures.items()])
    counts = values.select(key, "which", "value").distinct().groupBy(key).agg(
        *[F.count_if(F.col("which") == name).alias(name) for name in distinct])
    return totals.join(counts, key, "left").select(
        *totals.columns, *[F.coalesce(name, F.lit(0)).alias(name) for name in distinct])
