"""Per-key ordered lookups that stay safe when one key holds a large share of the rows.

A plain `Window.partitionBy(key).orderBy(ts)` puts every row of a key into one task. Here all rows are cut into ranges
of (key, time, tie) by sampled quantiles, so a hot key, even within one second, spans several ranges. A window scans each
range by itself; one carried row per range connects the ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saldo.session import materialize


def ranges(df: DataFrame, order: list[str], parts: int | None = None) -> DataFrame:
    """The rows in ranges of about equal size by the given order, numbered by `_part`, one range to a partition.

    Written once: the sampled bounds hold for all readers and for tasks that are run again. Rows that tie in all
    columns of the order share a range. `parts` is the number of shuffle partitions unless given.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    return materialize(cut, "ranges").repartitionById(parts, F.col("_part"))


def next_value(
    df: DataFrame, key: str, ts: str, tie: str, value: str, out: str, parts: int | None = None
) -> DataFrame:
    """Adds the value of the key's next row by (ts, tie); rows with a null key count as one key's."""
    order = [key, ts, tie]
    rows = ranges(df, order, parts)
    row = F.struct(F.col(key).alias("k"), F.col(ts).alias("t"), F.col(tie).alias("i"), F.col(value).alias("v"))
    # One row per range, bounded by the number of ranges.
    heads = rows.groupBy("_part").agg(F.min(row).alias("_head"))
    following = heads.select("_part", F.lead("_head").over(Window.orderBy("_part")).alias("_after"))
    within = Window.partitionBy("_part").orderBy(*order)
    after = F.coalesce("_next", "_after")
    return (
        rows.withColumn("_next", F.lead(row).over(within))
        .join(F.broadcast(following), "_part")
        .withColumn(out, F.when(after["k"].eqNullSafe(F.col(key)), after["v"]))
        .drop("_part", "_next", "_after")
    )


def trailing_count(df: DataFrame, key: str, order: Column, member: Column, out: str) -> DataFrame:
    """Rows of each key that satisfy `member` and come after its last row that does not.

    Two aggregations with map-side combining and one join; no ordering of a key's rows.
    """
    marked = df.select(F.col(key), order.alias("_at"), member.alias("_in"))
    last_out = marked.groupBy(key).agg(F.max(F.when(~F.col("_in"), F.col("_at"))).alias("_last_out"))
    after = marked.filter("_in").join(last_out, key).filter(
        F.col("_last_out").isNull() | (F.col("_at") > F.col("_last_out")))
    streak = after.groupBy(key).agg(F.count(F.lit(1)).alias(out))
    return last_out.select(key).join(streak, key, "left").select(
        key, F.coalesce(out, F.lit(0)).cast("bigint").alias(out))


def point_in_time_join(
    labels: DataFrame,
    features: DataFrame,
    entity: str,
    label_ts: str,
    feature_ts: str,
    fields: list[str],
    ttl_seconds: int,
    parts: int | None = None,
) -> DataFrame:
    """Adds to each label the newest feature row of its entity that is not later and not past its TTL.

    Labels and features are scanned together in order of (entity, time); the newest feature of earlier ranges is
    carried into each range. Of features with one entity and time, the one with the greatest hash of its values counts.
    A label without an entity or a time gets no feature.
    """
    names = labels.columns
    feat = F.struct(
        F.col(entity).alias("_of"), F.col(feature_ts).cast("timestamp").alias("_fts"), *[F.col(c) for c in fields])
    f = features.filter(F.col(entity).isNotNull() & F.col(feature_ts).isNotNull()).select(
        F.col(entity).alias("_entity"), F.col(feature_ts).cast("timestamp").alias("_ts"), F.lit(0).alias("_asks"),
        F.xxhash64(*fields).alias("_tie"), feat.alias("_feat"),
    )
    lab = labels.select(
        F.col(entity).alias("_entity"), F.col(label_ts).cast("timestamp").alias("_ts"), F.lit(1).alias("_asks"),
        F.xxhash64(*names).alias("_tie"), F.struct(*names).alias("_label"),
    )
    order = ["_entity", "_ts", "_asks", "_tie"]
    rows = ranges(lab.unionByName(f, allowMissingColumns=True), order, parts)
    # One row per range, bounded by the number of ranges. The last feature may be another entity's: then there is none.
    tails = rows.groupBy("_part").agg(F.max_by("_feat", F.when(F.col("_asks") == 0, F.struct(*order))).alias("_tail"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select("_part", F.last("_tail", ignorenulls=True).over(earlier).alias("_carried"))
    up_to = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    matched = (
        rows.withColumn("_within", F.last("_feat", ignorenulls=True).over(up_to))
        .filter(F.col("_asks") == 1)
        .join(F.broadcast(carried), "_part")
    )
    hit = F.coalesce("_within", "_carried")
    fresh = (hit["_of"] == F.col("_entity")) & (F.unix_micros(hit["_fts"]) > F.unix_micros("_ts") - ttl_seconds * 1_000_000)
    return matched.select(
        *[F.col("_label")[c].alias(c) for c in names],
        *[F.when(fresh, hit[c]).alias(c) for c in fields],
        F.when(fresh, hit["_fts"]).alias("feature_ts"),
    )
