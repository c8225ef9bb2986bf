"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saldo.session import materialize

#: Runs of these characters separate words; a word is anything else.
SPACE = r"[\x20\x09-\x0D]+"


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(f"`{text}`"), F.lit(""))


def packed(docs: DataFrame) -> DataFrame:
    """All columns as one struct `doc`, so that the names of working columns cannot clash with theirs."""
    return docs.select(F.struct(F.col("*")).alias("doc"))


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("doc.*")


def row_order(id_col: Column, *ties: Column) -> list[Column]:
    """Ascending ids, null ids last."""
    return [id_col.asc_nulls_last(), *(t.asc_nulls_last() for t in ties)]


def running(df: DataFrame, order: Sequence[str], sums: Sequence[str], label: str) -> DataFrame:
    """Adds `cum_<name>`: the sum of each column over all rows up to this one, in the given order.

    Rows are range-partitioned by the order, so a hot key is cut over several partitions. Only one
    row of totals per partition is gathered; each partition is then summed by itself.
    """
    spark = df.sparkSession
    spread = materialize(
        df.repartitionByRange(partitions(spark), *order).withColumn("_part", F.spark_partition_id()), label
    )
    totals = spread.groupBy("_part").agg(*(F.sum(c).alias(f"_all_{c}") for c in sums))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", *(F.coalesce(F.sum(f"_all_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sums))
    upto = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per partition: bounded by the number of shuffle partitions.
    return (
        spread.withColumns({f"cum_{c}": F.sum(c).over(upto) for c in sums})
        .join(F.broadcast(offsets), "_part")
        .withColumns({f"cum_{c}": F.col(f"cum_{c}") + F.col(f"_off_{c}") for c in sums})
        .drop("_part", *(f"_off_{c}" for c in sums))
    )


def bin_offsets(bins: DataFrame, group: Sequence[str], coarse: str, fine: str, n: str, out: str) -> DataFrame:
    """Adds `out`: the sum of `n` over the group's bins before this one, in the order (coarse, fine).

    Summed in two levels, so that no window holds more rows than a group has coarse or a coarse bin fine ones.
    """
    whole = bins.groupBy(*group, coarse).agg(F.sum(n).alias("_all"))
    earlier = Window.partitionBy(*group).orderBy(coarse).rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select(*group, coarse, F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group, coarse).orderBy(fine).rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("_in", F.coalesce(F.sum(n).over(inside), F.lit(0)))
    return bins.join(whole, [*group, coarse]).withColumn(out, F.col("_before") + F.col("_in")).drop("_before", "_in")


def rank_in_group(df: DataFrame, group: Sequence[str], order: Sequence[str], bins: int = 64) -> DataFrame:
    """Adds `rank`: 0, 1, ... within each group, without ever holding a group in one task.

    Rows of a group are spread over bins * bins bins by a hash of their order columns; the bins' counts give
    each bin its first rank. The order of ranks is that of the bins, then of the order columns.
    """
    at = F.xxhash64(*order)
    spread = df.withColumns({"_coarse": F.pmod(at, F.lit(bins)), "_fine": F.pmod(F.shiftright(at, 32), F.lit(bins))})
    counts = spread.groupBy(*group, "_coarse", "_fine").agg(F.count(F.lit(1)).alias("_n"))
    firsts = bin_offsets(counts, group, "_coarse", "_fine", "_n", "_first").drop("_n")
    within = Window.partitionBy(*group, "_coarse", "_fine").orderBy(*order)
    return (
        spread.withColumn("_at", F.row_number().over(within) - 1)
        .join(firsts, [*group, "_coarse", "_fine"])
        .withColumn("rank", F.col("_first") + F.col("_at"))
        .drop("_coarse", "_fine", "_at", "_first")
    )


def row_key(id_: Column, text_hash: Column) -> Column:
    return F.concat_ws(":", F.coalesce(id_.cast("string"), F.lit("none")), text_hash.cast("string"))


def keep_rows(docs: DataFrame, keepers: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of `docs` that `keepers` (id, text_hash) names; of repeats of such a row, one.

    Join and window share one key of id and text, so the texts are shuffled once.
    """
    wanted = keepers.select(row_key(F.col("id"), F.col("text_hash")).alias("key"))
    rows = packed(docs)
    rows = rows.withColumn("key", row_key(F.col("doc").getField(id_col), F.xxhash64(F.col("doc").getField(text_col))))
    found = rows.join(wanted, "key", "left_semi")
    first = F.row_number().over(Window.partitionBy("key").orderBy(F.lit(1)))
    return unpacked(found.withColumn("n", first).filter("n = 1"))
