"""Exact dedup: heavy hitters are removed on the map side, all other digests by an ordinary shuffle.

Texts are equal when identical after every run of white space became one space. A null text counts as
empty. Of equal texts the row with the smallest id stays (null ids come last; of rows that repeat the same
id, one stays). An empty table gives an empty result. Other columns are carried along untouched.

Misra-Gries counters, kept per slice of the digest space, find the digests that hold many rows; they can
name digests in error, so each is counted exactly before it counts as a winner. At most
`SLICES * TOP` winners exist, whatever the input, which bounds their broadcast (4,096 rows, about 300 kB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saldo.llm.common import SPACE, row_order, text_or_empty, unpacked
from saldo.session import materialize

SLICES = 16
TOP = 256
COUNTERS = 1024
#: A digest with fewer rows than this is left to the shuffle.
HEAVY_ROWS = 100


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(text), SPACE, " ")


def digest(text: str = "text") -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def heavy_winners(rows: DataFrame) -> DataFrame:
    """(digest, win, n): the winner and the exact row count of every verified heavy digest.

    `rows` has id, digest and row, a tie-breaking row number.
    """
    hashed = rows.withColumn("h", F.xxhash64("digest"))
    sketches = hashed.groupBy(F.pmod("h", F.lit(SLICES)).alias("slice")).agg(
        F.expr(f"approx_top_k(h, {TOP}, {COUNTERS})").alias("top")
    )
    named = sketches.select(F.explode("top").alias("t")).select(F.col("t.item").alias("h"))
    return (
        hashed.join(F.broadcast(named), "h")
        .groupBy("digest")
        .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("win"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= HEAVY_ROWS)
    )


def digest_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One narrow row per document, written once: the row numbers must not change between uses."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), digest(text_col).alias("digest"))
    return materialize(rows.withColumn("row", F.monotonically_increasing_id()), "digests")


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    rows = digest_rows(docs, id_col, text_col)
    winners = materialize(heavy_winners(rows), "heavy")
    tagged = rows.join(F.broadcast(winners), "digest", "left")
    same = Window.partitionBy("digest")
    light = tagged.filter(F.col("win").isNull()).withColumns({
        "win": F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).over(same),
        "n": F.count(F.lit(1)).over(same),
    })
    return tagged.filter(F.col("win").isNotNull()).unionByName(light).select(
        F.col("id").alias(id_col),
        F.col("win.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("win.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    Copies of heavy digests are dropped before the shuffle; the rest is shuffled once by digest.
    """
    winners = materialize(heavy_winners(digest_rows(docs, id_col, text_col)), "heavy")
    rows = docs.select(digest(text_col).alias("digest"), F.struct(F.col("*")).alias("doc")).withColumn(
        "id", F.col("doc").getField(id_col)
    )
    rows = rows.join(F.broadcast(winners), "digest", "left").filter(
        F.col("win").isNull() | F.col("id").eqNullSafe(F.col("win.id"))
    )
    order = row_order(F.col("id"), F.xxhash64(F.col("doc").getField(text_col)))
    first = F.row_number().over(Window.partitionBy("digest").orderBy(*order))
    return unpacked(rows.select("digest", "id", "doc").withColumn("n", first).filter("n = 1"))
