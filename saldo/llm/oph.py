"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits.

A text's shingles are five words (all words if there are fewer), words being what white space separates. Each
shingle is hashed once; the top bits of the hash name one of 256 bins, and a bin keeps its least hash. An
empty bin takes the value of another: it draws bins by a hash of its own number and the attempt until one is
not empty (optimal densification), so the choice is the same in every document and independent between bins.
After `ATTEMPTS` draws the remaining draws are made at once, as the non-empty bin whose hash with this bin is
least, which is the same uniform choice. Stored are the low 8 bits of every bin, packed into 512 hexadecimal
digits.

Two fingerprints of b-bit bins agree by chance in a share c = 2^-8 of the bins, so the likeness is
(share of equal bins - c) / (1 - c), at least 0. A null text counts as empty; a text without words has the empty
fingerprint, whose likeness is 1 to another empty one and else 0. Repeated rows have equal fingerprints.

`with_edits` compares every text with an edited text, made of its first half and the beginning of the next
document by id (null ids last, ties by the text's hash; the last document is followed by the first). Texts are
shuffled once, by ranges of ids; the first rows of a range are sent along to the range before it, so no other
join is needed. No step runs Python on the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saldo.llm.common import SPACE, row_order, text_or_empty

SHINGLE = 5
BINS = 256
BIN_BITS = 8
BITS = 8
ATTEMPTS = 8
#: Rows of a range of ids, and the most ranges; beyond, ranges hold more rows.
RANGE_ROWS = 512
RANGES = 4096


#: A bin's greatest value stands for an empty bin.
EMPTY = (1 << 56) - 1


def with_fingerprint(rows: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the bins of a text column: 256 signed bytes, or none if the text has no words.

    Steps are columns of their own, as an array used inside a lambda must not be computed per element.
    """
    keep = rows.columns
    words = F.split(F.btrim(F.col(text), F.lit(" \t\n\x0b\f\r")), SPACE)
    rows = rows.withColumn("h", F.transform(words, lambda w: F.xxhash64(w)))
    rolling = F.transform(
        F.sequence(F.lit(0), F.size("h") - SHINGLE), lambda i: F.xxhash64(*(F.get("h", i + k) for k in range(SHINGLE)))
    )
    hashes = F.when(F.size("h") >= SHINGLE, rolling).otherwise(F.array(F.xxhash64("h")))
    floor = F.array(*(F.lit(((b ^ 128) - 128) * (EMPTY + 1) + EMPTY) for b in range(BINS)))
    rows = rows.withColumn("s", F.sort_array(F.concat(hashes, floor)))

    def first_of_bin(x: Column, i: Column) -> Column:
        return (i == 0) | (F.shiftright(x, 56) != F.shiftright(F.get("s", i - 1), 56))

    rows = rows.withColumn("least", F.filter("s", first_of_bin))
    byte = F.transform(
        "least", lambda x: F.when(x.bitwiseAND(F.lit(EMPTY)) != EMPTY, F.shiftright(F.shiftleft(x, 64 - BITS), 64 - BITS).cast("tinyint"))
    )
    rows = rows.withColumn("low", byte)
    rows = rows.withColumn("full", F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda k: F.get("low", k).isNotNull()))

    def filled(v: Column, j: Column) -> Column:
        draws = [F.get("low", F.pmod(F.xxhash64(j, F.lit(a)), F.lit(BINS)).cast("int")) for a in range(ATTEMPTS)]
        others = F.transform("full", lambda k: F.struct(F.xxhash64(j, k).alias("h"), F.get("low", k).alias("v")))
        rest = F.when(F.size("full") > 0, F.array_min(others).getField("v"))
        return F.coalesce(v, *draws, rest)

    bins = F.when(F.btrim(F.col(text), F.lit(" \t\n\x0b\f\r")) == "", F.array().cast("array<tinyint>")).otherwise(F.transform("low", filled))
    return rows.withColumn(out, bins).select(*keep, out)


def packed_bins(bins: str) -> Column:
    digits = F.array(*(F.lit(f"{v:02x}") for v in range(256)))
    return F.array_join(F.transform(bins, lambda v: F.get(digits, v.cast("int").bitwiseAND(F.lit(255)))), "")


def likeness(a: str, b: str) -> Column:
    """Estimated share of common shingles of two fingerprints' texts, corrected for chance agreement."""
    equal = F.size(F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda k: F.get(a, k) == F.get(b, k)))
    chance = 2.0**-BITS
    empty = (F.size(a) == 0).cast("int") + (F.size(b) == 0).cast("int")
    estimate = F.greatest(F.lit(0.0), (equal / BINS - chance) / (1 - chance))
    return F.when(empty == 2, F.lit(1.0)).when(empty == 1, F.lit(0.0)).otherwise(estimate)


def range_of(value: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are not above the value; null is above all. Two steps of about a square root each."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    blocks = [bounds[k : k + step] for k in range(0, len(bounds), step)]

    def upto(many: Column) -> Column:
        return F.size(F.filter(many, lambda b: b <= value))

    heads = F.array(*(F.lit(b[0]).cast("bigint") for b in blocks))
    inner = F.array(*(F.array(*(F.lit(v).cast("bigint") for v in b)) for b in blocks))
    block = upto(heads)
    within = F.when(block == 0, 0).otherwise((block - 1) * step + upto(F.get(inner, block - 1)))
    return F.when(value.isNull(), len(bounds)).otherwise(within)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fingerprint of every row."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
    return with_fingerprint(rows, "text", "bins").select(F.col("id").alias(id_col), packed_bins("bins").alias("fingerprint"))


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), text_or_empty(text_col).alias("text"))
    ids = rows.agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).first()
    wanted = min(RANGES, ids.n // RANGE_ROWS)
    bounds: list[int] = []
    if wanted > 1:
        shares = F.array(*(F.lit(k / wanted) for k in range(1, wanted)))
        found = rows.agg(F.percentile_approx("id", shares, 20 * wanted).alias("b")).first().b or []
        bounds = sorted({b for b in found if b > ids.first})
    ranges = len(bounds) + 1
    starts = F.col("id").eqNullSafe(F.lit(ids.first).cast("bigint"))
    if bounds:
        starts |= F.col("id").isin(bounds)
    rows = with_fingerprint(rows, "text", "bins").withColumn("range", range_of(F.col("id"), bounds))
    before = F.pmod(F.col("range") + ranges - 1, F.lit(ranges))
    # A range's first rows are also sent, as guests, to the end of the range before it.
    places = F.when(F.coalesce(starts, F.lit(False)), F.array("range", before)).otherwise(F.array("range"))
    rows = rows.select("id", "text", "bins", F.posexplode(places).alias("guest", "place"))
    order = Window.partitionBy("place").orderBy("guest", *row_order(F.col("id"), F.xxhash64("text")))
    rows = rows.withColumns({"next_text": F.lead("text").over(order), "next_bins": F.lead("bins").over(order)}).filter("guest = 0")
    half = F.expr("length(text) div 2").cast("int")
    edited = F.concat(F.left("text", F.length("text") - half), F.left("next_text", half))
    rows = rows.select("id", F.length("text").cast("bigint").alias("n_chars"), "bins", "next_bins", edited.alias("edited"))
    rows = with_fingerprint(rows, "edited", "edited_bins")
    return rows.select(
        F.col("id").alias(id_col),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        packed_bins("bins").alias("fingerprint"),
        packed_bins("edited_bins").alias("edited_fingerprint"),
        likeness("bins", "edited_bins").alias("near_edited"),
        likeness("bins", "next_bins").alias("near_next"),
    )
