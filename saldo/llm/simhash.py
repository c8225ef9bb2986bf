"""SimHash near-dedup with pigeonring filtering.

A text is lower-cased (A-Z) and cut into words at white space; its shingles are four words, or all words if
there are fewer. A fingerprint bit is 1 if it is set in more than half of the shingles' XXH64 (seed 42). No
words: fingerprint zero, linked like any other. A null text counts as empty. Fingerprints link when at most
four bits differ; a component is all documents reachable by links, and its id their smallest doc_id (null ids
are ignored; a component of null ids alone has none). Repeated rows share a fingerprint. An empty table gives an
empty result.

Filter. The 64 bits are five segments on a ring. If two fingerprints differ in at most 4 bits, some chain of
consecutive segments stays within its proportional budget all along: of its first l segments at most 4 * l / 5
bits differ, that is 0, 1, 2, 3 (pigeonring). The first two conditions are an equality of keys: a fingerprint is
filed under each chain's first two segments, and looks under them and under every one-bit change of the second.
The other conditions prune before the full Hamming check.

Work. Equal fingerprints are one row. First each file of the index links its members to its least and its
greatest member, as far as they are near; groups of copies fall into components by these stars alone. Then only
files that still span several components are searched, and only pairs of different components are compared, so
that a large group of near copies is never expanded into its pairs.

Broadcasts. Spark takes the rows after an explode for as many as before it, though files have 5 and lookups about 37 times
as many, and would broadcast them. They, and what is summed of them, are joined by sort and merge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import keep_rows
from saldo.llm.components import components
from saldo.session import materialize

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Segments of the ring, from the lowest bit.
WIDTHS = (13, 13, 13, 13, 12)
BLOCK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode().lower().split()  # on bytes both act on ASCII alone
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    lefts, rights = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(lefts), BLOCK):
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(lefts[at : at + BLOCK], rights[at : at + BLOCK], strict=True)),
            "<u8",
        )
        ones += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(lefts), bitorder="little").view("<u8")[0])


def fingerprinting(shingle: int):
    @F.pandas_udf("bigint")
    def fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in batch], np.uint64).view(np.int64))

    return fingerprints


def segment(fp: str, k: int) -> Column:
    at = sum(WIDTHS[: k % 5])
    return F.shiftrightunsigned(F.col(fp), at).bitwiseAND(F.lit((1 << WIDTHS[k % 5]) - 1))


def file_key(k: int, first: Column, second: Column) -> Column:
    return F.shiftleft(F.lit(k).cast("bigint"), 26) + F.shiftleft(first, 13) + second


def files(fps: DataFrame) -> DataFrame:
    """Five rows per fingerprint: where it is filed."""
    keys = F.array(*(file_key(k, segment("fp", k), segment("fp", k + 1)) for k in range(5)))
    return fps.withColumn("key", F.explode(keys)).hint("merge")


def lookups(fps: DataFrame) -> DataFrame:
    """Where a fingerprint looks: a one-bit change has the other parity, so only even segments make them."""

    def keys(k: int) -> Column:
        own = file_key(k, segment("fp", k), segment("fp", k + 1))
        flips = F.array(*(F.lit(1 << b).cast("bigint") for b in range(WIDTHS[(k + 1) % 5])))
        changed = F.transform(flips, lambda flip: own.bitwiseXOR(flip))
        even = F.bit_count(segment("fp", k + 1)) % 2 == 0
        return F.concat(F.array(own), F.when(even, changed).otherwise(F.array().cast("array<bigint>")))

    return fps.withColumn("key", F.explode(F.concat(*(keys(k) for k in range(5))))).hint("merge")


def near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MAX_BITS


def viable_chain(a: str, b: str) -> Column:
    """The chain's first three and four segments are within budget; the key says where it starts."""
    differs, ok = F.col(a).bitwiseXOR(F.col(b)), F.lit(False)
    for k in range(5):
        within = F.lit(True)
        for length in (3, 4):
            mask = 0
            for s in range(k, k + length):
                mask |= ((1 << WIDTHS[s % 5]) - 1) << sum(WIDTHS[: s % 5])
            mask -= (mask >> 63) << 64  # as a signed number
            within &= F.bit_count(differs.bitwiseAND(F.lit(mask).cast("bigint"))) <= MAX_BITS * length // 5
        ok = F.when(F.shiftright("key", 26) == k, within).otherwise(ok)
    return ok


def labelled(fps: DataFrame, labels: DataFrame, column: str, out: str) -> DataFrame:
    """Adds the component of `column`; a value without links is its own."""
    names = labels.select(F.col("node").alias(column), F.col("label").alias("_label"))
    return fps.join(names, column, "left").withColumn(out, F.coalesce("_label", column)).drop("_label")


def link_fingerprints(fps: DataFrame) -> DataFrame:
    """(fp, label) for distinct fingerprints: the label is the least fingerprint, as a signed number, of its component."""
    filed = files(fps)
    hubs = filed.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low != high")
    stars = filed.join(hubs, "key").withColumn("v", F.explode(F.array("low", "high"))).filter(near("fp", "v"))
    first = materialize(labelled(fps, components(stars.select(F.col("fp").alias("u"), "v")), "fp", "label"), "stars")

    filed = files(first)
    spans = filed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    looking = lookups(first).join(spans, "key").filter("low != label OR high != label").select("key", "fp", "label")
    others = filed.select(F.col("key").alias("key2"), F.col("fp").alias("fp2"), F.col("label").alias("label2"))
    pairs = looking.join(
        others, (F.col("key") == F.col("key2")) & (F.col("label") != F.col("label2")) & viable_chain("fp", "fp2") & near("fp", "fp2")
    )
    second = components(pairs.select(F.col("label").alias("u"), F.col("label2").alias("v")))
    return labelled(first, second, "label", "top").select("fp", F.col("top").alias("label"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text_hash, fp, label and component_id for every row."""
    text = F.col(f"`{text_col}`")
    rows = materialize(
        docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("text_hash"), fingerprinting(shingle)(text).alias("fp")),
        "fingerprints",
    )
    classes = materialize(rows.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    linked = materialize(link_fingerprints(classes.select("fp")).join(classes, "fp"), "linked")
    ids = linked.groupBy("label").agg(F.min("least").alias("component_id"))
    return rows.join(linked.select("fp", "label").join(ids, "label"), "fp")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` without near duplicates: of each component the row of the smallest id stays."""
    found = near_duplicates(docs, shingle, id_col, text_col)
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("k")
    return keep_rows(docs, found.groupBy("label").agg(least).select("k.id", "k.text_hash"), id_col, text_col)
