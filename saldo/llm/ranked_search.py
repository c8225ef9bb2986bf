"""Ranked lexical search by presence masks: the best documents for each item of a query set.

Terms are runs of ASCII letters and digits and of any other code points from U+0080 on; only A-Z are lower-cased. The
score is the integer one of `weight` and `contribution`: 64-bit integers, except for the logarithm, which is a double's.

The query set is taken in blocks of about `BLOCK_BYTES` of text, so that a block's terms fit in every task whatever the
set's size. For each block:

1. One pass over the documents writes, per document, its number of terms and the block's terms it holds, with their
   counts. From that table come the totals and the number of documents that hold each term.
2. Each task of a second pass lays some thousand documents side by side: a bitmap per term (who holds it) and the
   term's greatest contribution among them. For an item, the bitmaps of its terms, turned by ninety degrees, are the
   presence masks of the documents; documents with one mask form a group, and a mask can score no more than the sum of
   its terms' greatest contributions. Distinct masks are evaluated by descending maximum, until the last of the best
   scores found is above the next maximum: then no other document can be among the best. An item whose own maximum
   is below is not even grouped. What a task has found so far carries over to its next documents.
3. The best of every task, at most `most` rows per item, are ranked per item.

Documents without a term (null, empty, only separators) count nowhere and are never found. Equal scores are ordered by
ascending id, null ids last; rows with one id are documents of their own. Every row of the query set is an item of its own, so
repeated rows have repeated results; items without a term have none. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saldo.llm.words import windows
from saldo.session import materialize

MOST = 10
#: Text of the query set that is searched at once.
BLOCK_BYTES = 1 << 22
#: Documents side by side, and bits of their bitmaps, at most.
SIDE, BITMAP_BITS = 1 << 14, 1 << 28
#: Documents scored at once.
SCORED = 256

LETTERS_DIGITS = b"abcdefghijklmnopqrstuvwxyz0123456789"
TABLE = bytes(
    c if c >= 0x80 or c in LETTERS_DIGITS else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)
POSTINGS = "struct<n:bigint,terms:array<int>,counts:array<bigint>>"


def term_counts(text: str | None) -> Counter:
    """How often each term occurs."""
    counts: Counter = Counter()
    if text:
        for piece in windows(text.encode().translate(TABLE)):
            counts.update(piece.split())
    return counts


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def contribution(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What a term of weight 1 adds to the score of documents with n terms, tf of which are it."""
    m = 100 - 75 + (75 * n * documents) // terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def counting(vocabulary: dict[bytes, int]):
    """A column function text -> (n, terms, counts)."""

    @F.arrow_udf(POSTINGS)
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        number = vocabulary.get
        for batch in batches:
            n, ends, terms, counts = [], [0], [], []
            for text in batch:
                held = term_counts(text.as_py())
                n.append(held.total())
                for term, tf in held.items():
                    if (k := number(term)) is not None:
                        terms.append(k)
                        counts.append(tf)
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.StructArray.from_arrays(
                [
                    pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
                ],
                ["n", "terms", "counts"],
            )

    return count.asNondeterministic()  # else each use of its result would run it again


class Side:
    """Some documents side by side: their postings, a bitmap and the greatest contribution of each term."""

    def __init__(self, rows: pa.Table, size: int, documents: int, terms: int) -> None:
        rows = rows.combine_chunks()
        flat = lambda name: rows[name].combine_chunks().flatten().to_numpy()
        self.n = len(rows)
        self.ids = rows["id"].combine_chunks()
        place = pc.sort_indices(self.ids, null_placement="at_end").to_numpy()
        self.order = np.empty(self.n, np.int64)
        self.order[place] = np.arange(self.n)
        held = pc.list_value_length(rows["terms"].combine_chunks()).to_numpy()
        self.starts = np.concatenate(([0], np.cumsum(held, dtype=np.int64)))
        self.terms = flat("terms")
        owner = np.repeat(np.arange(self.n), held)
        self.adds = contribution(flat("counts"), rows["n"].to_numpy()[owner], documents, terms)
        self.greatest = np.zeros(size, np.int64)
        np.maximum.at(self.greatest, self.terms, self.adds)
        bitmaps = np.zeros((size, -(-self.n // 8)), np.uint8)
        # A document holds a term once, so sums of bits are their union.
        np.add.at(bitmaps, (self.terms, owner >> 3), (128 >> (owner & 7)).astype(np.uint8))
        self.bitmaps = bitmaps

    def masks(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the terms each distinct mask has (masks x terms), and each document's mask."""
        held = np.unpackbits(self.bitmaps[terms], axis=1, count=self.n)
        packed = np.packbits(held, axis=0)
        packed = np.pad(packed, ((0, -len(packed) % 8), (0, 0)))
        first, *more = np.ascontiguousarray(packed.T).view(np.uint64).T
        _, where, group = np.unique(first, return_index=True, return_inverse=True)
        for column in more:
            _, part = np.unique(column, return_inverse=True)
            _, where, group = np.unique(group * self.n + part, return_index=True, return_inverse=True)
        return held[:, where].T, group

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        start, n = self.starts[docs], self.starts[docs + 1] - self.starts[docs]
        before = np.cumsum(n) - n
        at = np.repeat(start - before, n) + np.arange(int(n.sum()))
        return np.add.reduceat(weights[self.terms[at]] * self.adds[at], before)

    def best(self, terms: np.ndarray, weights: np.ndarray, floor: int, most: int) -> list[tuple[int, int]]:
        """(score, document) of the best documents here; none below `floor` is needed."""
        limits = weights[terms] * self.greatest[terms]
        if limits.sum() <= 0 or limits.sum() < floor:
            return []
        mask, group = self.masks(terms)
        tops = mask.astype(np.int64) @ limits
        rank = np.argsort(-tops, kind="stable")
        place = np.empty(len(rank), np.int64)
        place[rank] = np.arange(len(rank))
        by_mask = np.argsort(place[group], kind="stable")
        ends = np.cumsum(np.bincount(place[group], minlength=len(rank)))
        tops = tops[rank]
        score, doc = np.empty(0, np.int64), np.empty(0, np.int64)
        done = at = 0
        while at < len(tops) and tops[at] > 0 and tops[at] >= floor:
            # The next mask, and those behind it that together have no more than SCORED documents.
            at = max(at + 1, int(np.searchsorted(ends, done + SCORED, "right")))
            docs = by_mask[done : ends[at - 1]]
            done = int(ends[at - 1])
            score, doc = np.concatenate((score, self.scores(docs, weights))), np.concatenate((doc, docs))
            top = np.lexsort((self.order[doc], -score))[:most]
            score, doc = score[top], doc[top]
            if len(score) == most:
                floor = max(floor, int(score[-1]))
        return [(int(s), int(d)) for s, d in zip(score, doc, strict=True) if s > 0]


def searching(items: list[dict[int, int]], weights: list[int], documents: int, terms: int, most: int):
    """A function over batches of (id, n, terms, counts) that gives the best documents of a task per item."""
    side = max(64, min(SIDE, BITMAP_BITS // max(len(weights), 1)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = np.array(weights, np.int64)
        wanted = []
        for item in items:
            held = np.fromiter(item, np.int64, len(item))
            wanted.append((held, value[held] * np.fromiter(item.values(), np.int64, len(item))))
        found: list[list[tuple]] = [[] for _ in items]  # (score, null id?, id)
        asked = np.zeros(len(value), np.int64)

        def judge(rows: pa.Table) -> None:
            here = Side(rows, len(value), documents, terms)
            for best, (held, worth) in zip(found, wanted, strict=True):
                if not len(held):
                    continue
                asked[held] = worth
                floor = best[-1][0] if len(best) == most else 1
                for score, doc in here.best(held, asked, floor, most):
                    key = here.ids[doc].as_py()
                    best.append((score, key is None, key))
                asked[held] = 0
                best.sort(key=lambda b: (-b[0], b[1], 0 if b[1] else b[2]))
                del best[most:]

        waiting: list[pa.RecordBatch] = []
        kind = None
        for batch in batches:
            kind = batch.schema.field("id").type
            for k in range(0, len(batch), side):
                waiting.append(batch.slice(k, side))
                if sum(map(len, waiting)) >= side:
                    judge(pa.Table.from_batches(waiting))
                    waiting = []
        if waiting:
            judge(pa.Table.from_batches(waiting))
        rows = [(k, key, score) for k, best in enumerate(found) for score, _, key in best]
        if rows:
            item, ids, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), pa.array(ids, kind), pa.array(score, pa.int64())], ["item", "id", "score"]
            )

    return search


def search_block(docs: DataFrame, queries: list, most: int, id_col: str, text_col: str) -> DataFrame | None:
    """(item number, id, score) candidates for a bounded list of query texts; None if they have no terms."""
    held = [term_counts(text) for text in queries]
    vocabulary = {term: k for k, term in enumerate(sorted(set().union(*held)))}
    if not vocabulary:
        return None
    counted = counting(vocabulary)(F.col(f"`{text_col}`")).alias("held")
    postings = materialize(docs.select(F.col(f"`{id_col}`").alias("id"), counted).select("id", "held.*"), "postings")
    documents, terms = postings.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not documents:
        return None
    # One row per term of the block.
    holding = dict(map(tuple, postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect()))
    weights = [weight(documents, holding.get(k, 0)) for k in range(len(vocabulary))]
    items = [{vocabulary[t]: tf for t, tf in h.items() if holding.get(vocabulary[t])} for h in held]
    schema = postings.selectExpr("cast(0 as int) as item", "id", "cast(0 as bigint) as score").schema
    return postings.filter(F.size("terms") > 0).mapInArrow(searching(items, weights, documents, terms, most), schema)


def search(
    docs: DataFrame, queries: DataFrame, most: int = MOST,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """item, rank (from 1), id, score: the `most` highest-scoring documents of each item, those with a score above 0."""
    spark = docs.sparkSession
    asked = queries.select(F.col(f"`{item_col}`").alias("key"), F.col(f"`{item_text}`").alias("asked"))
    size = asked.agg(F.coalesce(F.sum(F.octet_length("asked")), F.lit(0))).first()[0]
    blocks = size // BLOCK_BYTES + 1
    names = [item_col, "rank", id_col, "score"]
    key, id_ = asked.schema["key"].dataType.simpleString(), docs.schema[id_col].dataType.simpleString()
    out = spark.createDataFrame([], f"`{item_col}` {key}, rank int, `{id_col}` {id_}, score bigint")
    for block in range(blocks):
        mine = F.pmod(F.xxhash64("key", "asked"), F.lit(blocks)) == block
        rows = asked.filter(mine).collect()  # about BLOCK_BYTES of text
        found = search_block(docs, [r.asked for r in rows], most, id_col, text_col)
        if found is None:
            continue
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
        items = spark.createDataFrame([(k, r.key) for k, r in enumerate(rows)], f"item int, key {key}")
        out = out.unionByName(ranked.join(F.broadcast(items), "item").select("key", "rank", "id", "score").toDF(*names))
    return out
