"""Sharding: the contiguous partition of atomic groups into shards whose largest shard is smallest.

Groups are the rows of equal text; they are ordered by the digest of the text and never cut. The smallest
capacity for which a greedy fill needs no more than the wanted number of shards is found by binary search,
then the groups are cut there (law `bytes`).

The search needs no pass over the groups per step. The driver holds prefix sums at the edges of a bounded
number of bins. A greedy fill over them is either certain, or uncertain within a few bins; only those are
cut 64 times finer by the next Spark job. At most `PROBES * 2 * shards` bins are cut per job.

A null text has no bytes and counts as empty; a row's size is its UTF-8 bytes plus one. Repeated rows get
slots of their own. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import running, text_or_empty
from saldo.session import materialize

FAN_OUT = 64
PROBES = 9


class PrefixSums:
    """Known values of an increasing column, and the bins in which there are unknown ones."""

    def __init__(self, sums: DataFrame, column: str):
        self.sums, self.column = sums, column
        top = sums.agg(F.max(column)).first()[0]
        self.total = int(top or 0)
        self.levels = 1
        while self.total // FAN_OUT ** self.levels >= FAN_OUT:
            self.levels += 1
        self.points: list[int] = []
        self.open: dict[int, tuple[int, int]] = {}
        self.learn(0, None)

    def width(self, level: int) -> int:
        return FAN_OUT ** max(0, self.levels - 1 - level)

    def learn(self, level: int, parents: list[int] | None) -> None:
        """Adds the edges of the bins of one level, within the given bins of the level above."""
        value, rows = F.col(self.column), self.sums
        if parents is not None:
            rows = rows.filter(F.expr(f"{self.column} div {self.width(level - 1)}").isin(parents))
        found = (
            rows.groupBy(F.expr(f"{self.column} div {self.width(level)}").alias("bin"))
            .agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count(F.lit(1)).alias("n"))
            .collect()
        )
        known = set(self.points)
        for r in found:
            known |= {r.low, r.high}
            self.open.pop(r.low, None)
            if r.n > 2:
                self.open[r.low] = (level, r.bin)
        self.points = sorted(known)

    def refine(self, bins: set[tuple[int, int]]) -> None:
        for level in sorted({at for at, _ in bins}):
            self.learn(level + 1, [b for at, b in bins if at == level])

    def fill(self, capacity: int, shards: int, hopeful: bool) -> tuple[bool, list[int], set[tuple[int, int]]]:
        """A greedy fill: whether it fits, its cuts, and the bins in which a cut is uncertain."""
        at, cuts, unsure = 0, [], set()
        while at < self.total:
            if len(cuts) == shards:
                return False, cuts, unsure
            reach, k = at + capacity, bisect_right(self.points, at + capacity) - 1
            cut = self.points[k] if k >= 0 else 0
            if cut in self.open and cut <= reach:
                unsure.add(self.open[cut])
                cut = reach if hopeful else cut
            if cut <= at:
                return False, cuts, unsure
            at = cut
            cuts.append(at)
        return True, cuts, unsure


def smallest(lo: int, hi: int, fits) -> int:
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if fits(mid) else (mid + 1, hi)
    return lo


def minimax_cuts(sums: DataFrame, column: str, shards: int) -> list[int]:
    """Prefix sums at which the shards end, for the smallest feasible capacity."""
    known = PrefixSums(sums, column)
    if not known.total:
        return []
    lo, hi = -(-known.total // shards), known.total
    while True:
        hi = smallest(lo, hi, lambda c: known.fill(c, shards, False)[0])
        lo = smallest(lo, hi, lambda c: known.fill(c, shards, True)[0])
        if lo == hi:
            unsure = known.fill(lo, shards, False)[2]
            if not unsure:
                return known.fill(lo, shards, False)[1]
        else:
            probes = {lo + (hi - lo) * i // (PROBES - 1) for i in range(PROBES)}
            unsure = set().union(*(known.fill(c, shards, hope)[2] for c in probes for hope in (True, False)))
        known.refine(unsure)


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, law, shard, slot, grown_shard for every row."""
    text = text_or_empty(text_col)
    rows = materialize(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("crc"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.lit(1).cast("bigint").alias("one"),
        ),
        "sizes",
    )
    groups = rows.groupBy("digest").agg(F.sum("size").alias("size"), F.sum("one").alias("one"))
    sums = materialize(running(groups, ["digest"], ["size", "one"], "groups"), "sums")
    cuts = minimax_cuts(sums, "cum_size", shards)
    # One row per shard.
    ends = sorted((bytes(r.digest), r.cum_one) for r in sums.filter(F.col("cum_size").isin(cuts or [0])).collect())
    number, first = F.lit(0), F.lit(0)
    for k, (last, upto) in enumerate(ends[:-1], 1):
        beyond = F.col("digest") > F.lit(bytearray(last))
        number, first = F.when(beyond, k).otherwise(number), F.when(beyond, upto).otherwise(first)
    return running(rows, ["digest", "id"], ["one"], "rows").select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        number.cast("int").alias("shard"),
        (F.col("cum_one") - 1 - first).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
