"""Periodic runs of words, found by dyadic square catchers.

A run is a stretch of consecutive words with smallest period q and at least max(24, 3 q) words that cannot be
extended on either side keeping that period.

The words are laid end to end in streams, a word of its own between two texts. A catcher stands at the end e of
a completed block of L = 2^k words and watches the L words appended behind it; it answers for the squares
that begin in its block and end in these words. Every square has exactly one such catcher: the one at the
coarsest block edge inside it. An appended word proposes a period in two cases:

* it equals the block's last word: the square's middle lies behind the edge, its period is the number of words
  appended so far;
* it is the first one appended and equals a word of the block: the middle lies in the block.

Each proposal starts a comparison of the stream with itself, shifted by the period, to both sides of that word. A
comparison advances word by word for `STEPS` words, which ends almost all of them; what is left is finished by
binary search over fingerprints of prefixes. All catchers of a level advance side by side, level by level, which only
changes the order in which squares are reported. The squares of one period that overlap merge into a run; of
periods with the same run the smallest counts. A proposal inside a known run whose period divides the proposed one
is that run again and is not followed, so a text of one repeated word costs no more than others. Each run
is compared word by word in the end, and mended if fingerprints have deceived, so the result is exact.

A null text has no words; empty and white texts neither. Each row is judged by itself, whole: repeated rows
(with equal ids or not) give repeated results, null ids are kept, an empty table gives an empty result. A text takes about
40 bytes of memory per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.llm.words import Names, joined, numbered

#: Least number of words of a run, and of repeats of its period.
LEAST_WORDS, LEAST_REPEATS = 24, 3
#: Words of a stream; a longer text is a stream by itself.
STREAM = 1 << 20
#: Words that a comparison advances one by one.
STEPS = 16
#: Comparisons that advance together.
LANES = 1 << 18
#: Words that are known by number at a time (bounds memory, not results).
NAMES = 1 << 20
#: Modulus and bases of the fingerprints.
PRIME, BASES = (1 << 31) - 1, (1_000_003, 754_974_721)
#: Separators are numbered from here.
SEPARATORS = 1 << 29

RESULT = "struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"


class Prefixes:
    """Fingerprints of a stream's prefixes, for comparing two of its stretches at once."""

    def __init__(self, words: np.ndarray) -> None:
        self.sums, self.powers = [], []
        for base in BASES:
            power = np.empty(len(words) + 1, np.uint32)
            power[0], known, top = 1, 1, base % PRIME
            while known < len(power):
                more = min(known, len(power) - known)
                power[known : known + more] = power[:more].astype(np.uint64) * np.uint64(top) % np.uint64(PRIME)
                top, known = top * top % PRIME, known + more
            terms = (words.astype(np.uint64) + np.uint64(1)) * power[:-1] % np.uint64(PRIME)
            sums = np.zeros(len(words) + 1, np.uint32)
            sums[1:] = np.cumsum(terms, dtype=np.uint64) % np.uint64(PRIME)
            self.sums.append(sums)
            self.powers.append(power)

    def equal(self, at: np.ndarray, n: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Whether the n words from `at` on equal those `period` words before."""
        same = np.ones(len(at), bool)
        for sums, powers in zip(self.sums, self.powers, strict=True):
            def mark(start: np.ndarray) -> np.ndarray:
                return (sums[start + n].astype(np.uint64) + np.uint64(PRIME) - sums[start]) % np.uint64(PRIME)
            same &= mark(at) == mark(at - period) * powers[period] % np.uint64(PRIME)
        return same

    def furthest(self, at: np.ndarray, period: np.ndarray, low: np.ndarray, high: np.ndarray, way: int) -> np.ndarray:
        """Words that match from `at` on (way 1) or before it (way -1): at least `low`, at most `high`."""
        low, high = low.copy(), high.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_] + 1) // 2
            same = self.equal(at[open_] - (mid if way < 0 else 0), mid, period[open_])
            low[open_] = np.where(same, mid, low[open_])
            high[open_] = np.where(same, high[open_], mid - 1)
        return low


class Catchers:
    """All catchers over one stream of texts."""

    def __init__(self, texts: list[np.ndarray]) -> None:
        lengths = np.array([len(t) for t in texts], np.int64)
        self.first = np.cumsum(lengths + 1) - lengths  # a separator stands before each text and after the last
        self.longest = int(lengths.max(initial=0))
        self.edge = 1 << max(self.longest, 1).bit_length()
        size = int(lengths.sum()) + len(texts) + 1
        size += -size % (2 * self.edge)
        self.words = np.full(size, -1, np.int32)
        self.text = np.full(size, -1, np.int32)
        for k, (at, text) in enumerate(zip(self.first.tolist(), texts, strict=True)):
            self.words[at : at + len(text)] = text
            self.text[at : at + len(text)] = k
        gaps = np.flatnonzero(self.text < 0)
        self.words[gaps] = SEPARATORS + np.arange(len(gaps), dtype=np.int32)
        self.lengths = lengths
        self.known: dict[tuple[int, int], int] = {}  # (start, end) of a run -> its period
        self.cover = np.full(size, -1, np.int32)  # a run that holds this word
        self.starts: list[int] = []
        self.periods: list[int] = []
        self.prefixes: Prefixes | None = None

    def proposals(self, before: np.ndarray, after: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, period) of all proposals at these edges, from the blocks before and the words appended after."""
        size = before.shape[1]
        lane, at = np.nonzero(after == before[:, -1:])
        word, period = [edges[lane] + at], [at + 1]
        lane, at = np.nonzero(before == after[:, :1])
        return np.concatenate([*word, edges[lane]]), np.concatenate([*period, size - at])

    def runs(self) -> dict[tuple[int, int], int]:
        size = 1
        while size < self.edge:
            pairs = self.words.reshape(-1, 2, size)
            self.follow(*self.proposals(pairs[:, 0], pairs[:, 1], np.arange(len(pairs)) * 2 * size + size))
            size *= 2
        blocks = self.words.reshape(-1, size)  # no text is longer, so these edges need no coarser level
        self.follow(*self.proposals(blocks[:-1], blocks[1:], np.arange(1, len(blocks)) * size))
        return self.known

    def follow(self, word: np.ndarray, period: np.ndarray) -> None:
        for k in range(0, len(word), LANES):
            self.advance(word[k : k + LANES], period[k : k + LANES])

    def matching(self, word: np.ndarray, period: np.ndarray, way: int) -> np.ndarray:
        """Words that match one by one, up to STEPS, from each word on or before it. A separator matches nothing."""
        n = np.zeros(len(word), np.int64)
        alive = np.arange(len(word))
        for step in range(STEPS):
            at = word[alive] + (step if way > 0 else -1 - step)
            alive = alive[self.words[at] == self.words[at - period[alive]]]
            if not alive.size:
                break
            n[alive] += 1
        return n

    def advance(self, word: np.ndarray, period: np.ndarray) -> None:
        owner = self.text[word]
        fits = (owner >= 0) & (np.maximum(LEAST_REPEATS * period, LEAST_WORDS) <= self.lengths[owner])
        fits &= word - period >= self.first[owner]
        if self.starts:
            run = self.cover[word]
            inside = (np.array(self.starts)[run] <= word - period) & (period % np.array(self.periods)[run] == 0)
            fits &= (run < 0) | ~inside
        word, period, owner = word[fits], period[fits], owner[fits]
        need = np.maximum(LEAST_REPEATS * period, LEAST_WORDS) - period
        ahead, back = self.matching(word, period, 1), self.matching(word, period, -1)
        left = (ahead == STEPS) | (back == STEPS) | (ahead + back >= need)
        if not left.any():
            return
        word, period, owner, need, ahead, back = (x[left] for x in (word, period, owner, need, ahead, back))
        if self.prefixes is None:
            self.prefixes = Prefixes(self.words)
        end = self.first[owner] + self.lengths[owner]
        ahead = self.prefixes.furthest(word, period, ahead, np.where(ahead < STEPS, ahead, end - word), 1)
        room = word - period - self.first[owner]
        back = self.prefixes.furthest(word, period, back, np.where(back < STEPS, back, room), -1)
        caught = ahead + back >= need
        found = np.unique(np.stack([word - back - period, word + ahead, period])[:, caught], axis=1)
        for start, end, p in found.T.tolist():
            for true in self.exact(start, end, p):
                self.merge(*true)

    def exact(self, start: int, end: int, period: int) -> list[tuple[int, int, int]]:
        """The run itself; if fingerprints have deceived, the runs that its text has at this period."""
        w = self.words
        if np.array_equal(w[start + period : end], w[start : end - period]):
            return [(start, end, period)]
        owner = self.text[start]
        first, last = int(self.first[owner]), int(self.first[owner] + self.lengths[owner])
        differ = np.flatnonzero(w[first + period : last] != w[first : last - period]) + first + period
        edges = np.concatenate(([first + period - 1], differ, [last]))
        long = np.flatnonzero(np.diff(edges) - 1 >= max(LEAST_REPEATS * period, LEAST_WORDS) - period)
        return [(int(edges[k]) + 1 - period, int(edges[k + 1]), period) for k in long]

    def merge(self, start: int, end: int, period: int) -> None:
        known = self.known.get((start, end))
        if known is None or period < known:
            self.known[start, end] = period
            self.cover[start:end] = len(self.starts)
            self.starts.append(start)
            self.periods.append(period)


def runs_of(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each text, by start, then period; texts are word numbers."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    by_length = sorted((k for k, t in enumerate(texts) if len(t) >= LEAST_WORDS), key=lambda k: len(texts[k]))

    def catch(group: list[int]) -> None:
        catchers = Catchers([texts[k] for k in group])
        for (start, end), period in catchers.runs().items():
            k = int(catchers.text[start])
            found[group[k]].append((start - int(catchers.first[k]), end - start, period))

    group, size = [], 0
    for k in by_length:
        if group and size + len(texts[k]) > STREAM:
            catch(group)
            group, size = [], 0
        group.append(k)
        size += len(texts[k])
    if group:
        catch(group)
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def repeats(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Mask of the words to keep: a run keeps its first period only."""
    keep = np.ones(n, bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return keep


def judged(texts: list[bytes]) -> pa.StructArray:
    names = Names()
    words = []
    for text in texts:
        if len(names) > NAMES:
            names = Names()
        words.append(numbered(text, names))
    runs = runs_of(words)
    collapsed = [joined(t, repeats(len(w), r) if r else None) for t, w, r in zip(texts, words, runs, strict=True)]
    flat = np.array([x for r in runs for x in r], np.int64).reshape(-1, 3)
    offsets = np.cumsum([0, *map(len, runs)]).astype(np.int32)
    fields = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
    return pa.StructArray.from_arrays(
        [
            pa.array([len(w) for w in words], pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets), fields),
            pa.array(collapsed, pa.binary()).cast(pa.string()),
        ],
        ["n_words", "runs", "collapsed"],
    )


def catching():
    """A column function text -> (n_words, runs, collapsed)."""

    @F.arrow_udf(RESULT)
    def catch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield judged([t or b"" for t in batch.cast(pa.binary()).to_pylist()])

    return catch.asNondeterministic()  # else each use of its result would run it again


def find_runs(docs: DataFrame, id_col: str = "doc_id", text: str | Column = "text") -> DataFrame:
    """id, n_words, runs (start, length, period; by start, then period) and the collapsed text of every row.

    The collapsed text is the words joined by one space, without those that any run holds after its first period.
    """
    words = F.col(f"`{text}`") if isinstance(text, str) else text
    return docs.select(F.col(f"`{id_col}`").alias(id_col), catching()(words).alias("found")).select(f"`{id_col}`", "found.*")


def most_repeated(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of ties the first."""
    kind = "struct<start:bigint,length:bigint,period:bigint>"
    return F.aggregate(
        runs, F.lit(None).cast(kind),
        lambda best, r: F.when(best.isNull() | (r.length * best.period > best.length * r.period), r).otherwise(best),
    )
