"""Suffix dedup: removes every byte of a string of 200 bytes that also starts anywhere else.

Texts are bytes (UTF-8, a null text counts as empty); matches never cross documents; overlapping matches count,
and all are judged on the input. Texts below 200 bytes keep everything. Repeated rows are copies of each other.
An empty table gives an empty result.

Only the order of suffixes up to 200 bytes matters, and only where a suffix may have an equal. This replaces
recursive external induced sorting by one level of sampling, without a recursion or a priority queue of tuples:

1. Sample suffixes. Every window of 200 bytes names the least of its 64-byte strings by hash (leftmost of equal
   ones) as its anchor; equal windows name the same string at the same place. Each anchor owns the run of
   windows that name it. Anchors whose string occurs once in the corpus are dropped: their windows are single.
2. The sample is sorted. The suffix tuples of the remaining anchors (string, bytes to the right) are shuffled by
   string and sorted by Spark's external sorter: a partition may be far larger than memory. A task reads the sorted tuples as a stream, a few strings'
   tuples at a time, and derives the common-prefix length of neighbours.
3. All other suffixes are induced. A window that begins k bytes before its anchor equals another one if both
   have the same k bytes to the left and the same 200 - k bytes to the right. Both classes follow from
   common-prefix lengths, of the right order and of the left order; no window is compared byte by byte.
4. A string with more than `HOT` occurrences is not sorted: each of its windows becomes a row of its SHA-256
   digest, counted with map-side combining, so that no hot string has to fit in a task. Digests with more than one
   window in `SHARE` are fewer than `SHARE`: they are broadcast, and their windows stay where they are.

No row holds what grows with a text, but the text itself and the spans removed from it, which are at least 200
bytes long: anchors meet their text in pieces of `PIECE` bytes, and the windows of a piece are merged into maximal
spans before the spans of a text are gathered. A text of one repeated character is thus no special case.

Copies of whole texts are found beforehand by two hashes and the length; one of them takes part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import text_or_empty
from saldo.session import materialize, workspace

LENGTH = 200
GRAM = 64
#: Places of a gram within a window.
PLACES = LENGTH - GRAM + 1
#: Bytes hashed at a time; positions within them take the low bits of a hash.
BLOCK = 1 << 20
LOW = np.uint64((1 << 21) - 1)
#: Tuples a task holds at a time; a string's tuples are never divided, and a string has at most HOT of them.
HELD = 1 << 14
HOT = 50_000
#: Bytes of a text that meet their anchors in one row.
PIECE = 1 << 15
SHARE = 1024

BASE = 0x9E3779B97F4A7C15


def powers(x: int, n: int) -> np.ndarray:
    out = np.full(n, x, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Anchors:
    """Anchors of many texts at once."""

    def __init__(self) -> None:
        size = BLOCK + LENGTH
        self.up, self.down = powers(BASE, size), powers(pow(BASE, -1, 1 << 64), size)
        self.values = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)

    def find(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """For texts laid end to end: hash, place, first and last window of every anchor."""
        n = len(data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[:n], out=sums[1:])
        h = (sums[GRAM:] - sums[:-GRAM]) * self.down[: n - GRAM + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        ranked = (h & ~LOW) | np.arange(len(h), dtype=np.uint64)
        windows = n - LENGTH + 1
        # Least of every PLACES neighbours: minima up to and from the edges of blocks of that length.
        rows = -(-len(ranked) // PLACES)
        padded = np.full(rows * PLACES, np.iinfo(np.uint64).max, np.uint64)
        padded[: len(ranked)] = ranked
        grid = padded.reshape(rows, PLACES)
        fore = np.minimum.accumulate(grid, axis=1).ravel()
        back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(back[:windows], fore[PLACES - 1 : PLACES - 1 + windows])
        anchor = (least & LOW).astype(np.int64)
        # Windows that run over the end of their text are none.
        whole = np.ones(windows, bool)
        for end in ends[:-1].tolist():
            whole[max(0, end - LENGTH + 1) : end] = False
        new = np.ones(windows, bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | ~whole[:-1]
        first = np.flatnonzero(new & whole)
        stop = np.flatnonzero(whole & np.append(new[1:] | ~whole[1:], True))
        return h[anchor[first]], anchor[first], first, stop


def anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text and string: hash, the text's two hashes, whether the text may hold the string more than once, and each
    place with its bytes to the left and the bytes the last window leaves out, packed in one number.

    A text is told once per task. A text longer than a block is cut into blocks that share 199 bytes; as these
    cannot see each other, its strings all count as possibly repeated.
    """
    finder, seen = Anchors(), set()

    def told(parts: list[tuple[tuple[int, int], int, bytes, bool]]) -> pa.RecordBatch:
        lengths = np.array([len(p[2]) for p in parts])
        ends = np.cumsum(lengths)
        hashes, place, first, last = finder.find(np.frombuffer(b"".join(p[2] for p in parts), np.uint8), ends)
        part = np.searchsorted(ends, first, "right")
        shift = np.array([p[1] for p in parts])[part] - (ends - lengths)[part]
        packed = ((place + shift) << 16) | ((place - first) << 8) | (place - last)
        by = np.lexsort((hashes, part))
        part, hashes, packed = part[by], hashes[by], packed[by]
        heads = np.flatnonzero(np.diff(part, prepend=-1) | (np.diff(hashes, prepend=np.uint64(0)) != 0))
        offsets = np.append(heads, len(part))
        many = (np.diff(offsets) > 1) | np.array([p[3] for p in parts])[part[heads]]
        keys = np.array([p[0] for p in parts], np.int64).reshape(-1, 2)[part[heads]]
        return pa.RecordBatch.from_arrays(
            [pa.array(hashes[heads].view(np.int64)), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(many),
             pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(packed))],
            ["hash", "d", "e", "many", "ats"],
        )

    for batch in batches:
        parts: list[tuple[tuple[int, int], int, bytes, bool]] = []
        size = 0
        for d, e, text in zip(*(batch.column(c).to_pylist() for c in ("d", "e", "text")), strict=True):
            key = (d, e)
            if len(text) < LENGTH or key in seen:
                continue
            seen.add(key)
            for at in range(0, len(text) - LENGTH + 1, BLOCK - LENGTH + 1):
                part = text[at : at + BLOCK]
                if size + len(part) > BLOCK and parts:
                    yield told(parts)
                    parts, size = [], 0
                parts.append((key, at, part, len(text) > BLOCK))
                size += len(part)
        if parts:
            yield told(parts)


def matrix(values: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(v.ljust(width, b"\0") for v in values), np.uint8).reshape(len(values), width)


def common(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Common-prefix length of each row with the one before it; the first has none."""
    out = np.zeros(len(rows), np.int64)
    differ = rows[1:] != rows[:-1]
    any_ = differ.any(axis=1)
    out[1:] = np.where(any_, differ.argmax(axis=1), rows.shape[1])
    out[1:] = np.minimum(out[1:], np.minimum(lengths[1:], lengths[:-1]))
    return out


def repeated_windows(lefts: list[bytes], rights: list[bytes]) -> np.ndarray:
    """For anchors in order of their right bytes: by anchor and bytes to the left, whether that window repeats."""
    m = len(lefts)
    left_len, right_len = np.array([len(x) for x in lefts]), np.array([len(x) for x in rights])
    right_common = common(matrix(rights, LENGTH), right_len)
    left = matrix([x[::-1] for x in lefts], PLACES - 1)
    by_length = np.argsort(left_len, kind="stable")
    order = by_length[np.argsort(left[by_length].view(f"S{PLACES - 1}").ravel(), kind="stable")]
    left_common = common(left[order], left_len[order])
    out = np.zeros((m, PLACES), bool)
    left_class = np.empty(m, np.int64)
    for k in range(PLACES):
        own = np.flatnonzero((left_len >= k) & (right_len >= LENGTH - k))
        if len(own) < 2:
            continue
        left_class[order] = np.cumsum(left_common < k) if k else 0
        code = np.cumsum(right_common < LENGTH - k)[own] * np.int64(m + 1) + left_class[own]
        by = np.argsort(code, kind="stable")
        same = np.diff(code[by]) == 0
        out[own[by[1:][same]], k] = out[own[by[:-1][same]], k] = True
    return out


def repeat_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tuples sorted by string and right bytes become spans d, e, start, end of repeated windows."""

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        rows = list({(r[0], r[1], r[2]): r for r in rows}.values())  # rows repeated in the table
        repeats = repeated_windows([r[4] for r in rows], [r[5] for r in rows])
        edge = np.diff(np.pad(repeats, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        (row, near), (_, past) = np.nonzero(edge == 1), np.nonzero(edge == -1)
        place = np.array([r[2] >> 16 for r in rows], np.int64)[row]
        keys = np.array([(r[0], r[1]) for r in rows], np.int64).reshape(-1, 2)[row]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(place - past + 1), pa.array(place - near + LENGTH)],
            ["d", "e", "start", "end"],
        )

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("d", "e", "at", "gram", "left", "right")), strict=True):
            if len(held) >= HELD and row[3] != held[-1][3]:
                yield spans(held)
                held = []
            held.append(row)
    if held:
        yield spans(held)


def cutter():
    """A column function (text, starts and ends of spans by start) -> maximal spans and what remains."""

    @F.pandas_udf("spans array<struct<start:bigint,end:bigint>>, kept binary")
    def cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        out = []
        for text, first, last in zip(texts, starts, ends, strict=True):
            if text is None:
                out.append((None, None))
                continue
            last = np.maximum.accumulate(last)
            opens = np.append(True, first[1:] > last[:-1])
            first, last = first[opens].tolist(), last[np.append(opens[1:], True)].tolist()
            kept = b"".join(text[a:b] for a, b in zip([0, *last], [*first, len(text)], strict=True))
            out.append(([{"start": a, "end": b} for a, b in zip(first, last, strict=True)], kept))
        return pd.DataFrame(out, columns=["spans", "kept"])

    return cut


def text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text (bytes), n_bytes and the two hashes that stand for the text."""
    text = text_or_empty(text_col)
    return docs.select(
        F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("d"), F.xxhash64(F.lit(1), text).alias("e"),
        F.octet_length(text).cast("bigint").alias("n_bytes"), text.cast("binary").alias("text"),
    )


def text_classes(rows: DataFrame) -> DataFrame:
    """d, e, n_bytes, copies and the least id of every text."""
    rank = F.struct(F.col("id").isNull().alias("none"), "id")
    return rows.groupBy("d", "e", "n_bytes").agg(F.count(F.lit(1)).alias("copies"), F.min(rank).alias("least"))


def piece(place: Column) -> Column:
    return F.floor(place / F.lit(PIECE)).cast("int")


def mark_rows(anchors: DataFrame, known: DataFrame, hot: int) -> DataFrame:
    """d, e, piece, lead and marks: the anchors of a piece whose string occurs elsewhere, with a last bit if it is hot.

    `lead` is the id of the text's row that takes part.
    """
    # Counted with map-side combining, then joined, where adaptive execution splits a hot string.
    # One number stands for a text among those that hold a string, another one for each string.
    text = F.xxhash64("hash", "d", "e")
    found = anchors.groupBy("hash").agg(
        F.min(text).alias("low"), F.max(text).alias("high"), F.max("many").alias("many"), F.sum(F.size("ats")).alias("n")
    ).filter("low != high OR many")
    places = anchors.join(found.select("hash", (F.col("n") > hot).cast("int").alias("hot")), "hash").select(
        "d", "e", "hot", F.explode("ats").alias("at"))
    marks = places.groupBy("d", "e", piece(F.shiftright("at", 16)).alias("piece")).agg(
        F.collect_set(F.shiftleft("at", 1).bitwiseOR(F.col("hot"))).alias("marks"))
    return marks.join(known.select("d", "e", F.col("least.id").alias("lead")), ["d", "e"])


def piece_rows(rows: DataFrame) -> DataFrame:
    """d, e, id, piece, base and text: the bytes from `base` on that windows anchored in the piece may cover."""
    long = rows.filter(F.col("n_bytes") >= LENGTH)
    cut = long.withColumn("piece", F.explode(F.sequence(F.lit(0), piece(F.col("n_bytes") - 1))))
    cut = cut.withColumn("base", F.greatest(F.lit(0), F.col("piece") * F.lit(PIECE) - (PLACES - 1)))
    return cut.select("d", "e", "id", "piece", "base", substring("base", f"{PIECE + PLACES - 1 + LENGTH}").alias("text"))


def substring(start: str, length: str):
    return F.expr(f"substring(text, cast({start} as int) + 1, cast({length} as int))")


def span_rows(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """d, e, piece, start, end of repeated windows, of one copy of each text."""
    marked = piece_rows(rows).join(marks, ["d", "e", "piece"]).filter(F.col("id").eqNullSafe(F.col("lead")))
    marked = marked.select("d", "e", "piece", "base", "text", F.explode("marks").alias("m")).select(
        "d", "e", "piece", "base", "text",
        (F.col("m") % 2 == 1).alias("hot"),
        F.shiftright("m", 1).alias("at"),
        F.shiftright("m", 17).alias("place"),
        F.shiftright("m", 9).bitwiseAND(F.lit(255)).alias("before"),
        F.shiftright("m", 1).bitwiseAND(F.lit(255)).alias("beyond"),
    )
    tuples = marked.filter("not hot").select(
        "d", "e", "at",
        F.xxhash64(substring("place - base", str(GRAM))).alias("gram"),
        substring("place - base - before", "before").alias("left"),
        substring("place - base", f"{LENGTH} - beyond").alias("right"),
    )
    out = tuples.repartition("gram").sortWithinPartitions("gram", "right").mapInArrow(
        repeat_rows, "d bigint, e bigint, start bigint, end bigint"
    ).select("d", "e", piece(F.col("start")).alias("piece"), "start", "end")
    if not marks.filter(F.exists("marks", lambda m: m % 2 == 1)).isEmpty():
        windows = marked.filter("hot").select("d", "e", "base", "text", F.explode(F.expr("sequence(place - before, place - beyond)")).alias("start"))
        windows = windows.select("d", "e", "start", digest(substring("start - base", str(LENGTH))).alias("digest"))
        out = out.unionByName(repeated_digests(windows).select(
            "d", "e", piece(F.col("start")).alias("piece"), "start", (F.col("start") + LENGTH).alias("end")))
    return out


def digest(value: Column) -> Column:
    """The first 16 bytes of the SHA-256."""
    return F.unhex(F.substring(F.sha2(value, 256), 1, 32))


def repeated_digests(windows: DataFrame) -> DataFrame:
    """The windows whose digest another window has. Rows repeated in the table are one window.

    One job with its caller's: the texts that the windows are cut from are shuffled once for all uses.
    """
    where = F.xxhash64("d", "e", "start", "digest")
    edges = windows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(where).alias("low"), F.max(where).alias("high"))
    twice = edges.filter("low != high").select("digest", "n")
    twice = twice.join(F.broadcast(twice.agg(F.sum("n").alias("total"))))  # one row
    # Less than SHARE digests have more than that share of all windows: their windows are known without a shuffle.
    frequent = F.col("n") * SHARE > F.col("total")
    few = F.broadcast(twice.filter(frequent).select("digest"))
    rare = windows.join(few, "digest", "left_anti").join(twice.filter(~frequent).select("digest"), "digest", "left_semi")
    return windows.join(few, "digest", "left_semi").unionByName(rare)


SPANS = "array<struct<start:bigint,end:bigint>>"


def merged_span(done: Column, code: Column) -> Column:
    """Disjoint spans in order, latest first, with one that starts no earlier than the latest."""
    start = F.shiftright(code, 9)
    end = start + code.bitwiseAND(F.lit(511))
    latest = F.get(done, F.lit(0))
    span = lambda a, b: F.array(F.struct(a.alias("start"), b.alias("end")))
    # Within one span, the usual case, nothing but the latest is built anew.
    return (
        F.when(end <= latest["end"], done)
        .when(start <= latest["end"], F.concat(span(latest["start"], end), F.slice(done, 2, F.size(done))))
        .otherwise(F.concat(span(start, end), done)))


def maximal(spans: DataFrame) -> DataFrame:
    """d, e and, in order, starts and ends of each text's spans, touching ones of a piece merged.

    A window's piece bounds the rows that are ordered together; a text then has at most two spans for 200 bytes.
    """
    # Start and length in one number. A piece has a bounded number of them, whatever the size of a text or a group.
    code = F.shiftleft("start", 9).bitwiseOR(F.col("end") - F.col("start"))
    pieces = spans.groupBy("d", "e", "piece").agg(F.collect_set(code).alias("codes"))
    islands = pieces.select("d", "e", F.aggregate(F.sort_array("codes"), F.array().cast(SPANS), merged_span).alias("spans"))
    lists = islands.groupBy("d", "e").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))
    return lists.select("d", "e", F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """id, n_bytes, spans (removed, maximal) and kept (remaining bytes) of every row."""
    rows = text_rows(docs, id_col, text_col)
    known = materialize(text_classes(rows), "classes")
    with workspace(docs.sparkSession, "suffixes") as keep:
        found = rows.select("d", "e", "text").mapInArrow(
            anchor_rows, "hash bigint, d bigint, e bigint, many boolean, ats array<bigint>")
        marks = materialize(mark_rows(keep("anchors", found), known, hot), "marks")
    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    spans = known.select(
        "d", "e", F.when(copied, F.array(F.lit(0).cast("bigint"))).alias("from"), F.when(copied, F.array("n_bytes")).alias("to")
    ).join(maximal(span_rows(rows, marks)), ["d", "e"], "left")
    spans = spans.select("d", "e", F.coalesce("from", "starts").alias("starts"), F.coalesce("to", "ends").alias("ends"))
    spans = materialize(spans.filter("starts IS NOT NULL"), "spans")
    found = rows.join(spans, ["d", "e"], "left")
    changed = F.col("starts").isNotNull()
    found = found.select(
        "id", "n_bytes", F.when(~changed, F.col("text")).alias("text"),
        cutter()(F.when(changed, F.col("text")), F.col("starts"), F.col("ends")).alias("cut"),
    )
    none = F.array().cast(SPANS)
    return found.select(
        F.col("id").alias(id_col), "n_bytes",
        F.when(F.col("text").isNull(), F.col("cut.spans")).otherwise(none).alias("spans"),
        F.coalesce("text", "cut.kept").alias("kept"),
    )
