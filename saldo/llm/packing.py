"""Best-fit packing of token sequences, in supersteps by size.

Sizes are whole numbers up to the capacity, so range-sorting documents and gaps leaves at most `capacity`
classes of each, whatever the number of rows: a class is one interval of ranks. So the driver collects the counts
of the classes and runs all supersteps itself, in a Python loop; no sweep is distributed. A superstep takes the
largest class of documents not yet placed. Its successor sweep finds the smallest class of gaps that fits;
documents and gaps of the two classes are matched by rank, the gaps are updated, and the sweep goes on until
the class is placed, opening new sequences when no gap is left. This gives what placing single documents by
best-fit decreasing gives. The rows themselves move once: each row gets its rank within its class (no class
is ever in one task) and looks up the interval that holds it. The table of intervals grows with the capacity,
not with the rows, which bounds its broadcast.

Documents: the ids of the whole text, then the end id. A document longer than the capacity is cut so that all
its pieces but the first are full. A null text counts as empty and is one end id. Repeated rows are packed each
by itself. An empty table gives an empty result.

The ids are those of the tokenizers library with byte_bpe_50k.json. tiktoken, which is faster, computes them from
the same vocabulary's ranks; a text on which its pattern engine gives up (white space of a million characters in
a row) is encoded by tokenizers itself. A vocabulary needs both files for that.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator, Mapping
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from saldo.llm.common import rank_in_group
from saldo.session import materialize

CAPACITY = 2048
END_ID = 0
#: The special string of the vocabulary, and its id; inside a text it is one token.
SPECIAL = {"<|endoftext|>": 50256}
VOCABULARY = "byte_bpe_50k.tiktoken"

PIECES = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"


def encoder(vocabulary: str = VOCABULARY) -> tiktoken.Encoding:
    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


@cache
def tokenizer(vocabulary: str) -> Tokenizer:
    """The library's own encoder of a rank file's vocabulary."""
    return Tokenizer.from_file(public_tokenizers.path(vocabulary.removesuffix(".tiktoken") + ".json"))


def token_ids(text: str | None, encoding: tiktoken.Encoding) -> np.ndarray:
    try:
        ids = encoding.encode_to_numpy(text, allowed_special="all") if text else []
    except ValueError:  # the stack of tiktoken's pattern engine is limited
        ids = tokenizer(encoding.name).encode_batch_fast([text], add_special_tokens=False)[0].ids
    return np.append(np.asarray(ids, "<u4"), np.uint32(END_ID)).astype("<u4")


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens."""
    first = n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def piece_function(capacity: int, vocabulary: str):
    @F.pandas_udf(PIECES)
    def pieces(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = encoder(vocabulary)
        for batch in texts:
            out = []
            for text in batch:
                ids = token_ids(text, encoding)
                out.append([
                    {"piece": k, "start": at, "length": n, "ids_crc32": zlib.crc32(ids[at : at + n].tobytes())}
                    for k, (at, n) in enumerate(cut(len(ids), capacity))
                ])
            yield pd.Series(out, dtype=object)

    return pieces


def best_fit(sizes: Mapping[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Intervals (size, rank_from, rank_to, sequence_from, per_sequence, offset_from) that place every rank.

    Within an interval consecutive ranks fill a sequence with `per_sequence` rows, then the next sequence.
    """
    gaps: dict[int, deque[tuple[int, int]]] = {}
    classes: list[int] = []  # gaps in use, ascending
    out, opened = [], 0

    def leave(gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in gaps:
                gaps[gap] = deque()
                insort(classes, gap)
            gaps[gap].append((first, count))

    for size in sorted(sizes, reverse=True):
        rank, left = 0, sizes[size]
        while left:
            k = bisect_left(classes, size)
            if k < len(classes):
                gap = classes[k]
                first, count = gaps[gap].popleft()
                if not gaps[gap]:
                    del gaps[gap], classes[k]
            else:
                gap, first, count = capacity, opened, -(-left // (capacity // size))
                opened += count
            each = gap // size
            full = min(count, left // each)
            if full:
                filled, placed = full, full * each
            else:  # the last rows of the class share one sequence
                filled, placed, each = 1, left, left
            out.append((size, rank, rank + placed, first, each, capacity - gap))
            leave(gap, first + filled, count - filled)
            leave(gap - each * size, first, filled)
            rank, left = rank + placed, left - placed
    return out


def pack(
    docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    cuts = docs.select(F.col(f"`{id_col}`").alias("id"), F.explode(piece_function(capacity, vocabulary)(F.col(f"`{text_col}`"))).alias("p"))
    pieces = materialize(cuts.select("id", "p.*"), "pieces")
    sizes = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    intervals = docs.sparkSession.createDataFrame(
        best_fit(sizes, capacity),
        "length bigint, rank_from bigint, rank_to bigint, sequence_from bigint, each bigint, offset_from bigint",
    )
    ranked = rank_in_group(pieces, ["length"], ["id", "piece", "ids_crc32"])
    placed = ranked.join(
        F.broadcast(intervals.withColumnRenamed("length", "size")),
        (F.col("length") == F.col("size")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")),
    ).withColumn("at", F.col("rank") - F.col("rank_from"))
    return placed.select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32",
        (F.col("sequence_from") + F.expr("at div each")).alias("sequence_id"),
        (F.col("offset_from") + F.expr("at % each") * F.col("length")).alias("offset"),
    )
