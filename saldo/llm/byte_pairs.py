"""Byte-level BPE, encoding and decoding, by a segment tree over byte positions.

A text is cut by the splitting pattern; each match is encoded by itself. A match that is a token is that token.
Else every byte position that begins a token holds, as a leaf, the rank of the pair of this token and its live right
neighbour, together with the position; inner nodes hold the least of their children, so the root names the leftmost
pair of minimum rank. A merge takes the root, joins the pair and updates three leaves: that of the joined token, that of
the neighbour on its left, and that of the token that ended. Each update walks to the root, so a word of n bytes takes
O(n log n) steps. Words of up to `SHORT` bytes, nearly all there are, are merged side by side: their trees are the rows of
one matrix, and a step takes every row's root, joins every row's pair and updates its three leaves. Longer words
have a tree each. Words are kept once encoded, `LEXICON` at a time (this bounds memory, not results).

A null text counts as empty and has no ids. Each row is encoded by itself, whole: repeated rows give repeated
results, null ids of rows are kept, an empty table gives an empty result. A text takes some 60 bytes of memory per byte of its
longest match and some 8 bytes per token.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Words that are kept, and up to how many bytes words are kept and merged side by side.
LEXICON, SHORT = 1 << 19, 32
#: Words whose trees are rows of one matrix.
LANES = 1 << 13
#: Characters of texts that are encoded together.
BLOCK = 1 << 20
#: Matches of a longer text that are encoded together.
MATCHES = 1 << 17
#: Bytes of a word up to which its tree is a list; beyond, an array, which is slower and a fifth of the size.
ROW = 1 << 12
#: Positions take the low bits of a leaf, ranks the high ones.
PLACE = 32
MASK = (1 << PLACE) - 1
NONE = 1 << 62


class RankTree:
    """Least leaf of a row of leaves, with updates of single leaves. A leaf is rank and place, so ties go to the left."""

    def __init__(self, leaves: list[int] | array) -> None:
        self.width = width = 1 << max(len(leaves) - 1, 0).bit_length()
        blank = array("q", [NONE]) if isinstance(leaves, array) else [NONE]
        self.nodes = nodes = blank * width + leaves + blank * (width - len(leaves))
        for k in range(width - 1, 0, -1):
            a, b = nodes[2 * k], nodes[2 * k + 1]
            nodes[k] = a if a < b else b

    def update(self, place: int, leaf: int) -> None:
        nodes, k = self.nodes, self.width + place
        nodes[k] = leaf
        while k > 1:
            other = nodes[k ^ 1]
            low = leaf if leaf < other else other
            k >>= 1
            if nodes[k] == low:
                return  # nothing changes further up
            nodes[k] = leaf = low


class Pairs:
    """Ranks of pairs of neighbouring tokens, by their ids: a token's rank is its id."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.size = max(ranks.values()) + 1
        splits = (
            (left * self.size + right, rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if (left := ranks.get(token[:k])) is not None and (right := ranks.get(token[k:])) is not None
        )
        table = np.array(sorted(splits), np.int64).reshape(-1, 2)
        self.keys, self.ranks = np.ascontiguousarray(table[:, 0]), table[:, 1].copy()

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """-1 where the two do not make a token."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)


class Trees:
    """The rank trees of many words of up to `width` bytes, one to a row."""

    def __init__(self, words: list[bytes], width: int, bytes_: np.ndarray, pairs: Pairs) -> None:
        self.width, self.pairs = width, pairs
        self.n = np.fromiter(map(len, words), np.int64, len(words))
        laid = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        place = np.arange(width)
        self.live = place < self.n[:, None]
        self.ids = bytes_[laid]
        self.after = np.tile(place + 1, (len(words), 1))
        self.before = np.tile(place - 1, (len(words), 1))
        self.none = pairs.size * width
        self.nodes = np.full((len(words), 2 * width), self.none, np.int64)
        rank = pairs.rank(self.ids[:, :-1], self.ids[:, 1:])
        self.nodes[:, width:-1] = np.where((rank >= 0) & self.live[:, 1:], rank * width + place[:-1], self.none)
        for k in range(width - 1, 0, -1):
            np.minimum(self.nodes[:, 2 * k], self.nodes[:, 2 * k + 1], out=self.nodes[:, k])

    def update(self, row: np.ndarray, place: np.ndarray, rank: np.ndarray | int) -> None:
        k = place + self.width
        self.nodes[row, k] = np.where(rank >= 0, rank * self.width + place, self.none)
        while k.size and k[0] > 1:
            k = k >> 1
            self.nodes[row, k] = np.minimum(self.nodes[row, 2 * k], self.nodes[row, 2 * k + 1])

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        """All tokens of all words, and how many each word has."""
        row = np.arange(len(self.n))
        while (row := row[self.nodes[row, 1] != self.none]).size:
            rank, place = np.divmod(self.nodes[row, 1], self.width)
            gone = self.after[row, place]
            end = self.after[row, gone]
            self.ids[row, place], self.after[row, place], self.live[row, gone] = rank, end, False
            self.update(row, gone, -1)
            more = end < self.n[row]
            right = np.where(more, end, 0)
            self.before[row[more], end[more]] = place[more]
            self.update(row, place, np.where(more, self.pairs.rank(rank, self.ids[row, right]), -1))
            left = self.before[row, place]
            on = left >= 0
            self.update(row[on], left[on], self.pairs.rank(self.ids[row[on], left[on]], rank[on]))
        return self.ids[self.live], self.live.sum(axis=1)


class Encoder(dict):
    """Ids of words: a mapping from a word to its token ids, which are computed when first asked for."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        super().__init__()
        self.ranks = ranks
        self.pairs = Pairs(ranks)
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)])
        self.numbers = list(range(self.pairs.size))  # one object for each id
        self.pattern = regex.compile(public_tokenizers.PATTERN)

    def __missing__(self, word: str) -> list[int]:
        data = word.encode()
        whole = self.ranks.get(data)
        return self.merged(data) if whole is None else [whole]

    def learn(self, words: set[str]) -> None:
        """Encodes the words that are not known, side by side."""
        if len(self) > LEXICON:
            self.clear()
        fresh: dict[int, list[tuple[str, bytes]]] = {}
        for word in words.difference(self):
            data = word.encode()
            if (rank := self.ranks.get(data)) is not None:
                self[word] = (rank,)
            elif len(data) <= SHORT:
                fresh.setdefault(1 << (len(data) - 1).bit_length(), []).append((word, data))
        for width, some in fresh.items():
            for k in range(0, len(some), LANES):
                lanes = some[k : k + LANES]
                ids, n = Trees([data for _, data in lanes], width, self.bytes, self.pairs).merge()
                shared = list(map(self.numbers.__getitem__, ids.tolist()))
                ends = np.cumsum(n).tolist()
                for (word, _), a, b in zip(lanes, [0, *ends], ends):
                    self[word] = tuple(shared[a:b])

    def merged(self, word: bytes) -> list[int]:
        n, rank_of = len(word), self.ranks.get
        # A token begins at each live position; `after` is where the next one begins, `before` the one on the left.
        row = list if n <= ROW else lambda values: array("q", values)
        after, before = row(range(1, n + 1)), row(range(-1, n - 1))
        pairs = map(rank_of, (word[k : k + 2] for k in range(n - 1)))
        tree = RankTree(row(NONE if r is None else r << PLACE | k for k, r in enumerate(pairs)))
        nodes, update = tree.nodes, tree.update
        while (least := nodes[1]) != NONE:
            place = least & MASK
            gone = after[place]
            after[place] = end = after[gone]
            rank = None
            if end < n:
                update(gone, NONE)
                before[end] = place
                rank = rank_of(word[place : after[end]])
            update(place, NONE if rank is None else rank << PLACE | place)
            if (left := before[place]) >= 0:
                rank = rank_of(word[left:end])
                update(left, NONE if rank is None else rank << PLACE | left)
        ids, place = [], 0
        while place < n:
            ids.append(self.ranks[word[place : after[place]]])
            place = after[place]
        return ids

    def encode(self, texts: list[str]) -> Iterator[array]:
        """The ids of each text. Texts are taken some at a time, a long one by itself."""
        block: list[list[str]] = []
        size = 0

        def flush() -> Iterator[array]:
            self.learn(set().union(*block))
            for matches in block:
                yield array("i", chain.from_iterable(map(self.__getitem__, matches)))
            block.clear()

        for text in texts:
            if block and size + len(text) > BLOCK:
                yield from flush()
                size = 0
            if len(text) > BLOCK:
                yield self.long(text)
                continue
            block.append(self.pattern.findall(text))
            size += len(text)
        yield from flush()

    def long(self, text: str) -> array:
        """The ids of a long text, some of its matches at a time."""
        ids, matches = array("i"), (m[0] for m in self.pattern.finditer(text))
        while some := list(islice(matches, MATCHES)):
            self.learn(set(some))
            ids.extend(array("i", chain.from_iterable(map(self.__getitem__, some))))
        return ids


@cache
def encoder_of(vocabulary: str) -> Encoder:
    """The encoder of this Python worker, which keeps its words from one task to the next."""
    return Encoder(read_ranks(vocabulary))


@cache
def read_ranks(vocabulary: str) -> dict[bytes, int]:
    """Rank of every token, from a file of base64 tokens and ranks."""
    with open(public_tokenizers.path(vocabulary), "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file) if token}


@cache
def read_tokens(vocabulary: str) -> dict[int, bytes]:
    """Token of every rank."""
    return {rank: token for token, rank in read_ranks(vocabulary).items()}


def encoded(texts: pa.Array, encoder: Encoder) -> pa.ListArray:
    ids, ends = array("i"), [0]
    for found in encoder.encode([text.as_py() or "" for text in texts]):
        ids.extend(found)
        ends.append(len(ids))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(ids, np.int32)))


def decoded(rows: pa.ListArray, tokens: dict[int, bytes]) -> pa.Array:
    lists = (row.values.to_numpy().tolist() if row.is_valid else () for row in rows)
    return pa.array([b"".join(map(tokens.__getitem__, ids)) for ids in lists], pa.binary())


def encoding(vocabulary: str = VOCABULARY):
    """A column function text -> ids."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield encoded(batch, encoder_of(vocabulary))

    return encode.asNondeterministic()  # else each use of its result would run it again


def decoding(vocabulary: str = VOCABULARY):
    """A column function ids -> bytes. Null ids are no bytes; an id that the vocabulary lacks is an error."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield decoded(batch, read_tokens(vocabulary))

    return decode.asNondeterministic()


def both_ways(vocabulary: str = VOCABULARY):
    """A column function text -> (ids, decoded): what the two others give, in one Python worker."""

    @F.arrow_udf("struct<ids:array<int>,decoded:binary>")
    def there_and_back(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            ids = encoded(batch, encoder_of(vocabulary))
            yield pa.StructArray.from_arrays([ids, decoded(ids, read_tokens(vocabulary))], ["ids", "decoded"])

    return there_and_back.asNondeterministic()


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """id and `ids`, the token ids of every row's text."""
    return docs.select(F.col(f"`{id_col}`").alias(id_col), encoding(vocabulary)(F.col(f"`{text_col}`")).alias("ids"))


def decode(ids: Column, vocabulary: str = VOCABULARY) -> Column:
    """The bytes that the ids stand for."""
    return decoding(vocabulary)(ids)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """id, `ids` and `decoded`, the bytes that these ids stand for."""
    found = both_ways(vocabulary)(F.col(f"`{text_col}`")).alias("found")
    return docs.select(F.col(f"`{id_col}`").alias(id_col), found).select(f"`{id_col}`", "found.*")
