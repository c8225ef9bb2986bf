"""Token counts by a compiled finite-state splitter and a memo of words.

Two steps, composed:

* The splitter reads character classes and marks where words begin, one or two characters late where the
  split depends on what follows (`transitions`). It is a deterministic transducer of 12 states.
* The lexicon is a table from whole words to the number of tokens they become. The model of the tokenizers
  library merges a word when it is first seen; the number is kept for the following texts (of about
  `LEXICON` words at a time; this bounds memory, not results).

The texts of a batch are laid end to end, an end symbol after each, and cut into chunks of equal length. For
every chunk the splitter's state map (start state to end state) is computed for all chunks side by side; the
maps are composed by a parallel prefix scan, which gives each chunk its true start state, from which the
marks follow, again for all chunks side by side. A very long text is thus many chunks, not one long loop.

A special string inside a text is one token and ends the text before it. A null text counts as empty and has
no tokens. Each row is counted by itself; repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

VOCABULARY = "byte_bpe_50k.json"
CHUNK = 1024
#: Characters whose chunks are run side by side.
BATCH_CHARS = 1 << 21
LEXICON = 1 << 20

# Character classes.
BLANK, WHITE, LETTER, SINGLE, PAIR_E, PAIR_L, E, NUMBER, QUOTE, OTHER, END = range(11)
# States: text start; in a run of letters, numbers, others; after one blank, one other white character, two or
# more white characters ending in a blank or in another; after a quote that may begin a contraction; after
# quote and r or v; after quote and l; after a whole contraction.
START, LETTERS, NUMBERS, OTHERS, ONE_BLANK, ONE_WHITE, BLANKS, WHITES, QUOTED, WANT_E, WANT_L, WHOLE = range(12)
STATES = 12
#: Marks: a word begins at this character; at the one before it.
HERE, BEFORE = 1, 2


def transitions() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks, by state and class."""
    letters = (LETTER, SINGLE, PAIR_E, PAIR_L, E)
    run = {**dict.fromkeys(letters, LETTERS), NUMBER: NUMBERS, QUOTE: OTHERS, OTHER: OTHERS}
    fresh = {**run, QUOTE: QUOTED, BLANK: ONE_BLANK, WHITE: ONE_WHITE}
    white = {BLANK: BLANKS, WHITE: WHITES}
    to, marks = np.zeros((STATES, 11), np.uint8), np.zeros((STATES, 11), np.uint8)

    def rule(state: int, next_by_class: dict[int, int], mark: int) -> None:
        for c, s in next_by_class.items():
            to[state, c], marks[state, c] = s, mark

    for state in (START, LETTERS, NUMBERS, OTHERS, ONE_WHITE, WHITES, QUOTED, WHOLE):
        rule(state, fresh, HERE)
    rule(LETTERS, dict.fromkeys(letters, LETTERS), 0)
    rule(NUMBERS, {NUMBER: NUMBERS}, 0)
    rule(OTHERS, {QUOTE: OTHERS, OTHER: OTHERS}, 0)
    rule(ONE_BLANK, run | white, 0)  # a blank joins the word behind it
    rule(ONE_WHITE, white, 0)
    rule(BLANKS, run, BEFORE)  # the last blank leaves its run and joins the word
    rule(WHITES, fresh, HERE | BEFORE)
    for state in (BLANKS, WHITES):
        rule(state, white, 0)
    rule(QUOTED, {QUOTE: OTHERS, OTHER: OTHERS, SINGLE: WHOLE, PAIR_E: WANT_E, PAIR_L: WANT_L}, 0)
    for state, wanted in ((WANT_E, E), (WANT_L, PAIR_L)):
        rule(state, fresh, HERE | BEFORE)  # not a contraction: the letter before begins a word
        rule(state, dict.fromkeys(letters, LETTERS), BEFORE)
        rule(state, {wanted: WHOLE}, 0)
        marks[state, END] = BEFORE
    to[:, END] = START
    return to, marks


def character_classes() -> np.ndarray:
    """Class of every code point; one more entry for the end symbol."""
    out = np.full(0x110001, OTHER, np.uint8)
    everything = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
    for pattern, cls in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", WHITE)):
        for m in regex.finditer(pattern, everything):
            out[ord(m[0][0]) : ord(m[0][-1]) + 1] = cls
    for chars, cls in ((" ", BLANK), ("stmd", SINGLE), ("rv", PAIR_E), ("l", PAIR_L), ("e", E), ("'", QUOTE)):
        out[[ord(c) for c in chars]] = cls
    out[0x110000] = END
    return out


def compose(maps: np.ndarray) -> np.ndarray:
    """State before each chunk, from all chunks' state maps, by doubling: maps[i] becomes that of chunks 0..i."""
    step = 1
    while step < len(maps):
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].copy(), axis=1)
        step *= 2
    return np.concatenate(([START], maps[:-1, START])).astype(np.uint8)


class Splitter:
    def __init__(self) -> None:
        to, marks = transitions()
        self.classes = character_classes()
        self.to, self.marks = to.ravel(), marks.ravel()

    def starts(self, symbols: np.ndarray) -> np.ndarray:
        """Where words begin in a sequence of character classes."""
        chunks = -(-len(symbols) // CHUNK)
        grid = np.full(chunks * CHUNK, END, np.uint8)
        grid[: len(symbols)] = symbols
        columns = np.ascontiguousarray(grid.reshape(chunks, CHUNK).T).astype(np.intp)
        maps = np.tile(np.arange(STATES, dtype=np.uint8), (chunks, 1))
        for column in columns:
            maps = self.to[maps * np.intp(11) + column[:, None]]
        state = compose(maps)
        seen = np.empty((CHUNK, chunks), np.uint8)
        for k, column in enumerate(columns):
            at = state * np.intp(11) + column
            seen[k], state = self.marks[at], self.to[at]
        flat = seen.T.ravel()[: len(symbols)]
        begins = (flat & HERE) > 0
        begins[:-1] |= (flat[1:] & BEFORE) > 0
        return np.flatnonzero(begins)


def byte_letters() -> dict[int, str]:
    """The printable stand-ins of byte-level vocabularies: printable bytes stand for themselves, others follow from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class Lexicon(dict):
    """Tokens of a word; tokenizers' model merges a missing word when it is first seen."""

    def __init__(self, vocabulary: str) -> None:
        tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.merge = tokenizer.model.tokenize
        self.letters = byte_letters()
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self.merge(word.encode().decode("latin-1").translate(self.letters)))
        return n


class Counter:
    def __init__(self, vocabulary: str = VOCABULARY) -> None:
        self.splitter, self.lexicon = Splitter(), Lexicon(vocabulary)
        self.special = regex.compile("|".join(map(regex.escape, self.lexicon.special))) if self.lexicon.special else None

    def counts(self, texts: list[str | None]) -> list[int]:
        totals = [0] * len(texts)
        parts: list[str] = []
        owners: list[int] = []
        size = 0
        for k, text in enumerate(texts):
            pieces = [text] if text else []
            if text and self.special and self.special.search(text):
                pieces = self.special.split(text)
                totals[k] += len(pieces) - 1
            for piece in filter(None, pieces):
                parts.append(piece)
                owners.append(k)
                size += len(piece)
                if size >= BATCH_CHARS:
                    self.add(parts, owners, totals)
                    parts, owners, size = [], [], 0
        if parts:
            self.add(parts, owners, totals)
        return totals

    def add(self, parts: list[str], owners: list[int], totals: list[int]) -> None:
        if len(self.lexicon) > LEXICON:
            self.lexicon.clear()
        joined = "".join(parts)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(lengths)
        symbols = self.splitter.classes[np.insert(codes, ends, 0x110000)]
        starts = self.splitter.starts(symbols)
        # Positions without the end symbols, of which one follows each part.
        part = np.searchsorted(ends + np.arange(1, len(ends) + 1), starts, "right")
        at = (starts - part).tolist()
        words = [joined[a:b] for a, b in zip(at, at[1:] + [len(joined)], strict=True)]
        emitted = np.fromiter(map(self.lexicon.__getitem__, words), np.int64, len(words))
        sums = np.bincount(part, emitted, len(parts)).astype(np.int64).tolist()
        for owner, n in zip(owners, sums, strict=True):
            totals[owner] += n


def counting(vocabulary: str):
    @F.pandas_udf("bigint")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(vocabulary)
        for batch in texts:
            yield pd.Series(counter.counts(batch.tolist()), dtype="int64")

    return count


def count_tokens(
    docs: DataFrame, limit: int = 512, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY
) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit for every row."""
    text = F.col(f"`{text_col}`")
    return docs.select(
        F.col(f"`{id_col}`").alias(id_col),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
        counting(vocabulary)(text).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
