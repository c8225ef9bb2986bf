"""Secret scans: Aho-Corasick finds keywords, anchored patterns run only there, checksums are validated.

Kinds, in this order: `assign` (a password, token or key that is assigned a value of 6 characters or more),
`access` (AKIA keys of 20 characters or more), `hex` (runs of 24 or more hexadecimal digits), `github` and
`npm` (tokens whose last six characters are the CRC-32 of the 30 before them, in base 62). The matches of a
kind are leftmost and do not overlap; a match that is too short or fails its checksum is dropped, but the
text it covers is not searched again.

A run of hexadecimal digits holds no fixed keyword; the pattern itself is one linear scan for its digits.

All work is on UTF-8 bytes, the spans are code points. A null or empty text has no spans. Each row is
scanned by itself, whole; repeated rows give repeated results.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "github", "npm")
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"

ASSIGN = re.compile(
    rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
GITHUB = re.compile(rb"gh[pousr]_([0-9A-Za-z]+)")
NPM = re.compile(rb"npm_([0-9A-Za-z]+)")
#: Keyword, in lower case, and the kind whose pattern starts there.
KEYWORDS = {
    "password": 0, "passwd": 0, "secret": 0, "token": 0, "apikey": 0, "api_key": 0,
    "akia": 1,
    "ghp_": 3, "gho_": 3, "ghu_": 3, "ghs_": 3, "ghr_": 3,
    "npm_": 4,
}
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum(random_part: bytes) -> bytes:
    rest, out = zlib.crc32(random_part), []
    for _ in range(6):
        rest, digit = divmod(rest, 62)
        out.append(BASE62[digit])
    return bytes(reversed(out))


def signed(m: re.Match) -> bool:
    body = m[1]
    return len(body) == 36 and checksum(body[:30]) == body[30:]


#: By kind: the anchored pattern and what a match must also be.
RULES = {
    0: (ASSIGN, lambda m: len(m[1]) >= 6),
    1: (ACCESS, lambda m: len(m[0]) >= 20),
    3: (GITHUB, signed),
    4: (NPM, signed),
}


def automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        out.add_word(word, (len(word), kind))
    out.make_automaton()
    return out


def spans(text: str | None, words: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, kind, end), in that order, in code points."""
    if not text:
        return []
    data = text.encode()
    # Bytes are lower-cased in ASCII only, so positions stay the same.
    hits = sorted((end + 1 - n, kind) for end, (n, kind) in words.iter(data.lower().decode("latin-1")))
    found, past = [], [0] * len(KINDS)
    for start, kind in hits:
        if start < past[kind]:
            continue
        pattern, valid = RULES[kind]
        if m := pattern.match(data, start):
            past[kind] = m.end()
            if valid(m):
                found.append((start, kind, m.end()))
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(data)]
    if found and len(data) != len(text):
        points = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
        found = [(int(points[a]), kind, int(points[b])) for a, kind, b in found]
    return sorted(found)


def scanner():
    """A column function text -> spans."""

    @F.pandas_udf(SPANS)
    def secret_spans(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = automaton()
        for batch in texts:
            yield pd.Series(
                [[{"kind": KINDS[kind], "start": a, "end": b} for a, kind, b in spans(t, words)] for t in batch], dtype=object
            )

    return secret_spans.asNondeterministic()  # else each use of its result would run it again


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and `secrets`, the list of (kind, start, end), for every row."""
    return docs.select(F.col(f"`{id_col}`").alias(id_col), scanner()(F.col(f"`{text_col}`")).alias("secrets"))
