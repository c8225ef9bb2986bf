"""Words of UTF-8 texts, a window of a long text at a time, so that no text has to exist as one list of words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

#: Bytes of a text that are split into words at once.
WINDOW = 1 << 22
#: The white characters bytes.split() splits at: [\x20\x09-\x0D].
WHITE = re.compile(rb"[\x20\x09-\x0D]")


def windows(data: bytes, size: int | None = None) -> Iterator[bytes]:
    """The text in pieces of at least `size` bytes that end before a white character; the last may be shorter."""
    size = size or WINDOW
    at = 0
    while len(data) - at > size and (cut := WHITE.search(data, at + size)):
        yield data[at : cut.start()]
        at = cut.start()
    yield data[at:] if at else data


class Names(dict):
    """Numbers words in the order they are first seen."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def numbered(data: bytes, names: Names) -> np.ndarray:
    """The numbers of a text's words."""
    parts = []
    for piece in windows(data):
        words = piece.split()
        parts.append(np.fromiter(map(names.__getitem__, words), np.int32, len(words)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def joined(data: bytes, keep: np.ndarray | None = None) -> bytes:
    """The words, or those of them that a mask keeps, joined by one space."""
    parts, at = [], 0
    for piece in windows(data):
        words = piece.split()
        if keep is not None:
            words, at = [words[i] for i in np.flatnonzero(keep[at : at + len(words)])], at + len(words)
        if words:
            parts.append(b" ".join(words))
    return b" ".join(parts)
