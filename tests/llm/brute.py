"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import xxhash
from tokenizers import Tokenizer

WHITE = "[\x20\x09-\x0d]+"


def words(text: str) -> list[str]:
    return [w for w in re.split(WHITE, text) if w]


def normalised_sha(text: str | None) -> str:
    return hashlib.sha256(re.sub(WHITE, " ", text or "").encode()).hexdigest()


def simhash(text: str | None) -> int:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = words(lowered)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def linked(values: list[int], bits: int = 4) -> dict[int, int]:
    """Least reachable value, by value."""
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(v: int) -> int:
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def shingles(text: str | None) -> set[tuple[str, ...]]:
    w = words(text or "")
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def tokenizer() -> Tokenizer:
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def token_ids(texts: list[str | None]) -> list[list[int]]:
    return [e.ids for e in tokenizer().encode_batch([t or "" for t in texts], add_special_tokens=False)]


def repeated_bytes(texts: list[str | None], length: int = 200) -> list[list[bool]]:
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        covered = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                covered[i : i + length] = [True] * length
        out.append(covered)
    return out


def runs(flags: list[bool]) -> list[tuple[int, int]]:
    out, start = [], None
    for i, f in enumerate([*flags, False]):
        if f and start is None:
            start = i
        elif not f and start is not None:
            out.append((start, i))
            start = None
    return out


def least_capacity(sizes: list[int], shards: int) -> int:
    def needed(capacity: int) -> int:
        count, room = 1, capacity
        for s in sizes:
            if s > room:
                count, room = count + 1, capacity
            room -= s
        return count

    low, high = max(sizes), sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if needed(mid) <= shards else (mid + 1, high)
    return low


def shared(budget: float, room: dict, weight: dict) -> dict:
    """Water-filling by repeated rounds: full children leave, the others share the rest."""
    given = {k: 0.0 for k in room}
    open_, left = {k for k in room if weight[k] > 0}, budget
    while open_ and left > 1e-9:
        total = sum(weight[k] for k in open_)
        full = {k for k in open_ if room[k] <= left * weight[k] / total + 1e-9}
        if not full:
            for k in open_:
                given[k] = left * weight[k] / total
            break
        for k in full:
            given[k] = float(room[k])
            left -= room[k]
        open_ -= full
    return given


def mixed(rows: list[tuple], weights: dict, share: float, epochs: int, seed: str) -> tuple[dict, dict]:
    """rows: (id, path, tokens). Leaf budgets by path, copies by id."""
    supply = defaultdict(int)
    for _, path, tokens in rows:
        supply[path] += tokens
    budgets = {(): float(int(sum(supply.values()) * share))}
    names = list(weights)
    for depth, name in enumerate(names, 1):
        below = {}
        for parent, budget in budgets.items():
            room = defaultdict(int)
            for path, tokens in supply.items():
                if path[: depth - 1] == parent:
                    room[path[:depth]] += tokens * epochs
            below |= shared(budget, room, {k: weights[name].get(k[-1], 1.0) for k in room})
        budgets = below
    budgets = {k: int(v + 1e-6) for k, v in budgets.items()}
    copies = {}
    for path, budget in budgets.items():
        whole, rest = divmod(budget, supply[path]) if supply[path] else (0, 0)
        own = sorted((hashlib.md5(f"{seed}:{whole}:{i}".encode()).hexdigest(), i, t) for i, p, t in rows if p == path)
        total = 0
        for _, i, t in own:
            total += t
            copies[i] = whole + (rest > 0 and total <= rest)
    return budgets, copies


def best_fit(sizes: list[int], capacity: int) -> int:
    gaps: list[int] = []
    for s in sorted(sizes, reverse=True):
        fits = [g for g in gaps if g >= s]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - s)
        else:
            gaps.append(capacity - s)
    return len(gaps)


PATTERNS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
    "github": re.compile("gh[pousr]_([0-9A-Za-z]+)"),
    "npm": re.compile("npm_([0-9A-Za-z]+)"),
}


def base62(n: int) -> str:
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    return "".join(digits[n // 62**k % 62] for k in range(5, -1, -1))


def signed(body: str) -> bool:
    return len(body) == 36 and base62(zlib.crc32(body[:30].encode())) == body[30:]


VALID = {
    "assign": lambda m: len(m[2]) >= 6,
    "access": lambda m: len(m[0]) >= 20,
    "hex": lambda m: len(m[0]) >= 24,
    "github": lambda m: signed(m[1]),
    "npm": lambda m: signed(m[1]),
}


def secrets(text: str | None) -> list[tuple[str, int, int]]:
    found = [(m.start(), k, name, m.end()) for k, (name, p) in enumerate(PATTERNS.items()) for m in p.finditer(text or "") if VALID[name](m)]
    return [(name, a, b) for a, _, name, b in sorted(found)]
