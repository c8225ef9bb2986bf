"""Runs, byte pairs and ranked search against plain Python and the library, over nulls, long texts, ties and repeats."""

import hashlib
import math
import random
import re
import zlib
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from saldo.llm import byte_pairs, periodic_runs, queries, ranked_search, words
from .conftest import prose
from .test_operators import LONG, ROWS


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def in_order(rows):
    return sorted(rows, key=repr)


# --- 11 periodic runs -------------------------------------------------------------------------------

def plain_runs(w):
    """(start, length, period) of every run, by comparing the words with themselves at each distance."""
    n, best = len(w), {}
    for p in range(1, n // 3 + 1):
        i = p
        while i < n:
            j = i
            while j < n and w[j] == w[j - p]:
                j += 1
            if j - i + p >= max(24, 3 * p):
                best.setdefault((i - p, j), p)
            i = max(j, i + 1)
    return sorted(((s, e - s, p) for (s, e), p in best.items()), key=lambda r: (r[0], r[2]))


def sequences(seed):
    r = random.Random(seed)
    for _ in range(150):
        n, k = r.randrange(250), r.choice([1, 2, 3, 40])
        w = [r.randrange(k) for _ in range(n)]
        for _ in range(r.randrange(3) if n > 30 else 0):
            a = r.randrange(n)
            p, end = 1 + r.randrange(max(1, (n - a) // 3)), r.randrange(a, n + 1)
            for i in range(a, end):
                w[i] = w[a + (i - a) % p]
        yield np.array(w, np.int32)


@pytest.mark.parametrize("change", [{}, {"STREAM": 300}, {"LANES": 7}, {"STEPS": 1}, {"BASES": (1, 1)}])
def test_runs_of_sequences(monkeypatch, change):
    # Bases of 1 make fingerprints of equal multisets collide: only the comparison word by word is left.
    for name, value in change.items():
        monkeypatch.setattr(periodic_runs, name, value)
    texts = list(sequences(3))
    want = [plain_runs(t.tolist()) for t in texts]
    assert periodic_runs.runs_of(texts) == want and sum(map(len, want)) > 50


@pytest.mark.parametrize("unit, n", [(1, 300_000), (7, 100_001), (1000, 50_000)])
def test_runs_of_long_repetitions(unit, n):
    w = np.tile(np.arange(unit, dtype=np.int32), n // unit + 1)[:n]
    assert periodic_runs.runs_of([w, w[:10]]) == [[(0, n, unit)], []]
    gap = np.concatenate([w, [unit], w]).astype(np.int32)
    assert periodic_runs.runs_of([gap]) == [[(0, n, unit), (n + 1, n, unit)]]


def planted(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def runs_row(doc_id, text):
    w = planted(doc_id, text)
    runs = plain_runs(w)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in drop)),
    )


def test_periodic_runs(table, monkeypatch):
    monkeypatch.setattr(words, "WINDOW", 100)
    again = " ".join(["x y  z"] * 30 + ["q"] + ["a\tb"] * 20)
    rows = [r for r in ROWS if len(r[1] or "") < 10_000]
    rows += [(30, again), (30, again), (31, "v " * 23), (32, "v " * 24), (33, " ".join("abcdefgh" * 3)), (34, again + " " + prose(1, 40) + " " + again)]
    rows += [(100 + i, prose(i, i)) for i in range(80)]
    got = queries_rows("op11_periodic_runs", table(rows))
    assert in_order(got) == in_order(runs_row(*r) for r in rows)
    assert sum(r[1] > 0 for r in got) > 4
    found = periodic_runs.find_runs(table([(32, "v " * 24), (33, None)])).orderBy("doc_id").collect()
    assert [(r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found] == [(24, [(0, 24, 1)], "v"), (0, [], "")]


def queries_rows(name, docs):
    return [tuple(r) for r in queries.ON_DOCUMENTS[name](docs).collect()]


def test_windows_of_words():
    for text in (b"", b" ", b"one", LONG.encode(), b"a  b\x0b\x0cc" * 40, b"x" * 300):
        for size in (1, 7, 1000):
            assert b"".join(words.windows(text, size)) == text
            assert [w for p in words.windows(text, size) for w in p.split()] == text.split()


# --- 12 byte pairs ----------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    ranks = byte_pairs.read_ranks(byte_pairs.VOCABULARY)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def samples(seed, n):
    r = random.Random(seed)
    parts = ["a", "b", "the", " ", "  ", "\n", "é", "漢", "'s", "'re", "1", "23", "!", "...", "\x85", "　", "zz", "\x00", "<|endoftext|>"]
    for _ in range(n):
        yield "".join(r.choice(parts) for _ in range(r.randrange(60)))


def test_ids_are_those_of_the_library(library, monkeypatch):
    encoder = byte_pairs.Encoder(byte_pairs.read_ranks(byte_pairs.VOCABULARY))
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(chr(c) + ("x" if c % 2 else " 1 ") for c in points[k : k + 4000]) for k in range(0, len(points), 4000)]
    texts += [*samples(1, 500), LONG, "a" * 5000, "ab" * 5000, " " * 3000 + "x", "é" * 3000, "=" * 9000]
    assert [ids.tolist() for ids in encoder.encode(texts)] == [library.encode_ordinary(t) for t in texts]
    texts = [*samples(2, 300), LONG[:9000], "a" * 200, "é" * 70]
    want = [library.encode_ordinary(t) for t in texts]
    for change in ({"BLOCK": 50, "MATCHES": 4}, {"LEXICON": 5}, {"SHORT": 0, "ROW": 4}, {"SHORT": 500, "LANES": 3}):
        encoder.clear()
        with monkeypatch.context() as m:
            for name, value in change.items():
                m.setattr(byte_pairs, name, value)
            assert [ids.tolist() for ids in encoder.encode(texts)] == want
    assert list(encoder.encode([])) == []


@pytest.mark.parametrize("kind", [list, lambda v: array("q", v)])
def test_rank_tree(kind):
    r = random.Random(7)
    for n in (0, 1, 2, 3, 8, 13):
        leaves = [r.randrange(100) << byte_pairs.PLACE | k for k in range(n)]
        tree = byte_pairs.RankTree(kind(leaves))
        for _ in range(60 if n else 0):
            k = r.randrange(n)
            leaves[k] = r.choice([byte_pairs.NONE, r.randrange(5) << byte_pairs.PLACE | k])
            tree.update(k, leaves[k])
            assert tree.nodes[1] == min(leaves)


def test_byte_pairs(table, library):
    rows = [*ROWS, (40, "漢字 " * 900), (41, " " * 2000), (42, "ab" * 20_000)]
    got = queries_rows("op12_byte_pairs", table(rows))
    want = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        want.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(text or "")))
    assert in_order(got) == in_order(want)
    back = byte_pairs.encode(table(rows)).select("doc_id", byte_pairs.decode(F.col("ids")).cast("string"))
    assert in_order(map(tuple, back.collect())) == in_order((i, t or "") for i, t in rows)
    assert byte_pairs.encode(table(rows)).schema["ids"].dataType.simpleString() == "array<int>"


# --- 13 ranked search -------------------------------------------------------------------------------

def plain_terms(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)


def plain_search(docs, items, most=10):
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, c, c.total()) for i, c in held if c]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in held:
            score = 0
            for t in plain_terms(text):
                if tf := c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        scored.sort()
        out += [(item, k, None if none else i, -s) for k, (s, none, i) in enumerate(scored[:most], 1)]
    return out


ITEMS = [
    (1, "w1x w2x W3X w4x w4x"), (2, " ".join(f"w{k}x" for k in range(300))), (3, None), (4, "..."), (5, "nowhere"), (6, "über A b-c"), (7, "漢字 tis"),
    (1, "w1x w2x W3X w4x w4x"), (None, "x the same"), (8, prose(13, 150)), (9, "the"),
]


def search_docs():
    rows = [*ROWS, (50, "The SAME, the.same!"), (50, "The SAME, the.same!"), (51, "\x00w1x\x7fw2x{w3x"), (52, "über ÜBER")]
    rows += [(60 + i, prose(i, 3 + i, 400)) for i in range(120)] + [(300 + i, "the same words") for i in range(60)]
    return rows


@pytest.mark.parametrize("change", [{}, {"SIDE": 64, "SCORED": 3}, {"BLOCK_BYTES": 700}])
def test_ranked_search(spark, table, monkeypatch, change):
    for name, value in change.items():
        monkeypatch.setattr(ranked_search, name, value)
    items = spark.createDataFrame([(i, t, 0, 0) for i, t in ITEMS], "item_id bigint, text string, score int, rank int")
    got = ranked_search.search(table(search_docs()), items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert in_order(map(tuple, got.collect())) == in_order(plain_search(search_docs(), ITEMS))


def test_search_stops_early(spark, table):
    rows = search_docs()
    held = [ranked_search.term_counts(t) for _, t in rows]
    assert [dict(h) for h in held] == [dict(Counter(x.encode() for x in plain_terms(t))) for _, t in rows]
    # Documents whose mask cannot reach the floor are not scored.
    docs = table([(k, "rare word" if k < 20 else "word") for k in range(2000)])
    calls = []
    plain = ranked_search.Side.scores

    def counted(side, docs_, weights):
        calls.append(len(docs_))
        return plain(side, docs_, weights)

    postings = docs.select(F.col("doc_id").alias("id"), ranked_search.counting({b"rare": 0, b"word": 1})(F.col("text")).alias("held"))
    batch = postings.select("id", "held.*").toArrow().to_batches()
    ranked_search.Side.scores = counted
    try:
        found = list(ranked_search.searching([{0: 1, 1: 1}], [5, 1], 2000, 2020, 10)(iter(batch)))
    finally:
        ranked_search.Side.scores = plain
    assert sum(calls) < 600 and found[0].column("id").to_pylist() == list(range(10))


def test_later_operators_on_empty_tables(spark, table):
    none = table([])
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert queries_rows("op11_periodic_runs", none) == [] and queries_rows("op12_byte_pairs", none) == []
    assert ranked_search.search(none, items).collect() == []
    assert ranked_search.search(table([(1, "a")]), items.limit(0)).collect() == []
    assert ranked_search.search(table([(1, None)]), items).collect() == []
