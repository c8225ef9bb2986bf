"""The pipeline against plain Python, stage by stage, and the registered queries."""

from collections import Counter

import __spark_entry__
import corpus_pipeline
from saldo.llm import language_id, queries
from . import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stages(spark, docs, sf, tmp_path):
    """Rows after each stage, as they are read again."""
    out = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages(spark, sf, tmp_path):
    docs = queries.documents(spark, sf)
    got = stages(spark, docs, sf, tmp_path)
    assert all(df.columns == COLUMNS for df in got[:-1])
    rows = {r.doc_id: r for r in docs.collect()}
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in got]
    assert all(df.count() == len(i) for df, i in zip(got[:-1], ids, strict=False))

    models = language_id.compressors(language_id.fit(docs.filter(~language_id.held_out())))
    judged = {i: language_id.judge(r.text, models) for i, r in rows.items()}
    kept = {i for i, (lang, score) in judged.items() if lang != "und" and score >= language_id.MARGIN}
    assert ids[0] == kept

    first = {}
    for i in sorted(kept):
        first.setdefault(brute.normalised_sha(rows[i].text), i)
    kept = set(first.values())
    assert ids[1] == kept

    prints = {i: brute.simhash(rows[i].text) for i in kept}
    label = brute.linked(list(prints.values()))
    first = {}
    for i in sorted(kept):
        first.setdefault(label[prints[i]], i)
    kept = set(first.values())
    assert ids[2] == kept

    def path(r):
        digits = r.source.removeprefix("src")
        return f"domain{(int(digits) if digits.isdigit() else 0) % 4}", r.lang, r.source

    weights = {**queries.MIX_WEIGHTS, "source": {}}
    leaves = [(i, path(rows[i]), -(-len(rows[i].text.encode()) // 4)) for i in kept]
    _, copies = brute.mixed(leaves, weights, corpus_pipeline.MIXED_SHARE, 1, queries.MIX_SEED)
    kept = {i for i, n in copies.items() if n}
    assert ids[3] == kept

    pieces = got[4].collect()
    tokens = dict(zip(sorted(kept), brute.token_ids([rows[i].text for i in sorted(kept)]), strict=True))
    total = Counter()
    for p in pieces:
        total[p.doc_id] += p.length
    assert total == {i: len(t) + 1 for i, t in tokens.items()}
    assert len({p.sequence_id for p in pieces}) == brute.best_fit([p.length for p in pieces], 2048)


def test_run_equals_stages(spark, sf, tmp_path):
    want = stages(spark, queries.documents(spark, sf), sf, tmp_path)[-1]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, sf)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))


def test_stages_on_an_empty_table(spark, sf, tmp_path):
    got = stages(spark, queries.documents(spark, sf).limit(0), sf, tmp_path)
    assert [df.count() for df in got] == [0] * 5


def test_stages_on_edge_rows(spark, tmp_path):
    rows = [(1, "the same text of five words"), (1, "the same text of five words"), (None, "the same  text of five words"), (2, None), (3, ""), (None, None),
            (4, "123"), (5, "another text that has words enough to be judged"), (5, "another text that has words enough to be judged")]
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = stages(spark, docs, None, tmp_path)
    assert sorted(r.doc_id for r in got[1].collect()) == [1, 5]
    assert got[-1].count() <= 2


def test_every_operator_is_registered():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 11))
    assert "pipeline" in __spark_entry__.queries()
