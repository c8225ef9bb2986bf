"""What must not grow with the tables: shuffles, spills and the bytes a task reads."""

import glob
import gzip

import corpus_pipeline
from pyspark.sql import functions as F

from saldo.llm import components, simhash, suffix_dedup
from saldo.operators import tables as U
from saldo.plans import batch as B
from saldo.plans import intermediate as I
from saldo.plans.staging import stg_payment_events
from saldo.sources import bronze as S
from saldo.sources import published as V
from saldo.sources import sinks as O
from saldo.streaming import jobs as D
from workload import adapters as W
from workload import streams as WS
from workload.queries import twice_ingested


def test_a_landed_table_is_written_by_the_tasks_that_read_it(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    wide, few = (W.landed(spark, str(tmp_path), f"in-{n}", lambda n=n: spark.range(0, 1000, 1, n)) for n in (2 * cores + 1, 1))
    assert (len(wide.inputFiles()), len(few.inputFiles())) == (2 * cores + 1, cores)
    for table in (wide, few):
        assert sorted(r.id for r in table.collect()) == list(range(1000))


def test_json_input_is_compressed_and_cut_by_rows(spark, sf, monkeypatch):
    monkeypatch.setattr(WS, "ROWS_PER_FILE", 100)
    rows = W.stream_table(spark, sf, "charges")
    path = WS.json_files(spark, sf, "charges")
    files = glob.glob(f"{path}/*.json.gz")
    assert sum(len(gzip.open(f).readlines()) for f in files) == rows.count()
    assert max(len(gzip.open(f).readlines()) for f in files) <= 100
    assert sorted(map(str, spark.read.schema(rows.schema).json(path).collect())) == sorted(map(str, rows.collect()))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_newest_rows_are_joined_where_they_are(spark):
    rows = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 3, 1), (None, 4, 1), (None, 5, 2)], "k string, v int, t int").repartition(2)
    known = spark.createDataFrame([("b",)], "k string").hint("merge")
    found = U.newest_per_key(rows, ["k"], F.col("t")).join(known, "k", "left_anti")
    assert plan(found).count("Exchange hashpartitioning") == 2  # the rows once, the known keys once
    assert sorted(map(tuple, found.collect()), key=str) == [("a", 2, 2), (None, 5, 2)]


def test_the_intake_holds_no_rows_on_executors(spark, sf, tmp_path, monkeypatch):
    def refuse(*_):
        raise AssertionError("persisted")

    monkeypatch.setattr(type(spark.range(1)), "persist", refuse)
    path = str(tmp_path / "out")
    WS.finish(D.run_intake(WS.raw_stream(spark, sf), path, str(tmp_path / "cp"), F.lit(W.AS_OF).cast("timestamp"), **WS.ONCE))
    consumed = O.read_batches(spark, f"{path}/counters", "messages_consumed bigint").first()[0]
    assert consumed == W.raw_messages(spark, sf).count()
    payloads = O.read_batches(spark, f"{path}/quarantine", "original_payload string")
    assert payloads.count() == payloads.dropna().count() > 0


def test_spans_are_merged_without_a_row_for_each(spark):
    """Overlapping, touching, contained and repeated spans, and a run of one for every byte."""
    some = [(1, 0, 0, 200), (1, 0, 0, 260), (1, 0, 100, 300), (1, 0, 300, 500), (1, 0, 501, 701), (1, 0, 501, 701), (1, 1, 32_800, 33_000)]
    dense = [(2, 0, at, at + 200) for at in range(3000)]
    df = spark.createDataFrame([(d, d, p, a, b) for d, p, a, b in some + dense], "d bigint, e bigint, piece int, start bigint, end bigint")
    found = suffix_dedup.maximal(df)
    got = {r.d: list(zip(r.starts, r.ends, strict=True)) for r in found.collect()}
    assert got == {1: [(0, 500), (501, 701), (32_800, 33_000)], 2: [(0, 3199)]}
    assert "Generate" not in plan(found) and "Window" not in plan(found)


def test_payloads_to_sign_are_read_once(spark, sf):
    found = plan(W.captured(spark, sf, "adyen"))
    assert "json_tuple" in found and "get_json_object(cast(value" not in found


def test_a_batch_stored_by_day_is_merged_where_it_lies(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), (None, 3, "y")], "k string, v int, d string")
    batch = spark.createDataFrame([("d" * 9, "b", 4), ("z", "c", 5)], "d string, k string, v int")
    merged = U.upsert(target, batch, ["k"], cut="d")
    assert "max_by" not in plan(merged) and plan(merged).count("REBALANCE") == 1
    assert sorted(map(tuple, merged.collect()), key=str) == sorted([("a", 1, "x"), (None, 3, "y"), ("b", 4, "d" * 9), ("c", 5, "z")], key=str)


def test_the_newest_rows_travel_without_a_second_key(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, t int")
    assert sorted(map(tuple, U.newest_per_key(rows, ["k"], F.col("t")).collect()), key=str) == [("a", 2), (None, 3)]
    assert "struct(t" in plan(U.newest_per_key(rows, ["k"], F.col("t"))) and "struct(k" not in plan(U.newest_per_key(rows, ["k"], F.col("t")))
    only = rows.select("k")
    assert sorted(map(tuple, U.newest_per_key(only, ["k"], F.lit(1)).collect()), key=str) == [("a",), (None,)]


def test_facts_are_not_dealt_again_and_entities_are_merged_from_their_days(spark, sf, tmp_path, monkeypatch):
    """Which tables deal their rows by day while they are written, and what the entities' tables are read from."""
    dealt, read, put, hint = set(), {}, V.Version.put, type(spark.range(1)).hint

    def watched(self, name, df, *more, **named):
        read.setdefault(name, set(df.inputFiles()))
        with monkeypatch.context() as m:
            m.setattr(type(df), "hint", lambda df, *a: (dealt.add((self.run, name)), hint(df, *a))[1])
            return put(self, name, df, *more, **named)

    monkeypatch.setattr(V.Version, "put", watched)
    source, out = str(tmp_path / "bronze"), str(tmp_path / "out")
    rows, new = W.bronze(spark, sf), F.col("ingested_at") >= F.lit("2024-01-20 10:07:00").cast("timestamp")
    S.append_bronze(rows.filter(~new), source)
    B.run_batch(spark, source, out, W.AS_OF)
    S.append_bronze(rows.filter(new), source)
    done = B.run_incremental(spark, source, out, W.AS_OF)
    assert {(1, "stg_payment_events"), (2, "state_customer_days")} <= dealt
    assert not {(1, "fct_payments"), (2, "fct_payments"), (2, "stg_payment_events")} & dealt
    for name in ("customer", "merchant"):
        assert all(f"/state_{name}_" in f for f in read[f"int_payment_{name}_metrics"])
    assert done["fct_payments"].select("event_id").distinct().count() == done["fct_payments"].count() == rows.count()
    days = done["fct_payments"].select("event_date").distinct().count()
    assert len(done["fct_payments"].inputFiles()) <= 2 * days + 2 * spark.sparkContext.defaultParallelism


def test_days_of_an_entity_are_counted_without_storing_them_as_values(spark, sf):
    rows = W.bronze(spark, sf).limit(300)
    undated = rows.limit(5).withColumn("provider_created_at", F.lit(None).cast("timestamp")).withColumn("customer_id", F.lit("undated"))
    stg = stg_payment_events(rows.unionByName(undated)).cache()
    for entity in (I.CUSTOMER, I.MERCHANT):
        values = entity.values(stg)
        assert "active_days" not in {r[0] for r in values.select("which").distinct().collect()}
        merged, whole = entity.from_days(entity.days(stg), values), entity.metrics(stg)
        assert sorted(map(str, merged.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))
    assert merged.filter("active_days > 0").count() and I.CUSTOMER.metrics(stg).filter("customer_id = 'undated'").first()["active_days"] == 0
    stg.unpersist()


def test_repeated_events_are_made_in_one_scan(spark, sf):
    rows, draw = W.bronze(spark, sf), F.pmod(F.crc32("event_id"), F.lit(6))
    older = rows.filter(draw < 2).withColumn("ingested_at", F.col("ingested_at") - F.expr("INTERVAL 20 MINUTES")) \
        .withColumn("amount_cents", F.lit(1).cast("bigint")).withColumn("status", F.lit("stale"))
    wanted, got = rows.unionByName(older).unionByName(rows.filter(draw == 3)), twice_ingested(spark, sf)
    assert got.schema.simpleString() == wanted.schema.simpleString() and got.count() == wanted.count()
    assert got.exceptAll(wanted).isEmpty()
    assert plan(got).count("FileScan") == plan(rows).count("FileScan") == 1


def test_rows_after_an_explode_are_not_broadcast(spark, monkeypatch):
    """Spark takes them for as few as the rows before."""
    plans, find = [], simhash.components
    monkeypatch.setattr(simhash, "components", lambda links: plans.append(plan(links)) or find(links))
    fps = spark.range(50).select(F.xxhash64("id").alias("fp"))
    assert simhash.link_fingerprints(fps).count() == 50
    assert [p.count("SortMergeJoin") for p in plans] == [1, 2]
    assert not any("Broadcast" in p for p in plans)


def broadcasts(text: str) -> list[str]:
    """The part of a plan below each broadcast."""
    lines, out = text.splitlines(), []
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    for k, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((i for i in range(k + 1, len(lines)) if depth[i] <= depth[k]), len(lines))
            out.append("\n".join(lines[k + 1 : end]))
    return out


def test_the_pipeline_finds_near_copies_without_a_broadcast_of_an_explode(spark, monkeypatch):
    plans, write = [], simhash.materialize
    for module in (simhash, components):
        monkeypatch.setattr(module, "materialize", lambda df, label: plans.append(plan(df)) or write(df, label))
    docs = spark.createDataFrame([(i, f"{i} {i + 1} {i + 2} {i + 3} words of its own") for i in range(40)] + [(99, "0 1 2 3 words of its own")], "doc_id bigint, text string")
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    plans.append(plan(kept))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(40))
    found = [b for p in plans for b in broadcasts(p)]
    assert found and sum("Generate" in p for p in plans) >= 2
    assert not any("Generate" in b for b in found)
