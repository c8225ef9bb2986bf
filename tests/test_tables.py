import datetime as dt
import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saldo.operators import grouping as G
from saldo.operators import sequences as Q
from saldo.operators import tables as U
from saldo.sources import bronze as S

T0 = dt.datetime(2024, 1, 1)


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


def test_upsert_keeps_newest_and_is_idempotent(spark):
    schema = "k string, v int, ingested_at timestamp"
    target = spark.createDataFrame([("a", 1, T0), ("b", 2, T0)], schema)
    batch = spark.createDataFrame([("b", 3, minutes(1)), ("b", 4, minutes(2)), ("c", 5, T0)], schema)
    once = U.upsert(target, batch, ["k"])
    assert sorted((r["k"], r["v"]) for r in once.collect()) == [("a", 1), ("b", 4), ("c", 5)]
    assert sorted(U.upsert(once, batch, ["k"]).collect()) == sorted(once.collect())


def test_enrichment_conflicts_change_only_enrichment(spark):
    schema = "event_id string, amount_cents bigint, fraud_score double, ingested_at timestamp"
    target = spark.createDataFrame([("a", 1, 0.1, T0)], schema)
    batch = spark.createDataFrame([("a", 9, None, minutes(1)), ("n", 2, 0.2, minutes(1)), ("n", 3, 0.3, minutes(2))], schema)
    got = {r["event_id"]: (r["amount_cents"], r["fraud_score"]) for r in U.upsert_enrichment(target, batch).collect()}
    assert got == {"a": (1, None), "n": (2, 0.3)}


def test_scd2_closes_and_opens(spark):
    schema = "k string, tier string, valid_from timestamp, valid_to timestamp, is_current boolean"
    dim = spark.createDataFrame([("a", "x", T0, None, True), ("b", None, T0, None, True), ("a", "w", T0, T0, False)], schema)
    snap = spark.createDataFrame([("a", "y"), ("b", None), ("c", "z")], "k string, tier string")
    merged = U.scd2_merge(dim, snap, "k", ["tier"], "2024-02-01")
    got = sorted((r["k"], r["tier"] or "", r["is_current"], r["valid_to"] is not None) for r in merged.collect())
    assert got == [("a", "w", False, True), ("a", "x", False, True), ("a", "y", True, False), ("b", "", True, False), ("c", "z", True, False)]
    again = U.scd2_merge(merged, snap, "k", ["tier"], "2024-03-01")
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))


def test_newest_per_key_combines_copies_before_the_shuffle(spark):
    df = spark.range(100).select(F.lit("hot").alias("k"), "id")
    plan = U.newest_per_key(df, ["k"], F.col("id"))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max_by") > plan.index("Exchange") > plan.index("max_by")
    assert "Window" not in plan


events = st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 300), st.sampled_from(["ok", "failed", None])), min_size=1, max_size=25)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events, st.sampled_from([1, 3, 8]))
def test_next_value_and_streak_match_brute_force(spark, rows, parts):
    data = [(i, k, minutes(m), s) for i, (k, m, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, k string, ts timestamp, s string")
    got = {r["id"]: r["nxt"] for r in Q.next_value(df, "k", "ts", "id", "s", "nxt", parts).collect()}
    ordered = sorted(data, key=lambda r: (r[1], r[2], r[0]))
    want = {a[0]: (b[3] if b is not None and b[1] == a[1] else None) for a, b in zip(ordered, [*ordered[1:], None])}
    assert got == want
    failed = F.coalesce(F.col("s") == "failed", F.lit(False))
    streaks = {r["k"]: r["n"] for r in Q.trailing_count(df, "k", F.struct("ts", "id"), failed, "n").collect()}
    for key in {r[1] for r in data}:
        run = 0
        for row in [r for r in ordered if r[1] == key][::-1]:
            if row[3] != "failed":
                break
            run += 1
        assert streaks[key] == run


@pytest.mark.parametrize("ttl,parts", [(3600, 1), (3600, 24), (86_400, 7)])
def test_point_in_time_join_matches_merge_asof(spark, ttl, parts):
    rng = random.Random(ttl + parts)
    when = lambda: T0 + dt.timedelta(seconds=rng.randrange(0, 200_000))
    # A third of all rows belong to one entity.
    who = lambda: rng.choice(["hot", *"abcd", "hot"])
    labels = [(i, who(), when()) for i in range(300)]
    feats = sorted({(who(), when()) for _ in range(120)})
    feats = [(k, t, n) for n, (k, t) in enumerate(feats)]
    got = Q.point_in_time_join(
        spark.createDataFrame(labels, "id int, k string, lt timestamp"),
        spark.createDataFrame(feats, "k string, ft timestamp, v int"), "k", "lt", "ft", ["v"], ttl, parts)
    mine = {r["id"]: r["v"] for r in got.collect()}
    left = pd.DataFrame(labels, columns=["id", "k", "lt"]).sort_values("lt")
    right = pd.DataFrame(feats, columns=["k", "ft", "v"]).sort_values("ft")
    want = pd.merge_asof(left, right, left_on="lt", right_on="ft", by="k")
    alive = want["ft"] > want["lt"] - pd.Timedelta(seconds=ttl)
    expected = {int(r.id): (int(r.v) if ok else None) for r, ok in zip(want.itertuples(), alive)}
    assert mine == expected


def hot_second(spark, n=200_000):
    """One customer has all but a few rows, all of them in one second."""
    hot = spark.range(n).select("id", F.lit("hot").alias("k"), F.lit(T0).alias("ts"))
    return hot.unionByName(spark.createDataFrame([(n, "a", T0), (n + 1, "z", T0)], hot.schema))


def test_a_hot_second_of_one_customer_is_cut_into_even_ranges(spark):
    n = 200_000
    rows = hot_second(spark, n)
    cut = Q.ranges(rows, ["k", "ts", "id"], 16)
    tasks = [r["count"] for r in cut.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == n + 2 and max(tasks) <= 2 * sorted(tasks)[len(tasks) // 2]
    got = Q.next_value(rows, "k", "ts", "id", "id", "nxt", 16)
    wrong = got.filter(~F.col("nxt").eqNullSafe(F.when(F.col("id") < n - 1, F.col("id") + 1)))
    assert got.count() == n + 2 and wrong.isEmpty()


def test_a_feature_is_carried_over_ranges_without_one(spark):
    n = 50_000
    labels = hot_second(spark, n).unionByName(
        spark.createDataFrame([(-1, None, T0), (-2, "hot", None)], "id long, k string, ts timestamp"))
    feats = spark.createDataFrame(
        [("hot", T0 - dt.timedelta(seconds=9), 1), ("hot", T0, 2), ("hot", T0 + dt.timedelta(seconds=1), 3),
         ("a", T0 - dt.timedelta(days=2), 4), (None, T0, 5), ("hot", None, 6)], "k string, ft timestamp, v int")
    got = Q.point_in_time_join(labels, feats, "k", "ts", "ft", ["v"], 3600, 16)
    counts = {(r["k"], r["v"]): r["count"] for r in got.groupBy("k", "v").count().collect()}
    assert counts == {("hot", 2): n, ("hot", None): 1, ("a", None): 1, ("z", None): 1, (None, None): 1}
    none = labels.limit(0)
    assert Q.point_in_time_join(none, feats, "k", "ts", "ft", ["v"], 3600, 4).isEmpty()
    assert Q.next_value(none, "k", "ts", "id", "id", "nxt", 4).isEmpty()
    assert Q.point_in_time_join(labels, feats.limit(0), "k", "ts", "ft", ["v"], 3600, 4).filter("v IS NOT NULL").isEmpty()


def test_distinct_counts_with_null_keys_and_a_hot_key(spark):
    rows = [("hot" if i % 3 else ("k%d" % (i % 5) if i % 2 else None), i % 7, "x" if i % 4 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, a int, b string")
    measures = [F.count(F.lit(1)).alias("n")]
    got = G.aggregate(df, ["k"], measures, {"da": F.col("a"), "db": F.col("b")}, null_keys=True)
    want = df.groupBy("k").agg(*measures, F.count_distinct("a").alias("da"), F.count_distinct("b").alias("db"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_conform_and_limits(spark):
    rows = [(i, f"e{i}", minutes(30 - i), i % 2 == 0) for i in range(10)]
    store = spark.createDataFrame(rows, "id int, event_id string, ingested_at timestamp, loaded_to_iceberg boolean")
    assert [r["id"] for r in S.read_unloaded(store, 2).collect()] == [9, 7]
    assert S.read_unloaded(store).count() == 5
    assert S.read_by_date(store, T0.date(), 3).count() == 3
    from saldo.schemas import BRONZE
    shaped = S.ingest_events(store, 3)
    assert shaped.schema.names == BRONZE.names and shaped.count() == 3
    nested = spark.createDataFrame([({"a": 1},)], "metadata map<string,int>")
    assert S.conform(nested, BRONZE).first()["metadata"] == '{"a":1}'
    plan = S.read_by_date(store, T0.date(), 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_snapshots(spark, tmp_path):
    df = spark.range(3)
    path = str(tmp_path / "t")
    U.write_version(df, path, "2024-01-01")
    U.write_version(df.union(df), path, "2024-02-01")
    read = lambda t: U.snapshot_as_of(spark, path, df.schema, t).count()
    assert (read("2023-12-31"), read("2024-01-15"), read("2024-03-01")) == (0, 3, 6)


def test_ledger_and_marking(spark):
    schema = "event_id string, loaded_to_iceberg boolean, loaded_at timestamp"
    store = spark.createDataFrame([("a", False, None), ("b", False, None), ("c", True, T0)], schema)
    ids = spark.createDataFrame([("a",), ("a",)], "event_id string")
    marked = {r["event_id"]: (r["loaded_to_iceberg"], r["loaded_at"]) for r in S.mark_loaded(store, ids, minutes(1)).collect()}
    assert marked == {"a": (True, minutes(1)), "b": (False, None), "c": (True, T0)}
    assert sorted(r["event_id"] for r in S.not_in_ledger(store, ids).collect()) == ["b", "c"]


def test_partition_upsert_touches_only_its_days(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k string, v int, d string, ingested_at timestamp"
    spark.createDataFrame([("a", 1, "x", T0), ("b", 2, "y", T0), ("n", 0, None, T0)], schema).write.partitionBy("d").parquet(path)
    batch = spark.createDataFrame([("b", 3, "y", T0), ("c", 4, "y", T0), ("n", 5, None, T0)], schema)
    for _ in range(2):
        U.upsert_partitions(spark, path, batch, ["k"], "d")
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 3), ("c", 4), ("n", 5)]


def test_partition_upsert_refuses_a_fine_key(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(str(i), str(i), T0) for i in range(5)], "k string, d string, ingested_at timestamp")
    rows.write.partitionBy("d").parquet(path)
    with pytest.raises(ValueError):
        U.upsert_partitions(spark, path, rows, ["k"], "d", most=4)


def test_ingest_is_repeatable(spark, tmp_path):
    bronze, ledger = str(tmp_path / "b"), str(tmp_path / "l")
    rows = [(i, f"e{i}", minutes(600 * i), False) for i in range(8)]
    schema = "id int, event_id string, ingested_at timestamp, loaded_to_iceberg boolean"
    store = spark.createDataFrame(rows, schema)
    assert S.ingest(store.limit(3), bronze, ledger) == 3
    assert S.ingest(store, bronze, str(tmp_path / "lost")) == 8  # as after a failure between the two writes
    assert S.ingest(store, bronze, ledger) == 5
    assert S.ingest(store, bronze, ledger) == 0
    assert sorted(r["event_id"] for r in spark.read.parquet(bronze).collect()) == [f"e{i}" for i in range(8)]
