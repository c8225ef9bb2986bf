import math
import random

import pytest

from saldo.operators import drift as DR

SCHEMA = "a double, b bigint, c float, d double"


def sample(spark, seed, n, move=0.0):
    r = random.Random(seed)
    rows = [(r.gauss(move, 1), int(r.expovariate(0.1)), None if r.random() < 0.1 else float(r.randrange(3)), 5.0) for _ in range(n)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3), rows


def report(reference, current):
    return {r.feature: r for r in DR.drift_report(reference, current).collect()}


def plain(before, after, edges):
    """PSI and KS of two lists, by bins."""
    def bins(values):
        return [sum(v is None for v in values)] + [sum(v is not None and sum(v > e for e in edges) == k for v in values) for k in range(len(edges) + 1)]

    a, b = bins(before), bins(after)
    p, q = ([(n + 0.5) / (sum(x) + 0.5 * len(x)) for n in x] for x in (a, b))
    psi = sum((y - x) * math.log(y / x) for x, y in zip(p, q, strict=True))
    ks = max(abs(sum(a[1 : k + 1]) / sum(a[1:]) - sum(b[1 : k + 1]) / sum(b[1:])) for k in range(1, len(a)))
    return psi, ks


def test_reports_equal_plain_python(spark):
    (one, before), (two, after) = sample(spark, 1, 900), sample(spark, 2, 1100, 0.3)
    edges = DR.quantile_edges(one, list("abcd"))
    assert len(edges["a"]) == 15 and edges["c"] == [0.0, 1.0, 2.0] and edges["d"] == [5.0]
    values = sorted(r[0] for r in before)
    assert edges["a"] == [values[math.ceil(k * 900 / 16) - 1] for k in range(1, 16)]
    got = report(DR.profile(one, edges), DR.profile(two, edges))
    for k, f in enumerate("abcd"):
        psi, ks = plain([r[k] for r in before], [r[k] for r in after], edges[f])
        assert (got[f].psi, got[f].ks) == (pytest.approx(psi), pytest.approx(ks))
        assert (got[f].reference_rows, got[f].current_rows) == (900, 1100)
    assert got["c"].reference_null_rate == sum(r[2] is None for r in before) / 900


def test_moved_features_are_found_and_others_are_not(spark):
    one, _ = sample(spark, 3, 4000)
    edges = DR.quantile_edges(one, list("abcd"))
    reference = DR.profile(one, edges)
    same = report(reference, DR.profile(sample(spark, 4, 3000)[0], edges))
    assert not any(r.drifted for r in same.values()) and {r.level for r in same.values()} == {"stable"}
    moved = report(reference, DR.profile(sample(spark, 5, 3000, 1.0)[0], edges))
    assert moved["a"].level == "major" and moved["a"].drifted and not moved["b"].drifted
    few = report(reference, DR.profile(sample(spark, 6, 20)[0], edges))
    assert few["a"].psi > DR.MODERATE and not few["a"].drifted, "twenty rows prove nothing"


def test_profiles_merge(spark):
    df, _ = sample(spark, 7, 500)
    edges = DR.quantile_edges(df, ["a", "c"], bins=4)
    parts = DR.merge_profiles(*[DR.profile(df.filter(f"b % 3 = {k}"), edges) for k in range(3)])
    key = lambda p: sorted((r.feature, r.bin, r.n) for r in p.collect() if r.n)
    assert key(parts) == key(DR.profile(df, edges))


def test_empty_sides_and_only_nulls(spark):
    df, _ = sample(spark, 8, 200)
    edges = DR.quantile_edges(df, ["a"])
    full, none = DR.profile(df, edges), DR.profile(df.limit(0), edges)
    for pair in ((full, none), (none, full), (none, none)):
        r = report(*pair)["a"]
        assert (r.level, r.psi, r.drifted) == ("unknown", None, None)
    nulls = spark.createDataFrame([(None,), (float("nan"),)] * 300, "a double")
    r = report(full, DR.profile(nulls, edges))["a"]
    assert r.drifted and r.level == "major" and r.ks is None and r.current_null_rate == 1.0
    assert DR.quantile_edges(nulls, ["a"]) == {"a": []}


def test_a_profile_is_one_scan_with_one_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    sample(spark, 9, 100)[0].write.parquet(path)
    df = spark.read.parquet(path)
    plan = DR.profile(df, DR.quantile_edges(df, ["a", "c"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("hashpartitioning") == 1 and "partial_count" in plan
    assert "ReadSchema: struct<a:double,c:float>" in plan
