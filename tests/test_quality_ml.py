import datetime as dt

import pytest
from pyspark.sql import functions as F

from saldo.operators import ml as L
from saldo.operators import quality as Q
from saldo.plans import features as X

T0 = dt.datetime(2024, 1, 1, 12)


def test_checks(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", "x"), (2, None, "y"), (None, "z", "y"), (None, "z", "y")], "k int, a string, b string")
    assert [tuple(r) for r in Q.check_unique(df, ["k"]).collect()] == [(1, 2)]
    assert {r["column"]: r["failures"] for r in Q.check_not_null(df, "k", "a", "b").collect()} == {"k": 2, "a": 1, "b": 1}
    assert {r["value"]: r["failures"] for r in Q.check_accepted(df, "b", ["x"]).collect()} == {"y": 3}
    assert Q.check_expression(df, "k < 2").first()["failures"] == 1
    report = Q.run_tests("t", df, Q.TableTests(("k",), ("a",), (("b", ["x", "y"]),)))
    assert {(r["check"], r["column"]): r["status"] for r in report.collect()} == {
        ("unique", "k"): "fail", ("not_null", "a"): "fail", ("accepted_values", "b"): "pass"}
    dim = spark.createDataFrame([(1,)], "k int")
    assert tuple(Q.check_relationship(df, dim, "k").first()) == (1, 1, 2)


@pytest.mark.parametrize("minutes,status", [(0, "pass"), (30, "pass"), (31, "warn"), (60, "warn"), (61, "error")])
def test_freshness(spark, minutes, status):
    df = spark.createDataFrame([(T0,)], "ts timestamp")
    assert Q.check_freshness(df, "ts", T0 + dt.timedelta(minutes=minutes)).first()["status"] == status
    assert Q.check_freshness(df.limit(0), "ts", T0).first()["status"] == "error"


def test_monitors(spark):
    rows = [("R", T0)] * 101 + [("S", T0), ("S", T0 - dt.timedelta(hours=2))]
    q = spark.createDataFrame(rows, "rejection_reason string, quarantine_timestamp timestamp")
    got = {r["rejection_reason"]: (r["n"], r["alert"]) for r in Q.quarantine_monitor(q, T0).collect()}
    assert got == {"R": (101, True), "S": (1, False)}
    summary = {r["source"]: r for r in Q.quarantine_summary({"a": q, "b": q.limit(0)}, T0).collect()}
    assert summary["a"]["quarantined"] == 102 and summary["b"]["quarantined"] == 0
    assert (summary["all"]["quality_score"], summary["all"]["alert"]) == (98.98, True)
    charges = spark.createDataFrame([(T0, i < 6) for i in range(100)], "created_at timestamp, validation_flag boolean")
    flags = Q.flag_monitor(charges, T0).first()
    assert (flags["flagged_records"], flags["alert"]) == (6, True)
    assert Q.flag_monitor(charges.limit(0), T0).first()["flagged_percentage"] == 0.0


def test_feature_reports(spark):
    df = spark.createDataFrame([(0.5, 0.1, None), (1.5, 0.2, 1)], "failure_rate_30d double, fraud_score_avg double, x int")
    row = Q.validate_customer_features(df).first()
    assert (row["num_records"], row["high_null_columns"], row["invalid_failure_rates"], row["quality_status"]) == (2, ["x"], 1, "error")
    assert Q.validate_customer_features(df.filter("failure_rate_30d < 1")).first()["quality_status"] == "warning"


def test_views_respect_ttl(spark):
    view = X.FeatureView("v", "k", 3600, {"f": "bigint"})
    src = spark.createDataFrame([("a", T0, 1), ("a", T0 - dt.timedelta(minutes=30), 2), ("b", T0 - dt.timedelta(hours=2), 3)], "k string, feature_timestamp timestamp, f int")
    people = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    got = {r["k"]: r["f"] for r in X.latest_features(people, view, src, T0).collect()}
    assert got == {"a": 1, "b": None, "c": None}
    earlier = {r["k"]: r["f"] for r in X.latest_features(people, view, src, T0 - dt.timedelta(minutes=10)).collect()}
    assert earlier["a"] == 2


def test_metrics_and_promotion(spark):
    rows = [(1, 1)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(0, 0)] * 4
    m = L.binary_metrics(spark.createDataFrame(rows, "label int, prediction int")).first()
    assert (m["accuracy"], m["precision"], m["recall"]) == (0.7, 0.6, 0.75) and m["f1"] == pytest.approx(2 / 3)
    zero = L.binary_metrics(spark.createDataFrame([(0, 0)], "label int, prediction int")).first()
    assert (zero["precision"], zero["recall"], zero["f1"]) == (0.0, 0.0, 0.0)
    registry = spark.createDataFrame([], L.REGISTRY_SCHEMA)
    for f1 in (0.5, 0.5, 0.6, 0.4):
        registry = L.promote_if_better(registry, "m", f1, "p")
    assert [r["stage"] for r in registry.orderBy("version").collect()] == ["Archived", "None", "Production", "None"]


def training(spark, n=200):
    u = lambda s: L.keyed_uniform(F.col("customer_id"), 1, s)
    cols = {c: u(c) for c in L.FRAUD_FEATURES}
    df = spark.range(n).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("customer_id"))
    return df.select("customer_id", *[v.alias(k) for k, v in cols.items()])


def test_labels_and_split_are_stable(spark):
    df = L.synthetic_labels(training(spark), "fraud")
    again = L.synthetic_labels(training(spark).repartition(7), "fraud")
    key = lambda d: sorted((r["customer_id"], r["label"]) for r in d.collect())
    assert key(df) == key(again)
    train, test = L.stratified_split(df)
    assert not {r["customer_id"] for r in train.collect()} & {r["customer_id"] for r in test.collect()}
    for label, n in df.groupBy("label").count().collect():
        assert abs(test.filter(F.col("label") == label).count() - n * 0.2) <= 1
    assert train.count() + test.count() == 200
    assert L.ensure_two_classes(df.limit(19)) is None
    flipped = L.ensure_two_classes(df.withColumn("label", F.lit(1)))
    assert flipped.filter("label = 0").count() == 40


def test_training_scoring_and_fallback(spark):
    data = training(spark).withColumn("label", (F.col("fraud_score_avg") > 0.6).cast("int"))
    train, test = L.stratified_split(data)
    model = L.train_fraud(train)
    scored = L.predict(model, test, L.FRAUD_FEATURES)
    metrics = L.binary_metrics(scored).first()
    assert 0.8 <= metrics["f1"] <= 1.0 and L.auc_roc(scored) > 0.9
    top = L.feature_importance(spark, model, L.FRAUD_FEATURES).first()
    assert top["feature"] == "fraud_score_avg"
    some = test.withColumn("usable", F.col("failure_rate_30d") > 0.5)
    mixed = L.score_with_model(some, L.FRAUD_FEATURES, model, F.lit(0.123), F.col("usable"), "score")
    rows = mixed.collect()
    assert all((r["score_source"] == "model") == r["usable"] for r in rows)
    assert all(r["score"] == 0.123 for r in rows if not r["usable"])
    rules = L.score_with_model(some, L.FRAUD_FEATURES, None, F.lit(0.5), F.col("usable"), "score")
    assert rules.filter("score_source <> 'rules'").count() == 0
