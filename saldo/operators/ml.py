"""Training sets, model training, evaluation, promotion and scoring with Spark ML."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FRAUD_FEATURES = [
    "fraud_score_avg", "failure_rate_30d", "total_payments_30d", "high_risk_payment_count",
    "merchant_fraud_rate", "high_risk_transaction_pct", "merchant_health_score",
]
CHURN_FEATURES = [
    "total_payments_30d", "total_payments_90d", "failure_rate_30d", "consecutive_failures",
    "recovery_rate_30d", "days_since_last_payment", "payment_method_count",
]
MIN_ROWS = 20


def fraud_training_set(customers: DataFrame, merchants: DataFrame) -> DataFrame:
    """Customer features beside the merchant averages. The averages are one row by construction."""
    averages = merchants.agg(
        F.avg("fraud_rate_30d").alias("merchant_fraud_rate"),
        F.avg("high_risk_transaction_pct").alias("high_risk_transaction_pct"),
        F.avg("merchant_health_score").alias("merchant_health_score"))
    picked = customers.select(
        "customer_id", "fraud_score_avg", "failure_rate_30d", "total_payments_30d", "high_risk_payment_count")
    return picked.crossJoin(F.broadcast(averages))


def churn_training_set(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", *CHURN_FEATURES, "customer_tier")


def keyed_uniform(key: Column, seed: int, purpose: str) -> Column:
    """Uniform number in [0, 1) from the key: the same row gets the same draw under any partitioning."""
    text = F.concat(F.lit(f"{purpose}:{seed}:"), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))


def label_probability(kind: str) -> Column:
    """Weighted probability of the synthetic label, clipped to [0, 1]."""
    value = lambda c, default: F.coalesce(F.col(c).cast("double"), F.lit(default))
    clip = lambda x: F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
    if kind == "fraud":
        return clip(
            value("fraud_score_avg", 0.0) * 0.5 + value("merchant_fraud_rate", 0.0) * 0.3
            + value("high_risk_transaction_pct", 0.0) * 0.2)
    return clip(
        value("failure_rate_30d", 0.0) * 0.4 + clip(value("days_since_last_payment", 0.0) / 30) * 0.3
        + (F.lit(1.0) - value("recovery_rate_30d", 1.0)) * 0.3)


def synthetic_labels(df: DataFrame, kind: str, seed: int = 42, key: str = "customer_id") -> DataFrame:
    """Adds a Bernoulli `label` drawn from the key."""
    draw = keyed_uniform(F.col(key), seed, f"{kind}-label")
    return df.withColumn("label", (draw < label_probability(kind)).cast("int"))


DRAWS = 2**32
BINS = 2**16


def exact_cuts(df: DataFrame, draw: Column, share: float) -> dict:
    """By label, the number of rows and the least draw that at least `share` of the rows do not exceed; exact.

    Draws are whole multiples of 2^-32. Counts of 65,536 bins name the bin that holds the cut, counts within
    that bin name the cut: two small aggregates, whatever the number of rows.
    """
    rows = df.select("label", (draw * DRAWS).cast("bigint").alias("u"))
    split = rows.select("label", F.expr(f"u div {BINS}").alias("bin"), F.expr(f"u % {BINS}").alias("rest"))

    def nth(counts: list, wanted: int) -> tuple[int, int]:
        """The value that holds the wanted row, and how many rows lie before it."""
        before = 0
        for value, n in sorted(counts):
            if before + n >= wanted:
                return value, before
            before += n
        raise ValueError("fewer rows than wanted")

    by_bin: dict = {}
    for r in split.groupBy("label", "bin").count().collect():  # at most 65,536 per label
        by_bin.setdefault(r["label"], []).append((r["bin"], r["count"]))
    totals = {label: sum(n for _, n in counts) for label, counts in by_bin.items()}
    wanted = {label: max(1, math.ceil(share * n)) for label, n in totals.items()}
    found = {label: nth(counts, wanted[label]) for label, counts in by_bin.items()}
    if not found:
        return {}
    inside = reduce(lambda c, x: c | x, [(F.col("label") == k) & (F.col("bin") == b) for k, (b, _) in found.items()])
    by_rest: dict = {}
    for r in split.filter(inside).groupBy("label", "rest").count().collect():
        by_rest.setdefault(r["label"], []).append((r["rest"], r["count"]))
    cut = {k: b * BINS + nth(by_rest[k], wanted[k] - before)[0] for k, (b, before) in found.items()}
    return {k: (totals[k], cut[k] / DRAWS) for k in cut}


def ensure_two_classes(df: DataFrame, seed: int = 42, key: str = "customer_id", min_rows: int = MIN_ROWS) -> DataFrame | None:
    """None below `min_rows`, as in the source system; with a single class the fifth of the rows with the lowest draws is flipped."""
    n, low, high = df.agg(F.count(F.lit(1)), F.min("label"), F.max("label")).first()
    if n < min_rows:
        return None
    if low != high:
        return df
    draw = keyed_uniform(F.col(key), seed, "flip")
    cut = exact_cuts(df, draw, 0.2)[low][1]
    return df.withColumn("label", F.when(draw <= cut, 1 - F.col("label")).otherwise(F.col("label")))


def stratified_split(df: DataFrame, test: float = 0.2, seed: int = 42, key: str = "customer_id"):
    """(train, test) by a keyed draw; with two rows or more in every class, exactly the same share of each."""
    draw = keyed_uniform(F.col(key), seed, "split")
    cuts = exact_cuts(df, draw, test)
    if cuts and min(n for n, _ in cuts.values()) >= 2:
        cut = reduce(lambda c, x: c.when(F.col("label") == x[0], F.lit(x[1][1])), cuts.items(), F)
    else:
        cut = F.lit(test)
    marked = df.withColumn("_test", draw <= cut)
    return marked.filter(~F.col("_test")).drop("_test"), marked.filter("_test").drop("_test")


def balanced_weights(df: DataFrame) -> DataFrame:
    """Adds `weight` = rows / (classes x rows of the class)."""
    rows = df.groupBy("label").count().collect()  # one row per class
    total = sum(r["count"] for r in rows)
    weight = reduce(
        lambda c, r: c.when(F.col("label") == r["label"], total / (len(rows) * r["count"])), rows, F)
    return df.withColumn("weight", weight)


def _assembled(features: list[str], classifier) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), classifier])


def train_fraud(train: DataFrame, seed: int = 42):
    """Random forest, 100 trees of depth 10, balanced classes.

    minInstancesPerNode is the nearest setting to a minimum split of five rows.
    """
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", weightCol="weight", numTrees=100, maxDepth=10,
        minInstancesPerNode=2, seed=seed)
    data = balanced_weights(train.fillna(0, FRAUD_FEATURES))
    return _assembled(FRAUD_FEATURES, forest).fit(data)


def train_churn(train: DataFrame, seed: int = 42):
    """Gradient boosting, 100 rounds of depth 5, step 0.1."""
    boosted = GBTClassifier(
        labelCol="label", featuresCol="features", maxIter=100, maxDepth=5, stepSize=0.1, seed=seed)
    return _assembled(CHURN_FEATURES, boosted).fit(train.fillna(0, CHURN_FEATURES))


def predict(model, df: DataFrame, features: list[str]) -> DataFrame:
    """Adds `probability_1` and `prediction`."""
    keep = df.columns
    scored = model.transform(df.fillna(0, features))
    return scored.select(
        *keep, F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("probability_1"))


def binary_metrics(predictions: DataFrame) -> DataFrame:
    """One row: accuracy, precision, recall, F1 of class 1 (0 when undefined), counts and base rate."""
    yes, said = F.col("label") == 1, F.col("prediction") == 1
    counts = predictions.agg(
        F.count_if(yes & said).alias("tp"), F.count_if(~yes & said).alias("fp"),
        F.count_if(yes & ~said).alias("fn"), F.count_if(~yes & ~said).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    over = lambda a, b: F.when(b == 0, 0.0).otherwise(a / b)
    return counts.select(
        "tp", "fp", "fn", "tn",
        over(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        over(tp, tp + fp).alias("precision"), over(tp, tp + fn).alias("recall"),
        over(2 * tp, 2 * tp + fp + fn).alias("f1"),
        over(tp + fn, tp + fp + fn + tn).alias("base_rate"))


def auc_roc(predictions: DataFrame) -> float | None:
    """Area under the ROC curve; None when the labels have one class."""
    if predictions.agg(F.count_distinct("label")).first()[0] < 2:
        return None
    scored = predictions.withColumn("_score", F.col("probability_1").cast("double"))
    return BinaryClassificationEvaluator(rawPredictionCol="_score", labelCol="label").evaluate(
        scored.withColumn("label", F.col("label").cast("double")))


def feature_importance(spark: SparkSession, model, features: list[str]) -> DataFrame:
    """Importances in descending order: one row per model feature."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(features, values, strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


REGISTRY_SCHEMA = "name string, version int, f1 double, stage string, path string"


def promote_if_better(registry: DataFrame, name: str, f1: float, path: str, min_gain: float = 0.0) -> DataFrame:
    """The registry with the new version added.

    It becomes Production when the model has no champion or beats the champion's F1 by more than
    min_gain; the champion is then archived. The registry holds one row per trained version.
    """
    mine = F.col("name") == name
    state = registry.filter(mine).agg(
        F.max("version"), F.max(F.when(F.col("stage") == "Production", F.col("f1")))).first()
    version, champion = (state[0] or 0) + 1, state[1]
    wins = champion is None or f1 > champion + min_gain
    old = registry
    if wins:
        old = registry.withColumn(
            "stage", F.when(mine & (F.col("stage") == "Production"), "Archived").otherwise(F.col("stage")))
    new = registry.sparkSession.createDataFrame(
        [(name, version, float(f1), "Production" if wins else "None", path)], REGISTRY_SCHEMA)
    return old.unionByName(new)


def score_with_model(df: DataFrame, features: list[str], model, rules: Column, usable: Column,
                     out: str) -> DataFrame:
    """P(class 1) where features are usable, else the rule score; NULL features count as 0.

    With no model every row gets its rule score.
    """
    keep = df.columns
    if model is None:
        return df.select(*keep, rules.alias(out), F.lit("rules").alias(f"{out}_source"))
    raw = df.withColumn("_rules", rules).withColumn("_usable", usable)
    filled = raw.select(
        F.struct(*keep).alias("_row"), "_rules", "_usable",
        *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features])
    scored = model.transform(filled)
    return scored.select(
        "_row.*",
        F.when(F.col("_usable"), vector_to_array("probability")[1]).otherwise(F.col("_rules")).alias(out),
        F.when(F.col("_usable"), "model").otherwise("rules").alias(f"{out}_source"))


def churn_model_factors() -> tuple[Column, Column]:
    """(factors, actions) read off the features when the model scored a customer."""
    streak = F.coalesce("consecutive_failures", F.lit(0)) >= 2
    rate = F.coalesce("failure_rate_30d", F.lit(0.0)) > 0.3
    pick = lambda a, b: F.array_compact(F.array(F.when(streak, a), F.when(rate, b)))
    return (
        pick("multiple_consecutive_failures", "high_recent_failure_rate"),
        pick("immediate_customer_outreach", "review_payment_methods"),
    )
