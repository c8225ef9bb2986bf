"""Declared data tests, monitors and the review of quarantined rows.

Reports are DataFrames; no check collects rows. All NULL and accepted-value checks of a table share
one aggregation pass, however many there are; each uniqueness check is one partial aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo import constants as C
from saldo.functions.macros import pct2


def check_unique(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keys that occur more than once; rows with a NULL key part are not compared."""
    return df.dropna(subset=cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def check_not_null(df: DataFrame, *cols: str) -> DataFrame:
    """NULL count per column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("failures")) for c in cols])))


def check_accepted(df: DataFrame, col: str, values: list) -> DataFrame:
    """Values outside the list with their counts; NULL is not a violation."""
    return df.filter(~F.col(col).isin(values)).groupBy(F.col(col).alias("value")).agg(
        F.count(F.lit(1)).alias("failures"))


def check_freshness(df: DataFrame, ts: str, as_of, warn_minutes: int = 30, error_minutes: int = 60) -> DataFrame:
    """Age of the newest row and its state: pass, warn or error. An empty table is an error."""
    now = F.lit(as_of).cast("timestamp")
    age = F.timestamp_diff("MINUTE", F.col("newest"), now)
    late = lambda minutes: F.col("newest") < now - F.make_dt_interval(mins=F.lit(minutes))
    return df.agg(F.max(ts).cast("timestamp").alias("newest")).select(
        "newest", age.alias("age_minutes"),
        F.when(F.col("newest").isNull() | late(error_minutes), "error")
        .when(late(warn_minutes), "warn").otherwise("pass").alias("status"))


def check_relationship(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Orphan rows per state of the key: referenced rows missing from the dimension, and NULL keys."""
    dim_key = dim_key or key
    known = dim.select(F.col(dim_key).alias(key))
    # Orphans are reduced to one row per key before the join, so a hot key is one row.
    keys = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    null_rows = F.sum(F.when(F.col(key).isNull(), F.col("n")))
    orphans = keys.join(known, key, "left_anti").agg(
        F.coalesce(F.sum(F.when(F.col(key).isNotNull(), F.col("n"))), F.lit(0)).alias("orphan_rows"),
        F.count(F.col(key)).alias("orphan_keys"),
        F.coalesce(null_rows, F.lit(0)).alias("null_key_rows"))
    return orphans


def check_expression(df: DataFrame, rule: str) -> DataFrame:
    """Number of rows for which the rule is false; unknown is not a failure."""
    return df.filter(~F.expr(rule)).agg(F.count(F.lit(1)).alias("failures"))


@dataclass(frozen=True)
class TableTests:
    """Declared tests of one table."""

    unique: tuple = ()
    not_null: tuple = ()
    accepted: tuple = ()      # (column, allowed values)


INTERVAL = TableTests(("interval_key",), ("interval_key",))

SUITE = {
    "payment_events": TableTests(
        ("event_id",), ("event_id", "provider", "event_type", "status", "ingested_at"),
        (("provider", C.PROVIDERS), ("currency", C.SUPPORTED_CURRENCIES))),
    "payment_events_quarantine": TableTests((), ("event_id", "original_payload", "quarantined_at")),
    "stg_payment_events": TableTests(
        ("event_id",), ("event_id", "provider", "event_type", "status", "ingested_at"),
        (("event_category", C.EVENT_CATEGORIES),)),
    "int_payment_customer_metrics": TableTests(("customer_id",), ("customer_id",), (
        ("customer_tier", C.CUSTOMER_TIERS), ("payment_risk_profile", C.RISK_PROFILES),
        ("fraud_risk_category", C.RISK_LEVELS), ("churn_risk_category", C.RISK_LEVELS))),
    "int_payment_merchant_metrics": TableTests(("merchant_id",), ("merchant_id",), (
        ("health_category", C.HEALTH_CATEGORIES), ("fraud_risk_category", C.RISK_LEVELS))),
    "int_payment_daily_summary": TableTests(("event_date",), ("event_date",)),
    "dim_customer": TableTests(
        ("customer_key", "customer_id"), ("customer_key", "customer_id", "is_current"),
        (("customer_tier", C.CUSTOMER_TIERS),)),
    "dim_merchant": TableTests(
        ("merchant_key", "merchant_id"), ("merchant_key", "merchant_id", "is_current"),
        (("health_category", C.HEALTH_CATEGORIES),)),
    "dim_date": TableTests(("date_key",), ("date_key", "year", "month")),
    "fct_payments": TableTests(
        ("payment_key", "event_id"), ("payment_key", "event_id", "date_key", "status"),
        (("event_category", C.EVENT_CATEGORIES),)),
    "fct_daily_payments": TableTests(("date_key",), ("date_key", "total_transactions")),
    "analytics_payment_intervals": INTERVAL,
    "analytics_payment_summary": INTERVAL,
    "analytics_risk_overview": INTERVAL,
    "analytics_provider_comparison": TableTests(
        ("interval_provider_key",), ("interval_provider_key", "provider")),
    "analytics_payment_trends": TableTests(("trend_key",), ("trend_key", "date_key")),
    "analytics_customer_segments": TableTests(
        (), ("segment_type",), (("segment_type", C.SEGMENT_TYPES),)),
    "feat_customer_features": TableTests(("customer_id",), ("customer_id", "feature_timestamp")),
    "feat_merchant_features": TableTests(("merchant_id",), ("merchant_id", "feature_timestamp")),
}


def run_tests(table: str, df: DataFrame, tests: TableTests) -> DataFrame:
    """Report of one table: table, check, column, failures, status."""
    checks = [("not_null", c, F.count_if(F.col(c).isNull())) for c in tests.not_null]
    checks += [("accepted_values", c, F.count_if(~F.col(c).isin(list(v)))) for c, v in tests.accepted]
    one_pass = df.agg(*[value.alias(f"c{i}") for i, (_, _, value) in enumerate(checks)])
    rows = [
        F.struct(F.lit(kind).alias("check"), F.lit(col).alias("column"), F.col(f"c{i}").alias("failures"))
        for i, (kind, col, _) in enumerate(checks)
    ]
    report = one_pass.select(F.inline(F.array(*rows)))
    for col in tests.unique:
        duplicates = check_unique(df, [col]).agg(F.count(F.lit(1)).alias("failures"))
        report = report.unionByName(duplicates.select(
            F.lit("unique").alias("check"), F.lit(col).alias("column"), "failures"))
    return report.select(
        F.lit(table).alias("table"), "check", "column", "failures",
        F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"))


def quality_suite(tables: dict[str, DataFrame], suite: dict[str, TableTests] | None = None) -> DataFrame:
    """One report over all given tables that have declared tests."""
    suite = suite or SUITE
    reports = [run_tests(name, df, suite[name]) for name, df in tables.items() if name in suite]
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


# --- monitors ---------------------------------------------------------------------------------------

def _since(ts: str, as_of, hours: int) -> Column:
    now = F.lit(as_of).cast("timestamp")
    return (F.col(ts) > now - F.make_dt_interval(hours=F.lit(hours))) & (F.col(ts) <= now)


def quarantine_monitor(quarantine: DataFrame, as_of, threshold: int = 100, hours: int = 1) -> DataFrame:
    """Recent rejections per reason with first and last time seen; alert above the threshold."""
    return quarantine.filter(_since("quarantine_timestamp", as_of, hours)).groupBy("rejection_reason").agg(
        F.count(F.lit(1)).alias("n"), F.min("quarantine_timestamp").alias("first_seen"),
        F.max("quarantine_timestamp").alias("last_seen"),
    ).withColumn("alert", F.col("n") > threshold).orderBy(F.desc("n"))


def quarantine_summary(quarantines: dict[str, DataFrame], as_of, assumed_total: int = 10_000,
                       true_totals: dict[str, DataFrame] | None = None, hours: int = 1) -> DataFrame:
    """Recent rejections per table plus a total row with the quality score and alert.

    The score divides by an assumed volume; when the full tables are given, `true_score` uses their
    real row counts of the same period, and decides on the alert.
    """
    tagged = None
    for name, df in quarantines.items():
        part = df.filter(_since("quarantine_timestamp", as_of, hours)).select(
            F.lit(name).alias("source"), "rejection_reason")
        tagged = part if tagged is None else tagged.unionByName(part)
    names = tagged.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(n) for n in quarantines])).alias("source"))
    counts = tagged.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("rejection_reason").alias("unique_reasons"))
    per_table = names.join(counts, "source", "left").select(
        "source", F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("unique_reasons", F.lit(0)).alias("unique_reasons"))
    if true_totals:
        totals = None
        for name, df in true_totals.items():
            part = df.filter(_since("created_at", as_of, hours)).agg(F.count(F.lit(1)).alias("total")).select(
                F.lit(name).alias("source"), "total")
            totals = part if totals is None else totals.unionByName(part)
        per_table = per_table.join(totals, "source", "left")
    else:
        per_table = per_table.withColumn("total", F.lit(None).cast("bigint"))
    # At most one row per table from here on.
    g = per_table.groupingSets([[F.col("source")], []], F.col("source")).agg(
        F.sum("n").alias("quarantined"), F.sum("unique_reasons").alias("unique_reasons"),
        F.sum("total").alias("total_rows"))
    is_total = F.col("source").isNull()
    score = pct2(F.lit(assumed_total) - F.col("quarantined"), F.lit(assumed_total))
    true_score = pct2(F.col("total_rows") - F.col("quarantined"), F.col("total_rows"))
    return g.select(
        F.coalesce("source", F.lit("all")).alias("source"), "quarantined",
        F.when(~is_total, F.col("unique_reasons")).alias("unique_reasons"),
        F.when(is_total, score).alias("quality_score"),
        F.when(is_total, F.coalesce(true_score, score) < 99.0).alias("alert"),
        F.when(is_total, true_score).alias("true_score"))


def flag_monitor(charges: DataFrame, as_of, threshold_pct: float = 5.0, hours: int = 1) -> DataFrame:
    """Share of recent valid charges that carry the suspicious flag."""
    flagged = charges.filter(_since("created_at", as_of, hours)).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("validation_flag")).alias("flagged_records"))
    share = F.coalesce(
        F.col("flagged_records") * F.lit(100.0) / F.when(F.col("total_records") != 0, F.col("total_records")),
        F.lit(0.0))
    return flagged.select("*", share.alias("flagged_percentage"), (share > threshold_pct).alias("alert"))


def _null_rates(df: DataFrame, extra: list[Column]) -> DataFrame:
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in df.columns]
    wide = df.agg(F.count(F.lit(1)).alias("num_records"), *nulls, *extra)
    rates = [
        F.struct(F.lit(c).alias("column"),
                 (F.col(f"_null_{c}") / F.when(F.col("num_records") != 0, F.col("num_records"))).alias("rate"))
        for c in df.columns
    ]
    return wide.withColumn("null_rates", F.array(*rates))


def validate_customer_features(features: DataFrame) -> DataFrame:
    """One row over the whole table: null rates, columns above 10 % NULL, bad rates, mean score, status."""
    rate = F.col("failure_rate_30d")
    wide = _null_rates(features, [
        F.count_if((rate < 0) | (rate > 1)).alias("invalid_failure_rates"),
        F.avg("fraud_score_avg").alias("fraud_score_mean")])
    high = F.transform(F.filter("null_rates", lambda r: r["rate"] > 0.1), lambda r: r["column"])
    return wide.select(
        "num_records", "null_rates", high.alias("high_null_columns"), "invalid_failure_rates",
        "fraud_score_mean",
        F.when(F.col("num_records") == 0, "skipped")
        .when(F.col("invalid_failure_rates") > 0, "error")
        .when(F.size(high) > 0, "warning").otherwise("healthy").alias("quality_status"))


def validate_merchant_features(features: DataFrame) -> DataFrame:
    """One row over the whole table: null rates and mean health."""
    wide = _null_rates(features, [F.avg("merchant_health_score").alias("avg_merchant_health_score")])
    return wide.select("num_records", "avg_merchant_health_score", "null_rates")


def apply_review(quarantine: DataFrame, decisions: DataFrame, key: str = "event_id") -> DataFrame:
    """Quarantine rows with the reviewers' decisions (key, reviewed_at, reviewed_by, resolution) set."""
    fields = ["reviewed_at", "reviewed_by", "resolution"]
    made = decisions.groupBy(key).agg(F.max_by(F.struct(*fields), "reviewed_at").alias("_d"))
    decided = F.col("_d").isNotNull()
    joined = quarantine.join(made, key, "left")
    values = {f: F.when(decided, F.col("_d")[f]).otherwise(F.col(f)) for f in fields}
    values["reviewed"] = decided | F.coalesce("reviewed", F.lit(False))
    return joined.select(*[values.get(c, F.col(c)).alias(c) for c in quarantine.columns])


def reprocess(reviewed: DataFrame) -> DataFrame:
    """Raw messages of the rows resolved as `reprocessed`, ready for another normalization."""
    return reviewed.filter(F.col("resolution") == "reprocessed").select(
        F.col("original_payload").cast("binary").alias("value"), F.col("source_topic").alias("topic"),
        F.col("kafka_partition").cast("int").alias("partition"), F.col("kafka_offset").alias("offset"))
