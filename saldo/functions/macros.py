"""Reusable column expressions: rates, money, categories, keys, time buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Double ratio; 0 when the denominator is 0 or NULL."""
    return F.when(
        F.coalesce(denominator, F.lit(0)) == 0, F.lit(0.0)
    ).otherwise(numerator.cast("double") / denominator)


def surrogate_key(*cols: Column) -> Column:
    """MD5 over the dash-joined text of the columns, NULL as empty text."""
    return F.md5(F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from start up to, not including, end."""
    days = F.sequence(F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1))
    return spark.range(1).select(F.explode(days).alias("date_day"))


def customer_tier(revenue_cents: Column) -> Column:
    return (
        F.when(revenue_cents >= 100_000, "platinum")
        .when(revenue_cents >= 50_000, "gold")
        .when(revenue_cents >= 10_000, "silver")
        .otherwise("bronze")
    )


def risk_profile(failure_rate: Column) -> Column:
    return (
        F.when(failure_rate >= 0.15, "high_risk")
        .when(failure_rate >= 0.05, "medium_risk")
        .otherwise("low_risk")
    )


def fraud_risk_level(score: Column) -> Column:
    """NULL scores count as low."""
    return F.when(score >= 0.7, "high").when(score >= 0.3, "medium").otherwise("low")


def churn_risk_level(score: Column) -> Column:
    """Three-level reading of a churn score; NULL counts as low."""
    return F.when(score >= 0.6, "high").when(score >= 0.3, "medium").otherwise("low")


def cents_to_dollars(cents: Column) -> Column:
    return (cents.cast(MONEY) / F.lit(100)).cast(MONEY)


def merchant_health_score(dispute: Column, refund: Column, failure: Column) -> Column:
    penalty = dispute * 400 + refund * 300 + failure * 300
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.lit(100.0) - penalty))


def merchant_health_category(score: Column) -> Column:
    return (
        F.when(score >= 90, "excellent").when(score >= 70, "good").when(score >= 50, "fair")
        .otherwise("poor")
    )


# Category -> status spellings.
STATUS_SYNONYMS = {
    "succeeded": ["succeeded", "paid", "complete", "completed"],
    "failed": ["failed", "failure", "declined"],
    "pending": ["pending", "processing", "in_progress"],
    "refunded": ["refunded", "partially_refunded"],
    "disputed": ["disputed", "chargeback"],
    "canceled": ["canceled", "cancelled", "voided"],
}


def payment_status_category(status: Column) -> Column:
    folded = F.lower(status)
    known = [F.when(folded.isin(words), name) for name, words in STATUS_SYNONYMS.items()]
    return F.coalesce(*known, F.lit("unknown"))


def _category(event_type: Column, dispute_words: list[str]) -> Column:
    disputed = event_type.contains(dispute_words[0])
    for word in dispute_words[1:]:
        disputed = disputed | event_type.contains(word)
    return (
        F.when(event_type.contains("charge") | event_type.like("%payment%succeeded%"), "charge")
        .when(event_type.contains("refund"), "refund")
        .when(disputed, "dispute")
        .when(event_type.contains("subscription"), "subscription")
        .when(event_type.contains("failed"), "failed_payment")
        .otherwise("other")
    )


def event_type_category(event_type: Column) -> Column:
    """Category used by the fact table. The charge rule comes first, so every chargeback is a charge."""
    return _category(event_type, ["dispute", "chargeback"])


def staging_category(event_type: Column) -> Column:
    """Category used by staging; its dispute rule knows no chargebacks."""
    return _category(event_type, ["dispute"])


def interval_15m(ts: Column) -> Column:
    """15-minute tumbling bucket (start, end)."""
    return F.window(ts, "15 minutes")


def interval_label(start: Column) -> Column:
    return F.date_format(start, "yyyy-MM-dd HH:mm")


def whole_days(start: Column, end: Column) -> Column:
    """Whole 24-hour periods between two timestamps."""
    return F.timestamp_diff("DAY", start, end)


# Rounded outputs divide exact integers once, so partition order can never change a result.

def money2(cents: Column) -> Column:
    """Cents as dollars with two decimals."""
    return F.round(cents.cast("double")) / 100


def pct2(part: Column, whole: Column) -> Column:
    """Percentage with two decimals; NULL when the whole is 0."""
    return F.round(part * F.lit(10000.0) / F.when(whole != 0, whole)) / 100


def scaled(score: Column) -> Column:
    """Score in units of 1/10000. Scores carry four decimals, so this is exact."""
    return F.round(score * 10000).cast("bigint")


def mean_score(total_scaled: Column, n: Column) -> Column:
    """Unrounded mean of scaled scores."""
    return total_scaled / F.when(n != 0, n) / 10000


def score4(total_scaled: Column, n: Column) -> Column:
    """Mean of scaled scores with four decimals, 0 when there are none."""
    return F.coalesce(F.round(total_scaled / F.when(n != 0, n)) / 10000, F.lit(0.0))
