"""Star schema: customer, merchant and date dimensions, payment and daily facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.functions import macros as M
from saldo.operators.incremental import newer_than


def _dimension(metrics: DataFrame, key: str, natural: str, as_of) -> DataFrame:
    built = F.lit(as_of).cast("timestamp")
    return metrics.select(
        M.surrogate_key(F.col(natural)).alias(key),
        "*",
        built.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
        built.alias("dw_created_at"),
        built.alias("dw_updated_at"),
    )


def dim_customer(customer_metrics: DataFrame, as_of) -> DataFrame:
    return _dimension(customer_metrics, "customer_key", "customer_id", as_of)


def dim_merchant(merchant_metrics: DataFrame, as_of) -> DataFrame:
    return _dimension(merchant_metrics, "merchant_key", "merchant_id", as_of)


def touched_entities(stg: DataFrame, natural: str, loaded_until) -> DataFrame:
    """All events of the entities that have events past the mark.

    Restricting the events before aggregating keeps an incremental dimension build from
    re-aggregating the whole history of untouched entities.
    """
    if loaded_until is None:
        return stg
    touched = newer_than(stg, "ingested_at", loaded_until).select(natural).distinct()
    return stg.join(touched, natural, "left_semi")


def dim_date(spark: SparkSession, start: str = "2020-01-01", end: str = "2030-12-31") -> DataFrame:
    """Calendar with an exclusive end. The ISO week label pairs the calendar year with the ISO week."""
    day = F.col("date_key")
    weekday = F.weekday(day) + 1
    week2 = F.lpad(F.weekofyear(day).cast("string"), 2, "0")
    year_text = F.year(day).cast("string")
    return (
        M.date_spine(spark, start, end)
        .withColumnRenamed("date_day", "date_key")
        .select(
            "date_key",
            F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"),
            F.weekofyear(day).alias("week_of_year"), F.dayofmonth(day).alias("day_of_month"),
            weekday.alias("day_of_week"), F.dayofyear(day).alias("day_of_year"),
            F.date_format(day, "EEEE").alias("day_name"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.date_format(day, "MMM").alias("month_name_short"),
            F.year(day).alias("fiscal_year"), F.quarter(day).alias("fiscal_quarter"),
            (weekday >= 6).alias("is_weekend"), (weekday < 6).alias("is_weekday"),
            F.date_format(day, "yyyy-MM").alias("year_month"),
            F.concat(year_text, F.lit("-Q"), F.quarter(day).cast("string")).alias("year_quarter"),
            year_text.alias("year_str"),
            F.weekofyear(day).alias("iso_week"),
            F.concat(year_text, F.lit("-W"), week2).alias("iso_year_week"),
        )
    )


def fct_payments(stg: DataFrame, as_of, loaded_until=None) -> DataFrame:
    """Event-grain fact: a pure projection, no shuffle. Write it partitioned by event_date."""
    flag = lambda condition: F.when(condition, 1).otherwise(0)
    col, built = F.col, F.lit(as_of).cast("timestamp")
    day = F.to_date("provider_created_at")
    return newer_than(stg, "ingested_at", loaded_until).select(
        M.surrogate_key(col("event_id")).alias("payment_key"),
        M.surrogate_key(col("customer_id")).alias("customer_key"),
        M.surrogate_key(col("merchant_id")).alias("merchant_key"),
        day.alias("date_key"),
        "event_id", "provider", "provider_event_id", "event_type",
        M.event_type_category(col("event_type")).alias("event_category"),
        "customer_id", "merchant_id", "amount_cents",
        M.cents_to_dollars(col("amount_cents")).alias("amount_dollars"),
        "currency", "status",
        M.payment_status_category(col("status")).alias("status_category"),
        "failure_code", "failure_message",
        flag(col("status") == "succeeded").alias("is_successful"),
        flag(col("status") == "failed").alias("is_failed"),
        flag(col("event_type").contains("refund")).alias("is_refund"),
        flag(col("event_type").contains("dispute")).alias("is_dispute"),
        "payment_method_type", "card_brand", "card_last_four", "fraud_score", "risk_level",
        M.fraud_risk_level(col("fraud_score")).alias("fraud_risk_category"),
        "retry_strategy", "retry_delay_seconds", "churn_score", "churn_risk_level",
        M.churn_risk_level(col("churn_score")).alias("churn_risk_category"),
        "days_to_churn_estimate", "validation_status", "validation_errors",
        flag(col("validation_status") == "passed").alias("is_valid"),
        "provider_created_at", "processed_at", "ingested_at",
        day.alias("event_date"),
        "metadata", "schema_version",
        built.alias("dw_created_at"), built.alias("dw_updated_at"),
    )


def fct_daily_payments(daily_summary: DataFrame, as_of) -> DataFrame:
    built = F.lit(as_of).cast("timestamp")
    return daily_summary.withColumnRenamed("event_date", "date_key").select(
        "*", built.alias("dw_created_at"), built.alias("dw_updated_at")
    )


def touched_days(stg: DataFrame, loaded_until) -> DataFrame:
    """All events of the days that received events past the mark, so that partial days are completed."""
    if loaded_until is None:
        return stg
    day = F.to_date("provider_created_at")
    touched = newer_than(stg, "ingested_at", loaded_until).select(day.alias("_day")).distinct()
    return stg.join(touched, day == F.col("_day"), "left_semi")
