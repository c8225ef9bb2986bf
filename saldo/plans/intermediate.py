"""Per-customer, per-merchant and per-day aggregates.

Measures are combined on the map side, so a hot customer, merchant or day costs one small buffer per
task, and exact distinct counts are taken over narrow rows spread by value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.functions import macros as M
from saldo.operators.grouping import aggregate, distinct_values, merged


# The distinct value that partial measures of each day count by themselves.
ACTIVE_DAYS = "active_days"


def ok() -> Column:
    return F.col("status") == "succeeded"


def bad() -> Column:
    return F.col("status") == "failed"


def amount() -> Column:
    return F.col("amount_cents")


def refund_type() -> Column:
    return F.col("event_type").contains("refund")


def dispute_type() -> Column:
    return F.col("event_type").contains("dispute")


def sum_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, amount())), F.lit(0).cast("bigint"))


def mean_cents(total: str, n: str) -> Column:
    """Mean over successful payments, 0 when there are none."""
    return M.safe_divide(F.col(total), F.col(n))


def _score_sums(prefix: str) -> list[Column]:
    col = F.col(f"{prefix}_score")
    return [F.sum(M.scaled(col)).alias(f"_{prefix}_sum"), F.count(col).alias(f"_{prefix}_n")]


def _mean(prefix: str) -> Column:
    return M.mean_score(F.col(f"_{prefix}_sum"), F.col(f"_{prefix}_n"))


@dataclass(frozen=True)
class Entity:
    """An entity's aggregate: its additive measures, distinct values, and the columns derived from them.

    Measures are merged over days by summing, but for those named in `extremes`.
    """
    key: str
    measures: Callable[[], list[Column]]
    distinct: Callable[[], dict[str, Column]]
    extremes: dict[str, str]
    finish: Callable[[DataFrame], DataFrame]

    def rows(self, stg: DataFrame) -> DataFrame:
        return stg.filter(F.col(self.key).isNotNull())

    def metrics(self, stg: DataFrame, approx: bool = False, parts: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
        """The metrics from the events, or from their partial measures and distinct values where these are stored."""
        if parts is not None:
            return self.from_days(*parts)
        return self.finish(aggregate(self.rows(stg), [self.key], self.measures(), self.distinct(), approx))

    def days(self, stg: DataFrame) -> DataFrame:
        """Partial measures of each entity and day."""
        dated = self.rows(stg).withColumn("event_date", F.to_date("provider_created_at"))
        return dated.groupBy("event_date", self.key).agg(*self.measures())

    def values(self, stg: DataFrame) -> DataFrame:
        """Distinct values of each entity and day, but for the days themselves."""
        dated = self.rows(stg).withColumn("event_date", F.to_date("provider_created_at"))
        return distinct_values(dated, ["event_date", self.key], {n: c for n, c in self.distinct().items() if n != ACTIVE_DAYS})

    def from_days(self, days: DataFrame, values: DataFrame) -> DataFrame:
        """The metrics of entities from all their days; the events themselves are not read."""
        names = [c for c in days.columns if c not in ("event_date", self.key)]
        how = {n: self.extremes.get(n, "sum") for n in [*names, ACTIVE_DAYS]}
        counted = days.withColumn(ACTIVE_DAYS, F.col("event_date").isNotNull().cast("bigint"))  # an entity has one row a day
        return self.finish(merged(counted, values, self.key, how, [n for n in self.distinct() if n != ACTIVE_DAYS]))


def _customer_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(ok()).alias("successful_transactions"),
        F.count_if(bad()).alias("failed_transactions"),
        F.count_if((F.col("status") == "refunded") | refund_type()).alias("refunded_transactions"),
        sum_where(ok()).alias("total_revenue_cents"),
        F.count(F.when(ok(), amount())).alias("_paid"),
        F.max(F.when(ok(), amount())).alias("_max"),
        F.min(F.when(ok(), amount())).alias("_min"),
        *_score_sums("fraud"), *_score_sums("churn"),
        F.max("fraud_score").alias("max_fraud_score"),
        F.max("churn_score").alias("max_churn_score"),
        F.count_if(F.col("risk_level") == "high").alias("high_risk_transaction_count"),
        F.min("days_to_churn_estimate").alias("min_days_to_churn"),
        F.min("payment_method_type").alias("preferred_payment_method"),
        F.min("card_brand").alias("preferred_card_brand"),
        F.min("currency").alias("preferred_currency"),
        F.min("provider_created_at").alias("first_transaction_at"),
        F.max("provider_created_at").alias("last_transaction_at"),
    ]


def _customer_distinct() -> dict[str, Column]:
    return {
        ACTIVE_DAYS: F.to_date("provider_created_at"),
        "provider_count": F.col("provider"),
        "merchant_count": F.col("merchant_id"),
    }


def _customer_columns(g: DataFrame) -> DataFrame:
    d = (
        g.withColumn("avg_transaction_cents", mean_cents("total_revenue_cents", "_paid"))
        .withColumn("failure_rate", M.safe_divide(F.col("failed_transactions"), F.col("total_transactions")))
        .withColumn("avg_fraud_score", _mean("fraud"))
        .withColumn("avg_churn_score", _mean("churn"))
    )
    return d.select(
        "customer_id",
        "total_transactions", "successful_transactions", "failed_transactions", "refunded_transactions",
        "total_revenue_cents",
        M.cents_to_dollars(F.col("total_revenue_cents")).alias("total_revenue_dollars"),
        "avg_transaction_cents",
        M.cents_to_dollars(F.col("avg_transaction_cents")).alias("avg_transaction_dollars"),
        F.coalesce("_max", F.lit(0)).alias("max_transaction_cents"),
        F.coalesce("_min", F.lit(0)).alias("min_transaction_cents"),
        "failure_rate",
        M.risk_profile(F.col("failure_rate")).alias("payment_risk_profile"),
        "avg_fraud_score", "max_fraud_score", "high_risk_transaction_count",
        M.fraud_risk_level(F.col("avg_fraud_score")).alias("fraud_risk_category"),
        "avg_churn_score", "max_churn_score", "min_days_to_churn",
        M.churn_risk_level(F.col("avg_churn_score")).alias("churn_risk_category"),
        "preferred_payment_method", "preferred_card_brand", "preferred_currency",
        M.customer_tier(F.col("total_revenue_cents")).alias("customer_tier"),
        "first_transaction_at", "last_transaction_at", "active_days",
        M.whole_days(F.col("first_transaction_at"), F.col("last_transaction_at")).alias("customer_tenure_days"),
        "provider_count", "merchant_count",
    )


CUSTOMER = Entity("customer_id", _customer_measures, _customer_distinct, {
    "_max": "max", "_min": "min", "max_fraud_score": "max", "max_churn_score": "max", "min_days_to_churn": "min",
    "preferred_payment_method": "min", "preferred_card_brand": "min", "preferred_currency": "min",
    "first_transaction_at": "min", "last_transaction_at": "max",
}, _customer_columns)


def int_customer_metrics(stg: DataFrame, approx: bool = False, parts: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """One row per customer with volumes, revenue, scores, tiers and tenure."""
    return CUSTOMER.metrics(stg, approx, parts)


def _merchant_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(ok()).alias("successful_transactions"),
        F.count_if(bad()).alias("failed_transactions"),
        F.count_if(refund_type()).alias("refund_count"),
        F.count_if(dispute_type() | F.col("event_type").contains("chargeback")).alias("dispute_count"),
        sum_where(ok()).alias("total_revenue_cents"),
        sum_where(refund_type()).alias("total_refunds_cents"),
        F.count(F.when(ok(), amount())).alias("_paid"),
        *_score_sums("fraud"),
        F.count_if(F.col("risk_level") == "high").alias("high_risk_transaction_count"),
        F.min("provider").alias("primary_provider"),
        F.min("currency").alias("primary_currency"),
        F.min("provider_created_at").alias("first_transaction_at"),
        F.max("provider_created_at").alias("last_transaction_at"),
    ]


def _merchant_distinct() -> dict[str, Column]:
    return {
        "unique_customers": F.col("customer_id"),
        "provider_count": F.col("provider"),
        "currency_count": F.col("currency"),
        ACTIVE_DAYS: F.to_date("provider_created_at"),
    }


def _merchant_columns(g: DataFrame) -> DataFrame:
    total, paid = F.col("total_transactions"), F.col("successful_transactions")
    d = (
        g.withColumn("avg_transaction_cents", mean_cents("total_revenue_cents", "_paid"))
        .withColumn("net_revenue_cents", F.col("total_revenue_cents") - F.col("total_refunds_cents"))
        .withColumn("failure_rate", M.safe_divide(F.col("failed_transactions"), total))
        .withColumn("refund_rate", M.safe_divide(F.col("refund_count"), paid))
        .withColumn("dispute_rate", M.safe_divide(F.col("dispute_count"), paid))
        .withColumn("avg_fraud_score", _mean("fraud"))
    )
    d = d.withColumn("health_score", M.merchant_health_score(
        F.col("dispute_rate"), F.col("refund_rate"), F.col("failure_rate")))
    return d.select(
        "merchant_id",
        "total_transactions", "successful_transactions", "failed_transactions", "refund_count",
        "dispute_count", "total_revenue_cents",
        M.cents_to_dollars(F.col("total_revenue_cents")).alias("total_revenue_dollars"),
        "total_refunds_cents",
        M.cents_to_dollars(F.col("total_refunds_cents")).alias("total_refunds_dollars"),
        "avg_transaction_cents",
        M.cents_to_dollars(F.col("avg_transaction_cents")).alias("avg_transaction_dollars"),
        "net_revenue_cents",
        M.cents_to_dollars(F.col("net_revenue_cents")).alias("net_revenue_dollars"),
        "failure_rate", "refund_rate", "dispute_rate", "health_score",
        M.merchant_health_category(F.col("health_score")).alias("health_category"),
        "avg_fraud_score", "high_risk_transaction_count",
        M.safe_divide(F.col("high_risk_transaction_count"), total).alias("high_risk_rate"),
        M.fraud_risk_level(F.col("avg_fraud_score")).alias("fraud_risk_category"),
        "unique_customers",
        M.safe_divide(total, F.col("unique_customers")).alias("transactions_per_customer"),
        "provider_count", "primary_provider", "currency_count", "primary_currency",
        "first_transaction_at", "last_transaction_at", "active_days",
        M.whole_days(F.col("first_transaction_at"), F.col("last_transaction_at")).alias("merchant_tenure_days"),
    )


MERCHANT = Entity("merchant_id", _merchant_measures, _merchant_distinct, {
    "primary_provider": "min", "primary_currency": "min", "first_transaction_at": "min", "last_transaction_at": "max",
}, _merchant_columns)


def int_merchant_metrics(stg: DataFrame, approx: bool = False, parts: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """One row per merchant with rates, health, risk and reach."""
    return MERCHANT.metrics(stg, approx, parts)


def int_daily_summary(stg: DataFrame, approx: bool = False) -> DataFrame:
    """One row per provider-created day. NULL providers and methods fall in no pivot column."""
    provider, method, currency = F.col("provider"), F.col("payment_method_type"), F.col("currency")
    g = aggregate(stg.withColumn("event_date", F.to_date("provider_created_at")), ["event_date"], [
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(ok()).alias("successful_transactions"),
        F.count_if(bad()).alias("failed_transactions"),
        F.count_if(refund_type()).alias("refund_count"),
        F.count_if(dispute_type()).alias("dispute_count"),
        sum_where(ok()).alias("total_revenue_cents"),
        sum_where(refund_type()).alias("total_refunds_cents"),
        F.count(F.when(ok(), amount())).alias("_paid"),
        *_score_sums("fraud"), *_score_sums("churn"),
        F.count_if(F.col("risk_level") == "high").alias("high_risk_count"),
        F.count_if(F.col("churn_risk_level") == "high").alias("high_churn_risk_count"),
        F.count_if(provider == "stripe").alias("stripe_transactions"),
        F.count_if(provider == "square").alias("square_transactions"),
        F.count_if(~provider.isin("stripe", "square")).alias("other_provider_transactions"),
        F.count_if(currency == "USD").alias("usd_transactions"),
        F.count_if(currency == "EUR").alias("eur_transactions"),
        F.count_if(currency == "GBP").alias("gbp_transactions"),
        F.count_if(method == "card").alias("card_transactions"),
        F.count_if(method == "bank_transfer").alias("bank_transfer_transactions"),
        F.count_if(~method.isin("card", "bank_transfer")).alias("other_method_transactions"),
    ], {"unique_customers": F.col("customer_id"), "unique_merchants": F.col("merchant_id")}, approx, null_keys=True)
    d = (
        g.withColumn("avg_transaction_cents", mean_cents("total_revenue_cents", "_paid"))
        .withColumn("net_revenue_cents", F.col("total_revenue_cents") - F.col("total_refunds_cents"))
    )
    total = F.col("total_transactions")
    return d.select(
        "event_date",
        "total_transactions", "successful_transactions", "failed_transactions", "refund_count",
        "dispute_count", "total_revenue_cents",
        M.cents_to_dollars(F.col("total_revenue_cents")).alias("total_revenue_dollars"),
        "total_refunds_cents",
        M.cents_to_dollars(F.col("total_refunds_cents")).alias("total_refunds_dollars"),
        "net_revenue_cents",
        M.cents_to_dollars(F.col("net_revenue_cents")).alias("net_revenue_dollars"),
        "avg_transaction_cents",
        M.cents_to_dollars(F.col("avg_transaction_cents")).alias("avg_transaction_dollars"),
        M.safe_divide(F.col("failed_transactions"), total).alias("failure_rate"),
        M.safe_divide(F.col("refund_count"), F.col("successful_transactions")).alias("refund_rate"),
        _mean("fraud").alias("avg_fraud_score"), "high_risk_count",
        M.safe_divide(F.col("high_risk_count"), total).alias("high_risk_rate"),
        _mean("churn").alias("avg_churn_score"), "high_churn_risk_count",
        "unique_customers", "unique_merchants",
        M.safe_divide(total, F.col("unique_customers")).alias("transactions_per_customer"),
        "stripe_transactions", "square_transactions", "other_provider_transactions",
        "usd_transactions", "eur_transactions", "gbp_transactions",
        "card_transactions", "bank_transfer_transactions", "other_method_transactions",
    )
