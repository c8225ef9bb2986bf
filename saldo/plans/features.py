"""Feature tables, feature views and services, and feature lookups."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saldo.functions import macros as M
from saldo.operators.grouping import distinct_counts
from saldo.operators.sequences import next_value, point_in_time_join, ranges
from saldo.plans.intermediate import amount, bad, ok

CUSTOMER_TYPES = {
    "total_payments_30d": "bigint", "total_payments_90d": "bigint",
    "total_amount_cents_30d": "bigint", "avg_amount_cents": "float",
    "failed_payments_30d": "bigint", "failure_rate_30d": "float", "consecutive_failures": "bigint",
    "recovered_payments_30d": "bigint", "recovery_rate_30d": "float",
    "days_since_first_payment": "bigint", "days_since_last_payment": "bigint",
    "days_since_last_failure": "bigint", "payment_method_count": "bigint",
    "has_backup_payment_method": "bigint", "fraud_score_avg": "float",
    "high_risk_payment_count": "bigint",
}
PROFILE_TYPES = {"customer_tier": "string", "subscription_age_days": "bigint", "account_age_days": "bigint"}
MERCHANT_TYPES = {
    "total_transactions_30d": "bigint", "total_volume_cents_30d": "bigint",
    "unique_customers_30d": "bigint", "avg_transaction_amount": "float",
    "failure_rate_30d": "float", "dispute_rate_30d": "float", "refund_rate_30d": "float",
    "chargeback_rate_30d": "float", "fraud_rate_30d": "float",
    "high_risk_transaction_pct": "float", "merchant_health_score": "float",
}
CUSTOMER_COLUMNS = ["customer_id", "feature_timestamp", *CUSTOMER_TYPES, *PROFILE_TYPES]
MERCHANT_COLUMNS = ["merchant_id", "feature_timestamp", *MERCHANT_TYPES]


def feat_customer(metrics: DataFrame, as_of) -> DataFrame:
    """Customer features as the source models them: all-time values under 30/90-day names."""
    col, zero = F.col, F.lit(0)
    tenure = F.coalesce("customer_tenure_days", zero)
    values = {
        "total_payments_30d": col("total_transactions"),
        "total_payments_90d": col("total_transactions"),
        "total_amount_cents_30d": col("total_revenue_cents"),
        "avg_amount_cents": col("avg_transaction_cents"),
        "failed_payments_30d": col("failed_transactions"),
        "failure_rate_30d": col("failure_rate"),
        "consecutive_failures": col("failed_transactions"),
        "recovered_payments_30d": col("successful_transactions") - col("failed_transactions"),
        "recovery_rate_30d": F.lit(1.0) - col("failure_rate"),
        "days_since_first_payment": tenure,
        "days_since_last_payment": zero,
        "days_since_last_failure": tenure,
        "payment_method_count": col("provider_count"),
        "has_backup_payment_method": F.when(col("provider_count") > 1, 1).otherwise(0),
        "fraud_score_avg": F.coalesce("avg_fraud_score", F.lit(0.0)),
        "high_risk_payment_count": F.coalesce("high_risk_transaction_count", zero),
        "customer_tier": col("customer_tier"),
        "subscription_age_days": col("customer_tenure_days"),
        "account_age_days": col("customer_tenure_days"),
    }
    types = {**CUSTOMER_TYPES, **PROFILE_TYPES}
    return metrics.filter(col("customer_id").isNotNull()).select(
        "customer_id", F.lit(as_of).cast("timestamp").alias("feature_timestamp"),
        *[values[n].cast(t).alias(n) for n, t in types.items()],
    )


def feat_merchant(metrics: DataFrame, as_of) -> DataFrame:
    """Merchant features; the chargeback rate stands in as the dispute rate."""
    col = F.col
    values = {
        "total_transactions_30d": col("total_transactions"),
        "total_volume_cents_30d": col("total_revenue_cents"),
        "unique_customers_30d": col("unique_customers"),
        "avg_transaction_amount": col("avg_transaction_cents"),
        "failure_rate_30d": col("failure_rate"),
        "dispute_rate_30d": col("dispute_rate"),
        "refund_rate_30d": col("refund_rate"),
        "chargeback_rate_30d": col("dispute_rate"),
        "fraud_rate_30d": F.coalesce("avg_fraud_score", F.lit(0.0)),
        "high_risk_transaction_pct": F.coalesce("high_risk_rate", F.lit(0.0)),
        "merchant_health_score": col("health_score"),
    }
    return metrics.filter(col("merchant_id").isNotNull()).select(
        "merchant_id", F.lit(as_of).cast("timestamp").alias("feature_timestamp"),
        *[values[n].cast(t).alias(n) for n, t in MERCHANT_TYPES.items()],
    )


def _by_range(stg: DataFrame, now: Column, parts: int | None) -> DataFrame:
    """Partial aggregates of each customer and range of rows, from one scan and without a shuffle after the ranges'.

    Rows of a range are ordered once, newest first. What depends on the customer's rows in other ranges is left open: whether
    its last row, a failure, is followed by a success, and whether its failures after its last other row are the last ones.
    """
    at, failed = F.col("provider_created_at"), F.coalesce(bad(), F.lit(False))
    last30, last90 = (at > now - F.expr(f"INTERVAL {days} DAYS") for days in (30, 90))
    newest_first = Window.partitionBy("_part", "customer_id").orderBy(at.desc(), F.col("event_id").desc())
    used = stg.select("customer_id", at, "event_id", "status", "amount_cents", "fraud_score", "risk_level")
    rows = ranges(used, ["customer_id", "provider_created_at", "event_id"], parts).withColumns({
        "_next": F.lag(F.struct(F.col("status").alias("v"))).over(newest_first),
        "_later_others": F.count_if(~failed).over(newest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    })
    no_next = F.col("_next").isNull()
    paid = F.when(last30 & ok(), amount())
    return rows.groupBy("_part", "customer_id").agg(
        F.count_if(last30 & bad() & (F.col("_next.v") == "succeeded")).alias("_recovered"),
        F.count_if(last30 & bad() & no_next).alias("_open"),
        F.min_by(F.struct(F.col("status").alias("v")), F.struct(at, F.col("event_id"))).alias("_first_status"),
        F.count_if(~failed).alias("_others"),
        F.count_if(failed & (F.col("_later_others") == 0)).alias("_tail"),
        F.count_if(last30).alias("total_payments_30d"),
        F.count_if(last90).alias("total_payments_90d"),
        F.coalesce(F.sum(paid), F.lit(0).cast("bigint")).alias("total_amount_cents_30d"),
        F.count(paid).alias("_paid"),
        F.count_if(last30 & bad()).alias("failed_payments_30d"),
        F.min(at).alias("_first"), F.max(at).alias("_last"), F.max(F.when(bad(), at)).alias("_last_bad"),
        F.sum(F.when(last30, M.scaled(F.col("fraud_score")))).alias("_fraud_sum"),
        F.count(F.when(last30, F.col("fraud_score"))).alias("_fraud_n"),
        F.count_if(last30 & (F.col("risk_level") == "high")).alias("high_risk_payment_count"),
    )


def feat_customer_windowed(stg: DataFrame, as_of, parts: int | None = None) -> DataFrame:
    """The declared meaning of the customer features: true windows ending at as_of.

    A failure counts as recovered when the customer's next event succeeded; the streak counts the
    failures after the customer's last event that did not fail. Rows are cut into even ranges of (customer, time,
    event), and a customer's rows are reduced to one per range before they are put in order.
    """
    now = F.lit(as_of).cast("timestamp")
    at = F.col("provider_created_at")
    seen = stg.filter(F.col("customer_id").isNotNull() & (at <= now))
    cut = _by_range(seen, now, parts)
    newest_first = Window.partitionBy("customer_id").orderBy(F.col("_part").desc())
    cut = cut.withColumns({
        "_after": F.lag("_first_status").over(newest_first),
        "_later": F.coalesce(F.sum("_others").over(newest_first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    })
    added = ["total_payments_30d", "total_payments_90d", "total_amount_cents_30d", "_paid", "failed_payments_30d",
             "_fraud_sum", "_fraud_n", "high_risk_payment_count"]
    types = {f.name: f.dataType for f in cut.schema.fields}
    g = cut.groupBy("customer_id").agg(
        F.sum(F.col("_recovered") + F.when(F.col("_after.v") == "succeeded", F.col("_open")).otherwise(0)).alias("recovered_payments_30d"),
        F.coalesce(F.sum(F.when(F.col("_later") == 0, F.col("_tail"))), F.lit(0)).alias("consecutive_failures"),
        *[F.sum(c).cast(types[c]).alias(c) for c in added],
        F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.max("_last_bad").alias("_last_bad"),
    )
    methods = distinct_counts(
        seen.filter(at > now - F.expr("INTERVAL 90 DAYS")), ["customer_id"], {"payment_method_count": F.col("payment_method_type")})
    g = g.join(methods, "customer_id", "left").withColumn("payment_method_count", F.coalesce("payment_method_count", F.lit(0)))
    recovered = F.col("recovered_payments_30d")
    days = lambda since: M.whole_days(F.col(since), now)
    values = {
        **{n: F.col(n) for n in CUSTOMER_TYPES if n in g.columns},
        "avg_amount_cents": M.safe_divide(F.col("total_amount_cents_30d"), F.col("_paid")),
        "failure_rate_30d": M.safe_divide(F.col("failed_payments_30d"), F.col("total_payments_30d")),
        "recovery_rate_30d": M.safe_divide(recovered, F.col("failed_payments_30d")),
        "days_since_first_payment": days("_first"),
        "days_since_last_payment": days("_last"),
        "days_since_last_failure": days("_last_bad"),
        "has_backup_payment_method": F.when(F.col("payment_method_count") > 1, 1).otherwise(0),
        "fraud_score_avg": F.coalesce(M.mean_score(F.col("_fraud_sum"), F.col("_fraud_n")), F.lit(0.0)),
    }
    return g.select(
        "customer_id", now.alias("feature_timestamp"),
        *[values[n].cast(t).alias(n) for n, t in CUSTOMER_TYPES.items()],
    )


@dataclass(frozen=True)
class FeatureView:
    """Declared feature table: entity, time to live and typed fields."""

    name: str
    entity: str
    ttl_seconds: int
    fields: dict = field(default_factory=dict)
    ts_col: str = "feature_timestamp"

    def read(self, source: DataFrame, as_of=None) -> DataFrame:
        """Projected and typed rows; with as_of, only those still alive then."""
        rows = source
        if as_of is not None:
            now = F.lit(as_of).cast("timestamp")
            ts = F.col(self.ts_col)
            oldest = now - F.make_dt_interval(secs=F.lit(self.ttl_seconds))
            rows = rows.filter((ts > oldest) & (ts <= now))
        return rows.select(
            self.entity, self.ts_col, *[F.col(n).cast(t).alias(n) for n, t in self.fields.items()])


DAY = 86_400
CUSTOMER_PAYMENT = FeatureView("customer_payment_features", "customer_id", DAY, CUSTOMER_TYPES)
CUSTOMER_PROFILE = FeatureView("customer_profile_features", "customer_id", 7 * DAY, PROFILE_TYPES)
MERCHANT_PAYMENT = FeatureView("merchant_payment_features", "merchant_id", DAY, MERCHANT_TYPES)


@dataclass(frozen=True)
class FeatureService:
    """A named selection of features over several views."""

    name: str
    picks: tuple


FRAUD_SERVICE = FeatureService("fraud_detection", (
    (CUSTOMER_PAYMENT, ["total_payments_30d", "failure_rate_30d", "fraud_score_avg",
                        "high_risk_payment_count", "days_since_first_payment"]),
    (MERCHANT_PAYMENT, ["fraud_rate_30d", "high_risk_transaction_pct", "merchant_health_score"]),
))
CHURN_SERVICE = FeatureService("churn_prediction", (
    (CUSTOMER_PAYMENT, ["total_payments_30d", "total_payments_90d", "failure_rate_30d",
                        "consecutive_failures", "recovery_rate_30d", "days_since_first_payment",
                        "days_since_last_payment", "days_since_last_failure",
                        "payment_method_count", "has_backup_payment_method"]),
    (CUSTOMER_PROFILE, ["customer_tier", "subscription_age_days"]),
))
RETRY_SERVICE = FeatureService("retry_optimization", (
    (CUSTOMER_PAYMENT, ["failure_rate_30d", "consecutive_failures", "recovery_rate_30d"]),
    (MERCHANT_PAYMENT, ["failure_rate_30d"]),
))


def latest_features(entities: DataFrame, view: FeatureView, source: DataFrame, as_of,
                    names: list[str] | None = None, prefix: str = "") -> DataFrame:
    """Newest live feature row per entity, NULLs where there is none."""
    names = names or list(view.fields)
    newest = view.read(source, as_of).groupBy(view.entity).agg(
        F.max_by(F.struct(*names), view.ts_col).alias("_f"))
    return entities.join(newest, view.entity, "left").select(
        *entities.columns, *[F.col("_f")[n].alias(prefix + n) for n in names])


def service_features(entities: DataFrame, service: FeatureService, sources: dict, as_of) -> DataFrame:
    """All features of a service. A name used by two views gets its view's name as prefix."""
    every = [n for _, names in service.picks for n in names]
    result = entities
    for view, names in service.picks:
        clash = [n for n in names if every.count(n) > 1]
        renamed = {n: f"{view.name}__{n}" if n in clash else n for n in names}
        newest = view.read(sources[view.name], as_of).groupBy(view.entity).agg(
            F.max_by(F.struct(*names), view.ts_col).alias("_f"))
        keep = result.columns
        result = result.join(newest, view.entity, "left").select(
            *keep, *[F.col("_f")[n].alias(renamed[n]) for n in names])
    return result


def historical_features(labels: DataFrame, label_ts: str, view: FeatureView, source: DataFrame) -> DataFrame:
    """Point-in-time features for training labels."""
    return point_in_time_join(
        labels, view.read(source), view.entity, label_ts, view.ts_col, list(view.fields), view.ttl_seconds)


def retry_label(stg: DataFrame) -> DataFrame:
    """For every failed charge: did the customer's next event succeed?

    The next event is looked up before failed charges are selected, so successes can be seen.
    """
    rows = stg.filter(F.col("customer_id").isNotNull()).select(
        "event_id", "customer_id", "event_type", "status", "failure_code", "amount_cents", "currency",
        "provider_created_at")
    nxt = next_value(rows, "customer_id", "provider_created_at", "event_id", "status", "_next_status")
    return nxt.filter(F.col("status") == "failed").select(
        "event_id", "customer_id", "failure_code", "amount_cents", "currency",
        F.col("_next_status").eqNullSafe(F.lit("succeeded")).alias("retry_succeeded"))
