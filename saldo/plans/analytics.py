"""Dashboard models: 15-minute intervals, daily trends, customer segments and report queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saldo.functions import macros as M
from saldo.operators.grouping import aggregate
from saldo.plans.intermediate import amount, bad, ok, sum_where

PROVIDERS = ["stripe", "square", "adyen", "braintree"]


def category() -> Column:
    return F.col("event_category")


def provider() -> Column:
    return F.col("provider")


def method() -> Column:
    return F.col("payment_method_type")


def high() -> Column:
    return F.col("risk_level") == "high"


def is_bank() -> Column:
    return method().isin("bank_transfer", "us_bank_account")


def _bucketed(stg: DataFrame, edge) -> DataFrame:
    """Rows with their 15-minute bucket; from a bucket edge on (inclusive) when one is given."""
    rows = stg.filter(F.col("ingested_at").isNotNull())
    if edge is not None:
        rows = rows.filter(F.col("ingested_at") >= F.lit(edge))
    return rows.withColumn("interval_start", M.interval_15m(F.col("ingested_at"))["start"])


def _reach() -> dict[str, Column]:
    return {"unique_customers": F.col("customer_id"), "unique_merchants": F.col("merchant_id")}


def _volume(total: str, succeeded: str, failed: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias(total), F.count_if(ok()).alias(succeeded), F.count_if(bad()).alias(failed),
    ]


def _money(revenue: str, refunds: str) -> list[Column]:
    return [
        sum_where(ok()).alias(revenue),
        sum_where(category() == "refund").alias(refunds),
        F.count(F.when(ok(), amount())).alias("_paid"),
    ]


def _scores(*kinds: str) -> list[Column]:
    sums = []
    for kind in kinds:
        col = F.col(f"{kind}_score")
        sums += [F.sum(M.scaled(col)).alias(f"_{kind}_sum"), F.count(col).alias(f"_{kind}_n")]
    return sums


def _avg_score(kind: str) -> Column:
    return M.score4(F.col(f"_{kind}_sum"), F.col(f"_{kind}_n")).alias(f"avg_{kind}_score")


def _time_columns(key: str, *extra: str) -> list[Column]:
    start = F.col("interval_start")
    return [
        M.surrogate_key(start, *[F.col(c) for c in extra]).alias(key),
        start,
        (start + F.expr("INTERVAL 15 MINUTES")).alias("interval_end"),
        F.to_date(start).alias("event_date"),
        F.hour(start).alias("event_hour"),
        M.interval_label(start).alias("interval_label"),
    ]


def _dollars(cents: Column | str, name: str) -> Column:
    return M.money2(F.col(cents) if isinstance(cents, str) else cents).alias(name)


def _avg_dollars(revenue: str) -> Column:
    return M.money2(M.safe_divide(F.col(revenue), F.col("_paid"))).alias("avg_transaction_dollars")


def _pct(part: str, whole: str, name: str) -> Column:
    return F.coalesce(M.pct2(F.col(part), F.col(whole)), F.lit(0.0)).alias(name)


def _per_minute(total: str) -> Column:
    return (F.round(F.col(total) * F.lit(100.0) / 15) / 100).alias("transactions_per_minute")


def _provider_counts(suffix: str, condition: Column | None = None) -> list[Column]:
    hit = lambda p: (provider() == p) if condition is None else (condition & (provider() == p))
    return [F.count_if(hit(p)).alias(f"{p}_{suffix}") for p in PROVIDERS]


def payment_intervals(stg: DataFrame, edge=None, approx: bool = False) -> DataFrame:
    """15-minute volumes, revenue, rates, scores, reach, provider and method split."""
    g = aggregate(_bucketed(stg, edge), ["interval_start"], [
        *_volume("transaction_count", "successful_count", "failed_count"),
        F.count_if(category() == "refund").alias("refund_count"),
        F.count_if(category() == "dispute").alias("dispute_count"),
        *_money("revenue_cents", "refund_cents"),
        *_scores("fraud", "churn"),
        F.count_if(high()).alias("high_risk_count"),
        *_provider_counts("count"),
        F.count_if(method() == "card").alias("card_count"),
        F.count_if(is_bank()).alias("bank_count"),
    ], _reach(), approx)
    net = F.col("revenue_cents") - F.col("refund_cents")
    return g.select(
        *_time_columns("interval_key"),
        "transaction_count", "successful_count", "failed_count", "refund_count", "dispute_count",
        "revenue_cents", _dollars("revenue_cents", "revenue_dollars"),
        "refund_cents", _dollars("refund_cents", "refund_dollars"),
        net.alias("net_revenue_cents"), _dollars(net, "net_revenue_dollars"),
        _avg_dollars("revenue_cents"),
        _pct("successful_count", "transaction_count", "success_rate_pct"),
        _pct("failed_count", "transaction_count", "failure_rate_pct"),
        _avg_score("fraud"), "high_risk_count", _avg_score("churn"),
        "unique_customers", "unique_merchants",
        *[f"{p}_count" for p in PROVIDERS], "card_count", "bank_count",
        _per_minute("transaction_count"),
    )


def payment_summary(stg: DataFrame, edge=None, approx: bool = False) -> DataFrame:
    """15-minute headline numbers with the refund rate."""
    g = aggregate(_bucketed(stg, edge), ["interval_start"], [
        *_volume("total_transactions", "successful_transactions", "failed_transactions"),
        F.count_if(category() == "refund").alias("refunds"),
        F.count_if(category() == "dispute").alias("disputes"),
        *_money("total_revenue_cents", "total_refunds_cents"),
        *_scores("fraud"),
        F.count_if(high()).alias("high_risk_transactions"),
        *_provider_counts("transactions"),
    ], _reach(), approx)
    net = F.col("total_revenue_cents") - F.col("total_refunds_cents")
    return g.select(
        *_time_columns("interval_key"),
        "total_transactions", "successful_transactions", "failed_transactions", "refunds", "disputes",
        "total_revenue_cents", _dollars("total_revenue_cents", "total_revenue_dollars"),
        "total_refunds_cents", _dollars("total_refunds_cents", "total_refunds_dollars"),
        net.alias("net_revenue_cents"), _dollars(net, "net_revenue_dollars"),
        _avg_dollars("total_revenue_cents"),
        _pct("successful_transactions", "total_transactions", "success_rate_pct"),
        _pct("failed_transactions", "total_transactions", "failure_rate_pct"),
        _pct("refunds", "total_transactions", "refund_rate_pct"),
        _avg_score("fraud"), "high_risk_transactions", "unique_customers", "unique_merchants",
        *[f"{p}_transactions" for p in PROVIDERS],
        _per_minute("total_transactions"),
    )


def provider_comparison(stg: DataFrame, edge=None, approx: bool = False) -> DataFrame:
    """15-minute numbers per provider."""
    g = aggregate(_bucketed(stg, edge).filter(provider().isNotNull()), ["interval_start", "provider"], [
        *_volume("total_transactions", "successful_transactions", "failed_transactions"),
        F.count_if(category() == "refund").alias("refund_transactions"),
        F.count_if(category() == "dispute").alias("dispute_transactions"),
        *_money("total_revenue_cents", "total_refund_cents"),
        F.min(F.when(ok(), amount())).alias("_min"), F.max(F.when(ok(), amount())).alias("_max"),
        *_scores("fraud"),
        F.count_if(high()).alias("high_risk_transactions"),
    ], {"unique_customers": F.col("customer_id")}, approx)
    net = F.col("total_revenue_cents") - F.col("total_refund_cents")
    reach = F.when(F.col("unique_customers") != 0, F.col("unique_customers"))
    zero = F.lit(0)
    return g.select(
        *_time_columns("interval_provider_key", "provider"), "provider",
        "total_transactions", "successful_transactions", "failed_transactions",
        "refund_transactions", "dispute_transactions",
        "total_revenue_cents", _dollars("total_revenue_cents", "total_revenue_dollars"),
        "total_refund_cents", _dollars("total_refund_cents", "total_refund_dollars"),
        net.alias("net_revenue_cents"), _dollars(net, "net_revenue_dollars"),
        _avg_dollars("total_revenue_cents"),
        _dollars(F.coalesce("_min", zero), "min_transaction_dollars"),
        _dollars(F.coalesce("_max", zero), "max_transaction_dollars"),
        _pct("successful_transactions", "total_transactions", "success_rate_pct"),
        _pct("failed_transactions", "total_transactions", "failure_rate_pct"),
        _pct("refund_transactions", "total_transactions", "refund_rate_pct"),
        _pct("dispute_transactions", "total_transactions", "dispute_rate_pct"),
        _avg_score("fraud"), "high_risk_transactions",
        M.pct2(F.col("high_risk_transactions"), F.col("total_transactions")).alias("high_risk_rate_pct"),
        "unique_customers",
        (F.round(F.col("total_transactions") * F.lit(100.0) / reach) / 100).alias("transactions_per_customer"),
        _per_minute("total_transactions"),
    )


def risk_overview(stg: DataFrame, edge=None) -> DataFrame:
    """15-minute risk counts, shares, amounts and score ranges. No distinct counts, one partial aggregate."""
    levels = ["high", "medium", "low"]
    at = lambda level: F.col("risk_level") == level
    extremes = [
        agg(f"{kind}_score").alias(f"_{name}_{kind}")
        for kind in ("fraud", "churn") for name, agg in (("min", F.min), ("max", F.max))
    ]
    g = _bucketed(stg, edge).groupBy("interval_start").agg(
        *_volume("total_transactions", "successful_count", "failed_count"),
        F.coalesce(F.sum(amount()), F.lit(0)).cast("bigint").alias("total_amount_cents"),
        sum_where(ok()).alias("successful_amount_cents"),
        *[F.count_if(at(x)).alias(f"{x}_risk_count") for x in levels],
        *[sum_where(at(x)).alias(f"{x}_risk_amount_cents") for x in levels],
        *_scores("fraud", "churn"), *extremes,
        *_provider_counts("high_risk", high()),
        F.count_if(high() & (method() == "card")).alias("card_high_risk"),
        F.count_if(high() & is_bank()).alias("bank_high_risk"),
    )

    def score_columns(kind: str) -> list[Column]:
        edge_score = lambda name: F.coalesce(
            F.round(f"_{name}_{kind}", 4), F.lit(0.0)).alias(f"{name}_{kind}_score")
        return [_avg_score(kind), edge_score("min"), edge_score("max")]

    amounts = [
        c for x in levels
        for c in (F.col(f"{x}_risk_amount_cents"),
                  _dollars(f"{x}_risk_amount_cents", f"{x}_risk_amount_dollars"))
    ]
    return g.select(
        *_time_columns("interval_key"),
        "total_transactions", "successful_count", "failed_count",
        "total_amount_cents", _dollars("total_amount_cents", "total_amount_dollars"),
        "successful_amount_cents", _dollars("successful_amount_cents", "successful_amount_dollars"),
        *[f"{x}_risk_count" for x in levels],
        *[M.pct2(F.col(f"{x}_risk_count"), F.col("total_transactions")).alias(f"{x}_risk_pct") for x in levels],
        *amounts, *score_columns("fraud"), *score_columns("churn"),
        *[f"{p}_high_risk" for p in PROVIDERS], "card_high_risk", "bank_high_risk",
    )


CALENDAR = [
    "year", "quarter", "month", "week_of_year", "day_of_week", "day_name", "month_name",
    "year_month", "year_quarter", "is_weekend", "is_weekday",
]


def trend_days(fct: DataFrame, approx: bool = False) -> DataFrame:
    """One row per day of facts: what the trends need of it."""
    paid, refunded = F.col("is_successful") == 1, F.col("is_refund") == 1
    return aggregate(fct.drop("date_key").withColumnRenamed("event_date", "date_key"), ["date_key"], [
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("is_successful").alias("successful_count"),
        F.sum("is_failed").alias("failed_count"),
        F.sum("is_refund").alias("refund_count"),
        F.sum("is_dispute").alias("dispute_count"),
        sum_where(paid).alias("revenue_cents"),
        sum_where(refunded).alias("refund_cents"),
        F.count(F.when(paid, amount())).alias("_paid"),
        *_scores("fraud", "churn"),
        F.count_if(F.col("fraud_risk_category") == "high").alias("high_risk_count"),
        F.count_if(method() == "card").alias("card_transactions"),
        F.count_if(method() == "bank_transfer").alias("bank_transactions"),
        F.count_if(provider() == "stripe").alias("stripe_transactions"),
        F.count_if(provider() == "square").alias("square_transactions"),
    ], _reach(), approx)


def payment_trends(fct: DataFrame, calendar: DataFrame, as_of, approx: bool = False, start: str = "2024-01-01") -> DataFrame:
    return trends_of(trend_days(fct, approx), calendar, as_of, start)


def trends_of(daily: DataFrame, calendar: DataFrame, as_of, start: str = "2024-01-01") -> DataFrame:
    """Zero-filled daily series from `start` to `as_of`, with running revenue and 7-row moving averages.

    The ordered windows have no partition key, so they see one task: their input is one row per
    calendar day (at most a few thousand), because the events are aggregated before the join.
    """
    days = calendar.filter(
        (F.col("date_key") >= F.lit(start).cast("date"))
        & (F.col("date_key") <= F.to_date(F.lit(as_of)))
    ).select("date_key", *CALENDAR)
    counts = [c for c in daily.columns if c != "date_key"]
    j = days.join(daily, "date_key", "left").select(
        "date_key", *CALENDAR, *[F.coalesce(c, F.lit(0)).alias(c) for c in counts]
    )
    ordered = Window.orderBy("date_key")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    week = ordered.rowsBetween(-6, Window.currentRow)
    net = F.col("revenue_cents") - F.col("refund_cents")
    return j.select(
        M.surrogate_key(F.col("date_key")).alias("trend_key"), "date_key", *CALENDAR,
        "transaction_count", "successful_count", "failed_count", "refund_count", "dispute_count",
        "revenue_cents", _dollars("revenue_cents", "revenue_dollars"),
        "refund_cents", _dollars("refund_cents", "refund_dollars"),
        net.alias("net_revenue_cents"), _dollars(net, "net_revenue_dollars"),
        _avg_dollars("revenue_cents"),
        _pct("successful_count", "transaction_count", "success_rate_pct"),
        _pct("failed_count", "transaction_count", "failure_rate_pct"),
        _avg_score("fraud"), "high_risk_count", _avg_score("churn"),
        "unique_customers", "unique_merchants", "card_transactions", "bank_transactions",
        "stripe_transactions", "square_transactions",
        F.sum("revenue_cents").over(so_far).alias("cumulative_revenue_cents"),
        F.avg("transaction_count").over(week).alias("ma7_transaction_count"),
        F.avg("revenue_cents").over(week).alias("ma7_revenue_cents"),
    )


def customer_segments(customers: DataFrame) -> DataFrame:
    """Four segmentations and their share of the totals, from one pass over the customers.

    The customers are first reduced to one row per combination of the four segment columns (a few
    dozen rows); grouping sets over that small frame give every segmentation and the grand total.
    """
    dims = {
        "tier": "customer_tier", "fraud_risk": "fraud_risk_category",
        "churn_risk": "churn_risk_category", "payment_method": "preferred_payment_method",
    }
    names = list(dims.values())
    combos = customers.groupBy(*names).agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("total_revenue_cents").alias("revenue"),
        F.sum("total_transactions").alias("transactions"),
        F.sum("failure_rate").alias("failure"), F.count("failure_rate").alias("failure_n"),
        F.sum("avg_fraud_score").alias("fraud"), F.count("avg_fraud_score").alias("fraud_n"),
        F.sum("avg_churn_score").alias("churn"), F.count("avg_churn_score").alias("churn_n"),
    )
    sums = [c for c in combos.columns if c not in names]
    cols = [F.col(c) for c in names]
    sets = combos.groupingSets([[c] for c in cols] + [[]], *cols).agg(
        F.grouping_id().alias("gid"), *[F.sum(c).alias(c) for c in sums]
    )
    everything = 2 ** len(names) - 1
    gids = {kind: everything - 2 ** (len(names) - 1 - i) for i, kind in enumerate(dims)}
    segment = F.coalesce(*[F.when(F.col("gid") == g, kind) for kind, g in gids.items()])
    value = F.coalesce(*[F.when(F.col("gid") == gids[kind], F.col(c)) for kind, c in dims.items()])
    totals = Window.partitionBy()
    all_rows = F.col("gid") == everything
    tagged = sets.select(
        segment.alias("segment_type"), value.alias("segment_value"), *sums,
        F.max(F.when(all_rows, F.col("customers"))).over(totals).alias("all_customers"),
        F.max(F.when(all_rows, F.col("revenue"))).over(totals).alias("all_revenue"),
    )
    kind = F.col("segment_type")
    tier = kind == "tier"
    mean = lambda s: F.col(s) / F.when(F.col(f"{s}_n") != 0, F.col(f"{s}_n"))
    per_customer = F.col("revenue") / F.col("customers")
    return tagged.filter(
        kind.isNotNull() & ((kind != "payment_method") | F.col("segment_value").isNotNull())
    ).select(
        kind, "segment_value",
        F.col("customers").alias("customer_count"),
        M.pct2(F.col("customers"), F.col("all_customers")).alias("customer_pct"),
        F.col("revenue").alias("segment_revenue_cents"),
        _dollars("revenue", "segment_revenue_dollars"),
        M.pct2(F.col("revenue"), F.col("all_revenue")).alias("revenue_pct"),
        F.when(tier, M.money2(per_customer)).alias("avg_revenue_per_customer_dollars"),
        F.when(tier, F.round(F.col("transactions") * F.lit(10.0) / F.col("customers")) / 10)
        .alias("avg_transactions_per_customer"),
        F.when(tier, F.round(mean("failure") * 100, 2)).alias("avg_failure_rate_pct"),
        F.when(kind.isin("tier", "fraud_risk"), F.round(mean("fraud"), 4)).alias("avg_fraud_score"),
        F.when(kind.isin("tier", "churn_risk"), F.round(mean("churn"), 4)).alias("avg_churn_score"),
    )


# --- report queries -----------------------------------------------------------------------------

def provider_performance(charges: DataFrame) -> DataFrame:
    total = F.sum("amount")
    return charges.groupBy("provider", "status").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.avg("amount").alias("avg_amount"), total.alias("total_amount"),
    ).orderBy(F.desc("total_amount"))


def refund_analytics(refunds: DataFrame) -> DataFrame:
    return refunds.groupBy("provider", "reason").agg(
        F.count(F.lit(1)).alias("refund_count"), F.sum("amount").alias("total_refunded"),
    ).orderBy(F.desc("total_refunded"))


def dispute_patterns(disputes: DataFrame) -> DataFrame:
    return disputes.groupBy("provider", "status", "reason").agg(
        F.count(F.lit(1)).alias("dispute_count"), F.sum("amount").alias("total_disputed"),
    ).orderBy(F.desc("dispute_count"))


def recent(df: DataFrame, ts: str, n: int = 10, tie_breaker: str = "event_id") -> DataFrame:
    """Latest n rows: a top-k per task, merged, no global sort."""
    return df.orderBy(F.desc(ts), F.col(tie_breaker)).limit(n)


def rejection_counts(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("rejected"))


# Provider type -> documented outcome label.
OUTCOMES = {"charge.succeeded": "SUCCESS", "charge.failed": "FAILED"}
SQUARE_OUTCOMES = {"COMPLETED": "SUCCESS", "FAILED": "FAILED"}


def _outcome(column: Column, table: dict[str, str]) -> Column:
    hits = [F.when(column == raw, label) for raw, label in table.items()]
    return F.coalesce(*hits, F.lit("OTHER"))


def unified_payments(stripe: DataFrame, square: DataFrame, loaded_until=None) -> DataFrame:
    """Two provider tables in one shape, past the high-water mark when one is given."""
    left = stripe.select(
        F.col("event_id").alias("transaction_id"), F.lit("stripe").alias("provider"),
        F.col("type").alias("event_type"), F.col("created").alias("transaction_timestamp"),
        M.money2(F.col("amount_cents")).alias("amount_dollars"),
        F.upper("currency").alias("currency_code"), "customer_id",
        _outcome(F.col("type"), OUTCOMES).alias("normalized_status"),
        F.col("failure_code").alias("failure_reason"),
    )
    right = square.select(
        F.col("payment_id").alias("transaction_id"), F.lit("square").alias("provider"),
        F.col("status").alias("event_type"), F.col("created_at").alias("transaction_timestamp"),
        "amount_dollars", F.upper("currency").alias("currency_code"),
        F.col("buyer_email").alias("customer_id"),
        _outcome(F.col("status"), SQUARE_OUTCOMES).alias("normalized_status"),
        F.col("card_status").alias("failure_reason"),
    )
    both = left.unionByName(right)
    if loaded_until is None:
        return both
    return both.filter(F.col("transaction_timestamp") > F.lit(loaded_until))


def customer_clv(payments: DataFrame) -> DataFrame:
    """Lifetime value, success rate and value segment per customer."""
    kind = F.col("event_type")
    g = payments.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_payments"),
        F.count_if(kind == "charge.succeeded").alias("successful_payments"),
        F.count_if(kind == "charge.failed").alias("failed_payments"),
        F.sum("amount_cents").alias("_cents"), F.count("amount_cents").alias("_n"),
        F.max("provider_created_at").alias("last_payment_date"),
    )
    value = F.col("_cents") / F.lit(100.0)
    return g.select(
        "customer_id", "total_payments", "successful_payments", "failed_payments",
        (F.col("successful_payments") / F.when(F.col("total_payments") != 0, F.col("total_payments")))
        .alias("success_rate"),
        value.alias("lifetime_value"),
        (F.col("_cents") / F.when(F.col("_n") != 0, F.col("_n")) / 100).alias("avg_payment_amount"),
        "last_payment_date",
        F.when(value > 10000, "high").when(value > 1000, "medium").otherwise("low").alias("clv_segment"),
    )


def hourly_success_metrics(payments: DataFrame, as_of, hours: int = 1) -> DataFrame:
    """Totals of the last hour before as_of."""
    now = F.lit(as_of).cast("timestamp")
    start = now - F.make_dt_interval(hours=F.lit(hours))
    kind = F.col("event_type")
    return payments.filter((F.col("provider_created_at") > start) & (F.col("provider_created_at") <= now)).agg(
        F.count(F.lit(1)).alias("total_payments"),
        F.count_if(kind == "charge.succeeded").alias("successful"),
        F.count_if(kind == "charge.failed").alias("failed"),
        (F.sum("amount_cents") / F.count("amount_cents") / 100).alias("avg_amount"),
    )


def parent_child_counts(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str,
                        child_id: str, label: str) -> DataFrame:
    """Children per parent label, 0 when none. Children are counted before the join, so a parent
    with very many children contributes one row to it."""
    per_parent = children.groupBy(F.col(child_key).alias(parent_key)).agg(
        F.count(child_id).alias("_children"))
    joined = parents.join(per_parent, parent_key, "left")
    return joined.groupBy(label).agg(
        F.sum(F.coalesce("_children", F.lit(0))).alias("child_count")
    ).orderBy(F.desc("child_count"))
