"""The same results as plain SQL over the driver's tables, for an independent engine.

Dates and times are printed as text, as the Spark side does. Rounded values divide exact integers
once, so both engines reach the same double.
"""

from __future__ import annotations

from saldo import constants as C
from workload import adapters as W
from workload.content import CONTENT, LATER

ORACLES: dict[str, str] = {}

AS_OF = f"TIMESTAMP '{W.AS_OF}'"


def ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def ratio(n: str, d: str) -> str:
    return f"CASE WHEN coalesce({d}, 0) = 0 THEN 0e0 ELSE CAST({n} AS DOUBLE) / ({d}) END"


def pct(n: str, d: str) -> str:
    return f"round(({n}) * 1e4 / nullif({d}, 0)) / 100"


def money(x: str) -> str:
    return f"round(CAST({x} AS DOUBLE)) / 100"


def dollars(x: str) -> str:
    """Cents to a two-decimal amount, by way of two-decimal cents."""
    return f"CAST(round(CAST({x} AS DECIMAL(18,2)), 0) AS DOUBLE) / 100"


def mean(col: str) -> str:
    return f"CAST(sum(CAST(round({col} * 10000) AS BIGINT)) AS DOUBLE) / nullif(count({col}), 0) / 10000"


def mean4(col: str) -> str:
    return f"coalesce(round(CAST(sum(CAST(round({col} * 10000) AS BIGINT)) AS DOUBLE) / nullif(count({col}), 0)) / 10000, 0e0)"


def n(cond: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT)"


def cents(cond: str) -> str:
    return f"CAST(coalesce(sum(amount_cents) FILTER (WHERE {cond}), 0) AS BIGINT)"


PE = f"pe AS ({W.BRONZE_SQL.format(events='events')})"
WH = f"w AS ({W.WEBHOOK_SQL.format(events='events')})"
CATEGORY = """CASE WHEN event_type LIKE '%charge%' OR event_type LIKE '%payment%succeeded%' THEN 'charge'
  WHEN event_type LIKE '%refund%' THEN 'refund' WHEN event_type LIKE '%dispute%' {extra} THEN 'dispute'
  WHEN event_type LIKE '%subscription%' THEN 'subscription' WHEN event_type LIKE '%failed%' THEN 'failed_payment' ELSE 'other' END"""
STG = f"""{PE}, stg AS (SELECT *, CAST(NULL AS VARCHAR) AS failure_message, CAST(NULL AS VARCHAR) AS retry_strategy,
  CAST(NULL AS BIGINT) AS retry_delay_seconds, CAST(NULL AS VARCHAR) AS validation_errors,
  {CATEGORY.format(extra='')} AS event_category FROM pe)"""
FRAUD = lambda s: f"CASE WHEN {s} >= 0.7e0 THEN 'high' WHEN {s} >= 0.3e0 THEN 'medium' ELSE 'low' END"
CHURN3 = lambda s: f"CASE WHEN {s} >= 0.6e0 THEN 'high' WHEN {s} >= 0.3e0 THEN 'medium' ELSE 'low' END"
CHURN4 = lambda s: f"CASE WHEN {s} >= 0.75e0 THEN 'critical' WHEN {s} >= 0.5e0 THEN 'high' WHEN {s} >= 0.25e0 THEN 'medium' ELSE 'low' END"
TIER = lambda c: f"CASE WHEN {c} >= 100000 THEN 'platinum' WHEN {c} >= 50000 THEN 'gold' WHEN {c} >= 10000 THEN 'silver' ELSE 'bronze' END"
PROFILE = lambda r: f"CASE WHEN {r} >= 0.15e0 THEN 'high_risk' WHEN {r} >= 0.05e0 THEN 'medium_risk' ELSE 'low_risk' END"
HEALTH = lambda s: f"CASE WHEN {s} >= 90 THEN 'excellent' WHEN {s} >= 70 THEN 'good' WHEN {s} >= 50 THEN 'fair' ELSE 'poor' END"
KEY = lambda *c: "md5(" + " || '-' || ".join(f"coalesce(CAST({x} AS VARCHAR), '')" for x in c) + ")"

# --- relational models ----------------------------------------------------------------------------

BRONZE_COLUMNS = [
    "event_id", "provider", "provider_event_id", "event_type", "customer_id", "merchant_id", "amount_cents",
    "currency", "payment_method_type", "card_brand", "card_last_four", "status", "failure_code", "failure_message",
    "fraud_score", "risk_level", "churn_score", "churn_risk_level", "retry_strategy", "retry_delay_seconds",
    "days_to_churn_estimate", "validation_status", "validation_errors", "provider_created_at", "processed_at",
    "ingested_at", "metadata", "schema_version",
]
BRONZE_OUT = ", ".join(
    f"{ts(c)} AS {c}" if c in ("provider_created_at", "processed_at", "ingested_at") else c for c in BRONZE_COLUMNS)

ORACLES["m01_stg_payment_events"] = f"WITH {STG} SELECT {BRONZE_OUT}, event_category FROM stg"


def customer_metrics(source: str = "stg", name: str = "cm") -> str:
    return f"""{name}_a AS (SELECT customer_id, count(*) AS total_transactions,
  {n("status = 'succeeded'")} AS successful_transactions, {n("status = 'failed'")} AS failed_transactions,
  {n("status = 'refunded' OR event_type LIKE '%refund%'")} AS refunded_transactions,
  {cents("status = 'succeeded'")} AS total_revenue_cents,
  count(CASE WHEN status = 'succeeded' THEN amount_cents END) AS paid,
  coalesce(max(CASE WHEN status = 'succeeded' THEN amount_cents END), 0) AS max_transaction_cents,
  coalesce(min(CASE WHEN status = 'succeeded' THEN amount_cents END), 0) AS min_transaction_cents,
  {mean('fraud_score')} AS avg_fraud_score, max(fraud_score) AS max_fraud_score,
  {n("risk_level = 'high'")} AS high_risk_transaction_count,
  {mean('churn_score')} AS avg_churn_score, max(churn_score) AS max_churn_score,
  min(days_to_churn_estimate) AS min_days_to_churn, min(payment_method_type) AS preferred_payment_method,
  min(card_brand) AS preferred_card_brand, min(currency) AS preferred_currency,
  min(provider_created_at) AS first_at, max(provider_created_at) AS last_at,
  count(DISTINCT CAST(provider_created_at AS DATE)) AS active_days, count(DISTINCT provider) AS provider_count,
  count(DISTINCT merchant_id) AS merchant_count
  FROM {source} WHERE customer_id IS NOT NULL GROUP BY customer_id),
{name}_b AS (SELECT *, {ratio('total_revenue_cents', 'paid')} AS avg_transaction_cents,
  {ratio('failed_transactions', 'total_transactions')} AS failure_rate FROM {name}_a),
{name} AS (SELECT customer_id, total_transactions, successful_transactions, failed_transactions, refunded_transactions,
  total_revenue_cents, {dollars('total_revenue_cents')} AS total_revenue_dollars, avg_transaction_cents,
  {dollars('avg_transaction_cents')} AS avg_transaction_dollars, max_transaction_cents, min_transaction_cents, failure_rate,
  {PROFILE('failure_rate')} AS payment_risk_profile, avg_fraud_score, max_fraud_score, high_risk_transaction_count,
  {FRAUD('avg_fraud_score')} AS fraud_risk_category, avg_churn_score, max_churn_score, min_days_to_churn,
  {CHURN3('avg_churn_score')} AS churn_risk_category, preferred_payment_method, preferred_card_brand, preferred_currency,
  {TIER('total_revenue_cents')} AS customer_tier, first_at, last_at, active_days,
  date_sub('day', first_at, last_at) AS customer_tenure_days, provider_count, merchant_count FROM {name}_b)"""


CM = f"{STG}, {customer_metrics()}"
ORACLES["m02_customer_metrics"] = f"""WITH {CM} SELECT * EXCLUDE (first_at, last_at),
  {ts('first_at')} AS first_transaction_at, {ts('last_at')} AS last_transaction_at FROM cm"""


def merchant_metrics(source: str = "stg", name: str = "mm") -> str:
    return f"""{name}_a AS (SELECT merchant_id, count(*) AS total_transactions,
  {n("status = 'succeeded'")} AS successful_transactions, {n("status = 'failed'")} AS failed_transactions,
  {n("event_type LIKE '%refund%'")} AS refund_count,
  {n("event_type LIKE '%dispute%' OR event_type LIKE '%chargeback%'")} AS dispute_count,
  {cents("status = 'succeeded'")} AS total_revenue_cents, {cents("event_type LIKE '%refund%'")} AS total_refunds_cents,
  count(CASE WHEN status = 'succeeded' THEN amount_cents END) AS paid, {mean('fraud_score')} AS avg_fraud_score,
  {n("risk_level = 'high'")} AS high_risk_transaction_count, count(DISTINCT customer_id) AS unique_customers,
  count(DISTINCT provider) AS provider_count, min(provider) AS primary_provider, count(DISTINCT currency) AS currency_count,
  min(currency) AS primary_currency, min(provider_created_at) AS first_at, max(provider_created_at) AS last_at,
  count(DISTINCT CAST(provider_created_at AS DATE)) AS active_days
  FROM {source} WHERE merchant_id IS NOT NULL GROUP BY merchant_id),
{name}_b AS (SELECT *, {ratio('total_revenue_cents', 'paid')} AS avg_transaction_cents,
  total_revenue_cents - total_refunds_cents AS net_revenue_cents,
  {ratio('failed_transactions', 'total_transactions')} AS failure_rate,
  {ratio('refund_count', 'successful_transactions')} AS refund_rate,
  {ratio('dispute_count', 'successful_transactions')} AS dispute_rate FROM {name}_a),
{name}_c AS (SELECT *, greatest(0e0, least(1e2, 1e2 - (dispute_rate * 400 + refund_rate * 300 + failure_rate * 300))) AS health_score FROM {name}_b),
{name} AS (SELECT merchant_id, total_transactions, successful_transactions, failed_transactions, refund_count, dispute_count,
  total_revenue_cents, {dollars('total_revenue_cents')} AS total_revenue_dollars, total_refunds_cents,
  {dollars('total_refunds_cents')} AS total_refunds_dollars, avg_transaction_cents,
  {dollars('avg_transaction_cents')} AS avg_transaction_dollars, net_revenue_cents,
  {dollars('net_revenue_cents')} AS net_revenue_dollars, failure_rate, refund_rate, dispute_rate, health_score,
  {HEALTH('health_score')} AS health_category, avg_fraud_score, high_risk_transaction_count,
  {ratio('high_risk_transaction_count', 'total_transactions')} AS high_risk_rate,
  {FRAUD('avg_fraud_score')} AS fraud_risk_category, unique_customers,
  {ratio('total_transactions', 'unique_customers')} AS transactions_per_customer, provider_count, primary_provider,
  currency_count, primary_currency, first_at, last_at, active_days,
  date_sub('day', first_at, last_at) AS merchant_tenure_days FROM {name}_c)"""


MM = f"{STG}, {merchant_metrics()}"
ORACLES["m03_merchant_metrics"] = f"""WITH {MM} SELECT * EXCLUDE (first_at, last_at),
  {ts('first_at')} AS first_transaction_at, {ts('last_at')} AS last_transaction_at FROM mm"""


def daily_summary(source: str = "stg") -> str:
    return f"""ds_a AS (SELECT CAST(provider_created_at AS DATE) AS event_date, count(*) AS total_transactions,
  {n("status = 'succeeded'")} AS successful_transactions, {n("status = 'failed'")} AS failed_transactions,
  {n("event_type LIKE '%refund%'")} AS refund_count, {n("event_type LIKE '%dispute%'")} AS dispute_count,
  {cents("status = 'succeeded'")} AS total_revenue_cents, {cents("event_type LIKE '%refund%'")} AS total_refunds_cents,
  count(CASE WHEN status = 'succeeded' THEN amount_cents END) AS paid,
  {mean('fraud_score')} AS avg_fraud_score, {n("risk_level = 'high'")} AS high_risk_count,
  {mean('churn_score')} AS avg_churn_score, {n("churn_risk_level = 'high'")} AS high_churn_risk_count,
  count(DISTINCT customer_id) AS unique_customers, count(DISTINCT merchant_id) AS unique_merchants,
  {n("provider = 'stripe'")} AS stripe_transactions, {n("provider = 'square'")} AS square_transactions,
  {n("provider NOT IN ('stripe', 'square')")} AS other_provider_transactions,
  {n("currency = 'USD'")} AS usd_transactions, {n("currency = 'EUR'")} AS eur_transactions, {n("currency = 'GBP'")} AS gbp_transactions,
  {n("payment_method_type = 'card'")} AS card_transactions, {n("payment_method_type = 'bank_transfer'")} AS bank_transfer_transactions,
  {n("payment_method_type NOT IN ('card', 'bank_transfer')")} AS other_method_transactions
  FROM {source} GROUP BY 1),
ds_b AS (SELECT *, {ratio('total_revenue_cents', 'paid')} AS avg_transaction_cents,
  total_revenue_cents - total_refunds_cents AS net_revenue_cents FROM ds_a),
ds AS (SELECT * EXCLUDE (paid), {dollars('total_revenue_cents')} AS total_revenue_dollars,
  {dollars('total_refunds_cents')} AS total_refunds_dollars, {dollars('net_revenue_cents')} AS net_revenue_dollars,
  {dollars('avg_transaction_cents')} AS avg_transaction_dollars,
  {ratio('failed_transactions', 'total_transactions')} AS failure_rate,
  {ratio('refund_count', 'successful_transactions')} AS refund_rate,
  {ratio('high_risk_count', 'total_transactions')} AS high_risk_rate,
  {ratio('total_transactions', 'unique_customers')} AS transactions_per_customer FROM ds_b)"""


DS = f"{STG}, {daily_summary()}"
ORACLES["m04_daily_summary"] = f"WITH {DS} SELECT * REPLACE ({day('event_date')} AS event_date) FROM ds"
ORACLES["m09_fct_daily_payments"] = f"WITH {DS} SELECT * EXCLUDE (event_date), {day('event_date')} AS date_key FROM ds"
ORACLES["m09_fct_daily_incremental"] = f"""WITH {DS} SELECT {day('event_date')} AS event_date, total_transactions,
  total_revenue_cents, unique_customers FROM ds"""
ORACLES["m05_dim_customer"] = f"""WITH {CM} SELECT {KEY('customer_id')} AS customer_key, customer_id, customer_tier, total_revenue_cents,
  {ts(AS_OF)} AS valid_from, CAST(NULL AS VARCHAR) AS valid_to, true AS is_current FROM cm"""
ORACLES["m05_dim_customer_incremental"] = f"""WITH {CM} SELECT {KEY('customer_id')} AS customer_key, customer_id,
  total_transactions, total_revenue_cents, customer_tier, CASE WHEN customer_id IN (SELECT customer_id FROM stg WHERE ingested_at >= TIMESTAMP '2024-01-20')
  THEN {ts(AS_OF)} ELSE {ts("TIMESTAMP '2024-01-20'")} END AS valid_from FROM cm"""
ORACLES["m06_dim_merchant"] = f"""WITH {MM} SELECT {KEY('merchant_id')} AS merchant_key, merchant_id, health_category, health_score,
  {ts(AS_OF)} AS valid_from, CAST(NULL AS VARCHAR) AS valid_to, true AS is_current FROM mm"""

DATES = """dates AS (SELECT CAST(d AS DATE) AS date_key FROM (SELECT unnest(range(DATE '2020-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS d)),
dd AS (SELECT date_key, year(date_key) AS year, quarter(date_key) AS quarter, month(date_key) AS month, weekofyear(date_key) AS week_of_year,
  day(date_key) AS day_of_month, isodow(date_key) AS day_of_week, dayofyear(date_key) AS day_of_year, dayname(date_key) AS day_name,
  monthname(date_key) AS month_name, left(monthname(date_key), 3) AS month_name_short, year(date_key) AS fiscal_year,
  quarter(date_key) AS fiscal_quarter, isodow(date_key) IN (6, 7) AS is_weekend, isodow(date_key) NOT IN (6, 7) AS is_weekday,
  strftime(date_key, '%Y-%m') AS year_month, year(date_key) || '-Q' || quarter(date_key) AS year_quarter,
  CAST(year(date_key) AS VARCHAR) AS year_str, weekofyear(date_key) AS iso_week,
  year(date_key) || '-W' || lpad(CAST(weekofyear(date_key) AS VARCHAR), 2, '0') AS iso_year_week FROM dates)"""
ORACLES["m07_dim_date"] = f"""WITH {PE}, {DATES}, c AS (SELECT CAST(provider_created_at AS DATE) AS date_key, count(*) AS n FROM pe GROUP BY 1)
SELECT dd.* REPLACE ({day('dd.date_key')} AS date_key), coalesce(c.n, 0) AS n FROM dd LEFT JOIN c USING (date_key)"""

STATUS = """CASE WHEN lower(status) IN ('succeeded', 'paid', 'complete', 'completed') THEN 'succeeded'
  WHEN lower(status) IN ('failed', 'failure', 'declined') THEN 'failed' WHEN lower(status) IN ('pending', 'processing', 'in_progress') THEN 'pending'
  WHEN lower(status) IN ('refunded', 'partially_refunded') THEN 'refunded' WHEN lower(status) IN ('disputed', 'chargeback') THEN 'disputed'
  WHEN lower(status) IN ('canceled', 'cancelled', 'voided') THEN 'canceled' ELSE 'unknown' END"""
FCT = f"""fct AS (SELECT *, CAST(provider_created_at AS DATE) AS event_date,
  CASE WHEN status = 'succeeded' THEN 1 ELSE 0 END AS is_successful, CASE WHEN status = 'failed' THEN 1 ELSE 0 END AS is_failed,
  CASE WHEN event_type LIKE '%refund%' THEN 1 ELSE 0 END AS is_refund, CASE WHEN event_type LIKE '%dispute%' THEN 1 ELSE 0 END AS is_dispute,
  CASE WHEN validation_status = 'passed' THEN 1 ELSE 0 END AS is_valid, {FRAUD('fraud_score')} AS fraud_risk_category,
  {CHURN3('churn_score')} AS churn_risk_category FROM stg)"""
ORACLES["m08_fct_payments"] = f"""WITH {STG}, {FCT} SELECT {KEY('event_id')} AS payment_key, {KEY('customer_id')} AS customer_key,
  {KEY('merchant_id')} AS merchant_key, {day('event_date')} AS date_key, {day('event_date')} AS event_date, {BRONZE_OUT},
  {CATEGORY.format(extra="OR event_type LIKE '%chargeback%'")} AS event_category, {dollars('amount_cents')} AS amount_dollars,
  {STATUS} AS status_category, is_successful, is_failed, is_refund, is_dispute, is_valid, fraud_risk_category, churn_risk_category FROM fct"""
ORACLES["m10_scd2_merge"] = f"""WITH {STG}, old AS (SELECT * FROM stg WHERE ingested_at < TIMESTAMP '2024-01-20'),
{customer_metrics('old', 'a')}, {customer_metrics('stg', 'b')},
j AS (SELECT b.customer_id, a.customer_tier AS t0, b.customer_tier AS t1, a.payment_risk_profile AS p0, b.payment_risk_profile AS p1,
  a.customer_id IS NOT NULL AS known, a.customer_id IS NULL OR a.customer_tier <> b.customer_tier OR a.payment_risk_profile <> b.payment_risk_profile AS changed
  FROM b LEFT JOIN a USING (customer_id))
SELECT customer_id, t0 AS customer_tier, p0 AS payment_risk_profile, {ts("TIMESTAMP '2024-01-20'")} AS valid_from,
  CASE WHEN changed THEN {ts(AS_OF)} END AS valid_to, NOT changed AS is_current FROM j WHERE known
UNION ALL SELECT customer_id, t1, p1, {ts(AS_OF)}, NULL, true FROM j WHERE changed"""
ORACLES["m11_incremental_filter"] = f"""WITH {STG} SELECT event_id, {ts('ingested_at')} AS ingested_at, event_category FROM stg
WHERE ingested_at >= (SELECT max(ingested_at) FROM stg WHERE ingested_at < TIMESTAMP '2024-01-20')"""

# --- intervals ---------------------------------------------------------------------------------------

BUCKET = "time_bucket(INTERVAL '15 minutes', ingested_at)"


def time_columns(key: str, *extra: str) -> str:
    return f"""{KEY('b', *extra)} AS {key}, {ts('b')} AS interval_start, {ts("b + INTERVAL '15 minutes'")} AS interval_end,
  {day('b')} AS event_date, hour(b) AS event_hour, strftime(b, '%Y-%m-%d %H:%M') AS interval_label"""


BK = f"{STG}, bk AS (SELECT *, {BUCKET} AS b FROM stg WHERE ingested_at IS NOT NULL)"
OK, BAD = "status = 'succeeded'", "status = 'failed'"
REFUND, DISPUTE, HIGH = "event_category = 'refund'", "event_category = 'dispute'", "risk_level = 'high'"
PAID = f"count(amount_cents) FILTER (WHERE {OK})"
PROVIDERS = ["stripe", "square", "adyen", "braintree"]
BANK = "payment_method_type IN ('bank_transfer', 'us_bank_account')"
PER_MINUTE = "round(count(*) * 1e2 / 15) / 100 AS transactions_per_minute"
REVENUE, REFUNDS = cents(OK), cents(REFUND)


def money_columns(revenue: str, refunds: str) -> str:
    stem = lambda x: x.removesuffix("_cents")
    return f"""{REVENUE} AS {revenue}, {money(REVENUE)} AS {stem(revenue)}_dollars, {REFUNDS} AS {refunds}, {money(REFUNDS)} AS {stem(refunds)}_dollars,
  {REVENUE} - {REFUNDS} AS net_revenue_cents, {money(f'({REVENUE} - {REFUNDS})')} AS net_revenue_dollars,
  {money(ratio(REVENUE, PAID))} AS avg_transaction_dollars"""


def rate(cond: str) -> str:
    return f"coalesce({pct(n(cond), 'count(*)')}, 0e0)"


ORACLES["a01_payment_intervals"] = f"""WITH {BK} SELECT {time_columns('interval_key')}, count(*) AS transaction_count,
  {n(OK)} AS successful_count, {n(BAD)} AS failed_count, {n(REFUND)} AS refund_count, {n(DISPUTE)} AS dispute_count,
  {money_columns('revenue_cents', 'refund_cents')}, {rate(OK)} AS success_rate_pct, {rate(BAD)} AS failure_rate_pct,
  {mean4('fraud_score')} AS avg_fraud_score, {n(HIGH)} AS high_risk_count, {mean4('churn_score')} AS avg_churn_score,
  count(DISTINCT customer_id) AS unique_customers, count(DISTINCT merchant_id) AS unique_merchants,
  {', '.join(f'{n(f"provider = {chr(39)}{p}{chr(39)}")} AS {p}_count' for p in PROVIDERS)},
  {n("payment_method_type = 'card'")} AS card_count, {n(BANK)} AS bank_count, {PER_MINUTE} FROM bk GROUP BY b"""
ORACLES["m11_interval_rebuild"] = f"""WITH {BK} SELECT {ts('b')} AS interval_start, count(*) AS transaction_count, {REVENUE} AS revenue_cents,
  count(DISTINCT customer_id) AS unique_customers, {rate(OK)} AS success_rate_pct FROM bk GROUP BY b"""
ORACLES["a02_payment_summary"] = f"""WITH {BK} SELECT {time_columns('interval_key')}, count(*) AS total_transactions,
  {n(OK)} AS successful_transactions, {n(BAD)} AS failed_transactions, {n(REFUND)} AS refunds, {n(DISPUTE)} AS disputes,
  {money_columns('total_revenue_cents', 'total_refunds_cents')}, {rate(OK)} AS success_rate_pct, {rate(BAD)} AS failure_rate_pct,
  {rate(REFUND)} AS refund_rate_pct, {mean4('fraud_score')} AS avg_fraud_score, {n(HIGH)} AS high_risk_transactions,
  count(DISTINCT customer_id) AS unique_customers, count(DISTINCT merchant_id) AS unique_merchants,
  {', '.join(f'{n(f"provider = {chr(39)}{p}{chr(39)}")} AS {p}_transactions' for p in PROVIDERS)}, {PER_MINUTE} FROM bk GROUP BY b"""
ORACLES["a03_provider_comparison"] = f"""WITH {BK} SELECT {time_columns('interval_provider_key', 'provider')}, provider,
  count(*) AS total_transactions, {n(OK)} AS successful_transactions, {n(BAD)} AS failed_transactions,
  {n(REFUND)} AS refund_transactions, {n(DISPUTE)} AS dispute_transactions, {money_columns('total_revenue_cents', 'total_refund_cents')},
  {money(f'coalesce(min(amount_cents) FILTER (WHERE {OK}), 0)')} AS min_transaction_dollars,
  {money(f'coalesce(max(amount_cents) FILTER (WHERE {OK}), 0)')} AS max_transaction_dollars,
  {rate(OK)} AS success_rate_pct, {rate(BAD)} AS failure_rate_pct, {rate(REFUND)} AS refund_rate_pct, {rate(DISPUTE)} AS dispute_rate_pct,
  {mean4('fraud_score')} AS avg_fraud_score, {n(HIGH)} AS high_risk_transactions, {pct(n(HIGH), 'count(*)')} AS high_risk_rate_pct,
  count(DISTINCT customer_id) AS unique_customers, round(count(*) * 1e2 / nullif(count(DISTINCT customer_id), 0)) / 100 AS transactions_per_customer,
  {PER_MINUTE} FROM bk WHERE provider IS NOT NULL GROUP BY b, provider"""


def _level_columns() -> str:
    parts = []
    for x in ("high", "medium", "low"):
        at = f"risk_level = '{x}'"
        parts += [f"{n(at)} AS {x}_risk_count", f"{pct(n(at), 'count(*)')} AS {x}_risk_pct",
                  f"{cents(at)} AS {x}_risk_amount_cents", f"{money(cents(at))} AS {x}_risk_amount_dollars"]
    for kind in ("fraud", "churn"):
        parts += [f"{mean4(f'{kind}_score')} AS avg_{kind}_score"]
        parts += [f"round(coalesce({m}({kind}_score), 0e0), 4) AS {m}_{kind}_score" for m in ("min", "max")]
    parts += [f"""{n(f"{HIGH} AND provider = '{p}'")} AS {p}_high_risk""" for p in PROVIDERS]
    return ", ".join(parts)


ORACLES["a04_risk_overview"] = f"""WITH {BK} SELECT {time_columns('interval_key')}, count(*) AS total_transactions,
  {n(OK)} AS successful_count, {n(BAD)} AS failed_count, CAST(coalesce(sum(amount_cents), 0) AS BIGINT) AS total_amount_cents,
  {money('coalesce(sum(amount_cents), 0)')} AS total_amount_dollars, {REVENUE} AS successful_amount_cents, {money(REVENUE)} AS successful_amount_dollars,
  {_level_columns()}, {n(f"{HIGH} AND payment_method_type = 'card'")} AS card_high_risk, {n(f"{HIGH} AND {BANK}")} AS bank_high_risk
  FROM bk GROUP BY b"""

TREND_COUNTS = ["transaction_count", "successful_count", "failed_count", "refund_count", "dispute_count", "revenue_cents",
                "refund_cents", "high_risk_count", "unique_customers", "unique_merchants", "card_transactions",
                "bank_transactions", "stripe_transactions", "square_transactions"]
CALENDAR = ["year", "quarter", "month", "week_of_year", "day_of_week", "day_name", "month_name", "year_month",
            "year_quarter", "is_weekend", "is_weekday"]
ORACLES["a05_payment_trends"] = f"""WITH {STG}, {FCT}, {DATES}, m AS (SELECT event_date AS date_key, count(*) AS transaction_count,
  CAST(sum(is_successful) AS BIGINT) AS successful_count, CAST(sum(is_failed) AS BIGINT) AS failed_count,
  CAST(sum(is_refund) AS BIGINT) AS refund_count, CAST(sum(is_dispute) AS BIGINT) AS dispute_count,
  {cents('is_successful = 1')} AS revenue_cents, {cents('is_refund = 1')} AS refund_cents,
  count(CASE WHEN is_successful = 1 THEN amount_cents END) AS paid, {mean4('fraud_score')} AS avg_fraud_score,
  {n("fraud_risk_category = 'high'")} AS high_risk_count, {mean4('churn_score')} AS avg_churn_score,
  count(DISTINCT customer_id) AS unique_customers, count(DISTINCT merchant_id) AS unique_merchants,
  {n("payment_method_type = 'card'")} AS card_transactions, {n("payment_method_type = 'bank_transfer'")} AS bank_transactions,
  {n("provider = 'stripe'")} AS stripe_transactions, {n("provider = 'square'")} AS square_transactions FROM fct GROUP BY 1),
j AS (SELECT dd.date_key, {', '.join('dd.' + c for c in CALENDAR)}, {', '.join(f'coalesce(m.{c}, 0) AS {c}' for c in TREND_COUNTS)},
  coalesce(m.paid, 0) AS paid, coalesce(m.avg_fraud_score, 0e0) AS avg_fraud_score, coalesce(m.avg_churn_score, 0e0) AS avg_churn_score
  FROM dd LEFT JOIN m USING (date_key) WHERE dd.date_key BETWEEN DATE '2024-01-01' AND CAST({AS_OF} AS DATE))
SELECT * EXCLUDE (paid) REPLACE ({day('date_key')} AS date_key), {KEY('date_key')} AS trend_key,
  {money('revenue_cents')} AS revenue_dollars, {money('refund_cents')} AS refund_dollars,
  revenue_cents - refund_cents AS net_revenue_cents, {money('(revenue_cents - refund_cents)')} AS net_revenue_dollars,
  {money(ratio('revenue_cents', 'paid'))} AS avg_transaction_dollars,
  coalesce({pct('successful_count', 'transaction_count')}, 0e0) AS success_rate_pct,
  coalesce({pct('failed_count', 'transaction_count')}, 0e0) AS failure_rate_pct,
  CAST(sum(revenue_cents) OVER (ORDER BY date_key) AS BIGINT) AS cumulative_revenue_cents,
  avg(transaction_count) OVER (ORDER BY date_key ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma7_transaction_count,
  avg(revenue_cents) OVER (ORDER BY date_key ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma7_revenue_cents FROM j"""


def _segment(kind: str, col: str, tier: bool, fraud: bool, churn: bool, where: str = "true") -> str:
    opt = lambda on, x: x if on else "CAST(NULL AS DOUBLE)"
    return f"""SELECT '{kind}' AS segment_type, {col} AS segment_value, count(*) AS customer_count,
  {pct('count(*)', 'any_value(tc)')} AS customer_pct, CAST(sum(total_revenue_cents) AS BIGINT) AS segment_revenue_cents,
  {money('sum(total_revenue_cents)')} AS segment_revenue_dollars, {pct('CAST(sum(total_revenue_cents) AS BIGINT)', 'any_value(tr)')} AS revenue_pct,
  {opt(tier, money('CAST(sum(total_revenue_cents) AS DOUBLE) / count(*)'))} AS avg_revenue_per_customer_dollars,
  {opt(tier, 'round(CAST(sum(total_transactions) AS BIGINT) * 1e1 / count(*)) / 10')} AS avg_transactions_per_customer,
  {opt(tier, 'round(sum(failure_rate) / count(failure_rate) * 100, 2)')} AS avg_failure_rate_pct,
  {opt(fraud, 'round(sum(avg_fraud_score) / count(avg_fraud_score), 4)')} AS avg_fraud_score,
  {opt(churn, 'round(sum(avg_churn_score) / count(avg_churn_score), 4)')} AS avg_churn_score
  FROM c WHERE {where} GROUP BY {col}"""


ORACLES["a06_customer_segments"] = f"""WITH {CM}, c AS (SELECT *, count(*) OVER () AS tc, CAST(sum(total_revenue_cents) OVER () AS BIGINT) AS tr FROM cm)
{_segment('tier', 'customer_tier', True, True, True)} UNION ALL {_segment('fraud_risk', 'fraud_risk_category', False, True, False)}
UNION ALL {_segment('churn_risk', 'churn_risk_category', False, False, True)}
UNION ALL {_segment('payment_method', 'preferred_payment_method', False, False, False, 'preferred_payment_method IS NOT NULL')}"""

# --- typed streams --------------------------------------------------------------------------------------

CUR5 = ", ".join(f"'{c}'" for c in C.STREAM_CURRENCIES)
REQUIRED = {"charges": "", "refunds": "WHEN charge_id IS NULL THEN 'MISSING_CHARGE_ID'",
            "disputes": "WHEN charge_id IS NULL THEN 'MISSING_CHARGE_ID'", "subscriptions": "WHEN plan_id IS NULL THEN 'MISSING_PLAN_ID'"}
FLAGS = {
    "charges": "(amount = 0 AND status = 'succeeded') OR customer_id IS NULL OR (status = 'failed' AND failure_code IS NULL)",
    "refunds": "amount = 0 OR customer_id IS NULL OR charge_id IS NULL OR (status = 'failed' AND failure_reason IS NULL)",
    "disputes": "customer_id IS NULL OR charge_id IS NULL OR reason IS NULL",
    "subscriptions": 'customer_id IS NULL OR plan_id IS NULL OR "interval" IS NULL',
}


def judged_stream(kind: str, name: str = "s") -> str:
    low = "<" if kind == "subscriptions" else "<="
    return f"""{name} AS (SELECT *, CASE WHEN customer_id IS NULL THEN 'MISSING_CUSTOMER_ID' {REQUIRED[kind]}
  WHEN currency IS NOT NULL AND upper(currency) NOT IN ({CUR5}) THEN 'INVALID_CURRENCY'
  WHEN amount {low} 0 THEN 'INVALID_AMOUNT_NEGATIVE' WHEN amount > 1000000 THEN 'INVALID_AMOUNT_TOO_LARGE' END AS reason_code,
  coalesce({FLAGS[kind]}, false) AS flag FROM ({W.STREAM_SQL[kind].format(orders='orders')}))"""


for _i, _k in enumerate(W.STREAM_SQL, start=1):
    ORACLES[f"v{_i:02d}_split_{_k}"] = f"""WITH {judged_stream(_k)} SELECT event_id, customer_id, CAST(amount AS DOUBLE) AS amount,
  CASE WHEN reason_code IS NULL THEN upper(currency) ELSE currency END AS currency, status, {ts('created_at')} AS created_at,
  CASE WHEN reason_code IS NULL THEN flag END AS validation_flag, reason_code AS rejection_reason,
  CASE WHEN reason_code IS NOT NULL THEN {ts(AS_OF)} END AS quarantine_timestamp FROM s"""
ORACLES["s10_valid_and_quarantine_sinks"] = f"""WITH {judged_stream('charges')} SELECT event_id, CAST(amount AS DOUBLE) AS amount,
  CASE WHEN reason_code IS NULL THEN upper(currency) ELSE currency END AS currency, CASE WHEN reason_code IS NULL THEN flag END AS validation_flag,
  reason_code AS rejection_reason, CASE WHEN reason_code IS NOT NULL THEN {ts(AS_OF)} END AS quarantine_timestamp FROM s"""


def union_kinds(make) -> str:
    ctes = ", ".join(judged_stream(k, f"s_{k}") for k in W.STREAM_SQL)
    return f"WITH {ctes} " + " UNION ALL ".join(make(k, f"s_{k}") for k in W.STREAM_SQL)


STREAM_VIEW = f"event_id, customer_id, CAST(amount AS DOUBLE) AS amount, currency, status, {ts('created_at')} AS created_at"
ORACLES["s09_typed_streams"] = union_kinds(lambda k, s: f"SELECT '{k}' AS kind, {STREAM_VIEW} FROM {s}")
ORACLES["s11_charges_passthrough"] = f"WITH {judged_stream('charges')} SELECT {STREAM_VIEW} FROM s"
ORACLES["v10_watermarked_stream"] = ORACLES["s11_charges_passthrough"]
ORACLES["v05_clean_amount"] = f"""WITH {judged_stream('subscriptions')} SELECT event_id,
  CAST(CASE WHEN amount > 0 AND amount <= 1000000 THEN amount END AS DOUBLE) AS charge_amount,
  CAST(CASE WHEN amount >= 0 AND amount <= 1000000 THEN amount END AS DOUBLE) AS plan_amount FROM s"""
ORACLES["v06_clean_currency"] = f"""WITH {judged_stream('charges')} SELECT event_id,
  CASE WHEN upper(currency) NOT IN ('NULL', '') THEN upper(currency) END AS currency FROM s"""
ORACLES["v07_suspicious_flag"] = union_kinds(lambda k, s: f"SELECT '{k}' AS kind, event_id, flag FROM {s}")
ORACLES["v08_rejection_reason"] = union_kinds(lambda k, s: f"SELECT '{k}' AS kind, event_id, reason_code AS reason FROM {s}")
ORACLES["v09_run_split_streams"] = union_kinds(lambda k, s: f"""SELECT '{k}' AS kind, event_id,
  coalesce(reason_code, CASE WHEN flag THEN 'flagged' ELSE 'valid' END) AS outcome FROM {s}""")
ORACLES["a07_provider_performance"] = f"""WITH {judged_stream('charges')} SELECT provider, status, count(*) AS transaction_count,
  CAST(CAST(CAST(sum(amount) AS DOUBLE) / count(amount) AS DECIMAL(20,6)) AS DOUBLE) AS avg_amount, CAST(sum(amount) AS DOUBLE) AS total_amount
  FROM s WHERE reason_code IS NULL GROUP BY ALL"""
ORACLES["a08_refund_analytics"] = f"""WITH {judged_stream('refunds')} SELECT provider, reason, count(*) AS refund_count,
  CAST(sum(amount) AS DOUBLE) AS total_refunded FROM s WHERE reason_code IS NULL GROUP BY ALL"""
ORACLES["a09_dispute_patterns"] = f"""WITH {judged_stream('disputes')} SELECT provider, status, reason, count(*) AS dispute_count,
  CAST(sum(amount) AS DOUBLE) AS total_disputed FROM s WHERE reason_code IS NULL GROUP BY ALL"""
ORACLES["a10_recent"] = f"""WITH {judged_stream('charges')} SELECT event_id, {ts('created_at')} AS created_at, CAST(amount AS DOUBLE) AS amount
  FROM (SELECT * FROM s WHERE reason_code IS NULL ORDER BY created_at DESC, event_id LIMIT 10)"""
ORACLES["a10_recent_quarantine"] = f"""WITH {judged_stream('charges')} SELECT event_id, {ts('created_at')} AS created_at, reason_code AS rejection_reason
  FROM (SELECT * FROM s WHERE reason_code IS NOT NULL ORDER BY created_at DESC, event_id LIMIT 10)"""
ORACLES["a16_rejection_counts"] = f"""WITH {judged_stream('charges')} SELECT reason_code AS rejection_reason, count(*) AS rejected
  FROM s WHERE reason_code IS NOT NULL GROUP BY 1"""

RECENT = "created_at > TIMESTAMP '1997-06-15 00:30:00' - INTERVAL 4800 HOUR AND created_at <= TIMESTAMP '1997-06-15 00:30:00'"
ORACLES["q06_quarantine_monitor"] = f"""WITH {judged_stream('charges')} SELECT reason_code AS rejection_reason, count(*) AS n,
  {ts('min(created_at)')} AS first_seen, {ts('max(created_at)')} AS last_seen, count(*) > 100 AS alert
  FROM s WHERE reason_code IS NOT NULL AND {RECENT} GROUP BY 1"""
_Q7 = ", ".join(judged_stream(k, f"s_{k}") for k in W.STREAM_SQL)
_Q7U = " UNION ALL ".join(f"""SELECT '{k}' AS source, {n('reason_code IS NOT NULL')} AS quarantined,
  count(DISTINCT reason_code) AS unique_reasons, count(*) AS total FROM s_{k} WHERE {RECENT}""" for k in W.STREAM_SQL)
ORACLES["q07_quarantine_summary"] = f"""WITH {_Q7}, t AS ({_Q7U}) SELECT source, quarantined, unique_reasons, CAST(NULL AS DOUBLE) AS quality_score,
  CAST(NULL AS BOOLEAN) AS alert, CAST(NULL AS DOUBLE) AS true_score FROM t
UNION ALL SELECT 'all', CAST(sum(quarantined) AS BIGINT), NULL, round((10000 - CAST(sum(quarantined) AS BIGINT)) * 1e4 / 10000) / 100,
  {pct('CAST(sum(total) - sum(quarantined) AS BIGINT)', 'CAST(sum(total) AS BIGINT)')} < 99, {pct('CAST(sum(total) - sum(quarantined) AS BIGINT)', 'CAST(sum(total) AS BIGINT)')} FROM t"""
ORACLES["q08_flag_monitor"] = f"""WITH {judged_stream('charges')}, v AS (SELECT count(*) AS total_records, {n('flag')} AS flagged_records
  FROM s WHERE reason_code IS NULL AND {RECENT}) SELECT *, coalesce(flagged_records * 1e2 / nullif(total_records, 0), 0e0) AS flagged_percentage,
  coalesce(flagged_records * 1e2 / nullif(total_records, 0), 0e0) > 5 AS alert FROM v"""

# --- reports ---------------------------------------------------------------------------------------------

ORACLES["a11_unified_payments"] = f"""WITH {PE}, u AS (SELECT event_id AS transaction_id, 'stripe' AS provider, event_type, provider_created_at AS t,
  {money('amount_cents')} AS amount_dollars, currency AS currency_code, customer_id,
  CASE event_type WHEN 'charge.succeeded' THEN 'SUCCESS' WHEN 'charge.failed' THEN 'FAILED' ELSE 'OTHER' END AS normalized_status,
  failure_code AS failure_reason FROM pe WHERE provider = 'stripe'
UNION ALL SELECT event_id, 'square', CASE status WHEN 'succeeded' THEN 'COMPLETED' WHEN 'failed' THEN 'FAILED' ELSE 'PENDING' END, provider_created_at,
  {money('amount_cents')}, currency, customer_id, CASE status WHEN 'succeeded' THEN 'SUCCESS' WHEN 'failed' THEN 'FAILED' ELSE 'OTHER' END, failure_code
  FROM pe WHERE provider = 'square')
SELECT * EXCLUDE (t), {ts('t')} AS transaction_timestamp FROM u WHERE t > TIMESTAMP '2024-01-05'"""
ORACLES["a12_customer_clv"] = f"""WITH {PE}, g AS (SELECT customer_id, count(*) AS total_payments, {n("event_type = 'charge.succeeded'")} AS successful_payments,
  {n("event_type = 'charge.failed'")} AS failed_payments, CAST(sum(amount_cents) AS BIGINT) AS c, count(amount_cents) AS k, max(provider_created_at) AS l FROM pe GROUP BY 1)
SELECT customer_id, total_payments, successful_payments, failed_payments, CAST(successful_payments AS DOUBLE) / nullif(total_payments, 0) AS success_rate,
  c / 1e2 AS lifetime_value, CAST(c AS DOUBLE) / nullif(k, 0) / 100 AS avg_payment_amount, {ts('l')} AS last_payment_date,
  CASE WHEN c / 1e2 > 10000 THEN 'high' WHEN c / 1e2 > 1000 THEN 'medium' ELSE 'low' END AS clv_segment FROM g"""
ORACLES["a13_retry_label"] = f"""WITH {PE}, l AS (SELECT *, lead(status) OVER (PARTITION BY customer_id ORDER BY provider_created_at, event_id) AS nxt
  FROM pe WHERE customer_id IS NOT NULL) SELECT event_id, customer_id, failure_code, amount_cents, currency, coalesce(nxt = 'succeeded', false) AS retry_succeeded
  FROM l WHERE status = 'failed'"""
ORACLES["a14_hourly_success"] = f"""WITH {PE} SELECT count(*) AS total_payments, {n("event_type = 'charge.succeeded'")} AS successful,
  {n("event_type = 'charge.failed'")} AS failed, CAST(sum(amount_cents) AS DOUBLE) / count(amount_cents) / 100 AS avg_amount
  FROM pe WHERE provider_created_at > TIMESTAMP '2024-01-15 11:00:00' AND provider_created_at <= TIMESTAMP '2024-01-15 12:00:00'"""
ORACLES["a15_parent_child_counts"] = "SELECT c_name, count(o_orderkey) AS child_count FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_name"
ORACLES["a15_top_scored"] = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"

# --- expressions -----------------------------------------------------------------------------------------

EXPRESSIONS = {
    "f01_safe_divide": f"{ratio('amount_cents', '(amount_cents % 7)')} AS ratio, {ratio('amount_cents', 'days_to_churn_estimate')} AS null_ratio",
    "f02_surrogate_key": f"{KEY('customer_id')} AS one, {KEY('customer_id', 'amount_cents', 'merchant_id')} AS three",
    "f04_customer_tier": f"{TIER('amount_cents * 10')} AS tier",
    "f05_risk_profile": f"{PROFILE('fraud_score')} AS profile",
    "f06_fraud_risk_level": f"{FRAUD('fraud_score')} AS level",
    "f07_churn_risk_level": f"{CHURN3('churn_score')} AS level",
    "f08_cents_to_dollars": f"{dollars('amount_cents')} AS dollars",
    "f10_merchant_health_category": f"{HEALTH('fraud_score * 100')} AS category",
    "f11_status_category": f"{STATUS} AS category",
    "f12_event_type_category": f"""{CATEGORY.format(extra="OR event_type LIKE '%chargeback%'")} AS category, event_category AS staging""",
    "f13_interval_15m": f"""{ts(BUCKET)} AS interval_start, {ts(f"{BUCKET} + INTERVAL '15 minutes'")} AS interval_end, strftime({BUCKET}, '%Y-%m-%d %H:%M') AS label""",
    "e04_fraud_risk_level": f"{FRAUD('fraud_score')} AS level",
}
for _name, _sql in EXPRESSIONS.items():
    ORACLES[_name] = f"WITH {STG} SELECT event_id, {_sql} FROM stg"
ORACLES["e06_churn_level"] = f"WITH {STG} SELECT event_id, {CHURN4('churn_score')} AS level FROM stg WHERE churn_score IS NOT NULL"
ORACLES["f03_date_spine"] = """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1),
s AS (SELECT CAST(unnest(range((SELECT min(d) FROM o), (SELECT max(d) FROM o), INTERVAL 1 DAY)) AS DATE) AS d)
SELECT strftime(s.d, '%Y-%m-%d') AS date_day, coalesce(o.n, 0) AS n FROM s LEFT JOIN o USING (d)"""
ORACLES["f09_merchant_health"] = f"""WITH {MM} SELECT merchant_id,
  greatest(0e0, least(1e2, 1e2 - (dispute_rate / 20 * 400 + refund_rate / 20 * 300 + failure_rate / 20 * 300))) AS score FROM mm"""

# --- features ----------------------------------------------------------------------------------------------

FC = f"""fc AS (SELECT customer_id, total_transactions AS total_payments_30d, total_transactions AS total_payments_90d,
  total_revenue_cents AS total_amount_cents_30d, CAST(avg_transaction_cents AS FLOAT) AS avg_amount_cents, failed_transactions AS failed_payments_30d,
  CAST(failure_rate AS FLOAT) AS failure_rate_30d, failed_transactions AS consecutive_failures,
  successful_transactions - failed_transactions AS recovered_payments_30d, CAST(1e0 - failure_rate AS FLOAT) AS recovery_rate_30d,
  coalesce(customer_tenure_days, 0) AS days_since_first_payment, 0 AS days_since_last_payment, coalesce(customer_tenure_days, 0) AS days_since_last_failure,
  provider_count AS payment_method_count, CASE WHEN provider_count > 1 THEN 1 ELSE 0 END AS has_backup_payment_method,
  CAST(coalesce(avg_fraud_score, 0e0) AS FLOAT) AS fraud_score_avg, high_risk_transaction_count AS high_risk_payment_count, customer_tier,
  customer_tenure_days AS subscription_age_days, customer_tenure_days AS account_age_days FROM cm)"""
FM = f"""fm AS (SELECT merchant_id, total_transactions AS total_transactions_30d, total_revenue_cents AS total_volume_cents_30d,
  unique_customers AS unique_customers_30d, CAST(avg_transaction_cents AS FLOAT) AS avg_transaction_amount, CAST(failure_rate AS FLOAT) AS failure_rate_30d,
  CAST(dispute_rate AS FLOAT) AS dispute_rate_30d, CAST(refund_rate AS FLOAT) AS refund_rate_30d, CAST(dispute_rate AS FLOAT) AS chargeback_rate_30d,
  CAST(coalesce(avg_fraud_score, 0e0) AS FLOAT) AS fraud_rate_30d, CAST(coalesce(high_risk_rate, 0e0) AS FLOAT) AS high_risk_transaction_pct,
  CAST(health_score AS FLOAT) AS merchant_health_score FROM mm)"""
CUST_FLOATS = ["avg_amount_cents", "failure_rate_30d", "recovery_rate_30d", "fraud_score_avg"]
MERCH_FLOATS = ["avg_transaction_amount", "failure_rate_30d", "dispute_rate_30d", "refund_rate_30d", "chargeback_rate_30d",
                "fraud_rate_30d", "high_risk_transaction_pct", "merchant_health_score"]


def wide(cols: list[str]) -> str:
    return "* REPLACE (" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols) + ")"


BOTH = f"{STG}, {customer_metrics()}, {merchant_metrics()}, {FC}, {FM}"
ORACLES["x01_feat_customer"] = f"WITH {CM}, {FC} SELECT {wide(CUST_FLOATS)}, {ts(AS_OF)} AS feature_timestamp FROM fc"
ORACLES["x02_feat_merchant"] = f"WITH {MM}, {FM} SELECT {wide(MERCH_FLOATS)}, {ts(AS_OF)} AS feature_timestamp FROM fm"
ORACLES["s14_export_features"] = f"""WITH {BOTH} SELECT 'customer' AS entity, 'success' AS status, count(*) AS row_count, 21 AS column_count FROM fc
UNION ALL SELECT 'merchant', 'success', count(*), 13 FROM fm"""
SNAP = f"""{PE}, snap AS (SELECT customer_id, CAST(CAST(provider_created_at AS DATE) + 1 AS TIMESTAMP) AS ft, count(*) AS total_payments_30d,
  {n("status = 'failed'")} AS failed_payments_30d, CAST(sum(amount_cents) AS BIGINT) AS total_amount_cents_30d FROM pe WHERE customer_id IS NOT NULL GROUP BY 1, 2)"""
SNAP_FIELDS = ["total_payments_30d", "failed_payments_30d", "total_amount_cents_30d"]
ALIVE = "ft > TIMESTAMP '2024-01-15 06:00:00' - INTERVAL 1 DAY AND ft <= TIMESTAMP '2024-01-15 06:00:00'"
ORACLES["x03_feature_view"] = f"WITH {SNAP} SELECT customer_id, {ts('ft')} AS feature_timestamp, {', '.join(SNAP_FIELDS)} FROM snap WHERE {ALIVE}"
ORACLES["x04_feature_services"] = f"""WITH {BOTH}, p AS (SELECT DISTINCT customer_id, merchant_id FROM pe WHERE customer_id IS NOT NULL AND merchant_id IS NOT NULL)
SELECT p.customer_id, p.merchant_id, fc.total_payments_30d, CAST(fc.failure_rate_30d AS DOUBLE) AS failure_rate_30d, CAST(fc.fraud_score_avg AS DOUBLE) AS fraud_score_avg,
  fc.high_risk_payment_count, fc.days_since_first_payment, CAST(fm.fraud_rate_30d AS DOUBLE) AS fraud_rate_30d,
  CAST(fm.high_risk_transaction_pct AS DOUBLE) AS high_risk_transaction_pct, CAST(fm.merchant_health_score AS DOUBLE) AS merchant_health_score,
  CAST(fc.failure_rate_30d AS DOUBLE) AS customer_payment_features__failure_rate_30d, CAST(fc.recovery_rate_30d AS DOUBLE) AS recovery_rate_30d,
  CAST(fm.failure_rate_30d AS DOUBLE) AS merchant_payment_features__failure_rate_30d, fc.consecutive_failures, fc.customer_tier,
  fc.days_since_first_payment AS churn_days FROM p LEFT JOIN fc USING (customer_id) LEFT JOIN fm USING (merchant_id)"""
ORACLES["x05_latest_features"] = f"""WITH {SNAP}, a AS (SELECT * FROM snap WHERE {ALIVE} QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY ft DESC) = 1),
e AS (SELECT DISTINCT 'cus_' || user_id AS customer_id FROM events) SELECT e.customer_id, {', '.join('a.' + f for f in SNAP_FIELDS)} FROM e LEFT JOIN a USING (customer_id)"""
_LIVE = "s.ft > l.provider_created_at - INTERVAL 1 DAY"
ORACLES["x06_point_in_time_join"] = f"""WITH {SNAP}, l AS (SELECT event_id, customer_id, provider_created_at FROM pe WHERE customer_id IS NOT NULL)
SELECT l.event_id, l.customer_id, {ts('l.provider_created_at')} AS provider_created_at, {', '.join(f'CASE WHEN {_LIVE} THEN s.{f} END AS {f}' for f in SNAP_FIELDS)},
  CASE WHEN {_LIVE} THEN {ts('s.ft')} END AS feature_ts FROM l ASOF LEFT JOIN snap s ON l.customer_id = s.customer_id AND l.provider_created_at >= s.ft"""
_NOW = "TIMESTAMP '2024-01-25 00:00:00'"
_L30, _L90 = f"provider_created_at > {_NOW} - INTERVAL 30 DAY", f"provider_created_at > {_NOW} - INTERVAL 90 DAY"
ORACLES["x07_feat_customer_windowed"] = f"""WITH {PE}, s AS (SELECT *, lead(status) OVER o AS nxt,
  count(*) FILTER (WHERE status <> 'failed') OVER (PARTITION BY customer_id ORDER BY provider_created_at DESC, event_id DESC) AS later_ok
  FROM pe WHERE customer_id IS NOT NULL AND provider_created_at <= {_NOW} WINDOW o AS (PARTITION BY customer_id ORDER BY provider_created_at, event_id)),
g AS (SELECT customer_id, {n(_L30)} AS total_payments_30d, {n(_L90)} AS total_payments_90d, {cents(f"{_L30} AND status = 'succeeded'")} AS total_amount_cents_30d,
  {n(f"{_L30} AND status = 'succeeded'")} AS paid, {n(f"{_L30} AND status = 'failed'")} AS failed_payments_30d,
  {n(f"{_L30} AND status = 'failed' AND nxt = 'succeeded'")} AS recovered_payments_30d, {n("status = 'failed' AND later_ok = 0")} AS consecutive_failures,
  min(provider_created_at) AS f, max(provider_created_at) AS l, max(provider_created_at) FILTER (WHERE status = 'failed') AS lb,
  count(DISTINCT payment_method_type) FILTER (WHERE {_L90}) AS payment_method_count,
  CAST(sum(CAST(round(fraud_score * 10000) AS BIGINT)) FILTER (WHERE {_L30}) AS DOUBLE) / nullif(count(fraud_score) FILTER (WHERE {_L30}), 0) / 10000 AS fs,
  {n(f"{_L30} AND risk_level = 'high'")} AS high_risk_payment_count FROM s GROUP BY 1)
SELECT customer_id, {ts(_NOW)} AS feature_timestamp, total_payments_30d, total_payments_90d, total_amount_cents_30d,
  CAST(CAST({ratio('total_amount_cents_30d', 'paid')} AS FLOAT) AS DOUBLE) AS avg_amount_cents, failed_payments_30d,
  CAST(CAST({ratio('failed_payments_30d', 'total_payments_30d')} AS FLOAT) AS DOUBLE) AS failure_rate_30d, consecutive_failures, recovered_payments_30d,
  CAST(CAST({ratio('recovered_payments_30d', 'failed_payments_30d')} AS FLOAT) AS DOUBLE) AS recovery_rate_30d,
  date_sub('day', f, {_NOW}) AS days_since_first_payment, date_sub('day', l, {_NOW}) AS days_since_last_payment, date_sub('day', lb, {_NOW}) AS days_since_last_failure,
  payment_method_count, CASE WHEN payment_method_count > 1 THEN 1 ELSE 0 END AS has_backup_payment_method,
  CAST(CAST(coalesce(fs, 0e0) AS FLOAT) AS DOUBLE) AS fraud_score_avg, high_risk_payment_count FROM g"""

# --- sources and sinks -----------------------------------------------------------------------------------

STORE = f"{PE}, store AS (SELECT *, n % 3 = 0 AS loaded, CASE WHEN n % 3 = 0 THEN ingested_at END AS loaded_at FROM pe)"
ORACLES["s01_read_unloaded"] = f"WITH {STORE} SELECT event_id, {ts('ingested_at')} AS ingested_at, amount_cents FROM store WHERE NOT loaded"
ORACLES["s02_read_by_date"] = f"""WITH {STORE} SELECT event_id, {ts('ingested_at')} AS ingested_at FROM store
WHERE CAST(ingested_at AS DATE) = DATE '2024-01-15'"""
ORACLES["s03_mark_loaded"] = f"""WITH {STORE} SELECT event_id, loaded OR n % 5 = 0 AS loaded_to_iceberg,
  CASE WHEN n % 5 = 0 THEN {ts(AS_OF)} ELSE {ts('loaded_at')} END AS loaded_at FROM store"""
ORACLES["s04_event_count"] = f"""WITH {STORE} SELECT 'all' AS state, count(*) AS event_count FROM store
UNION ALL SELECT 'loaded', count(*) FILTER (WHERE loaded) FROM store UNION ALL SELECT 'unloaded', count(*) FILTER (WHERE NOT loaded) FROM store"""
_STORE_OUT = BRONZE_OUT.replace(", days_to_churn_estimate", ", CAST(days_to_churn_estimate AS BIGINT) AS days_to_churn_estimate")
ORACLES["s05_conform"] = f"WITH {STG} SELECT {_STORE_OUT} FROM stg"
ORACLES["s06_ingest_events"] = f"WITH {STG} SELECT {_STORE_OUT} FROM stg WHERE n % 3 <> 0"
ORACLES["s08_ingest_profile"] = f"""WITH {PE} SELECT 'event_type' AS metric, event_type AS value, count(*) AS n FROM pe GROUP BY 2
UNION ALL SELECT 'provider', provider, count(*) FROM pe GROUP BY 2
UNION ALL SELECT 'min_ingested_at', rtrim(strftime(min(ingested_at), '%Y-%m-%d %H:%M:%S.%f'), '0'), count(*) FROM pe
UNION ALL SELECT 'max_ingested_at', rtrim(strftime(max(ingested_at), '%Y-%m-%d %H:%M:%S.%f'), '0'), count(*) FROM pe"""

ORACLES["s15_upsert"] = f"""WITH {PE}, p AS (SELECT *, ingested_at < TIMESTAMP '2024-01-20' AND amount_cents % 10 = 0 AS changed FROM pe)
SELECT event_id, CASE WHEN changed THEN 'revised' ELSE status END AS status, amount_cents,
  {ts("CASE WHEN changed THEN ingested_at + INTERVAL 100 DAY ELSE ingested_at END")} AS ingested_at FROM p"""
ORACLES["s15_upsert_partitions"] = f"""WITH {PE}, p AS (SELECT event_id, CAST(provider_created_at AS DATE) AS d,
  CASE WHEN provider_created_at >= TIMESTAMP '2024-01-19' THEN 'revised' ELSE status END AS status FROM pe)
SELECT event_id, {day('d')} AS event_date, status FROM p"""
ORACLES["s16_upsert_enrichment"] = f"""WITH {PE}, p AS (SELECT *, ingested_at < TIMESTAMP '2024-01-20' AND amount_cents % 4 = 0 AS again FROM pe)
SELECT event_id, amount_cents, status, CASE WHEN again THEN 0.5e0 ELSE fraud_score END AS fraud_score,
  CASE WHEN NOT again THEN risk_level END AS risk_level, CASE WHEN again THEN {ts(AS_OF)} ELSE {ts('ingested_at')} END AS ingested_at FROM p"""
ORACLES["s18_snapshot_as_of"] = f"""WITH {STG}, old AS (SELECT * FROM stg WHERE ingested_at < TIMESTAMP '2024-01-20'), {merchant_metrics('old', 'a')}
SELECT merchant_id, total_transactions, total_revenue_cents FROM a"""

# --- normalization -----------------------------------------------------------------------------------------

CUR20 = ", ".join(f"'{c}'" for c in C.SUPPORTED_CURRENCIES)
NULLS = ", ".join(f"'{c}'" for c in C.NULL_SPELLINGS)


def denull(x: str) -> str:
    return f"CASE WHEN {x} NOT IN ({NULLS}) THEN {x} END"


def mapped(x: str, table: dict[str, str], otherwise: str = "NULL") -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"CASE {x} {arms} ELSE {otherwise} END"


EVENT_TYPE = {
    "stripe": mapped("raw_type", C.STRIPE_EVENT_TYPES, "raw_type"),
    "square": mapped("raw_type", C.SQUARE_EVENT_TYPES, "raw_type"),
    "adyen": mapped("raw_type", C.ADYEN_EVENT_TYPES, "lower(raw_type)"),
    "braintree": mapped("raw_type", C.BRAINTREE_EVENT_TYPES, "replace(raw_type, '_', '.')"),
}
SECOND = "date_trunc('second', ts)"
ISO = f"strftime({SECOND}, '%Y-%m-%dT%H:%M:%SZ')"
TXN = "(id IS NOT NULL)"
ADYEN_STATUS = f"CASE WHEN NOT success THEN 'failed' ELSE {mapped('raw_type', C.ADYEN_STATUSES, 'lower(raw_type)')} END"
ADYEN_METHOD = mapped("lower(adyen_method)", C.ADYEN_METHODS, "lower(adyen_method)")
ADYEN_BRAND = f"CASE WHEN k % 2 = 0 THEN '411111' ELSE {mapped('lower(adyen_method)', C.ADYEN_BRANDS)} END"
REFUSAL = ("CASE k % 8 WHEN 0 THEN 'declined' WHEN 1 THEN 'fraud' WHEN 2 THEN 'expired_card' WHEN 3 THEN 'insufficient_funds' "
           "WHEN 4 THEN 'invalid_card' WHEN 5 THEN 'blocked' WHEN 6 THEN 'canceled' ELSE 'unknown' END")
BT_STATUS = f"""coalesce({mapped('raw_type', C.BRAINTREE_KIND_STATUSES)}, {mapped('lower(txn_status)', C.BRAINTREE_TXN_STATUSES, 'lower(txn_status)')},
  lower(replace(raw_type, '_', ' ')))"""
BT_METHOD = mapped("lower(instrument)", C.BRAINTREE_METHODS, "lower(instrument)")
BT_BRAND = mapped("lower(bt_brand)", C.BRAINTREE_BRANDS, "lower(bt_brand)")
BT_ID = f"raw_type || '_' || CASE WHEN {TXN} THEN 'txn_' || id ELSE {ISO} END"
BT_AMOUNT = "CASE WHEN k % 9 = 0 THEN 0 ELSE amount END"
SQ_METHOD = mapped("upper(source_type)", C.SQUARE_SOURCE_TYPES, "lower(source_type)")
SQ_STATUS = mapped("upper(square_status)", C.SQUARE_STATUSES, "lower(square_status)")
SQ_REFUND = mapped("upper(square_status)", C.SQUARE_REFUND_STATUSES, "lower(square_status)")
IS_REFUND = "square_form = 'refund'"

# Error codes in order; a NULL entry is no error.
_AMT = "CASE WHEN amount < 0 THEN 'INVALID_AMOUNT_NEGATIVE' WHEN amount > 100000000 THEN 'INVALID_AMOUNT_TOO_LARGE' END"
_CUR = f"CASE WHEN upper(trim(currency)) NOT IN ({CUR20}) THEN 'INVALID_CURRENCY' END"
_NOID = "CASE WHEN id IS NULL THEN '{}' END"
_ERRS = {
    "stripe": f"[{_NOID.format('MISSING_EVENT_ID')}, {_AMT}, {_CUR}]",
    "square": f"""CASE square_form WHEN 'no_data' THEN [{_NOID.format('MISSING_EVENT_ID')}, 'MISSING_DATA']
      WHEN 'no_payment' THEN [{_NOID.format('MISSING_EVENT_ID')}, 'MISSING_PAYMENT'] WHEN 'unknown' THEN [{_NOID.format('MISSING_EVENT_ID')}, 'UNKNOWN_OBJECT_TYPE']
      WHEN 'refund' THEN [{_NOID.format('MISSING_EVENT_ID')}, CASE WHEN amount < 0 OR amount > 100000000 THEN 'INVALID_AMOUNT' END, {_CUR}]
      ELSE [{_NOID.format('MISSING_EVENT_ID')}, {_AMT}, {_CUR}] END""",
    "adyen": f"[{_NOID.format('MISSING_PSP_REFERENCE')}, {_AMT}, {_CUR}]",
    "braintree": f"""[CASE WHEN id IS NULL AND raw_type LIKE 'transaction!_%' ESCAPE '!' THEN 'MISSING_TRANSACTION_ID' END,
      CASE WHEN n % 29 = 0 THEN 'INVALID_AMOUNT' WHEN k % 9 = 0 THEN NULL WHEN amount < 0 OR amount > 100000000 THEN 'INVALID_AMOUNT' END,
      CASE WHEN k % 7 <> 0 THEN {_CUR} END]""",
}
_LIST = " ".join(f"WHEN '{p}' THEN {e}" for p, e in _ERRS.items())
JUDGED = f"""{WH}, x AS (SELECT *, {W.TOPIC_SQL} AS topic,
  list_filter(CASE WHEN form <> 'object' THEN ['INVALID_JSON'] ELSE CASE provider {_LIST} END END, lambda e: e IS NOT NULL) AS errs FROM w),
j AS (SELECT *, array_to_string(errs, ',') AS codes, errs[1] AS first_code, len(errs) = 0 AS ok,
  CASE WHEN form = 'object' THEN CASE provider WHEN 'stripe' THEN 'evt_' || id WHEN 'square' THEN 'evt_' || id
    WHEN 'adyen' THEN 'psp_' || id || '_' || raw_type ELSE {BT_ID} END END AS dlq_id,
  CASE provider WHEN 'stripe' THEN {EVENT_TYPE['stripe']} WHEN 'square' THEN {EVENT_TYPE['square']}
    WHEN 'adyen' THEN {EVENT_TYPE['adyen']} ELSE {EVENT_TYPE['braintree']} END AS event_type FROM x)"""
DLQ = "dlq AS (SELECT *, provider || ':' || dlq_id AS event_id FROM j WHERE NOT ok)"
NULL_TEXT = "CAST(NULL AS VARCHAR)"
CURRENCY = "upper(trim(currency))"

UNIFIED = {
    "stripe": {
        "merchant_id": denull("merchant"), "customer_id": denull("customer"), "amount_cents": "amount", "currency": CURRENCY,
        "payment_method_type": """CASE WHEN raw_type LIKE 'payment_intent%' THEN CASE WHEN k % 2 = 0 THEN 'card' ELSE 'us_bank_account' END
          WHEN raw_type LIKE 'charge%' THEN CASE WHEN k % 3 <> 0 THEN 'card' END ELSE 'refund' END""",
        "card_brand": "CASE WHEN raw_type LIKE 'charge%' THEN 'visa' END", "card_last_four": "CASE WHEN raw_type LIKE 'charge%' THEN '4242' END",
        "status": "CASE t WHEN 'signup' THEN 'unknown' WHEN 'error' THEN 'requires_payment_method' ELSE 'succeeded' END",
        "failure_code": "CASE WHEN t = 'error' AND k % 2 = 0 THEN 'card_declined' WHEN t = 'click' AND k % 4 = 0 THEN 'lost_or_stolen_card' END",
        "failure_message": "CASE WHEN t = 'error' THEN CASE WHEN k % 2 = 1 THEN 'Bank said no' ELSE 'Declined' END END",
        "metadata": """'{"merchant_id":"' || merchant || '","order_id":"o' || n || '"}'""", "provider_created_at": ts(SECOND),
        "event_id": "'stripe:evt_' || id", "provider_event_id": "'evt_' || id",
    },
    "square": {
        "merchant_id": denull("merchant"), "customer_id": f"CASE WHEN NOT {IS_REFUND} THEN {denull('customer')} END",
        "amount_cents": "amount", "currency": CURRENCY, "payment_method_type": f"CASE WHEN {IS_REFUND} THEN 'refund' ELSE {SQ_METHOD} END",
        "card_brand": f"CASE WHEN NOT {IS_REFUND} AND source_type = 'CARD' THEN 'VISA' END", "card_last_four": NULL_TEXT,
        "status": f"CASE WHEN {IS_REFUND} THEN CASE square_status WHEN 'ODD' THEN 'rejected' ELSE {SQ_REFUND} END ELSE {SQ_STATUS} END",
        "failure_code": NULL_TEXT, "failure_message": NULL_TEXT,
        "metadata": f"""CASE WHEN {IS_REFUND} THEN '{{"location_id":"L1","payment_id":"p' || n || '","reason":"r"}}'
          ELSE '{{"location_id":"L1","order_id":"o' || n || '","reference_id":null}}' END""",
        "provider_created_at": f"CASE WHEN NOT {IS_REFUND} AND k % 10 = 3 THEN {ts(AS_OF)} ELSE {ts(SECOND)} END",
        "event_id": "'square:evt_' || id", "provider_event_id": "'evt_' || id",
    },
    "adyen": {
        "merchant_id": "merchant", "customer_id": NULL_TEXT, "amount_cents": "amount", "currency": CURRENCY,
        "payment_method_type": ADYEN_METHOD, "card_brand": ADYEN_BRAND, "card_last_four": "'1234'", "status": ADYEN_STATUS,
        "failure_code": f"CASE WHEN NOT success THEN {REFUSAL} END", "failure_message": "CASE WHEN NOT success THEN refusal END",
        "metadata": """'{"original_reference":null,"merchant_reference":"o' || n || '","operations":["CANCEL"],"live":' ||
          CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END || '}'""", "provider_created_at": ts(SECOND),
        "event_id": "'adyen:psp_' || id || '_' || raw_type", "provider_event_id": "'psp_' || id",
    },
    "braintree": {
        "merchant_id": "merchant", "customer_id": "customer", "amount_cents": BT_AMOUNT,
        "currency": f"CASE WHEN k % 7 = 0 THEN 'USD' ELSE {CURRENCY} END", "payment_method_type": BT_METHOD, "card_brand": BT_BRAND,
        "card_last_four": "'9876'", "status": BT_STATUS,
        "failure_code": f"CASE WHEN {BT_STATUS} = 'failed' THEN coalesce(txn_status, 'unknown') END",
        "failure_message": f"CASE WHEN {BT_STATUS} = 'failed' THEN 'Transaction ' || coalesce(txn_status, 'failed') END",
        "metadata": """'{"kind":"' || raw_type || '","transaction_type":"sale","subscription":' || CASE WHEN raw_type LIKE 'subscription%'
          THEN '{"id":"s' || n || '","status":null,"plan_id":"pl"}' ELSE 'null' END || ',"dispute":null,"dev_mode":false}'""",
        "provider_created_at": ts(SECOND), "event_id": f"'braintree:' || {BT_ID}",
        "provider_event_id": f"CASE WHEN {TXN} THEN 'txn_' || id ELSE {BT_ID} END",
    },
}


def unified(provider: str, *columns: str) -> str:
    u = {**UNIFIED[provider], "provider": "provider", "event_type": "event_type"}
    picked = columns or tuple(u)
    return f"WITH {JUDGED} SELECT {', '.join(f'{u[c]} AS {c}' for c in ('event_id', *[p for p in picked if p != 'event_id']))} FROM j WHERE ok AND provider = '{provider}'"


ORACLES["n09_stripe_to_unified"] = unified("stripe")
ORACLES["n10_stripe_payment_method"] = unified("stripe", "payment_method_type")
ORACLES["n11_stripe_card"] = unified("stripe", "card_brand", "card_last_four")
ORACLES["n12_stripe_status"] = unified("stripe", "status")
ORACLES["n13_stripe_failure"] = unified("stripe", "failure_code", "failure_message")
ORACLES["n14_square_to_unified"] = unified("square")
ORACLES["n17_adyen_to_unified"] = unified("adyen")
ORACLES["n21_braintree_to_unified"] = unified("braintree")
_SQ = UNIFIED["square"]
ORACLES["n15_square_payments_and_refunds"] = f"""WITH {JUDGED} SELECT {_SQ['event_id']} AS event_id, {IS_REFUND} AS is_refund, {_SQ['status']} AS status,
  amount AS amount_cents, {_SQ['customer_id']} AS customer_id FROM j WHERE ok AND provider = 'square'"""
ORACLES["n01_parse_payload"] = f"WITH {WH} SELECT n AS \"offset\", form = 'object' AS readable FROM w WHERE provider = 'stripe'"
ORACLES["n02_null_spellings"] = f"WITH {WH} SELECT n, {denull('merchant')} AS merchant, {denull('customer')} AS customer FROM w"
ORACLES["n03_null_columns"] = f"""WITH {WH} SELECT n, k, {denull('merchant')} AS merchant, {denull('customer')} AS customer,
  {denull('txn_status')} AS txn_status, amount FROM w"""
ORACLES["n04_validate_currency"] = f"""WITH {WH}, t AS (SELECT n, CASE WHEN n % 41 = 0 THEN NULL WHEN n % 43 = 0 THEN ' ' WHEN n % 47 = 0 THEN 'EURO'
  ELSE currency END AS c FROM w), m AS (SELECT n, upper(trim(c)) AS c, CASE WHEN c IS NULL THEN 'Currency is required'
  WHEN trim(c) = '' THEN 'Currency cannot be empty' WHEN length(trim(c)) <> 3 THEN 'Currency must be 3 characters, got ' || length(trim(c))
  WHEN upper(trim(c)) NOT IN ({CUR20}) THEN 'Unsupported currency: ' || upper(trim(c)) END AS message FROM t)
SELECT n, message IS NULL AS is_valid, CASE WHEN message IS NULL THEN c END AS value, message FROM m"""
_AMOUNT_MSG = """CASE WHEN n % 6 = 4 THEN 'Amount is required' WHEN n % 6 IN (3, 5) THEN 'Amount must be an integer'
  WHEN amount < 0 THEN 'Amount must be >= 0, got ' || amount WHEN amount > 100000000 THEN 'Amount must be <= 100000000, got ' || amount END"""
ORACLES["n05_validate_amount"] = f"""WITH {WH}, m AS (SELECT n, amount, {_AMOUNT_MSG} AS message FROM w)
SELECT n, message IS NULL AS is_valid, CASE WHEN message IS NULL THEN amount END AS value, message FROM m"""
ORACLES["n06_validate_refund_amount"] = f"""WITH {WH}, m AS (SELECT n, amount, CASE WHEN amount < 0 THEN 'Amount must be >= 0, got ' || amount
  WHEN amount > 5000 THEN 'Amount must be <= 5000, got ' || amount END AS message FROM w)
SELECT n, message IS NULL AS is_valid, CASE WHEN message IS NULL THEN amount END AS value, message FROM m"""
ORACLES["n07_collect_errors"] = f"WITH {JUDGED} SELECT n AS \"offset\", codes, first_code FROM j"
ORACLES["n08_event_types"] = f"WITH {JUDGED} SELECT n, raw_type, event_type FROM j"
ORACLES["n16_square_lookups"] = f"WITH {WH} SELECT n, {SQ_METHOD} AS method, {SQ_STATUS} AS status, {SQ_REFUND} AS refund_status FROM w"
ORACLES["n18_adyen_status"] = f"WITH {WH} SELECT n, {ADYEN_STATUS} AS status FROM w WHERE provider = 'adyen'"
ORACLES["n19_adyen_methods"] = f"WITH {WH} SELECT n, {ADYEN_METHOD} AS method, {ADYEN_BRAND} AS brand, '1234' AS last4 FROM w"
ORACLES["n20_adyen_failure_code"] = f"WITH {WH} SELECT n, {REFUSAL} AS code FROM w"
ORACLES["n22_braintree_status"] = f"WITH {WH} SELECT n, {BT_STATUS} AS status FROM w WHERE provider = 'braintree'"
ORACLES["n23_braintree_methods"] = f"WITH {WH} SELECT n, {BT_METHOD} AS method, {BT_BRAND} AS brand FROM w"
ORACLES["n24_parse_iso"] = f"""WITH {WH} SELECT n, CASE n % 5 WHEN 0 THEN {ts(SECOND)} WHEN 1 THEN {ts(f'{SECOND} - INTERVAL 2 HOUR')} ELSE {ts(AS_OF)} END AS created FROM w"""
DLQ_PROVIDER_ID = "dlq_id AS provider_event_id"
ORACLES["n25_dlq_records"] = f"""WITH {JUDGED}, {DLQ} SELECT event_id, provider, {DLQ_PROVIDER_ID}, codes, first_code AS failure_reason, topic AS source_topic,
  n % 3 AS kafka_partition, n AS kafka_offset, {ts(AS_OF)} AS quarantined_at, 1 AS schema_version FROM dlq"""
_IDS = " ".join(f"WHEN '{p}' THEN {UNIFIED[p]['event_id']}" for p in UNIFIED)
_AMTS = f"CASE WHEN provider = 'braintree' THEN {BT_AMOUNT} ELSE amount END"
ORACLES["n26_normalize"] = f"""WITH {JUDGED}, {DLQ} SELECT CASE provider {_IDS} END AS event_id, 'valid' AS outcome, event_type, {_AMTS} AS amount_cents FROM j WHERE ok
UNION ALL SELECT event_id, 'dlq', first_code, NULL FROM dlq"""
ORACLES["n27_explode_adyen_batch"] = f"""WITH {WH}, r AS (SELECT *, unnest([0, 1]) AS item_no FROM w WHERE provider = 'adyen' AND form <> 'cut'),
-- A list in place of an item is an item without fields; a request that is cut off has no items.
c AS (SELECT * REPLACE (CASE WHEN form = 'object' THEN amount END AS amount), CASE WHEN form = 'object' THEN CASE WHEN item_no = 0 THEN raw_type ELSE 'REFUND' END END AS code FROM r)
SELECT n AS "offset", item_no, 'psp_' || id || '_' || code AS key, CASE WHEN n % 2 = 0 THEN 'true' ELSE 'false' END AS live, code AS event_code,
  CAST(amount AS VARCHAR) AS amount FROM c"""
ORACLES["n28_route_topic"] = f"""WITH {WH} SELECT n, 'webhooks.' || provider || '.' || CASE provider
  WHEN 'stripe' THEN CASE WHEN raw_type LIKE 'payment_intent.%' THEN 'payment_intent' WHEN raw_type LIKE 'charge.%' THEN 'charge' ELSE 'refund' END
  WHEN 'square' THEN split_part(raw_type, '.', 1) ELSE 'notification' END AS topic FROM w"""
_BAD_LEN = "CASE WHEN length(currency) <> 3 THEN 'string_length' END"
_NEG = "CASE WHEN amount < 0 THEN 'greater_than_equal' END"
_MISS = lambda cond: f"CASE WHEN {cond} THEN 'missing' END"
_MIS = "string_pattern_mismatch"
_STRIPE_EVENT = f"{_MISS('id IS NULL')}, {_NEG}, {_BAD_LEN}, {_MISS(chr(116) + ' = ' + chr(39) + 'signup' + chr(39))}, {_MISS('k % 2 <> 0')}"
_CUS = f"CASE WHEN NOT regexp_full_match(customer, 'cus_[a-zA-Z0-9]+') THEN '{_MIS}' END"
_PI = f"CASE WHEN k % 12 = 5 THEN '{_MIS}' END"
_STRUCT = {
    # A refund of a chargeback-type event keeps status succeeded; only signups lack a status.
    "stripe": f"""CASE WHEN raw_type LIKE 'payment_intent%' THEN [{_STRIPE_EVENT}, {_PI}, {_CUS}]
      WHEN raw_type LIKE 'charge%' THEN [{_STRIPE_EVENT}, {_PI}, {_MISS('k % 11 = 0')}, {_CUS}] ELSE [{_STRIPE_EVENT}, {_PI}] END""",
    "square": f"""CASE WHEN square_form = 'no_data' THEN [{_MISS('id IS NULL')}, 'missing', 'missing', 'missing']
      WHEN square_form IN ('payment', 'unnamed') AND raw_type LIKE 'payment%' THEN [{_MISS('id IS NULL')}, {_MISS('k % 10 = 4')},
        CASE WHEN square_status IN ('approved', 'ODD') THEN 'literal_error' END, {_NEG}, {_BAD_LEN}]
      WHEN square_form = 'refund' THEN [{_MISS('id IS NULL')}, CASE WHEN square_status = 'approved' THEN 'literal_error' END, {_NEG}, {_BAD_LEN}]
      ELSE [{_MISS('id IS NULL')}] END""",
    "adyen": f"[{_MISS('id IS NULL')}, {_NEG}, {_BAD_LEN}]",
    "braintree": f"[{_MISS('id IS NULL')}]",
}
_STRUCT_ARMS = " ".join(f"WHEN '{p}' THEN {e}" for p, e in _STRUCT.items())
ORACLES["n29_check_structure"] = f"""WITH {WH} SELECT provider, n AS "offset", array_to_string(list_filter(
  CASE WHEN form <> 'object' THEN ['json_invalid'] ELSE CASE provider {_STRUCT_ARMS} END END, lambda e: e IS NOT NULL), ',') AS codes FROM w"""
ORACLES["n30_audit_signatures"] = f"""WITH {WH}, v AS (SELECT provider, n, CASE WHEN provider = 'adyen' AND form <> 'object' THEN 'missing hmacSignature' WHEN n % 11 = 0 THEN CASE provider WHEN 'adyen' THEN 'missing hmacSignature' ELSE 'missing signature header' END
  WHEN provider = 'stripe' AND n % 17 = 0 THEN 'invalid signature header format' WHEN provider = 'stripe' AND n % 19 = 0 THEN 'invalid timestamp format'
  WHEN provider = 'stripe' AND n % 13 = 0 THEN 'timestamp outside tolerance window' WHEN provider = 'stripe' AND n % 23 = 0 THEN 'no v1 signature'
  -- The fixture signs an amount of 0 as "0"; the audited rule signs it as empty text, so it does not match.
  WHEN n % 7 = 0 OR (provider = 'adyen' AND amount = 0) THEN 'signature mismatch' END AS reason FROM w WHERE provider <> 'braintree')
SELECT provider, n AS "offset", CASE WHEN reason IS NULL THEN 'valid' WHEN reason LIKE 'timestamp outside%' THEN 'expired' ELSE 'invalid' END AS verdict, reason FROM v"""
ORACLES["n31_decode_braintree"] = f"""WITH {WH} SELECT n, CASE WHEN n % 13 = 0 THEN 'unknown' WHEN n % 5 = 0 THEN raw_type WHEN n % 11 = 0 OR n % 7 = 0 THEN 'unknown' ELSE raw_type END AS kind,
  CASE WHEN n % 13 = 0 THEN NULL WHEN n % 5 = 0 OR n % 11 <> 0 THEN {ISO} END AS timestamp,
  CASE WHEN n % 13 <> 0 AND n % 5 <> 0 AND n % 11 <> 0 THEN '{{"id":"txn_' || n || '"}}' END AS transaction, true AS dev_mode
  FROM w WHERE provider = 'braintree'"""
ORACLES["n32_ingress_dlq"] = f"""WITH {WH} SELECT 'square' AS provider, 'invalid_signature' AS error_type,
  CASE WHEN n % 11 = 0 THEN 'missing signature header' ELSE 'signature mismatch' END AS error_message, {ts(AS_OF)} AS received_at, 0 AS retry_count,
  true AS has_payload, 1 AS header_count FROM w WHERE provider = 'square' AND (n % 11 = 0 OR n % 7 = 0)"""
ORACLES["s07_ingest_quarantine"] = f"""WITH {JUDGED}, {DLQ} SELECT event_id, provider, first_code AS failure_reason, topic AS source_topic, n % 3 AS kafka_partition,
  n AS kafka_offset, false AS reviewed, {ts(AS_OF)} AS quarantined_at FROM dlq WHERE n % 5 <> 0"""
ORACLES["s08_failure_profile"] = f"""WITH {JUDGED}, {DLQ} SELECT first_code AS failure_reason, count(*) AS n FROM dlq WHERE n % 5 <> 0
GROUP BY 1 ORDER BY n DESC, failure_reason LIMIT 10""".replace("WHERE n % 5", "WHERE dlq.n % 5")
ORACLES["s12_raw_topics"] = f"WITH {JUDGED} SELECT topic, count(*) AS messages FROM j GROUP BY 1"
ORACLES["s13_normalized_and_dlq_messages"] = f"""WITH {JUDGED}, {DLQ}, u AS (SELECT CASE provider {_IDS} END AS e FROM j WHERE ok)
SELECT '{C.NORMALIZED_TOPIC}' AS topic, e AS key, e AS event_id FROM u UNION ALL SELECT '{C.DLQ_TOPIC}', dlq_id, event_id FROM dlq"""
DLQ_KEY = "coalesce(event_id, (n % 3) || '-' || n)"
ORACLES["s17_upsert_quarantine"] = f"""WITH {JUDGED}, {DLQ}, k AS (SELECT *, {DLQ_KEY} AS dlq_key FROM dlq QUALIFY row_number() OVER (PARTITION BY dlq_key ORDER BY n % 3, n) = 1)
SELECT dlq_key, event_id, CASE WHEN n % 4 = 0 THEN 'AGAIN' ELSE first_code END AS failure_reason, n AS kafka_offset,
  CASE WHEN n % 4 = 0 THEN {ts(f'{AS_OF} + INTERVAL 1 DAY')} ELSE {ts(AS_OF)} END AS updated_at FROM k"""
ORACLES["v11_dedupe"] = f"""WITH {PE} SELECT event_id, n * 10 + 1 AS "offset", amount_cents FROM pe WHERE n % 61 <> 0"""
ORACLES["v12_dedupe_dlq"] = f"""WITH {JUDGED}, {DLQ} SELECT {DLQ_KEY} AS dlq_key, event_id, topic AS source_topic, n % 3 AS kafka_partition, n AS kafka_offset
FROM dlq QUALIFY row_number() OVER (PARTITION BY {DLQ_KEY} ORDER BY n % 3, n) = 1"""
ORACLES["v13_stream_interval_metrics"] = f"""WITH {BK} SELECT {ts('b')} AS interval_start, {ts("b + INTERVAL '15 minutes'")} AS interval_end, count(*) AS transaction_count,
  {n(OK)} AS successful_count, {n(BAD)} AS failed_count, {REVENUE} AS revenue_cents, {n(HIGH)} AS high_risk_count, true AS customers_close, true AS merchants_close FROM bk GROUP BY b"""
_NORM = f"{JUDGED}, u AS (SELECT *, CASE provider {_IDS} END AS event_id, {_AMTS} AS cents FROM j WHERE ok)"


def _intake_counters(times: int) -> str:
    return f"""WITH {_NORM}, {DLQ}, dead AS (SELECT count(DISTINCT {DLQ_KEY}) AS n FROM dlq), ids AS (SELECT count(DISTINCT event_id) AS n FROM u)
SELECT {times} * (SELECT count(*) FROM j) AS messages_consumed, ids.n AS workflows_started,
  {times} * (SELECT count(*) FROM j) - ids.n - dead.n AS duplicates_skipped, 0 AS errors, dead.n AS dlq_workflows FROM ids, dead"""


ORACLES["v14_stream_counters"] = _intake_counters(1)
ORACLES["v14_redelivered_counters"] = _intake_counters(2)
ORACLES["v14_redelivered_quarantine"] = f"""WITH {JUDGED}, {DLQ} SELECT {DLQ_KEY} AS dlq_key, topic AS source_topic
FROM dlq QUALIFY row_number() OVER (PARTITION BY {DLQ_KEY} ORDER BY n % 3, n) = 1"""
_ST = " ".join(f"WHEN '{p}' THEN {UNIFIED[p]['status']}" for p in UNIFIED)
_CU = " ".join(f"WHEN '{p}' THEN {UNIFIED[p]['currency']}" for p in UNIFIED)
CUR10 = ", ".join(f"'{c}'" for c in C.RULE_CURRENCIES)
ORACLES["v14_intake_bronze"] = f"""WITH {_NORM} SELECT event_id, event_type, cents AS amount_cents, CASE provider {_CU} END AS currency, CASE provider {_ST} END AS status,
  CASE WHEN cents > 0 AND cents <= 100000000 AND CASE provider {_CU} END IN ({CUR10}) AND trim(CASE provider {_ST} END) <> '' THEN 'passed' ELSE 'failed' END AS validation_status,
  {ts(AS_OF)} AS ingested_at FROM u"""
ORACLES["v14_redelivered_bronze"] = ORACLES["v14_intake_bronze"]

# --- enrichment ------------------------------------------------------------------------------------------------

UN = f"{PE}, un AS ({W.UNIFIED_SQL})"


def rule_list(customers: str, merchants: str) -> str:
    return f"""list_filter([CASE WHEN amount_cents <= 0 THEN 'AMOUNT_NOT_POSITIVE' WHEN amount_cents > 100000000 THEN 'AMOUNT_EXCEEDS_MAXIMUM' END,
  CASE WHEN upper(currency) NOT IN ({CUR10}) THEN 'CURRENCY_NOT_ALLOWED' END, CASE WHEN {customers} THEN 'CUSTOMER_BLOCKLISTED' END,
  CASE WHEN {merchants} THEN 'MERCHANT_BLOCKLISTED' END, CASE WHEN trim(status) = '' THEN 'MISSING_REQUIRED_FIELD' END], lambda e: e IS NOT NULL)"""


_LITERAL = rule_list("customer_id IN ('" + "', '".join(C.BLOCKED_CUSTOMERS) + "')", "merchant_id IN ('" + "', '".join(C.BLOCKED_MERCHANTS) + "')")
ORACLES["e01_business_rules"] = f"""WITH {UN}, r AS (SELECT *, {_LITERAL} AS e FROM un) SELECT event_id, len(e) = 0 AS is_valid, array_to_string(e, ',') AS codes,
  CASE WHEN amount_cents > 10000 THEN 1 ELSE 0 END AS warning_count, 5 AS rules FROM r"""
_TABLES = rule_list("customer_id IN (SELECT 'cus_' || c_custkey FROM customer WHERE c_acctbal < 0)",
                    "merchant_id IN (SELECT 'merch_' || s_suppkey FROM supplier WHERE s_acctbal < 0)")
ORACLES["e01_business_rules_with_tables"] = f"""WITH {UN}, r AS (SELECT *, {_TABLES} AS e FROM un)
SELECT event_id, len(e) = 0 AS is_valid, array_to_string(e, ',') AS codes FROM r"""
SCORED = "(contains(lower(status), 'succeeded') OR contains(lower(status), 'captured') OR contains(lower(event_type), 'succeeded') OR contains(lower(event_type), 'captured'))"
RETRIED = "(contains(lower(status), 'failed') OR contains(lower(event_type), 'failed') OR contains(lower(status), 'declined'))"
HAS_CUSTOMER = "coalesce(customer_id <> '', false)"
ORACLES["e02_event_gates"] = f"WITH {UN} SELECT event_id, {SCORED} AS scored, {RETRIED} AS retried, {HAS_CUSTOMER} AS churn FROM un"


def noise(key: str, modulus: int) -> str:
    return f"CAST(concat('0x', substr(md5({key}), 1, 8)) AS BIGINT) % {modulus}"


FRAUD_SCORE = f"""greatest(0, least(10000, 500 + CASE WHEN amount_cents > 100000 THEN 2500 WHEN amount_cents > 50000 THEN 1500 ELSE 0 END
  + CASE WHEN {HAS_CUSTOMER} THEN 0 ELSE 1500 END + CASE WHEN lower(card_brand) IN ('unknown', 'other') THEN 1000 ELSE 0 END + {noise('event_id', 1001)} - 500)) / 1e4"""
FRAUD_FACTORS = f"""concat_ws(',', CASE WHEN amount_cents > 100000 THEN 'very_high_amount' WHEN amount_cents > 50000 THEN 'high_amount' END,
  CASE WHEN NOT {HAS_CUSTOMER} THEN 'guest_checkout' END, CASE WHEN lower(card_brand) IN ('unknown', 'other') THEN 'unknown_card_brand' END)"""
ORACLES["e03_fraud_score_rules"] = f"WITH {UN} SELECT event_id, {FRAUD_SCORE} AS fraud_score, {FRAUD_FACTORS} AS factors FROM un"


def churn_score(streak: str, gap: str) -> str:
    return f"""greatest(0, least(10000, 500 + CASE WHEN {streak} >= 3 THEN 3500 WHEN {streak} >= 1 THEN 1500 ELSE 0 END
  + CASE WHEN {gap} > 30 THEN 1500 ELSE 0 END + {noise('customer_id', 1000)} - 500)) / 1e4"""


_S5, _G5 = "(amount_cents % 5)", "(amount_cents % 61)"
ORACLES["e05_churn_rules"] = f"""WITH {STG} SELECT event_id, {churn_score(_S5, _G5)} AS probability,
  concat_ws(',', CASE WHEN {_S5} >= 3 THEN 'multiple_consecutive_failures' WHEN {_S5} >= 1 THEN 'recent_failure' END, CASE WHEN {_G5} > 30 THEN 'payment_gap' END) AS factors,
  concat_ws(',', CASE WHEN {_S5} >= 3 THEN 'immediate_customer_outreach' WHEN {_S5} >= 1 THEN 'send_payment_update_reminder' END,
    CASE WHEN {_G5} > 30 THEN 'engagement_campaign' END) AS actions FROM stg WHERE customer_id IS NOT NULL"""
FAILING = "(contains(lower(status), 'failed') OR contains(lower(status), 'declined'))"
ORACLES["e07_churn_signals"] = f"""WITH {UN} SELECT event_id, CASE WHEN {FAILING} THEN 1 ELSE 0 END AS consecutive_failures, 5 AS days_since_last_payment,
  CASE WHEN {FAILING} THEN 0 ELSE 30 END AS days_since_last_failure FROM un"""
ORACLES["e07_churn_signals_history"] = f"""WITH {UN}, s AS (SELECT *, count(*) FILTER (WHERE status <> 'failed') OVER (PARTITION BY customer_id
  ORDER BY provider_created_at DESC, event_id DESC) AS later_ok FROM pe WHERE customer_id IS NOT NULL),
h AS (SELECT customer_id, {n("status = 'failed' AND later_ok = 0")} AS streak, date_sub('day', max(provider_created_at), {AS_OF}) AS gap,
  date_sub('day', max(provider_created_at) FILTER (WHERE status = 'failed'), {AS_OF}) AS since FROM s GROUP BY 1)
SELECT event_id, CASE WHEN {FAILING} THEN greatest(coalesce(streak, 0), 1) ELSE coalesce(streak, 0) END AS consecutive_failures, coalesce(gap, 5) AS days_since_last_payment,
  CASE WHEN {FAILING} THEN 0 ELSE coalesce(since, 30) END AS days_since_last_failure FROM un LEFT JOIN h USING (customer_id)"""

FP = f"{PE}, fp AS (SELECT *, coalesce(failure_code, '') AS code FROM ({W.FAILED_SQL}))"


def in_list(values: list[str]) -> str:
    return "code IN (" + ", ".join(f"'{v}'" for v in values) + ")"


_BACK = "CAST(least(3600, 60 * power(2, attempt - 1)) AS BIGINT)"
_LINEAR = "least(3600, 120 * attempt)"


def retry() -> dict[str, str]:
    a, b, t = in_list(C.NON_RETRYABLE_CODES), in_list(C.CUSTOMER_ACTION_CODES), f"({in_list(C.TRANSIENT_CODES)} OR code = '')"
    return {
        "action": f"CASE WHEN {a} THEN 'do_not_retry' WHEN {b} THEN 'contact_customer' WHEN attempt >= 5 THEN 'do_not_retry' ELSE 'retry_delayed' END",
        "delay_seconds": f"CASE WHEN {a} OR {b} OR attempt >= 5 THEN NULL WHEN {t} THEN {_BACK} ELSE {_LINEAR} END",
        "confidence": f"CASE WHEN {a} THEN 0.95e0 WHEN {b} THEN 0.9e0 WHEN attempt >= 5 THEN 0.85e0 WHEN {t} THEN 0.75e0 ELSE 0.6e0 END",
        "reason": f"""CASE WHEN {a} THEN 'Failure code ''' || code || ''' is not retryable' WHEN {b} THEN 'Failure code ''' || code || ''' requires customer action'
          WHEN attempt >= 5 THEN 'Maximum attempts (5) reached' WHEN {t} THEN 'Transient failure, retry in ' || {_BACK} || 's (attempt ' || attempt || '/5)'
          ELSE 'Unknown failure code ''' || code || ''', conservative retry in ' || {_LINEAR} || 's' END""",
    }


RETRY = retry()
ORACLES["e08_retry_strategy"] = f"""WITH {FP} SELECT event_id, {', '.join(f'{v} AS {k}' for k, v in RETRY.items())}, 5 AS max_attempts FROM fp"""
_CARD, _TRANS, _CUST = in_list(C.RECOVERY_CARD_UPDATE_CODES), in_list(C.RECOVERY_TRANSIENT_CODES), in_list(C.RECOVERY_CUSTOMER_CODES)
_H = "CAST(least(24, power(2, attempt - 1)) AS BIGINT)"
_OPEN = """CASE WHEN ltv > 10000000 THEN 'High-value customer requires priority recovery' WHEN tier IN ('pro', 'enterprise') THEN 'Premium tier (' || tier || ') customer'
  WHEN attempt >= 3 THEN 'Multiple failed attempts - escalating priority' END"""
_SPARE = "CASE WHEN backup THEN 'Backup payment method available' END"
_RATE = "CAST(greatest(7 - attempt, 0) / 1e1 AS DECIMAL(4,2))"
ORACLES["e09_recovery_plan"] = f"""WITH {FP} SELECT event_id,
  CASE WHEN ltv > 10000000 THEN 'urgent' WHEN tier IN ('pro', 'enterprise') OR attempt >= 3 THEN 'high' ELSE 'medium' END AS priority,
  CASE WHEN expired OR {_CARD} THEN 'update_payment_method' ELSE 'retry_optimal_time' END AS primary_action,
  CASE WHEN expired THEN 0.35e0 WHEN {_CARD} THEN CASE WHEN backup THEN 0.65e0 ELSE 0.3e0 END WHEN {_TRANS} THEN 0.7e0
    WHEN {_CUST} THEN CASE WHEN backup THEN 0.55e0 ELSE 0.45e0 END ELSE 0.5e0 END AS probability,
  CASE WHEN expired THEN concat_ws('|', 'update_payment_method/0.0/0.00/Card has expired and must be updated',
      CASE WHEN email THEN 'dunning_email/0.5/0.35/Send card update request email' END, CASE WHEN phone THEN 'sms_reminder/24.0/0.25/Follow up with SMS if no response' END)
    WHEN {_CARD} THEN concat_ws('|', CASE WHEN backup THEN 'offer_alternative/0.0/0.65/Try backup payment method first' END, 'dunning_email/0.0/0.30/Notify customer of ' || code)
    WHEN {_TRANS} THEN concat_ws('|', 'retry_optimal_time/' || {_H} || '.0/' || {_RATE} || '/Retry after ' || {_H} || 'h for transient failure',
      CASE WHEN attempt >= 3 THEN 'dunning_email/' || ({_H} + 24) || '.0/0.20/Notify customer after multiple failures' END)
    WHEN {_CUST} THEN concat_ws('|', CASE WHEN backup THEN 'offer_alternative/0.0/0.55/Offer to use backup payment method' END,
      'retry_optimal_time/24.0/0.45/Wait for funds to become available', CASE WHEN email THEN 'dunning_email/48.0/0.30/Send friendly reminder about payment' END)
    ELSE concat_ws('|', 'retry_optimal_time/4.0/0.50/Standard retry after cooling period', 'dunning_email/24.0/0.25/Follow up with payment reminder',
      CASE WHEN attempt >= max_attempts - 1 THEN 'escalate_to_support/48.0/0.15/Escalate to support before final attempt' END) END AS steps,
  concat_ws('|', {_OPEN}, CASE WHEN expired THEN 'Card is expired' WHEN {_CARD} THEN 'Card issue (' || code || ') requires customer action'
    WHEN {_TRANS} THEN 'Transient failure (' || code || ') - good retry candidate' WHEN {_CUST} THEN 'Customer action required (' || code || ')'
    ELSE 'Unknown failure code: ' || CASE WHEN code = '' THEN 'none' ELSE code END END,
    CASE WHEN NOT expired AND ({_CARD} OR {_CUST}) THEN {_SPARE} END) AS insights FROM fp"""
ORACLES["e10_card_expired"] = f"WITH {FP} SELECT event_id, expired FROM fp"
ORACLES["e11_optimal_retry_hour"] = f"""WITH {FP} SELECT event_id, CASE WHEN contains(code, 'insufficient_funds') THEN 9 WHEN amount_cents > 5000000 THEN 14 ELSE 10 END AS retry_hour FROM fp"""
ORACLES["e12_recovery_confidence"] = f"""WITH {FP} SELECT event_id, least(95, 60 + CASE WHEN code <> '' THEN 15 ELSE 0 END + CASE WHEN ltv > 0 THEN 10 ELSE 0 END
  + CASE WHEN email OR phone THEN 10 ELSE 0 END) / 1e2 AS confidence FROM fp"""
ENRICHED = f"""{UN}, e0 AS (SELECT *, {_LITERAL} AS errs, coalesce(failure_code, '') AS code, {SCORED} AS g1, {RETRIED} AS g2, {HAS_CUSTOMER} AS g3 FROM un),
en AS (SELECT *, CASE WHEN len(errs) = 0 THEN 'passed' ELSE 'failed' END AS validation_status, CASE WHEN g1 THEN {FRAUD_SCORE} END AS fs,
  CASE WHEN g3 THEN {churn_score(f'CASE WHEN {FAILING} THEN 1 ELSE 0 END', '5')} END AS cs FROM e0)"""
ORACLES["e13_enrich"] = f"""WITH {ENRICHED} SELECT event_id, validation_status, array_to_string(errs, ',') AS codes, fs AS fraud_score,
  CASE WHEN g1 THEN {FRAUD('fs')} END AS risk_level, cs AS churn_score, CASE WHEN g3 THEN {CHURN4('cs')} END AS churn_risk_level,
  CASE WHEN g2 THEN {RETRY['action']} END AS retry_action, CASE WHEN g2 THEN {RETRY['delay_seconds']} END AS retry_delay FROM en"""
_CONF = "CASE WHEN {a} THEN '0.95' WHEN {b} THEN '0.9' WHEN attempt >= 5 THEN '0.85' WHEN {t} THEN '0.75' ELSE '0.6' END".format(
    a=in_list(C.NON_RETRYABLE_CODES), b=in_list(C.CUSTOMER_ACTION_CODES), t=f"({in_list(C.TRANSIENT_CODES)} OR code = '')")
ORACLES["e14_to_bronze"] = f"""WITH {ENRICHED} SELECT event_id, amount_cents, validation_status, CASE WHEN g2 THEN {RETRY['delay_seconds']} END AS retry_delay_seconds,
  CASE WHEN g2 THEN '{{"action":"' || {RETRY['action']} || '","delay_seconds":' || coalesce(CAST({RETRY['delay_seconds']} AS VARCHAR), 'null') ||
    ',"max_attempts":5,"confidence":' || {_CONF} || ',"reason":"' || {RETRY['reason']} || '"}}' END AS retry_strategy,
  '{{"retry_attempt_count":"' || attempt || '"' || CASE WHEN g1 THEN ',"fraud_model_version":"rules-v1"' ELSE '' END ||
    CASE WHEN g3 THEN ',"churn_model_version":"rules-v1"' ELSE '' END || '}}' AS metadata, {ts(AS_OF)} AS ingested_at, schema_version FROM en"""

# --- quality -------------------------------------------------------------------------------------------------------

ORACLES["q01_check_unique"] = f"""WITH {PE} SELECT customer_id, merchant_id, count(*) AS n FROM pe
WHERE customer_id IS NOT NULL AND merchant_id IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1"""
ORACLES["q02_check_not_null"] = f"WITH {PE} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS failures FROM pe"
    for c in ("event_id", "customer_id", "merchant_id", "fraud_score", "failure_code"))
ORACLES["q03_check_accepted"] = f"WITH {PE} SELECT currency AS value, count(*) AS failures FROM pe WHERE currency NOT IN ('USD', 'EUR', 'GBP') GROUP BY 1"
ORACLES["q04_check_freshness"] = f"""WITH {STG}, m AS (SELECT max(ingested_at) AS top FROM stg),
p AS (SELECT provider, max(ingested_at) AS newest FROM stg GROUP BY 1), g AS (SELECT unnest([10, 45, 90]) AS late),
a AS (SELECT provider, late, newest, top + late * INTERVAL 1 MINUTE AS now FROM p, g, m)
SELECT provider, late, CAST(floor((epoch_us(now) - epoch_us(newest)) / 60000000) AS BIGINT) AS age_minutes,
  CASE WHEN newest < now - INTERVAL 60 MINUTE THEN 'error' WHEN newest < now - INTERVAL 30 MINUTE THEN 'warn' ELSE 'pass' END AS status FROM a"""
ORACLES["q11_check_relationship"] = f"""WITH {STG}, old AS (SELECT DISTINCT customer_id FROM stg WHERE ingested_at < TIMESTAMP '2024-01-02' AND customer_id IS NOT NULL)
SELECT {n('customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM old)')} AS orphan_rows,
  count(DISTINCT customer_id) FILTER (WHERE customer_id NOT IN (SELECT customer_id FROM old)) AS orphan_keys, {n('customer_id IS NULL')} AS null_key_rows FROM stg"""
ORACLES["q12_check_expression"] = f"""WITH {PE} SELECT 'provider IN (''stripe'', ''square'')' AS rule, {n("NOT provider IN ('stripe', 'square')")} AS failures FROM pe
UNION ALL SELECT 'amount_cents > 1000', {n('NOT amount_cents > 1000')} FROM pe UNION ALL SELECT 'fraud_score < 0.5', {n('NOT fraud_score < 0.5')} FROM pe"""
ORACLES["q09_validate_customer_features"] = f"""WITH {CM}, {FC} SELECT count(*) AS num_records, {n('failure_rate_30d < 0 OR failure_rate_30d > 1')} AS invalid_failure_rates,
  round(avg(CAST(fraud_score_avg AS DOUBLE)), 6) AS fraud_score_mean, 0 AS high_null_columns, 'healthy' AS quality_status FROM fc"""
ORACLES["q10_validate_merchant_features"] = f"""WITH {MM}, {FM} SELECT count(*) AS num_records,
  round(avg(CAST(merchant_health_score AS DOUBLE)), 6) AS avg_merchant_health_score, 0e0 AS null_rate_sum FROM fm"""
_DECIDED = "first_code IN ('MISSING_EVENT_ID', 'INVALID_CURRENCY')"
_KEPT = f"""{JUDGED}, {DLQ}, kept AS (SELECT * FROM dlq QUALIFY row_number() OVER (PARTITION BY {DLQ_KEY} ORDER BY n % 3, n) = 1)"""


def _drift(ctes: str, table: str, key: str, features: list[str]) -> str:
    """PSI and KS of odd against even entities, bin by bin."""
    shares = "[" + ", ".join(f"{k}/16.0::DOUBLE" for k in range(1, 16)) + "]"
    long = " UNION ALL ".join(f"SELECT '{f}' AS feature, k, {f}::DOUBLE AS x FROM e" for f in features)
    return f"""WITH {ctes}, e AS (SELECT *, regexp_extract({key}, '([0-9]+)$', 1)::BIGINT AS k FROM {table}), v AS ({long}),
edges AS (SELECT feature, list_sort(list_distinct(quantile_disc(x, {shares}))) AS edges FROM v WHERE k % 2 = 0 GROUP BY feature),
sides AS (
  SELECT variant, feature, side, x FROM (SELECT unnest(['unshifted', 'shifted']) AS variant), (SELECT feature, 'a' AS side, x FROM v WHERE k % 2 = 0)
  UNION ALL SELECT 'unshifted', feature, 'b', x FROM v WHERE k % 2 = 1
  UNION ALL SELECT 'shifted', feature, 'b', CASE WHEN k % 4 = 1 THEN x * 2 + 1 ELSE x END FROM v WHERE k % 2 = 1),
binned AS (SELECT variant, feature, side, CASE WHEN x IS NULL THEN -1 ELSE len(list_filter(edges, lambda c: c < x)) END AS bin FROM sides JOIN edges USING (feature)),
grid AS (SELECT variant, feature, unnest(range(-1, len(edges) + 1)) AS bin FROM edges, (SELECT unnest(['unshifted', 'shifted']) AS variant)),
cells AS (
  SELECT g.variant, g.feature, g.bin, count(*) FILTER (WHERE side = 'a') AS a, count(*) FILTER (WHERE side = 'b') AS b
  FROM grid g LEFT JOIN binned d ON g.variant = d.variant AND g.feature = d.feature AND g.bin = d.bin GROUP BY ALL),
shares AS (
  SELECT *, (a + 0.5) / (sum(a) OVER w + 0.5 * count(*) OVER w) AS p, (b + 0.5) / (sum(b) OVER w + 0.5 * count(*) OVER w) AS q,
    abs(sum(CASE WHEN bin >= 0 THEN a ELSE 0 END) OVER o / (sum(CASE WHEN bin >= 0 THEN a ELSE 0 END) OVER w)::DOUBLE
      - sum(CASE WHEN bin >= 0 THEN b ELSE 0 END) OVER o / (sum(CASE WHEN bin >= 0 THEN b ELSE 0 END) OVER w)::DOUBLE) AS gap
  FROM cells WINDOW w AS (PARTITION BY variant, feature), o AS (PARTITION BY variant, feature ORDER BY bin)),
r AS (
  SELECT variant, feature, sum(a)::BIGINT AS reference_rows, sum(b)::BIGINT AS current_rows, sum((q - p) * ln(q / p)) AS psi, max(gap) AS ks,
    sum(CASE WHEN bin >= 0 THEN a END)::DOUBLE AS va, sum(CASE WHEN bin >= 0 THEN b END)::DOUBLE AS vb, (count(*) - 1)::DOUBLE AS free
  FROM shares GROUP BY ALL),
limits AS (
  SELECT *, free * pow(1 - 2 / (9 * free) + 1.645::DOUBLE * sqrt(2 / (9 * free)), 3) * (1.0::DOUBLE / reference_rows + 1.0::DOUBLE / current_rows) AS psi_limit
  FROM r)
SELECT variant, feature, reference_rows, current_rows, round(psi, 6) AS psi, round(psi_limit, 6) AS psi_limit, round(ks, 6) AS ks, round(1.36::DOUBLE * sqrt((va + vb) / (va * vb)), 6) AS ks_limit,
  CASE WHEN psi <= psi_limit OR psi < 0.1 THEN 'stable' WHEN psi >= 0.25 THEN 'major' ELSE 'moderate' END AS level,
  (psi > psi_limit AND psi >= 0.1) OR ks > 1.36::DOUBLE * sqrt((va + vb) / (va * vb)) AS drifted FROM limits"""


ORACLES["q09_customer_drift"] = _drift(f"{CM}, {FC}", "fc", "customer_id", [
    "total_payments_30d", "total_amount_cents_30d", "failure_rate_30d", "fraud_score_avg", "days_since_first_payment"])
ORACLES["q10_merchant_drift"] = _drift(f"{MM}, {FM}", "fm", "merchant_id", [
    "total_transactions_30d", "total_volume_cents_30d", "unique_customers_30d", "merchant_health_score"])

ORACLES["q13_apply_review"] = f"""WITH {_KEPT} SELECT n AS kafka_offset, first_code AS failure_reason, {_DECIDED} OR n % 5 = 0 AS reviewed,
  CASE WHEN {_DECIDED} THEN 'lead' WHEN n % 5 = 0 THEN 'ops' END AS reviewed_by,
  CASE first_code WHEN 'INVALID_CURRENCY' THEN 'discarded' WHEN 'MISSING_EVENT_ID' THEN 'reprocessed' ELSE CASE WHEN n % 5 = 0 THEN 'discarded' END END AS resolution,
  CASE WHEN {_DECIDED} THEN {ts("TIMESTAMP '2024-06-02'")} WHEN n % 5 = 0 THEN {ts(AS_OF)} END AS reviewed_at FROM kept"""
ORACLES["q13_reprocess"] = f"""WITH {_KEPT}, r AS (SELECT *, provider = 'stripe' AND n % 2 = 0 AS fixed,
  ltrim(replace(codes, 'MISSING_EVENT_ID', ''), ',') AS rest FROM kept WHERE first_code = 'MISSING_EVENT_ID')
SELECT CASE WHEN fixed AND rest = '' THEN 'stripe:fixed_' || n ELSE CAST(n AS VARCHAR) END AS ref,
  CASE WHEN NOT fixed THEN first_code WHEN rest = '' THEN 'valid' ELSE split_part(rest, ',', 1) END AS failure_reason FROM r"""

# The declared tests over every model, counted directly.
_ALL = f"{STG}, {customer_metrics()}, {merchant_metrics()}, {daily_summary()}, bk AS (SELECT *, {BUCKET} AS b FROM stg), {DATES}, {FC}, {FM}"


def _checks(table: str, source: str, unique: dict[str, str], not_null: dict[str, str], accepted: dict[str, tuple[str, list[str]]]) -> list[str]:
    row = lambda check, column, failures: (
        f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", '{column}' AS \"column\", CAST(({failures}) AS BIGINT) AS failures")
    out = [row("unique", c, f"SELECT count(*) FROM (SELECT {x} AS k FROM {source} WHERE {x} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)") for c, x in unique.items()]
    out += [row("not_null", c, f"SELECT count(*) FROM {source} WHERE {x} IS NULL") for c, x in not_null.items()]
    out += [row("accepted_values", c, f"SELECT count(*) FROM {source} WHERE {x} NOT IN ({', '.join(repr(v) for v in vs)})") for c, (x, vs) in accepted.items()]
    return out


def _same(*cols: str) -> dict[str, str]:
    return {c: c for c in cols}


_INTERVALS = "(SELECT DISTINCT b FROM bk)"
_SUITE = (
    _checks("stg_payment_events", "stg", _same("event_id"), _same("event_id", "provider", "event_type", "status", "ingested_at"),
            {"event_category": ("event_category", C.EVENT_CATEGORIES)})
    + _checks("int_payment_customer_metrics", "cm", _same("customer_id"), _same("customer_id"), {
        "customer_tier": ("customer_tier", C.CUSTOMER_TIERS), "payment_risk_profile": ("payment_risk_profile", C.RISK_PROFILES),
        "fraud_risk_category": ("fraud_risk_category", C.RISK_LEVELS), "churn_risk_category": ("churn_risk_category", C.RISK_LEVELS)})
    + _checks("int_payment_merchant_metrics", "mm", _same("merchant_id"), _same("merchant_id"), {
        "health_category": ("health_category", C.HEALTH_CATEGORIES), "fraud_risk_category": ("fraud_risk_category", C.RISK_LEVELS)})
    + _checks("int_payment_daily_summary", "ds", _same("event_date"), _same("event_date"), {})
    + _checks("dim_customer", "cm", {"customer_key": KEY("customer_id"), "customer_id": "customer_id"},
              {"customer_key": KEY("customer_id"), "customer_id": "customer_id", "is_current": "true"}, {"customer_tier": ("customer_tier", C.CUSTOMER_TIERS)})
    + _checks("dim_merchant", "mm", {"merchant_key": KEY("merchant_id"), "merchant_id": "merchant_id"},
              {"merchant_key": KEY("merchant_id"), "merchant_id": "merchant_id", "is_current": "true"}, {"health_category": ("health_category", C.HEALTH_CATEGORIES)})
    + _checks("dim_date", "dd", _same("date_key"), _same("date_key", "year", "month"), {})
    + _checks("fct_payments", "stg", {"payment_key": KEY("event_id"), "event_id": "event_id"},
              {"payment_key": KEY("event_id"), "event_id": "event_id", "date_key": "provider_created_at", "status": "status"},
              {"event_category": ("event_category", C.EVENT_CATEGORIES)})
    + _checks("fct_daily_payments", "ds", {"date_key": "event_date"}, {"date_key": "event_date", "total_transactions": "total_transactions"}, {})
    + [s for t in ("analytics_payment_intervals", "analytics_payment_summary", "analytics_risk_overview")
       for s in _checks(t, _INTERVALS, {"interval_key": KEY("b")}, {"interval_key": KEY("b")}, {})]
    + _checks("analytics_provider_comparison", "(SELECT DISTINCT b, provider FROM bk)", {"interval_provider_key": KEY("b", "provider")},
              {"interval_provider_key": KEY("b", "provider"), "provider": "provider"}, {})
    + _checks("analytics_payment_trends", "dd", {"trend_key": KEY("date_key")}, {"trend_key": KEY("date_key"), "date_key": "date_key"}, {})
    + _checks("analytics_customer_segments", "(SELECT unnest(['tier', 'fraud_risk', 'churn_risk', 'payment_method']) AS segment_type)", {},
              _same("segment_type"), {"segment_type": ("segment_type", C.SEGMENT_TYPES)})
    + _checks("feat_customer_features", "fc", _same("customer_id"), {"customer_id": "customer_id", "feature_timestamp": "1"}, {})
    + _checks("feat_merchant_features", "fm", _same("merchant_id"), {"merchant_id": "merchant_id", "feature_timestamp": "1"}, {})
)
ORACLES["q05_quality_suite"] = f"""WITH {_ALL}, report AS ({' UNION ALL '.join(_SUITE)})
SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM report"""
ORACLES["m12_ingest_twice"] = ORACLES["s06_ingest_events"]


_NEWER = "SELECT {0} FROM stg WHERE ingested_at >= TIMESTAMP '2024-01-20 10:07:00'"
_WRITTEN = "CASE WHEN {0} IN (" + _NEWER + f") THEN {ts('TIMESTAMP ' + repr(LATER))} ELSE {ts(AS_OF)} END"
ORACLES["m12_incremental_dimensions"] = f"WITH {_ALL} " + " UNION ALL ".join(
    f"SELECT '{dim}' AS dimension, {key} AS entity, {_WRITTEN.format(key)} AS valid_from, {_WRITTEN.format(key)} AS dw_created_at, "
    f"{_WRITTEN.format(key)} AS dw_updated_at, true AS is_current FROM {source}"
    for dim, key, source in (("dim_customer", "customer_id", "cm"), ("dim_merchant", "merchant_id", "mm")))

# --- training ----------------------------------------------------------------------------------------------------------

ORACLES["l01_fraud_training_set"] = f"""WITH {BOTH}, a AS (SELECT avg(CAST(fraud_rate_30d AS DOUBLE)) AS f, avg(CAST(high_risk_transaction_pct AS DOUBLE)) AS h,
  avg(CAST(merchant_health_score AS DOUBLE)) AS s FROM fm) SELECT customer_id, CAST(fraud_score_avg AS DOUBLE) AS fraud_score_avg,
  CAST(failure_rate_30d AS DOUBLE) AS failure_rate_30d, total_payments_30d, high_risk_payment_count, round(a.f, 6) AS merchant_fraud_rate,
  round(a.h, 6) AS high_risk_transaction_pct, round(a.s, 6) AS merchant_health_score FROM fc, a"""
ORACLES["l02_churn_training_set"] = f"""WITH {CM}, {FC} SELECT customer_id, total_payments_30d, total_payments_90d, CAST(failure_rate_30d AS DOUBLE) AS failure_rate_30d,
  consecutive_failures, CAST(recovery_rate_30d AS DOUBLE) AS recovery_rate_30d, days_since_last_payment, payment_method_count, customer_tier FROM fc"""


def draw(purpose: str) -> str:
    return f"CAST(concat('0x', substr(md5('{purpose}:42:' || customer_id), 1, 8)) AS BIGINT) / 4294967296e0"


LABELLED = f"""{CM}, {FC}, lab AS (SELECT *, CASE WHEN {draw('churn-label')} < least(greatest(CAST(failure_rate_30d AS DOUBLE) * 0.4e0
  + least(greatest(days_since_last_payment / 30, 0e0), 1e0) * 0.3e0 + (1e0 - CAST(recovery_rate_30d AS DOUBLE)) * 0.3e0, 0e0), 1e0) THEN 1 ELSE 0 END AS label FROM fc)"""
ORACLES["l03_synthetic_labels"] = f"WITH {LABELLED} SELECT customer_id, label FROM lab"
_F1 = """CAST(count(*) FILTER (WHERE label = 1 AND p) AS BIGINT) AS tp, CAST(count(*) FILTER (WHERE label = 0 AND p) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE label = 1 AND NOT p) AS BIGINT) AS fn, CAST(count(*) FILTER (WHERE label = 0 AND NOT p) AS BIGINT) AS tn"""
ORACLES["l08_binary_metrics"] = f"""WITH {LABELLED}, m AS (SELECT {_F1} FROM (SELECT label, CAST(failure_rate_30d AS DOUBLE) > 0.2e0 AS p FROM lab))
SELECT tp, fp, fn, tn, {ratio('tp + tn', 'tp + fp + fn + tn')} AS accuracy, {ratio('tp', 'tp + fp')} AS precision, {ratio('tp', 'tp + fn')} AS recall,
  {ratio('2 * tp', '2 * tp + fp + fn')} AS f1, {ratio('tp + fn', 'tp + fp + fn + tn')} AS base_rate FROM m"""
_CUTS = " UNION ALL ".join(
    f"SELECT {i} AS version, 'models/{cut}' AS path, {_F1} FROM (SELECT label, CAST(failure_rate_30d AS DOUBLE) > {cut}e0 AS p FROM lab)"
    for i, cut in enumerate((0.3, 0.1, 0.5), start=1))
# The champion is the first version with the best F1 so far.
ORACLES["l10_promote_if_better"] = f"""WITH {LABELLED}, m AS ({_CUTS}), s AS (SELECT version, path, {ratio('2 * tp', '2 * tp + fp + fn')} AS f1 FROM m),
w AS (SELECT *, f1 > coalesce(max(f1) OVER (ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS won FROM s)
SELECT 'churn-prediction' AS name, version, f1, CASE WHEN NOT won THEN 'None' WHEN version = (SELECT max(version) FROM w WHERE won) THEN 'Production' ELSE 'Archived' END AS stage, path FROM w"""
_FLIP = draw("flip")
ORACLES["l04_ensure_two_classes"] = f"""WITH {CM}, {FC}, d AS (SELECT customer_id, {_FLIP} AS u FROM fc), c AS (SELECT quantile_disc(u, 0.2) AS cut FROM d)
SELECT customer_id, CASE WHEN (SELECT count(*) FROM d) >= 20 AND u <= cut THEN 1 ELSE 0 END AS label FROM d, c"""
ORACLES["l05_stratified_split"] = f"""WITH {LABELLED}, d AS (SELECT customer_id, label, {draw('split')} AS u FROM lab),
c AS (SELECT label, quantile_disc(u, 0.2) AS cut, count(*) AS n FROM d GROUP BY 1)
SELECT customer_id, label, CASE WHEN u <= CASE WHEN (SELECT min(n) FROM c) >= 2 THEN cut ELSE 0.2e0 END THEN 'test' ELSE 'train' END AS part
FROM d JOIN c USING (label)"""

_PARTS = """d AS (SELECT customer_id, label, {draw} AS u FROM {labels}), c AS (SELECT label, quantile_disc(u, 0.2) AS cut, count(*) AS n FROM d GROUP BY 1),
t AS (SELECT d.* FROM d JOIN c USING (label) WHERE u <= CASE WHEN (SELECT min(n) FROM c) >= 2 THEN cut ELSE 0.2e0 END)
SELECT CASE WHEN (SELECT count(*) FROM d) < 20 THEN 0 ELSE (SELECT count(*) FROM t) END AS test_rows,
  CASE WHEN (SELECT count(*) FROM d) < 20 THEN 0 ELSE (SELECT CAST(coalesce(sum(label), 0) AS BIGINT) FROM t) END AS positives,
  true AS scores_valid, true AS metrics_valid"""
ORACLES["l07_train_churn"] = f"WITH {LABELLED}, " + _PARTS.format(draw=draw("split"), labels="lab")
_FRAUD_P = """least(greatest(CAST(fraud_score_avg AS DOUBLE) * 0.5e0 + a.f * 0.3e0 + a.h * 0.2e0, 0e0), 1e0)"""
ORACLES["l06_train_fraud"] = f"""WITH {BOTH}, a AS (SELECT avg(CAST(fraud_rate_30d AS DOUBLE)) AS f, avg(CAST(high_risk_transaction_pct AS DOUBLE)) AS h FROM fm),
lab AS (SELECT customer_id, CASE WHEN {draw('fraud-label')} < {_FRAUD_P} THEN 1 ELSE 0 END AS label FROM fc, a), """ + _PARTS.format(draw=draw("split"), labels="lab")
_FEATURES = ("fraud_score_avg", "failure_rate_30d", "total_payments_30d", "high_risk_payment_count", "merchant_fraud_rate", "high_risk_transaction_pct", "merchant_health_score")
ORACLES["l09_feature_importance"] = f"""WITH {CM} SELECT unnest([{', '.join(repr(f) for f in _FEATURES)}]) AS feature, true AS is_share, 1e0 AS total
WHERE (SELECT count(*) FROM cm) >= 20"""
_KNOWN = "(customer_id IN (SELECT customer_id FROM cm) AND (SELECT count(*) FROM cm) >= 20)"
ORACLES["e15_score_with_model"] = f"""WITH {CM}, un AS ({W.UNIFIED_SQL}) SELECT event_id, CASE WHEN {_KNOWN} THEN 'model' ELSE 'rules' END AS churn_score_source,
  CASE WHEN customer_id IS NOT NULL AND NOT {_KNOWN} THEN {churn_score('0', '5')} END AS rule_score, true AS in_range FROM un"""

# --- the whole build ---------------------------------------------------------------------------------------------


def _build_content() -> str:
    """Every row of every model as its key and a measure, from the SQL of the models' own queries."""
    return " UNION ALL ".join(
        f"SELECT '{model}' AS model, concat_ws('|', {', '.join(keys)}) AS key, CAST({measure} AS DOUBLE) AS measure FROM ({ORACLES[name]})"
        for model, (name, keys, measure) in CONTENT.items())


ORACLES["m12_batch_build"] = ORACLES["m12_incremental_build"] = ORACLES["m12_interrupted_build"] = _build_content()
