"""Payment tables derived from the driver's tables.

The texts marked as shared run unchanged in Spark and in DuckDB, so both sides of a check start from
the same rows. `{events}` and `{orders}` stand for the source relations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.schemas import BRONZE, STREAMS
from saldo.session import TIMES, scratch, settings
from saldo.sources.bronze import conform
from workload.signing import SECRETS, signer  # noqa: F401

AS_OF = "2024-06-01 00:00:00"
# Newest rows of the fixture; monitors look at the last hour before it.
MONITOR_AS_OF = "1998-08-02 00:00:00"

# --- shared: bronze payment events ---------------------------------------------------------------
BRONZE_SQL = """
WITH b AS (
  SELECT event_id AS n, ts, user_id AS u, event_type AS t, value AS v,
         CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS k
  FROM {events}),
c AS (
  SELECT *, CASE n % 4 WHEN 0 THEN 'stripe' WHEN 1 THEN 'square' WHEN 2 THEN 'adyen' ELSE 'braintree' END AS provider,
    CASE WHEN k < 4 THEN 'dispute.created' WHEN k < 8 THEN 'dispute.second_chargeback'
         WHEN t = 'purchase' THEN 'charge.succeeded' WHEN t = 'view' THEN 'payment.succeeded'
         WHEN t = 'click' THEN 'refund.created'
         WHEN t = 'signup' THEN CASE WHEN k % 2 = 0 THEN 'subscription.charged' ELSE 'subscription.canceled' END
         ELSE 'payment.failed' END AS event_type,
    CASE WHEN k < 8 THEN 'disputed' WHEN t IN ('purchase','view') THEN 'succeeded'
         WHEN t = 'click' THEN CASE WHEN k % 3 = 0 THEN 'pending' ELSE 'refunded' END
         WHEN t = 'signup' THEN CASE WHEN k % 2 = 0 THEN 'succeeded' ELSE 'canceled' END
         ELSE 'failed' END AS status,
    CASE WHEN k % 20 = 19 THEN NULL ELSE concat('cus_', CAST(u AS STRING)) END AS customer_id,
    CASE WHEN n % 50 = 49 THEN NULL ELSE concat('merch_', CAST(n % 23 AS STRING)) END AS merchant_id,
    CASE k % 6 WHEN 0 THEN 'card' WHEN 1 THEN 'card' WHEN 2 THEN 'bank_transfer' WHEN 3 THEN 'us_bank_account' WHEN 4 THEN 'wallet' ELSE NULL END AS payment_method_type
  FROM b),
d AS (SELECT *, CASE WHEN status = 'succeeded' THEN (n * 37) % 1000 END AS fraud_milli,
    CASE WHEN customer_id IS NOT NULL THEN (u * 53) % 1000 END AS churn_milli FROM c)
SELECT n, k, concat(provider, ':evt_', CAST(n AS STRING)) AS event_id, provider,
  concat('evt_', CAST(n AS STRING)) AS provider_event_id, event_type, customer_id, merchant_id,
  CAST(ROUND(v * 100) AS BIGINT) AS amount_cents,
  CASE n % 6 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'CAD' WHEN 4 THEN 'JPY' ELSE 'USD' END AS currency,
  payment_method_type,
  CASE WHEN payment_method_type = 'card' THEN CASE n % 3 WHEN 0 THEN 'visa' WHEN 1 THEN 'mastercard' ELSE 'unknown' END END AS card_brand,
  CASE WHEN payment_method_type = 'card' THEN lpad(CAST(n % 10000 AS STRING), 4, '0') END AS card_last_four,
  status,
  CASE WHEN status = 'failed' THEN CASE n % 5 WHEN 0 THEN 'card_declined' WHEN 1 THEN 'insufficient_funds' WHEN 2 THEN 'processing_error' WHEN 3 THEN 'weird_code' ELSE NULL END END AS failure_code,
  CAST(fraud_milli AS DOUBLE) / 1000 AS fraud_score,
  CASE WHEN fraud_milli >= 700 THEN 'high' WHEN fraud_milli >= 300 THEN 'medium' WHEN fraud_milli >= 0 THEN 'low' END AS risk_level,
  CAST(churn_milli AS DOUBLE) / 1000 AS churn_score,
  CASE WHEN churn_milli >= 750 THEN 'critical' WHEN churn_milli >= 500 THEN 'high' WHEN churn_milli >= 250 THEN 'medium' WHEN churn_milli >= 0 THEN 'low' END AS churn_risk_level,
  CASE WHEN churn_milli >= 500 THEN 1000 - churn_milli END AS days_to_churn_estimate,
  CASE WHEN k % 10 = 0 THEN 'failed' ELSE 'passed' END AS validation_status,
  ts AS provider_created_at, ts + INTERVAL 1 SECOND AS processed_at, ts + INTERVAL 30 SECOND AS ingested_at,
  concat('{{"k":', CAST(k AS STRING), '}}') AS metadata, CAST(1 AS BIGINT) AS schema_version
FROM d
"""

# --- shared: the four typed streams --------------------------------------------------------------
_STREAM_BASE = """
  concat('evt_', CAST(o_orderkey AS STRING)) AS event_id,
  CASE o_orderkey % 5 WHEN 0 THEN 'stripe' WHEN 1 THEN 'braintree' WHEN 2 THEN 'adyen' WHEN 3 THEN 'checkout' ELSE 'square' END AS provider,
  CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE concat('cus_', CAST(o_custkey AS STRING)) END AS customer_id,
  CASE WHEN o_orderkey % 47 = 0 THEN NULL
       WHEN o_orderkey % 41 = 0 THEN CAST(-1 AS DECIMAL(10,2))
       WHEN o_orderkey % 43 = 0 THEN CAST(2000000 AS DECIMAL(10,2))
       WHEN o_orderkey % 59 = 0 THEN CAST(0 AS DECIMAL(10,2))
       ELSE CAST(o_totalprice AS DECIMAL(10,2)) END AS amount,
  CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN 'NULL' WHEN o_orderkey % 29 = 0 THEN 'XXX'
       WHEN o_orderkey % 3 = 0 THEN 'usd' WHEN o_orderkey % 3 = 1 THEN 'EUR' ELSE 'Gbp' END AS currency,
  CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'succeeded' ELSE 'pending' END AS status,
  concat('merch_', CAST(o_custkey % 23 AS STRING)) AS merchant_id,
  o_orderdate AS created_at"""

STREAM_SQL = {
    "charges": f"""SELECT {_STREAM_BASE},
  CASE WHEN o_orderstatus = 'F' THEN 'charge.failed' ELSE 'charge.succeeded' END AS event_type,
  concat('ch_', CAST(o_orderkey AS STRING)) AS charge_id,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN 'card_declined' END AS failure_code
FROM {{orders}}""",
    "refunds": f"""SELECT {_STREAM_BASE},
  'refund.created' AS event_type, concat('re_', CAST(o_orderkey AS STRING)) AS refund_id,
  CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE concat('ch_', CAST(o_orderkey AS STRING)) END AS charge_id,
  CASE WHEN o_orderkey % 67 = 0 THEN NULL ELSE o_orderpriority END AS reason,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN 'card_declined' END AS failure_reason
FROM {{orders}}""",
    "disputes": f"""SELECT {_STREAM_BASE},
  'dispute.created' AS event_type, concat('dp_', CAST(o_orderkey AS STRING)) AS dispute_id,
  CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE concat('ch_', CAST(o_orderkey AS STRING)) END AS charge_id,
  CASE WHEN o_orderkey % 67 = 0 THEN NULL ELSE o_orderpriority END AS reason
FROM {{orders}}""",
    "subscriptions": f"""SELECT {_STREAM_BASE},
  'subscription.created' AS event_type, concat('sub_', CAST(o_orderkey AS STRING)) AS subscription_id,
  CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE concat('plan_', CAST(o_orderkey % 7 AS STRING)) END AS plan_id,
  CASE WHEN o_orderkey % 67 = 0 THEN NULL ELSE 'month' END AS "interval"
FROM {{orders}}""",
}

# --- shared: parameters of raw webhooks ----------------------------------------------------------
# One row per message: what its payload says and how it is broken.
WEBHOOK_SQL = """
WITH b AS (
  SELECT event_id AS n, ts, user_id AS u, event_type AS t, value AS v,
         CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS k
  FROM {events})
SELECT n, k, t, ts,
  CASE n % 4 WHEN 0 THEN 'stripe' WHEN 1 THEN 'square' WHEN 2 THEN 'adyen' ELSE 'braintree' END AS provider,
  CASE WHEN n % 101 = 0 THEN 'cut' WHEN n % 127 = 0 THEN 'list' ELSE 'object' END AS form,
  CASE WHEN n % 103 = 0 THEN NULL ELSE CAST(n AS STRING) END AS id,
  CASE WHEN n % 107 = 0 THEN -5 WHEN n % 131 = 0 THEN 200000000 ELSE CAST(ROUND(v * 100) AS BIGINT) END AS amount,
  CASE WHEN n % 109 = 0 THEN 'zzz' WHEN n % 3 = 0 THEN ' usd' WHEN n % 3 = 1 THEN 'Eur' ELSE 'GBP' END AS currency,
  CASE WHEN n % 113 = 0 THEN 'null' WHEN k % 20 = 19 THEN NULL ELSE concat('cus_', CAST(u AS STRING)) END AS customer,
  CASE WHEN n % 50 = 49 THEN 'None' ELSE concat('merch_', CAST(n % 23 AS STRING)) END AS merchant,
  CASE n % 4
    WHEN 0 THEN CASE t WHEN 'purchase' THEN 'charge.succeeded' WHEN 'view' THEN 'payment_intent.succeeded'
      WHEN 'click' THEN 'refund.created' WHEN 'signup' THEN 'charge.dispute.created' ELSE 'payment_intent.payment_failed' END
    WHEN 1 THEN CASE WHEN t = 'click' THEN 'refund.created' WHEN k % 2 = 0 THEN 'payment.completed' ELSE 'invoice.paid' END
    WHEN 2 THEN CASE t WHEN 'purchase' THEN 'AUTHORISATION' WHEN 'view' THEN 'CAPTURE' WHEN 'click' THEN 'REFUND'
      WHEN 'signup' THEN 'CUSTOM_CODE' ELSE 'CHARGEBACK' END
    ELSE CASE t WHEN 'purchase' THEN 'transaction_settled' WHEN 'view' THEN 'subscription_charged_successfully'
      WHEN 'click' THEN 'dispute_opened' WHEN 'signup' THEN 'custom_kind' ELSE 'subscription_charged_unsuccessfully' END
  END AS raw_type,
  CASE WHEN n % 4 = 1 THEN CASE WHEN n % 23 = 0 THEN 'no_data' WHEN n % 19 = 0 THEN 'no_payment'
    WHEN t = 'click' THEN 'refund' WHEN n % 17 = 0 THEN 'unnamed' WHEN n % 13 = 0 THEN 'unknown' ELSE 'payment' END END AS square_form,
  CASE k % 4 WHEN 0 THEN 'CARD' WHEN 1 THEN 'WALLET' WHEN 2 THEN 'bank_account' ELSE 'WEIRD' END AS source_type,
  CASE k % 4 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'FAILED' WHEN 2 THEN 'approved' ELSE 'ODD' END AS square_status,
  CASE k % 8 WHEN 0 THEN 'Refused by bank' WHEN 1 THEN 'FRAUD suspected' WHEN 2 THEN 'Card Expired' WHEN 3 THEN 'Insufficient funds'
    WHEN 4 THEN 'Invalid number' WHEN 5 THEN 'Blocked card' WHEN 6 THEN 'Cancelled' ELSE 'Odd' END AS refusal,
  CASE k % 5 WHEN 0 THEN 'visa' WHEN 1 THEN 'mc' WHEN 2 THEN 'iDEAL' WHEN 3 THEN 'klarna' ELSE 'Weird' END AS adyen_method,
  CASE k % 5 WHEN 0 THEN 'processor_declined' WHEN 1 THEN 'settling' WHEN 2 THEN 'Voided' WHEN 3 THEN NULL ELSE 'odd_state' END AS txn_status,
  CASE k % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'PayPal_account' WHEN 2 THEN NULL ELSE 'crypto' END AS instrument,
  CASE k % 3 WHEN 0 THEN 'American Express' WHEN 1 THEN 'Visa' ELSE 'OtherBrand' END AS bt_brand,
  k % 5 <> 0 AS success
FROM b
"""


def _spark_sql(spark: SparkSession, text: str, sf_dir: str) -> DataFrame:
    sources = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in ("events", "orders")}
    return spark.sql(text.format(**sources).replace('"interval"', "`interval`"))


_LANDED: dict[tuple, str] = {}


def spread(rows: DataFrame) -> DataFrame:
    """Rows read by fewer tasks than there are cores, dealt evenly; others as they are read, without a shuffle.

    Spark reads at least 4 MB in a task while there are fewer tasks than cores, so what is dealt is a small table.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def landed(spark: SparkSession, sf_dir: str, name: str, make) -> DataFrame:
    """A derived table, written once per session and read back as a stored table.

    Queries then scan Parquet, as they would in use, instead of deriving their input again.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _LANDED:
        path = scratch(spark, name)
        with settings(spark, **TIMES):
            spread(make()).write.parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def payment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze columns plus the helper numbers n and k."""
    return landed(spark, sf_dir, "payments", lambda: _spark_sql(spark, BRONZE_SQL, sf_dir))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "bronze", lambda: conform(_spark_sql(spark, BRONZE_SQL, sf_dir), BRONZE))


def row_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row store's table: a numeric id, a loaded flag and decimal scores."""
    rows = payment_rows(spark, sf_dir)
    ts = ["provider_created_at", "processed_at", "ingested_at"]
    keep = [c for c in rows.columns if c not in ("n", "k", "fraud_score", "churn_score", "metadata", *ts)]
    return rows.select(
        F.col("n").alias("id"), *keep,
        *[F.col(c).cast("timestamp").alias(c) for c in ts],
        F.col("fraud_score").cast("decimal(5,4)").alias("fraud_score"),
        F.col("churn_score").cast("decimal(5,4)").alias("churn_score"),
        F.create_map(F.lit("k"), F.col("k")).alias("metadata"),
        (F.col("n") % 3 == 0).alias("loaded_to_iceberg"),
        F.when(F.col("n") % 3 == 0, F.col("ingested_at").cast("timestamp")).alias("loaded_at"),
    )


def unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized events as the enrichment sees them: no scores, some rows breaking the rules."""
    rows = payment_rows(spark, sf_dir)
    n, k = F.col("n"), F.col("k")
    return rows.select(
        "event_id", "provider", "provider_event_id", "event_type",
        F.when(n % 211 == 0, "merch_blocked_001").otherwise(F.col("merchant_id")).alias("merchant_id"),
        F.when(n % 199 == 0, "cus_blocked_001").otherwise(F.col("customer_id")).alias("customer_id"),
        F.when(n % 97 == 0, F.lit(0)).when(n % 89 == 0, F.lit(100_000_001))
        .when(n % 7 == 0, F.col("amount_cents") * 20).otherwise(F.col("amount_cents")).alias("amount_cents"),
        F.when(n % 83 == 0, "SEK").otherwise(F.lower("currency")).alias("currency"),
        "payment_method_type", "card_brand", "card_last_four",
        F.when(n % 223 == 0, "  ").otherwise(F.col("status")).alias("status"),
        "failure_code", F.lit(None).cast("string").alias("failure_message"),
        F.concat(F.lit('{"retry_attempt_count":"'), (k % 7 + 1).cast("string"), F.lit('"}')).alias("metadata"),
        F.col("provider_created_at").cast("timestamp").alias("provider_created_at"),
        F.col("processed_at").cast("timestamp").alias("processed_at"), "schema_version",
    )


UNIFIED_SQL = """SELECT n, k, event_id, provider, provider_event_id, event_type,
  CASE WHEN n % 211 = 0 THEN 'merch_blocked_001' ELSE merchant_id END AS merchant_id,
  CASE WHEN n % 199 = 0 THEN 'cus_blocked_001' ELSE customer_id END AS customer_id,
  CASE WHEN n % 97 = 0 THEN 0 WHEN n % 89 = 0 THEN 100000001 WHEN n % 7 = 0 THEN amount_cents * 20 ELSE amount_cents END AS amount_cents,
  CASE WHEN n % 83 = 0 THEN 'SEK' ELSE lower(currency) END AS currency, payment_method_type, card_brand, card_last_four,
  CASE WHEN n % 223 = 0 THEN '  ' ELSE status END AS status, failure_code, k % 7 + 1 AS attempt,
  provider_created_at, processed_at, schema_version FROM pe"""


def failed_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed payments with retry and customer context for the recovery plan."""
    n, k = F.col("n"), F.col("k")
    return payment_rows(spark, sf_dir).filter(F.col("status") == "failed").select(
        "event_id", "customer_id", "failure_code",
        (F.col("amount_cents") * F.when(n % 11 == 0, 1000).otherwise(1)).alias("amount_cents"),
        (k % 9 + 1).alias("attempt_number"), F.lit(5).alias("max_attempts"),
        F.when(n % 6 == 0, F.lit(10_000_001)).when(n % 6 == 1, F.lit(0)).otherwise(F.lit(500)).alias("ltv_cents"),
        F.when(n % 8 == 0, "pro").when(n % 8 == 1, "enterprise").when(n % 8 == 2, "free").alias("subscription_tier"),
        (n % 4 != 0).alias("has_email"), (n % 5 == 0).alias("has_phone"), (k % 3 == 0).alias("has_backup"),
        F.when(n % 9 == 0, 5).when(n % 9 == 1, 6).when(n % 9 == 2, 0).alias("card_exp_month"),
        F.when(n % 9 < 3, 2024).alias("card_exp_year"),
    )


FAILED_SQL = """SELECT n, k, event_id, customer_id, failure_code,
  amount_cents * CASE WHEN n % 11 = 0 THEN 1000 ELSE 1 END AS amount_cents,
  k % 9 + 1 AS attempt, 5 AS max_attempts,
  CASE n % 6 WHEN 0 THEN 10000001 WHEN 1 THEN 0 ELSE 500 END AS ltv,
  CASE n % 8 WHEN 0 THEN 'pro' WHEN 1 THEN 'enterprise' WHEN 2 THEN 'free' END AS tier,
  n % 4 <> 0 AS email, n % 5 = 0 AS phone, k % 3 = 0 AS backup,
  n % 9 = 0 AS expired FROM pe WHERE status = 'failed'"""


def stream_table(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """One typed stream as a table in its declared schema."""
    return landed(
        spark, sf_dir, kind, lambda: conform(_spark_sql(spark, STREAM_SQL[kind], sf_dir), STREAMS[kind]))


def webhook_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, WEBHOOK_SQL, sf_dir)


# Payload texts. NULL members are left out of the JSON.
_PAYLOADS = {
    "stripe": """to_json(named_struct(
        'id', concat('evt_', id), 'object', 'event', 'api_version', '2023-10-16', 'type', raw_type, 'livemode', k % 2 = 0,
        'created', CAST(floor(unix_micros(CAST(ts AS TIMESTAMP)) / 1000000) AS BIGINT), 'pending_webhooks', 1,
        'data', named_struct('object', named_struct(
            'id', concat(CASE WHEN raw_type LIKE 'payment_intent%' THEN 'pi' WHEN raw_type LIKE 'charge%' THEN 'ch' ELSE 're' END,
                         CASE WHEN k % 12 = 5 THEN '-' ELSE '_' END, CAST(n AS STRING)),
            'amount', amount, 'currency', currency, 'customer', customer,
            'status', CASE t WHEN 'signup' THEN NULL WHEN 'error' THEN 'requires_payment_method' ELSE 'succeeded' END,
            'created', CASE WHEN k % 2 = 0 THEN CAST(floor(unix_micros(CAST(ts AS TIMESTAMP)) / 1000000) AS BIGINT) END,
            'paid', CASE WHEN raw_type LIKE 'charge%' THEN true END,
            'captured', CASE WHEN raw_type LIKE 'charge%' AND k % 11 <> 0 THEN true END,
            'payment_method_types', CASE WHEN raw_type LIKE 'payment_intent%' THEN array(CASE WHEN k % 2 = 0 THEN 'card' ELSE 'us_bank_account' END) END,
            'payment_method_details', CASE WHEN raw_type LIKE 'charge%' THEN named_struct(
                'type', CASE WHEN k % 3 <> 0 THEN 'card' END, 'card', named_struct('brand', 'visa', 'last4', '4242')) END,
            'failure_code', CASE WHEN t = 'error' AND k % 2 = 1 THEN 'None' END,
            'failure_message', CASE WHEN t = 'error' AND k % 2 = 1 THEN 'Bank said no' END,
            'last_payment_error', CASE WHEN t = 'error' THEN named_struct('code', 'card_declined', 'message', 'Declined') END,
            'failure_reason', CASE WHEN t = 'click' AND k % 4 = 0 THEN 'lost_or_stolen_card' END,
            'metadata', named_struct('merchant_id', merchant, 'order_id', concat('o', CAST(n AS STRING)))))))""",
    "square": """to_json(named_struct(
        'event_id', concat('evt_', id), 'type', raw_type, 'merchant_id', merchant,
        'created_at', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        'data', CASE WHEN square_form <> 'no_data' THEN named_struct(
            'type', CASE square_form WHEN 'refund' THEN 'refund' WHEN 'unnamed' THEN 'other' WHEN 'unknown' THEN 'other' ELSE 'payment' END,
            'id', concat('d', CAST(n AS STRING)),
            'object', named_struct(
                'payment', CASE WHEN square_form IN ('payment', 'unnamed') THEN named_struct(
                    'id', concat('p', CAST(n AS STRING)), 'created_at', CASE WHEN k % 10 = 3 THEN 'garbage' WHEN k % 10 <> 4 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'") END,
                    'amount_money', named_struct('amount', amount, 'currency', currency),
                    'status', square_status, 'source_type', source_type, 'customer_id', customer, 'location_id', 'L1',
                    'order_id', concat('o', CAST(n AS STRING)),
                    'card_details', CASE WHEN source_type = 'CARD' THEN named_struct('card_brand', 'VISA', 'last_4', 'null', 'exp_month', 12, 'exp_year', 2030) END) END,
                'refund', CASE WHEN square_form = 'refund' THEN named_struct(
                    'id', concat('r', CAST(n AS STRING)), 'created_at', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
                    'amount_money', named_struct('amount', amount, 'currency', currency),
                    'status', CASE square_status WHEN 'ODD' THEN 'REJECTED' ELSE square_status END,
                    'payment_id', concat('p', CAST(n AS STRING)), 'location_id', 'L1', 'reason', 'r') END)) END))""",
    "adyen": """to_json(named_struct(
        'pspReference', concat('psp_', id), 'eventCode', raw_type, 'merchantAccountCode', merchant,
        'merchantReference', concat('o', CAST(n AS STRING)),
        'amount', named_struct('value', amount, 'currency', currency), 'success', success,
        'eventDate', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), 'paymentMethod', adyen_method, 'reason', refusal,
        'operations', array('CANCEL'), 'live', k % 2 = 0,
        'additionalData', named_struct('cardBin', CASE WHEN k % 2 = 0 THEN '411111' END, 'cardSummary', '1234')))""",
    "braintree": """to_json(named_struct(
        'kind', raw_type, 'timestamp', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        'transaction', named_struct(
            'id', concat('txn_', id), 'status', txn_status, 'type', 'sale',
            'amount', CASE WHEN n % 29 = 0 THEN 'abc' WHEN k % 9 = 0 THEN NULL
                           ELSE concat(CAST(CAST(amount AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2)), CASE WHEN k % 9 = 1 THEN '9' ELSE '' END) END,
            'currency_iso_code', CASE WHEN k % 7 <> 0 THEN currency END,
            'merchant_account_id', merchant, 'customer_id', customer, 'payment_instrument_type', instrument,
            'card_details', named_struct('card_type', bt_brand, 'last_4', '9876')),
        'subscription', CASE WHEN raw_type LIKE 'subscription%' THEN named_struct('id', concat('s', CAST(n AS STRING)), 'plan_id', 'pl') END))""",
}

# Shared: source topic of a message.
TOPIC_SQL = """CASE provider
    WHEN 'stripe' THEN CASE WHEN raw_type LIKE 'payment_intent%' THEN 'webhooks.stripe.payment_intent'
      WHEN raw_type LIKE 'charge%' THEN 'webhooks.stripe.charge' ELSE 'webhooks.stripe.refund' END
    WHEN 'square' THEN CASE WHEN raw_type = 'refund.created' THEN 'webhooks.square.refund' ELSE 'webhooks.square.payment' END
    WHEN 'adyen' THEN 'webhooks.adyen.notification' ELSE 'webhooks.braintree.notification' END"""


def messages_of(w: DataFrame) -> DataFrame:
    """Raw webhook messages (value, topic, partition, offset) of the webhook parameters."""
    payload = F.coalesce(*[
        F.when(F.col("provider") == p, F.expr(text)) for p, text in _PAYLOADS.items()])
    broken = (
        F.when(F.col("form") == "cut", F.expr("substring(_p, 1, length(_p) - 15)"))
        .when(F.col("form") == "list", F.concat(F.lit("["), F.col("_p"), F.lit("]")))
        .otherwise(F.col("_p")))
    return w.withColumn("_p", payload).select(
        broken.cast("binary").alias("value"), F.expr(TOPIC_SQL).alias("topic"),
        (F.col("n") % 3).cast("int").alias("partition"), F.col("n").alias("offset"))


RAW_SCHEMA = "value binary, partition int, offset bigint, topic string"


def raw_landing(spark: SparkSession, sf_dir: str) -> str:
    """Folder of captured raw messages, one subfolder per topic; written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, "raw")
    if key not in _LANDED:
        path = scratch(spark, "raw")
        rows = messages_of(webhook_parameters(spark, sf_dir))
        spread(rows).write.partitionBy("topic").parquet(path)
        _LANDED[key] = path
    return _LANDED[key]


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw webhook messages (value, topic, partition, offset) as landed."""
    landed = spark.read.schema(RAW_SCHEMA).parquet(raw_landing(spark, sf_dir))
    return landed.select("value", "topic", "partition", "offset")


# --- signed webhooks ------------------------------------------------------------------------------
SQUARE_URL = "https://example.com/webhooks/square"


def captured(spark: SparkSession, sf_dir: str, provider: str) -> DataFrame:
    """Webhooks as received: offset, value and signature header, a fixed share of them tampered with."""
    n = F.col("offset")
    rows = raw_messages(spark, sf_dir).filter(F.col("topic").contains(provider))
    sign = signer(provider)
    flip = lambda s: F.when(n % 7 == 0, F.reverse(s)).otherwise(s)
    if provider == "stripe":
        sent = F.unix_timestamp(F.lit(AS_OF).cast("timestamp")) - F.when(n % 13 == 0, 301).otherwise(300)
        text = sent.cast("string")
        digest = flip(sign(F.concat(F.encode(F.concat(text, F.lit(".")), "utf-8"), "value")))
        head = F.concat(F.lit("t="), text)
        header = (
            F.when(n % 11 == 0, F.lit(None)).when(n % 17 == 0, F.lit("nonsense"))
            .when(n % 19 == 0, F.concat(F.lit("t=soon,v1="), digest)).when(n % 23 == 0, head)
            .otherwise(F.concat(head, F.lit(",v1=0000,v1="), digest)))
        return rows.select("offset", "value", header.alias("signature"))
    if provider == "square":
        message = F.concat(F.encode(F.lit(SQUARE_URL), "utf-8"), F.col("value"))
        return rows.select(
            "offset", "value", F.when(n % 11 == 0, F.lit(None)).otherwise(flip(sign(message))).alias("signature"))
    # One pass over the payload for all its parts, and a signature that is computed before its two uses.
    top = ["pspReference", "originalReference", "merchantAccountCode", "merchantReference", "amount", "eventCode", "success"]
    told = rows.select("*", F.json_tuple(F.col("value").cast("string"), *top).alias(*[f"_{p}" for p in top]))
    cash = [F.get_json_object("_amount", f"$.{p}") for p in ("value", "currency")]
    parts = [F.coalesce(c, F.lit("")) for c in (*[F.col(f"_{p}") for p in top[:4]], *cash, F.col("_eventCode"), F.col("_success"))]
    digest = F.when(n % 11 == 0, F.lit(None)).otherwise(flip(sign(F.encode(F.concat_ws(":", *parts), "utf-8"))))
    body = F.col("value").cast("string")
    signed = F.when(
        F.col("_d").isNotNull(),
        F.concat(F.expr("substring(_b, 1, length(_b) - 2)"), F.lit(',"hmacSignature":"'), F.col("_d"), F.lit('"}}'))
    ).otherwise(F.col("_b"))
    whole = told.withColumn("_d", digest).withColumn("_b", body)
    return whole.select("offset", signed.cast("binary").alias("value"))
