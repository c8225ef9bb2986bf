import pytest
from pyspark.sql import functions as F

from saldo import constants as C
from saldo.functions import macros as M
from saldo.functions import scoring as R
from saldo.operators import enrich as E


def value(spark, column):
    return spark.range(1).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("score,level", [(None, "low"), (0.29, "low"), (0.3, "medium"), (0.69, "medium"), (0.7, "high")])
def test_fraud_levels(spark, score, level):
    assert value(spark, M.fraud_risk_level(F.lit(score).cast("double"))) == level
    assert value(spark, R.fraud_level(F.lit(score).cast("double"))) == level


@pytest.mark.parametrize("p,level", [(0.24, "low"), (0.25, "medium"), (0.5, "high"), (0.75, "critical")])
def test_churn_levels(spark, p, level):
    assert value(spark, R.churn_level4(F.lit(p))) == level


@pytest.mark.parametrize("event_type,category,staging", [
    ("charge.refunded", "charge", "charge"), ("subscription.charged", "charge", "charge"),
    ("dispute.second_chargeback", "charge", "charge"), ("payment.succeeded", "charge", "charge"),
    ("refund.failed", "refund", "refund"), ("dispute.created", "dispute", "dispute"),
    ("subscription.canceled", "subscription", "subscription"), ("payment.failed", "failed_payment", "failed_payment"),
    ("payout.expired", "other", "other"), (None, "other", "other"),
])
def test_categories(spark, event_type, category, staging):
    text = F.lit(event_type).cast("string")
    assert value(spark, M.event_type_category(text)) == category
    assert value(spark, M.staging_category(text)) == staging


def test_small_expressions(spark):
    assert value(spark, M.safe_divide(F.lit(1), F.lit(0))) == 0.0
    assert value(spark, M.safe_divide(F.lit(1), F.lit(None).cast("int"))) == 0.0
    assert value(spark, M.safe_divide(F.lit(1), F.lit(4))) == 0.25
    assert str(value(spark, M.cents_to_dollars(F.lit(12345)))) == "123.45"
    assert value(spark, M.surrogate_key(F.lit(None), F.lit("a"))) == value(spark, F.md5(F.lit("-a")))
    assert value(spark, M.whole_days(F.lit("2024-01-01 23:00:00").cast("timestamp"), F.lit("2024-01-02 01:00:00").cast("timestamp"))) == 0
    health = lambda *r: value(spark, M.merchant_health_score(*[F.lit(x) for x in r]))
    assert health(0.0, 0.0, 0.0) == 100.0 and health(1.0, 1.0, 1.0) == 0.0 and health(0.01, 0.02, 0.03) == pytest.approx(81.0)
    days = M.date_spine(spark, "2020-01-01", "2030-12-31")
    assert days.count() == 4017 and str(days.agg(F.max("date_day")).first()[0]) == "2030-12-30"


def retry(spark, code, attempt):
    return value(spark, R.retry_strategy(F.lit(code).cast("string"), F.lit(attempt)))


def test_retry(spark):
    for code in C.NON_RETRYABLE_CODES:
        assert retry(spark, code, 1)["action"] == "do_not_retry"
    for code in C.CUSTOMER_ACTION_CODES:
        assert retry(spark, code, 9)["action"] == "contact_customer"
    assert [retry(spark, "timeout", n)["delay_seconds"] for n in (1, 2, 3, 4)] == [60, 120, 240, 480]
    assert retry(spark, "timeout", 5)["reason"] == "Maximum attempts (5) reached"
    assert retry(spark, "Card Declined", 1)["confidence"] == 0.95
    assert retry(spark, None, 1)["delay_seconds"] == 60
    assert retry(spark, "odd", 3)["delay_seconds"] == 360


def test_card_expiry(spark):
    now = F.lit("2024-06-15").cast("timestamp")
    expired = lambda m, y: value(spark, R.is_card_expired(F.lit(m).cast("int"), F.lit(y).cast("int"), now))
    assert expired(5, 2024) and expired(12, 2023)
    assert not expired(6, 2024) and not expired(1, 2025) and not expired(None, 2020) and not expired(0, 2020)


def plan(spark, **over):
    base = dict(failure_code="processing_error", amount_cents=100, attempt_number=1, max_attempts=5, ltv_cents=0,
                subscription_tier=None, has_email=True, has_phone=False, has_backup=False, card_exp_month=None, card_exp_year=None)
    row = {**base, **over}
    schema = ("failure_code string, amount_cents bigint, attempt_number int, max_attempts int, ltv_cents bigint, subscription_tier string,"
              "has_email boolean, has_phone boolean, has_backup boolean, card_exp_month int, card_exp_year int")
    return E.recovery_plan(spark.createDataFrame([tuple(row.values())], schema), "2024-06-15 00:00:00").first()


def test_recovery(spark):
    actions = lambda p: [s["action"] for s in p["steps"]]
    expired = plan(spark, card_exp_month=1, card_exp_year=2020, has_phone=True)
    assert (expired["primary_action"], expired["probability"]) == ("update_payment_method", 0.35)
    assert actions(expired) == ["update_payment_method", "dunning_email", "sms_reminder"]
    backup = plan(spark, failure_code="card_declined", has_backup=True)
    assert actions(backup) == ["offer_alternative", "dunning_email"] and backup["probability"] == 0.65
    assert plan(spark, ltv_cents=10_000_001)["priority"] == "urgent"
    assert plan(spark, ltv_cents=10_000_000)["priority"] == "medium"
    assert plan(spark, subscription_tier="pro")["priority"] == "high"
    late = plan(spark, attempt_number=9)
    assert late["steps"][0]["expected_success_rate"] == 0.0 and late["steps"][0]["delay_hours"] == 24.0
    assert actions(plan(spark, failure_code="odd", attempt_number=4)) == ["retry_optimal_time", "dunning_email", "escalate_to_support"]
    assert plan(spark, failure_code=None)["insights"] == ["Unknown failure code: none"]


def test_business_rules(spark):
    schema = "event_id string, provider string, event_type string, status string, amount_cents bigint, currency string, customer_id string, merchant_id string"
    rows = [("a", "p", "t", "s", 1, "usd", "c", "m"), ("b", "p", "t", " ", 0, "SEK", "cus_blocked_001", "merch_blocked_001"),
            ("c", "p", None, "s", 100_000_001, "USD", None, None), ("d", "p", "t", "s", 100_000_000, "NZD", "c", "m")]
    df = spark.createDataFrame(rows, schema)
    got = {r["event_id"]: [e["code"] for e in r["errors"]] for r in E.business_rules(df).collect()}
    assert got == {
        "a": [], "d": [], "c": ["AMOUNT_EXCEEDS_MAXIMUM", "MISSING_REQUIRED_FIELD"],
        "b": ["AMOUNT_NOT_POSITIVE", "CURRENCY_NOT_ALLOWED", "CUSTOMER_BLOCKLISTED", "MERCHANT_BLOCKLISTED", "MISSING_REQUIRED_FIELD"]}
    listed = spark.createDataFrame([("c",), ("c",)], "customer_id string")
    tables = E.business_rules(df, listed, spark.createDataFrame([], "merchant_id string"))
    assert {r["event_id"] for r in tables.collect() if "CUSTOMER_BLOCKLISTED" in [e["code"] for e in r["errors"]]} == {"a", "d"}
