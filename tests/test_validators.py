import pytest
from pyspark.sql import functions as F

from saldo import constants as C
from saldo.functions import validators as V


def one(spark, value, make, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(make(F.col("v")).alias("r")).first()["r"]


def test_null_spellings_are_exact(spark):
    values = [*C.NULL_SPELLINGS, "nUll", "nil", " ", "0"]
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    kept = rows.select(V.normalize_null_string(F.col("v")).alias("r")).filter("r IS NOT NULL")
    assert sorted(r["r"] for r in kept.collect()) == [" ", "0", "nUll", "nil"]


@pytest.mark.parametrize("text,value,message", [
    ("usd", "USD", None), (" Eur ", "EUR", None), (None, None, "Currency is required"),
    ("", None, "Currency cannot be empty"), ("US", None, "Currency must be 3 characters, got 2"),
    ("XXX", None, "Unsupported currency: XXX"),
])
def test_currency(spark, text, value, message):
    r = one(spark, text, V.validate_currency)
    assert (r["is_valid"], r["value"], r["message"]) == (message is None, value, message)


@pytest.mark.parametrize("json,value", [
    ("0", 0), ("100000000", 100000000), ("100000001", None), ("-1", None), ('"123"', 123), ("12.7", 12),
    ("-0.5", 0), ('"12.7"', None), ('"abc"', None), ("null", None), ("99999999999999999999999", None), ("1e3", 1000),
])
def test_amount(spark, json, value):
    r = one(spark, json, lambda c: V.validate_amount(
        V.variant_integer(F.parse_json(c)), ~F.is_variant_null(F.parse_json(c))))
    assert (r["is_valid"], r["value"]) == (value is not None, value)


def test_amount_bounds_and_zero(spark):
    strict = lambda c: V.validate_amount(c, low=10, high=20, allow_zero=False)
    assert one(spark, 9, strict, "bigint")["message"] == "Amount must be >= 10, got 9"
    assert one(spark, 21, strict, "bigint")["message"] == "Amount must be <= 20, got 21"
    no_zero = lambda c: V.validate_amount(c, allow_zero=False)
    assert one(spark, 0, no_zero, "bigint")["message"] == "Amount cannot be zero"
    assert one(spark, 0, V.validate_refund_amount, "bigint")["is_valid"]


def test_error_list_keeps_order_and_drops_blanks(spark):
    errors = V.collect_errors(
        V.error(F.lit(False), "a", "A", "x"), V.error(F.lit(True), "b", "B", "x"), V.error(F.lit(True), "c", "C", "x"))
    row = spark.range(1).select(V.error_codes(errors).alias("all"), V.primary_error_code(errors).alias("first")).first()
    assert (row["all"], row["first"]) == (["B", "C"], "B")
    none = V.collect_errors(V.error(F.lit(False), "a", "A", "x"))
    assert spark.range(1).select(V.primary_error_code(none).alias("r")).first()["r"] is None


@pytest.mark.parametrize("provider,raw,expected", [
    ("stripe", "charge.dispute.created", "dispute.created"), ("stripe", "Custom.Type", "Custom.Type"),
    ("square", "payment.completed", "payment.succeeded"), ("adyen", "AUTHORISATION", "payment.authorized"),
    ("adyen", "NEW_CODE", "new_code"), ("braintree", "subscription_went_past_due", "subscription.past_due"),
    ("braintree", "odd_kind_x", "odd.kind.x"),
])
def test_event_types(spark, provider, raw, expected):
    assert one(spark, raw, lambda c: V.normalize_event_type(provider, c)) == expected


def test_iso_timestamps(spark):
    fallback = F.lit("2024-06-01").cast("timestamp")
    read = lambda t: str(one(spark, t, lambda c: V.parse_iso_or(c, fallback).cast("string")))
    assert read("2024-01-15T12:00:00Z") == "2024-01-15 12:00:00"
    assert read("2024-01-15T12:00:00+02:00") == "2024-01-15 10:00:00"
    assert read("garbage") == read("") == read(None) == "2024-06-01 00:00:00"
