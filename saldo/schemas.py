"""Declared schemas. Nothing at a table boundary is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B, TS = (
    T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.TimestampType(),
)
MONEY = T.DecimalType(10, 2)


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


def _strings(*names: str) -> list[tuple]:
    return [(n, S) for n in names]


# Raw message, the shape of the Kafka source plus the fields the jobs use.
RAW_MESSAGE = _schema(("value", T.BinaryType()), ("topic", S), ("partition", I), ("offset", L))

ERROR = _schema(("field", S), ("code", S), ("message", S))
ERRORS = T.ArrayType(ERROR)

UNIFIED = _schema(
    *_strings("event_id", "provider", "provider_event_id", "event_type", "merchant_id", "customer_id"),
    ("amount_cents", L),
    *_strings("currency", "payment_method_type", "card_brand", "card_last_four", "status",
              "failure_code", "failure_message", "metadata"),
    ("provider_created_at", TS), ("processed_at", TS), ("schema_version", L),
)

BRONZE = _schema(
    *_strings("event_id", "provider", "provider_event_id", "event_type", "customer_id", "merchant_id"),
    ("amount_cents", L),
    *_strings("currency", "payment_method_type", "card_brand", "card_last_four", "status",
              "failure_code", "failure_message"),
    ("fraud_score", D), ("risk_level", S), ("churn_score", D), ("churn_risk_level", S),
    ("retry_strategy", S), ("retry_delay_seconds", L), ("days_to_churn_estimate", L),
    ("validation_status", S), ("validation_errors", S),
    ("provider_created_at", TS), ("processed_at", TS), ("ingested_at", TS),
    ("metadata", S), ("schema_version", L),
)

QUARANTINE = _schema(
    *_strings("event_id", "provider", "provider_event_id", "original_payload", "validation_errors",
              "failure_reason", "source_topic"),
    ("kafka_partition", L), ("kafka_offset", L), ("reviewed", B), ("reviewed_at", TS),
    ("reviewed_by", S), ("resolution", S), ("quarantined_at", TS),
)

DLQ = _schema(
    *_strings("event_id", "provider", "provider_event_id", "original_payload"),
    ("validation_errors", ERRORS), ("failure_reason", S), ("source_topic", S),
    ("kafka_partition", I), ("kafka_offset", L), ("quarantined_at", TS), ("schema_version", L),
)

INGRESS_DLQ = _schema(
    ("provider", S), ("raw_payload", S), ("raw_headers", T.MapType(S, S)), ("error_type", S),
    ("error_message", S), ("received_at", TS), ("retry_count", I),
)

CHARGES = _schema(
    *_strings("event_id", "event_type", "provider", "charge_id", "customer_id"),
    ("amount", MONEY),
    *_strings("currency", "status", "failure_code", "failure_message", "payment_method_id",
              "payment_method_type", "card_brand", "card_last4"),
    ("card_exp_month", I), ("card_exp_year", I),
    *_strings("card_country", "billing_country", "billing_postal_code", "merchant_id",
              "merchant_name", "description"),
    ("metadata", _schema(*_strings("order_id", "user_email", "subscription_id"))),
    ("risk_score", I), ("risk_level", S), ("3ds_authenticated", S),
    ("created_at", TS), ("updated_at", TS),
)

REFUNDS = _schema(
    *_strings("event_id", "event_type", "provider", "refund_id", "charge_id", "customer_id"),
    ("amount", MONEY),
    *_strings("currency", "status", "reason", "failure_reason", "merchant_id"),
    ("metadata", _schema(*_strings("refund_requested_by", "original_order_id", "support_ticket_id"))),
    ("created_at", TS), ("updated_at", TS),
)

DISPUTES = _schema(
    *_strings("event_id", "event_type", "provider", "dispute_id", "charge_id", "customer_id"),
    ("amount", MONEY),
    *_strings("currency", "status", "reason"),
    ("evidence_due_by", TS), ("is_charge_refundable", S), ("merchant_id", S),
    ("metadata", _schema(*_strings("case_number", "customer_contacted", "evidence_submitted"))),
    ("network_reason_code", S), ("created_at", TS), ("updated_at", TS),
)

SUBSCRIPTIONS = _schema(
    *_strings("event_id", "event_type", "provider", "subscription_id", "customer_id", "plan_id",
              "plan_name"),
    ("amount", MONEY), ("currency", S), ("interval", S), ("interval_count", I), ("status", S),
    ("cancel_at_period_end", S), ("canceled_at", TS), ("trial_start", TS), ("trial_end", TS),
    ("current_period_start", TS), ("current_period_end", TS), ("payment_method_id", S),
    ("merchant_id", S),
    ("metadata", _schema(*_strings("user_email", "signup_source", "promo_code"))),
    ("discount", _schema(("coupon_id", S), ("percent_off", I))),
    ("created_at", TS), ("updated_at", TS),
)

STREAMS = {
    "charges": CHARGES, "refunds": REFUNDS, "disputes": DISPUTES, "subscriptions": SUBSCRIPTIONS,
}


def valid_schema(kind: str) -> T.StructType:
    """Schema of the accepted rows of one stream."""
    return T.StructType([*STREAMS[kind].fields, T.StructField("validation_flag", B, True)])


def quarantine_schema(kind: str) -> T.StructType:
    """Schema of the rejected rows of one stream."""
    return T.StructType([
        *STREAMS[kind].fields,
        T.StructField("quarantine_timestamp", TS, True),
        T.StructField("rejection_reason", S, True),
    ])
