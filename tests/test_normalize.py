import copy
import json

import pytest
from pyspark.sql import functions as F

from saldo.operators import gateway as G
from saldo.operators import normalize as N
from saldo.schemas import DLQ, RAW_MESSAGE, UNIFIED

NOW = "2024-06-01 00:00:00"

STRIPE = {
    "id": "evt_1", "object": "event", "api_version": "2023-10-16", "created": 1705312800, "type": "charge.succeeded",
    "data": {"object": {
        "id": "ch_1", "amount": 2000, "currency": "usd", "status": "succeeded", "customer": "cus_1", "created": 1705312800,
        "paid": True, "captured": True, "payment_method_details": {"card": {"brand": "visa", "last4": "4242"}},
        "metadata": {"merchant_id": "m1"}}},
    "livemode": False,
}
SQUARE = {
    "merchant_id": "M", "type": "payment.completed", "event_id": "sq1", "created_at": "2024-01-15T10:00:00Z",
    "data": {"type": "payment", "id": "p1", "object": {"payment": {
        "id": "p1", "created_at": "2024-01-15T10:00:00Z", "amount_money": {"amount": 500, "currency": "USD"},
        "status": "COMPLETED", "source_type": "CARD", "location_id": "L", "customer_id": "c",
        "card_details": {"card_brand": "VISA", "last_4": "1111"}}}},
}
ADYEN = {
    "pspReference": "psp1", "merchantAccountCode": "acc", "amount": {"value": 1000, "currency": "EUR"},
    "eventCode": "AUTHORISATION", "success": True, "eventDate": "2024-01-15T12:00:00+00:00", "paymentMethod": "mc",
    "additionalData": {"cardSummary": "1234"}, "operations": ["CAPTURE"], "live": False,
}
BRAINTREE = {
    "kind": "transaction_settled", "timestamp": "2024-01-15T10:00:00Z",
    "transaction": {"id": "t1", "status": "settled", "type": "sale", "amount": "10.00", "currency_iso_code": "USD",
                    "merchant_account_id": "ma", "customer_id": "c1", "payment_instrument_type": "credit_card",
                    "card_details": {"card_type": "Visa", "last_4": "1111"}},
}
TOPICS = {"stripe": "webhooks.stripe.charge", "square": "webhooks.square.payment",
          "adyen": "webhooks.adyen.notification", "braintree": "webhooks.braintree.notification"}
BASE = {"stripe": STRIPE, "square": SQUARE, "adyen": ADYEN, "braintree": BRAINTREE}


def put(payload, path, value):
    """A copy with one member changed; a value of ... removes it."""
    out = copy.deepcopy(payload)
    *parents, last = path.split(".")
    node = out
    for p in parents:
        node = node[p]
    if value is ...:
        node.pop(last)
    else:
        node[last] = value
    return out


def raw(spark, provider, payloads):
    enc = [p if isinstance(p, bytes) else json.dumps(p).encode() for p in payloads]
    return spark.createDataFrame(
        [(bytearray(v), TOPICS[provider], 0, i) for i, v in enumerate(enc)], RAW_MESSAGE)


def judged(spark, provider, payloads):
    rows = N.PROVIDER_FUNCTIONS[provider](raw(spark, provider, payloads), F.lit(NOW).cast("timestamp"))
    return sorted(rows.collect(), key=lambda r: r["offset"])


def errors(row):
    return [e["code"] for e in row["errors"]]


CASES = [
    ("stripe", "id", ..., ["MISSING_EVENT_ID"]), ("stripe", "type", "", ["MISSING_EVENT_TYPE"]),
    ("stripe", "data.object", {}, ["MISSING_DATA_OBJECT"]), ("stripe", "data", ..., ["MISSING_DATA_OBJECT"]),
    ("stripe", "data.object.id", None, ["MISSING_OBJECT_ID"]),
    ("stripe", "data.object.amount", -5, ["INVALID_AMOUNT_NEGATIVE"]),
    ("stripe", "data.object.amount", 100000001, ["INVALID_AMOUNT_TOO_LARGE"]),
    ("stripe", "data.object.amount", "abc", ["INVALID_AMOUNT"]), ("stripe", "data.object.amount", ..., ["INVALID_AMOUNT"]),
    ("stripe", "data.object.amount", "123", []), ("stripe", "data.object.currency", "zzz", ["INVALID_CURRENCY"]),
    ("stripe", "data.object", "text", ["INVALID_JSON"]),
    ("square", "event_id", ..., ["MISSING_EVENT_ID"]), ("square", "data", {}, ["MISSING_DATA"]),
    ("square", "data.object", {}, ["MISSING_PAYMENT"]), ("square", "data.type", "refund", ["MISSING_REFUND"]),
    ("square", "data.type", "other", []), ("square", "data", {"type": "other", "object": {}}, ["UNKNOWN_OBJECT_TYPE"]),
    ("square", "data.object.payment.amount_money.amount", -1, ["INVALID_AMOUNT_NEGATIVE"]),
    ("adyen", "pspReference", "", ["MISSING_PSP_REFERENCE"]), ("adyen", "eventCode", ..., ["MISSING_EVENT_CODE"]),
    ("adyen", "amount", ..., ["INVALID_AMOUNT", "INVALID_CURRENCY"]), ("adyen", "eventDate", "bad", []),
    ("braintree", "kind", ..., ["MISSING_KIND"]), ("braintree", "transaction.id", ..., ["MISSING_TRANSACTION_ID"]),
    ("braintree", "transaction.amount", "abc", ["INVALID_AMOUNT"]),
    ("braintree", "transaction.amount", "-1.00", ["INVALID_AMOUNT"]),
    ("braintree", "transaction.amount", "1000000.01", ["INVALID_AMOUNT"]),
    ("braintree", "transaction.currency_iso_code", ..., []),
    ("braintree", "transaction.currency_iso_code", None, ["INVALID_CURRENCY"]),
]


@pytest.mark.parametrize("provider", list(BASE))
def test_error_lists(spark, provider):
    mine = [c for c in CASES if c[0] == provider]
    rows = judged(spark, provider, [put(BASE[provider], path, value) for _, path, value, _ in mine])
    for (_, path, value, expected), row in zip(mine, rows, strict=True):
        assert errors(row) == expected, (path, value)


def test_errors_come_in_order(spark):
    broken = put(put(put(STRIPE, "id", ""), "data.object.amount", -1), "data.object.currency", "x")
    assert errors(judged(spark, "stripe", [broken])[0]) == ["MISSING_EVENT_ID", "INVALID_AMOUNT_NEGATIVE", "INVALID_CURRENCY"]


def test_unreadable_payloads(spark):
    bad = [b'{"id": "evt', b"[1, 2]", b"5", b"", b"\xff\xfe{}", b'{"id": "a"} trailing']
    assert [errors(r) for r in judged(spark, "stripe", bad)] == [["INVALID_JSON"]] * len(bad)


def test_stripe_fields(spark):
    intent = put(put(STRIPE, "type", "payment_intent.payment_failed"), "data.object.payment_method_types", ["us_bank_account"])
    intent = put(put(intent, "data.object.status", ...), "data.object.last_payment_error", {"code": "card_declined", "message": "null"})
    refund = put(put(put(STRIPE, "type", "refund.created"), "data.object.payment_method_details", ...), "data.object.failure_reason", "lost")
    plain = put(put(STRIPE, "data.object.payment_method_details", ...), "data.object.created", ...)
    a, b, c, d = judged(spark, "stripe", [STRIPE, intent, refund, plain])
    assert (a["event_id"], a["payment_method_type"], a["card_brand"], a["card_last_four"]) == ("stripe:evt_1", None, "visa", "4242")
    assert (a["merchant_id"], a["customer_id"], a["currency"], a["event_type"]) == ("m1", "cus_1", "USD", "charge.succeeded")
    assert (b["payment_method_type"], b["status"], b["failure_code"], b["failure_message"]) == ("us_bank_account", "failed", "card_declined", None)
    assert (c["payment_method_type"], c["failure_code"]) == ("refund", "lost")
    assert d["payment_method_type"] == "card" and d["provider_created_at"] == a["provider_created_at"]


def test_adyen_and_braintree_fields(spark):
    failed = put(put(ADYEN, "success", False), "reason", "Card Expired")
    binned = put(ADYEN, "additionalData.cardBin", "411111")
    a, b, c = judged(spark, "adyen", [ADYEN, failed, binned])
    assert (a["event_id"], a["status"], a["payment_method_type"], a["card_brand"]) == ("adyen:psp1_AUTHORISATION", "authorized", "card", "mastercard")
    assert (b["status"], b["failure_code"], b["failure_message"]) == ("failed", "expired_card", "Card Expired")
    assert c["card_brand"] == "411111"
    cents = put(BRAINTREE, "transaction.amount", "10.999")
    event = {"kind": "dispute_opened", "timestamp": "2024-01-15T10:00:00Z", "dispute": {"id": "d"}}
    x, y = judged(spark, "braintree", [cents, event])
    assert x["amount_cents"] == 1099
    assert (y["event_id"], y["amount_cents"], y["status"], y["currency"]) == (
        "braintree:dispute_opened_2024-01-15T10:00:00Z", 0, "disputed", "USD")


def test_dlq_rows_and_partition_of_input(spark, tmp_path):
    messages = raw(spark, "stripe", [STRIPE, put(STRIPE, "data.object.amount", -1), b"\xff{"])
    out = N.normalize(messages, F.lit(NOW).cast("timestamp"), str(tmp_path / "n"))
    assert out.valid.schema.names == UNIFIED.names and out.dlq.schema.names == DLQ.names
    assert out.valid.count() == 1
    amount, garbage = sorted(out.dlq.collect(), key=lambda r: r["kafka_offset"])
    assert (amount["event_id"], amount["failure_reason"], amount["schema_version"]) == ("stripe:evt_1", "INVALID_AMOUNT_NEGATIVE", 1)
    assert garbage["event_id"] is None and "�" in garbage["original_payload"]


def test_structure_rules(spark):
    rows = raw(spark, "stripe", [STRIPE, put(STRIPE, "data.object.id", "pi_1"), put(STRIPE, "data.object.paid", ...),
                                 put(STRIPE, "type", "charge.unknown"), put(STRIPE, "type", "invoice.paid")])
    got = [[e["code"] for e in r["structure_errors"]] for r in G.check_structure(rows, "stripe").orderBy("offset").collect()]
    assert got == [[], ["string_pattern_mismatch"], ["missing"], ["literal_error"], ["union_tag_invalid"]]
    rows = raw(spark, "square", [SQUARE, put(SQUARE, "data.object.payment.status", "NEW"),
                                 put(SQUARE, "data.object.payment.card_details.exp_month", 13)])
    got = [[e["code"] for e in r["structure_errors"]] for r in G.check_structure(rows, "square").orderBy("offset").collect()]
    assert got == [[], ["literal_error"], ["out_of_range"]]


def test_batches_explode_to_normalizable_items(spark):
    request = {"live": True, "notificationItems": [{"NotificationRequestItem": ADYEN}, {"NotificationRequestItem": put(ADYEN, "eventCode", "REFUND")}]}
    items = G.explode_adyen_batch(raw(spark, "adyen", [request]))
    assert sorted(r["key"] for r in items.collect()) == ["psp1_AUTHORISATION", "psp1_REFUND"]
    rows = N.adyen_to_unified(items.drop("item_no", "key"), F.lit(NOW).cast("timestamp")).collect()
    assert all(errors(r) == [] and json.loads(r["metadata"])["live"] is True for r in rows)


def test_braintree_decoding(spark):
    import base64

    enc = lambda b: base64.b64encode(b).decode()
    payloads = [enc(json.dumps({"kind": "check", "transaction": {"id": "1"}}).encode()), enc(b"<n><kind>dispute_won</kind></n>"),
                enc(b"<n><kind>broken"), "%%%", enc(b"\xff\xfe"), None]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "i int, bt_payload string")
    got = [r["kind"] for r in G.decode_braintree(rows).orderBy("i").collect()]
    assert got == ["check", "dispute_won", "unknown", "unknown", "unknown", "unknown"]


def test_raw_data_that_is_not_cut_by_topic(spark, sf):
    from workload import adapters as W

    raw, now = W.raw_messages(spark, sf), F.lit(W.AS_OF).cast("timestamp")
    want, got = N.normalize(raw, now), N.normalize(raw.repartition(2), now, cut_by_topic=False)
    for name in ("valid", "dlq"):
        assert sorted(map(str, getattr(got, name).collect())) == sorted(map(str, getattr(want, name).collect()))
