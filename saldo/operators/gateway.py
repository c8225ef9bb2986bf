"""Webhook intake checks as batch jobs: unpacking, routing, structure, signatures, dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo import constants as C
from saldo.functions import validators as V
from saldo.operators.normalize import ADYEN_ITEM, parse_payload
from saldo.schemas import INGRESS_DLQ

ADYEN_BATCH = f"""
    live boolean,
    notificationItems array<struct<NotificationRequestItem: struct<{ADYEN_ITEM}>>>,
    _corrupt_record string"""


def explode_adyen_batch(raw: DataFrame) -> DataFrame:
    """One message per notification item, carrying the request's live flag. A pure narrow expansion."""
    items = parse_payload(raw, ADYEN_BATCH).select(
        "topic", "partition", "offset", F.col("p.live").alias("live"),
        F.posexplode("p.notificationItems").alias("item_no", "wrapper"))
    item = F.col("wrapper.NotificationRequestItem")
    names = [
        "pspReference", "eventCode", "merchantAccountCode", "merchantReference", "originalReference",
        "amount", "success", "eventDate", "paymentMethod", "reason", "operations", "additionalData"]
    body = F.to_json(
        F.struct(*[item[n].alias(n) for n in names], F.col("live")), {"ignoreNullFields": "false"})
    return items.select(
        body.cast("binary").alias("value"), "topic", "partition", "offset", "item_no",
        F.concat(item["pspReference"], F.lit("_"), item["eventCode"]).alias("key"))


def route_topic(provider: str, event_type: Column, prefix: str = "webhooks") -> Column:
    """Topic of an event: by type prefix for stripe, by the part before the dot for square."""
    base = F.lit(f"{prefix}.{provider}.")
    if provider == "stripe":
        groups = ["payment_intent", "charge", "refund"]
        group = F.coalesce(*[F.when(event_type.startswith(g + "."), g) for g in groups], F.lit("unknown"))
    elif provider == "square":
        group = F.split_part(event_type, F.lit("."), F.lit(1))
    else:
        group = F.lit("notification")
    return F.concat(base, group)


# --- structural rules -----------------------------------------------------------------------------

def _need(c: Column, field: str) -> Column:
    return V.error(c.isNull(), field, "missing", "Field required")


def _pattern(c: Column, field: str, prefix: str) -> Column:
    return V.error(~c.rlike(f"^{prefix}_[a-zA-Z0-9]+$"), field, "string_pattern_mismatch",
                   f"String should match ^{prefix}_[a-zA-Z0-9]+$")


def _one_of(c: Column, field: str, allowed: list[str]) -> Column:
    return V.error(~c.isin(allowed), field, "literal_error", "Value is not one of the allowed ones")


def _at_least_zero(v: Column, field: str) -> Column:
    whole = V.variant_integer(v)
    return V.error(whole < 0, field, "greater_than_equal", "Input should be greater than or equal to 0")


def _three_letters(c: Column, field: str) -> Column:
    return V.error(F.length(c) != 3, field, "string_length", "String should have 3 characters")


def _need_json(v: Column, field: str) -> Column:
    return V.error(v.isNull() | F.is_variant_null(v), field, "missing", "Field required")


STRUCTURE_PAYLOADS = {
    "stripe": """
        id string, api_version string, created double, type string, livemode boolean,
        pending_webhooks variant,
        data struct<object: struct<
            id: string, amount: variant, amount_capturable: variant, amount_received: variant,
            amount_captured: variant, amount_refunded: variant, currency: string, status: string,
            customer: string, payment_method: string, payment_intent: string, charge: string,
            paid: boolean, captured: boolean, created: double>>,
        request struct<id: string>, _corrupt_record string""",
    "square": """
        merchant_id string, type string, event_id string, created_at string,
        data struct<type: string, id: string, object: struct<
            payment: struct<id: string, created_at: string, status: string, location_id: string,
                amount_money: struct<amount: variant, currency: string>,
                card_details: struct<exp_month: int, exp_year: int>>,
            refund: struct<id: string, created_at: string, status: string, location_id: string,
                payment_id: string, amount_money: struct<amount: variant, currency: string>>>>,
        _corrupt_record string""",
    "adyen": ADYEN_ITEM + ", live boolean, _corrupt_record string",
    "braintree": """
        kind string, timestamp string, transaction struct<id: string, status: string, amount: string>,
        subscription struct<id: string, status: string>, dispute struct<id: string, status: string>,
        _corrupt_record string""",
}


def _stripe_structure(p: Column) -> list[tuple[Column, list[Column]]]:
    o = p["data"]["object"]
    at = "data.object."
    kind = p["type"]
    event = [
        _need(p["id"], "id"), _pattern(p["id"], "id", "evt"), _need(p["api_version"], "api_version"),
        _need(p["created"], "created"), _need(p["livemode"], "livemode"),
        _at_least_zero(p["pending_webhooks"], "pending_webhooks"),
        _pattern(p["request"]["id"], "request.id", "req"),
    ]
    common = [
        _need(o["id"], at + "id"), _need_json(o["amount"], at + "amount"),
        _at_least_zero(o["amount"], at + "amount"), _need(o["currency"], at + "currency"),
        _three_letters(o["currency"], at + "currency"), _need(o["status"], at + "status"),
        _need(o["created"], at + "created"),
    ]
    types = lambda group: [t for t in C.STRIPE_EVENT_TYPES if t.startswith(group + ".")]
    intent = [
        _one_of(kind, "type", types("payment_intent")), _pattern(o["id"], at + "id", "pi"),
        _one_of(o["status"], at + "status", C.STRIPE_INTENT_STATUSES),
        _at_least_zero(o["amount_capturable"], at + "amount_capturable"),
        _at_least_zero(o["amount_received"], at + "amount_received"),
        _pattern(o["customer"], at + "customer", "cus"), _pattern(o["payment_method"], at + "payment_method", "pm"),
    ]
    charge = [
        _one_of(kind, "type", types("charge")), _pattern(o["id"], at + "id", "ch"),
        _one_of(o["status"], at + "status", C.STRIPE_CHARGE_STATUSES),
        _at_least_zero(o["amount_captured"], at + "amount_captured"),
        _at_least_zero(o["amount_refunded"], at + "amount_refunded"),
        _need(o["paid"], at + "paid"), _need(o["captured"], at + "captured"),
        _pattern(o["customer"], at + "customer", "cus"),
        _pattern(o["payment_intent"], at + "payment_intent", "pi"),
        _pattern(o["payment_method"], at + "payment_method", "pm"),
    ]
    refund = [
        _one_of(kind, "type", types("refund")), _pattern(o["id"], at + "id", "re"),
        _one_of(o["status"], at + "status", C.STRIPE_REFUND_STATUSES),
        _pattern(o["charge"], at + "charge", "ch"), _pattern(o["payment_intent"], at + "payment_intent", "pi"),
    ]
    return [
        (kind.startswith("payment_intent."), event + common + intent),
        (kind.startswith("charge."), event + common + charge),
        (kind.startswith("refund."), event + common + refund),
        (F.lit(True), [V.error(F.lit(True), "type", "union_tag_invalid", "Unknown event type")]),
    ]


def _square_structure(p: Column):
    data = p["data"]
    event = [_need(p[n], n) for n in ("merchant_id", "type", "event_id", "created_at")] + [
        _need(data["type"], "data.type"), _need(data["id"], "data.id"), _need(data["object"], "data.object"),
    ]
    group = F.split_part(p["type"], F.lit("."), F.lit(1))

    def body(name: str, statuses: dict, extra: list[str]) -> list[Column]:
        o, at = data["object"][name], f"data.object.{name}."
        cash = o["amount_money"]
        return [_need(o[n], at + n) for n in ["id", "created_at", "status", "location_id", *extra]] + [
            _one_of(o["status"], at + "status", list(statuses)),
            _need_json(cash["amount"], at + "amount_money.amount"),
            _at_least_zero(cash["amount"], at + "amount_money.amount"),
            _need(cash["currency"], at + "amount_money.currency"),
            _three_letters(cash["currency"], at + "amount_money.currency"),
        ]

    card = data["object"]["payment"]["card_details"]
    at = "data.object.payment.card_details."
    card_rules = [
        V.error(~card["exp_month"].between(1, 12), at + "exp_month", "out_of_range", "Month must be 1 to 12"),
        V.error(card["exp_year"] < 2020, at + "exp_year", "greater_than_equal", "Year must be 2020 or later"),
    ]
    held = lambda name: F.coalesce(data["object"][name].isNotNull(), F.lit(False))
    return [
        ((group == "payment") & held("payment"), event + body("payment", C.SQUARE_STATUSES, []) + card_rules),
        ((group == "refund") & held("refund"), event + body("refund", C.SQUARE_REFUND_STATUSES, ["payment_id"])),
        (F.lit(True), event),
    ]


def _adyen_structure(p: Column):
    cash = p["amount"]
    return [(F.lit(True), [
        *[_need(p[n], n) for n in ("pspReference", "eventCode", "merchantAccountCode")],
        _need_json(cash["value"], "amount.value"), _at_least_zero(cash["value"], "amount.value"),
        _need(cash["currency"], "amount.currency"), _three_letters(cash["currency"], "amount.currency"),
        _need(p["success"], "success"),
    ])]


def _braintree_structure(p: Column):
    inner = [
        V.error(p[part].isNotNull() & p[part]["id"].isNull(), f"{part}.id", "missing", "Field required")
        for part in ("transaction", "subscription", "dispute")
    ]
    return [(F.lit(True), [_need(p["kind"], "kind"), *inner])]


STRUCTURES = {
    "stripe": _stripe_structure, "square": _square_structure,
    "adyen": _adyen_structure, "braintree": _braintree_structure,
}


def check_structure(raw: DataFrame, provider: str) -> DataFrame:
    """Raw messages with `structure_errors`, empty where the payload has the declared shape."""
    df = parse_payload(raw, STRUCTURE_PAYLOADS[provider])
    result = F.when(~F.col("readable"), V.collect_errors(
        V.error(F.lit(True), "payload", "json_invalid", "Payload is not a readable JSON object")))
    for condition, entries in STRUCTURES[provider](F.col("p")):
        result = result.when(condition, V.collect_errors(*entries))
    return df.withColumn("structure_errors", result).drop("p", "readable")


# --- signatures -----------------------------------------------------------------------------------

BLOCK = 64


def hmac_sha256(key: bytes, message: Column) -> Column:
    """Keyed SHA-256 digest as binary, from two nested hashes; stays inside generated code.

    The key is one secret per provider, so its two padded forms are literals.
    """
    import hashlib

    block = (hashlib.sha256(key).digest() if len(key) > BLOCK else key).ljust(BLOCK, b"\0")
    inner = F.lit(bytearray(b ^ 0x36 for b in block))
    outer = F.lit(bytearray(b ^ 0x5C for b in block))
    digest = lambda data: F.unhex(F.sha2(data, 256))
    return digest(F.concat(outer, digest(F.concat(inner, message))))


def _verdict(*rules: tuple) -> Column:
    """struct(verdict, reason) of the first rule that holds; otherwise valid."""
    chosen = None
    for condition, verdict, reason in rules:
        value = F.struct(F.lit(verdict).alias("verdict"), F.lit(reason).alias("reason"))
        chosen = F.when(condition, value) if chosen is None else chosen.when(condition, value)
    return chosen.otherwise(F.struct(F.lit("valid").alias("verdict"), F.lit(None).cast("string").alias("reason")))


def _skipped() -> Column:
    return F.struct(F.lit("valid").alias("verdict"), F.lit("verification skipped").alias("reason"))


def _missing(c: Column) -> Column:
    return ~F.coalesce(V.present(c), F.lit(False))


def stripe_verdict(value: Column, header: Column, secret: str, now_epoch: Column, tolerance: int = 300) -> Column:
    """Header `t=..,v1=..[,v1=..]`: every part needs a '=', t must be recent, one v1 must match."""
    if not secret:
        return _skipped()
    parts = F.split(header, ",")
    malformed = F.exists(parts, lambda x: ~x.contains("="))
    value_of = lambda x: F.substr(x, F.instr(x, "=") + 1)
    named = lambda name: F.transform(
        F.filter(parts, lambda x: F.substring_index(x, "=", 1) == name), value_of)
    stamp_text = F.try_element_at(named("t"), F.lit(1))
    stamp = F.when(stamp_text.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(stamp_text).try_cast("bigint"))
    signed = F.concat(F.encode(F.concat(stamp.cast("string"), F.lit(".")), "utf-8"), value.cast("binary"))
    expected = F.lower(F.hex(hmac_sha256(secret.encode(), signed)))
    given = named("v1")
    return _verdict(
        (_missing(header), "invalid", "missing signature header"),
        (malformed, "invalid", "invalid signature header format"),
        (_missing(stamp_text), "invalid", "missing timestamp"),
        (stamp.isNull(), "invalid", "invalid timestamp format"),
        (F.abs(now_epoch - stamp) > tolerance, "expired", "timestamp outside tolerance window"),
        (F.size(given) == 0, "invalid", "no v1 signature"),
        (~F.array_contains(given, expected), "invalid", "signature mismatch"),
    )


def square_verdict(value: Column, header: Column, key: str, url: str) -> Column:
    """Base64 digest over notification URL and body."""
    if not key:
        return _skipped()
    message = F.concat(F.lit(bytearray(url.encode())), value.cast("binary"))
    expected = F.base64(hmac_sha256(key.encode(), message))
    return _verdict(
        (_missing(header), "invalid", "missing signature header"),
        (F.lit(not url), "invalid", "notification URL is required"),
        (header != expected, "invalid", "signature mismatch"),
    )


def adyen_signing_text(p: Column) -> Column:
    """Eight colon-joined parts; an amount of 0 becomes empty text."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    amount = F.nullif(V.variant_integer(p["amount"]["value"]), F.lit(0))
    return F.concat_ws(
        ":", text(p["pspReference"]), text(p["originalReference"]), text(p["merchantAccountCode"]),
        text(p["merchantReference"]), text(amount), text(p["amount"]["currency"]),
        text(p["eventCode"]), text(p["success"]))


def adyen_verdict(p: Column, key_hex: str) -> Column:
    """Signature inside the item, over its signing text, keyed by the hex-decoded key."""
    if not key_hex:
        return _skipped()
    given = F.try_element_at(p["additionalData"], F.lit("hmacSignature"))
    try:
        key = bytes.fromhex(key_hex)
    except ValueError:
        return _verdict(
            (_missing(given), "invalid", "missing hmacSignature"),
            (F.lit(True), "invalid", "invalid HMAC key format"))
    expected = F.base64(hmac_sha256(key, F.encode(adyen_signing_text(p), "utf-8")))
    return _verdict(
        (_missing(given), "invalid", "missing hmacSignature"),
        (given != expected, "invalid", "signature mismatch"),
    )


def audit_signatures(captured: DataFrame, provider: str, secret: str, as_of=None, *,
                     url: str = "", tolerance: int = 300) -> DataFrame:
    """Re-verifies captured webhooks; adds `verdict` and `reason`. Rows: value plus `signature` header."""
    if provider == "adyen":
        df = parse_payload(captured, ADYEN_ITEM + ", live boolean, _corrupt_record string")
        result = adyen_verdict(F.col("p"), secret)
    elif provider == "square":
        df, result = captured, square_verdict(F.col("value"), F.col("signature"), secret, url)
    else:
        now = F.unix_timestamp(F.lit(as_of).cast("timestamp"))
        df, result = captured, stripe_verdict(F.col("value"), F.col("signature"), secret, now, tolerance)
    return df.withColumn("_v", result).select(*captured.columns, "_v.verdict", "_v.reason")


# --- braintree payloads and dead letters ----------------------------------------------------------

def decode_braintree(df: DataFrame, payload: str = "bt_payload") -> DataFrame:
    """Base64 payload to notification fields: JSON first, then XML, else kind `unknown`."""
    text = F.try_validate_utf8(F.expr(f"try_to_binary(`{payload}`, 'base64')").cast("string"))
    schema = """kind string, timestamp string, transaction string, subscription string,
                dispute string, _corrupt_record string"""
    d = df.withColumn("_text", text).withColumn("_j", F.from_json("_text", schema))
    body = F.btrim("_text", F.lit(" \t\r\n"))
    is_json = F.coalesce(
        body.startswith("{") & body.endswith("}") & F.col("_j._corrupt_record").isNull(), F.lit(False))
    # Fields are matched in the text: the XML functions raise on malformed documents.
    tag = lambda name: F.nullif(F.regexp_extract("_text", f"<{name}[^>]*>([^<]*)</{name}>", 1), F.lit(""))
    is_xml = F.coalesce(body.rlike(r"(?s)^<.*</[A-Za-z_][\w.\-]*>$"), F.lit(False))
    return d.select(
        *df.columns,
        F.coalesce(F.when(is_json, F.col("_j.kind")).when(is_xml, tag("kind")), F.lit("unknown")).alias("kind"),
        F.when(is_json, F.col("_j.timestamp")).when(is_xml, tag("timestamp")).alias("timestamp"),
        *[F.when(is_json, F.col(f"_j.{n}")).alias(n) for n in ("transaction", "subscription", "dispute")],
        F.lit(True).alias("dev_mode"),
    )


def ingress_dlq(rejected: DataFrame, provider: Column, error_type: Column, error_message: Column,
                received_at: Column) -> DataFrame:
    """Dead letters of the intake: payload, headers, error and time of receipt."""
    headers = F.col("headers") if "headers" in rejected.columns else F.create_map().cast("map<string,string>")
    values = {
        "provider": provider, "raw_payload": F.make_valid_utf8(F.col("value").cast("string")),
        "raw_headers": headers, "error_type": error_type, "error_message": error_message,
        "received_at": received_at, "retry_count": F.lit(0),
    }
    return rejected.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in INGRESS_DLQ.fields])
