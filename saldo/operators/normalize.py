"""Raw provider webhooks to the unified event schema, with ordered errors for the rejects.

Each provider function reads raw messages and returns one row per message: the unified columns plus
`errors` (empty for a valid event) and the message's own columns. A payload is parsed once, into a
declared struct; amounts stay JSON values so that text and numbers can be told apart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo import constants as C
from saldo.functions import validators as V
from saldo.schemas import DLQ, ERRORS, UNIFIED
from saldo.session import scratch

SOURCE_COLUMNS = ["value", "topic", "partition", "offset"]

STRIPE_PAYLOAD = """
    id string, type string, created double,
    data struct<object: struct<
        id: string, amount: variant, currency: string, customer: string, status: string,
        created: double, payment_method_types: array<string>,
        payment_method_details: struct<type: string, card: struct<brand: string, last4: string>>,
        failure_code: string, failure_message: string, failure_reason: string,
        last_payment_error: struct<code: string, message: string>,
        metadata: map<string, string>>>,
    _corrupt_record string"""

SQUARE_MONEY = "struct<amount: variant, currency: string>"
SQUARE_PAYLOAD = f"""
    event_id string, type string, merchant_id string, created_at string,
    data struct<type: string, id: string, object: struct<
        payment: struct<
            id: string, created_at: string, amount_money: {SQUARE_MONEY}, status: string,
            source_type: string, customer_id: string, location_id: string, order_id: string,
            reference_id: string, card_details: struct<card_brand: string, last_4: string>>,
        refund: struct<
            id: string, created_at: string, amount_money: {SQUARE_MONEY}, status: string,
            payment_id: string, location_id: string, reason: string>>>,
    _corrupt_record string"""

ADYEN_ITEM = """
    pspReference string, originalReference string, merchantAccountCode string,
    merchantReference string, amount struct<value: variant, currency: string>, eventCode string,
    success boolean, eventDate string, paymentMethod string, reason string,
    operations array<string>, additionalData map<string, string>"""
ADYEN_PAYLOAD = ADYEN_ITEM + ", live boolean, _corrupt_record string"

BRAINTREE_PAYLOAD = """
    kind string, timestamp string, dev_mode boolean,
    transaction struct<
        id: string, status: string, type: string, amount: string, currency_iso_code: variant,
        merchant_account_id: string, customer_id: string, payment_instrument_type: string,
        card_details: struct<card_type: string, last_4: string>>,
    subscription struct<id: string, status: string, plan_id: string>,
    dispute struct<id: string, status: string, reason: string, amount: string>,
    _corrupt_record string"""


def payload_text(value: Column) -> Column:
    """Payload as text, NULL when it is not valid UTF-8."""
    return F.try_validate_utf8(value.cast("string"))


def is_json_object(text: Column, parsed: Column) -> Column:
    """True for one readable JSON object; lists, numbers, cut-off and mistyped payloads are not."""
    body = F.btrim(text, F.lit(" \t\r\n"))
    shaped = body.startswith("{") & body.endswith("}")
    return F.coalesce(shaped & parsed["_corrupt_record"].isNull(), F.lit(False))


def parse_payload(raw: DataFrame, schema: str) -> DataFrame:
    """Adds the parsed struct `p` and `readable`."""
    with_text = raw.withColumn("_text", payload_text(F.col("value")))
    parsed = with_text.withColumn("p", F.from_json("_text", schema))
    return parsed.withColumn("readable", is_json_object(F.col("_text"), F.col("p"))).drop("_text")


UNREADABLE = ("payload", "INVALID_JSON", "Payload is not a readable JSON object")


def _errors(*paths: tuple) -> Column:
    """Error list of the first path whose condition holds; an unreadable payload comes before all."""
    unreadable = V.collect_errors(V.error(F.lit(True), *UNREADABLE))
    chosen = F.when(~F.col("readable"), unreadable)
    for condition, entries in paths:
        chosen = chosen.when(condition, V.collect_errors(*entries))
    return chosen.otherwise(F.array().cast(ERRORS))


def _required(value: Column, field: str, code: str, what: str) -> Column:
    return V.error(~F.coalesce(V.present(value), F.lit(False)), field, code, f"{what} is required")


def _all_null(*cols: Column) -> Column:
    empty = F.lit(True)
    for c in cols:
        empty = empty & c.isNull()
    return empty


def _amount_error(check: Column, whole: Column, field: str, coded: bool = True) -> Column:
    code = V.amount_error_code(whole) if coded else F.lit("INVALID_AMOUNT")
    return V.error(~check["is_valid"], field, code, check["message"])


def _currency_error(check: Column, field: str) -> Column:
    return V.error(~check["is_valid"], field, "INVALID_CURRENCY", check["message"])


def _json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _unified(df: DataFrame, provider: str, errors: Column, values: dict[str, Column], now: Column) -> DataFrame:
    """Assembles the unified columns; `dlq_id` is the provider-side id a rejected row is filed under."""
    values = {
        **values, "provider": F.lit(provider), "processed_at": now, "schema_version": F.lit(1),
        "event_id": F.concat(F.lit(f"{provider}:"), values["event_id"]),
    }
    return df.select(
        *SOURCE_COLUMNS, errors.alias("errors"), values["dlq_id"].alias("dlq_id"),
        *[values[f.name].cast(f.dataType).alias(f.name) for f in UNIFIED.fields],
    )


# --- stripe -------------------------------------------------------------------------------------

def stripe_payment_method_type(obj: Column, event_type: Column) -> Column:
    """First listed type, else the details' type (NULL when untyped), else refund or card."""
    types, details = obj["payment_method_types"], obj["payment_method_details"]
    return (
        F.when(F.size(types) > 0, F.get(types, F.lit(0)))
        .when(~_all_null(details["type"], details["card"]), details["type"])
        .when(event_type.startswith("refund."), "refund")
        .otherwise("card")
    )


def stripe_card(obj: Column) -> tuple[Column, Column]:
    card = obj["payment_method_details"]["card"]
    return card["brand"], card["last4"]


def stripe_status(obj: Column, event_type: Column) -> Column:
    """Own status, else the first hint found in the event type."""
    hints = [F.when(event_type.contains(h), h) for h in C.STRIPE_STATUS_HINTS]
    return F.coalesce(F.when(V.present(obj["status"]), obj["status"]), *hints, F.lit("unknown"))


def stripe_failure(obj: Column) -> tuple[Column, Column]:
    """(code, message): direct fields, else the last payment error, else the refund's reason."""
    clean = V.normalize_null_string
    direct = F.coalesce(V.present(obj["failure_code"]), F.lit(False)) | F.coalesce(
        V.present(obj["failure_message"]), F.lit(False))
    last = obj["last_payment_error"]
    has_last = ~_all_null(last["code"], last["message"])
    code = (
        F.when(direct, clean(obj["failure_code"])).when(has_last, clean(last["code"]))
        .otherwise(clean(obj["failure_reason"]))
    )
    message = F.when(direct, clean(obj["failure_message"])).when(has_last, clean(last["message"]))
    return code, message


def stripe_to_unified(raw: DataFrame, now: Column) -> DataFrame:
    obj, p = F.col("p.data.object"), F.col("p")
    fields = ["id", "amount", "currency", "customer", "status", "created", "payment_method_types",
              "payment_method_details", "failure_code", "metadata", "last_payment_error"]
    df = (
        parse_payload(raw, STRIPE_PAYLOAD)
        .withColumn("whole", V.variant_integer(obj["amount"]))
        .withColumn("amount", V.validate_amount(F.col("whole"), _given(obj["amount"])))
        .withColumn("money", V.validate_currency(obj["currency"]))
    )
    created = F.coalesce(F.nullif(obj["created"], F.lit(0.0)), F.nullif(p["created"], F.lit(0.0)))
    head = [
        _required(p["id"], "id", "MISSING_EVENT_ID", "Event ID"),
        _required(p["type"], "type", "MISSING_EVENT_TYPE", "Event type"),
    ]
    no_object = _all_null(*[obj[f] for f in fields])
    errors = _errors(
        (no_object, [*head, V.error(F.lit(True), "data.object", "MISSING_DATA_OBJECT", "Data object is required")]),
        (F.lit(True), [
            *head,
            _required(obj["id"], "data.object.id", "MISSING_OBJECT_ID", "Object ID"),
            _amount_error(F.col("amount"), F.col("whole"), "data.object.amount"),
            _currency_error(F.col("money"), "data.object.currency"),
            V.error(created.isNull(), "created", "MISSING_TIMESTAMP", "Timestamp is required"),
        ]),
    )
    brand, last4 = stripe_card(obj)
    code, message = stripe_failure(obj)
    metadata = obj["metadata"]
    return _unified(df, "stripe", errors, {
        "dlq_id": p["id"], "event_id": p["id"], "provider_event_id": p["id"],
        "event_type": V.normalize_event_type("stripe", p["type"]),
        "merchant_id": V.normalize_null_string(F.try_element_at(metadata, F.lit("merchant_id"))),
        "customer_id": V.normalize_null_string(obj["customer"]),
        "amount_cents": F.col("amount.value"), "currency": F.col("money.value"),
        "payment_method_type": stripe_payment_method_type(obj, p["type"]),
        "card_brand": brand, "card_last_four": last4,
        "status": stripe_status(obj, p["type"]),
        "failure_code": code, "failure_message": message,
        "metadata": F.coalesce(F.to_json(metadata), F.lit("{}")),
        "provider_created_at": F.timestamp_micros((created * 1_000_000).cast("bigint")),
    }, now)


def _given(v: Column) -> Column:
    """A JSON value is present and not null."""
    return v.isNotNull() & ~F.is_variant_null(v)


# --- square -------------------------------------------------------------------------------------

def square_source_type(c: Column) -> Column:
    known = F.when(V.present(c), F.coalesce(V.lookup(C.SQUARE_SOURCE_TYPES, F.upper(c)), F.lower(c)))
    return F.coalesce(known, F.lit("card"))


def square_status(c: Column) -> Column:
    text = F.coalesce(c, F.lit(""))
    return F.coalesce(V.lookup(C.SQUARE_STATUSES, F.upper(text)), F.lower(text))


def square_refund_status(c: Column) -> Column:
    text = F.coalesce(c, F.lit(""))
    return F.coalesce(V.lookup(C.SQUARE_REFUND_STATUSES, F.upper(text)), F.lower(text))


def square_payment(pay: Column) -> dict[str, Column]:
    """Unified fields only payments carry."""
    card = pay["card_details"]
    return {
        "customer_id": V.normalize_null_string(pay["customer_id"]),
        "payment_method_type": square_source_type(pay["source_type"]),
        "card_brand": V.normalize_null_string(card["card_brand"]),
        "card_last_four": V.normalize_null_string(card["last_4"]),
        "status": square_status(pay["status"]),
        "metadata": _json(pay["location_id"], pay["order_id"], pay["reference_id"]),
    }


def square_refund(refund: Column) -> dict[str, Column]:
    """Unified fields of refunds: no customer and no card."""
    nothing = F.lit(None).cast("string")
    return {
        "customer_id": nothing, "payment_method_type": F.lit("refund"),
        "card_brand": nothing, "card_last_four": nothing,
        "status": square_refund_status(refund["status"]),
        "metadata": _json(refund["location_id"], refund["payment_id"], refund["reason"]),
    }


def square_to_unified(raw: DataFrame, now: Column) -> DataFrame:
    p, data = F.col("p"), F.col("p.data")
    pay, refund = F.col("p.data.object.payment"), F.col("p.data.object.refund")
    kind = F.coalesce(data["type"], F.lit(""))
    no_pay = _all_null(pay["id"], pay["amount_money"], pay["status"], pay["created_at"], pay["location_id"])
    no_refund = _all_null(
        refund["id"], refund["amount_money"], refund["status"], refund["created_at"], refund["location_id"])
    # What the message describes: its declared type, else whichever object it holds.
    form = (
        F.when(kind == "payment", F.when(no_pay, "no_payment").otherwise("payment"))
        .when(kind == "refund", F.when(no_refund, "no_refund").otherwise("refund"))
        .when(~no_pay, "payment").when(~no_refund, "refund").otherwise("unknown")
    )
    df = parse_payload(raw, SQUARE_PAYLOAD).withColumn("form", form)
    is_refund = F.col("form") == "refund"
    df = df.withColumn("cash", F.when(is_refund, refund["amount_money"]).otherwise(pay["amount_money"]))
    df = (
        df.withColumn("whole", V.variant_integer(F.col("cash.amount")))
        .withColumn("amount", V.validate_amount(F.col("whole"), _given(F.col("cash.amount"))))
        .withColumn("money", V.validate_currency(F.col("cash.currency")))
    )
    head = [
        _required(p["event_id"], "event_id", "MISSING_EVENT_ID", "Event ID"),
        _required(p["type"], "type", "MISSING_EVENT_TYPE", "Event type"),
    ]
    gone = lambda field, code, text: [*head, V.error(F.lit(True), field, code, text)]
    checks = lambda name, body, what, coded: [
        *head,
        _required(body["id"], f"{name}.id", "MISSING_OBJECT_ID", f"{what} ID"),
        _amount_error(F.col("amount"), F.col("whole"), f"{name}.amount_money.amount", coded),
        _currency_error(F.col("money"), f"{name}.amount_money.currency"),
    ]
    errors = _errors(
        (_all_null(data["type"], data["id"], data["object"]), gone("data", "MISSING_DATA", "Data object is required")),
        (F.col("form") == "no_payment", gone("data.object.payment", "MISSING_PAYMENT", "Payment object is required")),
        (F.col("form") == "no_refund", gone("data.object.refund", "MISSING_REFUND", "Refund object is required")),
        (F.col("form") == "unknown", gone(
            "data.type", "UNKNOWN_OBJECT_TYPE", F.concat(F.lit("Unknown object type: "), kind))),
        (is_refund, checks("refund", refund, "Refund", False)),
        (F.lit(True), checks("payment", pay, "Payment", True)),
    )
    one, other = square_payment(pay), square_refund(refund)
    both = {name: F.when(is_refund, other[name]).otherwise(one[name]) for name in one}
    created = F.when(is_refund, refund["created_at"]).otherwise(pay["created_at"])
    nothing = F.lit(None)
    return _unified(df, "square", errors, {
        **both,
        "dlq_id": p["event_id"], "event_id": p["event_id"], "provider_event_id": p["event_id"],
        "event_type": V.normalize_event_type("square", p["type"]),
        "merchant_id": V.normalize_null_string(p["merchant_id"]),
        "amount_cents": F.col("amount.value"), "currency": F.col("money.value"),
        "failure_code": nothing, "failure_message": nothing,
        "provider_created_at": V.parse_iso_or(F.coalesce(F.nullif(created, F.lit("")), p["created_at"]), now),
    }, now)


# --- adyen --------------------------------------------------------------------------------------

def adyen_status(code: Column, success: Column) -> Column:
    return F.when(~success, "failed").otherwise(
        F.coalesce(V.lookup(C.ADYEN_STATUSES, code), F.lower(code)))


def adyen_payment_method(c: Column) -> Column:
    return F.when(V.present(c), F.coalesce(V.lookup(C.ADYEN_METHODS, F.lower(c)), F.lower(c)))


def adyen_card_brand(extra: Column, payment_method: Column) -> Column:
    """The card BIN when there is one, else the brand of the payment method."""
    bin_ = F.try_element_at(extra, F.lit("cardBin"))
    return F.coalesce(F.when(V.present(bin_), bin_), V.lookup(C.ADYEN_BRANDS, F.lower(payment_method)))


def adyen_last_four(extra: Column) -> Column:
    return F.try_element_at(extra, F.lit("cardSummary"))


def adyen_failure_code(reason: Column) -> Column:
    text = F.lower(reason)
    hits = [F.when(text.contains(word), code) for words, code in C.ADYEN_REFUSALS for word in words]
    return F.coalesce(*hits, F.lit("unknown"))


def adyen_to_unified(raw: DataFrame, now: Column) -> DataFrame:
    p = F.col("p")
    cash = p["amount"]
    df = (
        parse_payload(raw, ADYEN_PAYLOAD)
        .withColumn("whole", V.variant_integer(cash["value"]))
        .withColumn("amount", V.validate_amount(F.col("whole"), _given(cash["value"])))
        .withColumn("money", V.validate_currency(cash["currency"]))
    )
    errors = _errors((F.lit(True), [
        _required(p["pspReference"], "pspReference", "MISSING_PSP_REFERENCE", "PSP Reference"),
        _required(p["eventCode"], "eventCode", "MISSING_EVENT_CODE", "Event code"),
        _required(p["merchantAccountCode"], "merchantAccountCode", "MISSING_MERCHANT_ACCOUNT", "Merchant account"),
        _amount_error(F.col("amount"), F.col("whole"), "amount.value"),
        _currency_error(F.col("money"), "amount.currency"),
    ]))
    success = F.coalesce(p["success"], F.lit(False))
    refused = ~success & F.coalesce(V.present(p["reason"]), F.lit(False))
    psp, code = p["pspReference"], p["eventCode"]
    both_ids = F.concat(psp, F.lit("_"), code)
    return _unified(df, "adyen", errors, {
        "dlq_id": F.when(V.present(psp) & V.present(code), both_ids).otherwise(psp),
        "event_id": both_ids, "provider_event_id": psp,
        "event_type": V.normalize_event_type("adyen", code),
        "merchant_id": p["merchantAccountCode"], "customer_id": F.lit(None),
        "amount_cents": F.col("amount.value"), "currency": F.col("money.value"),
        "payment_method_type": adyen_payment_method(p["paymentMethod"]),
        "card_brand": adyen_card_brand(p["additionalData"], p["paymentMethod"]),
        "card_last_four": adyen_last_four(p["additionalData"]),
        "status": adyen_status(code, success),
        "failure_code": F.when(refused, adyen_failure_code(p["reason"])),
        "failure_message": F.when(refused, p["reason"]),
        "metadata": _json(
            p["originalReference"].alias("original_reference"),
            p["merchantReference"].alias("merchant_reference"),
            p["operations"].alias("operations"),
            F.coalesce(p["live"], F.lit(False)).alias("live")),
        "provider_created_at": V.parse_iso_or(p["eventDate"], now),
    }, now)


# --- braintree ----------------------------------------------------------------------------------

def braintree_status(kind: Column, txn_status: Column) -> Column:
    """By notification kind, else by transaction status, else the kind in words."""
    folded = F.lower(txn_status)
    by_txn = F.when(V.present(txn_status), F.coalesce(V.lookup(C.BRAINTREE_TXN_STATUSES, folded), folded))
    words = F.lower(F.replace(kind, F.lit("_"), F.lit(" ")))
    return F.coalesce(V.lookup(C.BRAINTREE_KIND_STATUSES, kind), by_txn, words, F.lit("unknown"))


def braintree_payment_method(c: Column) -> Column:
    return F.when(V.present(c), F.coalesce(V.lookup(C.BRAINTREE_METHODS, F.lower(c)), F.lower(c)))


def braintree_card_brand(c: Column) -> Column:
    return F.when(V.present(c), F.coalesce(V.lookup(C.BRAINTREE_BRANDS, F.lower(c)), F.lower(c)))


def decimal_text_to_cents(text: Column) -> Column:
    """Cents of a decimal text, fractions of a cent cut off; NULL when unreadable."""
    exact = F.trim(text).try_cast("decimal(36,16)") * 100
    return F.when(exact < 0, F.ceil(exact)).otherwise(F.floor(exact)).cast("decimal(38,0)")


def braintree_to_unified(raw: DataFrame, now: Column) -> DataFrame:
    p, txn = F.col("p"), F.col("p.transaction")
    has_amount = F.coalesce(V.present(txn["amount"]), F.lit(False))
    code = txn["currency_iso_code"]
    # An absent code means USD; an explicit JSON null stays missing.
    currency = F.when(code.isNull(), "USD").otherwise(F.try_variant_get(code, "$", "string"))
    df = (
        parse_payload(raw, BRAINTREE_PAYLOAD)
        .withColumn("whole", F.when(has_amount, decimal_text_to_cents(txn["amount"])).otherwise(F.lit(0)))
        .withColumn("amount", V.validate_amount(F.col("whole"), F.lit(True)))
        .withColumn("money", V.validate_currency(currency))
    )
    kind = p["kind"]
    has_txn = F.coalesce(V.present(txn["id"]), F.lit(False))
    message = F.when(
        F.col("whole").isNull(), F.concat(F.lit("Invalid amount format: "), txn["amount"])
    ).otherwise(F.col("amount.message"))
    errors = _errors((F.lit(True), [
        _required(kind, "kind", "MISSING_KIND", "Notification kind"),
        V.error(F.coalesce(kind.startswith("transaction_"), F.lit(False)) & ~has_txn, "transaction.id",
                "MISSING_TRANSACTION_ID", "Transaction ID is required for transaction notifications"),
        V.error(~F.col("amount.is_valid"), "transaction.amount", "INVALID_AMOUNT", message),
        _currency_error(F.col("money"), "transaction.currency_iso_code"),
    ]))
    suffix = F.when(has_txn, txn["id"]).otherwise(F.coalesce(p["timestamp"], F.lit("None")))
    event_id = F.concat(kind, F.lit("_"), suffix)
    status = braintree_status(kind, txn["status"])
    failed = status == "failed"
    return _unified(df, "braintree", errors, {
        # An unreadable payload has no id at all.
        "dlq_id": F.when(F.col("readable"), F.concat(F.coalesce(kind, F.lit("unknown")), F.lit("_"), suffix)),
        "event_id": event_id,
        "provider_event_id": F.when(has_txn, txn["id"]).otherwise(event_id),
        "event_type": V.normalize_event_type("braintree", kind),
        "merchant_id": txn["merchant_account_id"], "customer_id": txn["customer_id"],
        "amount_cents": F.col("amount.value"), "currency": F.col("money.value"),
        "payment_method_type": braintree_payment_method(txn["payment_instrument_type"]),
        "card_brand": braintree_card_brand(txn["card_details"]["card_type"]),
        "card_last_four": txn["card_details"]["last_4"],
        "status": status,
        "failure_code": F.when(failed, F.coalesce(txn["status"], F.lit("unknown"))),
        "failure_message": F.when(failed, F.concat(
            F.lit("Transaction "), F.coalesce(txn["status"], F.lit("failed")))),
        "metadata": _json(
            kind.alias("kind"), txn["type"].alias("transaction_type"),
            p["subscription"].alias("subscription"), p["dispute"].alias("dispute"),
            F.coalesce(p["dev_mode"], F.lit(False)).alias("dev_mode")),
        "provider_created_at": V.parse_iso_or(p["timestamp"], now),
    }, now)


# --- dispatch -----------------------------------------------------------------------------------

# A topic belongs to the first provider whose name it contains.
PROVIDER_FUNCTIONS = {
    "stripe": stripe_to_unified,
    "square": square_to_unified,
    "adyen": adyen_to_unified,
    "braintree": braintree_to_unified,
}


def topic_provider(topic: Column) -> Column:
    return F.coalesce(*[F.when(topic.contains(p), p) for p in PROVIDER_FUNCTIONS])


def judge(raw: DataFrame, now: Column | None = None) -> DataFrame:
    """Every raw message of a known provider with its unified columns and errors. No shuffle.

    The provider filters are on `topic` alone: raw data stored partitioned by topic is read once in
    total, each branch reading its own folders.
    """
    now = F.current_timestamp() if now is None else now
    parts = [
        to_unified(raw.filter(topic_provider(F.col("topic")) == provider), now)
        for provider, to_unified in PROVIDER_FUNCTIONS.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def valid_events(judged: DataFrame) -> DataFrame:
    return judged.filter(F.size("errors") == 0).select(*UNIFIED.names)


def dlq_records(judged: DataFrame, now: Column | None = None) -> DataFrame:
    """Dead-letter rows of the rejected messages; bytes that are not UTF-8 are replaced in the payload."""
    present = V.present(F.col("dlq_id"))
    values = {
        "event_id": F.when(present, F.concat("provider", F.lit(":"), "dlq_id")),
        "provider": F.col("provider"), "provider_event_id": F.col("dlq_id"),
        "original_payload": F.make_valid_utf8(F.col("value").cast("string")),
        "validation_errors": F.col("errors"),
        "failure_reason": F.coalesce(V.primary_error_code(F.col("errors")), F.lit("UNKNOWN_ERROR")),
        "source_topic": F.col("topic"), "kafka_partition": F.col("partition"),
        "kafka_offset": F.col("offset"),
        "quarantined_at": F.col("processed_at") if now is None else now,
        "schema_version": F.lit(1),
    }
    return judged.filter(F.size("errors") > 0).select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in DLQ.fields])


@dataclass(frozen=True)
class Normalized:
    valid: DataFrame
    dlq: DataFrame


def normalize(raw: DataFrame, now: Column | None = None, path: str | None = None, cut_by_topic: bool = True) -> Normalized:
    """Accepted unified events and dead-letter rows of a batch.

    Raw data not stored by topic (`cut_by_topic=False`) is written so first: else each of the four providers
    would read all of it.

    The judged rows are written once, split into two folders, and each result reads its own. Filtering
    the unwritten rows twice would parse every payload twice, and the optimizer would copy the parsing
    into both filters.
    """
    spark = raw.sparkSession
    path = path or scratch(spark, "normalized")
    if not cut_by_topic:
        raw.write.partitionBy("topic").parquet(landing := scratch(spark, "by-topic"))
        raw = spark.read.schema(raw.schema).parquet(landing)
    judged = judge(raw, now).withColumn("accepted", F.size("errors") == 0)
    judged.write.partitionBy("accepted").parquet(path)
    kept = spark.read.schema(judged.schema).parquet(path)
    return Normalized(valid_events(kept.filter("accepted")), dlq_records(kept.filter("NOT accepted")))
