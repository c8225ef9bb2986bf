"""One Spark query per operator. Every query reads the driver's tables in full."""

from __future__ import annotations

import contextlib
import datetime as dt
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldo import constants as C
from saldo import schemas as Z
from saldo.functions import macros as M
from saldo.functions import scoring as R
from saldo.functions import validators as V
from saldo.operators import drift as DR
from saldo.operators import enrich as E
from saldo.operators import gateway as G
from saldo.operators import incremental as H
from saldo.operators import ml as L
from saldo.operators import normalize as N
from saldo.operators import quality as Q
from saldo.operators import split as P
from saldo.operators import tables as U
from saldo.plans import analytics as A
from saldo.plans import batch as B
from saldo.plans import features as X
from saldo.plans import intermediate as I
from saldo.plans import marts as K
from saldo.plans.staging import stg_payment_events
from saldo.session import materialize, scratch
from saldo.sources import bronze as S
from saldo.sources import sinks as O
from saldo.sources import streams as J
from saldo.streaming import jobs as D
from workload import adapters as W
from workload import streams as WS
from workload.content import CONTENT, LATER

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def plain(df: DataFrame) -> DataFrame:
    """Types both engines print alike: text for dates, times and nested values, double for decimals."""
    out = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(t, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.ArrayType, T.StructType, T.MapType)):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
        return fn
    return register


def at(text: str = W.AS_OF):
    return F.lit(text).cast("timestamp")


def staged(spark, sf) -> DataFrame:
    return stg_payment_events(W.bronze(spark, sf))


def customers(spark, sf) -> DataFrame:
    return I.int_customer_metrics(staged(spark, sf))


def merchants(spark, sf) -> DataFrame:
    return I.int_merchant_metrics(staged(spark, sf))


def halves(df: DataFrame, ts: str = "ingested_at", cut: str = "2024-01-20 00:00:00"):
    """A table cut in two by time, for incremental builds."""
    edge = F.lit(cut).cast("timestamp")
    return df.filter(F.col(ts) < edge), df.filter(F.col(ts) >= edge)


AUDIT = ["dw_created_at", "dw_updated_at", "valid_from", "valid_to"]


# --- sources and sinks ------------------------------------------------------------------------------

@query("s01_read_unloaded")
def _(spark, sf):
    return S.read_unloaded(W.row_store(spark, sf)).select("event_id", "ingested_at", "amount_cents")


@query("s02_read_by_date")
def _(spark, sf):
    return S.read_by_date(W.row_store(spark, sf), dt.date(2024, 1, 15)).select("event_id", "ingested_at")


@query("s03_mark_loaded")
def _(spark, sf):
    store = W.row_store(spark, sf)
    ids = store.filter(F.col("id") % 5 == 0).select("event_id")
    return S.mark_loaded(store, ids, W.AS_OF).select("event_id", "loaded_to_iceberg", "loaded_at")


@query("s04_event_count")
def _(spark, sf):
    store = W.row_store(spark, sf)
    parts = [
        S.event_count(store, flag).select(F.lit(name).alias("state"), "event_count")
        for name, flag in (("all", None), ("loaded", True), ("unloaded", False))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("s05_conform")
def _(spark, sf):
    return S.conform(W.row_store(spark, sf), Z.BRONZE)


@query("s06_ingest_events")
def _(spark, sf):
    """Written to the bronze table and read back."""
    path = scratch(spark, "bronze")
    S.append_bronze(S.ingest_events(W.row_store(spark, sf)), path)
    return spark.read.parquet(path).select(*Z.BRONZE.names)


def quarantine_store(spark, sf) -> DataFrame:
    """The row store's quarantine: dead letters plus review columns, a fifth already reviewed."""
    dlq = N.normalize(W.raw_messages(spark, sf), at()).dlq
    done = F.col("kafka_offset") % 5 == 0
    return dlq.select(
        "*", done.alias("reviewed"), F.when(done, at()).alias("reviewed_at"),
        F.when(done, "ops").alias("reviewed_by"), F.when(done, "discarded").alias("resolution"),
    )


@query("s07_ingest_quarantine")
def _(spark, sf):
    return S.ingest_quarantine(quarantine_store(spark, sf)).select(
        "event_id", "provider", "failure_reason", "source_topic", "kafka_partition", "kafka_offset",
        "reviewed", "quarantined_at")


@query("s08_ingest_profile")
def _(spark, sf):
    return S.ingest_profile(W.bronze(spark, sf))


@query("s08_failure_profile")
def _(spark, sf):
    return S.failure_profile(S.ingest_quarantine(quarantine_store(spark, sf)))


STREAM_VIEW = ["event_id", "customer_id", "amount", "currency", "status", "created_at"]


def _over_kinds(make) -> DataFrame:
    result = None
    for kind in Z.STREAMS:
        part = make(kind)
        result = part if result is None else result.unionByName(part)
    return result


@query("s09_typed_streams")
def _(spark, sf):
    """All four streams, read from JSON files."""
    def one(kind):
        stream = J.typed_stream(spark, kind, json_path=WS.json_files(spark, sf, kind))
        return WS.collect_stream(stream.select(F.lit(kind).alias("kind"), *STREAM_VIEW), f"typed-{kind}")
    return _over_kinds(one)


@query("s10_valid_and_quarantine_sinks")
def _(spark, sf):
    """Valid and quarantine tables of the charge stream as the streaming job wrote them."""
    path = scratch(spark, "split")
    stream = WS.typed_table_stream(spark, sf, "charges")
    WS.finish(D.run_split_stream(stream, "charges", path, scratch(spark, "checkpoint"), at(), **WS.ONCE))
    ok = O.read_batches(spark, f"{path}/charges/valid", Z.valid_schema("charges"))
    bad = O.read_batches(spark, f"{path}/charges/quarantine", Z.quarantine_schema("charges"))
    return ok.unionByName(bad, allowMissingColumns=True).select(
        "event_id", "amount", "currency", "validation_flag", "rejection_reason", "quarantine_timestamp")


@query("s11_charges_passthrough")
def _(spark, sf):
    path = scratch(spark, "charges")
    stream = WS.typed_table_stream(spark, sf, "charges")
    WS.finish(O.passthrough(stream, path, scratch(spark, "checkpoint"), **WS.ONCE))
    return spark.read.schema(Z.CHARGES).parquet(path).select(*STREAM_VIEW)


@query("s12_raw_topics")
def _(spark, sf):
    raw = W.raw_messages(spark, sf)
    return raw.filter(F.col("topic").isin(J.raw_topics())).groupBy("topic").agg(F.count("*").alias("messages"))


@query("s13_normalized_and_dlq_messages")
def _(spark, sf):
    out = N.normalize(W.raw_messages(spark, sf), at())
    path = scratch(spark, "topics")
    O.write_normalized(out.valid, path)
    O.write_dlq(out.dlq, path)
    schema = "topic string, key string, value string"
    both = [O.read_batches(spark, f"{path}/{t}", schema) for t in (C.NORMALIZED_TOPIC, C.DLQ_TOPIC)]
    return both[0].unionByName(both[1]).select(
        "topic", "key", F.get_json_object("value", "$.event_id").alias("event_id"))


@query("s14_export_features")
def _(spark, sf):
    """Both feature tables, registered, exported and read back."""
    results = []
    for entity, feats in (("customer", X.feat_customer(customers(spark, sf), W.AS_OF)),
                          ("merchant", X.feat_merchant(merchants(spark, sf), W.AS_OF))):
        view, path = f"feat_{entity}_features", scratch(spark, f"export-{entity}")
        feats.createOrReplaceTempView(view)
        status = O.export_features(spark, view, entity, path)
        spark.catalog.dropTempView(view)
        stored = spark.read.parquet(path)
        results.append(stored.groupBy().agg(
            F.lit(entity).alias("entity"), F.lit(status["status"]).alias("status"),
            F.count(F.lit(1)).alias("row_count"), F.lit(len(stored.columns)).cast("bigint").alias("column_count")))
    return results[0].unionByName(results[1])


def _changed(df: DataFrame) -> DataFrame:
    """Later versions of a tenth of the rows."""
    return df.filter(F.pmod(F.crc32("event_id"), F.lit(10)) == 0)


@query("s15_upsert")
def _(spark, sf):
    """First half, then the second half plus changed rows of the first, twice over."""
    old, new = halves(W.bronze(spark, sf))
    late = F.col("ingested_at") + F.expr("INTERVAL 100 DAYS")
    change = old.filter(F.col("amount_cents") % 10 == 0).withColumn("status", F.lit("revised")) \
        .withColumn("ingested_at", late)
    stale = change.withColumn("status", F.lit("stale")).withColumn("ingested_at", F.col("ingested_at") - F.expr("INTERVAL 1 DAY"))
    batch = new.unionByName(change).unionByName(stale)
    once = U.upsert(old, batch, ["event_id"])
    return U.upsert(once, batch, ["event_id"]).select("event_id", "status", "amount_cents", "ingested_at")


@query("s15_upsert_partitions")
def _(spark, sf):
    """The same into a table partitioned by day, rewriting only touched days."""
    facts = W.bronze(spark, sf).withColumn("event_date", F.to_date("provider_created_at"))
    old, _rest = halves(facts, "provider_created_at")
    path = scratch(spark, "facts")
    old.write.partitionBy("event_date").parquet(path)
    change = facts.filter(F.col("provider_created_at") >= F.lit("2024-01-19").cast("timestamp")) \
        .withColumn("status", F.lit("revised"))
    U.upsert_partitions(spark, path, change, ["event_id"], "event_date")
    return spark.read.parquet(path).select("event_id", "event_date", "status")


@query("s16_upsert_enrichment")
def _(spark, sf):
    old, new = halves(W.bronze(spark, sf))
    again = old.filter(F.col("amount_cents") % 4 == 0).withColumn("fraud_score", F.lit(0.5)) \
        .withColumn("risk_level", F.lit(None).cast("string")).withColumn("amount_cents", F.lit(-1).cast("bigint")) \
        .withColumn("ingested_at", at())
    return U.upsert_enrichment(old, new.unionByName(again)).select(
        "event_id", "amount_cents", "status", "fraud_score", "risk_level", "ingested_at")


@query("s17_upsert_quarantine")
def _(spark, sf):
    """Dead letters stored, then a quarter of them filed again with another reason."""
    dlq = D.dedupe_dlq(N.normalize(W.raw_messages(spark, sf), at()).dlq).withColumn("updated_at", at())
    again = dlq.filter(F.col("kafka_offset") % 4 == 0).withColumn("failure_reason", F.lit("AGAIN")) \
        .withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 1 DAY"))
    return U.upsert_quarantine(dlq, again).select("dlq_key", "event_id", "failure_reason", "kafka_offset", "updated_at")


@query("s18_snapshot_as_of")
def _(spark, sf):
    """Two versions of the merchant metrics; the first is read back."""
    path = scratch(spark, "versions")
    stg = staged(spark, sf)
    old, _new = halves(stg)
    first = I.int_merchant_metrics(old).select("merchant_id", "total_transactions", "total_revenue_cents")
    second = I.int_merchant_metrics(stg).select("merchant_id", "total_transactions", "total_revenue_cents")
    U.write_version(first, path, "2024-01-20T00")
    U.write_version(second, path, "2024-02-01T00")
    return U.snapshot_as_of(spark, path, T.StructType(first.schema.fields), "2024-01-31T00")


# --- normalization ------------------------------------------------------------------------------------

def judged_of(spark, sf, provider: str) -> DataFrame:
    raw = W.raw_messages(spark, sf).filter(F.col("topic").contains(provider))
    return materialize(N.PROVIDER_FUNCTIONS[provider](raw, at()), f"judged-{provider}")


def valid_of(spark, sf, provider: str) -> DataFrame:
    return N.valid_events(judged_of(spark, sf, provider))


def codes(errors) -> F.Column:
    return F.array_join(V.error_codes(errors), ",")


@query("n01_parse_payload")
def _(spark, sf):
    raw = W.raw_messages(spark, sf)
    parsed = N.parse_payload(raw, N.STRIPE_PAYLOAD.replace("variant", "string"))
    return parsed.select("offset", "topic", "readable").filter(F.col("topic").contains("stripe")).select("offset", "readable")


@query("n02_null_spellings")
def _(spark, sf):
    w = W.webhook_parameters(spark, sf)
    return w.select("n", V.normalize_null_string(F.col("merchant")).alias("merchant"),
                    V.normalize_null_string(F.col("customer")).alias("customer"))


@query("n03_null_columns")
def _(spark, sf):
    w = W.webhook_parameters(spark, sf).select("n", "k", "merchant", "customer", "txn_status", "amount")
    return w.select(*[V.normalize_null(f.name, f.dataType) for f in w.schema.fields])


@query("n04_validate_currency")
def _(spark, sf):
    w = W.webhook_parameters(spark, sf)
    text = F.when(F.col("n") % 41 == 0, None).when(F.col("n") % 43 == 0, " ").when(F.col("n") % 47 == 0, "EURO") \
        .otherwise(F.col("currency"))
    return w.select("n", V.validate_currency(text).alias("c")).select("n", "c.*")


def _amount_json(n, amount):
    """Amounts as JSON values: number, text, fraction, fraction as text, null, word."""
    text = amount.cast("string")
    return (
        F.when(n % 6 == 0, text).when(n % 6 == 1, F.concat(F.lit('"'), text, F.lit('"')))
        .when(n % 6 == 2, F.concat(text, F.lit(".75"))).when(n % 6 == 3, F.concat(F.lit('"'), text, F.lit('.75"')))
        .when(n % 6 == 4, F.lit("null")).otherwise(F.lit('"ten"')))


@query("n05_validate_amount")
def _(spark, sf):
    w = W.webhook_parameters(spark, sf)
    v = F.parse_json(_amount_json(F.col("n"), F.col("amount")))
    checked = w.select("n", v.alias("v")).select(
        "n", V.validate_amount(V.variant_integer(F.col("v")), ~F.is_variant_null("v")).alias("a"))
    return checked.select("n", "a.*")


@query("n06_validate_refund_amount")
def _(spark, sf):
    w = W.webhook_parameters(spark, sf)
    return w.select("n", V.validate_refund_amount(F.col("amount"), high=5000).alias("a")).select("n", "a.*")


@query("n07_collect_errors")
def _(spark, sf):
    judged = materialize(N.judge(W.raw_messages(spark, sf), at()), "judged")
    return judged.select("offset", codes(F.col("errors")).alias("codes"),
                         V.primary_error_code(F.col("errors")).alias("first_code"))


@query("n08_event_types")
def _(spark, sf):
    w = W.webhook_parameters(spark, sf)
    kinds = [F.when(F.col("provider") == p, V.normalize_event_type(p, F.col("raw_type"))) for p in V.EVENT_TYPE_MAPS]
    return w.select("n", "raw_type", F.coalesce(*kinds).alias("event_type"))


UNIFIED_VIEW = [c for c in Z.UNIFIED.names if c not in ("processed_at", "schema_version")]


def _provider_query(name: str, provider: str, *columns: str):
    @query(name)
    def _(spark, sf):
        return valid_of(spark, sf, provider).select("event_id", *columns)


for _name, _p, _cols in (
    ("n09_stripe_to_unified", "stripe", [c for c in UNIFIED_VIEW if c != "event_id"]),
    ("n10_stripe_payment_method", "stripe", ["payment_method_type"]),
    ("n11_stripe_card", "stripe", ["card_brand", "card_last_four"]),
    ("n12_stripe_status", "stripe", ["status"]),
    ("n13_stripe_failure", "stripe", ["failure_code", "failure_message"]),
    ("n14_square_to_unified", "square", [c for c in UNIFIED_VIEW if c != "event_id"]),
    ("n17_adyen_to_unified", "adyen", [c for c in UNIFIED_VIEW if c != "event_id"]),
    ("n21_braintree_to_unified", "braintree", [c for c in UNIFIED_VIEW if c != "event_id"]),
):
    _provider_query(_name, _p, *_cols)


@query("n15_square_payments_and_refunds")
def _(spark, sf):
    """Payments and refunds told apart by what only refunds fix."""
    return valid_of(spark, sf, "square").select(
        "event_id", (F.col("payment_method_type") == "refund").alias("is_refund"), "status", "amount_cents", "customer_id")


@query("n16_square_lookups")
def _(spark, sf):
    w = W.webhook_parameters(spark, sf)
    return w.select("n", N.square_source_type(F.col("source_type")).alias("method"),
                    N.square_status(F.col("square_status")).alias("status"),
                    N.square_refund_status(F.col("square_status")).alias("refund_status"))


@query("n18_adyen_status")
def _(spark, sf):
    w = W.webhook_parameters(spark, sf).filter(F.col("provider") == "adyen")
    return w.select("n", N.adyen_status(F.col("raw_type"), F.col("success")).alias("status"))


@query("n19_adyen_methods")
def _(spark, sf):
    w = W.webhook_parameters(spark, sf)
    extra = F.map_filter(F.create_map(F.lit("cardBin"), F.when(F.col("k") % 2 == 0, "411111"), F.lit("cardSummary"),
                                      F.lit("1234")), lambda _, v: v.isNotNull())
    return w.select("n", N.adyen_payment_method(F.col("adyen_method")).alias("method"),
                    N.adyen_card_brand(extra, F.col("adyen_method")).alias("brand"),
                    N.adyen_last_four(extra).alias("last4"))


@query("n20_adyen_failure_code")
def _(spark, sf):
    return W.webhook_parameters(spark, sf).select("n", N.adyen_failure_code(F.col("refusal")).alias("code"))


@query("n22_braintree_status")
def _(spark, sf):
    w = W.webhook_parameters(spark, sf).filter(F.col("provider") == "braintree")
    return w.select("n", N.braintree_status(F.col("raw_type"), F.col("txn_status")).alias("status"))


@query("n23_braintree_methods")
def _(spark, sf):
    w = W.webhook_parameters(spark, sf)
    return w.select("n", N.braintree_payment_method(F.col("instrument")).alias("method"),
                    N.braintree_card_brand(F.col("bt_brand")).alias("brand"))


@query("n24_parse_iso")
def _(spark, sf):
    w = W.webhook_parameters(spark, sf)
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (F.when(F.col("n") % 5 == 0, F.concat(iso, F.lit("Z"))).when(F.col("n") % 5 == 1, F.concat(iso, F.lit("+02:00")))
            .when(F.col("n") % 5 == 2, "garbage").when(F.col("n") % 5 == 3, "").otherwise(None))
    return w.select("n", V.parse_iso_or(text, at()).alias("created"))


@query("n25_dlq_records")
def _(spark, sf):
    return N.normalize(W.raw_messages(spark, sf), at()).dlq.select(
        "event_id", "provider", "provider_event_id", codes(F.col("validation_errors")).alias("codes"),
        "failure_reason", "source_topic", "kafka_partition", "kafka_offset", "quarantined_at", "schema_version")


@query("n26_normalize")
def _(spark, sf):
    out = N.normalize(W.raw_messages(spark, sf), at())
    ok = out.valid.select("event_id", F.lit("valid").alias("outcome"), "event_type", "amount_cents")
    bad = out.dlq.select("event_id", F.lit("dlq").alias("outcome"), F.col("failure_reason").alias("event_type"),
                         F.lit(None).cast("bigint").alias("amount_cents"))
    return ok.unionByName(bad)


@query("n27_explode_adyen_batch")
def _(spark, sf):
    """Two items per request: the message itself and a refund of it. Broken requests are among them."""
    rows = W.raw_messages(spark, sf).filter(F.col("topic").contains("adyen"))
    body = F.col("value").cast("string")
    refund = F.regexp_replace(body, '"eventCode":"[A-Z_]*"', '"eventCode":"REFUND"')
    wrap = lambda item: F.concat(F.lit('{"NotificationRequestItem":'), item, F.lit("}"))
    request = F.concat(
        F.lit('{"live":'), F.when(F.col("offset") % 2 == 0, "true").otherwise("false"),
        F.lit(',"notificationItems":['), wrap(body), F.lit(","), wrap(refund), F.lit("]}"))
    items = G.explode_adyen_batch(rows.withColumn("value", request.cast("binary")))
    text = F.col("value").cast("string")
    return items.select("offset", "item_no", "key", F.get_json_object(text, "$.live").alias("live"),
                        F.get_json_object(text, "$.eventCode").alias("event_code"),
                        F.get_json_object(text, "$.amount.value").alias("amount"))


@query("n28_route_topic")
def _(spark, sf):
    w = W.webhook_parameters(spark, sf)
    routes = [F.when(F.col("provider") == p, G.route_topic(p, F.col("raw_type"))) for p in V.EVENT_TYPE_MAPS]
    return w.select("n", F.coalesce(*routes).alias("topic"))


@query("n29_check_structure")
def _(spark, sf):
    raw = W.raw_messages(spark, sf)
    result = None
    for p in V.EVENT_TYPE_MAPS:
        part = G.check_structure(raw.filter(F.col("topic").contains(p)), p).select(
            F.lit(p).alias("provider"), "offset", codes(F.col("structure_errors")).alias("codes"))
        result = part if result is None else result.unionByName(part)
    return result


@query("n30_audit_signatures")
def _(spark, sf):
    result = None
    for p in ("stripe", "square", "adyen"):
        part = G.audit_signatures(W.captured(spark, sf, p), p, W.SECRETS[p], W.AS_OF, url=W.SQUARE_URL).select(
            F.lit(p).alias("provider"), "offset", "verdict", "reason")
        result = part if result is None else result.unionByName(part)
    return result


def _bt_payloads(spark, sf) -> DataFrame:
    """Captured payloads: JSON, XML, JSON without a kind, and bytes that are neither."""
    w = W.webhook_parameters(spark, sf).filter(F.col("provider") == "braintree")
    n = F.col("n")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    xml = F.concat(F.lit("<notification><kind>"), "raw_type", F.lit('</kind><timestamp type="datetime">'), stamp,
                   F.lit("</timestamp></notification>"))
    js = F.to_json(F.struct(F.when(n % 7 != 0, F.col("raw_type")).alias("kind"), stamp.alias("timestamp"),
                            F.struct(F.concat(F.lit("txn_"), n.cast("string")).alias("id")).alias("transaction")))
    body = F.when(n % 5 == 0, xml).when(n % 11 == 0, "not a payload").otherwise(js)
    encoded = F.base64(F.encode(body, "utf-8"))
    return w.select("n", F.when(n % 13 == 0, F.lit("***")).otherwise(encoded).alias("bt_payload"))


@query("n31_decode_braintree")
def _(spark, sf):
    return G.decode_braintree(_bt_payloads(spark, sf)).select("n", "kind", "timestamp", "transaction", "dev_mode")


@query("n32_ingress_dlq")
def _(spark, sf):
    """Webhooks with a bad signature, as dead letters of the intake."""
    checked = G.audit_signatures(W.captured(spark, sf, "square"), "square", W.SECRETS["square"], url=W.SQUARE_URL)
    headers = F.create_map(F.lit("x-square-hmacsha256-signature"), F.coalesce("signature", F.lit("")))
    kept = materialize(checked.withColumn("headers", headers), "audited").filter(F.col("verdict") != "valid")
    return G.ingress_dlq(kept, F.lit("square"), F.lit("invalid_signature"), F.col("reason"), at()).select(
        "provider", "error_type", "error_message", "received_at", "retry_count",
        (F.length("raw_payload") > 0).alias("has_payload"), F.size("raw_headers").alias("header_count"))


# --- stream validation --------------------------------------------------------------------------------

def both_sides(df: DataFrame, kind: str) -> DataFrame:
    ok, bad = P.split(df, kind, at())
    return ok.unionByName(bad, allowMissingColumns=True)


SPLIT_VIEW = ["event_id", "customer_id", "amount", "currency", "status", "created_at", "validation_flag",
              "rejection_reason", "quarantine_timestamp"]

for _i, _kind in enumerate(Z.STREAMS, start=1):
    def _split_query(spark, sf, kind=_kind):
        return both_sides(W.stream_table(spark, sf, kind), kind).select(*SPLIT_VIEW)
    query(f"v{_i:02d}_split_{_kind}")(_split_query)


@query("v05_clean_amount")
def _(spark, sf):
    rows = W.stream_table(spark, sf, "subscriptions")
    return rows.select("event_id", V.clean_amount(F.col("amount")).alias("charge_amount"),
                       V.clean_amount(F.col("amount"), True).alias("plan_amount"))


@query("v06_clean_currency")
def _(spark, sf):
    return W.stream_table(spark, sf, "charges").select("event_id", V.clean_currency(F.col("currency")).alias("currency"))


@query("v07_suspicious_flag")
def _(spark, sf):
    return _over_kinds(lambda kind: W.stream_table(spark, sf, kind).select(
        F.lit(kind).alias("kind"), "event_id", P.suspicious_flag(kind).alias("flag")))


@query("v08_rejection_reason")
def _(spark, sf):
    return _over_kinds(lambda kind: W.stream_table(spark, sf, kind).select(
        F.lit(kind).alias("kind"), "event_id", P.rejection_reason(kind).alias("reason")))


@query("v09_run_split_streams")
def _(spark, sf):
    """All eight tables, written by four streaming jobs that run side by side."""
    path = scratch(spark, "splits")
    jobs = [
        D.run_split_stream(WS.typed_table_stream(spark, sf, kind), kind, path, scratch(spark, "checkpoint"), at(), **WS.ONCE)
        for kind in Z.STREAMS
    ]
    for job in jobs:
        WS.finish(job)

    def one(kind):
        ok = O.read_batches(spark, f"{path}/{kind}/valid", Z.valid_schema(kind)).select(
            "event_id", F.when(F.col("validation_flag"), "flagged").otherwise("valid").alias("outcome"))
        bad = O.read_batches(spark, f"{path}/{kind}/quarantine", Z.quarantine_schema(kind)).select(
            "event_id", F.col("rejection_reason").alias("outcome"))
        return ok.unionByName(bad).select(F.lit(kind).alias("kind"), "event_id", "outcome")
    return _over_kinds(one)


def _repeated(stream: DataFrame) -> DataFrame:
    """Every row up to three times, as redelivered messages are."""
    copies = F.sequence(F.lit(1), F.pmod(F.crc32("event_id"), F.lit(3)).cast("int") + 1)
    return stream.withColumn("copy", F.explode(copies))


@query("v10_watermarked_stream")
def _(spark, sf):
    """Redelivered charges, deduplicated in a stream with the declared watermark; newest first, in two runs of one checkpoint."""
    charges = W.stream_table(spark, sf, "charges")
    cut = charges.agg(F.percentile_approx("created_at", 0.5)).first()[0]
    landing, path, checkpoint = (scratch(spark, name) for name in ("landing", "dedupe", "checkpoint"))
    for part in (F.col("created_at") >= F.lit(cut), ~F.coalesce(F.col("created_at") >= F.lit(cut), F.lit(False))):
        _repeated(charges.filter(part)).drop("copy").write.mode("append").parquet(landing)
        stream = J.with_watermark(spark.readStream.schema(Z.CHARGES).parquet(landing))
        out = D.dedupe_stream(stream).select(*STREAM_VIEW)
        WS.finish(O.passthrough(out, path, checkpoint, **WS.ONCE))
    return spark.read.schema(out.schema).parquet(path)


@query("v11_dedupe")
def _(spark, sf):
    """Redelivered normalized messages; the earliest by partition and offset stays."""
    rows = _repeated(W.payment_rows(spark, sf).select(
        F.when(F.col("n") % 61 != 0, F.col("event_id")).alias("event_id"), (F.col("n") % 3).cast("int").alias("partition"),
        F.col("n").alias("offset"), "amount_cents"))
    copies = rows.withColumn("offset", F.col("offset") * 10 + F.col("copy"))
    return D.dedupe_stream(copies).select("event_id", "offset", "amount_cents")


@query("v12_dedupe_dlq")
def _(spark, sf):
    dlq = N.normalize(W.raw_messages(spark, sf), at()).dlq
    twice = dlq.unionByName(dlq.withColumn("kafka_offset", F.col("kafka_offset") + F.when(F.col("event_id").isNull(), 0).otherwise(1)))
    return D.dedupe_dlq(twice).select("dlq_key", "event_id", "source_topic", "kafka_partition", "kafka_offset")


EXACT = ["interval_start", "interval_end", "transaction_count", "successful_count", "failed_count", "revenue_cents", "high_risk_count"]


@query("v13_stream_interval_metrics")
def _(spark, sf):
    """Buckets as the stream emits them. A late closing row, in a run of its own, moves the watermark past the last one."""
    landing, path, checkpoint = (scratch(spark, name) for name in ("landing", "intervals", "checkpoint"))
    events = W.bronze(spark, sf)
    closing = events.orderBy("event_id").limit(1).withColumn("ingested_at", F.lit("2031-01-01 00:00:00").cast("timestamp"))
    for part in (events, closing):
        part.write.mode("append").parquet(landing)
        stream = D.stream_interval_metrics(spark.readStream.schema(Z.BRONZE).parquet(landing))
        WS.finish(O.passthrough(stream, path, checkpoint, **WS.ONCE))
    emitted = spark.read.schema(stream.schema).parquet(path)
    exact = events.groupBy(M.interval_15m(F.col("ingested_at")).start.alias("interval_start")).agg(
        F.count_distinct("customer_id").alias("customers"), F.count_distinct("merchant_id").alias("merchants"))
    # Three standard errors of the sketch, two at least.
    close = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.greatest(F.lit(2.0), F.col(b) * 0.15)
    return emitted.join(exact, "interval_start", "left").select(
        *EXACT, close("approx_customers", "customers").alias("customers_close"), close("approx_merchants", "merchants").alias("merchants_close"))


COUNTERS = "messages_consumed bigint, workflows_started bigint, duplicates_skipped bigint, errors bigint, dlq_workflows bigint"


def intake(spark, sf, times: int) -> str:
    """The intake job over the raw messages, delivered `times` over; each delivery is a run of its own of one checkpoint."""
    path, checkpoint, landing = (scratch(spark, name) for name in ("intake", "checkpoint", "landing"))
    for _ in range(times):
        W.raw_messages(spark, sf).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(W.RAW_SCHEMA).parquet(landing)
        WS.finish(D.run_intake(stream.select("value", "topic", "partition", "offset"), path, checkpoint, at(), **WS.ONCE))
    return path


def intake_totals(spark, path: str) -> DataFrame:
    counts = O.read_batches(spark, f"{path}/counters", COUNTERS)
    return counts.agg(*[F.sum(c).alias(c) for c in counts.columns])


@query("v14_stream_counters")
def _(spark, sf):
    """Counters of the intake job over the raw stream."""
    return intake_totals(spark, intake(spark, sf, 1))


@query("v14_redelivered_counters")
def _(spark, sf):
    """The same where every message is delivered again after a restart."""
    return intake_totals(spark, intake(spark, sf, 2))


INTAKE_VIEW = ["event_id", "event_type", "amount_cents", "currency", "status", "validation_status", "ingested_at"]


@query("v14_intake_bronze")
def _(spark, sf):
    """Bronze rows the same job writes."""
    return O.read_batches(spark, f"{intake(spark, sf, 1)}/bronze", Z.BRONZE).select(*INTAKE_VIEW)


@query("v14_redelivered_bronze")
def _(spark, sf):
    """The same where every message is delivered again after a restart: each id is there once."""
    return O.read_batches(spark, f"{intake(spark, sf, 2)}/bronze", Z.BRONZE).select(*INTAKE_VIEW)


@query("v14_redelivered_quarantine")
def _(spark, sf):
    """Dead letters of the same, each key once."""
    schema = "dlq_key string, source_topic string"
    return O.read_batches(spark, f"{intake(spark, sf, 2)}/quarantine", schema)


# --- enrichment ------------------------------------------------------------------------------------------

def rule_codes(errors) -> F.Column:
    return F.array_join(F.transform(errors, lambda e: e["code"]), ",")


@query("e01_business_rules")
def _(spark, sf):
    """Block lists as literals and, for every 23rd merchant and every 50th customer, as tables."""
    rows = W.unified(spark, sf)
    return E.business_rules(rows).select(
        "event_id", "is_valid", rule_codes(F.col("errors")).alias("codes"), F.size("warnings").alias("warning_count"),
        F.size("rules_checked").alias("rules"))


@query("e01_business_rules_with_tables")
def _(spark, sf):
    rows = W.unified(spark, sf)
    listed = W.table(spark, sf, "customer").filter(F.col("c_acctbal") < 0).select(
        F.concat(F.lit("cus_"), F.col("c_custkey").cast("string")).alias("customer_id"))
    shops = W.table(spark, sf, "supplier").filter(F.col("s_acctbal") < 0).select(
        F.concat(F.lit("merch_"), F.col("s_suppkey").cast("string")).alias("merchant_id"))
    return E.business_rules(rows, listed, shops).select("event_id", "is_valid", rule_codes(F.col("errors")).alias("codes"))


@query("e02_event_gates")
def _(spark, sf):
    return W.unified(spark, sf).select("event_id", *[c.alias(n) for n, c in E.event_gates().items()])


@query("e03_fraud_score_rules")
def _(spark, sf):
    return E.fraud_score(W.unified(spark, sf)).select(
        "event_id", "fraud_score", F.array_join("risk_factors", ",").alias("factors"))


@query("e04_fraud_risk_level")
def _(spark, sf):
    return staged(spark, sf).select("event_id", R.fraud_level(F.col("fraud_score")).alias("level"))


@query("e05_churn_rules")
def _(spark, sf):
    rows = staged(spark, sf).filter(F.col("customer_id").isNotNull())
    streak, gap = F.col("amount_cents") % 5, F.col("amount_cents") % 61
    return rows.select("event_id", R.churn_rules(F.col("customer_id"), streak, gap).alias("c")).select(
        "event_id", "c.probability", F.array_join("c.factors", ",").alias("factors"), F.array_join("c.actions", ",").alias("actions"))


@query("e06_churn_level")
def _(spark, sf):
    return staged(spark, sf).filter(F.col("churn_score").isNotNull()).select(
        "event_id", R.churn_level4(F.col("churn_score")).alias("level"))


SIGNALS = ["consecutive_failures", "days_since_last_payment", "days_since_last_failure"]


@query("e07_churn_signals")
def _(spark, sf):
    return E.churn_signals(W.unified(spark, sf)).select("event_id", *SIGNALS)


@query("e07_churn_signals_history")
def _(spark, sf):
    stg = staged(spark, sf)
    return E.churn_signals(W.unified(spark, sf), E.customer_history(stg, W.AS_OF)).select("event_id", *SIGNALS)


@query("e08_retry_strategy")
def _(spark, sf):
    rows = W.failed_payments(spark, sf)
    return E.retry_decision(rows, F.col("attempt_number")).select("event_id", "retry.*")


@query("e09_recovery_plan")
def _(spark, sf):
    plan = E.recovery_plan(W.failed_payments(spark, sf), W.AS_OF)
    steps = F.array_join(F.transform("steps", lambda s: F.concat_ws(
        "/", s["action"], s["delay_hours"].cast("decimal(6,1)").cast("string"), s["expected_success_rate"].cast("decimal(4,2)").cast("string"),
        s["reason"])), "|")
    return plan.select("event_id", "priority", "primary_action", steps.alias("steps"), "probability",
                       F.array_join("insights", "|").alias("insights"))


@query("e10_card_expired")
def _(spark, sf):
    rows = W.failed_payments(spark, sf)
    return rows.select("event_id", R.is_card_expired(F.col("card_exp_month"), F.col("card_exp_year"), at()).alias("expired"))


@query("e11_optimal_retry_hour")
def _(spark, sf):
    rows = W.failed_payments(spark, sf)
    return rows.select("event_id", R.optimal_retry_hour(F.col("failure_code"), F.col("amount_cents")).alias("retry_hour"))


@query("e12_recovery_confidence")
def _(spark, sf):
    rows = W.failed_payments(spark, sf)
    return rows.select("event_id", R.recovery_confidence(
        F.col("failure_code"), F.col("ltv_cents"), F.col("has_email"), F.col("has_phone")).alias("confidence"))


@query("e13_enrich")
def _(spark, sf):
    return E.enrich(W.unified(spark, sf)).select(
        "event_id", "validation_status", rule_codes(F.col("validation_errors")).alias("codes"), "fraud_score",
        "risk_level", "churn_score", "churn_risk_level", F.col("retry.action").alias("retry_action"),
        F.col("retry.delay_seconds").alias("retry_delay"))


@query("e14_to_bronze")
def _(spark, sf):
    rows = E.to_bronze(E.enrich(W.unified(spark, sf)), at())
    return rows.select(
        "event_id", "amount_cents", "validation_status", "retry_delay_seconds", "retry_strategy", "metadata",
        "ingested_at", "schema_version")


# --- relational models ----------------------------------------------------------------------------------

@query("m01_stg_payment_events")
def _(spark, sf):
    return staged(spark, sf)


@query("m02_customer_metrics")
def _(spark, sf):
    return customers(spark, sf)


@query("m03_merchant_metrics")
def _(spark, sf):
    return merchants(spark, sf)


@query("m04_daily_summary")
def _(spark, sf):
    return I.int_daily_summary(staged(spark, sf))


@query("m05_dim_customer")
def _(spark, sf):
    return K.dim_customer(customers(spark, sf), W.AS_OF).select(
        "customer_key", "customer_id", "customer_tier", "total_revenue_cents", "valid_from", "valid_to", "is_current")


@query("m05_dim_customer_incremental")
def _(spark, sf):
    """Old dimension, then a merge of the customers with newer events only."""
    stg = staged(spark, sf)
    old, _new = halves(stg)
    cut = dt.datetime(2024, 1, 20)
    dim = K.dim_customer(I.int_customer_metrics(old), "2024-01-20 00:00:00")
    fresh = K.dim_customer(I.int_customer_metrics(K.touched_entities(stg, "customer_id", cut)), W.AS_OF)
    return U.upsert(dim, fresh, ["customer_key"], "dw_updated_at").select(
        "customer_key", "customer_id", "total_transactions", "total_revenue_cents", "customer_tier", "valid_from")


@query("m06_dim_merchant")
def _(spark, sf):
    return K.dim_merchant(merchants(spark, sf), W.AS_OF).select(
        "merchant_key", "merchant_id", "health_category", "health_score", "valid_from", "valid_to", "is_current")


@query("m07_dim_date")
def _(spark, sf):
    """The calendar with the events of each day."""
    per_day = staged(spark, sf).groupBy(F.to_date("provider_created_at").alias("date_key")).agg(F.count(F.lit(1)).alias("n"))
    return K.dim_date(spark).join(per_day, "date_key", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query("m08_fct_payments")
def _(spark, sf):
    return K.fct_payments(staged(spark, sf), W.AS_OF).drop(*AUDIT)


@query("m09_fct_daily_payments")
def _(spark, sf):
    return K.fct_daily_payments(I.int_daily_summary(staged(spark, sf)), W.AS_OF).drop(*AUDIT)


@query("m09_fct_daily_incremental")
def _(spark, sf):
    """Old days, then every touched day aggregated again in full."""
    stg = staged(spark, sf)
    old, _new = halves(stg, cut="2024-01-20 12:00:00")
    table = I.int_daily_summary(old)
    fresh = I.int_daily_summary(K.touched_days(stg, dt.datetime(2024, 1, 20, 12)))
    merged = U.upsert(table, fresh, ["event_date"], "event_date")
    return merged.select("event_date", "total_transactions", "total_revenue_cents", "unique_customers")


@query("m10_scd2_merge")
def _(spark, sf):
    """Customer tiers before and after the second half of the events."""
    stg = staged(spark, sf)
    old, _new = halves(stg)
    cols = ["customer_id", "customer_tier", "payment_risk_profile"]
    opened = F.lit("2024-01-20 00:00:00").cast("timestamp")
    dim = I.int_customer_metrics(old).select(
        *cols, opened.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"), F.lit(True).alias("is_current"))
    snapshot = I.int_customer_metrics(stg).select(*cols)
    return U.scd2_merge(dim, snapshot, "customer_id", cols[1:], W.AS_OF)


@query("m11_incremental_filter")
def _(spark, sf):
    """Staging past the high-water mark of what is already loaded."""
    rows = W.bronze(spark, sf)
    mark = H.high_water(rows.filter(F.col("ingested_at") < F.lit("2024-01-20").cast("timestamp")), "ingested_at")
    return stg_payment_events(rows, mark).select("event_id", "ingested_at", "event_category")


@query("m11_interval_rebuild")
def _(spark, sf):
    """Intervals of the first half, rebuilt from 30 minutes before their end with all events."""
    stg = staged(spark, sf)
    old, _new = halves(stg, cut="2024-01-20 00:07:00")
    table = materialize(A.payment_intervals(old), "intervals")
    edge = H.reread_from(table)
    return H.replace_from(table, A.payment_intervals(stg, edge), "interval_start", edge).select(
        "interval_start", "transaction_count", "revenue_cents", "unique_customers", "success_rate_pct")


def _content(tables: dict[str, DataFrame]) -> DataFrame:
    """Every row of every model, as its key and a measure."""
    result = None
    for name, (_, keys, measure) in CONTENT.items():
        part = plain(tables[name].select(*keys, measure))
        part = part.select(F.lit(name).alias("model"), F.concat_ws("|", *keys).alias("key"), F.col(measure).cast("double").alias("measure"))
        result = part if result is None else result.unionByName(part)
    return result


def twice_ingested(spark, sf) -> DataFrame:
    """Bronze in which a third of the events are there in an older state as well, and some in the same state again."""
    draw = F.pmod(F.crc32("event_id"), F.lit(6))
    stale = F.when(draw < 2, F.array(F.lit(False), F.lit(True))).when(draw == 3, F.array(F.lit(False), F.lit(False)))
    rows = W.bronze(spark, sf).withColumn("_stale", F.explode(F.coalesce(stale, F.array(F.lit(False)))))  # read once
    return rows.withColumns({
        "ingested_at": F.when(F.col("_stale"), F.col("ingested_at") - F.expr("INTERVAL 20 MINUTES")).otherwise(F.col("ingested_at")),
        "amount_cents": F.when(F.col("_stale"), F.lit(1).cast("bigint")).otherwise(F.col("amount_cents")),
        "status": F.when(F.col("_stale"), F.lit("stale")).otherwise(F.col("status")),
    }).drop("_stale")


@query("m12_batch_build")
def _(spark, sf):
    """The whole build over bronze with repeated ids, every row of every model."""
    source, out = scratch(spark, "bronze"), scratch(spark, "models")
    S.append_bronze(twice_ingested(spark, sf), source)
    return _content(B.run_batch(spark, source, out, W.AS_OF))


def grown_build(spark, sf) -> dict[str, DataFrame]:
    """The build over the first half of the same bronze, then brought up to date in place."""
    rows = twice_ingested(spark, sf)
    old, new = halves(rows, cut="2024-01-20 10:07:00")
    source, out = scratch(spark, "bronze"), scratch(spark, "models")
    S.append_bronze(old, source)
    B.run_batch(spark, source, out, W.AS_OF)
    S.append_bronze(new, source)
    return B.run_incremental(spark, source, out, LATER)


@query("m12_incremental_build")
def _(spark, sf):
    tables = grown_build(spark, sf)
    return _content(tables | {"analytics_payment_trends": tables["analytics_payment_trends"].filter(F.col("date_key") <= F.to_date(at()))})


class Killed(Exception):
    """A run that ends half-way."""


@query("m12_interrupted_build")
def _(spark, sf):
    """An increment that is killed after staging and again after the facts, then repeated: every row of every model."""
    old, new = halves(twice_ingested(spark, sf), cut="2024-01-20 10:07:00")
    source, out = scratch(spark, "bronze"), scratch(spark, "models")
    S.append_bronze(old, source)
    B.run_batch(spark, source, out, W.AS_OF)
    S.append_bronze(new, source)
    for last in ("stg_payment_events", "fct_payments"):
        def step(name, last=last):
            if name == last:
                raise Killed(name)

        with contextlib.suppress(Killed):
            B.run_incremental(spark, source, out, W.AS_OF, step=step)
    B.run_incremental(spark, source, out, W.AS_OF)
    return _content(B.published(spark, out))


@query("m12_incremental_dimensions")
def _(spark, sf):
    """Audit columns of the dimensions after an increment: only entities with newer rows are written anew."""
    tables = grown_build(spark, sf)
    part = lambda name, key: tables[name].select(
        F.lit(name).alias("dimension"), F.col(key).alias("entity"), "valid_from", "dw_created_at", "dw_updated_at", "is_current")
    return part("dim_customer", "customer_id").unionByName(part("dim_merchant", "merchant_id"))


@query("m12_ingest_twice")
def _(spark, sf):
    """Bronze after the row store was ingested, ingested again, and ingested once more with the ledger lost."""
    source, ledger = scratch(spark, "bronze"), scratch(spark, "ledger")
    for path in (ledger, ledger, f"{ledger}-new"):
        S.ingest(W.row_store(spark, sf), source, path)
    return spark.read.parquet(source).select(*Z.BRONZE.names)


# --- analytics ----------------------------------------------------------------------------------------------

@query("a01_payment_intervals")
def payment_intervals(spark, sf):
    return A.payment_intervals(staged(spark, sf))


@query("a02_payment_summary")
def _(spark, sf):
    return A.payment_summary(staged(spark, sf))


@query("a03_provider_comparison")
def _(spark, sf):
    return A.provider_comparison(staged(spark, sf))


@query("a04_risk_overview")
def _(spark, sf):
    return A.risk_overview(staged(spark, sf))


@query("a05_payment_trends")
def _(spark, sf):
    return A.payment_trends(K.fct_payments(staged(spark, sf), W.AS_OF), K.dim_date(spark), W.AS_OF)


@query("a06_customer_segments")
def _(spark, sf):
    return A.customer_segments(K.dim_customer(customers(spark, sf), W.AS_OF))


def accepted(spark, sf, kind: str) -> DataFrame:
    return P.split(W.stream_table(spark, sf, kind), kind, at())[0]


def quarantined(spark, sf, kind: str) -> DataFrame:
    """Rejected rows, stamped with the time their message was created."""
    return P.split(W.stream_table(spark, sf, kind), kind, F.col("created_at"))[1]


@query("a07_provider_performance")
def _(spark, sf):
    return A.provider_performance(accepted(spark, sf, "charges"))


@query("a08_refund_analytics")
def _(spark, sf):
    return A.refund_analytics(accepted(spark, sf, "refunds"))


@query("a09_dispute_patterns")
def _(spark, sf):
    return A.dispute_patterns(accepted(spark, sf, "disputes"))


@query("a10_recent")
def _(spark, sf):
    return A.recent(accepted(spark, sf, "charges"), "created_at").select("event_id", "created_at", "amount")


@query("a10_recent_quarantine")
def _(spark, sf):
    """The newest rejected charges with their reason."""
    _, bad = P.split(W.stream_table(spark, sf, "charges"), "charges", at())
    return A.recent(bad, "created_at").select("event_id", "created_at", "rejection_reason")


@query("a11_unified_payments")
def _(spark, sf):
    rows = W.bronze(spark, sf)
    stripe = rows.filter(F.col("provider") == "stripe").select(
        "event_id", F.col("event_type").alias("type"), F.col("provider_created_at").alias("created"), "amount_cents",
        F.lower("currency").alias("currency"), "customer_id", "failure_code")
    square = rows.filter(F.col("provider") == "square").select(
        F.col("event_id").alias("payment_id"),
        F.when(F.col("status") == "succeeded", "COMPLETED").when(F.col("status") == "failed", "FAILED").otherwise("PENDING")
        .alias("status"),
        F.col("provider_created_at").alias("created_at"), M.money2(F.col("amount_cents")).alias("amount_dollars"),
        F.lower("currency").alias("currency"), F.col("customer_id").alias("buyer_email"), F.col("failure_code").alias("card_status"))
    return A.unified_payments(stripe, square, dt.datetime(2024, 1, 5))


@query("a12_customer_clv")
def _(spark, sf):
    return A.customer_clv(staged(spark, sf))


@query("a13_retry_label")
def _(spark, sf):
    return X.retry_label(staged(spark, sf))


@query("a14_hourly_success")
def _(spark, sf):
    return A.hourly_success_metrics(staged(spark, sf), "2024-01-15 12:00:00")


@query("a15_parent_child_counts")
def _(spark, sf):
    parents, children = W.table(spark, sf, "customer"), W.table(spark, sf, "orders")
    return A.parent_child_counts(parents, children, "c_custkey", "o_custkey", "o_orderkey", "c_name")


@query("a15_top_scored")
def _(spark, sf):
    """The ten highest-priced orders."""
    rows = W.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return A.recent(rows, "o_totalprice", 10, "o_orderkey")


@query("a16_rejection_counts")
def _(spark, sf):
    return A.rejection_counts(quarantined(spark, sf, "charges"))


# --- expressions ---------------------------------------------------------------------------------------------

def _expression(name: str, make):
    @query(name)
    def _(spark, sf):
        return staged(spark, sf).select("event_id", *make())


col = F.col
_expression("f01_safe_divide", lambda: [M.safe_divide(col("amount_cents"), col("amount_cents") % 7).alias("ratio"),
                                        M.safe_divide(col("amount_cents"), col("days_to_churn_estimate")).alias("null_ratio")])
_expression("f02_surrogate_key", lambda: [M.surrogate_key(col("customer_id")).alias("one"),
                                          M.surrogate_key(col("customer_id"), col("amount_cents"), col("merchant_id")).alias("three")])
_expression("f04_customer_tier", lambda: [M.customer_tier(col("amount_cents") * 10).alias("tier")])
_expression("f05_risk_profile", lambda: [M.risk_profile(col("fraud_score")).alias("profile")])
_expression("f06_fraud_risk_level", lambda: [M.fraud_risk_level(col("fraud_score")).alias("level")])
_expression("f07_churn_risk_level", lambda: [M.churn_risk_level(col("churn_score")).alias("level")])
_expression("f08_cents_to_dollars", lambda: [M.cents_to_dollars(col("amount_cents")).alias("dollars")])
_expression("f11_status_category", lambda: [M.payment_status_category(F.upper("status")).alias("category")])
_expression("f12_event_type_category", lambda: [M.event_type_category(col("event_type")).alias("category"),
                                                M.staging_category(col("event_type")).alias("staging")])


@query("f03_date_spine")
def _(spark, sf):
    """Days spanned by the orders, with the orders of each day."""
    orders = W.table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("date_day")).agg(F.count(F.lit(1)).alias("n"))
    low, high = orders.agg(F.min("date_day"), F.max("date_day")).first()
    return M.date_spine(spark, str(low), str(high)).join(orders, "date_day", "left").select("date_day", F.coalesce("n", F.lit(0)).alias("n"))


@query("f09_merchant_health")
def _(spark, sf):
    """Rates scaled down so that scores spread over the range."""
    score = M.merchant_health_score(*[F.col(c) / 20 for c in ("dispute_rate", "refund_rate", "failure_rate")])
    return merchants(spark, sf).select("merchant_id", score.alias("score"))


@query("f10_merchant_health_category")
def _(spark, sf):
    return staged(spark, sf).select("event_id", M.merchant_health_category(F.col("fraud_score") * 100).alias("category"))


@query("f13_interval_15m")
def _(spark, sf):
    return staged(spark, sf).withColumn("w", M.interval_15m(F.col("ingested_at"))).select(
        "event_id", F.col("w.start").alias("interval_start"), F.col("w.end").alias("interval_end"),
        M.interval_label(F.col("w.start")).alias("label"))


# --- features ---------------------------------------------------------------------------------------------------

@query("x01_feat_customer")
def _(spark, sf):
    return X.feat_customer(customers(spark, sf), W.AS_OF)


@query("x02_feat_merchant")
def _(spark, sf):
    return X.feat_merchant(merchants(spark, sf), W.AS_OF)


def snapshots(spark, sf) -> DataFrame:
    """Daily feature rows per customer, as features of that day's events, stamped at its end."""
    day = F.to_date("provider_created_at")
    return staged(spark, sf).filter(F.col("customer_id").isNotNull()).groupBy("customer_id", day.alias("d")).agg(
        F.count(F.lit(1)).alias("total_payments_30d"), F.count_if(F.col("status") == "failed").alias("failed_payments_30d"),
        F.sum("amount_cents").alias("total_amount_cents_30d"),
    ).select("customer_id", F.date_add("d", 1).cast("timestamp").alias("feature_timestamp"),
             "total_payments_30d", "failed_payments_30d", "total_amount_cents_30d")


SNAPSHOT_VIEW = X.FeatureView("daily", "customer_id", X.DAY, {
    n: "bigint" for n in ("total_payments_30d", "failed_payments_30d", "total_amount_cents_30d")})


@query("x03_feature_view")
def _(spark, sf):
    return SNAPSHOT_VIEW.read(snapshots(spark, sf), "2024-01-15 06:00:00")


@query("x04_feature_services")
def _(spark, sf):
    """The three services for every (customer, merchant) pair seen."""
    pairs = staged(spark, sf).filter(F.col("customer_id").isNotNull() & F.col("merchant_id").isNotNull()) \
        .select("customer_id", "merchant_id").distinct()
    cust = X.feat_customer(customers(spark, sf), W.AS_OF)
    sources = {"customer_payment_features": cust, "customer_profile_features": cust,
               "merchant_payment_features": X.feat_merchant(merchants(spark, sf), W.AS_OF)}
    later = "2024-06-01 12:00:00"
    fraud = X.service_features(pairs, X.FRAUD_SERVICE, sources, later)
    retry = X.service_features(pairs, X.RETRY_SERVICE, sources, later)
    churn = X.service_features(pairs, X.CHURN_SERVICE, sources, later)
    keys = ["customer_id", "merchant_id"]
    return fraud.join(retry.drop("consecutive_failures"), keys).join(
        churn.select(*keys, "consecutive_failures", "customer_tier", "days_since_first_payment").withColumnRenamed(
            "days_since_first_payment", "churn_days"), keys)


@query("x05_latest_features")
def _(spark, sf):
    everyone = W.table(spark, sf, "events").select(
        F.concat(F.lit("cus_"), F.col("user_id").cast("string")).alias("customer_id")).distinct()
    return X.latest_features(everyone, SNAPSHOT_VIEW, snapshots(spark, sf), "2024-01-15 06:00:00")


@query("x06_point_in_time_join")
def _(spark, sf):
    labels = staged(spark, sf).filter(F.col("customer_id").isNotNull()).select("event_id", "customer_id", "provider_created_at")
    return X.historical_features(labels, "provider_created_at", SNAPSHOT_VIEW, snapshots(spark, sf))


@query("x07_feat_customer_windowed")
def _(spark, sf):
    return X.feat_customer_windowed(staged(spark, sf), "2024-01-25 00:00:00")


# --- quality --------------------------------------------------------------------------------------------------------

@query("q01_check_unique")
def _(spark, sf):
    return Q.check_unique(staged(spark, sf), ["customer_id", "merchant_id"])


@query("q02_check_not_null")
def _(spark, sf):
    return Q.check_not_null(staged(spark, sf), "event_id", "customer_id", "merchant_id", "fraud_score", "failure_code")


@query("q03_check_accepted")
def _(spark, sf):
    return Q.check_accepted(staged(spark, sf), "currency", ["USD", "EUR", "GBP"])


@query("q04_check_freshness")
def _(spark, sf):
    """Freshness of each provider's rows, seen 10, 45 and 90 minutes after the newest of all."""
    rows = staged(spark, sf)
    newest, result = H.high_water(rows, "ingested_at"), None
    for provider in V.EVENT_TYPE_MAPS:
        for m in (10, 45, 90):
            part = Q.check_freshness(rows.filter(F.col("provider") == provider), "ingested_at", newest + dt.timedelta(minutes=m))
            part = part.select(F.lit(provider).alias("provider"), F.lit(m).alias("late"), "age_minutes", "status")
            result = part if result is None else result.unionByName(part)
    return result


@query("q05_quality_suite")
def _(spark, sf):
    models = B.build(spark, W.bronze(spark, sf), W.AS_OF)
    return Q.quality_suite(models)


@query("q06_quarantine_monitor")
def _(spark, sf):
    """Orders arrive over years, so the monitors look back 200 days instead of one hour."""
    return Q.quarantine_monitor(quarantined(spark, sf, "charges"), "1997-06-15 00:30:00", hours=4800)


@query("q07_quarantine_summary")
def _(spark, sf):
    kinds = list(Z.STREAMS)
    return Q.quarantine_summary(
        {k: quarantined(spark, sf, k) for k in kinds}, "1997-06-15 00:30:00",
        true_totals={k: W.stream_table(spark, sf, k) for k in kinds}, hours=4800).drop("total_rows")


@query("q08_flag_monitor")
def _(spark, sf):
    return Q.flag_monitor(accepted(spark, sf, "charges"), "1997-06-15 00:30:00", hours=4800)


DRIFT_FEATURES = {
    "customer_id": ["total_payments_30d", "total_amount_cents_30d", "failure_rate_30d", "fraud_score_avg", "days_since_first_payment"],
    "merchant_id": ["total_transactions_30d", "total_volume_cents_30d", "unique_customers_30d", "merchant_health_score"],
}


def drift_reports(features: DataFrame, key: str) -> DataFrame:
    """Entities with an odd number against those with an even one: as they are, and with every second value moved up."""
    names = DRIFT_FEATURES[key]
    number = F.regexp_extract(key, "([0-9]+)$", 1).cast("bigint")
    even, odd = features.filter(number % 2 == 0), features.filter(number % 2 == 1)
    moved = odd.select(*[F.when(number % 4 == 1, F.col(c).cast("double") * 2 + 1).otherwise(F.col(c).cast("double")).alias(c) for c in names])
    edges = DR.quantile_edges(even, names)
    reference, result = DR.profile(even, edges), None
    # The shifted profile is merged from two halves.
    merged = DR.merge_profiles(*[DR.profile(moved.filter(f"{names[0]} % 2 {op} 0"), edges) for op in ("=", "<>")])
    for variant, current in (("unshifted", DR.profile(odd, edges)), ("shifted", merged)):
        part = DR.drift_report(reference, current).select(
            F.lit(variant).alias("variant"), "feature", "reference_rows", "current_rows", F.round("psi", 6).alias("psi"),
            F.round("psi_limit", 6).alias("psi_limit"), F.round("ks", 6).alias("ks"), F.round("ks_limit", 6).alias("ks_limit"), "level", "drifted")
        result = part if result is None else result.unionByName(part)
    return result


@query("q09_customer_drift")
def _(spark, sf):
    return drift_reports(X.feat_customer(customers(spark, sf), W.AS_OF), "customer_id")


@query("q10_merchant_drift")
def _(spark, sf):
    return drift_reports(X.feat_merchant(merchants(spark, sf), W.AS_OF), "merchant_id")


@query("q09_validate_customer_features")
def _(spark, sf):
    report = Q.validate_customer_features(X.feat_customer(customers(spark, sf), W.AS_OF))
    return report.select("num_records", "invalid_failure_rates", F.round("fraud_score_mean", 6).alias("fraud_score_mean"),
                         F.size("high_null_columns").alias("high_null_columns"), "quality_status")


@query("q10_validate_merchant_features")
def _(spark, sf):
    report = Q.validate_merchant_features(X.feat_merchant(merchants(spark, sf), W.AS_OF))
    return report.select("num_records", F.round("avg_merchant_health_score", 6).alias("avg_merchant_health_score"),
                         F.aggregate("null_rates", F.lit(0.0), lambda a, r: a + r["rate"]).alias("null_rate_sum"))


@query("q11_check_relationship")
def _(spark, sf):
    """Events against the customers of the first half."""
    stg = staged(spark, sf)
    old, _new = halves(stg, cut="2024-01-02 00:00:00")
    return Q.check_relationship(stg, I.int_customer_metrics(old), "customer_id")


@query("q12_check_expression")
def _(spark, sf):
    stg = staged(spark, sf)
    rules = ["provider IN ('stripe', 'square')", "amount_cents > 1000", "fraud_score < 0.5"]
    parts = [Q.check_expression(stg, r).select(F.lit(r).alias("rule"), "failures") for r in rules]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def reviewed(spark, sf) -> DataFrame:
    """Dead letters with decisions: missing ids are reprocessed, bad currencies discarded."""
    store = D.dedupe_dlq(quarantine_store(spark, sf)).drop("dlq_key").withColumn(
        "review_key", F.col("kafka_offset").cast("string"))
    made = store.filter(F.col("failure_reason").isin("MISSING_EVENT_ID", "INVALID_CURRENCY")).select(
        "review_key", at("2024-06-02").alias("reviewed_at"), F.lit("lead").alias("reviewed_by"),
        F.when(F.col("failure_reason") == "INVALID_CURRENCY", "discarded").otherwise("reprocessed").alias("resolution"))
    return Q.apply_review(store, made, "review_key")


@query("q13_apply_review")
def _(spark, sf):
    return reviewed(spark, sf).select("kafka_offset", "failure_reason", "reviewed", "reviewed_by", "resolution", "reviewed_at")


@query("q13_reprocess")
def _(spark, sf):
    """Reprocessed payloads, half of one provider's repaired before: those pass or fail for their next reason, the others as before."""
    rows = reviewed(spark, sf)
    broken = F.col("source_topic").contains("stripe") & (F.col("kafka_offset") % 2 == 0)
    named = F.concat(F.lit('{"id":"fixed_'), F.col("kafka_offset").cast("string"), F.lit('",'), F.expr("substring(original_payload, 2)"))
    repaired = rows.withColumn("original_payload", F.when(broken, named).otherwise(F.col("original_payload").cast("string")))
    again = N.normalize(Q.reprocess(repaired), at())
    return again.dlq.select(F.col("kafka_offset").cast("string").alias("ref"), "failure_reason").unionByName(
        again.valid.select(F.col("event_id").alias("ref"), F.lit("valid").alias("failure_reason")))


# --- training -----------------------------------------------------------------------------------------------------

def fraud_set(spark, sf) -> DataFrame:
    return L.fraud_training_set(X.feat_customer(customers(spark, sf), W.AS_OF), X.feat_merchant(merchants(spark, sf), W.AS_OF))


def churn_set(spark, sf) -> DataFrame:
    return L.churn_training_set(X.feat_customer(customers(spark, sf), W.AS_OF))


def labelled(spark, sf, kind: str) -> DataFrame:
    rows = fraud_set(spark, sf) if kind == "fraud" else churn_set(spark, sf)
    return materialize(L.synthetic_labels(rows, kind), f"{kind}-set")


@query("l01_fraud_training_set")
def _(spark, sf):
    rounded = ["merchant_fraud_rate", "high_risk_transaction_pct", "merchant_health_score"]
    rows = fraud_set(spark, sf)
    return rows.select(*[F.round(c, 6).alias(c) if c in rounded else F.col(c) for c in rows.columns])


@query("l02_churn_training_set")
def _(spark, sf):
    return churn_set(spark, sf)


@query("l03_synthetic_labels")
def _(spark, sf):
    """Labels of the churn set, whose probability is exact in both engines."""
    return L.synthetic_labels(churn_set(spark, sf), "churn").select("customer_id", "label")


@query("l04_ensure_two_classes")
def _(spark, sf):
    """A one-class set with a fifth of its rows flipped."""
    one_class = materialize(churn_set(spark, sf).withColumn("label", F.lit(0)), "one-class")
    kept = L.ensure_two_classes(one_class)
    return (one_class if kept is None else kept).select("customer_id", "label")


@query("l05_stratified_split")
def _(spark, sf):
    train, test = L.stratified_split(labelled(spark, sf, "churn"))
    tag = lambda df, name: df.select("customer_id", "label", F.lit(name).alias("part"))
    return tag(train, "train").unionByName(tag(test, "test"))


def trained(spark, sf, kind: str):
    """(model, features, test predictions), or None where the data is too small to train on."""
    data = L.ensure_two_classes(labelled(spark, sf, kind))
    if data is None:
        return None
    train, test = L.stratified_split(data)
    model = (L.train_fraud if kind == "fraud" else L.train_churn)(train)
    features = L.FRAUD_FEATURES if kind == "fraud" else L.CHURN_FEATURES
    return model, features, materialize(L.predict(model, test, features), f"{kind}-predictions")


def _checked_training(spark, sf, kind: str) -> DataFrame:
    """What holds for any model: rows and positives of the test part, scores and metrics that agree with the predictions."""
    run = trained(spark, sf, kind)
    if run is None:
        return spark.range(1).select(F.lit(0).alias("test_rows"), F.lit(0).alias("positives"), F.lit(True).alias("scores_valid"), F.lit(True).alias("metrics_valid"))
    predictions = run[2]
    auc = L.auc_roc(predictions)
    metrics = L.binary_metrics(predictions)
    right = predictions.agg(
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("share"), F.count(F.lit(1)).alias("test_rows"),
        F.sum("label").alias("positives"),
        F.min(F.col("probability_1").between(0.0, 1.0) & ((F.col("probability_1") > 0.5) == (F.col("prediction") == 1))).alias("scores_valid"))
    agrees = (F.abs(F.col("accuracy") - F.col("share")) < 1e-9) & (F.col("tp") + F.col("fn") == F.col("positives")) & F.lit(auc is None or 0 <= auc <= 1)
    return right.crossJoin(F.broadcast(metrics)).select("test_rows", "positives", "scores_valid", agrees.alias("metrics_valid"))


@query("l06_train_fraud")
def _(spark, sf):
    return _checked_training(spark, sf, "fraud")


@query("l07_train_churn")
def _(spark, sf):
    return _checked_training(spark, sf, "churn")


@query("l08_binary_metrics")
def _(spark, sf):
    """The churn label against a threshold on the failure rate."""
    rows = labelled(spark, sf, "churn").withColumn("prediction", (F.col("failure_rate_30d") > 0.2).cast("int"))
    return L.binary_metrics(rows)


@query("l09_feature_importance")
def _(spark, sf):
    run = trained(spark, sf, "fraud")
    if run is None:
        return spark.createDataFrame([], "feature string, is_share boolean, total double")
    found = L.feature_importance(spark, run[0], run[1])
    total = found.agg(F.round(F.sum("importance"), 6).alias("total"))  # one row
    return found.crossJoin(F.broadcast(total)).select("feature", F.col("importance").between(0.0, 1.0).alias("is_share"), "total")


@query("l10_promote_if_better")
def _(spark, sf):
    """Three versions of a threshold model, registered in turn with their F1."""
    rows = labelled(spark, sf, "churn")
    registry = spark.createDataFrame([], L.REGISTRY_SCHEMA)
    for cut in (0.3, 0.1, 0.5):
        f1 = L.binary_metrics(rows.withColumn("prediction", (F.col("failure_rate_30d") > cut).cast("int"))).first()["f1"]
        registry = L.promote_if_better(registry, "churn-prediction", f1, f"models/{cut}")
    return registry


@query("e15_score_with_model")
def _(spark, sf):
    """Churn scores: the model where the customer has features, the rules elsewhere."""
    run = trained(spark, sf, "churn")
    model, features = (None, L.CHURN_FEATURES) if run is None else run[:2]
    everyone = W.unified(spark, sf).select("event_id", "customer_id", "status")
    joined = E.churn_signals(everyone).drop("days_since_last_payment", "consecutive_failures").join(
        churn_set(spark, sf).drop("customer_tier").withColumn("known", F.lit(True)), "customer_id", "left")
    rules = R.churn_rules(F.col("customer_id"), F.lit(0), F.lit(5))["probability"]
    scored = L.score_with_model(joined, features, model, rules, F.col("known").isNotNull(), "churn_score")
    by_rules = (F.col("churn_score_source") == "rules") & F.col("customer_id").isNotNull()
    return scored.select(
        "event_id", "churn_score_source", F.when(by_rules, F.round("churn_score", 6)).alias("rule_score"),
        F.coalesce(F.col("churn_score").between(0.0, 1.0), F.col("customer_id").isNull()).alias("in_range"))


def default_dir() -> str:
    return os.environ.get("SMOKE_SF_DIR", "/root/testdata/sf0.001")
