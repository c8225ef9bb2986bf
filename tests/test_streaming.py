import json

from pyspark.sql import functions as F

from saldo import schemas as Z
from saldo.session import scratch
from saldo.sources import sinks as O
from saldo.sources import streams as J
from saldo.streaming import jobs as D
from workload import adapters as W
from workload import streams as WS

NOW = "2024-06-01 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def test_split_stream_equals_batch_and_survives_replay(spark, sf, tmp_path):
    from saldo.operators import split as P

    table = W.stream_table(spark, sf, "refunds")
    files = tmp_path / "in"
    table.repartition(3).write.json(str(files))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for _ in range(2):  # the second run finds nothing new
        stream = J.typed_stream(spark, "refunds", json_path=str(files))
        D.run_split_stream(stream, "refunds", out, checkpoint, now(), availableNow=True).awaitTermination()
    ok, bad = P.split(table, "refunds", now())
    got = O.read_batches(spark, f"{out}/refunds/valid", Z.valid_schema("refunds"))
    assert sorted(map(str, got.collect())) == sorted(map(str, ok.collect()))
    rejected = O.read_batches(spark, f"{out}/refunds/quarantine", Z.quarantine_schema("refunds"))
    assert sorted(map(str, rejected.collect())) == sorted(map(str, bad.collect()))
    counters = O.read_batches(spark, f"{out}/refunds/counters", "processed bigint, valid bigint, invalid bigint")
    assert tuple(counters.agg(F.sum("processed"), F.sum("valid"), F.sum("invalid")).first()) == (
        table.count(), ok.count(), bad.count())


def test_a_replayed_batch_overwrites_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        O.write_batch(spark.range(5), path, 0)
    O.write_batch(spark.range(2), path, 1)
    assert O.read_batches(spark, path, "id bigint").count() == 7


def test_watermarked_dedupe(spark, sf, tmp_path):
    table = W.stream_table(spark, sf, "charges")
    files = str(tmp_path / "in")
    table.union(table).write.json(files)
    stream = J.typed_stream(spark, "charges", json_path=files)
    kept = WS.collect_stream(D.dedupe_stream(stream).select("event_id"), "dedupe")
    assert kept.count() == table.select("event_id").distinct().count()


def test_late_rows_still_reach_their_bucket(spark, tmp_path):
    schema = "event_id string, status string, amount_cents bigint, risk_level string, customer_id string, merchant_id string, ingested_at timestamp"
    def rows(*times):
        return spark.createDataFrame([(t, "succeeded", 1, "low", "c", "m", t) for t in times], schema.replace("ingested_at timestamp", "ingested_at string"))
    files = str(tmp_path / "in")
    rows("2024-01-01T00:01:00", "2024-01-01T00:20:00").coalesce(1).write.json(files)
    rows("2024-01-01T00:02:00", "2024-01-01T03:00:00").coalesce(1).write.mode("append").json(files)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(files)
    got = {str(r["interval_start"]): r["transaction_count"] for r in WS.collect_stream(D.stream_interval_metrics(stream), "late").collect()}
    assert got["2024-01-01 00:00:00"] == 2 and got["2024-01-01 00:15:00"] == 1


def test_intake_counts_duplicates(spark, tmp_path):
    item = {"pspReference": "p", "eventCode": "CAPTURE", "merchantAccountCode": "a", "amount": {"value": 100, "currency": "USD"}, "success": True}
    body = json.dumps(item).encode()
    rows = [(bytearray(body), "webhooks.adyen.notification", 0, i) for i in range(3)] + [(bytearray(b"{"), "webhooks.adyen.notification", 0, 9)]
    raw = str(tmp_path / "raw")
    spark.createDataFrame(rows, Z.RAW_MESSAGE).write.parquet(raw)
    stream = spark.readStream.schema(Z.RAW_MESSAGE).parquet(raw)
    out = str(tmp_path / "out")
    job = D.run_intake(stream, out, str(tmp_path / "cp"), now(), availableNow=True)
    job.awaitTermination()
    assert sum(p["numInputRows"] for p in job.recentProgress) == len(rows), "the source is read once"
    counters = spark.read.parquet(f"{out}/counters").first().asDict()
    assert {k: counters[k] for k in ("messages_consumed", "workflows_started", "duplicates_skipped", "errors", "dlq_workflows")} == {
        "messages_consumed": 4, "workflows_started": 1, "duplicates_skipped": 2, "errors": 0, "dlq_workflows": 1}
    bronze = O.read_batches(spark, f"{out}/bronze", Z.BRONZE).collect()
    assert [(r["event_id"], r["validation_status"]) for r in bronze] == [("adyen:p_CAPTURE", "passed")]


def test_kafka_options_and_decoding(spark):
    options = J.kafka_options("broker:9092", J.raw_topics())
    assert options["subscribe"].count(",") == 6 and options["startingOffsets"] == "earliest"
    value = json.dumps({"event_id": "e", "amount": 12.5, "created_at": "2024-01-01T00:00:00Z", "metadata": {"order_id": "o"}})
    row = J.decode(spark.createDataFrame([(bytearray(value.encode()),)], "value binary"), "charges").first()
    assert (row["event_id"], str(row["amount"]), row["metadata"]["order_id"]) == ("e", "12.50", "o")


def _charges(spark, *rows):
    return spark.createDataFrame([(i, t) for i, t in rows], "event_id string, created_at string")


def test_dedupe_keeps_late_rows_and_remembers_over_restarts(spark, tmp_path):
    files, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    deliveries = [
        [("new", "2024-06-01T00:00:00"), ("new", "2024-06-01T00:00:00")], [("old", "2020-01-01T00:00:00")],
        [("new", "2024-06-01T00:00:00"), ("older", "2019-01-01T00:00:00"), ("", "2024-01-01T00:00:00")], [("old", "2020-01-01T00:00:00")],
    ]
    for declared in (True, False):
        for rows in deliveries:
            _charges(spark, *rows).write.mode("append").json(f"{files}-{declared}")
            stream = spark.readStream.schema("event_id string, created_at timestamp").json(f"{files}-{declared}")
            stream = J.with_watermark(stream) if declared else stream
            O.passthrough(D.dedupe_stream(stream), f"{out}-{declared}", f"{checkpoint}-{declared}", availableNow=True).awaitTermination()
        got = spark.read.schema("event_id string").parquet(f"{out}-{declared}").collect()
        assert sorted(r["event_id"] for r in got) == ["new", "old", "older"]


def test_intake_over_restarts_and_replays(spark, tmp_path):
    def message(n, ref, at):
        item = {"pspReference": ref, "eventCode": "CAPTURE", "merchantAccountCode": "a", "amount": {"value": 100, "currency": "USD"}, "success": True}
        body = json.dumps(item | ({"eventDate": at} if at else {})).encode() if ref else b"{"
        return (bytearray(body), "webhooks.adyen.notification", 0, n)

    raw, out, checkpoint = (str(tmp_path / n) for n in ("raw", "out", "cp"))
    schema = "messages_consumed bigint, workflows_started bigint, duplicates_skipped bigint, errors bigint, dlq_workflows bigint"
    first = [message(0, "p", "2024-01-01T00:00:00Z"), message(1, "q", "2024-01-02T00:00:00Z"), message(2, "r", None), message(3, None, None)]
    second = [*first, message(4, "s", "2024-01-02T00:00:00Z"), message(5, None, None)]
    for rows, clock in ((first, NOW), (second, "2024-06-02 00:00:00")):
        spark.createDataFrame(rows, Z.RAW_MESSAGE).coalesce(1).write.mode("append").parquet(raw)
        stream = spark.readStream.schema(Z.RAW_MESSAGE).parquet(raw)
        D.run_intake(stream, out, checkpoint, F.lit(clock).cast("timestamp"), availableNow=True).awaitTermination()
    ids = [r["event_id"] for r in O.read_batches(spark, f"{out}/bronze", Z.BRONZE).collect()]
    assert sorted(ids) == [f"adyen:{x}_CAPTURE" for x in "pqrs"]
    dead = O.read_batches(spark, f"{out}/quarantine", "dlq_key string").collect()
    assert sorted(r["dlq_key"] for r in dead) == ["0-3", "0-5"]
    counts = O.read_batches(spark, f"{out}/counters", schema).agg(*[F.sum(c.split()[0]) for c in schema.split(", ")]).first()
    assert tuple(counts) == (10, 4, 4, 0, 2)


def test_intake_query_lands_raw_messages_in_their_own_partitions(spark, sf, monkeypatch):
    from workload import queries as Q

    raw, paths = W.raw_messages(spark, sf).repartition(5), {}
    monkeypatch.setattr(W, "raw_messages", lambda *_: raw)
    monkeypatch.setattr(Q, "scratch", lambda s, name: paths.setdefault(name, scratch(s, name)))
    totals = Q.intake_totals(spark, Q.intake(spark, sf, 1)).first()
    assert len(spark.read.parquet(paths["landing"]).inputFiles()) == 5
    assert totals.messages_consumed == raw.count()


def test_a_replayed_batch_does_not_see_its_own_keys(spark, tmp_path):
    from saldo.streaming.ledger import file_keys, unseen

    ledger, day = str(tmp_path / "ledger"), F.to_date("at")
    rows = spark.createDataFrame([("a", "2024-01-01"), ("b", None)], "id string, at string")
    file_keys(rows.filter("id = 'b'"), "id", day, ledger, 0)
    for _ in range(2):
        left = unseen(rows, "id", day, ledger, 1)
        assert [r["id"] for r in left.collect()] == ["a"]
        file_keys(left, "id", day, ledger, 1)
    assert unseen(rows, "id", day, ledger, 2).count() == 0
