"""Structured Streaming jobs: split, dedupe, interval metrics, counters, the full intake pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.functions.macros import interval_15m
from saldo.functions.validators import present
from saldo.operators.enrich import enrich, to_bronze
from saldo.operators.normalize import SOURCE_COLUMNS, dlq_records, judge, valid_events
from saldo.operators.split import judged, quarantine_rows, valid_rows
from saldo.operators.tables import newest_per_key
from saldo.session import workspace
from saldo.sources.sinks import write_batch, write_dlq, write_normalized
from saldo.streaming.ledger import file_keys, unseen

TEN_SECONDS = {"processingTime": "10 seconds"}


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, persist: bool = True, **trigger):
    """One query whose every micro-batch is persisted once and handed to `handle(batch, id)`.

    The persisted copy lives on the executors; a lost part of it is read again from the source. A handler that reads
    its batch once needs no copy.
    """

    def once(batch: DataFrame, batch_id: int) -> None:
        if not persist:
            return handle(batch, batch_id)
        kept = batch.persist()
        try:
            handle(kept, batch_id)
        finally:
            kept.unpersist()

    return (
        stream.writeStream.foreachBatch(once)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TEN_SECONDS)).start()
    )


def run_split_stream(stream: DataFrame, kind: str, path: str, checkpoint: str, now: Column | None = None, **trigger):
    """Valid and quarantine tables of one typed stream, plus a counters table, from one query.

    Folders are named after the batch id, so a batch replayed after a failure overwrites itself.
    """
    clock = F.current_timestamp() if now is None else now

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(valid_rows(batch, kind), f"{path}/{kind}/valid", batch_id)
        write_batch(quarantine_rows(batch, clock), f"{path}/{kind}/quarantine", batch_id)
        counters = stream_counters(batch, F.col("rejection_reason").isNull())
        write_batch(counters, f"{path}/{kind}/counters", batch_id)

    return run_batches(judged(stream, kind), handle, checkpoint, **trigger)


def dedupe_stream(stream: DataFrame, key: str = "event_id", order: tuple = ("partition", "offset"),
                  remember: str = "7 days") -> DataFrame:
    """The first row per key. Rows without a key are dropped.

    A stream remembers a key for `remember` after its arrival: its state is bounded by arrival time. A declared
    event-time watermark would instead drop rows that are merely late, so it is not used; as a stream cannot have
    a second watermark, such a stream remembers its keys for good. A table is reduced by an aggregate, so a key
    with very many copies is combined before the shuffle.
    """
    keyed = stream.filter(present(F.col(key)))
    if stream.isStreaming:
        # Without the event-time marks of its columns, nothing counts as late.
        plain = keyed.select(*[F.col(c).alias(c, metadata={}) for c in keyed.columns])
        if any("spark.watermarkDelayMs" in f.metadata for f in stream.schema.fields):
            return plain.dropDuplicates([key])
        arrived = plain.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", remember)
        return arrived.dropDuplicatesWithinWatermark([key]).drop("_arrived")
    return newest_per_key(keyed, [key], *[F.col(c) for c in order], oldest=True)


def dlq_key(event_id: Column, partition: Column, offset: Column) -> Column:
    """Event id, else the message's position."""
    return F.coalesce(
        F.when(event_id != "", event_id), F.concat_ws("-", partition.cast("string"), offset.cast("string")))


def dedupe_dlq(dlq: DataFrame) -> DataFrame:
    """One dead-letter row per key, the earliest by source position."""
    key = dlq_key(F.col("event_id"), F.col("kafka_partition"), F.col("kafka_offset"))
    return dedupe_stream(dlq.withColumn("dlq_key", key), "dlq_key", ("kafka_partition", "kafka_offset"))


def stream_interval_metrics(events: DataFrame, late: str = "30 minutes") -> DataFrame:
    """15-minute metrics that admit rows up to 30 minutes late.

    Distinct counts are sketches: exact ones would keep every id of an open bucket in the state.
    """
    rows = events.withWatermark("ingested_at", late) if events.isStreaming else events
    ok = F.col("status") == "succeeded"
    return rows.groupBy(interval_15m(F.col("ingested_at")).alias("w")).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.count_if(ok).alias("successful_count"),
        F.count_if(F.col("status") == "failed").alias("failed_count"),
        F.coalesce(F.sum(F.when(ok, F.col("amount_cents"))), F.lit(0).cast("bigint")).alias("revenue_cents"),
        F.count_if(F.col("risk_level") == "high").alias("high_risk_count"),
        F.approx_count_distinct("customer_id").alias("approx_customers"),
        F.approx_count_distinct("merchant_id").alias("approx_merchants"),
    ).select(F.col("w.start").alias("interval_start"), F.col("w.end").alias("interval_end"), "*").drop("w")


def stream_counters(batch: DataFrame, valid: Column) -> DataFrame:
    """Processed, valid and invalid rows of a batch."""
    return batch.agg(
        F.count(F.lit(1)).alias("processed"), F.count_if(valid).alias("valid"),
        F.count_if(~valid).alias("invalid"))


def intake_counters(judged_rows: DataFrame, started: DataFrame, filed: DataFrame) -> DataFrame:
    """Consumed, started, duplicate, error and dead-letter counts of a batch.

    `started` and `filed` are the events and dead letters that are new in this batch; what is neither new nor
    without an id was delivered before, in this batch or an earlier one.
    """
    fine = F.size("errors") == 0
    named = F.coalesce(present(F.col("event_id")), F.lit(False))
    totals = judged_rows.agg(
        F.count(F.lit(1)).alias("messages_consumed"), F.count_if(fine & ~named).alias("errors"))
    count = lambda df, name: F.broadcast(df.agg(F.count(F.lit(1)).alias(name)))  # noqa: E731  one row
    counted = totals.crossJoin(count(started, "workflows_started")).crossJoin(count(filed, "dlq_workflows"))
    skipped = F.col("messages_consumed") - F.col("errors") - F.col("workflows_started") - F.col("dlq_workflows")
    return counted.select(
        "messages_consumed", "workflows_started", skipped.alias("duplicates_skipped"), "errors", "dlq_workflows")


def run_intake(raw_stream: DataFrame, path: str, checkpoint: str, now: Column | None = None, **trigger):
    """Raw webhooks to bronze: normalize, file rejects, dedupe, enrich, write.

    Writes payments.normalized, payments.validation.dlq, quarantine, bronze and counters, one folder per batch. The
    two topics carry every message; bronze and quarantine carry each event id and dead-letter key once, over all
    batches of the checkpoint, which the ledgers ensure. An event keeps its provider day, so only the days of a
    batch are looked up; events whose payload has no time are filed without a day. The raw batch is read once. What
    several sinks read is written aside rather than held on executors, where a task would read whole payloads of many
    rows; it is deleted with the batch.
    """
    clock = F.current_timestamp() if now is None else now
    event_day = F.when(F.col("provider_created_at") != F.col("processed_at"), F.to_date("provider_created_at"))
    no_day = F.lit(None).cast("date")

    def handle(raw: DataFrame, batch_id: int) -> None:
        spark = raw.sparkSession
        with workspace(spark, "intake") as keep:
            # Stored by topic, each provider reads its own messages. Payloads are kept of rejected messages only.
            checked = judge(keep("raw", raw.select(*SOURCE_COLUMNS), "topic"), clock)
            payload = F.when(F.size("errors") > 0, F.col("value"))
            batch = keep("judged", checked.withColumn("value", payload))
            valid, dead = valid_events(batch), dlq_records(batch)
            write_normalized(valid, path, batch_id)
            write_dlq(dead, path, batch_id)
            named = batch.filter(F.size("errors") == 0).select(*valid.columns, "partition", "offset")
            first = dedupe_stream(named).select(*valid.columns)
            new = keep("new", unseen(first, "event_id", event_day, f"{path}/ledger/events", batch_id))
            write_batch(to_bronze(enrich(new), clock), f"{path}/bronze", batch_id)
            file_keys(new, "event_id", event_day, f"{path}/ledger/events", batch_id)
            rejected = unseen(dedupe_dlq(dead), "dlq_key", no_day, f"{path}/ledger/dead", batch_id)
            write_batch(rejected, f"{path}/quarantine", batch_id)
            kept = spark.read.schema(rejected.schema).parquet(f"{path}/quarantine/batch={batch_id}")
            file_keys(kept, "dlq_key", no_day, f"{path}/ledger/dead", batch_id)
            write_batch(intake_counters(batch, new, kept), f"{path}/counters", batch_id)

    return run_batches(raw_stream, handle, checkpoint, persist=False, **trigger)
