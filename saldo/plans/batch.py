"""The whole batch build in dependency order."""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.operators import tables as U
from saldo.operators.incremental import high_water, reread_from
from saldo.plans import analytics as A
from saldo.plans import features as X
from saldo.plans import intermediate as I
from saldo.plans import marts as K
from saldo.plans.staging import arrival_order, newest_events, stg_payment_events
from saldo.schemas import BRONZE
from saldo.session import TIMES, materialize, settings, side_by_side, workspace
from saldo.sources.bronze import ingest
from saldo.sources.published import NULL, Version, versions

# Tables that grow with the events are cut by day.
INTERVALS = {
    "analytics_payment_intervals": A.payment_intervals,
    "analytics_payment_summary": A.payment_summary,
    "analytics_provider_comparison": A.provider_comparison,
    "analytics_risk_overview": A.risk_overview,
}
DAY = "event_date"
# What increments are computed from: partial aggregates of each day.
ENTITIES = {"customer": I.CUSTOMER, "merchant": I.MERCHANT}
TREND_DAYS = "state_trend_days"
BY_DAY = {
    "stg_payment_events", "fct_payments", *INTERVALS,
    *(f"state_{name}_{part}" for name in ENTITIES for part in ("days", "values")),
}
# Projections of staging, whose files are cut by day already.
LAID = {"fct_payments"}
MODELS = [
    "stg_payment_events", "int_payment_customer_metrics", "int_payment_merchant_metrics",
    "int_payment_daily_summary", "dim_customer", "dim_merchant", "dim_date", "fct_payments",
    "fct_daily_payments", "feat_customer_features", "feat_merchant_features", *INTERVALS,
    "analytics_payment_trends", "analytics_customer_segments",
]

# First day and end (exclusive) of the calendar; first day of the trends.
CALENDAR = ("2020-01-01", "2030-12-31")
TRENDS_FROM = "2024-01-01"
# How late a writer may commit a row behind the newest ingestion time.
OVERLAP = timedelta(hours=1)

# While tables are written: a task keeps a few days' files open, so that only rows of further days are sorted; and wide
# projections are not compiled into methods that the JVM leaves uncompiled for their length (8,000 bytes).
WRITING = {"spark__sql__maxConcurrentOutputFileWriters": 4, "spark__sql__codegen__hugeMethodLimit": 8000, **TIMES}

Keep = Callable[[str, DataFrame], DataFrame]
Step = Callable[[str], object]


def build(spark: SparkSession, bronze: DataFrame, as_of, keep: Keep | None = None,
          calendar: tuple[str, str] = CALENDAR, trends_from: str = TRENDS_FROM) -> dict[str, DataFrame]:
    """All models; after staging, those that do not need each other are built side by side. Of events ingested more than once the last row counts.

    `keep(name, df)` stores a finished model and returns the stored table, which is what later models
    read: nothing upstream is computed twice. The partial aggregates that increments start from are kept as well, and
    the metrics of entities and the trends are merged from them.
    """
    if keep is None:
        keep = lambda name, df: materialize(df, name)
    t: dict[str, DataFrame] = {}

    def add(name: str, df: DataFrame) -> DataFrame:
        t[name] = keep(name, df)
        return t[name]

    def parts(label: str) -> tuple[DataFrame, DataFrame]:
        entity = ENTITIES[label]
        return keep(f"state_{label}_days", entity.days(stg)), keep(f"state_{label}_values", entity.values(stg))

    def of_customers() -> None:
        customers = add("int_payment_customer_metrics", I.int_customer_metrics(stg, parts=parts("customer")))
        dim_customer = add("dim_customer", K.dim_customer(customers, as_of))
        add("feat_customer_features", X.feat_customer(customers, as_of))
        add("analytics_customer_segments", A.customer_segments(dim_customer.filter("is_current")))

    def of_merchants() -> None:
        merchants = add("int_payment_merchant_metrics", I.int_merchant_metrics(stg, parts=parts("merchant")))
        add("dim_merchant", K.dim_merchant(merchants, as_of))
        add("feat_merchant_features", X.feat_merchant(merchants, as_of))

    def of_days() -> None:
        daily = add("int_payment_daily_summary", I.int_daily_summary(stg))
        add("fct_daily_payments", K.fct_daily_payments(daily, as_of))

    def of_facts() -> None:
        facts = add("fct_payments", K.fct_payments(stg, as_of))
        dates = add("dim_date", K.dim_date(spark, *calendar))
        trends = keep(TREND_DAYS, A.trend_days(facts))
        add("analytics_payment_trends", A.trends_of(trends, dates, as_of, trends_from))

    with settings(spark, **WRITING):
        stg = add("stg_payment_events", newest_events(stg_payment_events(bronze)))
        side_by_side(spark, of_facts, of_customers, of_merchants, of_days,  # the largest table first
                     *[functools.partial(lambda name, model: add(name, model(stg)), *item) for item in INTERVALS.items()])
    return {name: t[name] for name in MODELS}


def with_day(df: DataFrame) -> DataFrame:
    return df if DAY in df.columns else df.withColumn(DAY, F.to_date("provider_created_at"))


def day_part(day: date | None) -> str:
    """Folder name of a day."""
    return f"{DAY}={NULL if day is None else day.isoformat()}"


def put(models: Version, name: str, df: DataFrame) -> DataFrame:
    return models.put(name, with_day(df), DAY, laid=name in LAID) if name in BY_DAY else models.put(name, df)


def publish(models: Version, mark: datetime | None) -> None:
    models.publish(loaded_until=None if mark is None else mark.isoformat())


def published(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """All models of the published version."""
    models = Version(spark, out)
    return {name: models.read(name) for name in MODELS}


def run_batch(spark: SparkSession, bronze_path: str, out: str, as_of, step: Step | None = None, **settings) -> dict[str, DataFrame]:
    """Builds every model from the bronze table and publishes them together under `out`; returns them.

    A version that is already published there stays readable until the new one is complete. `step(name)` is called
    after each table.
    """
    models = Version(spark, out, step)
    tables = build(spark, spark.read.schema(BRONZE).parquet(bronze_path), as_of, lambda name, df: put(models, name, df), **settings)
    publish(models, high_water(tables["stg_payment_events"], "ingested_at"))
    return tables


def run_pipeline(spark: SparkSession, store: DataFrame, bronze_path: str, ledger_path: str, out: str, as_of,
                 step: Step | None = None) -> dict[str, DataFrame]:
    """The scheduled job: new rows of the row store into bronze, then the models, whole the first time.

    The models are brought up to date from the oldest of the loaded rows on, however old it is, before those rows
    count as loaded. A run that failed anywhere is simply repeated.
    """
    def update(oldest) -> None:
        if versions(spark, out):
            run_incremental(spark, bronze_path, out, as_of, since=oldest, step=step)
        else:
            run_batch(spark, bronze_path, out, as_of, step)

    ingest(store, bronze_path, ledger_path, then=update)
    return published(spark, out)


# --- incremental build ----------------------------------------------------------------------------

def bronze_since(spark: SparkSession, path: str, since) -> DataFrame:
    """Bronze rows ingested from a time on; folders of earlier days are not read."""
    bronze = spark.read.schema(BRONZE).parquet(path)
    if "ingested_date" in bronze.columns:
        bronze = bronze.filter(F.col("ingested_date") >= F.lit(since.date()))
    return bronze


def arrivals(candidates: DataFrame, staged: DataFrame) -> DataFrame:
    """Candidates that staging lacks or holds an older row of."""
    known = staged.select(F.col("event_id").alias("_id"), arrival_order().alias("_order"))
    fresh = newest_events(candidates)
    seen = (F.col("event_id") == F.col("_id")) & (F.col("_order") >= arrival_order())
    return fresh.join(known, seen, "left_anti")


def run_incremental(spark: SparkSession, bronze_path: str, out: str, as_of, overlap: timedelta = OVERLAP,
                    history: bool = False, trends_from: str = TRENDS_FROM, since=None, step: Step | None = None) -> dict[str, DataFrame]:
    """Brings the tables under `out` up to date with new bronze rows; equals a full rebuild.

    Bronze is read from `overlap` before the mark, or from `since` if that is older, so rows that tie with the mark or were committed late are found;
    rows already staged are recognised. Tables cut by day write only the days the new rows touch (an event keeps
    its day, as its provider time never changes). Daily tables and the partial aggregates of entities and trends are computed
    again for these days; entity tables merge the partial aggregates of the touched entities, so no event of another
    day is read. Dimension rows of other entities stay as they are. With `history` a changed dimension row is
    closed and a new one opened. Intervals restart 30 minutes before the last finished bucket, or at the oldest
    bucket that gained or lost a row.

    Everything is computed from the published version and written beside it; the pointer, which carries the mark as
    well, moves when the last table is complete. So a run that failed at any point has changed nothing, and its repetition
    finds the same new rows. `step(name)` is called after each table; after staging, tables that do not need each other are
    written side by side, and one that fails ends the others. What is written aside is deleted.
    """
    models = Version(spark, out, step)
    if models.notes["loaded_until"] is None:  # built from no rows
        return run_batch(spark, bronze_path, out, as_of, step, trends_from=trends_from)
    mark = datetime.fromisoformat(models.notes["loaded_until"])
    table = models.read
    with settings(spark, **WRITING), workspace(spark, "increment") as keep:
        since = min(mark - overlap, since or mark)
        candidates = with_day(stg_payment_events(bronze_since(spark, bronze_path, since), since))  # its files are listed once
        touched_parts = lambda df: [day_part(r[0]) for r in df.select(DAY).distinct().collect()]  # noqa: E731  one per calendar day
        # One row per event, cut by day as the tables are: staging and facts take these rows without dealing them again.
        arrived = keep("arrived", arrivals(candidates, table("stg_payment_events", touched_parts(candidates))).hint("rebalance", DAY), DAY)
        days = touched_parts(arrived)
        if not days:
            return {name: table(name) for name in MODELS}
        # Rows of staging that new ones replace: their entities and buckets change too.
        replaced = keep("replaced", table("stg_payment_events", days).join(arrived.select("event_id"), "event_id", "left_semi"))
        both = arrived.unionByName(replaced.select(*arrived.columns))

        def put_days(name: str, df: DataFrame, laid: bool = False) -> DataFrame:
            """The touched days of a table; one that is left without rows goes."""
            return models.put(name, with_day(df).select(*models.columns(name)), DAY, instead_of=days, laid=laid)

        def merge_days(name: str, updates: DataFrame, keys: list[str]) -> DataFrame:
            return put_days(name, U.upsert(table(name, days), updates, keys, cut=DAY), laid=True)

        @functools.cache
        def touched(key: str) -> DataFrame:
            return keep(f"touched_{key}", both.select(key).filter(F.col(key).isNotNull()).distinct())

        def refreshed(name: str, entity: I.Entity, label: str) -> DataFrame:
            now = table("stg_payment_events", days)
            partial = put_days(f"state_{label}_days", entity.days(now)), put_days(f"state_{label}_values", entity.values(now))
            fresh = entity.from_days(*(p.join(touched(entity.key), entity.key, "left_semi") for p in partial))
            return replace(name, entity.key, fresh)

        def replace(name: str, key: str, fresh: DataFrame) -> DataFrame:
            """Rows of touched entities in place of their old ones."""
            others = table(name).join(touched(key), key, "left_anti")
            return models.put(name, others.unionByName(fresh).select(*models.columns(name)))

        def dimension(name: str, key: str, metrics: DataFrame, model: Callable[..., DataFrame]) -> DataFrame:
            fresh = model(metrics.join(touched(key), key, "left_semi"), as_of)
            if history:
                return models.put(name, U.scd2_merge(table(name), fresh, key, [c for c in metrics.columns if c != key], as_of))
            return replace(name, key, fresh)

        def first_bucket() -> datetime:
            """Where interval tables restart. They are written after this, so their edge is the last build's."""
            oldest = both.agg(F.min("ingested_at")).first()[0]
            oldest = oldest.replace(minute=oldest.minute // 15 * 15, second=0, microsecond=0)
            ends = [reread_from(table(name)) for name in INTERVALS]
            return min([oldest, *(e for e in ends if e is not None)])

        stg, edge, _, _ = side_by_side(
            spark, lambda: merge_days("stg_payment_events", arrived, ["event_id"]), first_bucket,
            lambda: touched("customer_id"), lambda: touched("merchant_id"))

        def other_days(name: str, column: str) -> DataFrame:
            known = [p.removeprefix(f"{DAY}=") for p in days if p != day_part(None)]
            return table(name).filter(~F.coalesce(F.col(column).cast("string").isin(known), F.lit(day_part(None) in days)))

        def of_customers() -> None:
            customers = refreshed("int_payment_customer_metrics", I.CUSTOMER, "customer")
            dim_customer = dimension("dim_customer", "customer_id", customers, K.dim_customer)
            models.put("feat_customer_features", X.feat_customer(customers, as_of))
            models.put("analytics_customer_segments", A.customer_segments(dim_customer.filter("is_current")))

        def of_merchants() -> None:
            merchants = refreshed("int_payment_merchant_metrics", I.MERCHANT, "merchant")
            dimension("dim_merchant", "merchant_id", merchants, K.dim_merchant)
            models.put("feat_merchant_features", X.feat_merchant(merchants, as_of))

        def of_days() -> None:
            touched_days = I.int_daily_summary(table("stg_payment_events", days))
            daily = models.put("int_payment_daily_summary", other_days("int_payment_daily_summary", DAY).unionByName(touched_days))
            models.put("fct_daily_payments", K.fct_daily_payments(daily, as_of))

        def of_facts() -> None:
            merge_days("fct_payments", K.fct_payments(arrived, as_of), ["payment_key"])
            trends = models.put(TREND_DAYS, other_days(TREND_DAYS, "date_key").unionByName(A.trend_days(table("fct_payments", days))))
            models.put("analytics_payment_trends", A.trends_of(trends, table("dim_date"), as_of, trends_from))

        def intervals(name: str, model: Callable[..., DataFrame]) -> None:
            # The edge's day is written whole: its buckets before the edge come from the table.
            redone = [p for p in models.parts(name) if p >= day_part(edge.date()) and p != day_part(None)]
            kept = table(name, redone).filter(F.col("interval_start") < F.lit(edge))
            models.put(name, kept.unionByName(model(stg, edge).select(*kept.columns)), DAY, instead_of=redone)

        side_by_side(spark, of_facts, of_customers, of_merchants, of_days, *[functools.partial(intervals, *item) for item in INTERVALS.items()])
        publish(models, max(mark, high_water(arrived, "ingested_at")))
    return {name: table(name) for name in MODELS}
