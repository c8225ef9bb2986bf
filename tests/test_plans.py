import os
import re
import shutil
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from saldo.plans import analytics as A
from saldo.plans import batch as B
from saldo.plans import intermediate as I
from saldo.plans import marts as K
from saldo.plans.staging import stg_payment_events
from saldo.session import shared_dir
from saldo.sources import bronze as S
from saldo.sources.published import Version
from workload import adapters as W

AUDIT = {"dw_created_at", "dw_updated_at", "valid_from", "valid_to", "feature_timestamp"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_incremental_build_equals_a_full_one(spark, sf, tmp_path):
    """Two increments, the second of them run twice, against one full build."""
    bronze = W.bronze(spark, sf)
    cuts = [F.col("ingested_at") < F.lit(t).cast("timestamp") for t in ("2024-01-20 10:07:00", "2024-01-20 18:00:00", "2025-01-01")]
    paths = [str(tmp_path / f"b{i}") for i in range(3)]
    for cut, path in zip(cuts, paths, strict=True):
        bronze.filter(cut).write.parquet(path)
    grown = str(tmp_path / "grown")
    B.run_batch(spark, paths[0], grown, W.AS_OF)
    day_of = lambda f: re.search(r"event_date=([0-9-]+)", f).group(1)
    old_days = [f for f in spark.read.parquet(f"{grown}/fct_payments").inputFiles() if day_of(f) < "2024-01-20"]
    for path in (paths[1], paths[2], paths[2]):
        step = B.run_incremental(spark, path, grown, W.AS_OF)
    assert set(old_days) <= set(step["fct_payments"].inputFiles()), "untouched days keep their files"
    full = B.run_batch(spark, paths[2], str(tmp_path / "full"), W.AS_OF)
    assert set(step) == set(full) == set(B.MODELS)
    for name, want in full.items():
        cols = [c for c in want.columns if c not in AUDIT]
        got = sorted(map(str, step[name].select(cols).collect()))
        assert got == sorted(map(str, want.select(cols).collect())), name


def test_increment_finds_ties_and_late_rows_and_rewrites_only_what_they_touch(spark, sf, tmp_path):
    import datetime as dt

    bronze, source, out = W.bronze(spark, sf), str(tmp_path / "bronze"), str(tmp_path / "out")
    S.append_bronze(bronze.unionByName(bronze.filter("amount_cents % 3 = 0")), source)
    first = B.run_batch(spark, source, out, W.AS_OF)
    total = bronze.select("event_id").distinct().count()
    assert first["stg_payment_events"].count() == first["fct_payments"].count() == total
    mark = bronze.agg(F.max("ingested_at")).first()[0]
    someone = bronze.filter("customer_id IS NOT NULL").orderBy("event_id").limit(1)
    name = someone.first()["customer_id"]
    for k, late in enumerate((0, 50)):
        new = someone.withColumn("event_id", F.lit(f"late-{k}")).withColumn("ingested_at", F.lit(mark - dt.timedelta(minutes=late)))
        S.append_bronze(new, source)
        shared = Path(shared_dir(spark))
        left = set(shared.iterdir())
        step = B.run_incremental(spark, source, out, f"2024-07-0{k + 1} 00:00:00")
        assert step["stg_payment_events"].count() == step["fct_payments"].count() == total + k + 1
        changed = step["dim_customer"].filter(F.col("valid_from") != F.lit(W.AS_OF).cast("timestamp")).collect()
        assert [r["customer_id"] for r in changed] == [name]
        assert set(shared.iterdir()) == left, "what was written aside is deleted"
    full = B.run_batch(spark, source, str(tmp_path / "full"), "2024-07-02 00:00:00")
    for model, want in full.items():
        cols = [c for c in want.columns if c not in AUDIT]
        assert sorted(map(str, step[model].select(cols).collect())) == sorted(map(str, want.select(cols).collect())), model


def test_increment_keeps_history_when_asked(spark, sf, tmp_path):
    bronze, source, out = W.bronze(spark, sf), str(tmp_path / "bronze"), str(tmp_path / "out")
    cut = F.lit("2024-01-25 00:00:00").cast("timestamp")
    S.append_bronze(bronze.filter(F.col("ingested_at") < cut), source)
    before = {r["customer_id"]: r["total_transactions"] for r in B.run_batch(spark, source, out, W.AS_OF)["dim_customer"].collect()}
    S.append_bronze(bronze.filter(F.col("ingested_at") >= cut), source)
    dim = B.run_incremental(spark, source, out, "2024-07-01 00:00:00", history=True)["dim_customer"].collect()
    closed = {r["customer_id"]: r["total_transactions"] for r in dim if not r["is_current"]}
    assert closed and all(before[k] == n for k, n in closed.items())
    current = {r["customer_id"]: r["total_transactions"] for r in dim if r["is_current"]}
    assert sum(current.values()) == bronze.filter("customer_id IS NOT NULL").count()


def test_increment_reads_only_recent_days_of_bronze(spark, sf, tmp_path):
    import datetime as dt

    source = str(tmp_path / "bronze")
    S.append_bronze(W.bronze(spark, sf), source)
    rows = stg_payment_events(B.bronze_since(spark, source, dt.datetime(2024, 1, 20)), dt.datetime(2024, 1, 20))
    assert "ingested_date" in re.search(r"PartitionFilters: \[(.*?)\]", plan_of(rows)).group(1)


def test_scheduled_job_runs_from_the_row_store(spark, sf, tmp_path):
    store, paths = W.row_store(spark, sf), [str(tmp_path / n) for n in ("bronze", "ledger", "out")]
    wanted = store.filter("NOT loaded_to_iceberg")
    parts = wanted.filter("id % 2 = 0"), wanted
    for part in parts:
        for _ in range(2):
            got = B.run_pipeline(spark, part, *paths, W.AS_OF)
            assert got["fct_payments"].count() == part.count()


def test_facts_are_cut_by_day_and_prune(spark, sf, tmp_path):
    path = str(tmp_path / "facts")
    facts = Version(spark, path).put("facts", B.with_day(K.fct_payments(stg_payment_events(W.bronze(spark, sf)), W.AS_OF)), B.DAY)
    one = facts.filter("event_date = DATE '2024-01-05'").select("amount_cents")
    plan = plan_of(one)
    assert "event_date" in re.search(r"PartitionFilters: \[(.*?)\]", plan).group(1)
    assert "ReadSchema: struct<amount_cents:bigint>" in plan


def test_interval_scans_are_pruned_and_pushed(spark, sf):
    stg = stg_payment_events(W.bronze(spark, sf))
    plan = plan_of(A.risk_overview(stg, edge=None))
    assert "IsNotNull(ingested_at)" in plan and "failure_message" not in re.search(r"ReadSchema: (.*)", plan).group(1)
    assert plan.count("Exchange") == 1
    import datetime as dt
    late = plan_of(A.risk_overview(stg, edge=dt.datetime(2024, 1, 20)))
    assert "GreaterThanOrEqual(ingested_at,2024-01-20" in late


def test_measures_do_not_travel_with_distinct_values(spark, sf):
    plan = plan_of(I.int_customer_metrics(stg_payment_events(W.bronze(spark, sf))))
    assert "Cartesian" not in plan and "BroadcastNestedLoop" not in plan
    widest = [p for p in plan.splitlines() if "hashpartitioning(customer_id" in p and "which" in p]
    assert widest, "distinct values are shuffled by value"


def test_windowed_features_shuffle_events_once(spark, sf):
    from saldo.plans import features as X

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(X.feat_customer_windowed(stg_payment_events(W.bronze(spark, sf)), "2024-01-25 00:00:00"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("FileScan") == 2 and plan.count("Exchange") <= 5


def test_windowed_features_of_a_customer_cut_into_ranges(spark, sf):
    from saldo.plans import features as X

    stg = stg_payment_events(W.bronze(spark, sf)).withColumn("customer_id", F.lit("hot"))
    one, many = (X.feat_customer_windowed(stg, "2024-01-25 00:00:00", parts).collect() for parts in (1, 13))
    assert one == many and len(one) == 1 and one[0]["recovered_payments_30d"] > 0


def test_projections_do_not_shuffle(spark, sf):
    from saldo.operators import enrich as E
    from saldo.operators import split as P

    stg = stg_payment_events(W.bronze(spark, sf))
    assert "Exchange" not in plan_of(K.fct_payments(stg, W.AS_OF))
    ok, bad = P.split(W.stream_table(spark, sf, "charges"), "charges")
    assert "Exchange" not in plan_of(ok) + plan_of(bad)
    assert "Exchange" not in plan_of(E.to_bronze(E.enrich(W.unified(spark, sf)), F.lit(W.AS_OF).cast("timestamp")))


def test_payloads_are_parsed_once(spark, sf):
    from saldo.operators import normalize as N

    plan = plan_of(N.judge(W.raw_messages(spark, sf), F.lit(W.AS_OF).cast("timestamp")))
    assert plan.count("from_json(") == 4 and "Exchange" not in plan
    assert all("topic" in f for f in re.findall(r"PartitionFilters: \[(.*?)\]", plan))


def test_dim_date_pins(spark):
    row = K.dim_date(spark).filter("date_key = DATE '2021-01-01'").first()
    assert (row["iso_year_week"], row["day_name"], row["day_of_week"], row["is_weekend"]) == ("2021-W53", "Friday", 5, False)


def test_imports_need_no_session():
    root = Path(__file__).resolve().parent.parent
    code = "import __spark_entry__ as e; q = e.queries(); o = e.oracle_sql(); assert set(o) <= set(q) and len(q) > 150"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root)


def test_imports_without_the_text_operators(tmp_path):
    root = Path(__file__).resolve().parent.parent
    for name in ("saldo", "workload"):
        shutil.copytree(root / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q) and len(q) > 150 and not any(n.startswith('op') for n in q)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0 and "interval_key" in df.columns
