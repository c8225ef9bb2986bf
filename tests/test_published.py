"""Versions of published tables: what a run that fails leaves behind, for readers and for its repetition."""

import glob
import threading
import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from saldo.plans import batch as B
from saldo.session import delete, exists, side_by_side
from saldo.sources import bronze as S
from saldo.sources import published as V
from workload import adapters as W

AUDIT = {"dw_created_at", "dw_updated_at", "valid_from", "valid_to", "feature_timestamp"}


class Killed(Exception):
    pass


def rows(df):
    return sorted(map(str, df.collect()))


def content(tables):
    return {name: rows(df.select(*[c for c in df.columns if c not in AUDIT])) for name, df in tables.items()}


def killer(after: int):
    """A step that raises once so many tables are written."""
    seen = []

    def step(name):
        seen.append(name)
        if len(seen) == after:
            raise Killed(name)

    return step


def test_values_are_replaced_and_others_keep_their_files(spark, tmp_path):
    root = str(tmp_path)
    make = lambda data: spark.createDataFrame(data, "k int, d date, `run` int")
    import datetime as dt
    one, two, three = (dt.date(2024, 1, d) for d in (1, 2, 3))
    first = V.Version(spark, root)
    first.put("t", make([(1, one, 7), (2, two, 7), (3, None, 7)]).withColumnRenamed("run", "n"), "d")
    first.put("whole", spark.range(3))
    first.publish(mark="a")
    files = set(V.Version(spark, root).read("t", [B.day_part(None).replace(B.DAY, "d"), "d=2024-01-01"]).inputFiles())
    second = V.Version(spark, root)
    assert second.run == 2 and second.notes == {"mark": "a"} and second.parts("t") == ["d=2024-01-01", "d=2024-01-02", f"d={V.NULL}"]
    second.put("t", make([(4, three, 8)]).withColumnRenamed("run", "n"), "d", instead_of=["d=2024-01-02", "d=2024-01-03"])
    assert rows(V.Version(spark, root).read("t").select("k")) == rows(spark.createDataFrame([(1,), (2,), (3,)], "k int")), "not yet published"
    second.publish(mark="b")
    now = V.Version(spark, root).read("t")
    assert now.columns == ["k", "d", "n"] and sorted(map(tuple, now.collect()), key=str) == sorted([(1, one, 7), (3, None, 7), (4, three, 8)], key=str)
    assert files <= set(now.inputFiles())
    assert V.Version(spark, root).read("whole").count() == 3
    with pytest.raises(ValueError, match="not to be replaced"):
        V.Version(spark, root).put("t", make([(5, one, 9)]).withColumnRenamed("run", "n"), "d", instead_of=["d=2024-01-02"])
    none = V.Version(spark, root).put("t", now.limit(0), "d", instead_of=V.Version(spark, root).parts("t"))
    assert none.columns == now.columns and none.count() == 0


def test_old_versions_are_deleted_and_shared_folders_kept(spark, tmp_path):
    root = str(tmp_path)
    for k in range(5):
        v = V.Version(spark, root)
        v.put("t", spark.range(10).selectExpr("id", f"{k} AS k", "id % 5 AS d").filter(f"d = {k} OR {k} = 0"), "d", None if k == 0 else [f"d={k}"])
        v.put("whole", spark.range(k))
        v.publish()
    assert V.versions(spark, root) == [4, 5]
    assert rows(V.Version(spark, root).read("t").select("d", "k").distinct()) == rows(spark.range(5).selectExpr("id AS d", "CAST(id AS int) AS k"))
    assert {p.name for p in (Path(root) / "whole").iterdir() if p.name.startswith("run=")} == {"run=00000004", "run=00000005"}
    # A run that fails while it deletes is finished by the next one.
    v = V.Version(spark, root)
    v.clean = lambda: (_ for _ in ()).throw(Killed())
    v.put("whole", spark.range(9))
    with pytest.raises(Killed):
        v.publish()
    assert V.versions(spark, root) == [4, 5, 6] and V.Version(spark, root).read("whole").count() == 9
    v = V.Version(spark, root)
    v.put("whole", spark.range(8))
    v.publish()
    assert V.versions(spark, root) == [6, 7]


def test_increment_killed_at_any_point(spark, sf, tmp_path, monkeypatch):
    """Between tables, inside a write, and while the pointer is written; then repeated, against a full build."""
    source, out = str(tmp_path / "bronze"), str(tmp_path / "out")
    bronze = W.bronze(spark, sf)
    # Late rows of one customer, on days in the middle, and all rows of the last days.
    late = F.col("customer_id").isin([r[0] for r in bronze.select("customer_id").distinct().orderBy(F.desc("customer_id")).limit(1).collect()])
    late |= F.col("ingested_at") >= F.lit("2024-01-29 10:07:00").cast("timestamp")
    S.append_bronze(bronze.filter(~F.coalesce(late, F.lit(False))), source)
    B.run_batch(spark, source, out, W.AS_OF)
    S.append_bronze(bronze.filter(late), source)
    since = bronze.agg(F.min("ingested_at")).first()[0]
    run = lambda **more: B.run_incremental(spark, source, out, W.AS_OF, since=since, **more)
    before = content(B.published(spark, out))
    plain, publish = V.Version.put, V.Version.publish

    def put(self, name, df, *more, **named):
        if name == "int_payment_merchant_metrics":  # some tasks of the write succeed, others do not
            lost = F.when(F.rand(1) < 0.2, F.raise_error(F.lit("lost")).cast(df.dtypes[0][1]))
            df = df.withColumn(df.columns[0], lost.otherwise(F.col(df.columns[0])))
        return plain(self, name, df, *more, **named)

    def unfinished(self, **notes):  # the pointer is written, its _SUCCESS is not
        self.clean = lambda: None
        publish(self, **notes)
        delete(spark, f"{out}/{V.POINTER}/{V.folder(self.run)}/_SUCCESS")
        raise Killed

    for after in (1, 12):
        with pytest.raises(Killed):
            run(step=killer(after))
        assert V.versions(spark, out) == [1]
    assert content(B.published(spark, out)) == before
    with monkeypatch.context() as m:
        m.setattr(V.Version, "put", put)
        with pytest.raises(PySparkException):
            run()
    with monkeypatch.context() as m:
        m.setattr(V.Version, "publish", unfinished)
        with pytest.raises(Killed):
            run()
    assert content(B.published(spark, out)) == before
    run()
    assert V.versions(spark, out) == [1, 2]
    assert content(B.published(spark, out)) == content(B.run_batch(spark, source, str(tmp_path / "full"), W.AS_OF)) != before


def test_scheduled_job_killed_before_and_after_publishing(spark, sf, tmp_path, monkeypatch):
    paths = [str(tmp_path / n) for n in ("bronze", "ledger", "out")]
    wanted = W.row_store(spark, sf).filter("NOT loaded_to_iceberg")
    for part, after in ((wanted.filter("id % 2 = 0"), 2), (wanted, 3)):
        with pytest.raises(Killed):
            B.run_pipeline(spark, part, *paths, W.AS_OF, step=killer(after))
        assert not exists(spark, paths[1]) or spark.read.parquet(paths[1]).count() < part.count(), "ids are filed last"
        got = B.run_pipeline(spark, part, *paths, W.AS_OF)
        for name in ("stg_payment_events", "fct_payments"):
            assert got[name].count() == part.count(), name
        assert got["analytics_payment_intervals"].agg(F.sum("transaction_count")).first()[0] == part.count()
    loaded = spark.read.schema("event_id string").parquet(paths[1])
    assert loaded.count() == wanted.count() and B.run_pipeline(spark, wanted, *paths, W.AS_OF)["fct_payments"].count() == wanted.count()


def test_tables_that_do_not_need_each_other_are_written_at_once(spark, sf):
    """Facts, days, customers and merchants wait for each other: one after the other they would wait in vain."""
    meet = threading.Barrier(4)

    def keep(name, df):
        if name in ("fct_payments", "int_payment_daily_summary", "state_customer_days", "state_merchant_days"):
            meet.wait(60)
        return df

    names = [n.replace("__", ".") for n in B.WRITING]
    before = [spark.conf.get(n) for n in names]
    assert list(B.build(spark, W.bronze(spark, sf), W.AS_OF, keep)) == B.MODELS
    assert [spark.conf.get(n) for n in names] == before


def test_increment_writes_tables_at_once(spark, sf, tmp_path, monkeypatch):
    source, out = str(tmp_path / "bronze"), str(tmp_path / "out")
    bronze, late = W.bronze(spark, sf), F.col("ingested_at") >= F.lit("2024-01-29 10:07:00").cast("timestamp")
    S.append_bronze(bronze.filter(~late), source)
    B.run_batch(spark, source, out, W.AS_OF)
    S.append_bronze(bronze.filter(late), source)
    meet, plain = threading.Barrier(2), V.Version.put

    def put(self, name, *more, **named):
        if name in ("fct_payments", "int_payment_daily_summary"):
            meet.wait(120)
        return plain(self, name, *more, **named)

    monkeypatch.setattr(V.Version, "put", put)
    assert B.run_incremental(spark, source, out, W.AS_OF)["fct_payments"].count() == bronze.count()


def test_side_by_side_ends_running_parts_before_an_error(spark):
    begun, ended = threading.Event(), []

    def slow():
        begun.set()
        time.sleep(0.5)
        ended.append("slow")

    def fails():
        begun.wait(10)
        raise Killed

    with pytest.raises(Killed):
        side_by_side(spark, slow, fails, *[lambda: time.sleep(0.5)] * 2, lambda: ended.append("never"), most=2)
    assert ended[:1] == ["slow"] and "never" not in ended
    assert side_by_side(spark, lambda: 1, lambda: 2) == [1, 2]


def test_side_by_side_cancels_the_jobs_beside_an_error(spark):
    """A part whose job would run for minutes ends with the error, and does not begin its next job."""
    ended, running = [], spark.sparkContext.statusTracker().getActiveJobsIds

    def slow():
        spark.range(10**12).filter("id % 7 = 8").count()
        ended.append("counted")

    def fails():
        until = time.time() + 30
        while not running() and time.time() < until:
            time.sleep(0.05)
        raise Killed

    begun = time.time()
    with pytest.raises(Killed):
        side_by_side(spark, slow, fails)
    assert not ended and time.time() - begun < 60
    assert spark.range(3).count() == 3  # later jobs are not cancelled


def test_times_are_stored_with_their_range(spark, sf, tmp_path):
    """Bronze and models hold times as 64-bit numbers with minima and maxima, so that a time filter skips row groups."""
    source, out = str(tmp_path / "bronze"), str(tmp_path / "out")
    rows = W.bronze(spark, sf).limit(50)
    before = rows.withColumn("event_id", F.lit("old")).withColumn("ingested_at", F.lit("1850-01-01 00:00:00.000001").cast("timestamp")).limit(1)
    S.append_bronze(rows.unionByName(before), source)
    tables = B.run_batch(spark, source, out, W.AS_OF)
    for path in (source, f"{out}/stg_payment_events", f"{out}/fct_payments", f"{out}/dim_customer"):
        for file in glob.glob(f"{path}/**/*.parquet", recursive=True):
            group = pq.ParquetFile(file).metadata.row_group(0)
            columns = [group.column(i) for i in range(group.num_columns)]
            assert "INT96" not in {c.physical_type for c in columns}
            assert all(c.statistics.has_min_max for c in columns if c.path_in_schema == "ingested_at")
    assert tables["stg_payment_events"].filter("event_id = 'old'").select(F.col("ingested_at").cast("string")).first()[0] == "1850-01-01 00:00:00.000001"
