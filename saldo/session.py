"""Session settings and the shared scratch location."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Tables are written with times as 64-bit numbers: smaller and faster than Spark's default, twelve bytes without the
# minima and maxima that a time filter skips row groups by.
TIMES = {"spark__sql__parquet__outputTimestampType": "TIMESTAMP_MICROS"}


def recommended(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings the operators are planned for. Cluster sizing stays with the cluster."""
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # Recording the Python line of every expression dominates the build time of wide plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
    )


@contextlib.contextmanager
def settings(spark: SparkSession, **values: object):
    """Session settings for a block, named with `__` for each dot; what was set before returns at its end."""
    names = {name.replace("__", "."): str(value) for name, value in values.items()}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def side_by_side(spark: SparkSession, *parts: Callable[[], object], most: int = 4) -> list:
    """Runs parts that do not need each other's results, up to so many at once, and returns their results: one's jobs use cores another leaves idle.

    The first error ends the others: their running jobs are cancelled, parts that have not begun are left out, and it
    is raised once all running parts have ended.
    """
    context, tag = spark.sparkContext, f"side-by-side-{uuid.uuid4().hex[:12]}"

    def tagged(part: Callable[[], object]) -> object:
        context.addJobTag(tag)
        return part()

    with ThreadPoolExecutor(most) as pool:
        runs = [pool.submit(inheritable_thread_target(spark)(functools.partial(tagged, part))) for part in parts]  # with the caller's job group
        wait(runs, return_when=FIRST_EXCEPTION)
        error = next((e for e in (run.exception() for run in runs if run.done()) if e is not None), None)
        for run in runs:
            run.cancel()
        while wait(runs, timeout=0.2 if error else None).not_done:  # a part between two jobs begins its next one
            context.cancelJobsWithTag(tag)
    if error is not None:
        raise error
    return [run.result() for run in runs]


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach. Only a local session may fall back to a temp folder."""
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="saldo-")
    spark.conf.set(CHECKPOINT_CONF, local)
    return local


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path; none if it does not exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(target):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(target) if s.isDirectory())


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextlib.contextmanager
def workspace(spark: SparkSession, label: str):
    """A `keep(name, df)` that writes below one scratch folder, cut by columns if named; the folder is deleted at the end."""
    root = scratch(spark, label)

    def keep(name: str, df: DataFrame, *cut: str) -> DataFrame:
        path = f"{root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.partitionBy(*cut).parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield keep
    finally:
        delete(spark, root)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back: cuts lineage durably and lets several consumers share one computation."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
