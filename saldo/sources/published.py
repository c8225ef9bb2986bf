"""Tables that are published together: each run writes new folders, then one pointer moves.

A run never changes a file that a published version names. It writes `<root>/<table>/run=<number>`, for a table that is
cut by a column one folder per value below it, and keeps the folders of earlier runs for values it does not
touch. The pointer, one line of JSON below `<root>/_published/run=<number>`, lists for every table its columns and folders;
it is written last and counts once its `_SUCCESS` file exists. A run that fails anywhere before leaves the published
version as it was, for readers and for its own repetition, which takes the same number and overwrites what was left.

The pointer has one entry per table and value, so tables are cut by days or buckets, not by keys. One run at a time may
write below a root. Versions older than the last `KEEP` are deleted, with folders that no kept version names.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from saldo.session import delete, exists, subfolders

POINTER = "_published"
#: Versions that stay readable: the current one and the one before it.
KEEP = 2
#: The folder name of a null value.
NULL = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class Table:
    """Columns, the column it is cut by (None: not cut) and, by value's folder name, the run that wrote it."""

    schema: str
    cut: str | None
    parts: dict[str, int] = field(default_factory=dict)


def folder(run: int) -> str:
    return f"run={run:08d}"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published versions, oldest first."""
    found = [f for f in subfolders(spark, f"{root}/{POINTER}") if f.startswith("run=")]
    return [int(f.removeprefix("run=")) for f in found if exists(spark, f"{root}/{POINTER}/{f}/_SUCCESS")]


def read_pointer(spark: SparkSession, root: str, run: int) -> tuple[dict[str, Table], dict]:
    stored = json.loads(spark.read.text(f"{root}/{POINTER}/{folder(run)}").first()[0])
    return {name: Table(**t) for name, t in stored["tables"].items()}, stored["notes"]


class Version:
    """What is published below a root, and a run's writes on top of it."""

    def __init__(self, spark: SparkSession, root: str, step: Callable[[str], object] | None = None) -> None:
        self.spark, self.root, self.step = spark, root, step
        self.numbers = versions(spark, root)
        self.run = (self.numbers[-1] if self.numbers else 0) + 1
        self.tables, self.notes = read_pointer(spark, root, self.numbers[-1]) if self.numbers else ({}, {})

    def parts(self, name: str) -> list[str]:
        """Folder names of a cut table's values."""
        return sorted(self.tables[name].parts)

    def columns(self, name: str) -> list[str]:
        return T.StructType.fromJson(json.loads(self.tables[name].schema)).names

    def read(self, name: str, parts: Iterable[str] | None = None) -> DataFrame:
        """A table as published, or as this run has written it; of a cut table, if asked, only some values.

        The folders are named one by one, so nothing else is listed.
        """
        table = self.tables[name]
        schema = T.StructType.fromJson(json.loads(table.schema))
        wanted = table.parts if parts is None else [p for p in parts if p in table.parts]
        base = f"{self.root}/{name}"
        paths = [f"{base}/{folder(table.parts[p])}" + (f"/{p}" if table.cut else "") for p in wanted]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)

    def put(self, name: str, df: DataFrame, cut: str | None = None, instead_of: Iterable[str] | None = None,
            laid: bool = False) -> DataFrame:
        """Writes a table into this run's folder and returns it.

        With `instead_of` the rows take the place of these values of a cut table, and other values stay; without it,
        of the whole table. The rebalance keeps files few without gathering a hot value in one task: adaptive execution
        merges small values and splits large ones. Rows that are read from files cut in the same way (`laid`) are not
        dealt again: each task writes the few values it reads.
        """
        path = f"{self.root}/{name}/{folder(self.run)}"
        table = Table(df.schema.json(), cut)
        if cut is None:
            df.write.mode("overwrite").parquet(path)
            table.parts = {"": self.run}
        else:
            (
                (df if laid else df.hint("rebalance", cut)).write.mode("overwrite")
                .option("partitionOverwriteMode", "static").partitionBy(cut).parquet(path)
            )
            gone = set(instead_of) if instead_of is not None else set(self.tables[name].parts if name in self.tables else ())
            kept = {p: run for p, run in self.tables[name].parts.items() if p not in gone} if name in self.tables else {}
            written = [f for f in subfolders(self.spark, path) if f.startswith(f"{cut}=")]
            if clash := kept.keys() & set(written):
                raise ValueError(f"rows of {name} belong to values that were not to be replaced: {sorted(clash)[:3]}")
            table.parts = kept | dict.fromkeys(written, self.run)
        self.tables[name] = table
        if self.step is not None:
            self.step(name)
        return self.read(name)

    def publish(self, **notes) -> None:
        """Moves the pointer to what this run has written, then deletes what nobody needs any more."""
        stored = json.dumps({"tables": {n: vars(t) for n, t in self.tables.items()}, "notes": notes})
        pointer = self.spark.createDataFrame([(stored,)], "value string").coalesce(1)
        pointer.write.mode("overwrite").text(f"{self.root}/{POINTER}/{folder(self.run)}")
        self.numbers.append(self.run)
        self.notes = notes
        self.clean()

    def clean(self) -> None:
        """Deletes versions beyond the last `KEEP`. May fail half-way and be repeated by the next run."""
        old, kept = self.numbers[:-KEEP], self.numbers[-KEEP:]
        named = set()
        for run in kept:
            tables, _ = read_pointer(self.spark, self.root, run)
            named |= {(n, p, r) for n, t in tables.items() for p, r in t.parts.items()}
        for run in old:
            tables, _ = read_pointer(self.spark, self.root, run)
            for name, table in tables.items():
                for part, r in table.parts.items():
                    if (name, part, r) not in named:
                        delete(self.spark, f"{self.root}/{name}/{folder(r)}" + (f"/{part}" if part else ""))
            delete(self.spark, f"{self.root}/{POINTER}/{folder(run)}")
        self.numbers = kept
