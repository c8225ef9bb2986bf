"""High-water marks and incremental filters."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def high_water(table: DataFrame, column: str):
    """Newest value of a column, as one scalar. None for an empty table."""
    return table.agg(F.max(column)).first()[0]


def newer_than(df: DataFrame, column: str, mark, overlap: timedelta = timedelta(0)) -> DataFrame:
    """Rows from the mark on, less the overlap. The bound is a literal, so the filter reaches the scan.

    Rows with the mark's own time may have been committed after it was taken, and slow writers commit older
    ones; so the mark is included, and the reader must tolerate rows it has seen.
    """
    return df if mark is None else df.filter(F.col(column) >= F.lit(mark - overlap))


def reread_from(table: DataFrame, column: str = "interval_end", lookback_minutes: int = 30):
    """Bucket edge from which an interval table is rebuilt; None means rebuild everything."""
    newest = high_water(table, column)
    return None if newest is None else newest - timedelta(minutes=lookback_minutes)


def replace_from(table: DataFrame, rebuilt: DataFrame, column: str, edge) -> DataFrame:
    """Old rows before the edge plus the rebuilt rows from the edge on."""
    if edge is None:
        return rebuilt
    return table.filter(F.col(column) < F.lit(edge)).unionByName(rebuilt)
