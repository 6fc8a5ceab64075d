"""Monthly totals, and sketches of distinct values, kept beside the table and renewed by the
writes themselves.

A state file names the folder with the totals, one row per month, and the months whose totals are
stale. A write marks its months before it touches the table and renews them from the table after it,
so whatever dies in between, the totals of a month are either right or known to be stale;
stale months are added up from the table when they are asked for.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tillroll import storage
from tillroll.operators.totals import SKETCHES, TOTALS, monthly_summary
from tillroll.sources.files import literal_path

Month = tuple[int | None, int | None]
_SCHEMA = f"year int, month int, {TOTALS}, {SKETCHES}"


def _state_path(table_path: str) -> str:
    return storage.beside(table_path, "totals.json")


def state(spark: SparkSession, table_path: str) -> dict | None:
    """What is kept for the table, or None if totals are not kept (any more)."""
    text = storage.read_text(spark, _state_path(table_path))
    return None if text is None else json.loads(text)


def _save(spark: SparkSession, table_path: str, folder: str, stale: Iterable[Month]) -> None:
    marked = sorted({tuple(m) for m in stale}, key=repr)
    text = json.dumps({"folder": folder, "stale": marked})
    storage.write_text(spark, _state_path(table_path), text)


def make_void(spark: SparkSession, table_path: str) -> None:
    """The whole table is about to change: totals are kept again once they are asked for."""
    storage.delete(spark, _state_path(table_path))


def mark_stale(spark: SparkSession, table_path: str, months: Iterable[Row]) -> bool:
    """A write is about to change these months. False if no totals are kept."""
    kept = state(spark, table_path)
    if kept is None:
        return False
    stale = [*map(tuple, kept["stale"]), *[(m.year, m.month) for m in months]]
    _save(spark, table_path, kept["folder"], stale)
    return True


def _of(months: Iterable[Month]) -> Column:
    """On the partition columns, so that other months' files are not read."""
    test = F.lit(False)
    for year, month in months:
        test = test | (F.col("year").eqNullSafe(F.lit(year)) & F.col("month").eqNullSafe(F.lit(month)))
    return test


def totals(spark: SparkSession, table_path: str, table: DataFrame) -> DataFrame:
    """``year, month`` and their totals: kept ones, and stale months from the table itself."""
    kept = state(spark, table_path)
    if kept is None:
        return monthly_summary(table)
    rows = spark.read.schema(_SCHEMA).parquet(literal_path(kept["folder"]))
    stale = [tuple(m) for m in kept["stale"]]
    if not stale:
        return rows
    return rows.filter(~_of(stale)).unionByName(monthly_summary(table.filter(_of(stale))))


def renew(spark: SparkSession, table_path: str, table: DataFrame) -> None:
    """Store the totals as they are now; the table is read for stale months only."""
    old = state(spark, table_path)
    folder = storage.beside(table_path, f"totals-{storage.fresh_name()}")
    # A row per month: one small file.
    totals(spark, table_path, table).coalesce(1).write.parquet(folder)
    _save(spark, table_path, folder, [])
    if old is not None:
        storage.delete(spark, old["folder"])
