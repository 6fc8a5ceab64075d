"""Reports over the cleansed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.totals import added_up, estimated_distinct, line_totals, monthly_totals
from tillroll.sinks import totals
from tillroll.sources.tables import read_table

Month = tuple[int, int]


def in_period(since: Month | None = None, until: Month | None = None) -> Column:
    """Rows of months ``since`` to ``until``, both included; on the partition columns only."""
    test = F.lit(True)
    if since is not None:
        year, month = since
        test = test & (
            (F.col("year") > year) | ((F.col("year") == year) & (F.col("month") >= month))
        )
    if until is not None:
        year, month = until
        test = test & (
            (F.col("year") < year) | ((F.col("year") == year) & (F.col("month") <= month))
        )
    return test


def _within(rows: DataFrame, since: Month | None, until: Month | None) -> DataFrame:
    return rows if since is None and until is None else rows.filter(in_period(since, until))


def monthly_report(
    table: DataFrame, since: Month | None = None, until: Month | None = None
) -> DataFrame:
    """Lines, units and revenue per month; a period prunes the other months' files."""
    revenue = F.col("revenue").cast("decimal(38,2)")
    return monthly_totals(_within(table, since, until)).withColumn("revenue", revenue)


def yearly_report(
    table: DataFrame, since: Month | None = None, until: Month | None = None
) -> DataFrame:
    """Lines, units and revenue per year."""
    rows = _within(table, since, until).groupBy("year").agg(*line_totals())
    return rows.withColumn("revenue", F.col("revenue").cast("decimal(38,2)"))


def keep_totals(spark: SparkSession, table_path: str) -> None:
    """Keep monthly totals beside the table from now on: loads and merges renew those of the
    months they write. A full load ends that, until it is asked for again."""
    totals.renew(spark, table_path, read_table(spark, table_path))


def kept_report(
    spark: SparkSession,
    table_path: str,
    since: Month | None = None,
    until: Month | None = None,
    by: str = "month",
) -> DataFrame:
    """``monthly_report`` (``by="year"``: ``yearly_report``) from the kept totals: a row per month
    is read instead of the table."""
    if by not in ("month", "year"):
        raise ValueError(f"by must be month or year, not {by!r}")
    kept = totals.totals(spark, table_path, read_table(spark, table_path))
    columns = ["year"] if by == "year" else ["year", "month"]
    return added_up(_within(kept, since, until), *columns)


def kept_distinct(
    spark: SparkSession,
    table_path: str,
    since: Month | None = None,
    until: Month | None = None,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """About how many different orders, products and addresses a period has, from the sketches
    kept with the totals: exact counts would shuffle the values. ``by`` may be year and month."""
    kept = totals.totals(spark, table_path, read_table(spark, table_path))
    return estimated_distinct(_within(kept, since, until), *by)
