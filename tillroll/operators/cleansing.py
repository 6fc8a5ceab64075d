"""Row cleansing: key filter, deduplication, date parsing, naming."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tillroll.functions.dates import parse_order_date, period_columns
from tillroll.functions.ordering import survivor_order
from tillroll.schema import (
    CORRUPT,
    KEYS,
    ORDER_DATE,
    ORDER_ID,
    QUANTITY,
    SOURCE_SCHEMA,
    STORED_NAMES,
)


def remove_nulls(df: DataFrame, key: str = ORDER_ID) -> DataFrame:
    """Rows that have a key. Blank lines and repeated header lines have none."""
    return df.filter(F.col(key).isNotNull())


def rejected_rows(df: DataFrame, column: str = ORDER_ID) -> DataFrame:
    """Rows in which ``column`` is NULL: what ``remove_nulls`` takes out."""
    return df.filter(F.col(column).isNull())


def key_lookup(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Rows equal to every given value."""
    for name, value in values.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def exact_distinct(df: DataFrame) -> DataFrame:
    """One of each set of rows equal in every column."""
    return df.dropDuplicates()


def keep_max(
    df: DataFrame, keys: Sequence[str] = KEYS, measure: str = QUANTITY
) -> DataFrame:
    """One row per key: the one with the largest measure, under ``survivor_order``.

    The rank filter lets Spark cut every map task to one row per key *before* the only
    exchange (``WindowGroupLimit``), so a key that holds a third of the table sends one row
    per map task, not its rows.
    """
    # A name the caller cannot already have: with a fixed one, a column of that name is lost.
    rank = "_survivor_rank"
    while rank in df.columns:
        rank += "_"
    window = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(
        *survivor_order(df.schema, keys, measure)
    )
    return (
        df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)
    )


def remove_duplicates(
    df: DataFrame, keys: Sequence[str] = KEYS, measure: str = QUANTITY
) -> DataFrame:
    """Full-row distinct followed by keep-max, in one exchange.

    Exact copies share a key and tie in every column of the survivor order, so keeping one
    row per key removes them too. A distinct in front would cost a second shuffle on all
    columns and change nothing.
    """
    return keep_max(df, keys, measure)


def parse_dates(df: DataFrame, column: str = ORDER_DATE) -> DataFrame:
    """Replace the raw date text by its timestamp."""
    return df.withColumn(column, parse_order_date(column))


def add_period(df: DataFrame, date: str = ORDER_DATE) -> DataFrame:
    """Add ``year`` and ``month``."""
    return df.withColumns(period_columns(date))


def rename_columns(df: DataFrame, names: Mapping[str, str] = STORED_NAMES) -> DataFrame:
    """Stored column names; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(names))


def uncastable(df: DataFrame, schema: T.StructType = SOURCE_SCHEMA) -> DataFrame:
    """Add ``uncastable``: does a line hold a value that is not of its column's type?

    The reader keeps the text of every line it could not read in full. Lines that are only
    too short or too long are in there as well; they are usable and not marked. Only those
    few lines are split again here.
    """
    # An empty or missing field reads as NULL both times.
    line = F.from_csv(F.col(CORRUPT), ", ".join(f"`{c}` string" for c in schema.fieldNames()))
    typed = [f.name for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    bad = F.lit(False)
    for name in typed:
        bad = bad | (line[name].isNotNull() & F.col(name).isNull())
    return df.withColumn("uncastable", F.when(F.col(CORRUPT).isNull(), False).otherwise(bad))


def shaped(df: DataFrame) -> DataFrame:
    """Source rows with a key in the form of cleansed rows, all lines of a key still there."""
    return (
        df.transform(remove_nulls)
        .transform(parse_dates)
        .transform(add_period)
        .transform(rename_columns)
    )


def cleanse(df: DataFrame) -> DataFrame:
    """Source rows to cleansed rows: the whole chain, one exchange.

    Dates are parsed first because the survivor order compares dates, not texts; which of
    several equal-date texts survives cannot be seen in the result.
    """
    return (
        df.transform(remove_nulls)
        .transform(parse_dates)
        .transform(remove_duplicates)
        .transform(add_period)
        .transform(rename_columns)
    )
