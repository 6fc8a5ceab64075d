"""Which months hold which order ids: exact bitmaps per month, kept beside the table.

A row of the index is 64 neighbouring ids of a month, one bit each. Ids that rise over time make
nearly full words, and few of them per month; scattered ids make more words, still a fraction of the
key columns. A merge asks the index which months hold one of its ids and reads the keys of those only.

The index may name ids a month no longer holds, never the other way round: that would lose a
duplicate. So it is filled before rows are appended, replaced with a merge's months under the
merge's note, and void after any other write, until the next merge fills it again from the id column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tillroll import storage
from tillroll.schema import PERIOD, STORED_KEYS
from tillroll.sources.files import literal_path

_WORD = 6  # bits of an id that tell its place within a word
_SCHEMA = "word long, bits long, year int, month int"


def index_path(table_path: str) -> str:
    return storage.beside(table_path, "order_ids")


def _ready_path(table_path: str) -> str:
    return storage.beside(table_path, "order_ids_ready")


def place_of(id_: Column) -> tuple[Column, Column]:
    """The word of an order id, and its bit in it."""
    place = id_.bitwiseAND((1 << _WORD) - 1).cast("int")
    return F.shiftright(id_, _WORD), F.call_function("shiftleft", F.lit(1).cast("long"), place)


def id_words(rows: DataFrame, *by: str, counted: bool = False) -> DataFrame:
    """``word, bits`` of the order ids, per group of ``by``, and the ``n_lines`` of them if
    ``counted``; combined before the shuffle."""
    word, bit = place_of(F.col(STORED_KEYS[0]))
    counts = [F.count(F.lit(1)).alias("n_lines")] if counted else []
    return rows.groupBy(word.alias("word"), *by).agg(F.bit_or(bit).alias("bits"), *counts)


def read_index(spark: SparkSession, table_path: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(literal_path(index_path(table_path)))


def is_ready(spark: SparkSession, table_path: str) -> bool:
    return storage.exists(spark, _ready_path(table_path))


def make_void(spark: SparkSession, table_path: str) -> None:
    """The table was written past the index."""
    storage.delete(spark, _ready_path(table_path))


def _write(words: DataFrame, table_path: str, mode: str, replace: str = "static") -> None:
    ordered = words.hint("rebalance", *[F.col(c) for c in PERIOD]).sortWithinPartitions(*PERIOD, "word")
    writer = ordered.write.mode(mode).option("partitionOverwriteMode", replace)
    writer.partitionBy(*PERIOD).parquet(index_path(table_path))


def fill(table: DataFrame, table_path: str) -> None:
    """Index all rows of the table: one scan of its id column."""
    _write(id_words(table, *PERIOD), table_path, "overwrite")
    storage.write_text(table.sparkSession, _ready_path(table_path), "")


def add(rows: DataFrame, table_path: str) -> None:
    """Add the ids of rows that are about to be appended."""
    _write(id_words(rows, *PERIOD), table_path, "append")


def replace_months(rows: DataFrame, table_path: str) -> None:
    """Index the months of ``rows`` anew. Months left without rows keep their bits, at the cost
    of a look at a month that is no longer there."""
    _write(id_words(rows, *PERIOD), table_path, "overwrite", "dynamic")


def months_holding(spark: SparkSession, table_path: str, rows: DataFrame) -> Sequence[Row]:
    """``year, month, low, high``: months with an order id of ``rows``, and the range in which
    they share ids. One row per month comes to the driver."""
    index = read_index(spark, table_path)
    wanted = id_words(rows).withColumnRenamed("bits", "wanted")
    shared = index.join(wanted, "word").filter(F.col("bits").bitwiseAND(F.col("wanted")) != 0)
    first, last = F.min("word"), F.max("word")
    low = F.call_function("shiftleft", first, F.lit(_WORD))
    high = F.call_function("shiftleft", last, F.lit(_WORD)) + ((1 << _WORD) - 1)
    return shared.groupBy(*PERIOD).agg(low.alias("low"), high.alias("high")).collect()
