"""One row per key in the exchange that lays rows out, for nearly all rows.

Deduplicating by key and then ordering by month and id moves every row twice. Lines of a key that
are of one month meet in the second exchange anyway, so only ids with lines in several months need the
first. Which ids these are, bitmaps of ids per month tell, at a fraction of the rows' bytes. These
ids are settled apart, and so are ids with very many lines in a month, because ``keep_max`` cuts a
key to one row per task before it moves it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll import storage
from tillroll.operators.cleansing import keep_max
from tillroll.schema import PERIOD, STORED_KEYS, STORED_QUANTITY
from tillroll.sinks import key_index

PLACE = (*PERIOD, *STORED_KEYS)
HOT_ROWS = 100_000  # lines of one month that 64 neighbouring ids may have before they are settled apart
APART_WORDS = 1 << 21  # bitmaps that are broadcast at most; beyond that all rows are settled first


def line_words(rows: DataFrame) -> DataFrame:
    """``word, bits, n_lines`` of the rows' ids per month."""
    return key_index.id_words(rows, *PERIOD, counted=True)


def apart_words(words: DataFrame) -> DataFrame:
    """``word, bits`` of the ids in several months, or with too many lines, from words per month."""
    none = F.lit(0).cast("long")
    several = F.aggregate(
        F.collect_list("bits"),
        F.struct(none.alias("once"), none.alias("again")),
        lambda seen, bits: F.struct(
            seen.once.bitwiseOR(bits).alias("once"),
            seen.again.bitwiseOR(seen.once.bitwiseAND(bits)).alias("again"),
        ),
        lambda seen: seen.again,
    )
    hot = F.max("n_lines") > HOT_ROWS
    found = words.filter("word IS NOT NULL").groupBy("word").agg(F.when(hot, -1).otherwise(several).alias("bits"))
    return found.filter("bits != 0")


def few_words(words: DataFrame, path: str) -> DataFrame | None:
    """Bitmaps stored at ``path``; None if they are too many to be broadcast."""
    kept = storage.stored(words, path)
    return kept if kept.count() <= APART_WORDS else None


def split_by_id(rows: DataFrame, words: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose id is in the bitmaps, or that have none, and the others; without bitmaps, no others."""
    if words is None:
        return rows, None
    word, bit = key_index.place_of(F.col(STORED_KEYS[0]))
    own = F.broadcast(words.select(F.col("word").alias("_word"), F.col("bits").alias("_bits")))
    marked = rows.withColumns({"_place": word, "_bit": bit}).join(own, F.col("_place") == F.col("_word"), "left")
    named = F.col(STORED_KEYS[0]).isNull() | (F.coalesce("_bits", F.lit(0)).bitwiseAND(F.col("_bit")) != 0)
    return marked.filter(named).select(*rows.columns), marked.filter(~named).select(*rows.columns)


def clustered(rows: DataFrame) -> DataFrame:
    """Tasks are ranges of month, id and product, in this order."""
    return rows.repartitionByRange(*PLACE).sortWithinPartitions(*PLACE)


def settled(rows: DataFrame, words: DataFrame, scratch: str) -> DataFrame:
    """``clustered(keep_max(rows))``, for rows with the given words per month (more do no harm)."""
    few, most = split_by_id(rows, few_words(apart_words(words), scratch))
    few = keep_max(few, STORED_KEYS, STORED_QUANTITY)
    if most is None:
        return clustered(few)
    moved = most.unionByName(few).repartitionByRange(*PLACE)
    # Ranges keep the lines of a key and month together: no exchange, and the rows end in order.
    return keep_max(moved, PLACE, STORED_QUANTITY)
