"""Joins of wide rows with few keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of the filter: 16 million, at most 2 MB, whatever the number of keys.
FILTER_BITS = 24
_WORD = 6  # bits of the position within a 64-bit word


def _position(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(5)), 64 - FILTER_BITS)


def _with_filter(rows: DataFrame, keys: DataFrame, key: str, how: str) -> tuple[DataFrame, Column]:
    """The rows joined with a bitmap of the keys' hashes, and whether a row's key is in it."""
    at = _position(F.col(key))
    word, bit = F.shiftrightunsigned(at, _WORD), (at % (1 << _WORD)).cast("int")
    bits = keys.groupBy(word.alias("_filter_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_filter_bits")
    )
    joined = rows.join(F.broadcast(bits), word == F.col("_filter_word"), how)
    return joined, F.coalesce(F.getbit("_filter_bits", bit), F.lit(0)) == 1


def likely_rows(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """All rows whose ``key`` is among ``keys``, and few others, found where they lie.

    A bitmap of the keys' hashes, of fixed size, goes to all tasks. With very many keys it leaves
    out less; an exact join has to follow.
    """
    likely, found = _with_filter(rows, keys, key, "inner")
    return likely.filter(found).select(*rows.columns)


def unlikely_rows(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The other rows than ``likely_rows`` gives: their ``key`` is certainly not among ``keys``."""
    joined, found = _with_filter(rows, keys, key, "left")
    return joined.filter(~found).select(*rows.columns)


def rows_with_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is among ``keys``; texts of other rows are mostly not shuffled."""
    return likely_rows(rows, keys, key).join(keys, key, "left_semi")
