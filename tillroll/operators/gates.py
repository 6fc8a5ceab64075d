"""File gate (does a file follow the source contract?) and append gate (does a frame fit?)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.cleansing import uncastable
from tillroll.schema import CORRUPT, SOURCE_SCHEMA, names_and_types
from tillroll.sources.heads import file_headers

GATES = ("header", "strict", "fail")


class SchemaMismatch(ValueError):
    """New rows do not fit the table they should be appended to."""


def _ignores_case(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.caseSensitive") != "true"


def is_header_line(
    line: Column, schema: T.StructType = SOURCE_SCHEMA, ignore_case: bool = True
) -> Column:
    """Is a text line the expected header, its names plain or quoted?"""
    names = ",".join(f'(?:{re.escape(n)}|"{re.escape(n)}")' for n in schema.fieldNames())
    return line.rlike(f"{'(?i)' if ignore_case else ''}^{names}\\r?$")


def is_header(fields: str, spark: SparkSession, schema: T.StructType = SOURCE_SCHEMA) -> Column:
    """Are these fields the schema's names, in order? Case counts as it does for Spark."""
    names, found = schema.fieldNames(), F.col(fields)
    if _ignores_case(spark):
        names, found = [n.lower() for n in names], F.transform(found, F.lower)
    return found == F.array(*[F.lit(n) for n in names])


def inspect_files(
    files: DataFrame, gate: str = "header", schema: T.StructType = SOURCE_SCHEMA
) -> DataFrame:
    """Add ``reason``: why a file may not be loaded, NULL if it may.

    ``header`` and ``strict`` reject files whose header is not the contract's: a read by position
    would silently put values into the wrong columns. Only the heads of the files are read.
    ``fail`` looks at nothing beforehand: the scan stops at a differing header. What ``strict``
    adds, the check of all values, needs the parsed lines: see ``wrong_typed_files``.
    """
    if gate not in GATES:
        raise ValueError(f"gate must be one of {GATES}, not {gate!r}")
    if gate == "fail":
        return files.withColumn("reason", F.lit(None).cast("string"))
    headers = file_headers(files)
    checked = files.join(headers, "file_uri", "left").withColumn(
        "reason",
        F.when(F.col("header").isNull(), "no lines").when(
            ~is_header("header", files.sparkSession, schema), "header differs"
        ),
    )
    return checked.select("path", "file_uri", "length", "modified", "reason")


def wrong_typed(lines: DataFrame, schema: T.StructType = SOURCE_SCHEMA) -> DataFrame:
    """Add ``wrong_typed``: does a line hold a value that is not of its column's type?

    A repeated header line is no line of values.
    """
    again = is_header_line(F.col(CORRUPT), schema, _ignores_case(lines.sparkSession))
    marked = uncastable(lines, schema)
    return marked.withColumn(
        "wrong_typed", F.col("uncastable") & ~F.coalesce(again, F.lit(False))
    ).drop("uncastable")


def wrong_typed_files(lines: DataFrame) -> DataFrame:
    """``file_uri, reason`` of files with such lines, from ``wrong_typed`` lines."""
    bad = lines.filter("wrong_typed").select("file_uri").distinct()
    return bad.withColumn("reason", F.lit("wrong value types"))


def accepted_files(inspected: DataFrame) -> DataFrame:
    return inspected.filter(F.col("reason").isNull()).drop("reason")


def rejected_files(inspected: DataFrame) -> DataFrame:
    return inspected.filter(F.col("reason").isNotNull())


def append_gate(new_rows: DataFrame, table_schema: T.StructType) -> DataFrame:
    """``new_rows`` unchanged if names, order and types are the table's, else an error."""
    new, table = names_and_types(new_rows.schema), names_and_types(table_schema)
    if new != table:
        raise SchemaMismatch(f"table has {table}, new rows have {new}")
    return new_rows
