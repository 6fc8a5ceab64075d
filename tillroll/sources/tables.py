"""The cleansed table and the ledger of loaded files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import storage
from tillroll.schema import CLEANSED_SCHEMA, LEDGER_SCHEMA, REJECT_SCHEMAS
from tillroll.sinks.ledger import pending_copy, rejects_path
from tillroll.sources.files import literal_path
from tillroll.storage import has_files


def _schema_path(path: str) -> str:
    return storage.beside(path, "schema.json")


def table_schema(spark: SparkSession, path: str) -> T.StructType:
    """The schema of a Parquet table: the contract's, or what it has evolved to."""
    text = storage.read_text(spark, _schema_path(path))
    return CLEANSED_SCHEMA if text is None else T.StructType.fromJson(json.loads(text))


def record_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Read the table under this schema from now on. Recorded before rows of that schema are
    written: older files can be read under a newer schema, not the other way round."""
    if schema == CLEANSED_SCHEMA:
        storage.delete(spark, _schema_path(path))
    else:
        storage.write_text(spark, _schema_path(path), schema.json())


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """The cleansed table. Filters on ``year`` and ``month`` prune partitions.

    Parquet gets the schema stated: the types of partition columns are otherwise guessed from
    folder names, which fails for a table whose only period is NULL, and the files of a table whose
    schema has evolved differ.
    """
    reader = spark.read.format(fmt)
    if fmt == "parquet":
        reader = reader.schema(table_schema(spark, path) if schema is None else schema)
    return reader.load(literal_path(path))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Files loaded so far; no rows if nothing was ever loaded.

    While the ledger is being packed, or if that died, its copy is read.
    """
    path = pending_copy(spark, path) or path
    if not has_files(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(literal_path(path))


def read_rejects(spark: SparkSession, ledger_path: str, kind: str) -> DataFrame:
    """Rejected ``files`` or ``rows`` of all batches, with ``batch_id``; none if there are none."""
    path, schema = rejects_path(ledger_path, kind), REJECT_SCHEMAS[kind]
    if not has_files(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(literal_path(path))


def new_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed files that the ledger does not name."""
    return files.join(ledger.select("path"), "path", "left_anti")


def last_loaded(ledger: DataFrame) -> DataFrame:
    """The ledger's last row of every file."""
    latest = Window.partitionBy("path").orderBy(F.desc("loaded_at"), F.desc("batch_id"))
    return ledger.withColumn("place", F.row_number().over(latest)).filter("place = 1").drop("place")


def changed_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed files that the ledger does not name, or last named with another length or time."""
    as_is = ["path", "length", "modified"]
    return files.join(last_loaded(ledger).select(*as_is), as_is, "left_anti")


def unseen_files(
    spark: SparkSession, files: DataFrame, ledger_path: str, changed_too: bool = False
) -> DataFrame:
    """Listed files that are neither loaded nor rejected as they are now.

    A rejected file is looked at again once its length or time differs; a loaded one only with
    ``changed_too``.
    """
    ledger = read_ledger(spark, ledger_path)
    new = changed_files(files, ledger) if changed_too else new_files(files, ledger)
    rejected = read_rejects(spark, ledger_path, "files").select("path", "length", "modified")
    return new.join(rejected, ["path", "length", "modified"], "left_anti").select(*files.columns)
