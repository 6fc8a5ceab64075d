"""What every loaded file contributed to the table, so that a file can be withdrawn or replaced.

A load that tracks its files keeps their cleansed rows, the surviving line per file and key, under
its batch id, beside the ledger. Nothing is rewritten: rows count if the ledger names their batch as the
last one that loaded their file. Rows of batches that died, or of a file's former version, are
left out by that, and are known as rows to withdraw when the file is loaded again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import storage
from tillroll.functions.ordering import survivor_order
from tillroll.operators.cleansing import keep_max, shaped
from tillroll.schema import CLEANSED_SCHEMA, STORED_KEYS, STORED_QUANTITY
from tillroll.sinks import key_index, settling
from tillroll.sources.files import literal_path
from tillroll.sources.tables import last_loaded

FILE = "file_uri"
SURVIVES = "survives"  # of the rows of a key in a batch, the one that the batch puts into the table
_FILES = "path string, file_uri string, batch_id string"


def contributions_path(ledger_path: str, kind: str) -> str:
    return f"{ledger_path.rstrip('/')}_contributions/{kind}"


def _first_of(*keys: str) -> Column:
    """Is a row the survivor of its key? Rows that tie differ in nothing but their file."""
    order = survivor_order(CLEANSED_SCHEMA, STORED_KEYS, STORED_QUANTITY)
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order, FILE)) == 1


def contributed(lines: DataFrame, scratch: str) -> DataFrame:
    """Cleansed rows per file, from usable lines with ``file_uri``: one per file and key, with
    ``survives``, laid out as the table is.

    The surviving rows of all files are what cleansing the lines at once would give.
    """
    rows = shaped(lines).select(*CLEANSED_SCHEMA.fieldNames(), FILE)
    words = settling.apart_words(settling.line_words(rows))
    few, most = settling.split_by_id(rows, settling.few_words(words, scratch))
    few = keep_max(few, [*STORED_KEYS, FILE], STORED_QUANTITY).withColumn(SURVIVES, _first_of(*STORED_KEYS))
    if most is None:
        return settling.clustered(few)
    most = most.withColumn(SURVIVES, F.lit(None).cast("boolean"))
    moved = most.unionByName(few).repartitionByRange(*settling.PLACE)
    # As in ``settling.settled``: the other lines of a key and month are in the same range.
    kept = keep_max(moved, [*settling.PLACE, FILE], STORED_QUANTITY)
    kept = kept.withColumn(SURVIVES, F.coalesce(SURVIVES, _first_of(*settling.PLACE)))
    return kept.sortWithinPartitions(*settling.PLACE)


def write_contributions(rows: DataFrame, files: DataFrame, ledger_path: str, batch_id: str) -> DataFrame:
    """Keep a batch's rows as they are laid out; a batch that is repeated replaces its own."""
    for kind, frame in (("files", files.select("path", FILE)), ("rows", rows)):
        frame.write.mode("overwrite").parquet(f"{contributions_path(ledger_path, kind)}/batch_id={batch_id}")
    path = f"{contributions_path(ledger_path, 'rows')}/batch_id={batch_id}"
    return rows.sparkSession.read.schema(rows.schema).parquet(literal_path(path))


def _read(spark: SparkSession, ledger_path: str, kind: str) -> DataFrame:
    if kind == "files":
        schema = T.StructType.fromDDL(_FILES)
    else:
        extra = [T.StructField(c, T.StringType()) for c in (FILE, "batch_id")]
        schema = T.StructType([*CLEANSED_SCHEMA.fields, *extra])
    path = contributions_path(ledger_path, kind)
    if not storage.has_files(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(literal_path(path))


def _last_versions(spark: SparkSession, ledger: DataFrame, ledger_path: str) -> DataFrame:
    """``file_uri, batch_id``: the batch that loaded each file last, as the ledger has it."""
    last = last_loaded(ledger).select("path", "batch_id")
    return _read(spark, ledger_path, "files").join(last, ["path", "batch_id"]).select(FILE, "batch_id")


def replaced(
    spark: SparkSession,
    new: DataFrame,
    files: DataFrame,
    ledger: DataFrame,
    ledger_path: str,
    batch_id: str,
    scratch: str,
) -> tuple[DataFrame, DataFrame | None]:
    """``rows, withdrawn``: what a merge has to put in, and the keys it has to take out before.

    Withdrawn are all keys that older versions of the given files had, None if they had none. For these
    the other files have their say again: their current rows are found by key, within the range of the
    withdrawn ids, by which the stored rows of a month are ordered. So a key may have several rows
    then; without withdrawn keys the rows are one per key, and laid out.
    """
    kept = _read(spark, ledger_path, "rows")
    older = kept.join(files.select(FILE), FILE, "left_semi").filter(F.col("batch_id") != batch_id)
    withdrawn = storage.stored(older.select(*STORED_KEYS).distinct(), f"{scratch}/keys")
    low, high = withdrawn.agg(F.min(STORED_KEYS[0]), F.max(STORED_KEYS[0])).first()
    columns = CLEANSED_SCHEMA.fieldNames()
    rows = new.filter(SURVIVES).select(*columns)
    if low is None:
        return rows, None
    others = (
        kept.filter(F.col(STORED_KEYS[0]).between(low, high))
        .join(files.select(FILE), FILE, "left_anti")
        .join(_last_versions(spark, ledger, ledger_path), [FILE, "batch_id"], "left_semi")
        .select(*columns)
    )
    # Other files have few of the keys: these are found first, from the key columns, then their rows.
    # Rows of other ids are not moved for that.
    found = _with_keys(others.select(*STORED_KEYS), withdrawn, f"{scratch}/ids").distinct()
    found = storage.stored(found, f"{scratch}/found")
    return rows.unionByName(_with_keys(others, found, f"{scratch}/found_ids")), withdrawn


def _with_keys(rows: DataFrame, keys: DataFrame, scratch: str) -> DataFrame:
    """Rows that have one of the keys."""
    id_, product = STORED_KEYS
    named, _ = settling.split_by_id(rows, settling.few_words(key_index.id_words(keys), scratch))
    wanted = keys.select(F.col(id_).alias("_wanted_id"), F.col(product).alias("_wanted_product"))
    same = (F.col(id_) == F.col("_wanted_id")) & F.col(product).eqNullSafe(F.col("_wanted_product"))
    return named.join(wanted, same, "left_semi")


def keep_only(spark: SparkSession, ledger_path: str, batch_id: str) -> None:
    """After a full load: no other batch counts any more."""
    for kind in ("files", "rows"):
        path = contributions_path(ledger_path, kind)
        for name in storage.names(spark, path):
            if name.startswith("batch_id=") and name != f"batch_id={batch_id}":
                storage.delete(spark, f"{path}/{name}")
