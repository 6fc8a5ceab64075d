"""Recording which files were loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import storage
from tillroll.schema import LEDGER_SCHEMA
from tillroll.sources.files import literal_path


def write_ledger(files: DataFrame, path: str, batch_id: str, mode: str) -> None:
    """Record files as loaded: ``overwrite`` after a full load, ``append`` otherwise.

    Called after the table is written. A load that fails before leaves its files unrecorded,
    so the next run takes them again; nothing is lost.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode!r}")
    spark = files.sparkSession
    if mode == "append":
        _finish_packing(spark, path)
    else:
        storage.delete(spark, _note_path(path))
    files.select(
        "path",
        "length",
        "modified",
        F.lit(batch_id).alias("batch_id"),
        F.current_timestamp().alias("loaded_at"),
    ).select(*LEDGER_SCHEMA.fieldNames()).hint("rebalance").write.mode(mode).parquet(path)


def _note_path(path: str) -> str:
    return f"{path.rstrip('/')}_packing"


def pending_copy(spark: SparkSession, path: str) -> str | None:
    """The whole ledger's copy, while the ledger itself is replaced by it."""
    return storage.read_text(spark, _note_path(path))


def pack_ledger(spark: SparkSession, path: str) -> None:
    """Put the ledger's many small files, some per load, into few.

    A copy is written, noted, and put in the ledger's place. Readers use the copy as long as the
    note is there, so one that dies on the way loses nothing; the next append finishes it.
    """
    _finish_packing(spark, path)
    if not storage.has_files(spark, path):
        return
    copy = f"{path.rstrip('/')}_copy-{storage.fresh_name()}"
    rows = spark.read.schema(LEDGER_SCHEMA).parquet(literal_path(path))
    rows.hint("rebalance").write.parquet(copy)
    storage.write_text(spark, _note_path(path), copy)
    _finish_packing(spark, path)


def _finish_packing(spark: SparkSession, path: str) -> None:
    copy = pending_copy(spark, path)
    if copy is None:
        return
    rows = spark.read.schema(LEDGER_SCHEMA).parquet(literal_path(copy))
    rows.hint("rebalance").write.mode("overwrite").parquet(path)
    storage.delete(spark, _note_path(path))
    storage.delete(spark, copy)


def rejects_path(ledger_path: str, kind: str) -> str:
    """Where a load's rejected ``files`` or ``rows`` are kept: beside the ledger."""
    return f"{ledger_path.rstrip('/')}_rejected/{kind}"


def write_rejects(rejects: DataFrame, ledger_path: str, kind: str, batch_id: str) -> None:
    """Keep what a batch rejects. A batch that is repeated replaces what it has left before."""
    path = f"{rejects_path(ledger_path, kind)}/batch_id={batch_id}"
    # Few rows out of all lines of a load: the lines are filtered in as many tasks as they fill.
    rejects.hint("rebalance").write.mode("overwrite").parquet(path)
