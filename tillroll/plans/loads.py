"""Load jobs: source folder in, cleansed table and ledger out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import storage
from tillroll.operators.cleansing import remove_nulls, shaped, uncastable
from tillroll.operators.gates import (
    accepted_files,
    inspect_files,
    rejected_files,
    wrong_typed,
    wrong_typed_files,
)
from tillroll.schema import CORRUPT, ORDER_ID, SOURCE_SCHEMA
from tillroll.sinks import contributions, profiles
from tillroll.sinks.ledger import rejects_path, write_ledger, write_rejects
from tillroll.sinks.settling import PLACE
from tillroll.sinks.tables import append_rows, upsert_rows, write_table
from tillroll.sources.files import csv_scan_files, list_files
from tillroll.sources.tables import read_ledger, read_rejects, unseen_files
from tillroll.storage import stored_scratch

MODES = ("append", "upsert")


@dataclass(frozen=True)
class LoadResult:
    """What a load leaves behind, read from the ledger and from what is kept beside it."""

    spark: SparkSession
    batch_id: str
    ledger_path: str
    n_files: int  # loaded

    @property
    def files(self) -> DataFrame:
        """Files this load has recorded as loaded."""
        recorded = read_ledger(self.spark, self.ledger_path)
        return recorded.filter((F.col("batch_id") == self.batch_id) & F.lit(self.n_files > 0))

    @property
    def rejected_files(self) -> DataFrame:
        """Files not loaded, with ``reason``."""
        return self._rejects("files")

    @property
    def rejected_rows(self) -> DataFrame:
        """Lines of loaded files that are not in the table, with ``reason``."""
        return self._rejects("rows")

    def _rejects(self, kind: str) -> DataFrame:
        kept = read_rejects(self.spark, self.ledger_path, kind)
        return kept.filter(F.col("batch_id") == self.batch_id).drop("batch_id")


def usable_rows(files: DataFrame, gate: str = "header") -> DataFrame:
    """Lines of the listed files that have a key and hold no value of a wrong type."""
    rows = csv_scan_files(files, SOURCE_SCHEMA, gate == "fail", with_uri=False)
    # The key test reaches the scan, which then splits no further into a line without a key.
    return (
        rows.transform(remove_nulls)
        .transform(uncastable)
        .filter(~F.col("uncastable"))
        .select(*SOURCE_SCHEMA.fieldNames())
    )


def judged_lines(
    files: DataFrame, gate: str = "header", schema: T.StructType = SOURCE_SCHEMA
) -> DataFrame:
    """All lines of the listed files, with ``wrong_typed`` and the ``reason`` a line is left out.

    The raw text is kept of lines that are left out, to tell what was in them.
    """
    lines = wrong_typed(csv_scan_files(files, schema, gate == "fail"), schema)
    reason = F.when(F.col("wrong_typed"), "wrong value type").when(
        F.col(ORDER_ID).isNull(), "no order id"
    )
    kept_text = F.when(F.col("reason").isNotNull(), F.col(CORRUPT))
    return lines.withColumn("reason", reason).withColumn(CORRUPT, kept_text)


def unusable_rows(files: DataFrame) -> DataFrame:
    """The lines that a load leaves out: where they are and why."""
    return judged_lines(files).filter(F.col("reason").isNotNull()).drop("wrong_typed")


def union_gated(files: DataFrame, gate: str = "header") -> DataFrame:
    """All lines of the files that pass the gate, as one frame: one scan, not one per file."""
    accepted = stored_scratch(accepted_files(inspect_files(files, gate)), "accepted")
    if gate != "strict":
        return csv_scan_files(accepted, with_uri=False).select(*SOURCE_SCHEMA.fieldNames())
    lines = stored_scratch(judged_lines(accepted), "lines")
    passed = lines.join(wrong_typed_files(lines), "file_uri", "left_anti")
    return passed.select(*SOURCE_SCHEMA.fieldNames())


def _batch_id(files: DataFrame) -> str:
    """A name for a set of files as they are now: the same set has the same name."""
    each = F.xxhash64("path", "length", "modified")
    low, n = files.agg(F.bit_xor(each), F.count(F.lit(1))).first()
    return f"{(low or 0) & (2**64 - 1):016x}-{n}"


def _load(
    spark: SparkSession,
    files: DataFrame,
    ledger_path: str,
    gate: str,
    full: bool,
    write,
    schema: T.StructType = SOURCE_SCHEMA,
    track_files: bool = False,
    keep_profile: bool = False,
) -> LoadResult:
    """Judge files and lines, have ``write`` store the cleansed rows, then record all of it.

    ``write`` gets rows that may be several per key, the keys to withdraw before if files are tracked,
    and whether the rows are one per key and laid out already.

    The text is scanned once: the parsed lines go to scratch, from where the table and the kept
    rejects are written. Everything in scratch is deleted when the load ends, well or not.
    """
    with storage.shuffles_freed(spark), storage.scratch_folder(spark, "load") as scratch:
        listing = storage.stored(files, f"{scratch}/listing")
        batch_id = _batch_id(listing)
        inspected = storage.stored(inspect_files(listing, gate, schema), f"{scratch}/inspected")
        accepted, rejected = accepted_files(inspected), rejected_files(inspected)
        lines = storage.stored(judged_lines(accepted, gate, schema), f"{scratch}/lines", "zstd")
        if gate == "strict":
            bad = storage.stored(wrong_typed_files(lines), f"{scratch}/bad")
            lines = lines.join(bad, "file_uri", "left_anti")
            rejected = rejected.unionByName(accepted.join(bad, "file_uri").select(*rejected.columns))
            accepted = accepted.join(bad, "file_uri", "left_anti")
        n_files = accepted.count()
        if n_files:
            usable = lines.filter(F.col("reason").isNull())
            if track_files:
                rows = usable.select(*schema.fieldNames(), "file_uri")
                rows = contributions.contributed(rows, f"{scratch}/apart")
                rows = contributions.write_contributions(rows, accepted, ledger_path, batch_id)
                ledger = read_ledger(spark, ledger_path)
                rows, withdrawn = contributions.replaced(
                    spark, rows, accepted, ledger, ledger_path, batch_id, f"{scratch}/withdrawn"
                )
                write(rows, withdrawn, withdrawn is None)
            else:
                write(usable.select(*schema.fieldNames()).transform(shaped), None, False)
        if full and n_files:
            # What older loads have rejected was judged again or is gone.
            for kind in ("files", "rows"):
                storage.delete(spark, rejects_path(ledger_path, kind))
        if not listing.isEmpty():
            write_rejects(rejected, ledger_path, "files", batch_id)
            left_out = lines.filter(F.col("reason").isNotNull()).select(
                *SOURCE_SCHEMA.fieldNames(), CORRUPT, "file_uri", "reason"
            )
            write_rejects(left_out, ledger_path, "rows", batch_id)
        if n_files and keep_profile:
            profiles.write_profiles(lines, accepted, ledger_path, batch_id)
        if n_files:
            write_ledger(accepted, ledger_path, batch_id, "overwrite" if full else "append")
            if full:
                contributions.keep_only(spark, ledger_path, batch_id if track_files else "")
        return LoadResult(spark, batch_id, ledger_path, n_files)


def batch_load(
    spark: SparkSession,
    source_dir: str,
    table_path: str,
    ledger_path: str,
    fmt: str = "parquet",
    gate: str = "header",
    layout: str = "clustered",
    files: DataFrame | None = None,
    schema: T.StructType = SOURCE_SCHEMA,
    track_files: bool = False,
    keep_profile: bool = False,
) -> LoadResult:
    """Full load: replace the table by the cleansed rows of all files that pass the gate.

    ``files`` restricts the load to part of a listing of ``source_dir``. A folder without a
    loadable file leaves table and ledger as they are. ``schema`` is the files' contract, if it is
    another version than ``SOURCE_SCHEMA``. ``track_files`` keeps what each file contributes, so
    that later loads can replace a file that was corrected. ``keep_profile`` keeps each file's profile
    for ``profiles.kept_profile``.
    """
    _check_tracking(track_files, "upsert", fmt, schema)
    listing = list_files(spark, source_dir) if files is None else files

    def write(rows: DataFrame, _withdrawn: DataFrame | None, laid: bool) -> None:
        if laid and layout == "clustered":
            # As the contributions are: a stored file is a task's share.
            write_table(rows.sortWithinPartitions(*PLACE), table_path, "overwrite", fmt, "as_is")
        else:
            write_table(rows, table_path, "overwrite", fmt, layout, settle=not laid)

    return _load(spark, listing, ledger_path, gate, True, write, schema, track_files, keep_profile)


def _check_tracking(track_files: bool, mode: str, fmt: str, schema: T.StructType) -> None:
    if track_files and (mode != "upsert" or fmt != "parquet" or schema != SOURCE_SCHEMA):
        raise ValueError("files are tracked by merges into Parquet under the contract's schema only")


def incremental_load(
    spark: SparkSession,
    source_dir: str,
    table_path: str,
    ledger_path: str,
    mode: str = "upsert",
    fmt: str = "parquet",
    gate: str = "header",
    schema: T.StructType = SOURCE_SCHEMA,
    evolve: bool = False,
    track_files: bool = False,
    keep_profile: bool = False,
) -> LoadResult:
    """Load the files that are new, or were rejected and have changed since.

    ``upsert`` leaves the table as a full load of all files would, and can be repeated after a
    failure. ``append`` cleanses the new files among themselves and adds the rows; a key that an
    older file has too is then stored twice, and so are all rows if it is repeated after a
    failure between table and ledger.

    ``schema`` is the new files' contract; with ``evolve`` it may have more columns and wider numbers
    than the table, whose schema then follows. With ``track_files``, as in all loads of the table
    before, a loaded file whose length or time has changed is loaded again: the rows of its
    former version leave the table, other files' rows that these had displaced come back.
    """
    listing = list_files(spark, source_dir)
    return load_files(
        spark, listing, table_path, ledger_path, mode, fmt, gate, schema, evolve, track_files, keep_profile
    )


def load_files(
    spark: SparkSession,
    files: DataFrame,
    table_path: str,
    ledger_path: str,
    mode: str = "upsert",
    fmt: str = "parquet",
    gate: str = "header",
    schema: T.StructType = SOURCE_SCHEMA,
    evolve: bool = False,
    track_files: bool = False,
    keep_profile: bool = False,
) -> LoadResult:
    """Load those of the given files that the ledger does not name, then record them."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    _check_tracking(track_files, mode, fmt, schema)

    def write(rows: DataFrame, withdrawn: DataFrame | None, laid: bool) -> None:
        if mode == "append":
            append_rows(rows, table_path, fmt, evolve=evolve, settle=not laid)
        else:
            upsert_rows(rows, table_path, fmt, evolve=evolve, withdrawn=withdrawn, settle=not laid)

    unseen = unseen_files(spark, files, ledger_path, changed_too=track_files)
    return _load(spark, unseen, ledger_path, gate, False, write, schema, track_files, keep_profile)
