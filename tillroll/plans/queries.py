"""Registered queries: each operator and job over the driver's tables, whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import fixtures
from tillroll.functions.dates import parse_order_date, period_columns
from tillroll.operators import cleansing, gates, profiling
from tillroll.plans import loads, reports
from tillroll.schema import (
    DATE_FORMAT,
    ORDER_ID,
    PRODUCT,
    SOURCE_SCHEMA,
)
from tillroll.sinks import key_index, profiles
from tillroll.sinks.ledger import pack_ledger, write_ledger
from tillroll.sinks.tables import append_rows, pack_table, write_table
from tillroll.sources.files import csv_scan, csv_scan_files, list_files
from tillroll.sources.tables import new_files, read_ledger, read_table
from tillroll.storage import scratch_path, stored_scratch
from tillroll.streaming.pickup import start_pickup

Query = Callable[[SparkSession, str], DataFrame]

LOOKUP = {ORDER_ID: 88, PRODUCT: "cold bolt"}
REPORT_SINCE, REPORT_UNTIL = (2020, 11), (2022, 2)
FIRST_ID, LAST_ID = 32, 225
ESTIMATE_OFF = 0.08  # five standard errors of a sketch


def _comparable(cleansed: DataFrame) -> DataFrame:
    """Timestamps without zone, so that other engines read the same wall-clock values."""
    return cleansed.withColumn("Order_Date", F.col("Order_Date").cast("timestamp_ntz"))


# --- rows -------------------------------------------------------------------------------


def remove_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.sales(spark, sf_dir).transform(cleansing.remove_nulls)


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.sales(spark, sf_dir).transform(cleansing.rejected_rows)
    return profiling.key_counts(rows, [PRODUCT])


def key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleansing.key_lookup(fixtures.sales(spark, sf_dir), LOOKUP)


def exact_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.sales(spark, sf_dir).transform(cleansing.remove_nulls)
    return cleansing.exact_distinct(rows)


def keep_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survivors by key, as source rows (null keys are a group of their own per product)."""
    return cleansing.keep_max(fixtures.sales(spark, sf_dir))


def remove_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.sales(spark, sf_dir).transform(cleansing.remove_nulls)
    kept = cleansing.remove_duplicates(rows).withColumns(
        period_columns(parse_order_date("Order Date"))
    )
    return kept


def parse_order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("event_id") % 101 == 0, "Order Date").otherwise(
        F.date_format("ts", DATE_FORMAT)
    )
    parsed = (
        fixtures.table(spark, sf_dir, "events")
        .select("event_id", raw.alias("Order Date"))
        .transform(cleansing.parse_dates)
        .transform(cleansing.add_period)
    )
    return parsed.withColumn("Order Date", F.col("Order Date").cast("timestamp_ntz"))


def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.sales(spark, sf_dir).transform(cleansing.rename_columns)


def cleanse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(fixtures.sales(spark, sf_dir).transform(cleansing.cleanse))


# --- profiles ---------------------------------------------------------------------------


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.null_profile(fixtures.sales(spark, sf_dir))


def null_profile_with_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.sales(spark, sf_dir).transform(cleansing.remove_nulls)
    return profiling.null_profile(rows)


def required_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.sales(spark, sf_dir).transform(cleansing.cleanse)
    return _comparable(profiling.required_violations(rows))


def describe_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = profiling.describe_profile(fixtures.sales(spark, sf_dir))
    return described.withColumns({c: F.round(c, 4) for c in ("mean", "sd")})


def count_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.sales(spark, sf_dir).transform(cleansing.remove_nulls)
    return profiling.count_levels(rows)


def dup_key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.sales(spark, sf_dir).transform(cleansing.remove_nulls)
    return profiling.dup_key_counts(rows)


def top_dup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.sales(spark, sf_dir).transform(cleansing.remove_nulls)
    return profiling.top_dup_keys(rows, n=20)


def top_keys_after_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check that follows deduplication: no key is left with two rows."""
    rows = fixtures.sales(spark, sf_dir).transform(cleansing.remove_nulls)
    return profiling.top_dup_keys(cleansing.remove_duplicates(rows), n=5)


def top_dup_keys_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same keys as ``top_dup_keys``, from exact counts of those that can be among them."""
    rows = fixtures.sales(spark, sf_dir).transform(cleansing.remove_nulls)
    return profiling.top_dup_keys_of_stored(stored_scratch(rows, "sales"), n=20)


# --- files ------------------------------------------------------------------------------


def list_source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the listed files, by when they came; decoys lie beside them."""
    folder, early = fixtures.sales_csv(spark, sf_dir, late="decoys")
    files = stored_scratch(list_files(spark, folder), "listing")
    came = early.select("file_uri", F.lit("early").alias("came"))
    return (
        csv_scan_files(files)
        .groupBy("file_uri")
        .agg(F.count(F.lit(1)).alias("n_lines"))
        .join(came, "file_uri", "left")
        .groupBy(F.coalesce("came", F.lit("late")).alias("came"))
        .agg(F.sum("n_lines").alias("n_lines"))
    )


def csv_scan_one_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, _ = fixtures.sales_csv(spark, sf_dir)
    return csv_scan(spark, folder)


def csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, _ = fixtures.sales_csv(spark, sf_dir)
    inferred = csv_scan(spark, folder, schema=None)
    return inferred.withColumns(
        {f.name: F.col(f.name).cast(f.dataType) for f in SOURCE_SCHEMA.fields}
    )


def csv_scan_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, _ = fixtures.sales_csv(spark, sf_dir)
    files = stored_scratch(list_files(spark, folder), "listing")
    return csv_scan_files(files, with_uri=False).select(*SOURCE_SCHEMA.fieldNames())


def file_schema_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-file profile, summed over files of one shape: file names differ between runs."""
    folder, _ = fixtures.sales_csv(spark, sf_dir, late="wrong")
    files = stored_scratch(list_files(spark, folder), "listing")
    return (
        profiling.file_schema_profile(files)
        .groupBy("n_columns", "position", "column_name", "data_type")
        .agg(*[F.sum(c).alias(c) for c in ("n_rows", "n_null", "n_misfit")])
    )


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole exploration of the source rows, its counts as rows."""
    found = profiling.profile(fixtures.sales(spark, sf_dir))
    return profiling.profile_rows(found, SOURCE_SCHEMA.fieldNames())


def union_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, _ = fixtures.sales_csv(spark, sf_dir, late="drifted")
    return loads.union_gated(stored_scratch(list_files(spark, folder), "listing"))


def rejected_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in files the gate rejects, by reason."""
    folder, _ = fixtures.sales_csv(spark, sf_dir, late="drifted")
    files = stored_scratch(list_files(spark, folder), "listing")
    rejected = stored_scratch(gates.rejected_files(gates.inspect_files(files)), "rejected")
    return (
        csv_scan_files(rejected)
        .join(rejected.select("file_uri", "reason"), "file_uri")
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )


def new_files_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the files a ledger of the early ones does not name."""
    folder, early = fixtures.sales_csv(spark, sf_dir)
    ledger = scratch_path(spark, "ledger")
    write_ledger(early, ledger, "first", "overwrite")
    new = new_files(list_files(spark, folder), read_ledger(spark, ledger))
    rows = csv_scan_files(stored_scratch(new, "new"), with_uri=False)
    return rows.select(*SOURCE_SCHEMA.fieldNames())


# --- loads ------------------------------------------------------------------------------


def partitioned_write_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = fixtures.fresh_table(spark)
    write_table(fixtures.sales(spark, sf_dir).transform(cleansing.cleanse), path)
    return _comparable(read_table(spark, path))


def _early_then_late(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    folder, early = fixtures.sales_csv(spark, sf_dir)
    path, ledger = fixtures.fresh_table(spark)
    loads.batch_load(spark, folder, path, ledger, files=early)
    loads.incremental_load(spark, folder, path, ledger, mode)
    return _comparable(read_table(spark, path))


def append_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, early = fixtures.sales_csv(spark, sf_dir)
    path, _ = fixtures.fresh_table(spark)
    late = stored_scratch(new_files(list_files(spark, folder), early), "late")
    for files in (early, late):
        append_rows(loads.usable_rows(files).transform(cleansing.cleanse), path)
    return _comparable(read_table(spark, path))


def batch_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, _ = fixtures.sales_csv(spark, sf_dir)
    path, ledger = fixtures.fresh_table(spark)
    loads.batch_load(spark, folder, path, ledger)
    return _comparable(read_table(spark, path))


def _batch_of(spark: SparkSession, sf_dir: str, late: str, gate: str) -> DataFrame:
    folder, _ = fixtures.sales_csv(spark, sf_dir, late)
    path, ledger = fixtures.fresh_table(spark)
    loads.batch_load(spark, folder, path, ledger, gate=gate)
    return _comparable(read_table(spark, path))


def batch_job_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full load of a folder in which some files hold values of wrong types: their lines go."""
    return _batch_of(spark, sf_dir, "wrong", "header")


def batch_job_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with all values checked: the files that hold such lines go."""
    return _batch_of(spark, sf_dir, "wrong", "strict")


def batch_job_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full load in which the scan itself checks the headers."""
    return _batch_of(spark, sf_dir, "conforming", "fail")


def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that a full load has left out and kept beside the ledger, by reason."""
    folder, _ = fixtures.sales_csv(spark, sf_dir, "wrong")
    path, ledger = fixtures.fresh_table(spark)
    result = loads.batch_load(spark, folder, path, ledger)
    return result.rejected_rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n_lines"))


def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _early_then_late(spark, sf_dir, "append")


def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _early_then_late(spark, sf_dir, "upsert")


def stream_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files through the stream, in two micro-batches."""
    folder, _ = fixtures.sales_csv(spark, sf_dir)
    path, ledger = fixtures.fresh_table(spark)
    n_files = list_files(spark, folder).count()
    start_pickup(
        spark,
        folder,
        path,
        ledger,
        checkpoint=scratch_path(spark, "stream"),
        max_files_per_trigger=(n_files + 1) // 2,
    ).awaitTermination()
    return _comparable(read_table(spark, path))


def order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of the early rows that hold an order of the late ones, from the index of order ids."""
    folder, early = fixtures.sales_csv(spark, sf_dir)
    path, _ = fixtures.fresh_table(spark)
    late = stored_scratch(new_files(list_files(spark, folder), early), "late")
    write_table(loads.usable_rows(early).transform(cleansing.cleanse), path)
    key_index.fill(read_table(spark, path), path)
    rows = loads.usable_rows(late).transform(cleansing.rename_columns)
    holding = key_index.months_holding(spark, path, rows)
    schema = "year int, month int, low long, high long"
    return spark.createDataFrame([tuple(m) for m in holding], schema)


def clustered_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some neighbouring orders from a table clustered by id within its months."""
    path, _ = fixtures.fresh_table(spark)
    write_table(fixtures.sales(spark, sf_dir).transform(cleansing.cleanse), path, layout="clustered")
    wanted = F.col("Order_ID").between(FIRST_ID, LAST_ID)
    return _comparable(read_table(spark, path).filter(wanted))


def corrected_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load, a file corrected under its name, another load: as if it had been right at once."""
    folder, correct = fixtures.corrected_csv(spark, sf_dir)
    path, ledger = fixtures.fresh_table(spark)
    loads.batch_load(spark, folder, path, ledger, track_files=True)
    correct()
    loads.incremental_load(spark, folder, path, ledger, track_files=True)
    return _comparable(read_table(spark, path))


def evolved_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of whole prices takes rows with exact prices and a column more."""
    folder, early = fixtures.versioned_csv(spark, sf_dir)
    path, ledger = fixtures.fresh_table(spark)
    loads.batch_load(spark, folder, path, ledger, files=early, schema=fixtures.OLD_SCHEMA)
    loads.incremental_load(spark, folder, path, ledger, schema=fixtures.NEW_SCHEMA, evolve=True)
    return _comparable(read_table(spark, path))


def evolved_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without merging: older files are read under the newer schema."""
    folder, early = fixtures.versioned_csv(spark, sf_dir)
    path, ledger = fixtures.fresh_table(spark)
    loads.batch_load(spark, folder, path, ledger, files=early, schema=fixtures.OLD_SCHEMA)
    loads.incremental_load(spark, folder, path, ledger, "append", schema=fixtures.NEW_SCHEMA, evolve=True)
    return _comparable(read_table(spark, path))


def kept_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of two loads' lines, from the states that each kept of its files."""
    folder, early = fixtures.sales_csv(spark, sf_dir)
    path, ledger = fixtures.fresh_table(spark)
    loads.batch_load(spark, folder, path, ledger, files=early, keep_profile=True)
    loads.incremental_load(spark, folder, path, ledger, keep_profile=True)
    found = profiles.kept_profile(spark, ledger)
    return found.withColumns({c: F.round(c, 4) for c in ("mean", "sd")})


def packed_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends that leave a small file per task and month, packed, with their ledger."""
    folder, early = fixtures.sales_csv(spark, sf_dir)
    path, ledger = fixtures.fresh_table(spark)
    loads.batch_load(spark, folder, path, ledger, files=early)
    loads.incremental_load(spark, folder, path, ledger, "append")
    pack_table(spark, path, spare_files=1)
    pack_ledger(spark, ledger)
    return _comparable(read_table(spark, path))


# --- reports ----------------------------------------------------------------------------


def monthly_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.monthly_report(fixtures.sales(spark, sf_dir).transform(cleansing.cleanse))


def yearly_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.yearly_report(fixtures.sales(spark, sf_dir).transform(cleansing.cleanse))


def monthly_report_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A span of months from the stored table; other months' files are not read."""
    path, _ = fixtures.fresh_table(spark)
    write_table(fixtures.sales(spark, sf_dir).transform(cleansing.cleanse), path)
    return reports.monthly_report(read_table(spark, path), REPORT_SINCE, REPORT_UNTIL)


def kept_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals kept from before a merge, which renews those of the months it writes."""
    folder, early = fixtures.sales_csv(spark, sf_dir)
    path, ledger = fixtures.fresh_table(spark)
    loads.batch_load(spark, folder, path, ledger, files=early)
    reports.keep_totals(spark, path)
    loads.incremental_load(spark, folder, path, ledger)
    return reports.kept_report(spark, path)


def estimated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per year, counted, and whether the estimate from the kept sketches comes near."""
    path, _ = fixtures.fresh_table(spark)
    write_table(fixtures.sales(spark, sf_dir).transform(cleansing.cleanse), path)
    reports.keep_totals(spark, path)
    exact = read_table(spark, path).groupBy("year").agg(F.count_distinct("Order_ID").alias("orders"))
    estimates = reports.kept_distinct(spark, path, by=("year",)).select("year", F.col("orders").alias("estimate"))
    off = F.abs(F.col("estimate") - F.col("orders")) / F.col("orders")
    same = F.col("exact.year").eqNullSafe(F.col("found.year"))
    found = exact.alias("exact").join(estimates.alias("found"), same)
    return found.select("exact.year", "orders", (off <= ESTIMATE_OFF).alias("near"))


QUERIES: dict[str, Query] = {
    "remove_nulls": remove_nulls,
    "rejected_rows": rejected_rows,
    "key_lookup": key_lookup,
    "exact_distinct": exact_distinct,
    "keep_max": keep_max,
    "remove_duplicates": remove_duplicates,
    "parse_order_date": parse_order_dates,
    "rename_columns": rename_columns,
    "cleanse": cleanse,
    "null_profile": null_profile,
    "null_profile_with_key": null_profile_with_key,
    "required_violations": required_violations,
    "describe_profile": describe_profile,
    "count_levels": count_levels,
    "dup_key_counts": dup_key_counts,
    "top_dup_keys": top_dup_keys,
    "top_keys_after_dedup": top_keys_after_dedup,
    "profile": profile,
    "kept_profile": kept_profile,
    "top_dup_keys_bounded": top_dup_keys_bounded,
    "list_files": list_source_files,
    "csv_scan": csv_scan_one_schema,
    "csv_scan_inferred": csv_scan_inferred,
    "csv_scan_multi": csv_scan_multi,
    "file_schema_profile": file_schema_profile,
    "union_gated": union_gated,
    "rejected_files": rejected_files,
    "new_files_only": new_files_only,
    "partitioned_write_read": partitioned_write_read,
    "append_gated": append_gated,
    "batch_job": batch_job,
    "batch_job_header": batch_job_header,
    "batch_job_strict": batch_job_strict,
    "batch_job_fail": batch_job_fail,
    "rejected_lines": rejected_lines,
    "incremental_append": incremental_append,
    "incremental_upsert": incremental_upsert,
    "stream_incremental": stream_incremental,
    "order_months": order_months,
    "clustered_lookup": clustered_lookup,
    "corrected_file": corrected_file,
    "evolved_merge": evolved_merge,
    "evolved_append": evolved_append,
    "kept_report": kept_report,
    "packed_appends": packed_appends,
    "estimated_orders": estimated_orders,
    "monthly_report": monthly_report,
    "yearly_report": yearly_report,
    "monthly_report_pruned": monthly_report_pruned,
}
