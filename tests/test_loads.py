import glob
import json
import os

import pytest
from conftest import plan, rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tillroll import storage
from tillroll.operators.gates import SchemaMismatch
from tillroll.plans import loads, reports
from tillroll.plans.loads import batch_load, incremental_load
from tillroll.schema import CLEANSED_SCHEMA
from tillroll.sinks import tables
from tillroll.sinks.tables import append_rows, upsert_rows, write_table
from tillroll.sources.files import list_files
from tillroll.sources.tables import read_ledger, read_table

KEPT = ("Order_ID", "Product", "Quantity_Ordered", "year", "month")


def line(order, product, quantity, date, price=1.5, address="home"):
    return f"{order},{product},{quantity},{price},{date},{address}"


JANUARY = [
    line(1, "x", 2, "01/05/19 10:00"),
    line(1, "x", 2, "01/05/19 10:00"),
    line(2, "x", 1, "01/06/19 10:00"),
    ",,,,,",
]
FEBRUARY = [
    line(1, "x", 5, "02/01/19 10:00"),
    line(3, "y", 1, "02/02/19 10:00"),
    line(4, "y", 1, "no date"),
]


def stored_rows(spark, path):
    return rows(read_table(spark, path), *KEPT)


def cleansed(spark, *data):
    return spark.createDataFrame(
        [(o, p, q, 1.0, None, "home", y, m) for o, p, q, y, m in data], CLEANSED_SCHEMA
    )


def test_full_load(spark, source, target):
    source("jan.csv", *JANUARY)
    source("feb.csv", *FEBRUARY)
    source("drifted.csv", "x,1", header="Product,Order ID")
    table, ledger = target
    result = batch_load(spark, source.folder, table, ledger)
    assert stored_rows(spark, table) == sorted(
        [(1, "x", 5, 2019, 2), (2, "x", 1, 2019, 1), (3, "y", 1, 2019, 2), (4, "y", 1, None, None)],
        key=repr,
    )
    assert read_ledger(spark, ledger).count() == 2
    assert rows(result.rejected_files, "reason") == [("header differs",)]
    assert rows(result.rejected_rows, "reason") == [("no order id",)]
    assert os.path.isdir(f"{table}/year=2019/month=2")


def test_a_folder_without_loadable_files_changes_nothing(spark, source, target):
    table, ledger = target
    source("jan.csv", *JANUARY)
    batch_load(spark, source.folder, table, ledger)
    before = stored_rows(spark, table)
    os.replace(f"{source.folder}/jan.csv", f"{source.folder}/jan.txt")
    result = batch_load(spark, source.folder, table, ledger)
    assert result.files.count() == 0
    assert stored_rows(spark, table) == before
    assert incremental_load(spark, source.folder, table, ledger).files.count() == 0


def test_append_keeps_a_key_of_two_loads_twice(spark, source, target):
    table, ledger = target
    source("jan.csv", *JANUARY)
    batch_load(spark, source.folder, table, ledger)
    source("feb.csv", *FEBRUARY)
    result = incremental_load(spark, source.folder, table, ledger, "append")
    assert result.files.count() == 1
    assert [r for r in stored_rows(spark, table) if r[0] == 1] == [
        (1, "x", 2, 2019, 1),
        (1, "x", 5, 2019, 2),
    ]
    assert incremental_load(spark, source.folder, table, ledger, "append").files.count() == 0
    assert read_table(spark, table).count() == 5


@pytest.mark.parametrize("first,second", [(JANUARY, FEBRUARY), (FEBRUARY, JANUARY)])
def test_upsert_equals_the_full_load(spark, source, target, tmp_path, first, second):
    table, ledger = target
    source("a.csv", *first)
    batch_load(spark, source.folder, table, ledger)
    source("b.csv", *second)
    incremental_load(spark, source.folder, table, ledger, "upsert")
    whole = str(tmp_path / "whole")
    batch_load(spark, source.folder, whole, str(tmp_path / "whole_ledger"))
    columns = CLEANSED_SCHEMA.fieldNames()
    assert rows(read_table(spark, table), *columns) == rows(read_table(spark, whole), *columns)


def test_incremental_load_into_no_table(spark, source, tmp_path):
    source("a.csv", *JANUARY)
    for mode in loads.MODES:
        table = str(tmp_path / mode)
        incremental_load(spark, source.folder, table, f"{table}_ledger", mode)
        assert read_table(spark, table).count() == 2


def test_a_month_that_loses_its_last_row_is_removed(spark, target):
    table, _ = target
    write_table(cleansed(spark, (1, "x", 1, 2019, 4), (2, "x", 1, 2019, 5)), table)
    months = upsert_rows(cleansed(spark, (1, "x", 9, 2019, 6)), table)
    assert [tuple(m) for m in months] == [(2019, 4), (2019, 6)]
    assert stored_rows(spark, table) == [(1, "x", 9, 2019, 6), (2, "x", 1, 2019, 5)]
    assert not os.path.exists(f"{table}/year=2019/month=4")


def test_upsert_leaves_other_months_files_alone(spark, target):
    table, _ = target
    write_table(cleansed(spark, (1, "x", 1, 2019, 4), (2, "x", 1, 2019, 5)), table)
    untouched = glob.glob(f"{table}/year=2019/month=5/*.parquet")
    upsert_rows(cleansed(spark, (1, "x", 9, 2019, 4), (7, None, 1, None, None)), table)
    assert glob.glob(f"{table}/year=2019/month=5/*.parquet") == untouched
    assert read_table(spark, table).count() == 3
    # A null product is a key like any other, a null month a month like any other.
    upsert_rows(cleansed(spark, (7, None, 3, None, None)), table)
    assert [r for r in stored_rows(spark, table) if r[0] == 7] == [(7, None, 3, None, None)]


def test_a_smaller_quantity_changes_nothing(spark, target):
    table, _ = target
    write_table(cleansed(spark, (1, "x", 5, 2019, 4)), table)
    upsert_rows(cleansed(spark, (1, "x", 2, 2019, 6)), table)
    assert stored_rows(spark, table) == [(1, "x", 5, 2019, 4)]


@pytest.mark.parametrize("dies_at", ["before publishing", "before cleaning up"])
def test_a_merge_that_dies_half_way_is_repaired_by_the_next(
    spark, source, target, monkeypatch, dies_at
):
    table, ledger = target
    source("a.csv", *JANUARY)
    batch_load(spark, source.folder, table, ledger)
    source("b.csv", *FEBRUARY)
    def failing(*_args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        if dies_at == "before publishing":
            publish, calls = tables._publish_pending, []

            def late(*args):
                calls.append(args)
                return failing() if len(calls) > 1 else publish(*args)

            patch.setattr(tables, "_publish_pending", late)
        else:
            patch.setattr(tables, "_month_folder", failing)
            patch.setattr(tables, "_months", lambda df, own=tables._months: [
                m for m in own(df) if m.month != 1 or "merged" not in df.inputFiles()[0]
            ])
        with pytest.raises(OSError):
            incremental_load(spark, source.folder, table, ledger, "upsert")
    # The file is not recorded as loaded, and what is to be published is noted.
    assert read_ledger(spark, ledger).count() == 1
    assert os.path.exists(f"{table}/_pending_merge")
    incremental_load(spark, source.folder, table, ledger, "upsert")
    assert stored_rows(spark, table) == sorted(
        [(1, "x", 5, 2019, 2), (2, "x", 1, 2019, 1), (3, "y", 1, 2019, 2), (4, "y", 1, None, None)],
        key=repr,
    )
    assert read_ledger(spark, ledger).count() == 2
    assert not os.path.exists(f"{table}/_pending_merge")


@pytest.mark.parametrize("load", [batch_load, incremental_load])
def test_a_failed_write_leaves_the_ledger_as_it_was(spark, source, target, monkeypatch, load):
    table, ledger = target
    source("a.csv", *JANUARY)

    def failing(*_args, **_kwargs):
        raise OSError("disk full")

    monkeypatch.setattr(loads, "write_table", failing)
    monkeypatch.setattr(loads, "upsert_rows", failing)
    with pytest.raises(OSError):
        load(spark, source.folder, table, ledger)
    assert read_ledger(spark, ledger).count() == 0


def test_append_checks_the_schema_before_writing(spark, target):
    table, _ = target
    write_table(cleansed(spark, (1, "x", 1, 2019, 4)), table)
    wrong = cleansed(spark, (2, "x", 1, 2019, 4)).withColumn("Order_ID", F.col("Order_ID").cast("int"))
    for write in (append_rows, upsert_rows):
        with pytest.raises(SchemaMismatch):
            write(wrong, table)
    append_rows(cleansed(spark, (2, "x", 1, None, None)), table)
    assert read_table(spark, table).count() == 2


def test_append_to_a_table_whose_only_month_is_null(spark, target):
    table, _ = target
    write_table(cleansed(spark, (1, "x", 1, None, None)), table)
    append_rows(cleansed(spark, (2, "x", 1, 2019, 4)), table)
    assert stored_rows(spark, table) == [(1, "x", 1, None, None), (2, "x", 1, 2019, 4)]


def test_upsert_into_a_table_whose_only_month_is_null(spark, target):
    table, _ = target
    write_table(cleansed(spark, (1, "x", 1, None, None), (2, "x", 1, None, None)), table)
    upsert_rows(cleansed(spark, (1, "x", 2, 2019, 4)), table)
    assert stored_rows(spark, table) == [(1, "x", 2, 2019, 4), (2, "x", 1, None, None)]
    upsert_rows(cleansed(spark, (2, "x", 2, 2019, 4)), table)
    assert stored_rows(spark, table) == [(1, "x", 2, 2019, 4), (2, "x", 2, 2019, 4)]


def test_upsert_of_no_rows_changes_nothing(spark, target):
    table, _ = target
    write_table(cleansed(spark, (1, "x", 1, 2019, 4)), table)
    assert upsert_rows(cleansed(spark), table) == []
    assert stored_rows(spark, table) == [(1, "x", 1, 2019, 4)]


def test_only_keys_in_the_range_of_new_ids_are_read(spark, target):
    table, _ = target
    write_table(cleansed(spark, (1, "x", 1, 2019, 4), (9, "x", 1, 2019, 5)), table)
    seen = []
    original = tables._months
    tables._months = lambda df: seen.append(plan(df)) or original(df)
    try:
        incoming = read_table(spark, table).filter("Order_ID > 8")
        assert [tuple(m) for m in tables.touched_months(incoming, read_table(spark, table))] == [(2019, 5)]
    finally:
        tables._months = original
    assert "GreaterThanOrEqual(Order_ID,9)" in seen[0]
    assert "Purchase_Address" not in seen[0]


def test_rebalance_without_adaptive_execution_is_an_error(spark, target):
    table, _ = target
    data = cleansed(spark, *[(i, "x", 1, 2019, 4) for i in range(40)]).repartition(4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with pytest.raises(ValueError, match="adaptive"):
            write_table(data, table)
        write_table(data, table, layout="as_is")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(glob.glob(f"{table}/year=2019/month=4/*.parquet")) == 4


def test_rebalance_writes_a_file_per_small_month_and_several_per_large(spark, target):
    table, _ = target
    data = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("Order_ID"),
        F.lit("x").alias("Product"),
        F.lit(1).alias("Quantity_Ordered"),
        F.rand(1).alias("Price_Each"),
        F.lit(None).cast("timestamp").alias("Order_Date"),
        F.sha2(F.col("id").cast("string"), 256).alias("Purchase_Address"),
        F.lit(2019).alias("year"),
        # One month holds a third of all rows.
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 11 + 2).cast("int").alias("month"),
    )
    write_table(data, table)
    assert len(glob.glob(f"{table}/*/*/*.parquet")) == 12
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        write_table(data, table)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{table}/year=2019/month=1/*.parquet")) > 2
    assert read_table(spark, table).count() == 60_000
    with pytest.raises(ValueError, match="layout"):
        write_table(data, table, layout="sorted")


def test_period_filters_prune_partitions(spark, target):
    table, _ = target
    write_table(cleansed(spark, (1, "x", 1, 2019, 4), (2, "x", 4, 2019, 5), (3, "x", 1, 2020, 1)), table)
    report = reports.monthly_report(read_table(spark, table), (2019, 5), (2019, 12))
    assert rows(report, "year", "month", "n_lines", "units") == [(2019, 5, 1, 4)]
    partition_filters = plan(report).split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in partition_filters and "month" in partition_filters
    merged = read_table(spark, table).filter(tables.in_months(tables._months(cleansed(spark, (1, "x", 1, 2019, 4)))))
    assert merged.count() == 1
    assert "year" in plan(merged).split("PartitionFilters: [")[1].split("]")[0]
    assert rows(reports.yearly_report(read_table(spark, table)), "year", "n_lines") == [(2019, 2), (2020, 1)]


@pytest.mark.parametrize("session_mode", ["static", "dynamic"])
def test_a_full_load_replaces_the_table_whatever_the_session_says(
    spark, source, target, session_mode
):
    table, ledger = target
    source("jan.csv", *JANUARY)
    source("feb.csv", *FEBRUARY)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", session_mode)
    try:
        batch_load(spark, source.folder, table, ledger)
        os.remove(f"{source.folder}/feb.csv")
        batch_load(spark, source.folder, table, ledger)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert stored_rows(spark, table) == [(1, "x", 2, 2019, 1), (2, "x", 1, 2019, 1)]
    assert read_ledger(spark, ledger).count() == 1


def test_a_merge_asks_the_file_system_by_month_not_by_file(spark, target, monkeypatch):
    table, _ = target
    many = cleansed(spark, *[(i, "x", 1, 2019, 1 + i % 3) for i in range(90)]).repartition(30)
    write_table(many, table, layout="as_is")
    assert len(glob.glob(f"{table}/*/*/*.parquet")) > 50
    path, calls = storage._path, []
    monkeypatch.setattr(storage, "_path", lambda *args: calls.append(args) or path(*args))
    upsert_rows(cleansed(spark, *[(i, "x", 2, 2019, 1 + i % 3) for i in range(9)]), table)
    assert len(calls) < 15
    assert read_table(spark, table).count() == 90


def test_nothing_is_left_in_scratch(spark, source, target):
    table, ledger = target
    scratch = spark.conf.get("spark.checkpoint.dir") + "/tillroll"
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    source("jan.csv", *JANUARY)
    batch_load(spark, source.folder, table, ledger, gate="strict")
    source("feb.csv", *FEBRUARY)
    incremental_load(spark, source.folder, table, ledger)
    incremental_load(spark, source.folder, table, ledger)
    assert set(os.listdir(scratch)) == before


def test_rejected_files_are_looked_at_again_only_when_they_change(spark, source, target, monkeypatch):
    table, ledger = target
    source("jan.csv", *JANUARY)
    source("bad.csv", "x,1", header="Product,Order ID")
    batch_load(spark, source.folder, table, ledger)
    seen, inspect = [], loads.inspect_files
    monkeypatch.setattr(loads, "inspect_files", lambda f, *rest: seen.append(f.count()) or inspect(f, *rest))
    incremental_load(spark, source.folder, table, ledger)
    source("bad.csv", line(9, "z", 1, "01/09/19 10:00"))
    result = incremental_load(spark, source.folder, table, ledger)
    assert seen == [0, 1] and result.n_files == 1
    assert read_table(spark, table).filter("Order_ID = 9").count() == 1


def test_rejected_lines_are_kept_with_their_text(spark, source, target):
    table, ledger = target
    source("jan.csv", *JANUARY, "7,x,two,1,01/05/19 10:00,home", "A-7,x,2,1,01/05/19 10:00,home")
    for _ in range(2):  # a repeated load keeps them once
        result = batch_load(spark, source.folder, table, ledger)
    assert rows(result.rejected_rows, "reason", "_corrupt_record") == sorted(
        [
            ("no order id", None),
            ("wrong value type", "7,x,two,1,01/05/19 10:00,home"),
            ("wrong value type", "A-7,x,2,1,01/05/19 10:00,home"),
        ],
        key=repr,
    )
    assert result.files.count() == 1


def test_a_load_that_fails_before_the_ledger_can_be_repeated(spark, source, target, monkeypatch):
    table, ledger = target
    source("jan.csv", *JANUARY)
    with monkeypatch.context() as patch:
        patch.setattr(loads, "write_ledger", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            incremental_load(spark, source.folder, table, ledger)
    assert read_ledger(spark, ledger).count() == 0
    incremental_load(spark, source.folder, table, ledger)
    assert read_table(spark, table).count() == 2 and read_ledger(spark, ledger).count() == 1


def test_paths_with_glob_characters_can_be_read_back(spark, source, tmp_path):
    table, ledger = str(tmp_path / "a[1]{b}*" / "t"), str(tmp_path / "a[1]{b}*" / "l")
    source("jan.csv", *JANUARY)
    batch_load(spark, source.folder, table, ledger)
    source("feb.csv", *FEBRUARY)
    assert incremental_load(spark, source.folder, table, ledger).files.count() == 1
    assert read_table(spark, table).count() == 4


def test_prices_are_rounded_once_after_adding(spark):
    data = [(i, "x", 1, 0.004, None, "home", 2019, 4) for i in range(1000)]
    report = reports.monthly_report(spark.createDataFrame(data, CLEANSED_SCHEMA))
    assert str(report.first().revenue) == "4.00"


@pytest.mark.parametrize("gate", ["header", "strict", "fail"])
def test_a_load_scans_the_text_once(spark, source, target, gate, monkeypatch):
    table, ledger = target
    for name in "abc":
        source(f"{name}.csv", *[line(i, name, 1, "01/05/19 10:00") for i in range(400)])
    scan, scans = loads.csv_scan_files, []

    def counted(*args, **kwargs):
        scans.append(Observation())
        return scan(*args, **kwargs).observe(scans[-1], F.count(F.lit(1)).alias("n"))

    monkeypatch.setattr(loads, "csv_scan_files", counted)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        batch_load(spark, source.folder, table, ledger, gate=gate)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [s.get["n"] for s in scans] == [1200]
    assert read_table(spark, table).count() == 1200


def test_new_files_are_those_the_ledger_does_not_name(spark, source, target):
    table, ledger = target
    source("jan.csv", *JANUARY)
    batch_load(spark, source.folder, table, ledger)
    assert loads.unseen_files(spark, list_files(spark, source.folder), ledger).count() == 0


def test_rows_without_a_date_are_added_to_their_folder_not_rewritten(spark, target):
    table, _ = target
    write_table(cleansed(spark, (1, "x", 1, None, None), (2, "x", 1, 2019, 4)), table)
    undated = f"{table}/year={tables._DEFAULT_PARTITION}/month={tables._DEFAULT_PARTITION}"
    (old,) = glob.glob(f"{undated}/*.parquet")
    months = upsert_rows(cleansed(spark, (3, None, 1, None, None), (2, "x", 5, None, None)), table)
    assert [tuple(m) for m in months] == [(2019, 4)]
    want = [(1, "x", 1, None, None), (2, "x", 5, None, None), (3, None, 1, None, None)]
    assert stored_rows(spark, table) == want
    assert old in glob.glob(f"{undated}/*.parquet")
    # Publishing the same rows again adds nothing.
    note = {"staged": None, "months": [], "undated": True}
    staged = storage.scratch_path(spark, "again")
    write_table(cleansed(spark, (3, None, 1, None, None)), staged)
    storage.write_text(spark, f"{table}/{tables._PENDING}", json.dumps(note | {"staged": staged}))
    upsert_rows(cleansed(spark), table)
    assert stored_rows(spark, table) == want
    assert upsert_rows(cleansed(spark, (9, "x", 1, None, None)), table) == []
    assert read_table(spark, table).count() == 4
