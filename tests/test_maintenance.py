"""What is kept beside the table: index of order ids, totals, schema, contributions of files."""

import glob
import json
import os
import time

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import storage
from tillroll.operators import profiling
from tillroll.operators.cleansing import cleanse, keep_max
from tillroll.operators.evolution import evolved, fitted, wider
from tillroll.operators.gates import SchemaMismatch
from tillroll.plans import loads, reports
from tillroll.plans.loads import batch_load, incremental_load
from tillroll.schema import CLEANSED_SCHEMA, SOURCE_SCHEMA
from tillroll.sinks import key_index, ledger, profiles, settling, tables, totals
from tillroll.sinks.tables import append_rows, upsert_rows, write_table
from tillroll.sources.files import csv_scan
from tillroll.sources.tables import read_ledger, read_table, table_schema

KEPT = ("Order_ID", "Product", "Quantity_Ordered", "year", "month")


def cleansed(spark, *data):
    return spark.createDataFrame(
        [(o, p, q, 1.0, None, "home", y, m) for o, p, q, y, m in data], CLEANSED_SCHEMA
    )


def line(order, product, quantity, date="01/05/19 10:00", price=1.5, address="home"):
    return f"{order},{product},{quantity},{price},{date},{address}"


def stored_rows(spark, path):
    return rows(read_table(spark, path), *KEPT)


def test_rows_meet_the_range_of_their_own_month_only(spark, tmp_path):
    path = str(tmp_path / "table")
    months = [(2010 + i // 12, i % 12 + 1) for i in range(100)]
    old = [(10 * i + k, "bolt", 1, y, m) for i, (y, m) in enumerate(months) for k in range(3)]
    write_table(cleansed(spark, *old, (5000, "bolt", 1, None, None)), path)
    holding = [T.Row(year=y, month=m, low=10 * i, high=10 * i + 1) for i, (y, m) in enumerate(months)]
    holding.append(T.Row(year=None, month=None, low=5000, high=5000))
    new = cleansed(spark, (31, "bolt", 2, 2010, 5), (42, "bolt", 2, None, None), (5000, "bolt", 1, None, None))
    table = read_table(spark, path)
    within = tables._in_ranges(table, holding)
    assert rows(within, "Order_ID") == sorted([(10 * i + k,) for i in range(100) for k in range(2)] + [(5000,)], key=repr)
    # No row is held against all months: the plan does not grow with them.
    assert len(plan(within)) < 2 * len(plan(tables._in_ranges(table, holding[:2])))
    touched = tables.touched_months(new, table, holding)
    assert [tuple(m) for m in touched] == [(None, None), (2010, 4), (2010, 5)]


def test_only_rows_of_months_that_new_rows_do_not_name_meet_the_keys(spark, target, monkeypatch):
    path, _ = target
    old = [(10 * m + k, "bolt", 1, 2019, m) for m in range(1, 6) for k in range(3)]
    write_table(cleansed(spark, *old, (70, "bolt", 1, None, None), (71, None, 1, 2019, 5)), path)
    key_index.fill(read_table(spark, path), path)
    new = cleansed(
        spark,
        (11, "bolt", 2, 2019, 1), (12, "bolt", 2, 2019, 2), (31, "bolt", 2, 2019, 2),
        (71, None, 2, 2019, 1), (70, "bolt", 2, None, None), (40, "nut", 2, 2019, 7),
    )
    table, same_key, met = read_table(spark, path), tables._same_key, []
    monkeypatch.setattr(tables, "_same_key", lambda df, keys: met.append(df) or same_key(df, keys))

    def touched(incoming, *holding):
        return [tuple(m) for m in tables.touched_months(incoming, table, *holding)]

    holding = key_index.months_holding(spark, path, new)
    want = [(None, None), (2019, 1), (2019, 2), (2019, 3), (2019, 5), (2019, 7)]
    assert touched(new, holding) == touched(new) == want
    for df in met:
        found = {r.month for r in df.select("month").distinct().collect()}
        assert found and not found & {1, 2, 7}
    undated, dated = new.filter("month IS NULL"), new.filter("Order_ID = 11")
    assert touched(undated) == [(None, None)]
    assert touched(dated) == [(2019, 1)]


# --- index of order ids -------------------------------------------------------------------


def holding(spark, table, *ids):
    wanted = spark.createDataFrame([(i,) for i in ids], "Order_ID long")
    found = key_index.months_holding(spark, table, wanted)
    return sorted([(m.year, m.month, m.low, m.high) for m in found], key=repr)


def test_the_index_names_exactly_the_months_that_hold_an_id(spark, target):
    table, _ = target
    data = [(i, "x", 1, 2019, 1 + i // 1000) for i in range(0, 3000, 2)] + [(-7, None, 1, None, None), (2**62, "x", 1, 2019, 9)]
    write_table(cleansed(spark, *data), table)
    key_index.fill(read_table(spark, table), table)
    assert holding(spark, table, 4, 5) == [(2019, 1, 0, 63)]
    assert holding(spark, table, 5, 1001, 2999) == []
    assert holding(spark, table, 130, 900, 1500, 2998) == [
        (2019, 1, 128, 959), (2019, 2, 1472, 1535), (2019, 3, 2944, 3007),
    ]
    assert holding(spark, table, 2**62) == [(2019, 9, 2**62, 2**62 + 63)]
    index = spark.read.schema(key_index._SCHEMA).parquet(key_index.index_path(table))
    assert [(r.year, r.word) for r in index.filter("year IS NULL").collect()] == [(None, -1)]


def test_a_merge_of_scattered_ids_reads_keys_of_few_months(spark, target, monkeypatch):
    table, _ = target
    write_table(cleansed(spark, *[(i, "x", 1, 2019, 1 + i // 100) for i in range(1200)]), table)
    upsert_rows(cleansed(spark, (1, "x", 2, 2019, 1)), table)  # fills the index
    scans = []
    months = tables._months
    monkeypatch.setattr(tables, "_months", lambda df: scans.append(df) or months(df))
    # A low and a high id: their range is the whole table, they are of two months.
    changed = upsert_rows(cleansed(spark, (5, "x", 9, 2019, 1), (1150, "x", 9, 2019, 12)), table)
    assert [tuple(m) for m in changed] == [(2019, 1), (2019, 12)]
    read = [f for f in scans[0].inputFiles() if f.startswith("file:" + table) or table in f]
    text = plan(scans[0])
    assert read and "Purchase_Address" not in text
    pruned = [p.split("]")[0] for p in text.split("PartitionFilters: [")[1:]]
    assert any("201901" in p and "201912" in p for p in pruned)
    scanned = tables.read_table(spark, table).filter(tables.in_months(changed)).select(F.input_file_name().alias("f"))
    assert scanned.distinct().count() == 2
    assert (5, "x", 9, 2019, 1) in stored_rows(spark, table)
    assert read_table(spark, table).count() == 1200


def test_the_index_follows_merges_and_appends(spark, target):
    table, _ = target
    write_table(cleansed(spark, (1, "x", 1, 2019, 4), (70, "x", 1, 2019, 5)), table)
    upsert_rows(cleansed(spark, (2, "x", 1, 2019, 4), (3, "x", 1, None, None)), table)
    assert holding(spark, table, 2, 3) == [(2019, 4, 0, 63), (None, None, 0, 63)]
    append_rows(cleansed(spark, (500, "y", 1, 2019, 7)), table)
    assert holding(spark, table, 500) == [(2019, 7, 448, 511)]
    # The appended row is displaced by a merge that only the index can lead to it.
    assert [tuple(m) for m in upsert_rows(cleansed(spark, (500, "y", 5, 2019, 4)), table)] == [(2019, 4), (2019, 7)]
    assert (500, "y", 5, 2019, 4) in stored_rows(spark, table)
    assert read_table(spark, table).filter("Order_ID = 500").count() == 1
    # A write past the index makes it void; the next merge fills it again.
    write_table(cleansed(spark, (9, "x", 1, 2019, 4)), table)
    assert not key_index.is_ready(spark, table)
    upsert_rows(cleansed(spark, (9, "x", 2, 2019, 5)), table)
    assert stored_rows(spark, table) == [(9, "x", 2, 2019, 5)]


# --- order within months --------------------------------------------------------------------


def many_rows(spark, n=40_000):
    return spark.range(0, n, 1, 8).select(
        ((F.col("id") * 7919) % n).alias("Order_ID"),
        F.lit("x").alias("Product"),
        F.lit(1).alias("Quantity_Ordered"),
        F.rand(1).alias("Price_Each"),
        F.lit(None).cast("timestamp").alias("Order_Date"),
        F.sha2(F.col("id").cast("string"), 256).alias("Purchase_Address"),
        F.when(F.col("id") >= 0, 2019).otherwise(0).alias("year"),
        # One month holds half of all rows.
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 11 + 2).cast("int").alias("month"),
    )


def scanned_rows(df):
    """Rows that a scan gave out: those of row groups and pages it did not skip."""
    df.collect()
    found = []

    def walk(node):
        if "Scan" in node.nodeName():
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            walk(node.plan())

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found)


def test_a_clustered_table_skips_what_a_key_lookup_does_not_want(spark, target):
    table, _ = target
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("parquet.block.size", str(32 << 10))
    scanned = {}
    try:
        for layout in ("rebalance", "clustered"):
            write_table(many_rows(spark), f"{table}-{layout}", layout=layout)
            read = read_table(spark, f"{table}-{layout}").filter("year = 2019 AND month = 1")
            scanned[layout] = scanned_rows(read.filter("Order_ID BETWEEN 1000 AND 1010"))
            assert read.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("parquet.block.size")
    assert scanned["clustered"] < 3000 < scanned["rebalance"]
    # A large month is cut by id: its files hold ranges that do not overlap.
    files = read_table(spark, f"{table}-clustered").filter("month = 1").groupBy(F.input_file_name().alias("f"))
    ranges = sorted((r.a, r.b) for r in files.agg(F.min("Order_ID").alias("a"), F.max("Order_ID").alias("b")).collect())
    assert len(ranges) > 2
    assert all(b < c for (_, b), (c, _) in zip(ranges, ranges[1:]))
    # Tasks are ranges, so files are about as many as tasks and months, not their product.
    assert len(glob.glob(f"{table}-clustered/*/*/*.parquet")) < 40


# --- rejects --------------------------------------------------------------------------------


def test_rejects_are_filtered_in_as_many_tasks_as_the_lines_fill(spark, tmp_path):
    lines = spark.range(0, 4000, 1, 16).withColumn("reason", F.when(F.col("id") % 500 == 0, "no order id"))
    stored = storage.stored(lines, str(tmp_path / "lines"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    tasks = spark.sparkContext.accumulator(0)
    try:
        rejected = stored.filter("reason IS NOT NULL")
        assert rejected.rdd.getNumPartitions() > 8

        def counted(batches):
            tasks.add(1)
            yield from batches

        spied = rejected.mapInArrow(counted, rejected.schema)
        ledger.write_rejects(spied, str(tmp_path / "ledger"), "rows", "b")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert tasks.value > 8
    assert len(glob.glob(str(tmp_path / "ledger_rejected/rows/batch_id=b/*.parquet"))) == 1


# --- kept totals ----------------------------------------------------------------------------


def reported(df):
    return rows(df.withColumn("revenue", F.col("revenue").cast("string")), "year", "month", "n_lines", "units", "revenue")


def test_kept_totals_follow_every_write(spark, target):
    table, _ = target
    write_table(cleansed(spark, (1, "x", 1, 2019, 4), (2, "x", 1, 2019, 5), (3, "x", 2, None, None)), table)

    def same():
        kept = reported(reports.kept_report(spark, table))
        assert kept == reported(reports.monthly_report(read_table(spark, table)))
        return totals.state(spark, table)

    assert same() is None
    reports.keep_totals(spark, table)
    assert same()["stale"] == []
    upsert_rows(cleansed(spark, (2, "x", 9, 2019, 6), (4, "y", 1, None, None)), table)  # May is left empty
    assert same()["stale"] == []
    append_rows(cleansed(spark, (1, "x", 1, 2019, 4), (1, "x", 1, 2020, 1)), table)
    assert same()["stale"] == []
    assert rows(reports.kept_report(spark, table, (2019, 5), (2020, 1), by="year"), "year", "units") == [(2019, 9), (2020, 1)]
    assert len(os.listdir(f"{table}_meta")) <= 8  # former versions of the totals are gone
    write_table(cleansed(spark, (1, "x", 1, 2021, 4)), table)
    assert same() is None


def test_a_report_reads_a_row_per_month_and_not_the_table(spark, target):
    table, _ = target
    write_table(many_rows(spark, 4000), table)
    reports.keep_totals(spark, table)
    report = reports.kept_report(spark, table)
    assert scanned_rows(report) == 12
    assert not any(f"{table}/" in f for f in report.inputFiles())


def test_a_write_that_dies_leaves_no_wrong_totals(spark, target, monkeypatch):
    table, _ = target
    write_table(cleansed(spark, (1, "x", 1, 2019, 4), (2, "x", 1, 2019, 5)), table)
    reports.keep_totals(spark, table)

    def failing(*_args, **_kw):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(totals, "renew", failing)
        with pytest.raises(OSError):
            append_rows(cleansed(spark, (7, "x", 3, 2019, 5)), table)
    assert totals.state(spark, table)["stale"] == [[2019, 5]]
    assert reported(reports.kept_report(spark, table)) == reported(reports.monthly_report(read_table(spark, table)))
    with monkeypatch.context() as patch:
        patch.setattr(totals, "renew", failing)
        with pytest.raises(OSError):
            upsert_rows(cleansed(spark, (1, "x", 3, 2019, 8)), table)
    upsert_rows(cleansed(spark, (99, "x", 3, 2019, 8)), table)
    assert totals.state(spark, table)["stale"] == []
    assert reported(reports.kept_report(spark, table)) == reported(reports.monthly_report(read_table(spark, table)))


# --- schema evolution -----------------------------------------------------------------------


def test_the_lattice_of_types():
    whole, real = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()), (T.FloatType(), T.DoubleType())
    assert wider(whole[0], whole[3]) == whole[3] and wider(real[1], real[0]) == real[1]
    assert wider(T.IntegerType(), T.DoubleType()) == T.DoubleType()
    assert wider(T.LongType(), T.DoubleType()) is None and wider(T.IntegerType(), T.FloatType()) is None
    assert wider(T.DecimalType(10, 2), T.DecimalType(9, 4)) == T.DecimalType(12, 4)
    assert wider(T.DecimalType(38, 0), T.DecimalType(10, 4)) is None
    assert wider(T.StringType(), T.LongType()) is None
    kinds = [*whole, *real, T.DecimalType(10, 2), T.DecimalType(12, 4), T.StringType()]
    for a in kinds:  # a least upper bound: commutative and idempotent, and associative where defined
        assert wider(a, a) == a
        for b in kinds:
            assert wider(a, b) == wider(b, a)
            for c in kinds:
                ab, bc = wider(a, b), wider(b, c)
                if ab is not None and bc is not None:
                    assert wider(ab, c) == wider(a, bc)


def test_a_table_takes_new_columns_and_wider_numbers(spark, target):
    table, _ = target
    old = cleansed(spark, (1, "x", 5, 2019, 4), (2, "x", 1, 2019, 5)).withColumn("Price_Each", F.lit(3))
    write_table(old, table)
    assert table_schema(spark, table)["Price_Each"].dataType == T.IntegerType()
    new = cleansed(spark, (1, "x", 7, 2019, 4), (3, "y", 1, 2019, 6)).withColumn("Price_Each", F.lit(2.5))
    new = new.withColumn("Channel", F.lit("web"))
    for write in (append_rows, upsert_rows):
        with pytest.raises(SchemaMismatch):
            write(new, table)
    upsert_rows(new, table, evolve=True)
    names = table_schema(spark, table).fieldNames()
    assert names[-3:] == ["Channel", "year", "month"]
    # May was not rewritten: its file is read under the newer schema.
    assert rows(read_table(spark, table), "Order_ID", "Price_Each", "Channel", "month") == [
        (1, 2.5, "web", 4), (2, 3.0, None, 5), (3, 2.5, "web", 6),
    ]
    # Rows of the older contract still fit.
    append_rows(cleansed(spark, (4, "x", 1, 2019, 7)), table, evolve=True)
    upsert_rows(cleansed(spark, (2, "x", 8, 2019, 5)), table, evolve=True)
    assert rows(read_table(spark, table).filter("Channel IS NULL"), "Order_ID", "Quantity_Ordered") == [(2, 8), (4, 1)]
    assert rows(reports.monthly_report(read_table(spark, table)), "month", "units") == [(4, 7), (5, 8), (6, 1), (7, 1)]
    write_table(cleansed(spark, (1, "x", 1, 2019, 4)), table)
    assert table_schema(spark, table) == CLEANSED_SCHEMA


def test_changes_that_would_lose_something_are_refused(spark):
    table = CLEANSED_SCHEMA

    def with_type(name, kind):
        return T.StructType([T.StructField(f.name, kind if f.name == name else f.dataType) for f in table.fields])

    for name, kind in (("Price_Each", T.StringType()), ("Order_ID", T.DoubleType()), ("year", T.LongType())):
        with pytest.raises(SchemaMismatch):
            evolved(table, with_type(name, kind))
    with pytest.raises(SchemaMismatch):
        evolved(table, T.StructType([f for f in table.fields if f.name != "Product"]))
    assert evolved(table, with_type("Price_Each", T.FloatType())) == table
    less = T.StructType([f for f in table.fields if f.name != "Purchase_Address"])
    assert evolved(table, less) == table
    frame = spark.createDataFrame([], less)
    assert fitted(frame, table).schema.fieldNames() == table.fieldNames()


# --- corrected files ------------------------------------------------------------------------


def same_as_full_load(spark, source, table, tmp_path):
    whole = str(tmp_path / f"whole-{len(os.listdir(tmp_path))}")
    batch_load(spark, source.folder, whole, f"{whole}_ledger")
    columns = CLEANSED_SCHEMA.fieldNames()
    assert rows(read_table(spark, table), *columns) == rows(read_table(spark, whole), *columns)


def test_a_corrected_file_replaces_its_former_version(spark, source, target, tmp_path):
    table, ledger = target
    source("a.csv", line(1, "x", 2), line(2, "x", 1), line(3, "", 4, "02/05/19 10:00"))
    source("b.csv", line(1, "x", 9, "02/01/19 10:00"), line(5, "y", 1), line(3, "", 9), line(6, "z", 1, "no date"))
    batch_load(spark, source.folder, table, ledger, track_files=True)
    same_as_full_load(spark, source, table, tmp_path)
    source("c.csv", line(1, "x", 5, "03/01/19 10:00"), line(8, "c", 1))
    incremental_load(spark, source.folder, table, ledger, track_files=True)
    # The corrected file loses order 1, whose lines in a and c come back, and its undated row.
    source("b.csv", line(5, "y", 3, "04/01/19 10:00"), line(3, "", 1))
    result = incremental_load(spark, source.folder, table, ledger, track_files=True)
    assert result.n_files == 1
    same_as_full_load(spark, source, table, tmp_path)
    assert read_table(spark, table).filter("Order_ID = 1 AND Quantity_Ordered = 5").count() == 1
    assert incremental_load(spark, source.folder, table, ledger, track_files=True).n_files == 0
    # Again, together with a new file, down to nothing but a header line.
    source("c.csv", ",,,,,")
    source("d.csv", line(8, "c", 2), line(9, "d", 1))
    incremental_load(spark, source.folder, table, ledger, track_files=True)
    same_as_full_load(spark, source, table, tmp_path)


@pytest.mark.parametrize("dies_at", ["write_ledger", "upsert_rows"])
def test_a_correction_that_dies_can_be_repeated(spark, source, target, tmp_path, monkeypatch, dies_at):
    table, ledger = target
    source("a.csv", line(1, "x", 2), line(2, "x", 1))
    source("b.csv", line(1, "x", 9), line(5, "y", 1))
    batch_load(spark, source.folder, table, ledger, track_files=True)
    source("b.csv", line(7, "z", 1), line(5, "y", 1))

    def failing(*_args, **_kw):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(loads, dies_at, failing)
        with pytest.raises(OSError):
            incremental_load(spark, source.folder, table, ledger, track_files=True)
    # Corrected once more before the repetition: what the dead load has left goes too.
    source("b.csv", line(8, "z", 1), line(5, "y", 4))
    incremental_load(spark, source.folder, table, ledger, track_files=True)
    same_as_full_load(spark, source, table, tmp_path)
    assert read_ledger(spark, ledger).count() == 3


def test_without_tracking_a_changed_file_is_not_looked_at(spark, source, target):
    table, ledger = target
    source("a.csv", line(1, "x", 2))
    batch_load(spark, source.folder, table, ledger)
    source("a.csv", line(1, "x", 2), line(2, "x", 1))
    assert incremental_load(spark, source.folder, table, ledger).n_files == 0
    for kw in ({"mode": "append"}, {"fmt": "delta"}, {"schema": T.StructType(SOURCE_SCHEMA.fields[:3])}):
        with pytest.raises(ValueError, match="tracked"):
            incremental_load(spark, source.folder, table, ledger, track_files=True, **kw)


# --- packing --------------------------------------------------------------------------------


def n_files(table):
    return len(glob.glob(f"{table}/*/*/*.parquet"))


@pytest.mark.parametrize("dies", [False, True])
def test_many_appends_end_in_few_files(spark, target, monkeypatch, dies):
    table, _ = target
    write_table(cleansed(spark, (0, "x", 1, 2019, 4), (1, "x", 1, 2019, 5)), table)
    small = cleansed(spark, *[(10 + i, "y", 1, 2019, 4) for i in range(40)], *[(99, None, 1, None, None)])
    for _ in range(3):
        append_rows(small.repartition(20), table, layout="as_is")
    before, other = n_files(table), glob.glob(f"{table}/year=2019/month=5/*.parquet")
    want = stored_rows(spark, table)
    assert before > 40
    if dies:
        with monkeypatch.context() as patch:
            patch.setattr(tables, "_publish_pending", lambda *_: None)
            tables.pack_table(spark, table)
        assert os.path.exists(f"{table}/_pending_merge") and n_files(table) == before
        assert tables.pack_table(spark, table) == []
    else:
        assert [tuple(m) for m in tables.pack_table(spark, table)] == [(2019, 4)]
    # One file, and those of the months that are not crowded.
    assert n_files(table) <= 1 + 1 + 3
    assert glob.glob(f"{table}/year=2019/month=5/*.parquet") == other
    assert stored_rows(spark, table) == want
    assert [tuple(m) for m in tables.pack_table(spark, table, spare_files=2)] == [(None, None)]
    assert stored_rows(spark, table) == want
    assert tables.pack_table(spark, f"{table}-none") == []


@pytest.mark.parametrize("dies", [False, True])
def test_a_packed_ledger_names_the_same_files(spark, source, target, monkeypatch, dies):
    table, path = target
    for i in range(5):
        source(f"{i}.csv", line(i, "x", 1))
        incremental_load(spark, source.folder, table, path)
    want = rows(read_ledger(spark, path), "path", "batch_id")
    many = len(glob.glob(f"{path}/*.parquet"))
    if dies:
        with monkeypatch.context() as patch:
            finish, calls = ledger._finish_packing, []
            patch.setattr(ledger, "_finish_packing", lambda *a: calls.append(a) or (finish(*a) if len(calls) < 2 else None))
            ledger.pack_ledger(spark, path)
        for f in glob.glob(f"{path}/*.parquet")[1:]:
            os.remove(f)  # as if the replacement had died half way
        assert rows(read_ledger(spark, path), "path", "batch_id") == want
    else:
        ledger.pack_ledger(spark, path)
        assert len(glob.glob(f"{path}/*.parquet")) == 1 < many
    source("new.csv", line(9, "x", 1))
    assert incremental_load(spark, source.folder, table, path).n_files == 1
    assert rows(read_ledger(spark, path).filter("path NOT LIKE '%new.csv'"), "path", "batch_id") == want
    assert incremental_load(spark, source.folder, table, path).n_files == 0
    assert not glob.glob(f"{path}_copy-*") and not os.path.exists(f"{path}_packing")
    ledger.pack_ledger(spark, f"{path}-none")


# --- what lies on disk ----------------------------------------------------------------------


SPREAD = [
    (1, "x", 5, 2019, 1), (1, "x", 9, 2019, 1), (1, "x", 9, 2019, 1), (1, "x", 7, 2019, 2), (1, "y", 1, 2019, 1),
    (2, None, 3, 2019, 1), (2, None, 2, None, None), (3, "x", 1, 2019, 2), (3, "x", None, 2019, 2),
    (70, "x", 1, 2019, 1), (70, "x", 2, 2019, 1), (-5, "x", 1, None, None), (-5, "x", 1, 2019, 2), (2**62, "z", 1, 2019, 2),
    (None, "x", 1, 2019, 1), (None, "x", 2, 2019, 2), (None, None, 1, 2019, 1),
]


@pytest.mark.parametrize("limits", [{}, {"HOT_ROWS": 1}, {"APART_WORDS": 0}])
def test_settling_keeps_what_keep_max_does(spark, tmp_path, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(settling, name, value)
    data = cleansed(spark, *SPREAD).repartition(3)
    settled = settling.settled(data, settling.line_words(data), str(tmp_path / "apart"))
    text = plan(settled)
    assert rows(settled) == rows(keep_max(data, tables.STORED_KEYS, tables.STORED_QUANTITY))
    if "APART_WORDS" in limits:
        return
    # One exchange of all rows, and one by key for the ids of several months.
    assert text.count("rangepartitioning(year") == 1
    assert text.count("hashpartitioning(Order_ID") == 1
    apart = rows(spark.read.parquet(str(tmp_path / "apart")), "word", "bits")
    if not limits:
        assert apart == [(-1, 1 << 59), (0, 1 << 1 | 1 << 2)]
    else:
        assert (1, -1) in apart


def test_a_load_that_settles_on_the_way_equals_a_cleansed_write(spark, source, target, tmp_path):
    source("a.csv", line(1, "x", 2), line(1, "x", 4, "02/05/19 10:00"), line(1, "x", 4, "03/05/19 10:00"), line(2, "", 1))
    source("b.csv", line(1, "x", 4, "no date"), line(2, "", 1), line(2, "", 3, "02/01/19 10:00"), line(9, "y", 1))
    want = rows(csv_scan(spark, source.folder).transform(cleanse), *KEPT)
    for mode in ("append", "upsert"):
        path = str(tmp_path / mode)
        incremental_load(spark, source.folder, path, f"{path}_ledger", mode)
        assert stored_rows(spark, path) == want
        # Again, into a table that has them.
        incremental_load(spark, source.folder, path, f"{path}_other", mode)
        assert stored_rows(spark, path) == sorted(want * (2 if mode == "append" else 1), key=repr)
    for layout in ("clustered", "rebalance"):
        path = str(tmp_path / layout)
        batch_load(spark, source.folder, path, f"{path}_ledger", layout=layout, track_files=layout == "clustered")
        assert stored_rows(spark, path) == want


def test_published_files_are_those_that_were_staged(spark, target, monkeypatch):
    table, _ = target
    write_table(cleansed(spark, (1, "x", 1, 2019, 4), (2, "x", 1, 2019, 5), (3, "x", 1, None, None)), table)
    staged, publish = [], tables._publish

    def watched(spark, path, folder, *rest):
        staged.extend(os.path.basename(f) for f in glob.glob(f"{folder}/*/*/*.parquet"))
        return publish(spark, path, folder, *rest)

    monkeypatch.setattr(tables, "_publish", watched)
    upsert_rows(cleansed(spark, (1, "x", 2, 2019, 5), (3, "x", 2, 2019, 6)), table)
    assert stored_rows(spark, table) == [(1, "x", 2, 2019, 5), (2, "x", 1, 2019, 5), (3, "x", 2, 2019, 6)]
    assert sorted(os.path.basename(f) for f in glob.glob(f"{table}/*/*/*.parquet")) == sorted(staged)
    staged.clear()
    append_rows(cleansed(spark, (7, "x", 1, 2019, 5), (8, "x", 1, None, None)), table)
    tables.pack_table(spark, table, spare_files=1)
    assert staged and set(staged) <= {os.path.basename(f) for f in glob.glob(f"{table}/*/*/*.parquet")}
    assert not glob.glob(f"{table}_merged-*") and not glob.glob(f"{table}_packed-*")


def test_a_publishing_that_dies_between_months_is_finished(spark, target, monkeypatch):
    table, _ = target
    write_table(cleansed(spark, (1, "x", 1, 2019, 4), (2, "x", 1, 2019, 5), (3, "x", 1, 2019, 6)), table)
    reports.keep_totals(spark, table)
    move = storage.move_folders

    def dying(spark, moves):
        move(spark, dict([*moves.items()][:1]))
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(storage, "move_folders", dying)
        with pytest.raises(OSError):
            upsert_rows(cleansed(spark, (1, "x", 5, 2019, 5), (3, "x", 5, 2019, 6), (4, "x", 5, 2019, 7)), table)
    upsert_rows(cleansed(spark, (5, "x", 5, 2019, 8)), table)
    want = [(1, "x", 5, 2019, 5), (2, "x", 1, 2019, 5), (3, "x", 5, 2019, 6), (4, "x", 5, 2019, 7), (5, "x", 5, 2019, 8)]
    assert stored_rows(spark, table) == want
    # Months left without rows keep their bits.
    assert holding(spark, table, 1, 2, 3, 4, 5) == [(2019, m, 0, 63) for m in (4, 5, 6, 7, 8)]
    assert reported(reports.kept_report(spark, table)) == reported(reports.monthly_report(read_table(spark, table)))


def test_a_note_of_an_earlier_version_is_published(spark, target):
    table, _ = target
    write_table(cleansed(spark, (1, "x", 1, 2019, 4), (2, "x", 1, 2019, 5)), table)
    staged = storage.scratch_path(spark, "merged")
    write_table(cleansed(spark, (1, "x", 2, 2019, 4)), staged)
    note = {"staged": staged, "months": [[2019, 4], [2019, 5]], "undated": False}
    storage.write_text(spark, f"{table}/{tables._PENDING}", json.dumps(note))
    upsert_rows(cleansed(spark, (9, "x", 1, 2019, 6)), table)
    assert stored_rows(spark, table) == [(1, "x", 2, 2019, 4), (9, "x", 1, 2019, 6)]
    assert not os.path.exists(staged)


def test_loads_and_packing_leave_no_shuffle_files(spark, source, target):
    table, path = target
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        names = (disk.getAllFiles().apply(i).getName() for i in range(disk.getAllFiles().size()))
        return {name for name in names if name.startswith("shuffle_")}

    source("a.csv", *[line(i, "x", 1, f"0{1 + i % 9}/05/19 10:00") for i in range(50)])
    before = shuffled()
    batch_load(spark, source.folder, table, path)
    source("b.csv", *[line(i, "x", 2, f"0{1 + i % 9}/05/19 10:00") for i in range(50)])
    incremental_load(spark, source.folder, table, path)
    source("c.csv", line(1, "y", 2))
    incremental_load(spark, source.folder, table, path, "append")
    assert tables.pack_table(spark, table, spare_files=1)
    for _ in range(50):  # they are deleted in the background
        if shuffled() <= before:
            break
        time.sleep(0.2)
    assert shuffled() <= before


# --- kept profiles --------------------------------------------------------------------------


def test_a_kept_profile_equals_the_profile_of_all_lines(spark, source, target, monkeypatch):
    table, path = target
    source("a.csv", line(1, "x", 2, price=1e15), ",,,,,", line(3, "", 4, price=1e15 + 2))
    source("b.csv", line(5, "12", 1, price=1e15 + 1))
    batch_load(spark, source.folder, table, path, keep_profile=True, track_files=True)
    source("c.csv", line(7, "-3.5", 1, price=-4), line(2**60, "é", 9))
    seen, states = [], profiles.column_states
    monkeypatch.setattr(profiles, "column_states", lambda df, **kw: seen.append(df.count()) or states(df, **kw))
    incremental_load(spark, source.folder, table, path, keep_profile=True, track_files=True)
    source("b.csv", line(6, "13", 2), line(6, "14", 3))
    incremental_load(spark, source.folder, table, path, keep_profile=True, track_files=True)
    assert seen == [2, 2]  # the lines of the new file, and of the corrected one
    lines = csv_scan(spark, source.folder)
    want = {r.column_name: r.asDict() for r in profiling.describe_profile(lines).collect()}
    nulls = profiling.null_profile(lines).first().asDict()
    with_key = profiling.null_profile(lines.filter("`Order ID` IS NOT NULL")).first().asDict()
    found = {r.column_name: r.asDict() for r in profiles.kept_profile(spark, path).collect()}
    for name, row in want.items():
        got = found.pop(name)
        assert (got.pop("n_null"), got.pop("n_null_with_key")) == (nulls[name], with_key[name])
        for c in ("mean", "sd"):
            a, b = got.pop(c), row.pop(c)
            assert a == b or a == pytest.approx(b, rel=1e-9)
        assert got == row
    assert not found
    with pytest.raises(ValueError, match="no profiles"):
        profiles.kept_profile(spark, f"{path}-none")


# --- distinct estimates and top keys -----------------------------------------------------------


def test_estimates_come_near_without_reading_rows(spark, target):
    table, _ = target
    write_table(many_rows(spark), table)
    reports.keep_totals(spark, table)
    estimate = reports.kept_distinct(spark, table)
    assert abs(estimate.first().orders - 40_000) < 0.05 * 40_000
    assert estimate.first().products == 1
    assert not any(f"{table}/" in f for f in estimate.inputFiles())
    assert abs(reports.kept_distinct(spark, table, (2019, 1), (2019, 1)).first().orders - 20_000) < 1000
    # An order of two months counts once in their union: estimates are of unions, not sums.
    append_rows(cleansed(spark, *[(i, "x", 1, 2019, 2) for i in range(0, 40_000, 2)]), table)
    assert abs(reports.kept_distinct(spark, table).first().orders - 40_000) < 0.05 * 40_000
    months = reports.kept_distinct(spark, table, by=("year", "month"))
    assert months.count() == 12


def test_top_keys_from_bucket_counts_equal_those_from_all_counts(spark, monkeypatch):
    keys = ["k", "p"]
    data = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 1, F.col("id") % 40).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 7 > 0, F.lit("x")).alias("p"),
    )
    want = rows(profiling.top_dup_keys(data, keys, 5))
    counted = []
    key_counts = profiling.key_counts

    def spied(df, by=keys):
        out = key_counts(df, by)
        if list(by) == keys:
            counted.append(out.count())
        return out

    monkeypatch.setattr(profiling, "key_counts", spied)
    assert rows(profiling.top_dup_keys_of_stored(data, keys, 5)) == want
    assert counted[-1] < 1000 < data.distinct().count()  # few keys were counted one by one
    # Too few buckets to tell keys apart, ties at the end, fewer keys than asked for, none.
    for n, buckets, fullest in ((20, 4, 2), (37, 64, 3), (50, 1 << 20, 60)):
        got = profiling.top_dup_keys_of_stored(data, keys, n, buckets, fullest)
        assert rows(got) == rows(profiling.top_dup_keys(data, keys, n))
    few = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, p string")
    assert rows(profiling.top_dup_keys_of_stored(few, keys, 20)) == [(1, "a", 2), (2, None, 1)]
    assert profiling.top_dup_keys_of_stored(few.filter("k > 9"), keys).count() == 0
