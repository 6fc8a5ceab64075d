import pytest
from conftest import HEADER, plan, rows
from pyspark.errors import AnalysisException

from tillroll.operators import gates, profiling
from tillroll.plans.loads import batch_load, union_gated, unusable_rows, usable_rows
from tillroll.sinks.ledger import write_ledger
from tillroll.sources import heads
from tillroll.sources.files import csv_reader, csv_scan, csv_scan_files, list_files, read_files
from tillroll.sources.heads import file_headers
from tillroll.sources.tables import new_files, read_ledger
from tillroll.storage import stored_scratch

GOOD = "1,x,2,3.5,04/19/19 08:46,\"917 1st St, Dallas, TX 75001\""
DRIFTED = "Product,Order ID,Quantity Ordered,Price Each,Order Date,Purchase Address"


def listing(spark, folder):
    return stored_scratch(list_files(spark, folder), "listing")


def names(df):
    return sorted(r.path.rsplit("/", 1)[1] for r in df.select("path").collect())


def test_listing_has_the_csv_files_of_the_folder_only(spark, source, tmp_path):
    paths = [source("file1.csv", GOOD), source("file 2 [x]{y}%20.csv", GOOD)]
    for other in ("_h.csv", ".d.csv", "n.CSV", "t.txt"):
        source(other, GOOD)
    (tmp_path / "source" / "sub").mkdir()
    source("sub/z.csv", GOOD)
    found = [r.path.removeprefix("file:") for r in list_files(spark, source.folder).collect()]
    assert sorted(found) == sorted(paths)


def test_missing_folder_is_an_error_and_empty_folder_is_not(spark, source, tmp_path):
    assert list_files(spark, source.folder).count() == 0
    with pytest.raises(AnalysisException):
        list_files(spark, str(tmp_path / "nowhere")).count()


def test_ledger_is_written_extended_and_subtracted(spark, source, target):
    _, ledger = target
    assert read_ledger(spark, ledger).count() == 0
    source("a.csv", GOOD)
    write_ledger(listing(spark, source.folder), ledger, "1", "overwrite")
    source("b.csv", GOOD)
    new = stored_scratch(new_files(list_files(spark, source.folder), read_ledger(spark, ledger)), "new")
    assert names(new) == ["b.csv"]
    write_ledger(new, ledger, "2", "append")
    assert names(read_ledger(spark, ledger)) == ["a.csv", "b.csv"]
    write_ledger(new, ledger, "3", "overwrite")
    assert names(read_ledger(spark, ledger)) == ["b.csv"]


def test_blank_lines_and_repeated_headers_have_no_key(spark, source):
    source("a.csv", GOOD, ",,,,,", HEADER, GOOD)
    scanned = csv_scan(spark, source.folder)
    good = (1, "x", 2, 3.5, "04/19/19 08:46", "917 1st St, Dallas, TX 75001")
    assert rows(scanned) == sorted(
        [good, good, (None,) * 6, (None, "Product", None, None, "Order Date", "Purchase Address")],
        key=repr,
    )
    inferred = csv_scan(spark, source.folder, schema=None)
    assert dict(inferred.dtypes)["Order ID"] == "int"


def test_whole_number_prices_are_prices(spark, source):
    a = source("a.csv", "1,x,2,11,04/19/19 08:46,home")
    b = source("b.csv", "2,x,2,11.5,04/19/19 08:46,home")
    assert rows(csv_scan(spark, [a, b]), "Price Each") == [(11.0,), (11.5,)]
    assert rows(union_gated(listing(spark, source.folder), "strict"), "Price Each") == [(11.0,), (11.5,)]


def test_files_with_another_header_are_rejected(spark, source):
    source("good.csv", GOOD)
    source("quoted.csv", GOOD, header=",".join(f'"{n}"' for n in HEADER.split(",")))
    source("late_header.csv", GOOD, HEADER, header="\n" + DRIFTED)
    source("blank_first.csv", GOOD, header="\n\n" + HEADER)
    source("drifted.csv", "x,1,2,3.5,04/19/19 08:46,home", header=DRIFTED)
    source("short.csv", "1,x", header="Order ID,Product")
    source("blank.csv", header="")
    files = listing(spark, source.folder)
    inspected = stored_scratch(gates.inspect_files(files), "inspected")
    assert names(gates.accepted_files(inspected)) == ["blank_first.csv", "good.csv", "quoted.csv"]
    reasons = {
        r.path.rsplit("/", 1)[1]: r.reason for r in gates.rejected_files(inspected).collect()
    }
    assert reasons == {
        "late_header.csv": "header differs",
        "drifted.csv": "header differs",
        "short.csv": "header differs",
        "blank.csv": "no lines",
    }
    assert union_gated(files).count() == 3


def test_a_wrong_value_costs_its_line_or_under_the_strict_gate_its_file(spark, source, target):
    source("good.csv", GOOD, ",,,,,", HEADER)
    source("bad.csv", GOOD, "2,y,two,4,04/19/19 08:46,home")
    files = listing(spark, source.folder)
    accepted = gates.accepted_files(gates.inspect_files(files))
    usable = usable_rows(accepted)
    assert usable.count() == 2
    assert "PushedFilters: [IsNotNull(Order ID)]" in plan(usable)
    assert "file_path" not in plan(usable)
    assert [r[0] for r in rows(unusable_rows(accepted), "reason")] == [
        "no order id",
        "no order id",
        "wrong value type",
    ]
    assert union_gated(files, "strict").count() == 3
    result = batch_load(spark, source.folder, *target, gate="strict")
    assert names(result.files) == ["good.csv"]
    assert [r.reason for r in result.rejected_files.collect()] == ["wrong value types"]


def test_short_and_long_lines_are_usable(spark, source):
    source("a.csv", "3,short", "4,long,1,1,04/19/19 08:46,home,extra")
    files = listing(spark, source.folder)
    assert rows(usable_rows(files), "Order ID", "Price Each") == [(3, None), (4, 1.0)]


def test_the_fail_gate_stops_the_scan_at_a_differing_header(spark, source):
    source("good.csv", GOOD)
    files = listing(spark, source.folder)
    assert usable_rows(gates.accepted_files(gates.inspect_files(files, "fail")), "fail").count() == 1
    source("drifted.csv", "x,1,2,3.5,04/19/19 08:46,home", header=DRIFTED)
    files = gates.accepted_files(gates.inspect_files(listing(spark, source.folder), "fail"))
    with pytest.raises(Exception, match="(?i)header"):
        usable_rows(files, "fail").collect()


def test_an_unknown_gate_is_an_error(spark, source):
    with pytest.raises(ValueError, match="gate"):
        gates.inspect_files(list_files(spark, source.folder), "none")


@pytest.mark.parametrize("gate", ["header", "strict", "fail"])
def test_all_gates_judge_headers_alike(spark, source, target, gate):
    source("lower.csv", GOOD, header=HEADER.lower())
    source("quoted.csv", GOOD, header=",".join(f'"{n}"' for n in HEADER.split(",")))
    source("blank_first.csv", GOOD, header="\n \n" + HEADER)
    assert batch_load(spark, source.folder, *target, gate=gate).n_files == 3
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        if gate == "fail":
            with pytest.raises(Exception, match="(?i)header"):
                batch_load(spark, source.folder, *target, gate=gate)
        else:
            assert batch_load(spark, source.folder, *target, gate=gate).n_files == 2
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_a_header_longer_than_a_read_is_not_cut(spark, source, monkeypatch):
    long = ",".join(f"column {i}" for i in range(2000))
    source("long.csv", "1", header="\n" * 5000 + long)
    source("crlf.csv", header="\r\na,b\r\n1,2\r\n")
    source("end.csv", header="only")
    open(f"{source.folder}/unended.csv", "w").write("a,b")
    found = {r.file_uri.rsplit("/", 1)[1]: r.header for r in file_headers(listing(spark, source.folder)).collect()}
    assert found["long.csv"] == long.split(",") and found["end.csv"] == ["only"]
    assert found["crlf.csv"] == found["unended.csv"] == ["a", "b"]
    assert heads.HEAD_BYTES < len(long)


def test_listing_takes_few_tasks_and_parts_however_long_the_files(spark, source, tmp_path):
    for i in range(200):
        source(f"{i}.csv", GOOD * 20)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        files = list_files(spark, source.folder)
        assert files.rdd.getNumPartitions() == 1
        files.write.parquet(str(tmp_path / "listing"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(list((tmp_path / "listing").glob("*.parquet"))) == 1
    assert spark.read.parquet(str(tmp_path / "listing")).count() == 200


def test_inferred_types_are_the_readers(spark, source):
    path = source("a.csv", "2019-04-19,12345678901234567890,NaN,1.5", header="d,n,x,p")
    found = {r.column_name: r.data_type for r in profiling.inferred_schema(spark, path).collect()}
    assert found == {"d": "date", "n": "decimal(20,0)", "x": "double", "p": "double"}


@pytest.mark.parametrize("limit", [100, 1])
def test_a_file_set_is_read_exactly_by_one_reader_or_several(spark, source, limit):
    for name in ("a b.csv", "c[1]{x}%20é.csv", "d.csv"):
        source(name, GOOD)
    files = listing(spark, source.folder)
    source("later.csv", GOOD)
    found = read_files(files, csv_reader(spark), paths_per_reader=limit)
    assert "Exchange" not in plan(found)
    assert rows(found, "file_uri") == rows(files, "file_uri")
    bare = read_files(files, csv_reader(spark), with_uri=False, paths_per_reader=limit)
    assert bare.count() == 3 and "file_uri" not in bare.columns


def test_no_files_read_as_no_rows(spark, source):
    assert csv_scan_files(listing(spark, source.folder)).count() == 0


def test_append_gate_ignores_nullability_only(spark):
    table = spark.createDataFrame([], "a int not null, b string").schema
    fits = spark.createDataFrame([], "a int, b string")
    assert gates.append_gate(fits, table) is fits
    for other in ("b string, a int", "a bigint, b string", "a int"):
        with pytest.raises(gates.SchemaMismatch):
            gates.append_gate(spark.createDataFrame([], other), table)
