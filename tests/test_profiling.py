import statistics

from conftest import HEADER, plan, rows

from tillroll.operators import profiling
from tillroll.schema import SOURCE_SCHEMA
from tillroll.sources.files import list_files
from tillroll.storage import stored_scratch

DATA = [
    (1, "x", 2, 1.5, "d1", "home"),
    (1, "x", 2, 1.5, "d1", "home"),
    (1, "x", 3, None, "d1", "home"),
    (1, None, 3, 2.5, "d1", "12"),
    (2, "x", None, 4.5, None, "3.5"),
    (None, "x", 1, 1.0, None, None),
]


def frame(spark):
    return spark.createDataFrame(DATA, SOURCE_SCHEMA)


def test_null_profile(spark):
    assert rows(profiling.null_profile(frame(spark))) == [(1, 1, 1, 1, 2, 1)]
    p = profiling.profile(frame(spark))
    assert rows(p.nulls_with_key) == [(0, 1, 1, 1, 1, 0)]
    assert rows(p.levels) == [(5, 4, 3)]
    assert rows(p.top_keys)[0] == (1, "x", 3)


def test_describe(spark):
    found = {r.column_name: r for r in profiling.describe_profile(frame(spark)).collect()}
    assert list(found) == SOURCE_SCHEMA.fieldNames()
    prices = [r[3] for r in DATA if r[3] is not None]
    price, address = found["Price Each"], found["Purchase Address"]
    assert (price.n, price.min_number, price.max_number) == (5, 1.0, 4.5)
    assert abs(price.mean - statistics.mean(prices)) < 1e-9
    assert abs(price.sd - statistics.stdev(prices)) < 1e-9
    assert (address.n, address.mean, address.min_text, address.max_text) == (5, 7.75, "12", "home")


def test_counts_by_key(spark):
    keyed = frame(spark).filter("`Order ID` is not null")
    assert rows(profiling.dup_key_counts(keyed)) == [(1, "x", 3)]
    assert [tuple(r) for r in profiling.top_dup_keys(keyed, n=2).collect()] == [(1, "x", 3), (1, None, 1)]


def test_levels_of_no_rows(spark):
    assert rows(profiling.count_levels(frame(spark).limit(0))) == [(0, 0, 0)]


def test_counts_combine_before_each_shuffle_and_do_not_expand(spark):
    text = plan(profiling.count_levels(frame(spark)))
    assert "Expand" not in text
    for step in text.split("Exchange ")[1:]:
        assert "partial_" in step


def test_required_violations(spark):
    df = frame(spark).toDF("Order_ID", "Product", "Quantity_Ordered", "p", "Order_Date", "a")
    assert profiling.required_violations(df).count() == 3


def test_schema_rows(spark):
    found = profiling.schema_rows(frame(spark)).collect()
    assert tuple(found[0]) == (1, "Order ID", "bigint", True)
    assert len(found) == 6


def test_file_schemas(spark, source):
    source("a.csv", "1,x,2,3,04/19/19 08:46,home", ",,,,,", HEADER)
    source("b.csv", "A-1,true,1.5,3000000000,2019-04-19 08:46,NaN", "1,FALSE,7,,2019-04-19,1.5d", header='"Order ID",b,c,"Quantity Ordered",e,Price Each')
    source("c.csv", "1,2", header="one,two")
    source("d.csv", header="only")
    files = stored_scratch(list_files(spark, source.folder), "listing")
    found = {}
    for r in profiling.file_schema_profile(files).orderBy("position").collect():
        found.setdefault(r.file_uri[-5], []).append((r.n_columns, r.column_name, r.data_type, r.n_rows, r.n_null, r.n_misfit))
    names = HEADER.split(",")
    types = ["bigint", "string", "int", "double", "string", "string"]
    assert found["a"] == [(6, n, t, 2, 1, 0) for n, t in zip(names, types)]
    assert found["b"] == [
        (6, "Order ID", "bigint", 2, 0, 1),
        (6, "b", None, 2, 0, None),
        (6, "c", None, 2, 0, None),
        (6, "Quantity Ordered", "int", 2, 1, 1),
        (6, "e", None, 2, 0, None),
        (6, "Price Each", "double", 2, 0, 1),
    ]
    assert found["c"] == [(2, "one", None, 1, 0, None), (2, "two", None, 1, 0, None)]
    assert found["d"] == [(1, "only", None, 0, 0, None)]
    assert "Join" not in plan(profiling.file_schema_profile(files)).split("Scan csv")[1]


def test_extremes_of_large_ids_are_exact(spark):
    big = 2**53
    df = spark.createDataFrame([(big + 1,), (big + 3,)], "id bigint")
    found = profiling.describe_profile(df).first()
    assert (int(found.min_whole), int(found.max_whole)) == (big + 1, big + 3)
