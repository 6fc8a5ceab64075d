"""The queries' input: derived from the tables once, whatever form of it is asked for."""

import datetime

from pyspark.sql import functions as F

from tillroll import fixtures
from tillroll.sources.files import csv_scan


def tables(spark, folder):
    day = datetime.date(1995, 3, 4)
    data = {
        "customer": ([(1, "Ann", "TOYS"), (2, "Bob", None)], "c_custkey long, c_name string, c_mktsegment string"),
        "part": ([(50, "cold bolt"), (89, "nut"), (3, "cog")], "p_partkey long, p_name string"),
        "orders": (
            [(1, 1, day), (2, 2, None), (2, 1, day), (3, None, day)],
            "o_orderkey long, o_custkey long, o_orderdate date",
        ),
        "lineitem": (
            [(1, 50, 1, 2.0, 9.5), (2, 89, 5, 1.0, 3.0), (2, 3, 6, 4.0, 1.0), (3, 3, 1, 1.0, 1.0), (None, 3, 1, 1.0, 1.0)],
            "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double",
        ),
    }
    for name, (rows, schema) in data.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_lines_are_joined_once_for_all_forms(spark, tmp_path, monkeypatch):
    folder, derived, lines = tables(spark, tmp_path / "tables"), [], fixtures._lines

    def counted(*args):
        derived.append(args)
        return lines(*args)

    monkeypatch.setattr(fixtures, "_lines", counted)
    # A copy of the bolt's line, one order known twice, one without a customer.
    assert fixtures.sales(spark, folder).count() == 6
    for late in fixtures.LATE:
        path, early = fixtures.sales_csv(spark, folder, late)
        assert csv_scan(spark, [r.path for r in early.collect()]).count() == 2
        assert csv_scan(spark, f"{path}/part-*.csv").count() == 6
    path, correct = fixtures.corrected_csv(spark, folder)
    correct()
    assert csv_scan(spark, path).filter(F.col("Product") == "cog").count() == 2
    fixtures.versioned_csv(spark, folder)
    assert len(derived) == 1
