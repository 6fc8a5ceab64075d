import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from tillroll.operators.cleansing import (
    add_period,
    cleanse,
    exact_distinct,
    keep_max,
    key_lookup,
    parse_dates,
    rejected_rows,
    remove_duplicates,
    remove_nulls,
    rename_columns,
)
from tillroll.schema import CLEANSED_SCHEMA, SOURCE_SCHEMA, names_and_types


def sales(spark, *data):
    return spark.createDataFrame(list(data), SOURCE_SCHEMA)


# Input and expected rows of the first three tests are results to match.
def test_rows_without_a_key_are_removed(spark):
    df = spark.createDataFrame([("123", "Product A"), (None, "Product B")], ["Order ID", "Product"])
    assert rows(remove_nulls(df)) == [("123", "Product A")]
    assert rows(rejected_rows(df)) == [(None, "Product B")]


def test_the_largest_quantity_and_one_of_two_copies_survive(spark):
    names = ["Order ID", "Product", "Quantity Ordered"]
    df = spark.createDataFrame(
        [
            ("123", "Product A", 5),
            ("123", "Product A", 10),
            ("124", "Product B", 3),
            ("124", "Product B", 3),
        ],
        names,
    )
    expected = spark.createDataFrame([("123", "Product A", 10), ("124", "Product B", 3)], names)
    assertDataFrameEqual(remove_duplicates(df), expected)


def test_columns_are_renamed_and_absent_ones_ignored(spark):
    names = ["Order ID", "Quantity Ordered", "Price Each", "Order Date", "Purchase Address"]
    df = spark.createDataFrame([("123", 5, 20.0, "2025-02-03", "Address A")], names)
    renamed = rename_columns(df)
    assert renamed.columns == [n.replace(" ", "_") for n in names]
    assert rows(renamed) == [("123", 5, 20.0, "2025-02-03", "Address A")]
    assert rename_columns(df.select("Price Each")).columns == ["Price_Each"]


def test_ties_go_to_the_later_date_not_the_larger_text(spark):
    df = sales(
        spark,
        (1, "x", 2, 1.0, "12/31/18 10:00", "a"),
        (1, "x", 2, 9.0, "garbage", "a"),
        (1, "x", 2, 1.0, "01/01/19 10:00", "b"),
        (1, "x", 2, 1.0, "01/01/19 10:00", "a"),
    )
    assert rows(remove_duplicates(df)) == [(1, "x", 2, 1.0, "01/01/19 10:00", "a")]


def test_null_quantity_loses_and_null_product_is_a_group(spark):
    df = sales(
        spark,
        (1, "x", None, 1.0, None, None),
        (1, "x", 0, 1.0, None, None),
        (1, None, 1, 1.0, None, None),
        (1, None, 2, 1.0, None, None),
    )
    assert rows(remove_duplicates(df), "Product", "Quantity Ordered") == [("x", 0), (None, 2)]


def test_an_own_column_named_like_the_helper_is_kept(spark):
    df = spark.createDataFrame([(1, "x", 1, 7)], ["Order ID", "Product", "Quantity Ordered", "_survivor_rank"])
    assert rows(keep_max(df)) == [(1, "x", 1, 7)]


@pytest.fixture(scope="module")
def random_rows():
    rng = random.Random(7)

    def maybe(value):
        return None if rng.random() < 0.1 else value

    return [
        (
            rng.randint(1, 40),
            maybe(rng.choice("ab")),
            maybe(rng.randint(1, 3)),
            maybe(float(rng.randint(1, 3))),
            maybe(rng.choice(["01/02/19 10:00", "02/01/18 10:00", "04/31/19 10:00", "no date"])),
            maybe(rng.choice(["home", "work"])),
        )
        for _ in range(600)
    ]


def brute_force(data):
    """Distinct rows, then per key the first under the documented order."""
    from datetime import datetime

    def parsed(text):
        try:
            return datetime.strptime(text, "%m/%d/%y %H:%M").timestamp()
        except (TypeError, ValueError):
            return None

    def down(value):
        return (value is None, -value if value is not None else 0)

    best = {}
    for row in set(data):
        rank = (
            down(row[2]),
            down(parsed(row[4])),
            down(row[3]),
            (row[5] is None, row[5] or ""),
            (row[4] is None, [-ord(c) for c in row[4] or ""]),
        )
        if row[:2] not in best or rank < best[row[:2]][0]:
            best[row[:2]] = (rank, row)
    return sorted((row for _, row in best.values()), key=repr)


def test_deduplication_matches_brute_force_however_partitioned(spark, random_rows):
    df = sales(spark, *random_rows)
    expected = brute_force(random_rows)
    for n in (1, 3, 7):
        assert rows(remove_duplicates(df.repartition(n))) == expected
    assert rows(remove_duplicates(exact_distinct(df))) == expected


def test_deduplication_is_idempotent_and_mergeable(spark, random_rows):
    df, a, b = (sales(spark, *r) for r in (random_rows, random_rows[:250], random_rows[250:]))
    whole = remove_duplicates(df)
    assert rows(remove_duplicates(whole)) == rows(whole)
    merged = remove_duplicates(remove_duplicates(a).unionByName(remove_duplicates(b)))
    assert rows(merged) == rows(whole)


def test_dates_that_do_not_fit_become_null(spark):
    df = spark.createDataFrame(
        [("04/19/19 08:46",), ("4/5/19 8:46",), ("garbage",), ("04/30/98 23:59",), ("02/30/19 10:00",), (None,)],
        "`Order Date` string",
    )
    parsed = add_period(parse_dates(df)).select(F.date_format("Order Date", "yyyy-MM-dd HH:mm"), "year", "month")
    assert rows(parsed) == sorted(
        [("2019-04-19 08:46", 2019, 4), ("2098-04-30 23:59", 2098, 4)] + [(None, None, None)] * 4,
        key=repr,
    )


def test_lookup_by_key_and_product(spark):
    df = sales(spark, (1, "x", 1, 1.0, None, None), (1, "y", 2, 1.0, None, None), (2, "x", 3, 1.0, None, None))
    assert rows(key_lookup(df, {"Order ID": 1, "Product": "x"}), "Quantity Ordered") == [(1,)]


def test_cleansed_rows_have_the_cleansed_schema(spark):
    cleansed = cleanse(sales(spark, (1, "x", 1, 1.0, "04/19/19 08:46", "a"), (None, "x", 1, 1.0, "", "")))
    assert names_and_types(cleansed.schema) == names_and_types(CLEANSED_SCHEMA)
    assert cleansed.count() == 1


def test_deduplication_shuffles_once_and_cuts_before_the_shuffle(spark):
    # A source that is not a local relation, so that nothing is evaluated while planning.
    df = spark.range(100).select(
        (F.col("id") % 7).alias("Order ID"),
        F.lit("x").alias("Product"),
        F.col("id").cast("int").alias("Quantity Ordered"),
        F.col("id").cast("double").alias("Price Each"),
        F.lit("04/19/19 08:46").alias("Order Date"),
        F.lit("a").alias("Purchase Address"),
    )
    text = plan(cleanse(df))
    assert text.count("Exchange ") == 1
    before = text.split("Exchange ")[1]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_a_key_with_a_third_of_all_rows_sends_one_row_per_task(spark):
    df = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("Order ID"),
        F.lit("x").alias("Product"),
        F.col("id").cast("int").alias("Quantity Ordered"),
        F.lit("04/19/19 08:46").alias("Order Date"),
    )
    kept = remove_duplicates(df)
    assert kept.count() == 20_001
    assert rows(kept.filter("`Order ID` = 0"), "Quantity Ordered") == [(29_997,)]
