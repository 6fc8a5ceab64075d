"""Sales-shaped source rows derived from the driver's tables, with the usual dirt.

``line ⋈ order ⋈ part ⋈ customer``; dates moved 24 years ahead (as many leap days), so that a
two-digit year means the same century everywhere. Dirt depends on the part number only:
lines without a key, repeated header lines, dates that are no dates, exact copies. No row
of the tables is left out.
"""

from __future__ import annotations

import uuid

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import storage
from tillroll.schema import (
    ADDRESS,
    DATE_FORMAT,
    ORDER_DATE,
    ORDER_ID,
    PRICE,
    PRODUCT,
    QUANTITY,
    SOURCE_SCHEMA,
)
from tillroll.sources.files import list_files
from tillroll.storage import scratch_path, stored_scratch, write_text

# Orders' lines above this number come in the files that arrive late.
EARLY_LINES = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source rows with ``line`` (line number) and ``header_again`` (a repeated header)."""
    pk = F.col("l_partkey")
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    # Customers join the orders, which are fewer than the lines; and the lines take the orders' columns
    # last, so that these are shuffled once per order.
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    base = lineitem.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).join(
        orders.select("o_orderkey", "o_orderdate", "c_name", "c_mktsegment"),
        F.col("l_orderkey") == F.col("o_orderkey"),
    )
    header_again = pk % 89 == 0
    no_key = header_again | (pk % 97 == 0)
    moment = F.col("o_orderdate") + F.make_dt_interval(mins=(pk % 1440).cast("int")) + F.expr(
        "INTERVAL '24' YEAR"
    )
    copies = F.when((pk % 50 == 0) & ~no_key, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    return base.select(
        F.when(~no_key, F.col("l_orderkey")).alias(ORDER_ID),
        F.when(header_again, PRODUCT).otherwise(F.col("p_name")).alias(PRODUCT),
        F.when(~header_again, F.col("l_quantity").cast("int")).alias(QUANTITY),
        F.when(~header_again, F.col("l_extendedprice")).alias(PRICE),
        F.when(header_again, ORDER_DATE)
        .when(pk % 101 == 0, "unknown")
        .otherwise(F.date_format(moment, DATE_FORMAT))
        .alias(ORDER_DATE),
        F.when(header_again, ADDRESS)
        .otherwise(F.concat("c_name", F.lit(", "), "c_mktsegment"))
        .alias(ADDRESS),
        F.col("l_linenumber").alias("line"),
        pk.alias("part"),
        header_again.alias("header_again"),
        F.explode(copies).alias("copy"),
    )


_stored: dict[tuple[str, str], DataFrame] = {}


def stored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``_lines``, derived and stored once per session and table folder: they are the queries' input,
    and the joins that make them are no part of what a query does."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        with storage.shuffles_freed(spark):
            _stored[key] = stored_scratch(_lines(spark, sf_dir).drop("copy"), "sales", "zstd")
    return _stored[key]


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty source rows, as a typed scan of the CSV files would give them."""
    return stored_lines(spark, sf_dir).select(*SOURCE_SCHEMA.fieldNames())


LATE = ("conforming", "drifted", "wrong", "decoys")
# In folders with wrong values, the late lines of every third part are in files of their own, and
# half of them hold a value that is not of its column's type.
WRONG_ID, WRONG_QUANTITY, WRONG_PRICE = "A-17", "two", "n/a"
_folders: dict[tuple[str, str, str], tuple[str, DataFrame]] = {}


def _as_text(lines: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Lines as a file spells them: a repeated header line carries the column's name in every field."""
    spelled = [
        F.when(F.col("header_again"), c).otherwise(F.col(f"`{c}`").cast("string")).alias(c)
        for c in names or SOURCE_SCHEMA.fieldNames()
    ]
    return lines.select(*spelled, "line", "part", "header_again")


def sales_csv(
    spark: SparkSession, sf_dir: str, late: str = "conforming"
) -> tuple[str, DataFrame]:
    """A folder of CSV files of the source rows, and the listing of those that came early.

    Files with the orders' first lines are written first, the others later. ``late="drifted"``
    writes the late ones with other column order, ``"wrong"`` with values of wrong types in some,
    ``"decoys"`` adds files that are no source files. Written once per session and table folder:
    these are the inputs of the load jobs, not part of their work.
    """
    if late not in LATE:
        raise ValueError(f"late must be one of {LATE}, not {late!r}")
    key = (spark.sparkContext.applicationId, sf_dir, late)
    if key not in _folders:
        folder = scratch_path(spark, "sales-csv")
        names = SOURCE_SCHEMA.fieldNames()
        text = _as_text(stored_lines(spark, sf_dir))

        def write(rows: DataFrame, columns=names, to: str = folder) -> None:
            rows.select(*columns).write.mode("append").option("header", True).csv(to)

        early = text.filter(F.col("line") <= EARLY_LINES)
        after = text.filter(F.col("line") > EARLY_LINES)
        write(early)
        listing = stored_scratch(list_files(spark, folder), "early")
        if late == "wrong":
            third = F.col("part") % 3 == 0
            write(after.filter(~third))
            write(_with_wrong_values(after.filter(third)))
        else:
            write(after, reversed(names) if late == "drifted" else names)
        if late == "decoys":
            write(early, to=f"{folder}/sub")
            for name in ("_hidden.csv", ".hidden.csv", "upper.CSV", "text.txt"):
                write_text(spark, f"{folder}/{name}", ",".join(names) + "\n1,decoy,1,1,,\n")
        _folders[key] = folder, listing
    return _folders[key]


def _with_wrong_values(text: DataFrame) -> DataFrame:
    wrong, kind = (F.col("part") % 2 == 0) & ~F.col("header_again"), F.col("part") % 5
    return text.withColumns(
        {
            ORDER_ID: F.when(wrong & (kind == 0), WRONG_ID).otherwise(F.col(ORDER_ID)),
            QUANTITY: F.when(wrong & (kind == 1), WRONG_QUANTITY).otherwise(F.col(QUANTITY)),
            PRICE: F.when(wrong & (kind > 1), WRONG_PRICE).otherwise(F.col(PRICE)),
        }
    )


# Files of late lines that are corrected after they were loaded, and those that stay.
CORRECTED, RIGHT = "late-0.csv", ("late-1.csv", "late-2.csv")
WRONG_PRODUCT = "mistyped"


def corrected_csv(spark: SparkSession, sf_dir: str) -> tuple[str, Callable[[], None]]:
    """A folder in which one file is wrong, and a function that puts the corrected one in its place.

    The wrong file has the lines of every third part with larger quantities, which displace right
    lines of other files, and every seventh of them under a product that does not exist. Written
    anew on every call: what is done to the folder is the point.
    """
    folder = scratch_path(spark, "sales-csv")
    names = SOURCE_SCHEMA.fieldNames()
    text = _as_text(stored_lines(spark, sf_dir))

    def put(rows: DataFrame, name: str) -> None:
        with storage.scratch_folder(spark, "file") as beside, storage.shuffles_freed(spark):
            rows.select(*names).repartition(1).write.option("header", True).csv(beside)
            (part,) = (n for n in storage.names(spark, beside) if n.startswith("part-"))
            storage.move(spark, f"{beside}/{part}", f"{folder}/{name}")

    text.filter(F.col("line") <= EARLY_LINES).select(*names).write.option("header", True).csv(folder)
    late = text.filter(F.col("line") > EARLY_LINES)
    shares = [late.filter(F.col("part") % 3 == i) for i in range(3)]
    for rows, name in zip(shares[1:], RIGHT, strict=True):
        put(rows, name)
    more = F.col(f"`{QUANTITY}`").cast("int") + 100
    wrong = shares[0].withColumns(
        {
            QUANTITY: F.when(F.col("header_again"), F.col(QUANTITY)).otherwise(more.cast("string")),
            PRODUCT: F.when(~F.col("header_again") & (F.col("part") % 7 == 0), WRONG_PRODUCT).otherwise(F.col(PRODUCT)),
        }
    )
    put(wrong, CORRECTED)
    return folder, lambda: put(shares[0], CORRECTED)


# Two versions of the contract: whole prices first, later a column more.
CHANNEL = "Channel"
OLD_SCHEMA = T.StructType(
    [T.StructField(f.name, T.IntegerType() if f.name == PRICE else f.dataType) for f in SOURCE_SCHEMA.fields]
)
NEW_SCHEMA = T.StructType([*SOURCE_SCHEMA.fields, T.StructField(CHANNEL, T.StringType())])


def versioned_csv(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """A folder whose early files follow ``OLD_SCHEMA``, the later ones ``NEW_SCHEMA``, and the
    listing of the early ones."""
    key = (spark.sparkContext.applicationId, sf_dir, "versioned")
    if key not in _folders:
        folder = scratch_path(spark, "sales-csv")
        lines = stored_lines(spark, sf_dir).withColumn(CHANNEL, F.when(F.col("part") % 2 == 0, "web").otherwise("shop"))
        whole = lines.withColumn(PRICE, F.floor(F.col(f"`{PRICE}`")).cast("int"))

        def write(rows: DataFrame, schema: T.StructType) -> None:
            names = schema.fieldNames()
            text = _as_text(rows, names).select(*names)
            text.write.mode("append").option("header", True).csv(folder)

        write(whole.filter(F.col("line") <= EARLY_LINES), OLD_SCHEMA)
        listing = stored_scratch(list_files(spark, folder), "early")
        write(lines.filter(F.col("line") > EARLY_LINES), NEW_SCHEMA)
        _folders[key] = folder, listing
    return _folders[key]


def fresh_table(spark: SparkSession) -> tuple[str, str]:
    """Unused paths for a table and its ledger."""
    base = scratch_path(spark, f"load-{uuid.uuid4().hex[:8]}")
    return f"{base}/sales", f"{base}/ledger"
