"""Column contracts: what a source file holds, what the cleansed table holds."""

from __future__ import annotations

from pyspark.sql import types as T

# The source contract (names, order, date format) and the stored names.
ORDER_ID = "Order ID"
PRODUCT = "Product"
QUANTITY = "Quantity Ordered"
PRICE = "Price Each"
ORDER_DATE = "Order Date"
ADDRESS = "Purchase Address"
DATE_FORMAT = "MM/dd/yy HH:mm"
STORED_NAMES = {
    "Order ID": "Order_ID",
    "Quantity Ordered": "Quantity_Ordered",
    "Price Each": "Price_Each",
    "Order Date": "Order_Date",
    "Purchase Address": "Purchase_Address",
}

KEYS = (ORDER_ID, PRODUCT)
PERIOD = ("year", "month")
CORRUPT = "_corrupt_record"

# Order ids are 64-bit: one table at the target size holds more orders than an int can number.
SOURCE_SCHEMA = T.StructType(
    [
        T.StructField(ORDER_ID, T.LongType()),
        T.StructField(PRODUCT, T.StringType()),
        T.StructField(QUANTITY, T.IntegerType()),
        T.StructField(PRICE, T.DoubleType()),
        T.StructField(ORDER_DATE, T.StringType()),
        T.StructField(ADDRESS, T.StringType()),
    ]
)

CLEANSED_SCHEMA = T.StructType(
    [
        T.StructField("Order_ID", T.LongType()),
        T.StructField("Product", T.StringType()),
        T.StructField("Quantity_Ordered", T.IntegerType()),
        T.StructField("Price_Each", T.DoubleType()),
        T.StructField("Order_Date", T.TimestampType()),
        T.StructField("Purchase_Address", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ]
)
STORED_KEYS = ("Order_ID", "Product")
STORED_QUANTITY = "Quantity_Ordered"

# Cleansed columns that may not hold NULL. Spark reads every file column as nullable, so
# this is a check on the rows (operators.profiling.required_violations), not on the schema.
REQUIRED = ("Order_ID", "Product", "Quantity_Ordered", "Order_Date")

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)

# What loads reject, kept beside the ledger; lines with their values as far as they were readable.
REJECT_SCHEMAS = {
    "files": T.StructType(
        [
            T.StructField("path", T.StringType()),
            T.StructField("file_uri", T.StringType()),
            T.StructField("length", T.LongType()),
            T.StructField("modified", T.TimestampType()),
            T.StructField("reason", T.StringType()),
            T.StructField("batch_id", T.StringType()),
        ]
    ),
    "rows": T.StructType(
        [
            *SOURCE_SCHEMA.fields,
            T.StructField(CORRUPT, T.StringType()),
            T.StructField("file_uri", T.StringType()),
            T.StructField("reason", T.StringType()),
            T.StructField("batch_id", T.StringType()),
        ]
    ),
}


def names_and_types(schema: T.StructType) -> list[tuple[str, str]]:
    """What two schemas must share to be the same contract; nullability is left out."""
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]
