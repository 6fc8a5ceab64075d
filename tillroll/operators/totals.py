"""Totals of sales lines that add up: of parts of a month to those of the month, of months to a year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.schema import PERIOD

TOTALS = "n_lines long, units long, revenue decimal(38,8)"
# Columns whose distinct values are estimated, and the sketches' size: 2^12 registers, 1.6 % error.
SKETCHED = {"orders": "Order_ID", "products": "Product", "addresses": "Purchase_Address"}
LG_K = 12
SKETCHES = ", ".join(f"{name} binary" for name in SKETCHED)


def line_totals() -> list[Column]:
    # Summed as decimals: the result does not depend on the order of summation. Prices keep eight
    # places; only the sum is rounded, where it is reported.
    price = F.col("Price_Each").cast("decimal(24,8)")
    return [
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("Quantity_Ordered").alias("units"),
        F.sum(price * F.col("Quantity_Ordered")).cast("decimal(38,8)").alias("revenue"),
    ]


def monthly_totals(rows: DataFrame) -> DataFrame:
    """``year, month`` and the totals of their lines, not rounded."""
    return rows.groupBy(*PERIOD).agg(*line_totals())


def monthly_summary(rows: DataFrame) -> DataFrame:
    """``monthly_totals``, and a sketch of the distinct values of each of ``SKETCHED``."""
    sketches = [
        F.hll_sketch_agg(F.xxhash64(column), LG_K).alias(name) for name, column in SKETCHED.items()
    ]
    return rows.groupBy(*PERIOD).agg(*line_totals(), *sketches)


def estimated_distinct(summary: DataFrame, *by: str) -> DataFrame:
    """About how many different values of each of ``SKETCHED`` there are in a union of months."""
    return summary.groupBy(*by).agg(
        *[F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in SKETCHED]
    )


def added_up(totals: DataFrame, *by: str) -> DataFrame:
    """Totals of totals, as they are reported."""
    return totals.groupBy(*by).agg(
        F.sum("n_lines").alias("n_lines"),
        F.sum("units").alias("units"),
        F.sum("revenue").cast("decimal(38,2)").alias("revenue"),
    )
