"""Order-date parsing and the period columns derived from it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.schema import DATE_FORMAT


def parse_order_date(raw: Column | str, fmt: str = DATE_FORMAT) -> Column:
    """Timestamp of a raw date text; NULL (never an error) where the text does not fit."""
    return F.try_to_timestamp(F.col(raw) if isinstance(raw, str) else raw, F.lit(fmt))


def period_columns(date: Column | str) -> dict[str, Column]:
    """``year`` and ``month`` of a date; both NULL for a NULL date."""
    return {"year": F.year(date), "month": F.month(date)}
