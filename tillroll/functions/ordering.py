"""The total order that decides which of several lines for one key survives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.dates import parse_order_date
from tillroll.schema import ADDRESS, ORDER_DATE, PRICE, STORED_NAMES

_DATES = (ORDER_DATE, STORED_NAMES[ORDER_DATE])
_PRICES = (PRICE, STORED_NAMES[PRICE])
_ADDRESSES = (ADDRESS, STORED_NAMES[ADDRESS])


def survivor_order(schema: T.StructType, keys: Sequence[str], measure: str) -> list[Column]:
    """Sort columns that put the surviving row of a key first.

    Largest measure, then latest date, highest price, first address, then every other column.
    All columns take part, so rows that tie are equal in every column and the survivor does
    not depend on how the rows were partitioned. A raw date text is compared as the date it
    stands for; the text itself comes last, because it tells apart only unparseable dates,
    which are stored as the same NULL.
    """
    rest = [c for c in schema.fieldNames() if c not in keys and c != measure]
    order = [F.desc_nulls_last(measure)]
    last: list[Column] = []
    for name in (c for c in rest if c in _DATES):
        if isinstance(schema[name].dataType, T.StringType):
            order.append(parse_order_date(name).desc_nulls_last())
            last.append(F.desc_nulls_last(name))
        else:
            order.append(F.desc_nulls_last(name))
    order += [F.desc_nulls_last(c) for c in rest if c in _PRICES]
    order += [F.asc_nulls_last(c) for c in rest if c in _ADDRESSES]
    order += [F.asc_nulls_last(c) for c in rest if c not in _DATES + _PRICES + _ADDRESSES]
    return order + last
