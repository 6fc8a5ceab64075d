"""Changes of a table's schema that leave every stored row as it is: new columns, wider numbers.

The types a number may have form a lattice; two schemas meet in the smallest one that holds the values
of both exactly. Parquet files written under an older schema are read under the newer one:
a column they lack is NULL, a narrower number is widened by the reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.gates import SchemaMismatch
from tillroll.schema import PERIOD, STORED_KEYS

_DIGITS = 38  # most digits of a decimal
# A double holds whole numbers of 32 bits exactly, not those of 64.
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REAL = (T.FloatType, T.DoubleType)


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The smallest type that holds the values of both exactly, None if there is none."""
    if a == b:
        return a
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        places = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + places
        return T.DecimalType(digits, places) if digits <= _DIGITS else None
    for kinds in (_WHOLE, _REAL):
        if isinstance(a, kinds) and isinstance(b, kinds):
            return max(a, b, key=lambda t: kinds.index(type(t)))
    for whole, real in ((a, b), (b, a)):
        if isinstance(whole, _WHOLE[:3]) and isinstance(real, T.DoubleType):
            return real
    return None


def evolved(table: T.StructType, new: T.StructType) -> T.StructType:
    """The table's schema once rows of ``new`` are in it, or an error.

    Columns keep their place, new ones follow the others, the period stays last. A column that
    the new rows lack stays; they get NULL there, which a key and the period may not be.
    """
    lacking = [c for c in (*STORED_KEYS, *PERIOD) if c not in new.fieldNames()]
    if lacking:
        raise SchemaMismatch(f"new rows lack {lacking}")
    fields = []
    for field in table.fields:
        kind = field.dataType
        if field.name in new.fieldNames():
            kind = wider(kind, new[field.name].dataType)
            if kind is None or (field.name in PERIOD and kind != field.dataType):
                raise SchemaMismatch(
                    f"{field.name} is {field.dataType.simpleString()} in the table, "
                    f"{new[field.name].dataType.simpleString()} in new rows"
                )
        fields.append(T.StructField(field.name, kind))
    added = [T.StructField(f.name, f.dataType) for f in new.fields if f.name not in table.fieldNames()]
    data = [f for f in fields if f.name not in PERIOD]
    return T.StructType([*data, *added, *[f for f in fields if f.name in PERIOD]])


def fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows under an evolved schema: widened, NULL where they lack a column."""
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
