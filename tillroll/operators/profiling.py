"""Data-quality profiles as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.cleansing import remove_nulls
from tillroll.schema import KEYS, ORDER_ID, REQUIRED, SOURCE_SCHEMA
from tillroll.sources.files import csv_scan, literal_path, read_files
from tillroll.sources.heads import file_headers
from tillroll.storage import stored_scratch


# Plain and scientific notation. Texts are tested before they are cast: each failing cast is an
# exception inside the JVM, some hundred times dearer than the test.
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _as_number(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def null_profile(df: DataFrame) -> DataFrame:
    """One row: per column, in how many rows it is NULL."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def required_violations(df: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """Rows that hold NULL in a column the contract calls required."""
    bad = F.lit(False)
    for name in required:
        bad = bad | F.col(name).isNull()
    return df.filter(bad)


def describe_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: ``n, mean, sd``, and its extremes as number, whole number or text.

    One aggregate over the frame, turned into a row per column afterwards. Text columns have
    the mean and deviation of those values that are numbers. Whole numbers have exact extremes:
    a double would not tell large ids apart.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    inputs: list[Column] = []
    rows: list[Column] = []
    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    whole = T.DecimalType(38, 0)
    for i, field in enumerate(fields):
        is_number = isinstance(field.dataType, T.NumericType)
        is_whole = isinstance(field.dataType, T.IntegralType)
        column = F.col(f"`{field.name}`")
        # Computed once per row, used by several aggregates.
        number = column.cast("double") if is_number else _as_number(column.cast("string"))
        value, x = F.col(f"v{i}"), F.col(f"x{i}")
        inputs += [column.alias(f"v{i}"), number.alias(f"x{i}")]
        text = value.cast("string")
        rows.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.count(value).alias("n"),
                F.avg(x).alias("mean"),
                F.stddev(x).alias("sd"),
                (F.min(x) if is_number else no_number).alias("min_number"),
                (F.max(x) if is_number else no_number).alias("max_number"),
                (F.min(value) if is_whole else F.lit(None)).cast(whole).alias("min_whole"),
                (F.max(value) if is_whole else F.lit(None)).cast(whole).alias("max_whole"),
                (no_text if is_number else F.min(text)).alias("min_text"),
                (no_text if is_number else F.max(text)).alias("max_text"),
            ).alias(f"c{i}")
        )
    described = df.select(*inputs).agg(*rows)
    return described.select(F.inline(F.array(*described.columns)))


def column_states(df: DataFrame, by: Sequence[str] = (), key: str = ORDER_ID) -> DataFrame:
    """Per group of ``by`` and column what ``merged_profile`` needs: a state of the rows so far.

    Counts, mean and the sum of squared deviations from it, extremes; all of them merge with those
    of other rows without the rows. One aggregate over the frame, a row per column afterwards.
    """
    fields = [f for f in df.schema.fields if f.name not in by]
    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    whole, has_key = T.DecimalType(38, 0), F.col(f"`{key}`").isNotNull()
    inputs, rows = [has_key.alias("_has_key"), *[F.col(f"`{c}`") for c in by]], []
    for i, field in enumerate(fields):
        is_number = isinstance(field.dataType, T.NumericType)
        is_whole = isinstance(field.dataType, T.IntegralType)
        column = F.col(f"`{field.name}`")
        number = column.cast("double") if is_number else _as_number(column.cast("string"))
        value, x = F.col(f"v{i}"), F.col(f"x{i}")
        inputs += [column.alias(f"v{i}"), number.alias(f"x{i}")]
        text = value.cast("string")
        rows.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.count(value).alias("n"),
                F.count_if(value.isNull()).alias("n_null"),
                F.count_if(value.isNull() & F.col("_has_key")).alias("n_null_with_key"),
                F.count(x).alias("n_numbers"),
                F.avg(x).alias("mean"),
                (F.var_pop(x) * F.count(x)).alias("squares"),
                (F.min(x) if is_number else no_number).alias("min_number"),
                (F.max(x) if is_number else no_number).alias("max_number"),
                (F.min(value) if is_whole else F.lit(None)).cast(whole).alias("min_whole"),
                (F.max(value) if is_whole else F.lit(None)).cast(whole).alias("max_whole"),
                (no_text if is_number else F.min(text)).alias("min_text"),
                (no_text if is_number else F.max(text)).alias("max_text"),
            ).alias(f"c{i}")
        )
    grouped = df.select(*inputs).groupBy(*[F.col(f"`{c}`") for c in by]).agg(*rows)
    columns = F.inline(F.array(*[F.col(f"c{i}") for i in range(len(fields))]))
    return grouped.select(*[F.col(f"`{c}`") for c in by], columns)


def merged_profile(states: DataFrame) -> DataFrame:
    """``describe_profile`` and the counts of NULL, of all rows that the states stand for.

    Squared deviations add up with those of the parts' means from the whole mean, so nothing
    is lost to large sums.
    """
    weight = F.col("n_numbers")
    means = states.groupBy("column_name").agg(
        (F.sum(F.col("mean") * weight) / F.nullif(F.sum(weight), F.lit(0))).alias("whole_mean")
    )
    apart = F.col("mean") - F.col("whole_mean")
    n = F.sum("n_numbers")
    squares = F.sum(F.col("squares") + weight * apart * apart)
    # One row per column on the other side.
    return (
        states.join(F.broadcast(means), "column_name")
        .groupBy("column_name")
        .agg(
            *[F.sum(c).alias(c) for c in ("n", "n_null", "n_null_with_key")],
            F.first("whole_mean").alias("mean"),
            F.when(n > 1, F.sqrt(squares / (n - 1))).alias("sd"),
            *[F.min(f"min_{c}").alias(f"min_{c}") for c in ("number", "whole", "text")],
            *[F.max(f"max_{c}").alias(f"max_{c}") for c in ("number", "whole", "text")],
        )
    )


def count_levels(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row: rows, distinct rows, distinct keys.

    Counted in steps (copies of a row, then rows of a key, then keys), each combined before
    its shuffle. Three distinct counts in one aggregate would triple the rows instead.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    return (
        df.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .groupBy(*[F.col(k) for k in keys])
        .agg(F.sum("_copies").alias("_rows"), F.count(F.lit(1)).alias("_distinct"))
        .agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum("_distinct"), F.lit(0)).alias("n_distinct_rows"),
            F.count(F.lit(1)).alias("n_distinct_keys"),
        )
    )


def key_counts(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows per key, as ``cnt``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))


def dup_key_counts(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys that more than one row has."""
    return key_counts(df, keys).filter(F.col("cnt") > 1)


def top_dup_keys(df: DataFrame, keys: Sequence[str] = KEYS, n: int = 20) -> DataFrame:
    """The ``n`` keys with most rows; equal counts in key order."""
    order = [F.desc("cnt"), *[F.asc_nulls_first(k) for k in keys]]
    return key_counts(df, keys).orderBy(*order).limit(n)


# Buckets of keys whose rows are counted first, and how many of the fullest are looked into at once.
KEY_BUCKETS = 1 << 20
FULLEST = 4096


def top_dup_keys_of_stored(
    df: DataFrame,
    keys: Sequence[str] = KEYS,
    n: int = 20,
    buckets: int = KEY_BUCKETS,
    fullest: int = FULLEST,
) -> DataFrame:
    """``top_dup_keys`` without shuffling the counts of all keys, for rows that are stored.

    Rows are counted per bucket of keys first: no key has more rows than its bucket. The keys of
    the fullest buckets, counted exactly, give a count that the answer's last key reaches at least;
    a key with as many rows can only be in a bucket with as many. Only the keys of those buckets
    are counted then. If all buckets are as full as that, it is all keys, as in ``top_dup_keys``.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    order = [F.desc("cnt"), *[F.asc_nulls_first(k) for k in keys]]
    sizes = stored_scratch(key_counts(df.withColumn("_bucket", bucket), ["_bucket"]), "key-buckets")
    first = sizes.orderBy(F.desc("cnt"), "_bucket").limit(fullest)

    def counts_in(chosen: DataFrame) -> DataFrame:
        rows = df.withColumn("_bucket", bucket).join(chosen.select("_bucket"), "_bucket", "left_semi")
        return key_counts(rows.drop("_bucket"), keys)

    # At most ``fullest`` numbers are broadcast, n rows come to the driver.
    sure = counts_in(F.broadcast(first)).orderBy(*order).limit(n).collect()
    reached = sure[-1]["cnt"] if len(sure) == n else 1
    wanted = sizes.filter(F.col("cnt") >= reached)
    if wanted.count() == sizes.count():
        return top_dup_keys(df, keys, n)
    return counts_in(wanted).orderBy(*order).limit(n)


def schema_rows(df: DataFrame) -> DataFrame:
    """A frame's columns as rows: ``position, column_name, data_type, nullable``."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable)
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean"
    )


class Profile(NamedTuple):
    """What ``profile`` returns; each frame is computed only when it is used."""

    describe: DataFrame
    nulls: DataFrame
    nulls_with_key: DataFrame
    levels: DataFrame
    top_keys: DataFrame


def profile(df: DataFrame, key: str = ORDER_ID, keys: Sequence[str] = KEYS) -> Profile:
    """The data-quality exploration of one frame of source rows."""
    with_key = remove_nulls(df, key)
    return Profile(
        describe=describe_profile(df),
        nulls=null_profile(df),
        nulls_with_key=null_profile(with_key),
        levels=count_levels(with_key, keys),
        top_keys=top_dup_keys(with_key, keys),
    )


def profile_rows(found: Profile, columns: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """The counts of a profile as rows ``section, item, n``."""

    def unpivoted(df: DataFrame, section: str, names: Sequence[str]) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("item"), F.col(f"`{c}`").alias("n")) for c in names]
        return df.select(F.lit(section).alias("section"), F.inline(F.array(*pairs)))

    key = F.concat_ws("|", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in keys])
    return (
        unpivoted(found.nulls, "nulls", columns)
        .unionByName(unpivoted(found.nulls_with_key, "nulls with key", columns))
        .unionByName(unpivoted(found.levels, "levels", found.levels.columns))
        .unionByName(
            found.describe.select(F.lit("values").alias("section"), F.col("column_name").alias("item"), "n")
        )
        .unionByName(
            found.top_keys.select(
                F.lit("top keys").alias("section"), key.alias("item"), F.col("cnt").alias("n")
            )
        )
    )


def inferred_schema(spark: SparkSession, path: str) -> DataFrame:
    """One file's columns with the types that Spark's reader infers for it."""
    return schema_rows(csv_scan(spark, literal_path(path), schema=None))


def _fits(text: Column, kind: T.DataType) -> Column:
    """Can a text be read as a type? Texts that are no numbers at all are told by a test."""
    if isinstance(kind, T.IntegralType):
        return text.rlike(r"^[+-]?\d+$") & text.try_cast(kind).isNotNull()
    if isinstance(kind, T.FractionalType):
        return text.rlike(_NUMBER) | text.isin("NaN", "Inf", "-Inf", "Infinity", "-Infinity")
    return text.isNotNull()


def file_schema_profile(
    files: DataFrame, schema: T.StructType = SOURCE_SCHEMA
) -> DataFrame:
    """Per file and column: position, name, the contract's type, values, NULLs and misfits.

    ``n_misfit`` counts values that are not of the type the contract gives a column of that name,
    and is NULL for other columns. All files are read as text columns in one pass; per file and
    task one row is shuffled. Repeated lines of the contract's names, in any order, are no values.
    """
    spark = files.sparkSession
    headers = stored_scratch(file_headers(files).filter("header IS NOT NULL"), "headers")
    # One number, at most the width of the widest file.
    width = headers.agg(F.max(F.size("header"))).first()[0]
    names = [f"_c{i}" for i in range(width or 1)]
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = read_files(
        files,
        lambda paths: spark.read.schema(text)
        .option("header", True)
        .option("pathGlobFilter", "*.csv")
        .csv(paths),
    )
    contract = F.array(*[F.lit(n) for n in sorted(schema.fieldNames())])
    rows = rows.filter(F.array_sort(F.array_compact(F.array(*names))) != contract)
    # A column's type goes by its name, which is known per file: so every position is counted for
    # each type of the contract, and the name picks the count afterwards.
    kinds = sorted({f.dataType for f in schema.fields}, key=str)
    aggregates: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
    for n in names:
        aggregates.append(F.count(n).alias(f"{n}_n"))
        aggregates += [F.count_if(_fits(F.col(n), k)).alias(f"{n}_{i}") for i, k in enumerate(kinds)]
    per_file = rows.groupBy("file_uri").agg(*aggregates)
    columns = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.col("n_rows"),
                F.col(f"{n}_n").alias("n"),
                F.array(*[F.col(f"{n}_{k}") for k in range(len(kinds))]).alias("fitting"),
            )
            for i, n in enumerate(names)
        ]
    )
    type_of, place = F.lit(None).cast("string"), F.lit(None).cast("int")
    for f in schema.fields:
        own = F.col("column_name") == f.name
        type_of = F.when(own, f.dataType.simpleString()).otherwise(type_of)
        place = F.when(own, kinds.index(f.dataType)).otherwise(place)
    # From the headers, so that a file of nothing but a header is reported too.
    return (
        headers.select("file_uri", F.size("header").alias("n_columns"), F.posexplode("header"))
        .select(
            "file_uri",
            "n_columns",
            (F.col("pos") + 1).alias("position"),
            F.col("col").alias("column_name"),
        )
        .join(per_file.select("file_uri", F.inline(columns)), ["file_uri", "position"], "left")
        .select(
            "file_uri",
            "n_columns",
            "position",
            "column_name",
            type_of.alias("data_type"),
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
            F.coalesce(F.col("n_rows") - F.col("n"), F.lit(0)).alias("n_null"),
            F.when(
                place.isNotNull(), F.coalesce(F.col("n") - F.get("fitting", place), F.lit(0))
            ).alias("n_misfit"),
        )
    )
