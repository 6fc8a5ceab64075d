"""Source files: listing them, reading a chosen set of them."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schema import CORRUPT, SOURCE_SCHEMA

# Files per listing task and stored part. A listing opens no file, so their lengths don't count.
FILES_PER_TASK = 2_000
# Paths that one reader is given; more are read by more readers, whose rows are put together.
PATHS_PER_READER = 10_000


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Files directly in ``folder``: ``path, file_uri, length, modified``.

    Hidden files, subfolders and empty files are not listed; a missing folder is an error.
    The content column is pruned, so no file is opened; the source packs files by length all the
    same, so its splits are put together by number. ``path`` is the plain path, ``file_uri`` its
    encoded form as every scan reports it in ``_metadata.file_path``.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    found = found.load(literal_path(folder))
    tasks = math.ceil(len(found.inputFiles()) / FILES_PER_TASK)
    return found.coalesce(max(1, tasks)).select(
        "path",
        F.col("_metadata.file_path").alias("file_uri"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


def literal_path(path: str) -> str:
    """``path`` with the characters a reader would expand as a glob taken literally."""
    return "".join("\\" + c if c in "\\{}[]*?" else c for c in path)


def read_files(
    files: DataFrame,
    read: Callable[[list[str]], DataFrame],
    with_uri: bool = True,
    paths_per_reader: int = PATHS_PER_READER,
) -> DataFrame:
    """Rows of exactly the listed files, plus ``file_uri`` unless ``with_uri`` is off.

    ``files`` is a stored, not empty listing of distinct files. Every file is named to a reader,
    at any number of files, so files that reach the folder later are not read. The driver holds
    the names, as it does for any scan.
    """
    names = [literal_path(r.path) for r in files.select("path").toLocalIterator()]
    uri = F.col("_metadata.file_path").alias("file_uri")
    parts = []
    for i in range(0, len(names), paths_per_reader):
        rows = read(names[i : i + paths_per_reader])
        # Asking for the file makes the scan attach all file metadata to every row.
        parts.append(rows.select("*", uri) if with_uri else rows)
    return reduce(DataFrame.unionByName, parts)


def csv_reader(
    spark: SparkSession, schema: T.StructType = SOURCE_SCHEMA, check_header: bool = False
) -> Callable[[list[str]], DataFrame]:
    """A typed scan; the text of lines it cannot read in full goes to ``_corrupt_record``.

    ``check_header`` makes the scan fail at a file whose header differs from the schema.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])

    def read(paths: list[str]) -> DataFrame:
        return (
            spark.read.schema(full)
            .option("header", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("enforceSchema", not check_header)
            .option("pathGlobFilter", "*.csv")
            .csv(paths)
        )

    return read


def csv_scan(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = SOURCE_SCHEMA,
) -> DataFrame:
    """Read one CSV, many, or a folder of them as one frame, by position.

    ``schema=None`` infers names and types, which costs a pass over the files.
    """
    reader = spark.read.option("header", True).option("pathGlobFilter", "*.csv")
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv([paths] if isinstance(paths, str) else list(paths))


def csv_scan_files(
    files: DataFrame,
    schema: T.StructType = SOURCE_SCHEMA,
    check_header: bool = False,
    with_uri: bool = True,
) -> DataFrame:
    """Typed rows of the listed files, with ``_corrupt_record`` and ``file_uri``."""
    if files.isEmpty():
        extra = [CORRUPT, "file_uri"] if with_uri else [CORRUPT]
        full = T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in extra]])
        return files.sparkSession.createDataFrame([], full)
    return read_files(files, csv_reader(files.sparkSession, schema, check_header), with_uri)
