"""Where intermediate tables go, and the few file operations Spark's writers do not offer."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, tempfile.TemporaryDirectory] = {}


def fresh_name() -> str:
    return uuid.uuid4().hex


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder the session names in ``spark.checkpoint.dir``.

    Only a session whose executors are threads of this process may name none; it gets a folder
    of this machine, removed at exit.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        app = spark.sparkContext.applicationId
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.TemporaryDirectory(prefix="tillroll-")
        base = _local_dirs[app].name
    return f"{base.rstrip('/')}/tillroll/{name}-{fresh_name()}"


def stored(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: evaluated once, and no lineage to replay.

    Sizes of the written files are known to Spark, so later joins with it are broadcast only
    if it really is small. ``compression`` is Parquet's, if not the session's.
    """
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A fresh scratch path whose contents are deleted when the block ends, however it ends."""
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        delete(spark, path)


def stored_scratch(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``stored`` at a fresh scratch path."""
    return stored(df, scratch_path(df.sparkSession, name), compression)


def beside(table_path: str, kind: str) -> str:
    """Where something is kept that belongs to a table but is none of its rows."""
    return f"{table_path.rstrip('/')}_meta/{kind}"


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _path(spark, path)
    return fs.exists(hadoop_path)


def has_files(spark: SparkSession, path: str) -> bool:
    """Is there a folder at ``path`` with anything but Spark's hidden files in it?"""
    fs, hadoop_path = _path(spark, path)
    if not fs.exists(hadoop_path):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(hadoop_path))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if it is missing."""
    fs, hadoop_path = _path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [s.getPath().getName() for s in fs.listStatus(hadoop_path)]


_SHUFFLES_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries made in the block delete the files of their shuffles when they end.

    Otherwise these lie on the executors' disks until the driver collects garbage, so that those of
    all steps of a job lie there at once.
    """
    before = spark.conf.get(_SHUFFLES_FREED, None)
    spark.conf.set(_SHUFFLES_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES_FREED)
        else:
            spark.conf.set(_SHUFFLES_FREED, before)


def delete(spark: SparkSession, path: str, *more: str) -> None:
    """Delete files or folders of one file system, in order; no error if they are gone already."""
    fs, hadoop_path = _path(spark, path)
    fs.delete(hadoop_path, True)
    for other in more:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(other), True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a file in the place of another, which goes."""
    fs, hadoop_target = _path(spark, target)
    fs.delete(hadoop_target, False)
    fs.rename(spark._jvm.org.apache.hadoop.fs.Path(source), hadoop_target)


def move_folders(spark: SparkSession, moves: Mapping[str, str]) -> None:
    """Put folders in the places of others of the same file system, which go; one by one.

    A folder that is not there has been moved before.
    """
    if not moves:
        return
    fs, _ = _path(spark, next(iter(moves)))
    for source, target in moves.items():
        hadoop_source, hadoop_target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
        if not fs.exists(hadoop_source):
            continue
        fs.delete(hadoop_target, True)
        fs.mkdirs(hadoop_target.getParent())
        if not fs.rename(hadoop_source, hadoop_target):
            raise OSError(f"cannot move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not at all: written beside its place and renamed."""
    fs, hadoop_path = _path(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    fs.delete(hadoop_path, False)
    fs.rename(beside, hadoop_path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """What ``write_text`` has written, or None."""
    fs, hadoop_path = _path(spark, path)
    if not fs.exists(hadoop_path):
        return None
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
