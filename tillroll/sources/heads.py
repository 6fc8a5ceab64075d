"""The head of each source file, read by itself."""

from __future__ import annotations

import csv
import math
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame

# Bytes per read. A longer first line takes several reads; it is never cut.
HEAD_BYTES = 4096
FILES_PER_TASK = 500


def _first_line(stream: pa.NativeFile) -> str | None:
    """The first line that is not blank; None if there is none."""
    rest = b""
    while True:
        chunk = stream.read(HEAD_BYTES)
        lines = (rest + chunk).splitlines(keepends=True)
        # The last line may go on, unless this was the end.
        rest = lines.pop() if chunk and lines else b""
        for line in lines:
            if line.strip():
                return line.decode("utf-8", "replace").rstrip("\r\n")
        if not chunk:
            return None


def file_headers(files: DataFrame, n_files: int | None = None) -> DataFrame:
    """Per listed file the fields of its first line that is not blank: ``file_uri, header``.

    A few kB are read per file, however long it is, by tasks of ``FILES_PER_TASK`` files. A file
    of blank lines has a null header. Files are opened through ``pyarrow.fs`` (local and shared
    folders, HDFS, S3, GCS); where that cannot reach them, use the ``fail`` gate.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            headers = []
            for uri in batch.column("file_uri").to_pylist():
                fs, path = pafs.FileSystem.from_uri(uri)
                with fs.open_input_stream(path) as stream:
                    line = _first_line(stream)
                headers.append(None if line is None else next(csv.reader([line])))
            yield pa.record_batch(
                [batch.column("file_uri"), pa.array(headers, pa.list_(pa.string()))],
                names=["file_uri", "header"],
            )

    tasks = math.ceil((files.count() if n_files is None else n_files) / FILES_PER_TASK)
    spread = files.select("file_uri").repartition(max(1, tasks))
    return spread.mapInArrow(read, "file_uri string, header array<string>")
