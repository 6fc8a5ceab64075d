"""Load files as they arrive: a checkpoint finds them, the ledger says which are loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll.plans.loads import load_files
from tillroll.sources.files import literal_path

# Fixed value: the schema of Spark's binaryFile source.
_BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def file_stream(
    spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of arriving files, in the columns of a listing. No file is opened."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(_BINARY_FILE)
        .option("pathGlobFilter", "*.csv")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(literal_path(source_dir)).select(
        "path",
        F.col("_metadata.file_path").alias("file_uri"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


def start_pickup(
    spark: SparkSession,
    source_dir: str,
    table_path: str,
    ledger_path: str,
    checkpoint: str,
    mode: str = "upsert",
    fmt: str = "parquet",
    gate: str = "header",
    max_files_per_trigger: int | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Start loading: all files there now and then stop, or every ``interval``.

    The stream carries file names; each micro-batch runs the same load as an incremental run,
    because the gate and the deduplication need whole files, not unbounded rows. The ledger stays
    the one truth: files that it names, from a batch load or a micro-batch that ran before, are
    not loaded again. Rejected files and lines are kept beside the ledger as by any load; the
    checkpoint has passed a rejected file, so a corrected one must arrive under a new name.
    """

    def load(files: DataFrame, _batch: int) -> None:
        # A name can come up twice in a micro-batch when it holds glob characters.
        names = files.dropDuplicates(["path"])
        load_files(files.sparkSession, names, table_path, ledger_path, mode, fmt, gate)

    writer = (
        file_stream(spark, source_dir, max_files_per_trigger)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
    )
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
