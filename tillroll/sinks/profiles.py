"""Profiles of loaded files, kept beside the ledger, so that a growing table's profile reads no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll import storage
from tillroll.operators.profiling import column_states, merged_profile
from tillroll.schema import SOURCE_SCHEMA
from tillroll.sources.files import literal_path
from tillroll.sources.tables import last_loaded, read_ledger


def profiles_path(ledger_path: str) -> str:
    return f"{ledger_path.rstrip('/')}_profiles"


def write_profiles(lines: DataFrame, files: DataFrame, ledger_path: str, batch_id: str) -> None:
    """Keep the state of each loaded file, of all its lines; a repeated batch replaces its own."""
    states = column_states(lines.select(*SOURCE_SCHEMA.fieldNames(), "file_uri"), by=["file_uri"])
    states = states.join(files.select("file_uri", "path"), "file_uri").drop("file_uri")
    states.hint("rebalance").write.mode("overwrite").parquet(f"{profiles_path(ledger_path)}/batch_id={batch_id}")


def kept_profile(spark: SparkSession, ledger_path: str) -> DataFrame:
    """``merged_profile`` of the lines of all files, each as the ledger says it was last loaded.

    Files of loads that kept no profile are not in it.
    """
    path = profiles_path(ledger_path)
    if not storage.has_files(spark, path):
        raise ValueError(f"no profiles are kept beside {ledger_path}")
    states = spark.read.parquet(literal_path(path))
    last = last_loaded(read_ledger(spark, ledger_path)).select("path", "batch_id")
    return merged_profile(states.join(last, ["path", "batch_id"]))
