"""The corpus pipeline: from the documents table to token ids, in five stages.

Every stage takes what its predecessor kept, works on all of it, and passes on the rows it keeps;
all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillroll.llm.bpe import encode_decode
from tillroll.llm.kneser_ney import ordinary
from tillroll.llm.latent import decontaminated
from tillroll.llm.minhash import one_of_each_group
from tillroll.llm.pii import redacted
from tillroll.llm.tables import table
from tillroll.storage import stored_scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Bytes of a batch of texts on its way to a Python worker. Spark's bounds (10,000 rows, 64 MB) let
# a task hold a whole file of texts several times over, in the JVM and in the worker.
BATCH_BYTES = 2 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_small_batches(stage: Stage) -> Stage:
    """The stage in a session whose batches are bounded by ``BATCH_BYTES``, or less if it says so.

    The bound stays, because the frame that is returned is computed later.
    """

    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        set_ = int(spark.conf.get(_BATCH_CONF).lower().removesuffix("b"))
        if not 0 < set_ <= BATCH_BYTES:
            spark.conf.set(_BATCH_CONF, BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return bounded


@in_small_batches
def leave_out_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity scores reject go (operator 6)."""
    return ordinary(spark, docs, table(spark, sf_dir, "labels"))


@in_small_batches
def leave_out_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (operator 5)."""
    return one_of_each_group(spark, docs)


@in_small_batches
def leave_out_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go (operator 4)."""
    return decontaminated(spark, docs, table(spark, sf_dir, "benchmark"))


@in_small_batches
def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind (operator 1)."""
    return redacted(spark, docs)


@in_small_batches
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left (operator 10)."""
    return encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", leave_out_toxic),
    ("near-duplicates", leave_out_near_duplicates),
    ("decontamination", leave_out_contaminated),
    ("personal-data", redact),
    ("encoding", encode),
]

# Classifiers, near-duplicate search and encoding are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored_scratch(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
