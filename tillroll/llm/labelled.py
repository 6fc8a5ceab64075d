"""Labelled rows that a model may learn from, and a bounded share of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(parts: int) -> Column:
    """Which of ``parts`` folds a document is in: crc32 of its id's digits."""
    return (F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts).cast("int")


def held_out(parts: int, fold: int) -> Column:
    return F.coalesce(remainder(parts) == fold, F.lit(False))


def labels_to_learn(labels: DataFrame, target: str, parts: int, fold: int) -> DataFrame:
    """``doc_id, label`` of rows outside the held-out fold; labels other than 0 and 1 are none.

    A document labelled more than once counts once, with its largest label.
    """
    known = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("label")
    )
    known = known.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    return known.filter(~held_out(parts, fold)).groupBy("doc_id").agg(F.max("label").alias("label"))


def bounded_sample(labels: DataFrame, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each label at most, drawn by a hash of the document id."""
    counts = {r.label: r.n for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1_000_000))
    share = F.lit(0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, int(1_000_000 * min(1, per_class / n))).otherwise(share)
    return labels.filter(place < share)
