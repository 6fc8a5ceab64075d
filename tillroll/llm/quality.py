"""Quality scores by a sparse rule ensemble.

Whole texts are measured once. Spark ML grows a small random forest over the statistics; every path
from a tree's root to a node is a conjunctive rule. A logistic regression with a lasso penalty weighs
the rules and drops most of them. What is left is compiled into one Spark column, so scoring needs
the statistics and no model.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.labelled import bounded_sample, held_out, labels_to_learn
from tillroll.llm.textarrays import (
    lowered,
    mixed,
    runs,
    span_hashes,
    sums_by_text,
    utf8,
    word_hashes,
    words,
)
from tillroll.storage import stored_scratch

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
# Labelled documents of each class whose statistics are learned from, at most (about).
PER_CLASS = 50_000
TREES, DEPTH, LASSO = 16, 3, 0.0005
STATISTICS = (
    "log_bytes", "log_words", "log_lines", "word_length", "longest_word", "words_per_line",
    "letters", "upper", "digits", "marks", "pipes", "beyond_ascii", "distinct_words",
    "repeated_words", "commonest_word", "distinct_lines", "short_words", "sentence_ends",
)

Rule = tuple[tuple[str, str, float], ...]


def _salted(hashes: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """The hashes, made different in different texts."""
    salt = mixed(np.arange(11, 11 + len(per_text), dtype=np.uint64))
    return hashes + np.repeat(salt, per_text)


def _distinct(hashes: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: number of distinct hashes, and how often the commonest occurs."""
    codes, values = pd.factorize(_salted(hashes, per_text))
    text = np.repeat(np.arange(len(per_text)), per_text)
    owner = np.zeros(len(values), np.int64)
    owner[codes] = text
    most = np.zeros(len(per_text), np.int64)
    np.maximum.at(most, owner, np.bincount(codes, minlength=len(values)))
    return np.bincount(owner, minlength=len(per_text)), most


def statistics(run: pa.RecordBatch) -> list[np.ndarray]:
    """``STATISTICS`` of every text; an empty text has 0 in all of them."""
    data, starts = utf8(run.column("text"))
    size = np.diff(starts)
    per_byte = np.maximum(size, 1)

    def share(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(mask))[starts]) / per_byte

    begin, end, n_words = words(data, starts)
    hashes = word_hashes(lowered(data), begin, end)
    length = (end - begin).astype(np.float64)
    per_word = np.maximum(n_words, 1)
    distinct, most = _distinct(hashes, n_words)
    text = np.repeat(np.arange(len(size)), n_words)
    again = np.zeros(len(hashes), bool)
    if len(hashes):
        again[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    longest = np.zeros(len(size))
    np.maximum.at(longest, text, length)
    last = data[end - 1] if len(end) else np.empty(0, np.uint8)
    ends = (last == 46) | (last == 33) | (last == 63)

    # Lines of every text: what its line feeds part.
    breaks = data == 10
    line_first = np.zeros(len(data) + 1, bool)
    line_first[1:] = breaks
    line_first[starts[:-1][size > 0]] = True
    line_begin = np.flatnonzero(line_first[: len(data)])
    line_end = np.append(line_begin, len(data))[1:]
    n_lines = np.diff(np.searchsorted(line_begin, starts))
    # Without the line feed itself, which a last line may lack.
    line_end = line_end - breaks[line_end - 1]
    lines, _ = _distinct(span_hashes(data, line_begin, line_end), n_lines)
    per_line = np.maximum(n_lines, 1)

    upper = (data >= 65) & (data <= 90)
    letters = upper | ((data >= 97) & (data <= 122)) | (data >= 128)
    digits = (data >= 48) & (data <= 57)
    marks = (data > 32) & ~letters & ~digits
    return [
        np.log1p(size),
        np.log1p(n_words),
        np.log1p(n_lines),
        sums_by_text(length, n_words) / per_word,
        longest,
        n_words / per_line,
        share(letters),
        share(upper),
        share(digits),
        share(marks),
        share(data == 124),
        share(data >= 128),
        distinct / per_word,
        sums_by_text(again, n_words) / per_word,
        most / per_word,
        lines / per_line,
        sums_by_text(length <= 2, n_words) / per_word,
        sums_by_text(ends, n_words) / per_word,
    ]


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every row."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch):
                columns = [pa.array(c.astype(np.float64)) for c in statistics(run)]
                yield pa.record_batch([run.column("doc_id"), *columns], names=["doc_id", *STATISTICS])

    schema = ", ".join(["doc_id long", *[f"{c} double" for c in STATISTICS]])
    return docs.select("doc_id", "text").mapInArrow(measure, schema)


_BRANCH = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)")


def rules_of(tree: str) -> list[Rule]:
    """The conditions on the way to every node of a printed tree, the root left out."""
    path: list[tuple[str, str, float]] = []
    found, base = [], None
    for line in tree.splitlines():
        branch = _BRANCH.match(line)
        if branch:
            base = len(branch[1]) if base is None else base
            depth = len(branch[1]) - base
            path = [*path[:depth], (STATISTICS[int(branch[2])], branch[3], float(branch[4]))]
            found.append(tuple(path))
    return found


def holds(rule: Rule) -> Column:
    """A rule as a Spark column."""
    tests = [F.col(s) <= t if sign == "<=" else F.col(s) > t for s, sign, t in rule]
    return reduce(lambda a, b: a & b, tests)


def grow_rules(examples: DataFrame) -> list[Rule]:
    """Distinct rules of a random forest over ``label`` and the statistics."""
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="stats").transform(examples)
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="stats", numTrees=TREES, maxDepth=DEPTH, seed=3
    ).fit(vectors.select("stats", "label"))
    return sorted({rule for tree in forest.trees for rule in rules_of(tree.toDebugString)})


def weigh_rules(examples: DataFrame, rules: list[Rule]) -> tuple[list[tuple[Rule, float]], float]:
    """Rules that the lasso keeps, with their weights, and the intercept."""
    fired = F.array(*[holds(r).cast("double") for r in rules])
    vectors = examples.select(array_to_vector(fired).alias("rules"), "label")
    fitted = LogisticRegression(
        labelCol="label",
        featuresCol="rules",
        elasticNetParam=1.0,
        regParam=LASSO,
        maxIter=60,
        standardization=False,
    ).fit(vectors)
    weights = fitted.coefficients.toArray().tolist()
    kept = [(r, w) for r, w in zip(rules, weights, strict=True) if w]
    return kept, float(fitted.intercept)


def fit(stats: DataFrame, labels: DataFrame) -> Column | None:
    """The score as a column over the statistics; None if not both labels were learned from."""
    known = bounded_sample(labels_to_learn(labels, "quality", FOLDS, HELD_OUT), PER_CLASS)
    examples = stats.dropDuplicates(["doc_id"]).join(known, "doc_id").drop("doc_id")
    examples = stored_scratch(examples, "examples")
    if examples.select("label").distinct().count() < 2:
        return None
    rules = grow_rules(examples)
    if not rules:
        return None
    kept, intercept = weigh_rules(examples, rules)
    logit = F.lit(intercept)
    for rule, weight in kept:
        logit = logit + F.when(holds(rule), weight).otherwise(0.0)
    return 1 / (1 + F.exp(-logit))


def quality(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: ``doc_id, held_out, score, predicted`` and the statistics.

    Null and empty texts are measured as 0 throughout and scored like any other. Repeated rows are
    each scored, and learned from once; a null ``doc_id`` stays null and counts as not held out. If
    the labels do not hold both classes, every score is 0.5. Other columns are not looked at.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    stats = stored_scratch(measured(docs), "statistics")
    score = fit(stats, labels)
    scored = stats.withColumn("score", F.lit(0.5) if score is None else score)
    return scored.select(
        "doc_id",
        held_out(FOLDS, HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        *STATISTICS,
    )
