"""Toxicity by two class-conditional Kneser-Ney bigram models with shared backoff counts.

Class counts come from every labelled document outside the held-out fold, the backoff distribution
that both classes share from the bigrams of *all* documents. Spark counts the bigrams by a hash;
what tasks get to score with are arrays of fixed size, by the slots of a word's or bigram's hash.
A bigram seen once in a class is discounted by its whole count, so only bigrams seen again carry
weight of their own: rare expressions are left to the backoff.

The two models' log-likelihoods are compared per word, over the whole text and over windows: one
insulting passage makes a long text toxic, so the highest window counts as well. A logistic curve,
fitted on documents that the counts leave out, turns both into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.joins import likely_rows
from tillroll.llm.labelled import held_out, labels_to_learn, remainder
from tillroll.llm.textarrays import lowered, mixed, runs, utf8, word_hashes, words
from tillroll.storage import stored_scratch

FOLDS, HELD_OUT, CALIBRATION = 5, 0, 4
# Slots of words, in which their contexts are counted, and of bigrams seen again, as powers of two.
WORD_BITS, PAIR_BITS = 20, 23
# Registers that count a word's distinct contexts (a HyperLogLog of 16).
REGISTER_BITS = 4
DISCOUNT, SHARED = 1.0, 5.0
# Words per window; the features of a text are its whole and its highest windows.
WINDOWS = (2, 8)
FEATURES = ("whole", *[f"window_{n}" for n in WINDOWS])
THRESHOLD = 0.5
RIDGE = 1e-3

_START = np.uint64(1)
_WORDS = np.uint64((1 << WORD_BITS) - 1)
_REGISTERS = 1 << REGISTER_BITS


def bigrams(run: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per word: hash of the word before it (or of the start), its own, and of both.

    Words are runs of ASCII letters, digits and characters beyond ASCII, in lower case. The fourth
    array tells how many words each text has.
    """
    data, starts = utf8(run.column("text"))
    data = lowered(data)
    letter = (data >= 128) | ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57))
    data = np.where(letter, data, np.uint8(32))
    begin, end, per_text = words(data, starts)
    hashes = word_hashes(data, begin, end)
    before = np.empty_like(hashes)
    if len(hashes):
        before[1:] = hashes[:-1]
        before[(np.cumsum(per_text) - per_text)[per_text > 0]] = _START
    return before, hashes, mixed(before * np.uint64(3) + hashes), per_text


def word_slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes & _WORDS).astype(np.int32)


def shared_counts(docs: DataFrame) -> np.ndarray:
    """Distinct contexts of each word slot over all documents, estimated by 16 registers.

    A task sends one row per slot it has seen. What reaches the driver is one number per slot.
    """
    registers = [f"r{i}" for i in range(_REGISTERS)]

    def register(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        highest = np.zeros(1 << (WORD_BITS + REGISTER_BITS), np.uint8)
        for batch in batches:
            for run in runs(batch):
                _, word, pair, _ = bigrams(run)
                register_ = (pair >> np.uint64(64 - REGISTER_BITS)).astype(np.int64)
                at = (word_slot(word).astype(np.int64) << REGISTER_BITS) | register_
                # Leading zeros of the next 44 bits, by the exponent of their value.
                rest = ((pair >> np.uint64(16)) & np.uint64((1 << 44) - 1)).astype(np.float64)
                np.maximum.at(highest, at, (45 - np.frexp(rest)[1]).astype(np.uint8))
        tops = highest.view(np.int8).reshape(-1, _REGISTERS)
        for first in range(0, len(tops), 1 << 14):
            part = tops[first : first + (1 << 14)]
            slot = np.flatnonzero(part.any(axis=1))
            yield pa.record_batch(
                [(first + slot).astype(np.int32), *part[slot].T.copy()], names=["slot", *registers]
            )

    tops = docs.select("text").mapInArrow(register, ", ".join(["slot int", *[f"{r} byte" for r in registers]]))
    tops = tops.groupBy("slot").agg(*[F.max(r).alias(r) for r in registers])
    used, total = F.lit(0), F.lit(0.0)
    for r in registers:
        used += (F.col(r) > 0).cast("int")
        total += F.when(F.col(r) > 0, F.pow(F.lit(2.0), -F.col(r))).otherwise(0.0)
    found = tops.select("slot", used.alias("n"), total.alias("s")).toArrow()
    slot, used, total = (found.column(i).to_numpy() for i in range(3))
    m = _REGISTERS
    empty = m - used
    # 0.673 is HyperLogLog's constant for 16 registers; few contexts are counted linearly.
    estimate = 0.673 * m * m / (total + empty)
    linear = m * np.log(m / np.maximum(empty, 1))
    out = np.zeros(1 << WORD_BITS)
    out[slot] = np.where((estimate <= 2.5 * m) & (empty > 0), linear, estimate)
    return out


class Corrections:
    """What a bigram adds to its second word's log ratio, by slot; bigrams of one slot share it."""

    def __init__(self, slots: np.ndarray, values: np.ndarray) -> None:
        self._of = np.full(1 << PAIR_BITS, np.nan, np.float16)
        self._of[slots] = values
        self._shift = np.uint64(64 - PAIR_BITS)

    def of(self, pairs: np.ndarray, default: np.ndarray) -> np.ndarray:
        found = self._of[(pairs >> self._shift).astype(np.int64)]
        return np.where(np.isnan(found), default, found).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Log ratios toxic to ordinary: of words by backoff, and what bigrams seen again add."""

    word: np.ndarray  # by slot
    pair: Corrections
    weights: tuple[float, ...] | None = None


# A bigram's key holds the slots of its words, and the first bits of its hash, which give its own
# slot and tell apart what shares both words' slots.
_REST_BITS = 64 - 2 * WORD_BITS
# Two counts in one long, so that rows stay small: of the ordinary, and above it the toxic documents.
_COUNT_BITS = 32


def _keys(before: np.ndarray, word: np.ndarray, pair: np.ndarray) -> np.ndarray:
    slots = ((word & _WORDS) << np.uint64(WORD_BITS)) | (before & _WORDS)
    return (slots << np.uint64(_REST_BITS)) | (pair >> np.uint64(64 - _REST_BITS))


def _bits_of_key(above: int, n: int) -> Column:
    """``n`` bits of the key that have ``above`` others above them."""
    bits = F.shiftrightunsigned(F.col("key"), 64 - above - n)
    return bits.bitwiseAND(F.lit((1 << n) - 1).cast("long")).cast("int")


def count_pairs(labelled: DataFrame) -> DataFrame:
    """``key, c0, c1``: how many of each class's documents hold a bigram.

    A document counts once however often it repeats itself.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch):
                before, word, pair, per_text = bigrams(run)
                text = np.repeat(np.arange(len(per_text)), per_text)
                _, first = np.unique(pair + mixed(text), return_index=True)
                label = run.column("label").to_numpy()[text[first]].astype(np.int64)
                keys, at = np.unique(_keys(before, word, pair)[first], return_inverse=True)
                toxic = np.bincount(at, label, len(keys)).astype(np.int64)
                ordinary_ = np.bincount(at, 1 - label, len(keys)).astype(np.int64)
                yield pa.record_batch(
                    [keys.view(np.int64), ordinary_ + (toxic << _COUNT_BITS)], names=["key", "n"]
                )

    rows = labelled.select("text", "label").mapInArrow(count, "key long, n long")
    sums = rows.groupBy("key").agg(F.sum("n").alias("n"))
    return sums.select(
        "key",
        F.col("n").bitwiseAND(F.lit((1 << _COUNT_BITS) - 1)).alias("c0"),
        F.shiftrightunsigned("n", _COUNT_BITS).alias("c1"),
    )


def _by_slot(rows: DataFrame) -> list[np.ndarray]:
    """Columns of rows ``slot, ...`` as arrays over all word slots: nothing larger gets to the driver."""
    slot, *columns = (c.to_numpy() for c in rows.toArrow().columns)
    out = []
    for column in columns:
        out.append(np.zeros(1 << WORD_BITS))
        out[-1][slot] = column
    return out


def fit_counts(labelled: DataFrame, shared: np.ndarray) -> Model:
    """Both models' ratios from labelled documents (``text, label``) and the shared counts."""
    pairs = stored_scratch(count_pairs(labelled), "bigrams")
    classes = ("c0", "c1")
    word, before = _bits_of_key(0, WORD_BITS), _bits_of_key(WORD_BITS, WORD_BITS)
    slot = _bits_of_key(2 * WORD_BITS, PAIR_BITS)
    # A word's distinct contexts in each class, and how often it is a context itself.
    contexts = _by_slot(pairs.groupBy(word.alias("slot")).agg(*[F.count_if(F.col(c) > 0) for c in classes]))
    totals = _by_slot(pairs.groupBy(before.alias("slot")).agg(*[F.sum(c) for c in classes]))
    # What contexts in one class or both say, if they are more than one.
    again = (contexts[0] > DISCOUNT) | (contexts[1] > DISCOUNT)
    shared = (shared + 0.5) / (shared.sum() + 0.5 * len(shared))
    # A word's continuation probability in each class, shrunk to the shared one as if the class
    # held it in SHARED more contexts; the more contexts a class shows, the less that weighs.
    lower = [
        np.where(again, shared * (np.maximum(n - DISCOUNT, 0) + SHARED) / (n.sum() * shared + SHARED), shared)
        for n in contexts
    ]
    arrays = pairs.sparkSession.sparkContext.broadcast(
        [[a.astype(np.float32) for a in both] for both in (lower, totals)]
    )

    def correct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower, totals = arrays.value
        for batch in batches:
            second, first, c0, c1 = (batch.column(c).to_numpy() for c in ("word", "before", *classes))
            value = np.zeros(batch.num_rows)
            for sign, n, low, total in zip((-1, 1), (c0, c1), lower, totals, strict=True):
                shown = np.maximum(n - DISCOUNT, 0) + SHARED
                value += sign * np.log(shown / (total[first] * low[second] + SHARED))
            weight = (c0 + c1).astype(np.float32)
            yield pa.record_batch(
                [batch.column("slot"), (value * weight).astype(np.float32), weight],
                names=["slot", "value", "weight"],
            )

    seen = pairs.filter((F.col("c0") > DISCOUNT) | (F.col("c1") > DISCOUNT))
    rows = seen.select(slot.alias("slot"), word.alias("word"), before.alias("before"), *classes)
    rows = rows.mapInArrow(correct, "slot int, value float, weight float")
    slots = rows.groupBy("slot").agg((F.sum("value") / F.sum("weight")).cast("float").alias("value")).toArrow()
    corrections = Corrections(slots.column("slot").to_numpy(), slots.column("value").to_numpy())
    return Model(np.log(lower[1] / lower[0]).astype(np.float32), corrections)


def log_ratios(model: Model, run: pa.RecordBatch) -> list[np.ndarray]:
    """Per text: log ratio per word of the whole, and of its highest window of each length."""
    _, word, pair, per_text = bigrams(run)
    ratio = model.word[word_slot(word)].astype(np.float64)
    ratio += model.pair.of(pair, np.zeros(len(pair), np.float32))
    out = [np.zeros(len(per_text)) for _ in FEATURES]
    has = np.flatnonzero(per_text)
    if not len(has):
        return out
    n = len(ratio)
    total = np.zeros(n + 1)
    np.cumsum(ratio, out=total[1:])
    end = np.cumsum(per_text)
    begin = end - per_text
    out[0][has] = (total[end] - total[begin])[has] / per_text[has]
    for feature, length in zip(out[1:], WINDOWS, strict=True):
        # A window that the end of the text cuts short counts as if filled with even words.
        stop = np.minimum(np.arange(n) + length, np.repeat(end, per_text))
        window = (total[stop] - total[:-1]) / length
        feature[has] = np.maximum.reduceat(window, begin[has])
    return out


def _features(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` but ``text``, with the features."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != "text"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch):
                yield pa.record_batch(
                    [*[run.column(c) for c in kept], *log_ratios(shared.value, run)],
                    names=[*kept, *FEATURES],
                )

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name in kept]
    return docs.mapInArrow(measure, ", ".join([*fields, *[f"{f} double" for f in FEATURES]]))


def _logistic(measured: DataFrame) -> tuple[float, ...]:
    """Weights of a logistic regression on the features and its bias, with a slight ridge."""
    rows = measured.select(array_to_vector(F.array(*FEATURES)).alias("features"), F.col("label").cast("double"))
    curve = LogisticRegression(
        regParam=RIDGE / max(1, measured.count()), standardization=False, tol=1e-8, maxIter=200
    ).fit(rows)
    return (*[float(w) for w in curve.coefficients], float(curve.intercept))


def _labelled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id, label, text`` of every document to learn from, and the same without texts.

    Copies of a text are one example, named by its smallest id, so that every run learns the same.
    """
    known = labels_to_learn(labels, "toxic", FOLDS, HELD_OUT)
    digest = F.xxhash64("text").alias("digest")
    ids = docs.groupBy("doc_id", digest).agg(F.count(F.lit(1)).alias("n_rows")).join(known, "doc_id")
    first = ids.groupBy("digest", "label").agg(F.min(F.struct("doc_id", "n_rows")).alias("first"))
    examples = stored_scratch(first.select("first.*", "digest", "label"), "examples")
    rows = likely_rows(docs, examples, "doc_id").withColumn("digest", digest)
    rows = rows.join(examples, ["doc_id", "digest"])
    again = F.col("n_rows") > 1
    if not examples.filter(again).isEmpty():
        once = rows.filter(again).dropDuplicates(["doc_id", "digest", "label"])
        rows = rows.filter(~again).unionByName(once)
    return rows.select("doc_id", "label", "text"), examples


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Learn from the labelled documents outside the held-out fold; None without both classes."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows, examples = _labelled(docs, labels)
    calibration = remainder(FOLDS) == CALIBRATION
    found = examples.groupBy(calibration.alias("last")).agg(F.count_distinct("label").alias("n")).collect()
    if [r.n for r in found] != [2, 2]:
        return None
    model = fit_counts(rows.filter(~calibration), shared_counts(docs))
    measured = stored_scratch(_features(rows.filter(calibration), model), "calibration")
    return Model(model.word, model.pair, _logistic(measured))


def _with_score(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` but ``text``, with the features and ``score``."""
    logit = F.lit(model.weights[-1])
    for feature, weight in zip(FEATURES, model.weights, strict=False):
        logit = logit + F.col(feature) * weight
    return _features(docs, model).withColumn("score", 1 / (1 + F.exp(-logit)))


def ordinary(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not scored as toxic; same columns.

    Rows are judged where they lie: nothing but the learning is shuffled.
    """
    model = fit(docs, labels)
    if model is None:
        return docs
    shared = spark.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *weights, bias = shared.value.weights
        for batch in batches:
            for run in runs(batch):
                found = log_ratios(shared.value, run)
                logit = bias + sum(w * f for w, f in zip(weights, found, strict=True))
                score = 1 / (1 + np.exp(-np.clip(logit, -700, 700)))
                yield run.filter(pa.array(score < THRESHOLD))

    return docs.mapInArrow(keep, docs.schema)


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: ``doc_id, held_out, score, predicted`` and the log ratios.

    Null and empty texts have log ratios of 0 and a score like any other. Repeated rows are each
    scored; a null ``doc_id`` stays null and counts as not held out. If the labels hold not
    both classes there is nothing to learn: every score is 0. Other columns are not looked at.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = fit(docs, labels)
    if model is None:
        found = docs.select("doc_id", *[F.lit(0.0).alias(c) for c in (*FEATURES, "score")])
    else:
        found = _with_score(docs, model)
    return found.select(
        "doc_id",
        held_out(FOLDS, HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        *[F.col(f).alias(f"llr_{f}") for f in FEATURES],
    )
