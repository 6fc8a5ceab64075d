"""Language identification by error-correcting output codes over byte trigrams.

Every language has a codeword. Each bit of it is predicted by a binary classifier: the log ratio of
the trigram frequencies of the languages whose bit is set to those of the others. Counts come from
all documents that may be learned from; Spark adds them up per language and hashed trigram, a table
whose size does not depend on the corpus. Decoding weighs each bit's loss by how far the
classifier's two sides are apart and takes the codeword of least loss; a close second is flagged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.labelled import held_out
from tillroll.llm.textarrays import lowered, runs, utf8

FOLDS, HELD_OUT = 4, 2
GRAM_BITS = 16
SMOOTHING = 0.5
# With up to this many languages the code holds every split of them, beyond it BITS random ones.
EXHAUSTIVE, BITS = 6, 64
UNKNOWN = "und"
# A document is ambiguous if its second codeword's score is within this of the first's.
AMBIGUOUS = 0.2
PREDICTED = "doc_id long, lang_pred string, score double, ambiguous boolean"


def trigrams(run: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams around every letter of every text, and how many each text has.

    ASCII other than letters counts as space, and so does what is before and after a text.
    """
    data, starts = utf8(run.column("text"))
    data = lowered(data)
    letter = (data >= 128) | ((data >= 97) & (data <= 122))
    data = np.where(letter, data, np.uint8(32)).astype(np.uint32)
    before, after = np.full(len(data), 32, np.uint32), np.full(len(data), 32, np.uint32)
    before[1:], after[:-1] = data[:-1], data[1:]
    inside = starts[:-1][np.diff(starts) > 0]
    before[inside] = 32
    after[inside[1:] - 1] = 32
    gram = (before << np.uint32(16)) | (data << np.uint32(8)) | after
    gram = (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAM_BITS)
    places = np.flatnonzero(letter)
    return gram[places].astype(np.int64), np.diff(np.searchsorted(places, starts))


def gram_counts(docs: DataFrame, languages: list[str]) -> np.ndarray:
    """Trigram counts by language, over all rows of ``lang, text``."""
    place = {lang: i for i, lang in enumerate(languages)}
    size = 1 << GRAM_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(place) * size, np.int64)
        for batch in batches:
            for run in runs(batch):
                gram, per_text = trigrams(run)
                lang = np.array([place[x] for x in run.column("lang").to_pylist()], np.int64)
                total += np.bincount(gram + np.repeat(lang, per_text) * size, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.record_batch([at.astype(np.int64), total[at]], names=["at", "n"])

    sums = docs.select("lang", "text").mapInArrow(count, "at long, n long")
    found = sums.groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(place) * size)
    out[found.column("at").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(len(place), size)


def codewords(n: int) -> np.ndarray:
    """A row of +1 and -1 per language; no column or its opposite occurs twice."""
    if n < 2:
        return np.zeros((n, 0), np.int8)
    if n <= EXHAUSTIVE:
        # The first language is always set; the others take every combination but all set.
        columns = [[1, *[1 if k >> i & 1 else -1 for i in range(n - 1)]] for k in range(2 ** (n - 1) - 1)]
        return np.array(columns, np.int8).T
    rng = np.random.default_rng(n)
    best, apart = None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.int8), (n, BITS))
        code[0, np.abs(code.sum(axis=0)) == n] *= -1  # a bit must split the languages
        product = code.astype(int) @ code.T
        distance = (BITS - product[~np.eye(n, dtype=bool)].max()) // 2
        if distance > apart:
            best, apart = code, distance
    return best


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    bits: np.ndarray  # bits x trigrams: log ratios
    centre: np.ndarray  # per bit: the margin halfway between its two sides
    weight: np.ndarray  # per bit: how far its sides are apart, 1 on average


def fit(docs: DataFrame) -> Model | None:
    """Learn from all texts with a language outside the held-out fold; None if there are none."""
    known = docs.filter(
        F.col("doc_id").isNotNull()
        & F.col("lang").isNotNull()
        & F.col("text").isNotNull()
        & ~held_out(FOLDS, HELD_OUT)
    )
    languages = sorted(r.lang for r in known.select("lang").distinct().collect())
    if not languages:
        return None
    counts = gram_counts(known, languages) + SMOOTHING
    share = counts / counts.sum(axis=1, keepdims=True)
    code = codewords(len(languages))
    bits, centre, apart = [], [], []
    for column in code.T:
        set_, unset = share[column > 0].mean(axis=0), share[column < 0].mean(axis=0)
        ratio = np.log(set_ / unset)
        # Expected margins of the closest languages on either side.
        margins = share @ ratio
        low, high = margins[column < 0].max(), margins[column > 0].min()
        bits.append(ratio.astype(np.float32))
        centre.append((low + high) / 2)
        apart.append(max(high - low, 1e-6))
    weight = np.array(apart)
    weight = weight / weight.mean() if len(weight) else weight
    return Model(languages, code, np.array(bits), np.array(centre), weight)


def decode(model: Model, gram: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Score of every language for every text: the soft minimum of the codewords' losses."""
    loss = np.zeros((len(per_text), len(model.languages)))
    has = np.flatnonzero(per_text)
    begin = (np.cumsum(per_text) - per_text)[has]
    for b, ratio in enumerate(model.bits):
        margin = np.zeros(len(per_text))
        if len(has):
            margin[has] = np.add.reduceat(ratio[gram], begin) / per_text[has] - model.centre[b]
        # Evidence adds up with the text, but neighbouring trigrams repeat each other.
        margin *= np.sqrt(per_text)
        loss += model.weight[b] * np.logaddexp(0, -np.outer(margin, model.code[:, b]))
    score = np.exp(loss.min(axis=1, keepdims=True) - loss)
    return score / score.sum(axis=1, keepdims=True)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(shared.value.languages, object)
        for batch in batches:
            for run in runs(batch):
                gram, per_text = trigrams(run)
                scores = decode(shared.value, gram, per_text)
                order = np.sort(scores, axis=1)
                best, top = scores.argmax(axis=1), order[:, -1]
                second = order[:, -2] if scores.shape[1] > 1 else np.zeros(len(top))
                # Bytes beyond ASCII may be signs other than letters.
                texts = run.column("text").to_pylist()
                lettered = [any(map(str.isalpha, t or "")) for t in texts]
                yield pa.record_batch(
                    [
                        run.column("doc_id"),
                        pa.array(np.where(lettered, names[best], UNKNOWN), pa.string()),
                        np.where(lettered, top, 0.0),
                        np.where(lettered, top - second < AMBIGUOUS, True),
                    ],
                    names=["doc_id", "lang_pred", "score", "ambiguous"],
                )

    return docs.select("doc_id", "text").mapInArrow(of, PREDICTED)


def language_id(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, held_out, lang_pred, score, ambiguous``.

    A text that is null or has no letter is ``und`` with score 0, and so is every text if there is
    nothing to learn from. Repeated rows are each predicted; a row without ``doc_id`` is not
    learned from and not held out. Other columns are not looked at.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    model = fit(docs)
    if model is None:
        found = docs.select(
            "doc_id",
            F.lit(UNKNOWN).alias("lang_pred"),
            F.lit(0.0).alias("score"),
            F.lit(True).alias("ambiguous"),
        )
    else:
        found = predict(docs, model)
    return found.select(
        "doc_id", held_out(FOLDS, HELD_OUT).alias("held_out"), "lang_pred", "score", "ambiguous"
    )
