"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are queries; the words they use are the columns of a TF-IDF matrix whose rows are
passages of the documents. Document frequencies come from all passages, and so does the latent space: a
randomised SVD of the whole matrix and the items, its products A'(A x) summed by Spark over tasks.
Then every window of every document is searched: windows that cannot hold what confirms a query, by
prefix sums and by the query's rarest words, are skipped, the others are projected and compared
with all queries of their length, by cosines relative to what the space keeps of the query. Beside
it, every run of ``GRAM`` words that a text shares with a query makes a candidate, so an item that
is there word by word is found whatever the space has kept of it. A candidate is confirmed by the
longest common subsequence of words, and by its answer where the item has one.

A latent space serves at most ``QUERIES`` queries, two a dimension, and ``SPACES`` of them are
searched together, so what tasks hold does not grow with the benchmark.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.textarrays import lowered, mixed, runs, utf8, word_hashes, words
from tillroll.storage import scratch_folder, stored

ITEMS = 2_000  # items the driver holds at a time (about: chosen by a hash)
RANK, OVERSAMPLE = 128, 8
QUERIES, SPACES = 2 * RANK, 10
GRAM = 8  # words of a run that text and query share; shorter queries are one run
PASSAGE = 64  # words per passage of the matrix; longer items are cut into queries of so many
WINDOWS = (8, 12, 16, 24, 32, 48, 64)
RAREST = 3  # of a query's rarest words, how many a region must hold to be looked at
# A window's cosine as a share of what the query itself would reach.
COSINE = 0.35
# Share of a query's words, in order, that a region must hold; short queries must be whole.
COMMON, WHOLE_BELOW = 0.6, 12
ANSWER = re.compile(r"(?:\?|\banswer\s*:)\s*(?=\S)", re.IGNORECASE)
MATCHES = "doc_id long, item_id long, common_words int, item_words int, cosine double"


def bare_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, and how many words each has: lower case, without punctuation."""
    data, starts = utf8(column)
    data = lowered(data)
    letter = (data >= 128) | ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57))
    data = np.where(letter, data, np.uint8(32))
    begin, end, per_text = words(data, starts)
    return word_hashes(data, begin, end), per_text


@dataclass(frozen=True)
class Query:
    item_id: int
    words: tuple[int, ...]
    answer: frozenset[int]

    @property
    def needed(self) -> int:
        n = len(self.words)
        return n if n < WHOLE_BELOW else math.ceil(COMMON * n)


def queries_of(items: list[tuple[int, str]]) -> list[Query]:
    """Items as queries of at most ``PASSAGE`` words; the last one keeps the item's answer."""
    out = []
    hashes, per_text = bare_words(pa.array([t or "" for _, t in items], pa.string()))
    end = np.cumsum(per_text)
    for (item, text), a, b in zip(items, end - per_text, end, strict=True):
        own = hashes[a:b].tolist()
        parts = ANSWER.split(text or "", maxsplit=1)
        answer = bare_words(pa.array([parts[1]]))[0].tolist() if len(parts) > 1 else []
        count = max(1, math.ceil(len(own) / PASSAGE))
        size = math.ceil(len(own) / count)
        for i in range(0, len(own), max(size, 1)):
            last = i + size >= len(own)
            out.append(Query(item, tuple(own[i : i + size]), frozenset(answer if last else ())))
    return out


class Vocabulary:
    """Columns of the matrix: the words of a block of queries."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.unique(hashes)
        self._seen = np.zeros(1 << 20, bool)
        self._seen[self._place(self.hashes)] = True

    @staticmethod
    def _place(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(44)).astype(np.int64)

    def __len__(self) -> int:
        return len(self.hashes)

    def columns(self, hashes: np.ndarray) -> np.ndarray:
        """Column of every word, ``len(self)`` for a word of no query."""
        out = np.full(len(hashes), len(self), np.int32)
        maybe = np.flatnonzero(self._seen[self._place(hashes)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self) - 1)
        hit = self.hashes[at] == hashes[maybe]
        out[maybe[hit]] = at[hit]
        return out


def passages(per_text: np.ndarray) -> np.ndarray:
    """Number of the passage that each word is in; no passage spans two texts."""
    within = np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    first = np.cumsum(-(-per_text // PASSAGE)) - -(-per_text // PASSAGE)
    return np.repeat(first, per_text) + within // PASSAGE


_PASSAGES = "size long, n_words binary, columns binary"


def passage_rows(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The matrix by rows, a row of the frame per run of texts: how many passages it has, how many
    of the vocabulary's words each passage with any holds, and the columns of these words."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, kind = len(shared.value), column_type(len(shared.value))
        for batch in batches:
            for run in runs(batch):
                hashes, per_text = bare_words(run.column("text"))
                column = shared.value.columns(hashes)
                known = column < size
                n_words = np.bincount(passages(per_text)[known])
                parts = n_words[n_words > 0].astype(np.uint8), column[known].astype(kind)
                yield pa.record_batch(
                    [pa.array([int((-(-per_text // PASSAGE)).sum())], pa.int64())]
                    + [pa.array([part.tobytes()], pa.binary()) for part in parts],
                    names=["size", "n_words", "columns"],
                )

    return docs.select("text").mapInArrow(read, _PASSAGES)


def column_type(size: int) -> type:
    """Type of the columns of a stored matrix."""
    return np.uint16 if size <= 1 << 16 else np.int32


def stored_runs(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``size, n_words, columns`` of each run of a stored matrix of ``size`` columns."""
    for n, n_words, columns in zip(*[batch.column(c) for c in ("size", "n_words", "columns")], strict=True):
        per_passage = np.frombuffer(n_words.as_buffer(), np.uint8).astype(np.int64)
        yield n.as_py(), per_passage, np.frombuffer(columns.as_buffer(), column_type(size)).astype(np.int32)


def document_frequencies(matrix: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """In how many passages of all documents each column occurs, and how many there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            for n_passages, n_words, column in stored_runs(batch, size):
                pairs = np.unique(np.repeat(np.arange(len(n_words)), n_words) * size + column)
                total[:-1] += np.bincount(pairs % size, minlength=size)
                total[-1] += n_passages
        at = np.flatnonzero(total)
        yield pa.record_batch([at.astype(np.int64), total[at]], names=["at", "n"])

    found = matrix.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size + 1)
    out[found.column("at").to_numpy()] = found.column("n").to_numpy()
    return out[:-1], int(out[-1])


def _add_products(
    total: np.ndarray, column: np.ndarray, passage: np.ndarray, idf: np.ndarray, x: np.ndarray
) -> None:
    """Add A'(A x) for passages given as word occurrences, sorted by passage; rows of unit length."""
    if not len(column):
        return
    begin = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
    row = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(column))))
    weight = idf[column]
    norm = np.sqrt(np.add.reduceat(weight * weight, begin))
    # A few passages use few of the columns: their part of the matrix is small when dense.
    used = np.zeros(len(x), bool)
    used[column] = True
    columns = np.flatnonzero(used)
    at = row * len(columns) + (np.cumsum(used) - 1)[column]
    part = np.bincount(at, weight / np.maximum(norm[row], 1e-12), len(begin) * len(columns))
    part = part.astype(np.float32).reshape(len(begin), len(columns))
    total[columns] += part.T @ (part @ x[columns])


_ROWS = 64  # matrix rows that travel together
_WORDS = 1 << 12  # words (about) that are multiplied at a time


def gram_product(matrix: DataFrame, place: np.ndarray, idf: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A'(A x) over all passages of the stored matrix; Spark adds up the tasks' parts.

    ``place`` tells the row of ``x`` for each column of the matrix, -1 if it has none.
    """
    shared = matrix.sparkSession.sparkContext.broadcast((place, idf, x.astype(np.float32)))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, weights, right = shared.value
        total = np.zeros(right.shape, np.float64)
        for batch in batches:
            for _, n_words, stored_column in stored_runs(batch, len(places)):
                column = places[stored_column]
                known = column >= 0
                passage = np.repeat(np.arange(len(n_words)), n_words)[known]
                column = column[known]
                # Cut where a passage begins.
                cuts = np.searchsorted(passage, passage[_WORDS::_WORDS]).tolist()
                for first, last in zip([0, *cuts], [*cuts, len(column)], strict=True):
                    _add_products(total, column[first:last], passage[first:last], weights, right)
        for i in range(0, len(total), _ROWS):
            yield pa.record_batch(
                [pa.array([i], pa.int32()), pa.array([total[i : i + _ROWS].tobytes()], pa.binary())],
                names=["at", "part"],
            )

    def add(key: tuple, rows: pa.Table) -> pa.Table:
        parts = [np.frombuffer(p, np.float64) for p in rows.column("part").to_pylist()]
        return pa.table(
            {
                "at": pa.array([key[0].as_py()], pa.int32()),
                "part": pa.array([np.sum(parts, axis=0).tobytes()], pa.binary()),
            }
        )

    schema = "at int, part binary"
    summed = matrix.mapInArrow(multiply, schema).groupBy("at").applyInArrow(add, schema)
    out = np.zeros(x.shape)
    for row in summed.toArrow().to_pylist():
        part = np.frombuffer(row["part"], np.float64).reshape(-1, x.shape[1])
        out[row["at"] : row["at"] + len(part)] = part
    return out


def latent_space(
    matrix: DataFrame, place: np.ndarray, queries: list[Query], vocabulary: Vocabulary, idf: np.ndarray
) -> np.ndarray:
    """Leading right singular vectors of all passages and the queries, by a randomised range finder."""
    size = len(vocabulary)
    width = min(size, RANK + OVERSAMPLE)
    column = vocabulary.columns(np.array([w for q in queries for w in q.words], np.uint64))
    row = np.repeat(np.arange(len(queries)), [len(q.words) for q in queries])

    def both(x: np.ndarray) -> np.ndarray:
        """The queries weigh as much as all passages, so that no query's words are lost."""
        corpus = gram_product(matrix, place, idf, x)
        items = np.zeros(x.shape)
        _add_products(items, column, row, idf, x.astype(np.float32))
        scale = np.linalg.norm(corpus) / max(np.linalg.norm(items), 1e-12)
        return corpus + items * max(scale, 1.0)

    x = np.random.default_rng(7).standard_normal((size, width))
    basis, _ = np.linalg.qr(both(np.linalg.qr(x)[0]))
    small = basis.T @ both(basis)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    top = np.argsort(values)[::-1][: min(RANK, size)]
    return (basis @ vectors[:, top]).astype(np.float32)


def common_subsequence(query: tuple[int, ...], region: list[int]) -> int:
    """Length of the longest common subsequence, a bit of one number per word of the query."""
    masks: dict[int, int] = {}
    for i, word in enumerate(query):
        masks[word] = masks.get(word, 0) | 1 << i
    full = (1 << len(query)) - 1
    row = full
    for word in region:
        mask = masks.get(word)
        if mask:
            both = row & mask
            row = ((row + both) | (row - both)) & full
    return len(query) - row.bit_count()


def confirmed(query: Query, region: list[int]) -> int:
    """Words in common if the region holds enough of the query and of its answer, else 0."""
    present = set(region)
    if sum(map(present.__contains__, query.words)) < query.needed:
        return 0
    common = common_subsequence(query.words, region)
    answered = len(query.answer & present) * 2 >= len(query.answer)
    return common if common >= query.needed and answered else 0


class Texts:
    """Words of a run of texts, and hashes of the word runs in them."""

    def __init__(self, column: pa.Array) -> None:
        self.hashes, self.per_text = bare_words(column)
        self.end = np.cumsum(self.per_text)
        self._grams: dict[int, np.ndarray] = {}

    def grams(self, size: int) -> np.ndarray:
        """Hash of the ``size`` words from each place on, texts taken on end."""
        if size not in self._grams:
            self._grams[size] = grams(self.hashes, size)
        return self._grams[size]


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    count = max(0, len(hashes) - size + 1)
    out = np.zeros(count, np.uint64)
    for i in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + count]
    return mixed(out)


class Phrases:
    """Word runs of queries: where a text shares one, the query may lie there."""

    def __init__(self, queries: list[Query]) -> None:
        by_size: dict[int, list[np.ndarray]] = {}
        for number, query in enumerate(queries):
            size = min(GRAM, len(query.words))
            own = grams(np.array(query.words, np.uint64), size)
            row = np.stack([own.view(np.int64), np.full(len(own), number), np.arange(len(own))])
            by_size.setdefault(size, []).append(row)
        self._tables = []
        for size, rows in by_size.items():
            keys, number, offset = np.concatenate(rows, axis=1)
            keys = keys.view(np.uint64)
            order = np.argsort(keys, kind="stable")
            self._tables.append((size, Vocabulary(keys), keys[order], number[order], offset[order]))

    def places(self, texts: Texts) -> Iterator[tuple[int, int, int]]:
        """``(text, query, where the query would begin)``, each once."""
        for size, known, keys, number, offset in self._tables:
            found = texts.grams(size)
            at = np.flatnonzero(known.columns(found) < len(known))
            text = np.searchsorted(texts.end, at, side="right")
            within = at + size <= texts.end[text]  # no run spans two texts
            at, text = at[within], text[within]
            low, high = (np.searchsorted(keys, found[at], side=s) for s in ("left", "right"))
            count = high - low
            row = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
            place = np.stack([np.repeat(text, count), number[row], np.repeat(at, count) - offset[row]])
            yield from zip(*np.unique(place, axis=1).tolist(), strict=True)


class Searcher:
    """Everything a task needs to search whole texts for a block of queries."""

    def __init__(
        self, queries: list[Query], vocabulary: Vocabulary, idf: np.ndarray, rare: float, space: np.ndarray
    ) -> None:
        self.vocabulary = vocabulary
        # One more entry for words of no query: as rare as can be, and nothing in latent space.
        self.idf = np.append(idf, rare)
        zero = np.zeros((1, space.shape[1]), np.float32)
        self.weighted = np.concatenate([space * idf[:, None].astype(np.float32), zero])
        self.queries, self.phrases = queries, Phrases(queries)
        self.by_window: list[tuple[int, list[Query], np.ndarray, np.ndarray, tuple[np.ndarray, ...]]] = []
        for i, size in enumerate(WINDOWS):
            shorter = WINDOWS[i - 1] if i else 0
            own = [q for q in queries if shorter < len(q.words) <= size]
            if own:
                vectors, kept = zip(*[self._vector(q.words) for q in own], strict=True)
                least = (COSINE * np.minimum(kept, 1.0)).astype(np.float32)
                rarest = self._rarest(own)
                self.by_window.append((size, own, np.stack(vectors), least, rarest))

    def _rarest(self, queries: list[Query]) -> tuple[np.ndarray, ...]:
        """``column, query, wanted`` by column: the words of which a region must hold so many.

        A match leaves out ``len(words) - needed`` words of the query at most. So of its rarest
        words, as many and ``wanted`` more, at least ``wanted`` are in every region that matches.
        """
        found = []
        for number, query in enumerate(queries):
            columns = self.vocabulary.columns(np.array(query.words, np.uint64))
            wanted = min(RAREST, query.needed)
            count = len(columns) - query.needed + wanted
            rarest = np.unique(columns[np.argsort(-self.idf[columns], kind="stable")[:count]])
            found.append(np.stack([rarest, np.full(len(rarest), number), np.full(len(rarest), wanted)]))
        table = np.concatenate(found, axis=1)
        return tuple(table[:, np.argsort(table[0], kind="stable")])

    def _can_match(self, columns, texts: Texts, rarest, size: int) -> np.ndarray:
        """Per place in the texts, whether a window of ``size`` that begins there has a region with
        enough of the rarest words of any one query; no region spans two texts."""
        column, number, wanted = rarest
        n, reach = len(columns), size // 4 + 1
        some = np.zeros(len(self.vocabulary) + 1, bool)
        some[column] = True
        at = np.flatnonzero(some[columns])
        low, high = (np.searchsorted(column, columns[at], side=s) for s in ("left", "right"))
        count = high - low
        row = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
        at, query, wanted = np.repeat(at, count), number[row], wanted[row]
        order = np.argsort(query, kind="stable")
        at, query, wanted = at[order], query[order], wanted[order]
        last = np.arange(len(at)) + wanted - 1
        inside = np.flatnonzero(last < len(at))
        last = last[inside]
        near = (query[last] == query[inside]) & (at[last] - at[inside] < size + 2 * reach)
        a, b = at[inside][near], at[last][near]
        text = np.searchsorted(texts.end, a, side="right")
        same = b < texts.end[text]
        a, b, text = a[same], b[same], text[same]
        # The region of a window from f on is [f - reach, f + size + reach), within its text.
        first = np.maximum(b - size - reach + 1, (texts.end - texts.per_text)[text])
        change = np.zeros(n + 1, np.int64)
        np.add.at(change, first, 1)
        np.add.at(change, np.minimum(a + reach, n - 1) + 1, -1)
        return np.cumsum(change)[:-1] > 0

    def _vector(self, hashes: tuple[int, ...]) -> tuple[np.ndarray, float]:
        """Direction of the words in the space, and the share of their length that it keeps."""
        columns = self.vocabulary.columns(np.array(hashes, np.uint64))
        projected = self.weighted[columns].sum(axis=0)
        length = float(np.linalg.norm(projected))
        whole = math.sqrt((self.idf[columns] ** 2).sum())
        return projected / max(length, 1e-12), length / max(whole, 1e-12)

    def search(self, texts: Texts) -> Iterator[tuple[int, Query, int, float]]:
        """``(place of the text, query, common words, cosine)`` of every confirmed match."""
        if not len(texts.hashes):
            return
        yield from self._shared(texts)
        hashes, per_text, end = texts.hashes, texts.per_text, texts.end
        columns = self.vocabulary.columns(hashes)
        weight = self.idf[columns] ** 2
        whole = np.append(0, np.cumsum(weight))
        known = np.append(0, np.cumsum(np.where(columns < len(self.vocabulary), weight, 0)))
        for size, queries, vectors, least, rarest in self.by_window:
            can_match = self._can_match(columns, texts, rarest, size)
            stride = max(1, size // 4)
            # Windows of every text, the last one up to its end.
            count = np.where(per_text > 0, -(-np.maximum(per_text - size, 0) // stride) + 1, 0)
            text = np.repeat(np.arange(len(per_text)), count)
            step = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
            first = (end - per_text)[text] + step * stride
            able = can_match[first]
            text, first = text[able], first[able]
            last = np.minimum(first + size, end[text])
            norm = whole[last] - whole[first]
            # No cosine is above the root of the known words' share of the squared weight.
            able = known[last] - known[first] >= float(least.min()) ** 2 * norm
            found = self._candidates(columns, first[able], last[able], norm[able], size, vectors, least)
            yield from self._confirmed(
                hashes, columns, text[able], first[able], last[able], end, per_text, size, queries, found
            )

    def _shared(self, texts: Texts) -> Iterator[tuple[int, Query, int, float]]:
        """Matches where text and query share a run of words."""
        done: set[tuple[int, int]] = set()
        for at, number, place in self.phrases.places(texts):
            if (at, number) in done:
                continue
            query = self.queries[number]
            size, stop = len(query.words), int(texts.end[at])
            start = stop - int(texts.per_text[at])
            reach = size // 4 + 1
            region = texts.hashes[max(place - reach, start) : min(place + size + reach, stop)].tolist()
            common = confirmed(query, region)
            if common:
                done.add((at, number))
                there = texts.hashes[max(place, start) : min(place + size, stop)]
                (own, _), (other, kept) = self._vector(query.words), self._vector(there)
                yield at, query, common, float(own @ other) * kept

    def _candidates(self, columns, first, last, norm, size, vectors, least) -> dict[tuple[int, int], float]:
        """Cosines of (window, query) that reach the query's threshold."""
        out: dict[tuple[int, int], float] = {}
        padding = len(self.vocabulary)
        stride = size // 4
        for i in range(0, len(first), 512):
            # Windows share quarters, which are projected once.
            begin = first[i : i + 512, None] + np.arange(4) * stride
            begin = np.where(begin < last[i : i + 512, None], begin, -1)
            quarter, where, of = np.unique(begin, return_index=True, return_inverse=True)
            stop = last[i + where // 4]
            projected = np.zeros((len(quarter), vectors.shape[1]), np.float32)
            for step in range(stride):
                place = quarter + step
                inside = (quarter >= 0) & (place < stop)
                own = np.where(inside, columns[np.minimum(place, len(columns) - 1)], padding)
                projected += self.weighted[own]
            projected = projected[of.reshape(begin.shape)].sum(axis=1)
            cosine = projected @ vectors.T / np.sqrt(np.maximum(norm[i : i + 512, None], 1e-12))
            for w, q in zip(*np.nonzero(cosine >= least), strict=True):
                out[i + int(w), int(q)] = float(cosine[w, q])
        return out

    def _holding(self, columns, begin, stop, number, queries) -> np.ndarray:
        """Whether so many words of a region are the query's that it can be confirmed."""
        used = np.zeros((len(queries), len(self.vocabulary) + 1), bool)
        for row, query in zip(used, queries, strict=True):
            row[self.vocabulary.columns(np.array(query.words, np.uint64))] = True
        needed = np.array([q.needed for q in queries])
        out = np.zeros(len(begin), bool)
        for i in range(0, len(begin), 4096):
            place = begin[i : i + 4096, None] + np.arange((stop - begin).max())
            inside = place < stop[i : i + 4096, None]
            own = np.where(inside, columns[np.minimum(place, len(columns) - 1)], len(self.vocabulary))
            rows = number[i : i + 4096]
            out[i : i + 4096] = used[rows[:, None], own].sum(axis=1) >= needed[rows]
        return out

    def _confirmed(self, hashes, columns, text, first, last, end, per_text, size, queries, found):
        if not found:
            return
        done: set[tuple[int, int]] = set()
        ordered = sorted(found.items(), key=lambda x: -x[1])
        window, number = np.array([key for key, _ in ordered]).T
        reach = size // 4 + 1
        at = text[window]
        begin = np.maximum(first[window] - reach, end[at] - per_text[at])
        stop = np.minimum(last[window] + reach, end[at])
        for i in np.flatnonzero(self._holding(columns, begin, stop, number, queries)).tolist():
            key = int(at[i]), int(number[i])
            if key in done:
                continue
            query = queries[key[1]]
            common = confirmed(query, hashes[begin[i] : stop[i]].tolist())
            if common:
                done.add(key)
                yield key[0], query, common, ordered[i][1]


def searchers(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> Iterator[list[Searcher]]:
    """Searchers that share a pass over the documents; nothing if the benchmark has no words."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(
        F.col("item_id").isNotNull() & F.col("text").isNotNull()
    )
    blocks = max(1, math.ceil(items.count() / ITEMS))
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        queries = queries_of(sorted((r.item_id, r.text) for r in own.collect()))
        queries = [q for q in queries if q.words]
        for first in range(0, len(queries), QUERIES * SPACES):
            yield _fitted(spark, docs, queries[first : first + QUERIES * SPACES])


def _fitted(spark: SparkSession, docs: DataFrame, together: list[Query]) -> list[Searcher]:
    """Searchers for the queries, their spaces fitted on every passage of the documents.

    The texts are split into words once; the matrix is stored for the passes over it.
    """
    words_ = Vocabulary(np.array([w for q in together for w in q.words], np.uint64))
    with scratch_folder(spark, "passages") as scratch:
        matrix = stored(passage_rows(docs, words_), scratch)
        frequency, total = document_frequencies(matrix, len(words_))
        rare = math.log(total + 1) + 1
        group = []
        for i in range(0, len(together), QUERIES):
            part = together[i : i + QUERIES]
            vocabulary = Vocabulary(np.array([w for q in part for w in q.words], np.uint64))
            columns = words_.columns(vocabulary.hashes)
            place = np.full(len(words_), -1, np.int32)
            place[columns] = np.arange(len(vocabulary))
            idf = np.log((total + 1) / (frequency[columns] + 1)) + 1
            space = latent_space(matrix, place, part, vocabulary, idf)
            group.append(Searcher(part, vocabulary, idf, rare, space))
    return group


def all_found(group: list[Searcher], column: pa.Array) -> Iterator[tuple[int, Query, int, float]]:
    texts = Texts(column)
    for searcher in group:
        yield from searcher.search(texts)


def benchmark_matches(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document and item found in it: ``doc_id, item_id, common_words, item_words, cosine``.

    Null and empty texts match nothing, nor do items without words; a repeated row or item id gives
    one match. Of an item cut into several queries the best match is reported. A document without
    ``doc_id`` is reported with null. Other columns are not looked at.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = spark.createDataFrame([], MATCHES)
    for group in searchers(spark, docs, benchmark):
        shared = spark.sparkContext.broadcast(group)

        def match(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for run in runs(batch):
                    rows = [
                        (at, q.item_id, common, len(q.words), cosine)
                        for at, q, common, cosine in all_found(shared.value, run.column("text"))
                    ]
                    if rows:
                        at, item, common, size, cosine = zip(*rows, strict=True)
                        yield pa.record_batch(
                            [
                                run.column("doc_id").take(pa.array(at)),
                                pa.array(item, pa.int64()),
                                pa.array(common, pa.int32()),
                                pa.array(size, pa.int32()),
                                pa.array(cosine, pa.float64()),
                            ],
                            names=["doc_id", "item_id", "common_words", "item_words", "cosine"],
                        )

        found = found.unionByName(docs.mapInArrow(match, MATCHES))
    best = F.max(F.struct("common_words", "item_words", "cosine")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def decontaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found; same columns."""
    kept = docs
    for group in searchers(spark, docs, benchmark):
        shared = spark.sparkContext.broadcast(group)

        def leave_out(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for run in runs(batch):
                    clean = np.ones(run.num_rows, bool)
                    for at, *_ in all_found(shared.value, run.column("text")):
                        clean[at] = False
                    yield run.filter(pa.array(clean))

        kept = kept.mapInArrow(leave_out, docs.schema)
    return kept
