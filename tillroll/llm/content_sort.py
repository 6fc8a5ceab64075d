"""Exact duplicates by content sort: range-partitioned texts, sorted, neighbours compared in full.

Spark draws splitters from a sample of the rows and range-partitions the normalised texts by their
leading code points, then by digest, so that texts with a common passage in front are split too; rows
of one text follow each other by length and id, and a group of copies larger than a task's share goes
on in the next task. Spark sorts every partition externally. A task then walks over its rows
once and compares each normalised text with the one before it, byte by byte. The runs of equal texts
that meet at partition edges are joined to groups from one row per edge; texts of edges are compared
in full as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.storage import stored_scratch

# The characters that normalising deletes.
BLANKS = " \t\n\x0b\x0c\r"
# Leading code points of a text that order it before its digest does: splitters stay small.
LEAD = 32
# Rows of an unfinished run that a task holds back at most (ids only, no texts).
HELD_BACK = 100_000

_WALKED = (
    "doc_id long, digest binary, first boolean, size long, keep_id long, part int, run long, "
    "summary boolean, last boolean, edge string"
)


def in_content_order(docs: DataFrame) -> DataFrame:
    """``doc_id, norm, digest``, range-partitioned and sorted so that equal texts are adjacent.

    Of equal texts, the longest original comes first, then the smallest id (a missing id last).
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    norm = F.translate(text, BLANKS, "")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        norm.alias("norm"),
        F.unhex(F.sha2(norm, 256)).alias("digest"),
        F.char_length(text).alias("n_chars"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("lead", F.substring("norm", 1, LEAD))
    # ``row`` splits even the copies of one id.
    order = ["lead", "digest", F.desc("n_chars"), F.asc_nulls_last("doc_id"), "row"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.select("doc_id", "norm", "digest")


class _Walk:
    """One task's pass over its sorted rows; makes the rows and run summaries to return."""

    def __init__(self, part: int, held_back: int) -> None:
        self._part, self._limit = part, held_back
        self._run = -1  # number of the open run
        self._size = 0  # its rows so far
        self._open = False  # are its rows given out already, without a size?
        self._held: list[pa.RecordBatch] = []
        self._n_held = 0
        self._keep: int | None = None  # id of its first row
        self._text: str | None = None
        self._edge: str | None = None  # its text, if it is the partition's first run

    def batch(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n = batch.num_rows
        if n == 0:
            return
        norm = batch.column("norm")
        same = np.zeros(n, bool)
        same[0] = norm[0].as_py() == self._text
        same[1:] = pc.equal(norm.slice(1), norm.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(~same)
        ids, digests = batch.column("doc_id"), batch.column("digest")
        if len(starts) == 0 or starts[0] > 0:  # rows that go on with the open run
            yield from self._hold(ids, digests, 0, int(starts[0]) if len(starts) else n)
        if len(starts):
            yield from self._close()
            if len(starts) > 1:
                a, b = int(starts[0]), int(starts[-1])
                if self._run < 0:  # the partition's first run may go on from the one before
                    b = int(starts[1])
                    yield from self._begin(norm, ids, digests, a, b)
                    yield from self._close()
                    a, b = b, int(starts[-1])
                if a < b:
                    yield self._whole(ids, digests, starts[(starts >= a) & (starts < b)], a, b)
            yield from self._begin(norm, ids, digests, int(starts[-1]), n)
        self._text = norm[n - 1].as_py()

    def end(self) -> Iterator[pa.RecordBatch]:
        """The last run may go on in the next partition."""
        if self._run >= 0:
            yield from self._give_out()
            yield self._summary(True, self._text)

    def _begin(self, norm, ids, digests, a: int, b: int) -> Iterator[pa.RecordBatch]:
        self._run += 1
        self._size, self._keep = 0, ids[a].as_py()
        self._open = self._run == 0
        self._edge = norm[a].as_py() if self._run == 0 else None
        yield from self._hold(ids, digests, a, b, True)

    def _hold(self, ids, digests, a: int, b: int, begins: bool = False) -> Iterator[pa.RecordBatch]:
        first = np.zeros(b - a, bool)
        first[0] = begins
        # Copied, so that the batch with its texts can go.
        rows = pa.record_batch(
            [pa.concat_arrays([ids.slice(a, b - a)]), pa.concat_arrays([digests.slice(a, b - a)]), first],
            names=["doc_id", "digest", "first"],
        )
        self._held.append(rows)
        self._n_held += b - a
        self._size += b - a
        if self._open or self._n_held > self._limit:
            self._open = True
            yield from self._give_out()

    def _close(self) -> Iterator[pa.RecordBatch]:
        if self._run < 0:
            return
        if self._open:
            yield from self._give_out()
            yield self._summary(False, self._edge)
        else:
            yield from self._give_out(self._size)

    def _give_out(self, size: int | None = None) -> Iterator[pa.RecordBatch]:
        for rows in self._held:
            n = rows.num_rows
            yield self._rows(
                *rows.columns,
                pa.array([size] * n, pa.int64()),
                pa.array([self._keep] * n, pa.int64()),
                np.full(n, self._run, np.int64),
            )
        self._held, self._n_held = [], 0

    def _whole(self, ids, digests, starts: np.ndarray, a: int, b: int) -> pa.RecordBatch:
        """Runs that begin and end within a batch."""
        sizes = np.diff(np.append(starts, b))
        first = np.zeros(b - a, bool)
        first[starts - a] = True
        runs = self._run + 1 + np.repeat(np.arange(len(starts)), sizes)
        self._run += len(starts)
        keep = ids.take(pa.array(np.repeat(starts, sizes)))
        size = pa.array(np.repeat(sizes, sizes), pa.int64())
        return self._rows(ids.slice(a, b - a), digests.slice(a, b - a), pa.array(first), size, keep, runs)

    def _rows(self, ids, digests, first, size, keep, runs) -> pa.RecordBatch:
        n = len(ids)
        no = pa.array(np.zeros(n, bool))
        part = pa.array(np.full(n, self._part, np.int32))
        columns = [ids, digests, first, size, keep, part, pa.array(runs, pa.int64()), no, no]
        return pa.record_batch([*columns, pa.nulls(n, pa.string())], names=_names())

    def _summary(self, last: bool, edge: str | None) -> pa.RecordBatch:
        values = [None, None, None, self._size, self._keep, self._part, self._run, True, last, edge]
        types = [
            pa.int64(), pa.binary(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int64(),
            pa.bool_(), pa.bool_(), pa.string(),
        ]
        arrays = [pa.array([v], t) for v, t in zip(values, types, strict=True)]
        return pa.record_batch(arrays, names=_names())


def _names() -> list[str]:
    return [c.split()[0] for c in _WALKED.split(", ")]


def _walked(ordered: DataFrame, held_back: int) -> DataFrame:
    """Rows with their run, its size and first id where the task knows both; summaries of the
    other runs: those at a partition's edges, and those with more than ``held_back`` rows."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Walk(TaskContext.get().partitionId(), held_back)
        for batch in batches:
            yield from state.batch(batch)
        yield from state.end()

    return ordered.mapInArrow(walk, _WALKED)


def _open_groups(walked: DataFrame) -> DataFrame:
    """``part, run, opens, total, keep``: the summed runs, joined over partition edges.

    There are at most two rows per partition and one per ``HELD_BACK`` documents, so windows over
    all of them are light; texts of edges are joined pairwise, not brought together.
    """
    runs = walked.filter("summary").select("part", "run", "size", "keep_id", "last")
    edges = walked.filter("summary AND edge IS NOT NULL")
    heads = edges.filter("run = 0").select("part", F.col("edge").alias("head"))
    tails = edges.filter("last").select(F.col("part").alias("before"), F.col("edge").alias("tail"))
    in_order = Window.orderBy("part")
    parts = runs.filter("run = 0").select("part", F.lag("part").over(in_order).alias("before"))
    goes_on = (
        parts.join(heads, "part").join(tails, "before").filter("head = tail").select("part", F.lit(0).alias("run"))
    ).withColumn("goes_on", F.lit(True))
    runs = runs.join(goes_on, ["part", "run"], "left").withColumn("opens", F.col("goes_on").isNull())
    so_far = Window.orderBy("part", "run").rowsBetween(Window.unboundedPreceding, 0)
    opener = F.when(F.col("opens"), F.struct("part", "run"))
    runs = runs.withColumn("group", F.last(opener, ignorenulls=True).over(so_far))
    whole = Window.partitionBy("group")
    # The group's first run is the one that opens it; its first row stays.
    return runs.select(
        "part",
        "run",
        "opens",
        F.sum("size").over(whole).alias("total"),
        F.max(F.when(F.col("opens"), F.col("keep_id"))).over(whole).alias("keep"),
    )


def exact_duplicates(spark: SparkSession, docs: DataFrame, held_back: int = HELD_BACK) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal if nothing but the white space of ``BLANKS`` tells them apart; a null text is
    empty, and empty texts are equal. Of equal texts the row with most code points stays, then the
    one with the smallest id; rows without an id come last, and of rows equal in both one stays.
    Repeated rows count as rows. No rows give no rows. Other columns are not looked at.
    """
    walked = stored_scratch(_walked(in_content_order(docs), held_back), "content-sort")
    rows = walked.filter("NOT summary").select("doc_id", "digest", "first", "size", "keep_id", "part", "run")
    groups = stored_scratch(_open_groups(walked), "open-groups")
    # At most two rows per task and one per HELD_BACK documents.
    rows = rows.join(F.broadcast(groups), ["part", "run"], "left")
    known = F.col("size").isNotNull()
    return rows.select(
        "doc_id",
        F.when(known, F.col("keep_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("size", "total").alias("group_size"),
        (F.col("first") & (known | F.coalesce("opens", F.lit(False)))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
