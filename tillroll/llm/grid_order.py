"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors with a cosine of at least c are at most sqrt(2 - 2c) apart, and so are their projections
on the leading principal dimensions. Vectors of a label are sorted by their grid cells on these
dimensions, cell width that distance; Spark's range partitioning makes the order a distributed
sequence, and stretches of it become blocks with their bounds. Blocks meet only if their cells on the
first dimension touch and their bounds are near; two blocks are joined by halving, skipping
halves that are provably distant. What is left is compared in double precision.

Equal vectors of a label form a class and meet once. A block pair returns a number and a link to the
smallest reachable vector per vector, never its pairs, so a dense group costs rows in
proportion to its blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.components import components
from tillroll.storage import stored_scratch

COSINE = 0.98
EPSILON = math.sqrt(2 - 2 * COSINE) * (1 + 1e-9) + 1e-12
# Principal dimensions come from about this many vectors; they only decide what can be skipped.
SAMPLE, LEADING = 20_000, 8
BLOCK, LEAF = 512, 64
# Neighbouring blocks that are sent together.
TILE = 16
_NAMED = "label long, dim int, rep long, size long"


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, vector`` (doubles) of rows that can be linked at all, one per ``vec_id``."""
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    rows = rows.filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
    )
    return rows.filter(finite & F.exists("vector", lambda x: x != 0.0))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that neither huge nor tiny components overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def principal(reps: DataFrame) -> dict[int, np.ndarray]:
    """Leading principal dimensions, by the vectors' length, of a bounded sample."""
    total = reps.count()
    share = min(1.0, SAMPLE / max(total, 1))
    place = F.pmod(F.xxhash64("rep", F.lit(2)), F.lit(1_000_000))
    sample = reps.filter(place < int(1_000_000 * share)).select("dim", "vector").toPandas()
    out = {}
    for dim, rows in sample.groupby("dim")["vector"]:
        found = unit(np.array(rows.tolist(), np.float64))
        _, _, axes = np.linalg.svd(found - found.mean(axis=0), full_matrices=False)
        out[int(dim)] = axes[:LEADING].T
    return out


def _projected(vectors: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    """Coordinates on the leading dimensions, 0 beyond what the vectors have."""
    dim = vectors.shape[1]
    own = axes.get(dim)
    found = vectors[:, :LEADING] if own is None else vectors @ own
    out = np.zeros((len(vectors), LEADING))
    out[:, : found.shape[1]] = found
    return out


def blocks(reps: DataFrame, axes: dict[int, np.ndarray]) -> DataFrame:
    """Stretches of the grid order: ids, sizes, vectors and bounds of up to ``BLOCK`` vectors."""
    cells = [f"c{i}" for i in range(LEADING)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                flat = part.column("vector").flatten().to_numpy().reshape(-1, dim)
                cell = np.floor(_projected(unit(flat), axes) / EPSILON).astype(np.int32)
                yield pa.record_batch(
                    [*part.columns, *[pa.array(c) for c in cell.T]],
                    names=[*part.schema.names, *cells],
                )

    schema = f"{_NAMED}, vector array<double>, " + ", ".join(f"{c} int" for c in cells)
    order = ["label", "dim", *cells, "rep"]
    ordered = (
        reps.select("label", "dim", "rep", "size", "vector")
        .mapInArrow(place, schema)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, rest = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            rows = pa.Table.from_batches([batch.select(["label", "dim", "rep", "size", "vector"])])
            rest = rows if rest is None else pa.concat_tables([rest, rows])
            while rest is not None and len(rest) > BLOCK:
                head = _one_key(rest.slice(0, BLOCK))
                yield _block(head, (part << 32) | number, axes)
                rest, number = rest.slice(len(head)), number + 1
        while rest is not None and len(rest):
            head = _one_key(rest.slice(0, BLOCK))
            yield _block(head, (part << 32) | number, axes)
            rest, number = rest.slice(len(head)), number + 1

    return stored_scratch(ordered.mapInArrow(cut, _BLOCK_SCHEMA), "blocks")


_BLOCK_SCHEMA = (
    "block long, label long, dim int, reps binary, sizes binary, vectors binary,"
    "low array<double>, high array<double>"
)


def _one_key(rows: pa.Table) -> pa.Table:
    """The first rows that share label and length."""
    label, dim = rows.column("label").to_numpy(), rows.column("dim").to_numpy()
    other = np.flatnonzero((label != label[0]) | (dim != dim[0]))
    return rows.slice(0, int(other[0])) if len(other) else rows


def _block(rows: pa.Table, number: int, axes: dict[int, np.ndarray]) -> pa.RecordBatch:
    dim = rows.column("dim")[0].as_py()
    flat = rows.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, dim)
    found = unit(flat)
    at = _projected(found, axes)
    return pa.record_batch(
        [
            pa.array([number], pa.int64()),
            pa.array([rows.column("label")[0].as_py()], pa.int64()),
            pa.array([dim], pa.int32()),
            pa.array([rows.column("rep").to_numpy().tobytes()], pa.binary()),
            pa.array([rows.column("size").to_numpy().tobytes()], pa.binary()),
            pa.array([found.tobytes()], pa.binary()),
            pa.array([at.min(axis=0).tolist()], pa.list_(pa.float64())),
            pa.array([at.max(axis=0).tolist()], pa.list_(pa.float64())),
        ],
        names=["block", "label", "dim", "reps", "sizes", "vectors", "low", "high"],
    )


def block_pairs(found: DataFrame) -> DataFrame:
    """``a, b`` (a <= b): blocks of a label that may hold vectors within the distance."""
    bounds = found.select("block", "label", "dim", "low", "high")

    def cell(name: str) -> F.Column:
        return F.floor(F.get(name, F.lit(0)) / EPSILON)

    def side(name: str, reach: int) -> DataFrame:
        return bounds.select(
            "label",
            "dim",
            F.explode(F.sequence(cell("low"), cell("high") + reach)).alias("cell"),
            F.col("block").alias(name),
            F.col("low").alias(f"low_{name}"),
            F.col("high").alias(f"high_{name}"),
        )

    # Within the distance, two vectors are in the same or in neighbouring cells; reaching one
    # cell up from either side meets both orders of the pair.
    met = side("a", 1).join(side("b", 1), ["label", "dim", "cell"]).filter("a <= b")
    gaps = F.zip_with("low_a", "high_b", lambda x, y: F.greatest(x - y, F.lit(0.0)))
    back = F.zip_with("low_b", "high_a", lambda x, y: F.greatest(x - y, F.lit(0.0)))
    squares = F.aggregate(
        F.zip_with(gaps, back, lambda x, y: x * x + y * y), F.lit(0.0), lambda s, x: s + x
    )
    return met.filter(squares <= EPSILON * EPSILON).select("a", "b").distinct()


def _near_mask(a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> np.ndarray:
    """Which vectors of two stretches are linked, by halving and skipping distant halves."""
    out = np.zeros((len(a), len(b)), bool)

    def join(i: int, j: int, k: int, m: int) -> None:
        x, y = at_a[i:j], at_b[k:m]
        gap = np.maximum(x.min(axis=0) - y.max(axis=0), y.min(axis=0) - x.max(axis=0))
        if (np.maximum(gap, 0) ** 2).sum() > EPSILON * EPSILON:
            return
        if j - i <= LEAF and m - k <= LEAF:
            out[i:j, k:m] = a[i:j] @ b[k:m].T >= COSINE
        elif j - i >= m - k:
            middle = (i + j) // 2
            join(i, middle, k, m)
            join(middle, j, k, m)
        else:
            middle = (k + m) // 2
            join(i, j, k, middle)
            join(i, j, middle, m)

    join(0, len(a), 0, len(b))
    return out


def _smallest_linked(linked: np.ndarray, reps: np.ndarray) -> np.ndarray:
    """For each vector, the smallest id it reaches by the links of this matrix (symmetric)."""
    found = reps.copy()
    places = [np.flatnonzero(row) for row in linked]
    while True:
        before = found.copy()
        for i, near in enumerate(places):
            if len(near):
                found[i] = min(found[i], found[near].min())
        if (found == before).all():
            return found


def link_blocks(found: DataFrame, axes: dict[int, np.ndarray]) -> DataFrame:
    """``rep, reach, n``: per block pair and vector the linked vectors and the smallest reached.

    Pairs are compared tile by tile: ``TILE`` neighbouring blocks of the grid order against as many
    others. A block is sent to a tile pair once, however many partners it has there.
    """

    def unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        reps, sizes = (np.frombuffer(row[c], np.int64) for c in ("reps", "sizes"))
        own = np.frombuffer(row["vectors"], np.float64).reshape(len(reps), -1)
        return reps, sizes, own, _projected(own, axes)

    def compare(held: dict[int, tuple], pairs: list[dict]) -> Iterator[pa.RecordBatch]:
        for pair in pairs:
            same = pair["a"] == pair["b"]
            reps, sizes, a, at_a = held[pair["a"]]
            other, other_sizes, b, at_b = held[pair["b"]]
            linked = _near_mask(a, b, at_a, at_b)
            if same:
                np.fill_diagonal(linked, False)
                linked |= linked.T  # rounding may differ with the order of the factors
                names, count, both = reps, linked @ sizes, linked
            else:
                names = np.concatenate([reps, other])
                count = np.concatenate([linked @ other_sizes, linked.T @ sizes])
                both = np.block(
                    [
                        [np.zeros((len(reps),) * 2, bool), linked],
                        [linked.T, np.zeros((len(other),) * 2, bool)],
                    ]
                )
            some = np.flatnonzero(count)
            if len(some):
                both, names = both[np.ix_(some, some)], names[some]
                yield pa.record_batch(
                    [names, _smallest_linked(both, names), count[some].astype(np.int64)],
                    names=["rep", "reach", "n"],
                )

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, pairs = None, {}, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if (row["ta"], row["tb"]) != key:
                    yield from compare(held, pairs)
                    key, held, pairs = (row["ta"], row["tb"]), {}, row["pairs"]
                held[row["block"]] = unpack(row)
        yield from compare(held, pairs)

    pairs = block_pairs(found)
    tile = [F.floor(F.col(c) / TILE).cast("long").alias(f"t{c}") for c in "ab"]
    pairs = stored_scratch(pairs.select("a", "b", *tile), "block-pairs")
    # At most TILE * TILE pairs, of ids only, go with every block of a tile pair.
    lists = pairs.groupBy("ta", "tb").agg(F.collect_list(F.struct("a", "b")).alias("pairs"))
    needed = pairs.select("ta", "tb", F.explode(F.array("a", "b")).alias("block")).distinct()
    rows = needed.join(lists, ["ta", "tb"]).join(found.select("block", "reps", "sizes", "vectors"), "block")
    rows = rows.repartition("ta", "tb").sortWithinPartitions("ta", "tb", "block")
    return rows.mapInArrow(tiles, "rep long, reach long, n long")


def near_vectors(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """Per row: ``vec_id, n_links, component_id, kept``.

    Vectors of the same label and length are linked at a cosine of 0.98. A null label, vector or
    component, a component that is not finite, and a zero vector link with nothing. Repeated
    rows are each returned and count as one vector; of different rows with one ``vec_id`` the first
    by content counts. A null ``vec_id`` has no links, a null component, and is kept. Other columns
    are not looked at.
    """
    rows = valid_vectors(vectors)
    digest = [F.xxhash64("vector", F.lit(i)).alias(f"d{i}") for i in (1, 2)]
    named = rows.select("vec_id", F.struct("label", F.size("vector").alias("dim"), *digest).alias("key"))
    named = stored_scratch(named.groupBy("vec_id").agg(F.min("key").alias("key")), "vector-keys")
    classes = stored_scratch(
        named.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("size")),
        "vector-classes",
    )
    own = F.struct("label", F.size("vector").alias("dim"), *digest)
    reps = rows.withColumn("key", own).join(
        classes.withColumnRenamed("rep", "vec_id"), ["vec_id", "key"]
    )
    reps = reps.dropDuplicates(["vec_id"]).select(
        "label", F.size("vector").alias("dim"), F.col("vec_id").alias("rep"), "size", "vector"
    )
    reps = stored_scratch(reps, "vector-reps")
    axes = principal(reps)
    met = stored_scratch(link_blocks(blocks(reps, axes), axes), "vector-links")
    counts = met.groupBy("rep").agg(F.sum("n").alias("n"))
    links = met.select(F.col("rep").alias("a"), F.col("reach").alias("b"))
    by_rep = (
        classes.join(counts, "rep", "left")
        .join(components(links).withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "key",
            (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    by_id = named.join(by_rep, "key").select("vec_id", "n_links", "component_id")
    out = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(by_id, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
