"""Near-duplicate documents: MinHash signatures, a multi-index Hamming join, exact confirmation.

A signature has ``SLOTS`` minima of 32 bits. Two are near if at most ``SLOT_ERRORS`` slots differ.
Cut into ``CHUNKS`` chunks, two near signatures have a chunk with at most
``SLOT_ERRORS // CHUNKS`` errors (pigeonhole); a document enters the index under every choice of
the chunk's slots that such errors leave equal, so every near pair meets in a bucket. At a
similarity of 0.75 more than ``SLOT_ERRORS`` of 24 slots differ with probability 4e-7. A second,
longer sketch thins out what meets by chance; it loses a pair with probability 1e-6. What is left is
confirmed on the full shingle sets.

A document is its id and its text: rows of one id with different texts are documents of their own.
Documents with equal sets form a class and only its representative is searched. In a bucket all
members are first compared with its smallest one; after components are formed, only members of
different components are compared, in blocks, so a bucket of copies costs one pair per member, near
pairs never become rows, and no bucket is ever one task's.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.components import components
from tillroll.llm.joins import likely_rows, unlikely_rows
from tillroll.llm.textarrays import lowered, mixed, runs, signed, utf8, word_hashes, words
from tillroll.storage import stored_scratch

SHINGLE = 5
SIMILAR = 75  # per cent
SLOTS, CHUNKS, SLOT_ERRORS = 24, 6, 17
SKETCH, MISS = 96, 1e-6
# Members of a bucket that meet in one block; a larger bucket is compared block by block.
BLOCK = 1024
SIGNED = "doc_id long, text_key binary, n_shingles long, set_a long, set_b long, signature binary"

_SEEDS = mixed(np.arange(1, SLOTS + SKETCH + 1, dtype=np.uint64)) | np.uint64(1)
_STEPS = mixed(np.arange(101, 101 + SHINGLE, dtype=np.uint64)) | np.uint64(1)


def _threshold(slots: int, miss: float, similarity: float = SIMILAR / 100) -> int:
    """Smallest number of errors that a pair of that similarity exceeds with at most ``miss``."""
    tail = 0.0
    for errors in range(slots, 0, -1):
        tail += comb(slots, errors) * (1 - similarity) ** errors * similarity ** (slots - errors)
        if tail > miss:
            return errors
    return 0


SKETCH_ERRORS = _threshold(SKETCH, MISS)


def _choices() -> list[list[int]]:
    """Every set of slots that a chunk with as many errors as the pigeonhole allows leaves equal."""
    width = SLOTS // CHUNKS
    kept = width - SLOT_ERRORS // CHUNKS
    return [
        [chunk * width + i for i in slots]
        for chunk in range(CHUNKS)
        for slots in combinations(range(width), kept)
    ]


CHOICES = _choices()


def shingles(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, text after text, and how many each text has.

    Words are lower-cased in A-Z. A text of fewer than five words is one shingle, none without.
    """
    begin, end, per_text = words(data, starts)
    hashes = word_hashes(lowered(data), begin, end)
    n = len(hashes)
    if n == 0:
        return hashes, per_text
    last = np.cumsum(per_text)
    owner = np.repeat(np.arange(len(per_text)), per_text)
    left = last[owner] - np.arange(n)  # words from here to the end of the text
    first = left == per_text[owner]
    out = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        part = np.zeros(n, np.uint64)
        part[: max(n - k, 0)] = hashes[k:] * _STEPS[k]
        out += np.where(left > k, part, np.uint64(k + 1))
    keep = (left >= SHINGLE) | (first & (left < SHINGLE))
    out, owner = mixed(out[keep]), owner[keep]
    # The same shingle in another text is another value here.
    repeated = pd.Series(out + _text_salt(len(per_text))[owner]).duplicated().to_numpy()
    out, owner = out[~repeated], owner[~repeated]
    return out, np.bincount(owner, minlength=len(per_text)).astype(np.int64)


def _text_salt(n: int) -> np.ndarray:
    return mixed(np.arange(7, 7 + n, dtype=np.uint64))


def signatures(docs: DataFrame) -> DataFrame:
    """Per document: size, a 128-bit digest of its shingle set, and its signature and sketch."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch):
                found, counts = shingles(*utf8(run.column("text")))
                has = np.flatnonzero(counts)
                begin = (np.cumsum(counts) - counts)[has]
                minima = np.zeros((len(counts), len(_SEEDS)), np.uint32)
                sums = np.zeros((2, len(counts)), np.uint64)
                if len(has):
                    for k, seed in enumerate(_SEEDS):
                        least = np.minimum.reduceat(found * seed, begin)
                        minima[has, k] = least >> np.uint64(32)
                    sums[0, has] = np.add.reduceat(mixed(found), begin)
                    sums[1, has] = np.add.reduceat(mixed(found ^ _SEEDS[0]), begin)
                # 32 bits of each indexed slot, the low 8 of the sketch's minima's upper half.
                index = minima[:, :SLOTS].astype("<u4").view(np.uint8).reshape(len(counts), -1)
                sketch = (minima[:, SLOTS:] & 0xFF).astype(np.uint8)
                raw = np.concatenate([index, sketch], axis=1)
                yield pa.record_batch(
                    [
                        run.column("doc_id"),
                        run.column("text_key"),
                        counts,
                        signed(sums[0]),
                        signed(sums[1]),
                        pa.array([r.tobytes() for r in raw], pa.binary()),
                    ],
                    names=["doc_id", "text_key", "n_shingles", "set_a", "set_b", "signature"],
                )

    return docs.select("doc_id", "text", text_key().alias("text_key")).mapInArrow(sign, SIGNED)


def text_key() -> Column:
    """What tells the texts of one id apart: a digest of the text as it is, of none for a null."""
    return F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))


def texts_of(ids: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """``rep, text`` of the given representatives; texts of other documents are mostly not shuffled."""
    wanted = reps.select("rep", "doc_id", "text_key").join(ids, "rep", "left_semi")
    wanted = stored_scratch(wanted, "wanted-texts")
    rows = likely_rows(docs, wanted, "doc_id").withColumn("text_key", text_key())
    document = ["doc_id", "text_key"]
    return rows.join(wanted, document).dropDuplicates(document).select("rep", "text")


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Indexed slots and sketch of a column of signatures."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    raw = raw.reshape(len(column), 4 * SLOTS + SKETCH)
    return np.ascontiguousarray(raw[:, : 4 * SLOTS]).view("<u4"), raw[:, 4 * SLOTS :]


def buckets(reps: DataFrame) -> DataFrame:
    """``bucket, choice, rep``: each signature under every choice of slots."""

    def enumerate_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            index, _ = _unpacked(batch.column("signature"))
            rep = batch.column("rep")
            for number, slots in enumerate(CHOICES):
                key = np.full(len(index), number + 1, np.uint64)
                for slot in slots:
                    key = mixed(key * np.uint64(31) + index[:, slot])
                choice = np.full(len(index), number, np.int32)
                yield pa.record_batch([signed(key), choice, rep], names=["bucket", "choice", "rep"])

    return reps.mapInArrow(enumerate_, "bucket long, choice int, rep long")


def _near(index_a, sketch_a, n_a, index_b, sketch_b, n_b) -> np.ndarray:
    """Pairs whose sizes allow the similarity and whose signature and sketch are near."""
    near = 100 * np.minimum(n_a, n_b) >= SIMILAR * np.maximum(n_a, n_b)
    at = np.flatnonzero(near)
    at = at[(index_a[at] != index_b[at]).sum(axis=1) <= SLOT_ERRORS]
    at = at[(sketch_a[at] != sketch_b[at]).sum(axis=1) <= SKETCH_ERRORS]
    near[:] = False
    near[at] = True
    return near


def near_pairs(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Those of the pairs ``a, b`` that signature and sketch call near."""

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = _unpacked(batch.column("sa")), _unpacked(batch.column("sb"))
                n_a, n_b = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
                yield batch.select(["a", "b"]).filter(pa.array(_near(*a, n_a, *b, n_b)))

    for side in "ab":
        own = reps.select(
            F.col("rep").alias(side),
            F.col("signature").alias(f"s{side}"),
            F.col("n_shingles").alias(f"n{side}"),
        )
        pairs = pairs.join(own, side)
    return pairs.mapInArrow(thin, "a long, b long")


GROUP = ("bucket", "i", "j")


def cross_links(members: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """Links ``a, b`` between members of a bucket that are in different components.

    ``members`` are ``bucket, choice, rep, component, n_shingles, signature``. A bucket of more
    than ``BLOCK`` members is dealt into blocks and each two blocks meet in a group of their own.
    Signatures tell which members of a group have a near partner at all; only their texts are
    fetched, and pairs are confirmed inside the group: near pairs never become rows, and of the
    links that join the same components one is enough.
    """
    sizes = members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
    )
    divided = sizes.filter("low <> high").select(
        "bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")
    )
    dealt = (
        members.join(divided, "bucket")
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .drop("blocks", "other")
    )

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_groups(batches):
            active = np.zeros(len(rows), bool)
            for x, y in _near_within(rows):
                active[x] = active[y] = True
            yield from rows.filter(pa.array(active)).to_batches()

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_groups(batches):
            starts = _group_starts(rows)
            for a, b in zip(starts, np.append(starts[1:], len(rows)), strict=True):
                found = _links_of_group(rows.slice(a, b - a))
                if found:
                    x, y = zip(*found, strict=True)
                    yield pa.record_batch([np.array(x), np.array(y)], names=["a", "b"])

    def grouped(rows: DataFrame) -> DataFrame:
        return rows.repartition(*GROUP).sortWithinPartitions(*GROUP)

    active = stored_scratch(grouped(dealt).mapInArrow(pick, dealt.schema), "active")
    texts = stored_scratch(texts_of(active.select("rep").distinct(), reps, docs), "active-texts")
    return grouped(active.join(texts, "rep")).mapInArrow(confirm, "a long, b long").distinct()


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by group, cut only between groups."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([rest, rows]) if rest is not None else rows
        if not len(rows):
            continue
        last = _group_starts(rows)[-1]  # the last group may go on in the next batch
        rest = rows.slice(last)
        if last:
            yield rows.slice(0, last)
    if rest is not None and len(rest):
        yield rest


def _group_starts(rows: pa.Table) -> np.ndarray:
    keys = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in GROUP])
    change = np.ones(keys.shape[1], bool)
    change[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    return np.flatnonzero(change)


def _near_within(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of near pairs of the same group and different components.

    A pair that meets in several buckets belongs to the first choice of slots it agrees in.
    """
    starts = _group_starts(rows)
    size = np.diff(np.append(starts, len(rows)))
    left = np.repeat(starts + size, size) - np.arange(len(rows)) - 1  # rows after this one
    component, n, choice, i, j, own = (
        rows.column(c).to_numpy() for c in ("component", "n_shingles", "choice", "i", "j", "own")
    )
    index, sketch = _unpacked(rows.column("signature").combine_chunks())
    for shift in range(1, int(size.max())):
        x = np.flatnonzero(left >= shift)
        y = x + shift
        # Two blocks of a bucket meet here; pairs within one of them belong to its own group.
        on = (component[x] != component[y]) & ((i[x] == j[x]) | (own[x] != own[y]))
        x, y = x[on], y[on]
        near = _near(index[x], sketch[x], n[x], index[y], sketch[y], n[y])
        x, y = x[near], y[near]
        same = index[x] == index[y]
        agreed = np.stack([same[:, slots].all(axis=1) for slots in CHOICES], axis=1)
        first = agreed.argmax(axis=1) == choice[x]
        if first.any():
            yield x[first], y[first]


def _links_of_group(rows: pa.Table) -> list[tuple[int, int]]:
    """Confirmed links of one group that join components not yet joined here."""
    partners: dict[int, list[int]] = {}
    for x, y in _near_within(rows):
        for a, b in zip(x.tolist(), y.tolist(), strict=True):
            partners.setdefault(a, []).append(b)
    if not partners:
        return []
    found, counts = shingles(*utf8(rows.column("text").combine_chunks()))
    _, shingle = np.unique(found, return_inverse=True)
    begin = np.cumsum(counts) - counts
    rep = rows.column("rep").to_pylist()
    component = rows.column("component").to_pylist()
    root = {c: c for c in component}

    def top(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    links = []
    marked = np.zeros(int(shingle.max()) + 1, bool)
    for a, others in partners.items():
        own = shingle[begin[a] : begin[a] + counts[a]]
        marked[own] = True
        both = np.add.reduceat(marked[shingle], begin, dtype=np.int64)
        marked[own] = False
        other = np.array(others)
        linked = 100 * both[other] >= SIMILAR * (counts[a] + counts[other] - both[other])
        for b in other[linked].tolist():
            p, q = top(component[a]), top(component[b])
            if p != q:
                root[max(p, q)] = min(p, q)
                links.append((min(rep[a], rep[b]), max(rep[a], rep[b])))
    return links


def confirmed(pairs: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of the pairs ``a, b``, few per document, whose full shingle sets are similar enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch, "ta"):
                sets = []
                for side in ("ta", "tb"):
                    found, counts = shingles(*utf8(run.column(side)))
                    sets.append((found, counts, np.repeat(np.arange(len(counts)), counts)))
                salt = _text_salt(run.num_rows)
                (a, n_a, who_a), (b, n_b, who_b) = sets
                shared = np.isin(a + salt[who_a], b + salt[who_b])
                both = np.bincount(who_a[shared], minlength=run.num_rows)
                linked = (both > 0) & (100 * both >= SIMILAR * (n_a + n_b - both))
                yield run.select(["a", "b"]).filter(pa.array(linked))

    ids = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    texts = stored_scratch(texts_of(ids, reps, docs), "texts")
    for side in "ba":
        own = texts.select(F.col("rep").alias(side), F.col("text").alias(f"t{side}"))
        pairs = pairs.join(own, side)
    return pairs.select("a", "b", "ta", "tb").mapInArrow(confirm, "a long, b long")


def grouped_documents(docs: DataFrame) -> DataFrame:
    """Per row of ``doc_id, text``: ``doc_id, text_key, n_shingles, group, component_id``.

    ``group`` numbers the component, which two of equal ``component_id`` can only share a name of
    if documents share an id; it is null for rows that are linked with nothing: without id or words.
    """
    signed_ = stored_scratch(signatures(docs), "signatures")
    sets = ["set_a", "set_b", "n_shingles"]
    classes = signed_.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*sets)
    # The document of a class with the smallest id stands for it, under a number of its own.
    first = classes.agg(
        F.min(F.struct("doc_id", "text_key")).alias("least"), F.first("signature").alias("signature")
    )
    number = F.monotonically_increasing_id().alias("rep")
    reps = stored_scratch(first.select(number, *sets, "signature", "least.doc_id", "least.text_key"), "reps")
    indexed = buckets(reps)
    shared = (
        indexed.groupBy("bucket")
        .agg(F.min("rep").alias("pivot"), F.max("rep").alias("other"))
        .filter("pivot <> other")
        .select("bucket", "pivot")
    )
    indexed = stored_scratch(indexed.join(shared, "bucket"), "buckets")
    stars = indexed.filter("pivot <> rep").select(F.col("pivot").alias("a"), F.col("rep").alias("b"))
    stars = stored_scratch(near_pairs(stars.distinct(), reps), "stars")
    links = stored_scratch(confirmed(stars, reps, docs), "star-links")
    if not links.isEmpty():
        labels = stored_scratch(components(links), "star-labels")
    else:
        labels = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    members = (
        indexed.select("bucket", "choice", "rep")
        .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("component", F.coalesce("component", "rep"))
        .join(reps.select("rep", "n_shingles", "signature"), "rep")
    )
    links = stored_scratch(links.unionByName(cross_links(members, reps, docs)), "links")
    labels = stored_scratch(components(links).withColumnRenamed("node", "rep"), "labels")
    # Components are known by a representative's number; their name is the smallest id in them.
    names = labels.join(reps.select("rep", "doc_id"), "rep").groupBy("component").agg(
        F.min("doc_id").alias("name")
    )
    named = (
        reps.select(*sets, "rep", F.col("doc_id").alias("least"))
        .join(labels.join(names, "component"), "rep", "left")
        .withColumn("group", F.coalesce("component", "rep"))
        .withColumn("name", F.coalesce("name", "least"))
    )
    found = signed_.join(named.select(*sets, "group", "name"), sets, "left")
    has_id = F.col("doc_id").isNotNull()
    return found.select(
        "doc_id",
        "text_key",
        "n_shingles",
        F.when(has_id, F.col("group")).alias("group"),
        F.when(has_id, F.coalesce("name", "doc_id")).alias("component_id"),
    )


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked if 100 times the common shingles are at least 75 times all shingles of
    the two. Null and word-less texts have no shingles and are linked with nothing. A row without a
    ``doc_id`` cannot be named: it keeps a null component and is kept. Rows with the same
    ``doc_id`` are each returned; with different texts they are documents of their own. Other
    columns are not looked at.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return grouped_documents(docs).select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def one_of_each_group(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of one document of each group of near-duplicates, the one with the smallest id.

    Documents in no group stay, rows without an id among them; a document that several rows repeat
    stays once. No text is lost that is no near-duplicate of one that stays.

    Rows of an id that loses none are told by a filter of fixed size and stay where they lie; only
    the others' texts are shuffled, as far as one of their id is kept.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = stored_scratch(grouped_documents(own), "grouped").filter("doc_id IS NOT NULL")
    first = found.filter("group IS NOT NULL").groupBy("group").agg(
        F.min(F.struct("doc_id", "text_key")).alias("least")
    )
    alone = found.filter("group IS NULL").select("doc_id", "text_key")
    kept = first.select("least.doc_id", "least.text_key").unionByName(alone)
    kept = stored_scratch(kept.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(), "kept")
    # Ids with more rows than documents that are kept.
    rows = found.select(F.col("doc_id").alias("_id"), F.lit(1).alias("n"))
    rows = rows.unionByName(kept.select("_id", F.lit(-1).alias("n")))
    losing = rows.groupBy("_id").agg(F.sum("n").alias("n")).filter("n > 0").select("_id")
    losing = stored_scratch(losing, "losing-ids")
    named = docs.withColumn("_id", F.col("doc_id").cast("long")).filter("_id IS NOT NULL")
    whole = unlikely_rows(named, losing, "_id")
    others = likely_rows(likely_rows(named, losing, "_id"), kept, "_id").withColumn("_key", text_key())
    others = others.join(kept, ["_id", "_key"]).dropDuplicates(["_id", "_key"])
    parts = [whole.select(*docs.columns), others.select(*docs.columns), docs.filter("doc_id IS NULL")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
