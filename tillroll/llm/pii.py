"""Personal data: fixed base patterns, and identifiers found by bootstrapped contexts.

The base patterns find emails, IP addresses, payment cards and phone numbers. What they find are the
seeds: the words around a seed form lexical patterns. Whatever else fills such a pattern anywhere, a word or
a run of number-like words, is an instance, and counts for or against it. Spark scores the graph of
patterns and instances in rounds: a pattern is as trustworthy as the instances it surrounds, an
instance as the best trusted pattern around it; the instances that trusted patterns discover lead to
further patterns. In the end trusted patterns mark identifiers that no base pattern knows.

Each round reads the texts three times. The first pass bounds from below how many different fillers each
pattern has, by the bits they set in a small bitmap per pattern; a pattern with too many for its
trusted ones can never be trusted and goes. The second gathers all fillers of the others, the third all
places of the instances found. Tasks know what to look for from bitmaps of fixed size; exact joins
follow. Contexts are hashed; graph and places stay distributed, and every count is over all documents.
A filler is scored and marked only if it has a digit or a sign in it, and marked if most of its places
are in trusted patterns: a plain word is no identifier, but counts against its patterns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.textarrays import lowered, mixed, runs, signed, span_hashes, utf8, words
from tillroll.storage import stored_scratch

KINDS = ("email", "ip", "card", "phone")
FOUND = tuple(f"{kind}_like" for kind in KINDS)
# A pattern is trusted from this share of trusted instances and this many of them.
CONFIDENCE, SUPPORT, ROUNDS = 0.6, 3, 2
# Share of an instance's places that must be in trusted patterns.
SPECIFIC = 0.5
# Bits of the bitmaps that tell tasks what to look for: 16 million, 2 MB, whatever their number.
BITS = 24
# Words of 64 bits in which the fillers of a pattern leave their marks, and rows that a task holds.
MARKS, HELD = 4, 1 << 20

# The base patterns, written so that no text is scanned twice. A local part is
# found backwards from its "@"; an address cannot begin inside a run of digits.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# The signs that number-like words consist of, beside digits.
_NUMBER_SIGNS = np.frombuffer(b"()+.,-/;:", np.uint8)


class Span(NamedTuple):
    start: int
    order: int  # place of the kind in KINDS
    end: int


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Base spans of a text, by start and then kind; code points, end exclusive."""
    spans, free, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                spans.append(Span(start, 0, domain.end()))
                free = domain.end()
        at = text.find("@", max(at + 1, free))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            spans.append(Span(m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append(Span(m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            spans.append(Span(m.start(), 3, m.end()))
    return sorted(spans)


class Units(NamedTuple):
    """Words and runs of number-like words of several texts, without their punctuation."""

    text: np.ndarray  # place of the text
    begin: np.ndarray  # bytes
    end: np.ndarray
    instance: np.ndarray  # hash of the lower-cased spelling
    signs: np.ndarray  # has it a digit or a sign in it?
    patterns: np.ndarray  # three columns, 0 where there is no such context


def units(data: np.ndarray, starts: np.ndarray) -> Units:
    """What can fill a pattern, in order, and the patterns around each.

    Words of digits and ``_NUMBER_SIGNS`` that follow each other are one unit, however many, so
    that a number written with spaces is one. Words without a letter or digit are none. The
    patterns of a unit are the word before it, the two words before it, and the words on both sides.
    """
    begin, end, per_text = words(data, starts)
    text = np.repeat(np.arange(len(per_text)), per_text)
    low = lowered(data)
    digit = (data >= 48) & (data <= 57)
    word = digit | ((low >= 97) & (low <= 122)) | (data == 95) | (data >= 128)

    def inside(mask: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(mask))
        return total[b] - total[a]

    numeric = (inside(digit | np.isin(data, _NUMBER_SIGNS), begin, end) == end - begin) & (inside(digit, begin, end) > 0)
    last = data[end - 1] if len(end) else data[:0]
    goes_on = np.zeros(len(begin), bool)
    goes_on[:-1] = (
        numeric[:-1] & numeric[1:] & (text[:-1] == text[1:]) & (((last >= 48) & (last <= 57)) | (last == 41))[:-1]
    )
    first = np.ones(len(begin), bool)
    first[1:] = ~goes_on[:-1]
    begin, end, text, numeric = begin[first], end[~goes_on], text[first], numeric[first]
    # Punctuation on both sides goes; a plus sign or bracket in front of a number stays.
    n = len(data)
    places = np.arange(n)
    after = np.minimum.accumulate(np.where(word, places, n)[::-1])[::-1]
    before = np.maximum.accumulate(np.where(word, places, -1))
    a = after[begin] if len(begin) else begin
    real = a < end
    begin, end, text, numeric, a = begin[real], end[real], text[real], numeric[real], a[real]
    b = before[end - 1] + 1 if len(end) else end
    for _ in range(2):
        sign = numeric & (a > begin)
        sign[sign] = np.isin(data[a[sign] - 1], np.frombuffer(b"(+", np.uint8))
        a = a - sign
    signs = inside(digit | ~word, a, b) > 0
    instance = span_hashes(low, a, b)

    def beside(shift: int) -> tuple[np.ndarray, np.ndarray]:
        """The unit ``shift`` places before (or after) in the same text: its hash, and is there one?"""
        at = np.arange(len(a)) - shift
        ok = (at >= 0) & (at < len(a))
        ok[ok] = text[at[ok]] == text[ok]
        return np.where(ok, instance[np.clip(at, 0, max(len(a) - 1, 0))] if len(a) else instance, 0), ok

    (p1, has1), (p2, has2), (next_, has_next) = beside(1), beside(2), beside(-1)
    patterns = np.stack(
        [
            np.where(has1, mixed(p1 + np.uint64(1)), 0),
            np.where(has1 & has2, mixed(mixed(p2 + np.uint64(2)) ^ p1), 0),
            np.where(has1 & has_next, mixed(mixed(p1 + np.uint64(3)) ^ next_), 0),
        ],
        axis=1,
    ).astype(np.uint64)
    return Units(text, a, b, instance, signs, patterns)


def _code_points(data: np.ndarray) -> np.ndarray:
    """How many code points begin before each byte."""
    return np.append(0, np.cumsum((data & 0xC0) != 0x80))


_SEEDS = pa.list_(
    pa.struct([("rank", pa.int32()), ("instance", pa.int64()), ("patterns", pa.list_(pa.int64()))])
)
_BASE = pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())]))
_READ = (
    "doc_id long, text_key long, n_email long, n_ip long, n_card long, n_phone long,"
    "base_sha256 string, base array<struct<start: int, rank: int, end: int>>,"
    "seeds array<struct<rank: int, instance: long, patterns: array<long>>>"
)


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.order]}:{s.start}:{s.end}" for s in spans)


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, text``: what is found in a document is joined to it by the first two."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")


def read_texts(docs: DataFrame) -> DataFrame:
    """One pass over the whole texts: base spans, and seeds with the patterns around them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch):
                texts = run.column("text").fill_null("").to_pylist()
                found = [base_spans(t) for t in texts]
                counts = [[sum(s.order == k for s in spans) for spans in found] for k in range(len(KINDS))]
                digests = [hashlib.sha256(spelled(spans).encode()).hexdigest() for spans in found]
                base = [[{"start": s.start, "rank": s.order, "end": s.end} for s in spans] for spans in found]
                yield pa.record_batch(
                    [
                        run.column("doc_id"),
                        run.column("text_key"),
                        *[pa.array(c, pa.int64()) for c in counts],
                        pa.array(digests, pa.string()),
                        pa.array(base, _BASE),
                        pa.array(_seeds(run, found), _SEEDS),
                    ],
                    names=["doc_id", "text_key", *[f"n_{k}" for k in KINDS], "base_sha256", "base", "seeds"],
                )

    return stored_scratch(_keyed(docs).mapInArrow(read, _READ), "pii-read")


def _seeds(run: pa.RecordBatch, found: list[list[Span]]) -> list[list[dict]]:
    """For each base span the unit it begins in, as an instance of its kind."""
    out: list[list[dict]] = [[] for _ in found]
    if not any(found):
        return out
    data, starts = utf8(run.column("text"))
    all_units = units(data, starts)
    points = _code_points(data)
    first = np.searchsorted(all_units.text, np.arange(len(found) + 1))
    for i, spans in enumerate(found):
        own = slice(first[i], first[i + 1])
        ends = points[all_units.end[own]] - points[starts[i]]
        for span in spans:
            k = int(np.searchsorted(ends, span.start, side="right"))
            if k < len(ends):
                k += first[i]
                patterns = [int(p) for p in signed(all_units.patterns[k]) if p]
                instance = int(signed(all_units.instance[k : k + 1])[0])
                out[i].append({"rank": span.order, "instance": instance, "patterns": patterns})
    return out


_PLACES = "doc_id long, text_key long, start int, end int, instance long, slot int, pattern long"


def bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """The hashes' first ``BITS`` bits as a bitmap: at most 2 MB come to the driver."""
    at = F.shiftrightunsigned(F.col(column), 64 - BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))
    rows = hashes.groupBy(F.shiftrightunsigned(at, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    out = np.zeros(1 << (BITS - 6), np.int64)
    for row in rows.collect():
        out[row.word] = row.bits
    return out.view(np.uint64)


def _marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - BITS)
    return ((bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)


def _scan(docs: DataFrame, wanted: DataFrame, column: str, find, schema: str) -> DataFrame:
    """Rows that ``find`` makes, per task, of the units of each run of texts that fill one of the
    wanted patterns, or with ``column`` "instance" are wanted instances; and few other rows.

    ``find`` takes batches of ``(run, data, starts, units, marked)``.
    """
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, column))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[tuple]:
            for batch in batches:
                for run in runs(batch):
                    data, starts = utf8(run.column("text"))
                    own = units(data, starts)
                    hashes = own.patterns if column == "pattern" else own.instance
                    yield run, data, starts, own, (hashes != 0) & _marked(bits.value, hashes)

        yield from find(pieces())

    return _keyed(docs).mapInArrow(read, schema)


def _folded(keys: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of equal keys as one, their bits united."""
    order = np.argsort(keys, kind="stable")
    keys, bits = keys[order], bits[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.bitwise_or.reduceat(bits, first, axis=0) if len(first) else bits


def filler_bounds(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``pattern, at_least``: a lower bound of the different fillers of each wanted pattern.

    Every filler sets the bit that its hash names; there are at least as many as bits are set.
    """
    names = [f"m{i}" for i in range(MARKS)]

    def find(pieces: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        keys, bits = np.empty(0, np.uint64), np.empty((0, MARKS), np.uint64)

        def rows() -> pa.RecordBatch:
            columns = [pa.array(signed(np.ascontiguousarray(bits[:, i]))) for i in range(MARKS)]
            return pa.record_batch([pa.array(signed(keys)), *columns], names=["pattern", *names])

        for _, _, _, own, marked in pieces:
            at, slot = np.nonzero(marked)
            place = (own.instance[at] >> np.uint64(32)) % np.uint64(64 * MARKS)
            new = np.zeros((len(at), MARKS), np.uint64)
            new[np.arange(len(at)), (place >> np.uint64(6)).astype(np.int64)] = np.uint64(1) << (place & np.uint64(63))
            folded, marks = _folded(own.patterns[at, slot], new)
            keys, bits = _folded(np.append(keys, folded), np.concatenate([bits, marks]))
            if len(keys) > HELD:
                yield rows()
                keys, bits = keys[:0], bits[:0]
        yield rows()

    schema = ", ".join(f"{c} long" for c in ("pattern", *names))
    found = _scan(docs, wanted, "pattern", find, schema).groupBy("pattern").agg(*[F.bit_or(c).alias(c) for c in names])
    at_least = sum((F.bit_count(c) for c in names), F.lit(0))
    return found.select("pattern", at_least.alias("at_least")).join(wanted, "pattern", "left_semi")


def filler_edges(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``pattern, instance, signs``, once each: everything that fills the wanted patterns."""

    def find(pieces: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def rows() -> pa.RecordBatch:
            pattern, instance, signs = (np.concatenate([h[i] for h in held]) for i in range(3))
            order = np.lexsort((instance, pattern))
            pattern, instance, signs = pattern[order], instance[order], signs[order]
            new = np.ones(len(pattern), bool)
            new[1:] = (pattern[1:] != pattern[:-1]) | (instance[1:] != instance[:-1])
            columns = [pa.array(signed(pattern[new])), pa.array(signed(instance[new])), pa.array(signs[new])]
            return pa.record_batch(columns, names=["pattern", "instance", "signs"])

        for _, _, _, own, marked in pieces:
            at, slot = np.nonzero(marked)
            held.append((own.patterns[at, slot], own.instance[at], own.signs[at]))
            size += len(at)
            if size > HELD:
                yield rows()
                held, size = [], 0
        if held:
            yield rows()

    found = _scan(docs, wanted, "pattern", find, "pattern long, instance long, signs boolean")
    return found.join(wanted, "pattern", "left_semi").distinct()


def sightings(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """All places of the wanted instances: a row for each (slot -1) and one per pattern around it."""
    names = [c.split()[0] for c in _PLACES.split(", ")]

    def find(pieces: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        for run, data, starts, own, marked in pieces:
            hit = np.flatnonzero(marked)
            k, slot = np.nonzero(own.patterns[hit])
            at, slot = np.append(hit, hit[k]), np.append(np.full(len(hit), -1), slot)
            points = _code_points(data)
            origin = points[starts[own.text[at]]]
            pattern = np.where(slot >= 0, own.patterns[at, slot], np.uint64(0))
            where = pa.array(own.text[at])
            yield pa.record_batch(
                [
                    run.column("doc_id").take(where),
                    run.column("text_key").take(where),
                    pa.array((points[own.begin[at]] - origin).astype(np.int32)),
                    pa.array((points[own.end[at]] - origin).astype(np.int32)),
                    pa.array(signed(own.instance[at])),
                    pa.array(slot.astype(np.int32)),
                    pa.array(signed(pattern)),
                ],
                names=names,
            )

    return _scan(docs, wanted, "instance", find, _PLACES).join(wanted, "instance", "left_semi")


def trusted_patterns(edges: DataFrame, scores: DataFrame) -> DataFrame:
    """``pattern, rank, confidence`` of trusted patterns: one round of scoring.

    ``edges`` are ``pattern, instance``, once each, with all instances of a pattern; ``scores`` are
    ``instance, rank, score``. A pattern's confidence in a kind is the sum of its instances'
    scores over the number of all its instances plus one. Sums are combined before their shuffle.
    """
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("size"))
    summed = edges.join(scores, "instance").groupBy("pattern", "rank").agg(
        F.sum("score").alias("total"), F.count(F.lit(1)).alias("support")
    )
    confidence = F.col("total") / (F.col("size") + 1)
    found = summed.join(sizes, "pattern").withColumn("confidence", confidence)
    found = found.filter((F.col("confidence") >= CONFIDENCE) & (F.col("support") >= SUPPORT))
    return found.select("pattern", "rank", "confidence")


def _candidates(docs: DataFrame, edges: DataFrame, scores: DataFrame) -> DataFrame:
    """``pattern``: those that can be trusted at all, by their scored instances and by how many
    fillers they have at least."""
    summed = edges.join(scores, "instance").groupBy("pattern", "rank").agg(
        F.sum("score").alias("total"), F.count(F.lit(1)).alias("support")
    )
    enough = summed.filter(F.col("support") >= SUPPORT).groupBy("pattern").agg(F.max("total").alias("total"))
    enough = stored_scratch(enough, "supported-patterns")
    if enough.isEmpty():
        return enough.select("pattern")
    bounds = filler_bounds(docs, enough.select("pattern"))
    return enough.join(bounds, "pattern").filter(
        F.col("total") >= CONFIDENCE * (F.col("at_least") + 1)
    ).select("pattern")


def discovered(docs: DataFrame, read: DataFrame) -> DataFrame:
    """``doc_id, text_key, found``: spans that trusted patterns mark, of documents that have any."""
    seeds = read.select(F.explode("seeds").alias("s")).select("s.rank", "s.instance", "s.patterns")
    known = stored_scratch(
        seeds.select("instance", "rank").distinct().withColumn("score", F.lit(1.0)), "seeds"
    )
    scores = known
    around = seeds.select(F.explode("patterns").alias("pattern"), "instance").distinct()
    graph: list[DataFrame] = []
    seen: list[DataFrame] = []
    wanted = stored_scratch(_candidates(docs, around, scores), "patterns")
    trusted = None
    for _ in range(ROUNDS):
        if wanted.isEmpty():
            break
        graph.append(stored_scratch(filler_edges(docs, wanted), "pattern-graph"))
        edges = _union(graph)
        trusted = stored_scratch(trusted_patterns(edges, scores), "trusted")
        reached = (
            edges.filter("signs").join(trusted, "pattern").groupBy("instance", "rank").agg(F.max("confidence").alias("score"))
        )
        old = scores
        scores = known.unionByName(reached).groupBy("instance", "rank").agg(F.max("score").alias("score"))
        scores = stored_scratch(scores, "scores")
        new = scores.join(old.select("instance").distinct(), "instance", "left_anti").select("instance").distinct()
        new = stored_scratch(new, "new-instances")
        if new.isEmpty():
            break
        seen.append(stored_scratch(sightings(docs, new), "sightings"))
        # Patterns around what was found, beyond those that were looked at already.
        more = _union([s.filter("slot >= 0").select("pattern", "instance") for s in seen]).unionByName(around).distinct()
        more = more.join(edges.select("pattern").distinct(), "pattern", "left_anti")
        wanted = stored_scratch(_candidates(docs, more, scores), "patterns")
    if trusted is None or not seen:
        return read.select("doc_id", "text_key", F.col("base").alias("found")).limit(0)
    place = ["doc_id", "text_key", "start", "end", "instance"]
    best = (
        _union(seen)
        .filter("slot >= 0")
        .join(trusted, "pattern")
        .groupBy(*place)
        .agg(F.max(F.struct("confidence", F.negative("rank").alias("back"))).alias("best"))
        .withColumn("rank", F.negative(F.col("best.back")))
    )
    best = stored_scratch(best.select(*place, "rank"), "trusted-places")
    inside = best.groupBy("instance").agg(F.count(F.lit(1)).alias("inside"))
    everywhere = (
        _union(seen).filter("slot < 0").select(*place).distinct().groupBy("instance").agg(F.count(F.lit(1)).alias("n"))
    )
    specific = inside.join(everywhere, "instance").filter(F.col("inside") >= SPECIFIC * F.col("n"))
    span = F.struct("start", (F.col("rank") + len(KINDS)).cast("int").alias("rank"), "end")
    found = best.join(specific.select("instance"), "instance", "left_semi").groupBy("doc_id", "text_key").agg(
        F.collect_list(span).alias("found")
    )
    # A base span stays what it is: nothing found may overlap one.
    base = read.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "base").dropDuplicates(["id", "key"])
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key"))
    free = F.filter(
        "found", lambda f: ~F.exists("base", lambda b: (b["start"] < f["end"]) & (f["start"] < b["end"]))
    )
    found = found.join(base, same).select("doc_id", "text_key", free.alias("found"))
    return found.filter(F.size("found") > 0)


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def _names() -> Column:
    return F.array(*[F.lit(k) for k in (*KINDS, *FOUND)])


def _with_found(rows: DataFrame, docs: DataFrame, read: DataFrame) -> DataFrame:
    """``rows`` of ``doc_id, text_key`` with ``_pii_found``, null where nothing was found."""
    found = discovered(docs, read).select(
        F.col("doc_id").alias("_pii_id"), F.col("text_key").alias("_pii_key"), F.col("found").alias("_pii_found")
    )
    found = stored_scratch(found, "pii-found")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_pii_id")) & (F.col("_text_key") == F.col("_pii_key"))
    return rows.join(found, same, "left").drop("_pii_id", "_pii_key")


def personal_data(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, counts and digest of base spans, and all ``spans``.

    A null text is empty and has no spans. Repeated rows are each returned; a null ``doc_id``
    stays null. Found spans are named after the kind whose contexts they share, as
    ``phone_like``. Equal starts are in the order of ``KINDS``. Other columns are not looked at.
    """
    read = read_texts(docs)
    rows = _with_found(read.withColumnRenamed("text_key", "_text_key"), docs, read)
    none = F.array().cast("array<struct<start: int, rank: int, end: int>>")
    spans = F.array_sort(F.concat("base", F.coalesce("_pii_found", none)))
    text = F.transform(
        spans, lambda s: F.concat_ws(":", F.get(_names(), s["rank"]), s["start"], s["end"])
    )
    counts = [f"n_{k}" for k in KINDS]
    return rows.select("doc_id", *counts, "base_sha256", F.array_join(text, ",").alias("spans"))


def redacted(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind, as ``<EMAIL>``; same columns.

    ``n_chars``, if there, becomes the new text's number of code points. Null texts stay null.
    """
    read = read_texts(docs)
    kept = docs.columns
    joined = _with_found(docs.withColumn("_text_key", F.xxhash64("text")), docs, read).drop("_text_key")
    has_length = "n_chars" in kept
    schema = docs.schema

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*KINDS, *FOUND]
        for batch in batches:
            texts = []
            marks = batch.column("_pii_found").to_pylist()
            for text, found_ in zip(batch.column("text").to_pylist(), marks, strict=True):
                if text is not None:
                    spans = base_spans(text)
                    spans += [Span(s["start"], s["rank"], s["end"]) for s in found_ or ()]
                    out, at = [], 0
                    for s in sorted(spans):
                        if s.start >= at:
                            out += [text[at : s.start], f"<{names[s.order].upper()}>"]
                        at = max(at, s.end)
                    text = "".join([*out, text[at:]])
                texts.append(text)
            columns = {c: batch.column(c) for c in kept}
            columns["text"] = pa.array(texts, pa.string())
            if has_length:
                lengths = pa.array([None if t is None else len(t) for t in texts])
                columns["n_chars"] = lengths.cast(batch.schema.field("n_chars").type)
            yield pa.record_batch(list(columns.values()), names=kept)

    return joined.mapInArrow(replace, schema)
