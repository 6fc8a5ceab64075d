"""Source divergence audit over a vocabulary held in minimal acyclic transducers.

Terms in enough documents of a language are sorted by range partitions; each task builds transducers
of neighbouring terms, whose ordinals continue from shard to shard by prefix sums. All texts then
stream through the transducers of their language, which recount the kept terms by ordinal. Vocabularies
larger than ``BLOCK_BYTES`` go through in several passes, each with as many shards as fit. Ordinals
stand for terms from there on, and break ties: their order is the terms' byte order.

Shares are whole numbers, so is the divergence of two of them; sums over all terms start from the
divergence of the shares of absent terms, and only terms that one of two sources has are summed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.textarrays import lowered, runs, spans, utf8
from tillroll.llm.transducer import LEAD, Transducer, Walker, build
from tillroll.storage import stored_scratch

# Documents a term needs, the scale of shares, what is added to every count, ranks
# reported of a source's terms. A term is a run of letters A-Z, a-z and of all code points from 128.
MIN_DOCS = 10
SCALE, ADDED = 1_000_000_000, 2
TOP = 10

SHARD_TERMS = 1 << 16  # terms of a transducer; more only if they share their first bytes
BLOCK_BYTES = 64 << 20  # transducers that a pass over the texts holds, as arrays in memory
HELD_COUNTS = 1 << 20  # counts a task collects before it hands them on
ORDINALS = 4096  # ordinals and sources compared in one task
SOURCES = 64

_SHARD = (
    "lang string, lead binary, n_terms long, terms array<string>, n_states long, n_arcs long, "
    + ", ".join(f"{name} binary" for name in Transducer.TYPES)
)
_COUNTED = "lang string, source string, ord long, n long"


def _documents(docs: DataFrame) -> DataFrame:
    names = ("text", "lang", "source")
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in names])


def _letters(data: np.ndarray) -> np.ndarray:
    return ((data >= 97) & (data <= 122)) | (data >= 128)


def _document_counts(run: pa.RecordBatch) -> pa.Table:
    """``lang, term, n``: how many of a run's documents hold each term."""
    data, starts = utf8(run.column("text"))
    data = lowered(data)
    inside = _letters(data)
    begin, end, per_text = spans(inside, starts)
    # Terms are all letters there are, so the letters on end are the terms on end.
    offsets = np.append(0, np.cumsum(end - begin))
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
    terms = pa.LargeStringArray.from_buffers(len(begin), *buffers[1:]).dictionary_encode()
    langs = run.column("lang").dictionary_encode()
    text = np.repeat(np.arange(run.num_rows), per_text)
    code, n_terms = terms.indices.to_numpy().astype(np.int64), max(1, len(terms.dictionary))
    once = np.unique(text * n_terms + code)
    lang = langs.indices.to_numpy().astype(np.int64)[once // n_terms]
    found, n = np.unique(lang * n_terms + once % n_terms, return_counts=True)
    return pa.table(
        {
            "lang": langs.dictionary.take(pa.array(found // n_terms)),
            "term": terms.dictionary.cast(pa.string()).take(pa.array(found % n_terms)),
            "n": n.astype(np.int64),
        }
    )


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, term`` of the terms in at least ``min_docs`` documents of a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Counts of runs are added up now and then, and handed on once they are many.
        held, size = [], 0
        for batch in batches:
            for run in runs(batch):
                held.append(_document_counts(run))
                size += held[-1].num_rows
                if size > 2 * HELD_COUNTS:
                    held = [_summed(held)]
                    size = held[0].num_rows
                    if size > HELD_COUNTS:
                        yield from held[0].to_batches()
                        held, size = [], 0
        if held:
            yield from _summed(held).to_batches()

    counted = docs.select("lang", "text").mapInArrow(count, "lang string, term string, n long")
    return (
        counted.groupBy("lang", "term")
        .agg(F.sum("n").alias("n_docs"))
        .filter(F.col("n_docs") >= min_docs)
        .select("lang", "term")
    )


def _summed(counts: list[pa.Table]) -> pa.Table:
    added = pa.concat_tables(counts).group_by(["lang", "term"]).aggregate([("n", "sum")])
    return added.select(["lang", "term", "n_sum"]).rename_columns(["lang", "term", "n"])


def vocabulary(kept: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """The transducers of every language, with the ordinal each of them starts from (``base``)."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, lead, terms = None, None, []

        def packed() -> pa.RecordBatch:
            built = build(t.encode() for t in terms)
            row = {
                "lang": lang,
                "lead": terms[0].encode()[:LEAD],
                "n_terms": len(terms),
                "terms": terms,
                "n_states": len(built.degree),
                "n_arcs": len(built.label),
                **built.pack(),
            }
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            for row in batch.to_pylist():
                cut = len(terms) >= shard_terms and row["lead"] != lead
                if terms and (cut or row["lang"] != lang):
                    yield packed()
                    terms = []
                lang, lead = row["lang"], row["lead"]
                terms.append(row["term"])
        if terms:
            yield packed()

    lead = F.substring(F.col("term").cast("binary"), 1, LEAD)
    # Terms with equal first bytes share a partition, so that those tell the shard.
    ordered = kept.withColumn("lead", lead).repartitionByRange("lang", "lead")
    ordered = ordered.sortWithinPartitions("lang", "term")
    stored = stored_scratch(ordered.mapInArrow(shards, _SHARD), "transducers")
    before = Window.partitionBy("lang").orderBy("lead").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored.select("lang", "lead", F.coalesce(F.sum("n_terms").over(before), F.lit(0)).alias("base"))
    return stored.join(bases, ["lang", "lead"])


def _blocks(shards: DataFrame, block_bytes: int) -> list[list[tuple]]:
    """Shards of each pass: their names and sizes come to the driver, a row per ``SHARD_TERMS``."""
    blocks, room = [], 0
    sizes = shards.select("lang", "base", (F.col("n_states") * 72 + F.col("n_arcs") * 16).alias("size"))
    for lang, base, size in sorted(map(tuple, sizes.collect())):
        if not blocks or size > room:
            blocks.append([])
            room = block_bytes
        blocks[-1].append((lang, base))
        room -= size
    return blocks


class _Counts:
    """A task's counts by (group, ordinal), handed on when there are many."""

    def __init__(self) -> None:
        self._groups: dict[tuple[str, str], int] = {}
        self._keys = np.empty(0, np.int64)
        self._n = np.empty(0, np.int64)
        self._new: list[np.ndarray] = []
        self._held = 0

    def add(self, group: tuple[str, str], ordinals: np.ndarray) -> None:
        code = self._groups.setdefault(group, len(self._groups))
        self._new.append(ordinals | (code << 40))
        self._held += len(ordinals)

    def full(self) -> bool:
        if self._held > 2 * HELD_COUNTS:
            self._sum()
        return len(self._keys) > HELD_COUNTS or len(self._groups) >= 1 << 20

    def _sum(self) -> None:
        if self._new:
            new, n = np.unique(np.concatenate(self._new), return_counts=True)
            self._keys, where = np.unique(np.concatenate([self._keys, new]), return_inverse=True)
            sums = np.zeros(len(self._keys), np.int64)
            np.add.at(sums, where, np.concatenate([self._n, n]))
            self._n = sums
        self._new, self._held = [], 0

    def hand_on(self) -> Iterator[pa.RecordBatch]:
        self._sum()
        names = list(self._groups)
        cuts = np.searchsorted(self._keys >> 40, np.arange(len(names) + 1))
        for (lang, source), a, b in zip(names, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if a < b:
                yield pa.record_batch(
                    [
                        pa.array([lang] * (b - a), pa.string()),
                        pa.array([source] * (b - a), pa.string()),
                        pa.array(self._keys[a:b] & ((1 << 40) - 1)),
                        pa.array(self._n[a:b]),
                    ],
                    names=["lang", "source", "ord", "n"],
                )
        self.__init__()


def _recounted(docs: DataFrame, block: DataFrame) -> DataFrame:
    """Kept terms of one pass's shards in all texts of their languages, by source and ordinal."""
    rows = block.select("lang", "lead", "base", *Transducer.TYPES).collect()  # at most BLOCK_BYTES
    by_lang: dict[str, tuple[list, list, list]] = {}
    for row in rows:
        leads, bases, packed = by_lang.setdefault(row["lang"], ([], [], []))
        leads.append(bytes(row["lead"]))
        bases.append(row["base"])
        packed.append({name: bytes(row[name]) for name in Transducer.TYPES})
    shared = docs.sparkSession.sparkContext.broadcast(by_lang)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walkers: dict[str, Walker] = {}
        counts = _Counts()
        for batch in batches:
            for run in runs(batch):
                data, starts = utf8(run.column("text"))
                data = lowered(data)
                begin, end, per_text = spans(_letters(data), starts)
                first = np.cumsum(per_text) - per_text
                langs, sources = run.column("lang").to_pylist(), run.column("source").to_pylist()
                for lang in set(langs):
                    if lang not in walkers:
                        leads, bases, packed = shared.value[lang]
                        walkers[lang] = Walker(leads, bases, [Transducer.unpack(p) for p in packed])
                    # The texts of a language, those of a source next to each other.
                    own = sorted((s, i) for i, s in enumerate(sources) if langs[i] == lang)
                    texts = np.array([i for _, i in own])
                    n = per_text[texts]
                    at = np.repeat(first[texts] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    ordinals = walkers[lang].ordinals(data, begin[at], end[at])
                    place = np.cumsum(np.append(0, n))
                    k = 0
                    while k < len(own):
                        stop = k
                        while stop < len(own) and own[stop][0] == own[k][0]:
                            stop += 1
                        part = ordinals[place[k] : place[stop]]
                        counts.add((lang, own[k][0]), part[part >= 0])
                        k = stop
                if counts.full():
                    yield from counts.hand_on()
        yield from counts.hand_on()

    texts = docs.filter(F.col("lang").isin(list(by_lang)))
    counted = texts.mapInArrow(count, _COUNTED).groupBy("lang", "source", "ord").agg(F.sum("n").alias("n"))
    counted = stored_scratch(counted, "term-counts")
    shared.unpersist()  # still there for a task that is run again
    return counted


def recount(docs: DataFrame, shards: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``lang, source, ord, n``: how often each kept term occurs in each group that has it."""
    counted = docs.sparkSession.createDataFrame([], _COUNTED)
    for block in _blocks(shards, block_bytes):
        # Neighbours in order of (lang, base): the shards between the first and the last.
        place = F.struct("lang", "base")
        low, high = (F.struct(F.lit(x).alias("lang"), F.lit(b).cast("long").alias("base")) for x, b in (block[0], block[-1]))
        counted = counted.unionByName(_recounted(docs, shards.filter(place.between(low, high))))
    return counted


def _share(n: Column, total: Column, v: Column) -> Column:
    """One more than the scaled share, exact; ``total`` counts in a vocabulary of ``v``."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (n + ADDED).cast("decimal(20,0)")
    return F.call_function("div", above, (total + 2 * v).cast("decimal(20,0)")) + 1


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pair_sums(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, a, b, more`` (a < b): by how much two sources differ more than where both lack all.

    A task takes ``ORDINALS`` terms of two tiles of ``SOURCES`` sources each, so its arrays are
    bounded; only sums per pair leave it.
    """

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lang, block, i, j = key
        index, place = np.unique(rows["index"].to_numpy(), return_inverse=True)
        absent = np.zeros(len(index), np.int64)
        absent[place] = rows["absent"].to_numpy()
        share = np.repeat(absent[:, None], ORDINALS, axis=1)
        own = rows["ord"].to_numpy() >= 0
        share[place[own], rows["ord"].to_numpy()[own] - block * ORDINALS] = rows["p"].to_numpy()[own]
        out = []
        for k, a in enumerate(index):
            if a // SOURCES != i:
                continue
            others = slice(np.searchsorted(index, max(a + 1, j * SOURCES)), None)
            q, lacks = share[others], absent[others]
            f = (share[k] - q) ** 2 // (share[k] + q)
            base = (absent[k] - lacks) ** 2 // (absent[k] + lacks)
            out += [(a, b, m) for b, m in zip(index[others], (f - base[:, None]).sum(axis=1), strict=True)]
        return pd.DataFrame(out, columns=["a", "b", "more"]).assign(lang=lang)[["lang", "a", "b", "more"]]

    tile = F.floor(F.col("index") / SOURCES).cast("long")
    tiles = F.floor((F.col("n_sources") + (SOURCES - 1)) / SOURCES).cast("long")
    other = F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1))
    block = F.floor(F.col("ord") / ORDINALS).cast("long")
    last_block = F.floor((F.col("v") - 1) / ORDINALS).cast("long")
    # A source may have no term of a block; a row without a term says that it is there.
    present = groups.filter("v > 0").select(
        F.explode(F.sequence(F.lit(0).cast("long"), last_block)).alias("block"),
        F.lit(-1).cast("long").alias("ord"),
        F.col("absent").alias("p"),
        "lang", "index", "absent", "n_sources",
    )
    # Every row goes to the tasks of its tile and each other one.
    dealt = (
        counts.withColumn("block", block)
        .select(*present.columns)
        .unionByName(present)
        .withColumns({"tile": tile, "other": other})
        .withColumn("i", F.least("tile", "other"))
        .withColumn("j", F.greatest("tile", "other"))
    )
    sums = dealt.groupBy("lang", "block", "i", "j").applyInPandas(
        compare, "lang string, a long, b long, more long"
    )
    return sums.groupBy("lang", "a", "b").agg(F.sum("more").alias("more"))


def source_divergence(
    spark: SparkSession,
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    shard_terms: int = SHARD_TERMS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how sources of a language differ, and by what.

    Part ``pair`` ranks every other source of the language, part ``term`` the ten terms that most
    set the source off from its language. Null text, language and source are empty; a document
    without terms still makes its group, repeated rows are documents, ties go by byte order. A
    language without kept terms has pairs of value 0; one of a single source has none. No rows
    give no rows. Other columns are not looked at.
    """
    docs = _documents(docs)
    kept = stored_scratch(kept_terms(docs, min_docs), "kept-terms")
    shards = stored_scratch(vocabulary(kept, shard_terms), "vocabulary")
    counts = recount(docs, shards, block_bytes)
    sizes = shards.groupBy("lang").agg(F.sum("n_terms").alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_source, by_lang = Window.partitionBy("lang").orderBy("source"), Window.partitionBy("lang")
    none = F.lit(0).cast("long")
    groups = (
        docs.select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .select("lang", "source", F.coalesce("total", none).alias("total"), F.coalesce("v", none).alias("v"))
        .withColumn("index", (F.row_number().over(by_source) - 1).cast("long"))
        .withColumn("n_sources", F.count(F.lit(1)).over(by_lang))
        .withColumn("lang_total", F.sum("total").over(by_lang))
        .withColumn("absent", F.when(F.col("v") > 0, _share(none, F.col("total"), F.col("v"))))
    )
    groups = stored_scratch(groups, "source-groups")
    counts = counts.join(groups, ["lang", "source"])
    counts = stored_scratch(
        counts.withColumn("p", _share(F.col("n"), F.col("total"), F.col("v"))), "source-shares"
    )

    # Pairs: from the shares of absent terms, corrected by the terms that either has.
    a = groups.select("lang", "v", F.col("source").alias("source_a"), F.col("index").alias("a"), F.col("absent").alias("pa"))
    b = groups.select("lang", F.col("source").alias("source_b"), F.col("index").alias("b"), F.col("absent").alias("pb"))
    pairs = a.join(b, "lang").filter("a < b")  # the answer has each of them twice
    pairs = pairs.join(_pair_sums(counts, groups), ["lang", "a", "b"], "left")
    value = F.when(
        F.col("v") > 0, F.col("v") * _f(F.col("pa"), F.col("pb")) + F.coalesce("more", none)
    ).otherwise(none)
    pairs = pairs.withColumn("value", value).select(
        "lang",
        "value",
        F.explode(
            F.array(
                F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")),
                F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item")),
            )
        ).alias("of"),
    )
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select(
        "lang", "of.source", F.lit("pair").alias("part"), "of.item", "value"
    ).withColumn("rank", F.row_number().over(ranked))

    # Terms: the group's share against that of the whole language.
    of_term = Window.partitionBy("lang", "ord")
    terms = counts.withColumn("q", _share(F.sum("n").over(of_term), F.col("lang_total"), F.col("v")))
    terms = terms.filter("p > q").withColumn("value", _f(F.col("p"), F.col("q")))
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ord")
    terms = terms.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= TOP)
    spelled = shards.select("lang", "base", F.posexplode("terms").alias("at", "item"))
    spelled = spelled.select("lang", "item", (F.col("base") + F.col("at")).alias("ord"))
    terms = terms.join(spelled, ["lang", "ord"]).select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", "rank"
    )
    return pairs.unionByName(terms)
