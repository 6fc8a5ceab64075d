"""Main text of web pages: marked structure, and a suffix array of each host's word streams.

A page is a stream of words and block ends (paragraphs, headings, list items). What lies in a marked
article is its text. Where no article is marked, the streams of the host's pages decide: Spark's range
partitioning sorts all their suffixes, a distributed suffix array, in which suffixes with ``RUN``
or more tokens in common are neighbours. A run that repeats on enough pages of the host is
boilerplate: blocks that such runs cover go, and so do covered stretches of ``LONG`` words within
a block; unique runs stay. In a marked article a repeated run stays, since articles may quote each other,
unless its element is named like page furniture.

Pages that share most of what is not on half of the host's pages anyway, such as print versions, count
as one page of evidence, and no page loses all its text. All pages of all hosts are evidence. Suffixes
that cannot repeat on enough pages, by exact counts in parts of the host's pages, are not sorted.

Equal suffixes may span several sorted partitions. Each partition settles what lies inside it and
hands on a summary of its first and last group.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.components import components
from tillroll.llm.textarrays import mixed
from tillroll.storage import scratch_path, stored_scratch

# Tokens (words and block ends) that suffixes must share; a longer run is covered by its suffixes.
RUN = 4
# Words that a covered stretch inside a block must have to go without the rest of the block.
LONG = 12
# A run is boilerplate on this many pages, and on this share of the host's pages, at least; where a
# host has fewer pages, on all of them. One page is evidence of nothing.
MIN_PAGES, PAGE_SHARE = 3, 0.2
# Share of a page's own words that make it a version of another page.
SAME_PAGE = 0.6
HELD_BACK = 100_000  # suffixes of an unfinished group, and hashes of tokens, that a task holds back
PART = 1 << 23  # suffixes of the pages that are counted at once, at most
# Bits of the map of runs that can repeat on enough pages: 2 MB, whatever their number.
LIKELY_BITS = 24

# Elements of HTML by what they mean for the text.
_RAW = "script|style|noscript|template|textarea|title|svg|iframe|object|select|math"
_LEFT_OUT = frozenset("nav footer aside form dialog button menu".split())
_CONTAINERS = frozenset("article main".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark "
    "meter nobr output picture progress q rp rt ruby s samp small source span strike strong sub "
    "sup time track tt u var wbr".split()
)
_SPACED = frozenset("br td th".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# What a class, id or role is called that may mark page furniture: these names, or
# names that begin with one of the prefixes and go on with a hyphen, an underscore or a capital.
_FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments complementary consent contentinfo cookie cookies dialog discussion disqus footer gdpr "
    "login menu modal nav navbar navigation newsletter notice notices notification paywall popup "
    "promo promoted promotion related replies respond search share sharing sidebar signup skip "
    "social sponsor sponsored subscribe toolbar widget".split()
)
_PREFIXES = "ad|ads|advert|banner|breadcrumb|comment|cookie|footer|gdpr|newsletter|popup|sidebar|sponsor"
_PREFIX = re.compile(rf"(?:{_PREFIXES})(?:[-_]|(?=[A-Z]))")
_HIDDEN = re.compile(r"(?<![\w-])aria-hidden\s*=\s*[\"']?true")
_VALUE = re.compile(r"=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]+)")
# A name means nothing for the whole page, containers, headings and paragraphs.
_NEVER_NAMED = frozenset("html body article main p h1 h2 h3 h4 h5 h6 blockquote pre".split())
CONTAINER = r"(?i)<(?:article|main)\b|\brole\s*=\s*[\"']?main\b"

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b[^>]*(?<!/)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)(?:>|\Z)"
    r"|<(?P<close2>/?)(?P<tag2>[a-z][a-z0-9:-]*)(?P<rest2>[^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"(?:(?<![\w-])(?:class|id|role)\s*=\s*)(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)


class Block(NamedTuple):
    text: str
    kept: bool  # not in page furniture
    inside: bool  # in the article or main part that the page's text is
    named: bool  # in an element that is only named like page furniture


def _is_left_out(tag: str, rest: str, in_container: bool) -> bool:
    """Whether the element itself says that it is page furniture."""
    if tag in _LEFT_OUT or (tag == "header" and not in_container):
        return True
    return tag == "div" and "hidden" in rest and (
        _HIDDEN.search(rest) is not None or re.search(r"(?<![\w-])hidden(?![\w-])", _VALUE.sub("", rest)) is not None
    )


def _is_named(tag: str, rest: str) -> bool:
    """Whether an element is called like page furniture."""
    if not rest or tag in _NEVER_NAMED or tag in _INLINE:
        return False
    for names in _NAMES.findall(rest):
        for name in "".join(names).split():
            if name.lower() in _FURNITURE or _PREFIX.match(name):
                return True
    return False


class _Tag(NamedTuple):
    name: str
    closing: bool
    rest: str
    start: int
    end: int
    raw: bool


def _tags(page: str) -> tuple[list[_Tag], list[int | None]]:
    """All tags of a page, and for each opening one the place of the tag that closes it."""
    tags, closed_by = [], []
    waiting: dict[str, list[int]] = {}
    for token in _TOKEN.finditer(page):
        name = (token["tag"] or token["tag2"] or "").lower()
        closing = bool(token["close"] or token["close2"])
        rest = token["rest"] or token["rest2"] or ""
        if name and name not in _VOID and name not in _INLINE:
            if not closing:
                if not rest.endswith("/"):
                    waiting.setdefault(name, []).append(len(tags))
            elif waiting.get(name):
                closed_by[waiting[name].pop()] = len(tags)
        tags.append(_Tag(name, closing, rest, token.start(), token.end(), bool(token["raw"])))
        closed_by.append(None)
    return tags, closed_by


class _Container(NamedTuple):
    rank: int  # 0, or 1 within an element named like furniture, or 2 within furniture
    in_main: bool


class _Open(NamedTuple):
    closed_by: int | None
    what: str  # "out" furniture, "named" like it, "in" a container
    container: _Container | None = None


class _Stack:
    """Open elements that mean something for the text."""

    def __init__(self) -> None:
        self._open: list[_Open] = []
        self._closing: set[int] = set()

    def state(self) -> tuple[_Container | None, list[_Open]]:
        """The innermost container, and what is open within it."""
        within: list[_Open] = []
        for entry in reversed(self._open):
            if entry.container:
                return entry.container, within
            within.append(entry)
        return None, within

    def put(self, entry: _Open) -> None:
        # One closed and one unclosed element of a sort say all, so that the stack stays small.
        same = [e for e in self.state()[1] if e.what == entry.what]
        if entry.container or not any(e.closed_by is not None or entry.closed_by is None for e in same):
            self._open.append(entry)
            if entry.closed_by is not None:
                self._closing.add(entry.closed_by)

    def close(self, place: int) -> None:
        if place in self._closing:
            if self._open and self._open[-1].closed_by == place:
                self._open.pop()
            else:
                self._open = [e for e in self._open if e.closed_by != place]

    def end_unclosed(self) -> None:
        """Furniture that is never closed ends where an article begins."""
        if any(e.closed_by is None for e in self.state()[1]):
            self._open = [e for e in self._open if e.container or e.closed_by is not None]


class _Found(NamedTuple):
    text: str
    kept: bool
    named: bool
    container: _Container | None


def page_blocks(page: str | None) -> list[Block]:
    """Non-empty blocks of a page in order, with character references decoded."""
    page = page or ""
    tags, closed_by = _tags(page)
    found: list[_Found] = []
    parts: list[str] = []
    stack = _Stack()

    def end_block() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            container, within = stack.state()
            sorts = {e.what for e in within}
            found.append(_Found(text, "out" not in sorts, "named" in sorts, container))

    at = 0
    for place, tag in enumerate(tags):
        if tag.start > at:
            parts.append(html.unescape(page[at : tag.start]))
        at = tag.end
        if not tag.name:
            if tag.raw:
                end_block()
            continue
        if tag.name in _SPACED:
            parts.append(" ")
        elif tag.name not in _INLINE:
            end_block()
        if tag.closing:
            stack.close(place)
            continue
        if tag.name in _VOID or tag.name in _INLINE or tag.rest.endswith("/"):
            continue
        role_main = "main" in tag.rest and re.search(r"(?<![\w-])role\s*=\s*[\"']?main\b", tag.rest)
        if role_main or tag.name in _CONTAINERS:
            stack.end_unclosed()
            around, within = stack.state()
            sorts = {e.what for e in within}
            rank = max(around.rank if around else 0, 2 if "out" in sorts else 1 if "named" in sorts else 0)
            in_main = bool(role_main or tag.name == "main" or (around and around.in_main))
            stack.put(_Open(closed_by[place], "in", _Container(rank, in_main)))
        elif _is_left_out(tag.name, tag.rest, stack.state()[0] is not None):
            stack.put(_Open(closed_by[place], "out"))
        elif _is_named(tag.name, tag.rest):
            stack.put(_Open(closed_by[place], "named"))
    parts.append(html.unescape(page[at:]))
    end_block()
    return _chosen(found)


def _n_words(found: list[_Found]) -> int:
    return sum(f.text.count(" ") + 1 for f in found if f.kept)


def _chosen(found: list[_Found]) -> list[Block]:
    """Blocks with the container that is the page's text: the one least in furniture, by size."""
    chosen: tuple[int, bool] | None = None
    rank = min((f.container.rank for f in found if f.container and f.kept), default=None)
    if rank is not None:
        own = [f for f in found if f.container and f.container.rank == rank]
        # Articles in the main part belong to it; others compete with it.
        main, others = ([f for f in own if f.container.in_main is m] for m in (True, False))
        in_main = _n_words(main) >= _n_words(others)
        # No teaser in the furniture is the text of a page that marks none.
        loose = [f for f in found if not f.container]
        if not rank or _n_words(main if in_main else others) >= _n_words(loose):
            chosen = rank, in_main
    out = []
    for f in found:
        inside = f.container is not None and (f.container.rank, f.container.in_main) == chosen
        # An article in furniture is as much furniture as what holds it.
        furniture = f.container is not None and f.container.rank == 2 and not inside
        named = f.named or (f.container is not None and f.container.rank == 1 and not inside)
        out.append(Block(f.text, f.kept and not furniture, inside, named))
    return out


def undecided(blocks: list[Block]) -> bool:
    """Whether the host's repeated runs decide anything on the page."""
    marked = any(b.inside for b in blocks)
    return any(b.kept and (b.inside and b.named if marked else True) for b in blocks)


END = ""  # the token that ends a block


def tokens(blocks: list[Block]) -> tuple[list[str], list[int]]:
    """The page's stream: an end, then the words of each block and another end; and where the
    words of each block begin."""
    out, begin = [END], []
    for block in blocks:
        begin.append(len(out))
        out += block.text.split(" ")
        out.append(END)
    return out, begin


def joined(blocks: list[Block], at: list[int] | None = None) -> str:
    """The main text: blocks of the marked article, or else all that are kept, without what runs
    from the places ``at`` cover.

    Blocks named like furniture go if they are covered; with nothing known of the host (None)
    their name decides. If everything would go, nothing does.
    """
    marked = any(b.inside for b in blocks)
    wanted = [i for i, b in enumerate(blocks) if b.kept and (b.inside or not marked)]
    if at is None:
        return "\n".join(blocks[i].text for i in wanted if not blocks[i].named)
    stream, begin = tokens(blocks)
    covered = np.zeros(len(stream) + RUN, bool)
    for k in range(RUN):
        covered[np.array(at, np.int64) + k] = True
    out = []
    for i in wanted:
        words = blocks[i].text.split(" ")
        hit = covered[begin[i] : begin[i] + len(words)]
        if marked:
            if not (blocks[i].named and hit.all()):
                out.append(blocks[i].text)
        elif not hit.all():
            out.append(_without_long_runs(words, hit))
    return "\n".join(t for t in out if t) or "\n".join(blocks[i].text for i in wanted)


def _without_long_runs(words: list[str], hit: np.ndarray) -> str:
    """A block's text without covered stretches of ``LONG`` words or more."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    stays = np.ones(len(words), bool)
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        if b - a >= LONG:
            stays[a:b] = False
    return " ".join(w for w, s in zip(words, stays.tolist(), strict=True) if s)


def _hash(text: str) -> int:
    value = xxhash.xxh64_intdigest(text)
    return value - (1 << 64) if value >> 63 else value


_KEYS = [f"k{i}" for i in range(RUN)]
_PARSED = "page long, page_id long, url string, host string, texts array<string>, flags array<tinyint>"


def parsed_pages(pages: DataFrame) -> DataFrame:
    """Rows ``page, page_id, url, host, html`` with the page's blocks instead: texts and flags."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages_ = [page_blocks(source) for source in batch.column("html").to_pylist()]
            texts = [[b.text for b in blocks] for blocks in pages_]
            flags = [[b.kept | b.inside << 1 | b.named << 2 for b in blocks] for blocks in pages_]
            kept = [batch.column(c) for c in ("page", "page_id", "url", "host")]
            yield pa.record_batch(
                [*kept, pa.array(texts, pa.list_(pa.string())), pa.array(flags, pa.list_(pa.int8()))],
                names=["page", "page_id", "url", "host", "texts", "flags"],
            )

    return pages.mapInArrow(read, _PARSED)


def _blocks_of(batch: pa.RecordBatch) -> Iterator[list[Block]]:
    """The blocks of each page, from ``html`` or as ``parsed_pages`` gives them."""
    if "html" in batch.schema.names:
        yield from map(page_blocks, batch.column("html").to_pylist())
        return
    for texts, flags in zip(batch.column("texts").to_pylist(), batch.column("flags").to_pylist(), strict=True):
        yield [Block(t, bool(f & 1), bool(f & 2), bool(f & 4)) for t, f in zip(texts, flags, strict=True)]


_BLOCKS = "page long, host string, block long, n_words int, open boolean"


def block_rows(pages: DataFrame) -> DataFrame:
    """``page, host, block, n_words, open``: the different blocks of every page, by a hash, and whether
    repeated runs decide anything on the page."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            names = ("page", "host")
            for page, host, blocks in zip(
                *[batch.column(c).to_pylist() for c in names], _blocks_of(batch), strict=True
            ):
                own = {_hash(b.text): b.text.count(" ") + 1 for b in blocks}
                n, open_ = len(own), undecided(blocks)
                for column, values in zip(
                    columns, ([page] * n, [host] * n, list(own), list(own.values()), [open_] * n), strict=True
                ):
                    column += values
            types = [pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.bool_()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.record_batch(arrays, names=["page", "host", "block", "n_words", "open"])

    return pages.mapInArrow(read, _BLOCKS)


def page_groups(blocks: DataFrame) -> DataFrame:
    """``page, host, version, n_versions``: pages that are versions of one another get the same
    ``version``; how many the host has.

    A block that more than half of the host's pages have says nothing about two of them. Of the
    others, each leads from a page to the first page that has it; a page is a version of the
    one that holds most of its words. Rows are as many as blocks, not as pairs of pages.
    """
    pages = blocks.select("page", "host").distinct()
    hosts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    shared = blocks.groupBy("host", "block").agg(
        F.count(F.lit(1)).alias("n_having"), F.min("page").alias("first")
    )
    most = F.greatest(F.lit(2), F.floor(F.col("n_pages") / 2))
    # A block of one page only leads nowhere: its words are counted with the page.
    common = F.col("n_having") > most
    repeated = shared.filter("n_having > 1").join(hosts, "host").select("host", "block", "first", common.alias("common"))
    found = blocks.join(repeated, ["host", "block"])
    sums = found.filter("not common").groupBy("page", "first").agg(F.sum("n_words").alias("n_shared"))
    whole = blocks.groupBy("page").agg(F.sum("n_words").alias("n_all"))
    less = found.filter("common").groupBy("page").agg(F.sum("n_words").alias("n_common"))
    n_own = F.col("n_all") - F.coalesce("n_common", F.lit(0))
    links = (
        sums.filter("page <> first")
        .join(whole, "page")
        .join(less, "page", "left")
        .filter(F.col("n_shared") >= SAME_PAGE * n_own)
        .select(F.col("page").alias("a"), F.col("first").alias("b"))
    )
    labels = components(stored_scratch(links, "page-versions"))
    named = pages.join(labels.withColumnRenamed("node", "page"), "page", "left")
    named = named.select("page", "host", F.coalesce("component", "page").alias("version"))
    counts = named.groupBy("host").agg(F.count_distinct("version").alias("n_versions"))
    return named.join(counts, "host").select("page", "host", "version", "n_versions")


class _Hashes(dict):
    """Hashes of tokens, of so many at most as are kept at once."""

    def __missing__(self, token: str) -> int:
        if len(self) >= HELD_BACK:
            self.clear()
        self[token] = value = _hash(token)
        return value


def _suffix_keys(blocks: list[Block], host: str, hashes: _Hashes) -> list[np.ndarray]:
    """Hashes of the first ``RUN`` tokens of each suffix of a page's stream, the first one with the
    host's: suffixes of different hosts are never equal. No arrays for a page without a suffix."""
    stream, _ = tokens(blocks)
    n = len(stream) - RUN + 1
    if n <= 0:
        return []
    own = np.fromiter(map(hashes.__getitem__, stream), np.int64, len(stream))
    salt = np.int64(_hash(f"host {host}"))
    return [own[k : k + n] ^ (salt if k == 0 else 0) for k in range(RUN)]


def _place(keys: list[np.ndarray]) -> np.ndarray:
    """A suffix's place in the map of likely runs."""
    place = keys[0].view(np.uint64)
    for key in keys[1:]:
        place = mixed(place) + key.view(np.uint64)
    return (mixed(place) >> np.uint64(64 - LIKELY_BITS)).astype(np.int64)


def likely_runs(pages: DataFrame, part: int = PART) -> np.ndarray:
    """A map of bits, set for all runs that can be boilerplate, and few others.

    ``pages`` are ``host, n_pages, n_versions`` and blocks or ``html``. A task counts the pages that have a run in
    parts of its pages. A run on ``enough`` of the host's pages is on this share of them in one part at
    least, so no run is lost; and versions of a page are not more than pages.
    """

    def likely(n_by_host: dict[str, list]) -> pa.RecordBatch:
        found = [np.empty(0, np.int64)]
        for places, n_pages, enough in n_by_host.values():
            place, n = np.unique(np.concatenate(places), return_counts=True)
            found.append(place[n * n_pages >= enough * len(places)])
        return pa.record_batch([np.unique(np.concatenate(found))], names=["at"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_by_host: dict[str, list] = {}
        held, hashes = 0, _Hashes()
        for batch in batches:
            names = ("host", "n_pages", "enough")
            columns = [batch.column(c).to_pylist() for c in names]
            for blocks, host, n_pages, enough in zip(_blocks_of(batch), *columns, strict=True):
                keys = _suffix_keys(blocks, host, hashes)
                if keys:
                    places = np.unique(_place(keys))
                    n_by_host.setdefault(host, [[], n_pages, enough])[0].append(places)
                    held += len(places)
                if held >= part:
                    yield likely(n_by_host)
                    n_by_host, held = {}, 0
        yield likely(n_by_host)

    content = [c for c in pages.columns if c in ("html", "texts", "flags")]
    rows = pages.select(*content, "host", "n_pages", _enough().alias("enough")).mapInArrow(count, "at long")
    words = rows.groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))).alias("bits")
    )
    found = words.toArrow()
    out = np.zeros(1 << (LIKELY_BITS - 6), np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def suffixes(pages: DataFrame, likely: Broadcast | None = None) -> DataFrame:
    """The suffixes of every page's stream, by hashes of its first ``RUN`` tokens: all of them, or
    those in a map of ``likely_runs``.

    ``pages`` are ``page, host, version, n_versions`` and blocks or ``html``. ``k0`` is a hash of host and token.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            found: list[list[np.ndarray]] = []
            columns = [batch.column(c).to_pylist() for c in ("host", "version", "n_versions", "page")]
            for blocks, host, version, size, page in zip(_blocks_of(batch), *columns, strict=True):
                keys = _suffix_keys(blocks, host, hashes)
                if not keys:
                    continue
                at = np.arange(len(keys[0]), dtype=np.int32)
                if likely is not None:
                    place = _place(keys)
                    word, bit = likely.value[place >> 6], (place & 63).astype(np.uint64)
                    at = at[(word >> bit) & np.uint64(1) == 1]
                fixed = [np.full(len(at), x, np.int64) for x in (version, size, page)]
                found.append([*[k[at] for k in keys], *fixed, at])
            if found:
                columns = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
                yield pa.record_batch(columns, names=[*_KEYS, "version", "n_versions", "page", "at"])

    schema = ", ".join(f"{c} long" for c in (*_KEYS, "version", "n_versions", "page")) + ", at int"
    return pages.mapInArrow(read, schema)


_SETTLED = (
    "page long, at int, n_versions long, part int, place long, n long, low long, high long, "
    + ", ".join(f"{k} long" for k in _KEYS)
)
_COLUMNS = [c.split()[0] for c in _SETTLED.split(", ")]


class _Settler:
    """One task's pass over its sorted suffixes: groups of equal ones, and on how many page
    versions each is. Groups at the partition's ends, and those that grow too large to hold back,
    are given out open, with a summary of the group."""

    def __init__(self, part: int, held_back: int) -> None:
        self._part, self._limit = part, held_back
        self._key: tuple | None = None
        self._place = -1  # number of the group in the partition
        self._n = 0  # versions so far
        self._low = self._high = 0  # the first and the last of them
        self._size = 0  # of the host
        self._held: list[tuple[np.ndarray, np.ndarray]] = []
        self._n_held = 0
        self._open = False

    def batch(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if rows.num_rows == 0:
            return
        keys = np.stack([rows.column(k).to_numpy() for k in _KEYS])
        version, page, at = (rows.column(c).to_numpy() for c in ("version", "page", "at"))
        size = rows.column("n_versions").to_numpy()
        change = np.ones(rows.num_rows, bool)
        change[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
        starts = np.flatnonzero(change)
        other = change.copy()
        other[1:] |= version[1:] != version[:-1]
        versions = np.add.reduceat(other.astype(np.int64), starts)
        ends = np.append(starts[1:], rows.num_rows)
        # Groups that begin and end within the batch, then its first and its last one.
        whole = versions > 1
        whole[[0, -1]] = False
        inner = np.repeat(whole, ends - starts)
        if inner.any():
            n = np.repeat(versions, ends - starts)[inner]
            yield self._rows(page[inner], at[inner], size[inner], n)
        for g in sorted({0, len(starts) - 1}):
            a, b = int(starts[g]), int(ends[g])
            key = tuple(keys[:, a].tolist())
            if key != self._key:
                yield from self._close(False)
                self._key, self._place, self._n = key, self._place + 1, 0
                self._size, self._open = int(size[a]), self._place == 0
            if self._n == 0:
                self._low = int(version[a])
            self._n += int(versions[g]) - (self._n > 0 and self._high == version[a])
            self._high = int(version[b - 1])
            self._held.append((page[a:b].copy(), at[a:b].copy()))
            self._n_held += b - a
            if self._open or self._n_held > self._limit:
                self._open = True
                yield from self._give()

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self._close(True)

    def _close(self, last: bool) -> Iterator[pa.RecordBatch]:
        if self._key is None:
            return
        self._open |= last
        if self._open:
            yield from self._give()
            columns = {c: None for c in _COLUMNS}
            columns |= {"part": self._part, "place": self._place, "n": self._n, "low": self._low, "high": self._high}
            columns |= dict(zip(_KEYS, self._key, strict=True))
            yield pa.record_batch(
                [pa.array([columns[c]], pa.int32() if c in ("at", "part") else pa.int64()) for c in _COLUMNS],
                names=_COLUMNS,
            )
        elif self._n > 1:
            yield from self._give(self._n)
        self._held, self._n_held = [], 0

    def _give(self, n: int | None = None) -> Iterator[pa.RecordBatch]:
        for page, at in self._held:
            size = np.full(len(page), self._size, np.int64)
            yield self._rows(page, at, size, None if n is None else np.full(len(page), n, np.int64))
        self._held, self._n_held = [], 0

    def _rows(self, page, at, size, n) -> pa.RecordBatch:
        m = len(page)
        none = pa.nulls(m, pa.int64())
        place = none if n is not None else pa.array(np.full(m, self._place, np.int64))
        part = pa.array(np.full(m, self._part, np.int32))
        found = none if n is None else pa.array(n)
        columns = [pa.array(page), pa.array(at), pa.array(size), part, place, found, none, none]
        return pa.record_batch([*columns, *[none] * RUN], names=_COLUMNS)


def repeated_runs(pages: DataFrame, held_back: int = HELD_BACK, likely: Broadcast | None = None) -> DataFrame:
    """``page, at, n, n_versions``: places whose suffix is on ``n`` > 1 page versions of the host; all
    such, or those in a map of ``likely_runs``."""
    order = [*_KEYS, "version", "page", "at"]
    # Stored, since the range partitioning looks at them twice.
    found = stored_scratch(suffixes(pages, likely), "suffixes")
    ordered = found.repartitionByRange(*order).sortWithinPartitions(*order)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Settler(TaskContext.get().partitionId(), held_back)
        for batch in batches:
            yield from state.batch(batch)
        yield from state.end()

    settled = stored_scratch(ordered.mapInArrow(settle, _SETTLED), "suffix-array")
    # Open groups: at most two per partition and one per HELD_BACK suffixes, so broadcast. Parts
    # of one group follow each other, and so do a version's suffixes within it.
    summaries = settled.filter("page IS NULL")
    along = Window.partitionBy(*_KEYS).orderBy("part", "place")
    again = F.coalesce((F.lag("high").over(along) == F.col("low")).cast("long"), F.lit(0))
    summaries = summaries.withColumn("n", F.col("n") - again)
    total = F.sum("n").over(Window.partitionBy(*_KEYS)).alias("total")
    whole = stored_scratch(summaries.select("part", "place", total), "open-runs")
    found = settled.filter("page IS NOT NULL").join(F.broadcast(whole), ["part", "place"], "left")
    n = F.coalesce("n", "total")
    return found.select("page", "at", n.alias("n"), "n_versions").filter("n > 1")


def _enough() -> Column:
    """On how many of ``n_versions`` pages a run is boilerplate."""
    share = F.ceil(PAGE_SHARE * F.col("n_versions"))
    return F.greatest(F.lit(2), F.least("n_versions", F.greatest(F.lit(MIN_PAGES), share)))


def is_boilerplate() -> Column:
    """Is a run on ``n`` of ``n_versions`` pages boilerplate?"""
    return F.col("n") >= _enough()


def _decided(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` of pages with ``marks``: the places of boilerplate runs, or null."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column("marks").to_pylist()
            texts = [
                joined(blocks, at or [])
                for blocks, at in zip(_blocks_of(batch), marks, strict=True)
            ]
            kept = [batch.column(c) for c in ("page_id", "url")]
            yield pa.record_batch([*kept, pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return pages.mapInArrow(extract, "page_id long, url string, text string")


def main_text(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Per page: ``page_id, url, text, n_chars``.

    Null or empty html gives an empty text. A null url stays null; such pages share one nameless
    host. Repeated rows are each returned, and are versions of one page. Other columns are not
    looked at.
    """
    host = F.lower(F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", 1))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html", F.coalesce(host, F.lit("")).alias("host")
    )
    # Rows of one page have one key; what is found for it holds for all of them.
    rows = rows.withColumn("page", F.xxhash64("page_id", "url", "html"))
    # Every later step looks at all blocks: pages are parsed once, their blocks kept as small as they get.
    path = scratch_path(spark, "pages-parsed")
    parsed_pages(rows).write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(_PARSED).parquet(path)
    once = rows.select("page", "host", "texts", "flags")
    if not once.groupBy("page").count().filter("count > 1").isEmpty():
        once = once.dropDuplicates(["page"])
    blocks = stored_scratch(block_rows(once), "blocks")
    versions = stored_scratch(page_groups(blocks), "versions")
    hosts = versions.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"), F.max("n_versions").alias("n_versions"))
    # Small tables are stored, so that Spark knows that they are and does not shuffle the pages.
    evidence = once.join(stored_scratch(hosts, "hosts"), "host")
    other = stored_scratch(versions.filter("version <> page").select("page", "version"), "other-versions")
    likely = spark.sparkContext.broadcast(likely_runs(evidence))
    evidence = evidence.join(other, "page", "left").withColumn("version", F.coalesce("version", "page"))
    runs = repeated_runs(evidence, likely=likely).filter(is_boilerplate())
    # On the other pages repeats decide nothing.
    open_ = blocks.filter("open").select("page").distinct()
    marks = runs.join(open_, "page", "left_semi").groupBy("page").agg(F.collect_list("at").alias("marks"))
    texts = _decided(rows.join(stored_scratch(marks, "marks"), "page", "left").drop("page", "host"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))
