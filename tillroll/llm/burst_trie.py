"""Prefix trie of conversations as a burst trie: containers of suffixes under trie heads.

Every conversation is a sequence of turn ids (digests of role and text). All of them start in one
container under the root. A container that holds more than ``CONTAINER`` turns and conversations
bursts: its head becomes a trie node, and every next turn id a head with a container of its own.
Containers that are small enough are dealt to tasks by their head; a task sorts the suffixes of a
container and sweeps over them once, with the path of the last one on a stack, which gives all nodes
below the head. Totals of subtrees then go up through the burst heads, level by level.

A node is known by its depth and its smallest member: a conversation has one node at each depth.
Turns stay rows until they reach their container, so neither a conversation with very many turns
nor a node with very many members is brought together in one task; copies of a conversation burst
once for every turn. Only the ids that end at a burst node pass one task per node, as joined text
in order, because their digest is sequential.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.storage import stored_scratch

CONTAINER = 1024  # turns and conversations that a container holds without bursting
# Conversations are joined to the one whose id ends their group of five, by the
# first crc32 % 9 of its turns.
GROUP, MOST = 5, 9
LEAD = 32  # code points of a text that order turns of one number
CHUNK = 8192  # ids of a burst node that are joined before they are hashed

_NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, top boolean"
)
NODES = [c.split()[0] for c in _NODES.split(", ")[:-1]]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv, place, tid, bytes``: turns by number within their conversation, from 0.

    Turns are range-partitioned by conversation and number, and counted on from partition to partition:
    a conversation larger than a task's share is no task's alone.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    spelled = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.substring(text, 1, LEAD).alias("lead"),
        F.unhex(F.sha2(spelled, 256)).alias("tid"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    order = ["conv", F.asc_nulls_first("turn"), "role", "lead", "tid"]
    ordered = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = stored_scratch(
        ordered.select(
            "conv", "tid", "bytes",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "ordered-turns",
    )
    parts = ordered.groupBy("conv", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    place = F.col("row") - F.col("first") + F.col("before")
    return ordered.join(parts, ["conv", "part"]).select("conv", place.alias("place"), "tid", "bytes")


def _taken(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % MOST


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv, pos, tid, bytes`` of the rebuilt turns (from 1), and ``conv, length`` of all
    conversations, turnless ones too."""
    turns = stored_scratch(numbered_turns(conversations), "numbered-turns")
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    base = sizes.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    members = (
        sizes.withColumn("h", _taken(F.col("conv")))
        .withColumn("base", F.col("conv") - F.col("conv") % GROUP)
        .join(base, "base", "left")
        .withColumn("shared", F.least("h", F.coalesce("n_base", F.lit(0))))
    )
    members = stored_scratch(
        members.withColumn("length", F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "rebuilt"
    )
    own = turns.join(members.select("conv", "h", "shared"), "conv").filter("place >= h")
    own = own.select("conv", (F.col("place") - F.col("h") + F.col("shared") + 1).alias("pos"), "tid", "bytes")
    # A conversation lends at most its first eight turns, to at most nine others.
    lent = turns.filter(F.col("place") < MOST - 1).withColumnRenamed("conv", "base")
    lent = lent.join(members.select("conv", "base", "h"), "base").filter("place < h")
    lent = lent.select("conv", (F.col("place") + 1).alias("pos"), "tid", "bytes")
    return stored_scratch(own.unionByName(lent), "rebuilt-turns"), members.select("conv", "length")


class _Node:
    __slots__ = ("conv", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved", "bytes", "ends")

    def __init__(self, depth: int, parent: _Node | None, size: int) -> None:
        self.conv: int | None = None
        self.depth, self.parent, self.bytes = depth, parent, size
        self.n_convs = self.n_children = self.n_leaves = self.saved = 0
        self.ends: list[int] = []

    def close(self) -> None:
        """All below is known: sum up, and add the sums to the parent."""
        if self.ends:
            self.ends.sort()
            self.n_convs += len(self.ends)
            self.conv = self.ends[0] if self.conv is None else min(self.conv, self.ends[0])
        if not self.n_children:
            self.n_leaves = 1
        self.saved += (self.n_convs - 1) * self.bytes
        up = self.parent
        if up is not None:
            up.n_convs += self.n_convs
            up.n_children += 1
            up.n_leaves += self.n_leaves
            up.saved += self.saved
            up.conv = self.conv if up.conv is None else min(up.conv, self.conv)

    def row(self, outer: int | None) -> tuple:
        digest = hashlib.sha256(b",".join(b"%d" % c for c in self.ends)).hexdigest() if self.ends else NO_ENDS
        parent = outer if self.parent is None else self.parent.conv
        numbers = (self.n_convs, self.n_children, self.n_leaves, self.saved)
        return (self.conv, self.depth, parent, *numbers, digest, self.parent is None)


def swept(depth: int, top_bytes: int, suffixes: list[tuple[list[bytes], list[int], int]]) -> list[_Node]:
    """Nodes of a container, its head first: suffixes (turn ids, sizes, conversation) are sorted,
    then swept with the path of the last one on a stack."""
    suffixes.sort(key=lambda s: s[0])
    top = _Node(depth, None, top_bytes)
    nodes, path, last = [top], [top], []
    for ids, sizes, conv in suffixes:
        shared = 0
        for a, b in zip(ids, last, strict=False):
            if a != b:
                break
            shared += 1
        while len(path) > shared + 1:
            path.pop().close()
        for k in range(shared, len(ids)):
            node = _Node(depth + k + 1, path[-1], sizes[k])
            nodes.append(node)
            path.append(node)
        path[-1].ends.append(conv)
        last = ids
    while path:
        path.pop().close()
    return nodes


def _sweep(containers: DataFrame, turns: DataFrame) -> DataFrame:
    """All nodes of the given containers (``conv, node, depth, parent, top_bytes``)."""
    suffix = (containers["conv"] == turns["conv"]) & (turns["pos"] > containers["depth"])
    rows = containers.join(turns, suffix, "left").select(
        containers["conv"], "node", "depth", "parent", "top_bytes", "pos", "tid", "bytes"
    )
    # A container is at most CONTAINER rows; a task has many.
    rows = rows.repartition("depth", "node").sortWithinPartitions("depth", "node", "conv", "pos")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, suffixes, out = None, [], []

        def done() -> None:
            if head is not None:
                out.extend(n.row(head[2]) for n in swept(head[1], head[3], suffixes))

        def give() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            types = [*[pa.int64()] * 7, pa.string(), pa.bool_()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            out.clear()
            return pa.record_batch(arrays, names=[*NODES, "top"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv", "node", "depth", "parent", "top_bytes", "tid", "bytes")]
            for conv, node, depth, parent, top_bytes, tid, size in zip(*columns, strict=True):
                if head is None or head[:2] != (node, depth):
                    done()
                    head, suffixes = (node, depth, parent, top_bytes), []
                    if len(out) > 1 << 14:
                        yield give()
                if not suffixes or suffixes[-1][2] != conv:
                    suffixes.append(([], [], conv))
                if tid is not None:
                    suffixes[-1][0].append(tid)
                    suffixes[-1][1].append(size)
        done()
        if out:
            yield give()

    return rows.mapInArrow(sweep, _NODES)


def _digests(ended: DataFrame) -> DataFrame:
    """``node, depth, ends_sha256`` of burst nodes where conversations end (``conv, node, depth``).

    Sorted ids are joined to texts of up to ``CHUNK`` of them in as many tasks as there are
    partitions; a node's texts then pass one task, one at a time.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces: list[list] = []
            for depth, node, conv in zip(*[batch.column(c).to_pylist() for c in ("depth", "node", "conv")], strict=True):
                if not pieces or pieces[-1][:2] != [depth, node] or len(pieces[-1][2]) == CHUNK:
                    pieces.append([depth, node, []])
                pieces[-1][2].append(conv)
            yield pa.record_batch(
                [
                    pa.array([p[0] for p in pieces], pa.int64()),
                    pa.array([p[1] for p in pieces], pa.int64()),
                    pa.array([p[2][0] for p in pieces], pa.int64()),
                    pa.array([",".join(map(str, p[2])) for p in pieces], pa.string()),
                ],
                names=["depth", "node", "first", "joined"],
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, state, done = None, None, []
        for batch in batches:
            for depth, node, joined in zip(*[batch.column(c).to_pylist() for c in ("depth", "node", "joined")], strict=True):
                if head == (depth, node):
                    state.update(b"," + joined.encode())
                    continue
                if head is not None:
                    done.append((*head, state.hexdigest()))
                head, state = (depth, node), hashlib.sha256(joined.encode())
        if head is not None:
            done.append((*head, state.hexdigest()))
            depths, nodes, hexes = zip(*done, strict=True)
            yield pa.record_batch(
                [pa.array(depths, pa.int64()), pa.array(nodes, pa.int64()), pa.array(hexes, pa.string())],
                names=["depth", "node", "ends_sha256"],
            )

    order = ["depth", "node", "conv"]
    pieces = ended.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = pieces.mapInArrow(join, "depth long, node long, first long, joined string")
    pieces = pieces.repartition("depth", "node").sortWithinPartitions("depth", "node", "first")
    return pieces.mapInArrow(digest, "depth long, node long, ends_sha256 string")


def conversation_trie(
    spark: SparkSession, conversations: DataFrame, container: int = CONTAINER
) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations; see ``NODES``.

    Turns are ordered by number, a missing one first; turns of one number by role, the first
    ``LEAD`` code points of the text, and digest; a repeated row is a turn of its own. Null role and text
    are empty. Rows without ``conv_id`` are of no conversation and left out. No conversations give
    no nodes, not even a root. Other columns are not looked at.
    """
    turns, lengths = rebuilt(conversations)
    total = lengths.agg(F.min("conv").alias("least"), F.count(F.lit(1)).alias("n"), F.sum("length").alias("turns")).first()
    none = F.lit(None).cast("long")
    members = lengths.select(
        "conv", "length", F.lit(total.least).cast("long").alias("node"), F.lit(0).cast("long").alias("depth"),
        none.alias("parent"), F.lit(0).cast("long").alias("top_bytes"), F.lit(total.n).cast("long").alias("n_convs"),
    )
    small = ["conv", "node", "depth", "parent", "top_bytes"]
    if total.n + (total.turns or 0) <= container:
        return _sweep(members.select(*small), turns).select(*NODES)

    head_columns = "node long, depth long, parent long, top_bytes long, n_convs long"
    root = spark.createDataFrame([(total.least, 0, None, 0, total.n)], head_columns)
    heads, ended, containers = [root], [], []
    depth = 0
    while True:
        # Members of the burst nodes of this depth go on to their next turn.
        ended.append(members.filter(F.col("length") == depth).select("conv", "node", "depth"))
        following = turns.filter(F.col("pos") == depth + 1).select("conv", "tid", "bytes")
        going = members.filter(F.col("length") > depth).select("conv", "length", F.col("node").alias("parent"))
        going = stored_scratch(going.join(following, "conv"), "next-turns")
        left = F.col("length") - (depth + 1)
        kids = going.groupBy("parent", "tid").agg(
            F.min("conv").alias("node"),
            F.count(F.lit(1)).alias("n_convs"),
            (F.sum(left) + F.count(F.lit(1)) > container).alias("bursts"),
        )
        kids = stored_scratch(kids, "heads")
        depth += 1
        at = F.lit(depth).cast("long").alias("depth")
        # One row per head on the other side: adaptive execution splits a head with very many members.
        dealt = going.join(kids, ["parent", "tid"]).select(
            "conv", "length", "node", at, "parent", F.col("bytes").alias("top_bytes"), "n_convs", "bursts"
        )
        dealt = stored_scratch(dealt, "members")
        containers.append(dealt.filter(~F.col("bursts")).select(*small))
        members = dealt.filter("bursts")
        burst = members.filter("conv = node").select("node", "depth", "parent", "top_bytes", "n_convs")
        if burst.isEmpty():
            break
        heads.append(burst)

    def all_of(frames: list[DataFrame]) -> DataFrame:
        whole = frames[0]
        for frame in frames[1:]:
            whole = whole.unionByName(frame)
        return whole

    nodes = stored_scratch(_sweep(all_of(containers), turns), "swept")
    digests = stored_scratch(_digests(all_of(ended)), "end-digests")
    tops = nodes.filter("top").select("depth", F.col("parent_conv_id").alias("node"), "n_leaves", "saved_tokens")
    results = [nodes.select(*NODES)]
    above: DataFrame | None = None  # the burst heads one level down, as children of this level's
    for d in range(len(heads) - 1, -1, -1):
        below = tops.filter(F.col("depth") == d + 1).select("node", "n_leaves", "saved_tokens")
        if above is not None:
            below = below.unionByName(above)
        sums = below.groupBy("node").agg(
            F.count(F.lit(1)).alias("n_children"),
            F.sum("n_leaves").alias("leaves"),
            F.sum("saved_tokens").alias("saved"),
        )
        level = heads[d].join(sums, "node", "left").join(
            digests.filter(F.col("depth") == d).select("node", "ends_sha256"), "node", "left"
        )
        own = (F.col("n_convs") - 1) * F.col("top_bytes")
        level = stored_scratch(
            level.select(
                F.col("node").alias("conv_id"),
                "depth",
                F.col("parent").alias("parent_conv_id"),
                "n_convs",
                F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
                F.coalesce("leaves", F.lit(1).cast("long")).alias("n_leaves"),
                (own + F.coalesce("saved", F.lit(0).cast("long"))).alias("saved_tokens"),
                F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
            ),
            "burst-heads",
        )
        results.append(level)
        above = level.select(F.col("parent_conv_id").alias("node"), "n_leaves", "saved_tokens")
    return all_of(results)
