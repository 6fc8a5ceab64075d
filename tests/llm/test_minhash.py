import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, shingle_set, smallest_reachable
from pyspark.sql import functions as F

from tillroll.llm import minhash
from tillroll.llm.components import components
from tillroll.llm.joins import likely_rows, unlikely_rows
from tillroll.llm.textarrays import utf8

SCHEMA = "doc_id long, text string"


def expected(rows):
    sets = {i: shingle_set(t) for i, t in rows if i is not None}

    def linked(a, b):
        x, y = sets[a], sets[b]
        return bool(x and y) and 100 * len(x & y) >= 75 * len(x | y)

    root = smallest_reachable(sets, linked)
    return sorted((i, len(sets[i]), root[i], root[i] == i) for i in sets)


def found(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    return sorted(tuple(r) for r in minhash.near_duplicates(spark, df).collect())


def changed(words, share, rng):
    return [rng.choice("abcdefgh") * 3 + str(rng.random()) if rng.random() < share else w for w in words]


def corpus():
    """Copies, near copies on both sides of the threshold, chains, a shared passage."""
    rng = random.Random(5)
    rows, passage = [], [f"p{i}" for i in range(60)]
    for group in range(12):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice((3, 6, 40, 200)))]
        for copy in range(rng.randrange(1, 14)):
            words = base if copy % 4 == 0 else changed(base, rng.choice((0.01, 0.02, 0.03, 0.05)), rng)
            if group % 3 == 0:
                words = words[:50] + passage + words[50:]
            rows.append((" " if copy % 2 else "\n").join(words).upper())
            if copy % 3 == 0:
                base = words
    return [(i * 3, t) for i, t in enumerate(rows)]


def test_components_equal_brute_force_with_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    rows = corpus()
    assert found(spark, rows) == expected(rows)


def test_the_documents_table_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents()]
    assert found(spark, rows) == expected(rows)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "One  TWO"), (6, "x " * 50_000)]
    got = found(spark, rows)
    assert got == expected(rows)
    # Without an id a row is kept and linked with nothing; repeated rows are all returned.
    df = spark.createDataFrame([(None, "one two"), (4, "one two"), (4, "one two")], SCHEMA)
    got = sorted((tuple(r) for r in minhash.near_duplicates(spark, df).collect()), key=str)
    assert got == [(4, 1, 4, True), (4, 1, 4, True), (None, 1, None, True)]


def test_an_id_with_different_texts_names_several_documents(spark):
    words = [f"w{i}" for i in range(40)]
    a, b = " ".join(words), " ".join(f"v{i}" for i in range(40))
    near = " ".join([*words, "more"])
    rows = [(1, a), (1, b), (1, b), (2, near), (0, b.upper()), (3, ""), (3, None), (3, "v0 v1"), (None, a)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((tuple(r) for r in minhash.near_duplicates(spark, df).collect()), key=repr)
    want = [(1, 36, 1, True), (1, 36, 0, False), (1, 36, 0, False), (2, 37, 1, False), (0, 36, 0, True)]
    want += [(3, 0, 3, True), (3, 0, 3, True), (3, 1, 3, True), (None, 36, None, True)]
    assert got == sorted(want, key=repr)
    kept = minhash.one_of_each_group(spark, df).collect()
    texts = sorted(((r.doc_id, r.text or "") for r in kept), key=repr)
    # Both texts of document 1's id are there, through one row each; an empty one once.
    assert texts == sorted([(1, a), (0, b.upper()), (3, ""), (3, "v0 v1"), (None, a)], key=repr)


def test_no_rows_and_clashing_columns(spark):
    assert found(spark, []) == []
    names = ["component_id", "bucket", "rep", "text", "doc_id", "signature", "a"]
    df = spark.createDataFrame([(7, 7, 7, "a b c d e f", 1, 7, 7), (8, 8, 8, "a b c d e f", 2, 8, 8)], names)
    got = minhash.one_of_each_group(spark, df)
    assert got.columns == names
    assert [tuple(r) for r in got.collect()] == [(7, 7, 7, "a b c d e f", 1, 7, 7)]


def test_every_pair_within_the_signature_distance_meets_in_a_bucket(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**32, minhash.SLOTS, dtype=np.uint64)
    rows = []
    for i in range(200):
        slots = base.copy()
        wrong = rng.choice(minhash.SLOTS, minhash.SLOT_ERRORS, replace=False)
        slots[wrong] = rng.integers(0, 2**32, minhash.SLOT_ERRORS)
        rows.append((i, bytearray(slots.astype("<u4").tobytes() + bytes(minhash.SKETCH))))
    rows.append((999, bytearray(base.astype("<u4").tobytes() + bytes(minhash.SKETCH))))
    b = minhash.buckets(spark.createDataFrame(rows, "rep long, signature binary"))
    target = b.filter("rep = 999").select("bucket")
    assert b.join(target, "bucket", "left_semi").select("rep").distinct().count() == 201


def test_shingle_counts_per_text():
    texts = ["a b c d e", "a a a a a a a a", "", None, "A b", "a\x0bb c d e f"]
    _, counts = minhash.shingles(*utf8(pa.array(texts)))
    assert counts.tolist() == [len(shingle_set(t)) for t in texts]


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    links = {(rng.randrange(120), rng.randrange(120)) for _ in range(70)}
    links |= {(i, i + 1) for i in range(200, 260)}
    df = spark.createDataFrame(list(links), "a long, b long")
    nodes = {n for a, b in links if a != b for n in (a, b)}
    both = links | {(b, a) for a, b in links}
    got = {r.node: r.component for r in components(df).collect()}
    assert got == smallest_reachable(nodes, lambda a, b: (a, b) in both)
    assert components(df.filter(F.lit(False))).count() == 0


def test_texts_of_ids_that_lose_no_row_are_not_shuffled(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(40))) for i in range(400)]
    near = [f"w{i}" for i in range(60)]
    rows += [(1000 + i, " ".join([*near, f"x{i}"])) for i in range(20)]
    rows += [rows[3]] * 2 + [(5, "another text of one id"), (7, ""), (None, "no id"), (None, "no id")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = minhash.one_of_each_group(spark, spark.createDataFrame(rows, SCHEMA))
        found = sorted((tuple(r) for r in got.collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = [r for r in set(rows) if r[0] is not None and r[0] <= 1000] + [(None, "no id")] * 2
    assert found == sorted(want, key=repr)
    # The three rows of document 3, and what the filter lets through by chance.
    assert 3 <= shuffled_texts(got) < 10


def shuffled_texts(df):
    """Rows with a text that the shuffles of a computed frame have written."""

    def of(node):
        inner = {"AdaptiveSparkPlan": "executedPlan"}
        inner |= {f"{kind}QueryStage": "plan" for kind in ("Shuffle", "Broadcast", "Result")}
        name = node.nodeName()
        if name in inner:
            return of(getattr(node, inner[name])())
        columns, children = node.output(), node.children()
        written = 0
        if name == "Exchange" and "text" in [columns.apply(i).name() for i in range(columns.size())]:
            written = node.metrics().get("shuffleRecordsWritten").get().value()
        return written + sum(of(children.apply(i)) for i in range(children.size()))

    return of(df._jdf.queryExecution().executedPlan())


def test_rows_are_parted_by_their_keys(spark):
    rows = spark.range(2000).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    keys = spark.createDataFrame([(i,) for i in range(0, 4000, 3)], "k long")
    likely = {r.v for r in likely_rows(rows, keys, "k").collect()}
    others = {r.v for r in unlikely_rows(rows, keys, "k").collect()}
    assert not likely & others and likely | others == set(range(2000))
    assert {v for v in range(0, 2000, 3) if v % 10} <= likely
    assert len(likely) < 700
    none = keys.limit(0)
    assert unlikely_rows(rows, none, "k").count() == 2000 and likely_rows(rows, none, "k").count() == 0
