import hashlib
import random

import pytest
from helpers import documents

from tillroll.llm.content_sort import BLANKS, exact_duplicates

SCHEMA = "doc_id long, text string, part int, run string, digest int, norm double"


def brute(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault("".join(c for c in text or "" if c not in BLANKS), []).append((i, text or ""))
    out = []
    for norm, members in groups.items():
        members.sort(key=lambda m: (-len(m[1]), m[0] is None, m[0]))
        digest = hashlib.sha256(norm.encode()).hexdigest()
        out += [(i, members[0][0], len(members), k == 0, digest) for k, (i, _) in enumerate(members)]
    return sorted(out, key=repr)


def found(spark, rows, partitions=7, **kw):
    df = spark.createDataFrame([(*r, 0, "x", 1, 1.0) for r in rows], SCHEMA).repartition(partitions)
    return sorted((tuple(r) for r in exact_duplicates(spark, df, **kw).collect()), key=repr)


def test_documents_with_copies_and_blanks(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents()]
    rows += [(5000 + i, t.replace(" ", "\n ")) for i, t in rows[:40]]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("held_back", [2, 100_000])
def test_a_group_of_a_third_of_all_rows_spans_tasks(spark, held_back):
    draw = random.Random(3)
    rows = [(i, "the same text " + " " * draw.randrange(3)) for i in range(400)]
    rows += [(1000 + i, f"text {draw.randrange(300)}") for i in range(800)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert found(spark, rows, held_back=held_back) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_common_beginning_does_not_hide_differences(spark):
    rows = [(i, "licence " * 50 + str(i % 70)) for i in range(300)] + [(i + 300, "licence " * i) for i in range(60)]
    assert found(spark, rows) == brute(rows)


def test_nulls_empty_ties_repeated_and_long(spark):
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (None, "a b"), (None, "a b"), (4, "ab"), (5, "a b")]
    rows += [(6, "word " * 100_000), (7, "word\n" * 100_000), (8, "a b"), (8, "a b"), (None, None)]
    assert found(spark, rows, 3) == brute(rows)
    assert found(spark, [(None, "only")] * 3, 2) == brute([(None, "only")] * 3)
    assert found(spark, [], 1) == []
