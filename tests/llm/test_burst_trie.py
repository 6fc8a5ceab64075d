import hashlib
import random
import zlib

import pytest

from tillroll.llm.burst_trie import NODES, conversation_trie

SCHEMA = "conv_id long, turn int, role string, text string, node long, depth string, tid int, part double"


def brute(rows):
    original = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            original.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for turns in original.values():
        turns.sort()
    rebuilt = {}
    for c, turns in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        remainder = abs(c) % 5 * (1 if c >= 0 else -1)
        shared = original.get(c - remainder, [])[:h]
        rebuilt[c] = tuple((r, t) for _, _, r, t in [*shared, *turns[h:]])
    members = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children = {}
    for seq in members:
        if seq:
            children.setdefault(seq[:-1], []).append(seq)

    totals = {}
    for seq in sorted(members, key=len, reverse=True):
        saved = (len(members[seq]) - 1) * len(seq[-1][1].encode()) if seq else 0
        below = [totals[kid] for kid in children.get(seq, [])]
        totals[seq] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))

    out = []
    for seq, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if rebuilt[c] == seq)
        parent = min(members[seq[:-1]]) if seq else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(seq), parent, len(convs), len(children.get(seq, [])), *totals[seq], digest))
    return sorted(out, key=repr)


def found(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 0, "", 0, 0.0) for r in rows], SCHEMA).repartition(5)
    nodes = conversation_trie(spark, df, **kw)
    assert nodes.columns == NODES
    return sorted((tuple(r) for r in nodes.collect()), key=repr)


def made(n, seed=1, convs=None):
    draw = random.Random(seed)
    out = []
    for c in convs or range(n):
        kind = draw.random()
        for t in range(draw.randrange(1, 9)):
            if kind < 0.4 and t < 5:
                role, text = "user", f"common {t}"
            else:
                role, text = draw.choice([("user", f"é{draw.randrange(3)}"), ("bot", None), (None, "x y")])
            out.append((c, t, role, text))
    draw.shuffle(out)
    return out


@pytest.mark.parametrize("container", [1024, 25, 1])
def test_against_brute_force(spark, container):
    rows = made(160)
    assert found(spark, rows, container=container) == brute(rows)


def test_copies_of_a_conversation_burst_at_every_turn(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 2000, 5) for t in range(3)]
    rows += made(0, 2, range(1, 200, 3))
    assert found(spark, rows, container=60) == brute(rows)


def test_a_conversation_with_most_of_all_turns_spans_tasks(spark):
    rows = [(5, t, "user", f"turn {t % 300}") for t in range(700)] + made(40, 3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [r for r in rows if r[0] != 5 or (r[3] or "").startswith("turn")]
        assert found(spark, rows) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_nulls_ties_repeated_negative_and_empty(spark):
    rows = [(1, None, None, None), (1, 0, "user", "a"), (1, 0, "bot", "a"), (1, 0, "bot", "a")]
    rows += [(None, 0, "user", "nobody's"), (0, 3, "user", "late"), (0, None, "user", "early")]
    rows += [(-3, 0, "user", "a"), (-7, 0, "user", "b"), (-5, 0, "u", "c"), (-5, 1, "u", "c"), (2, 0, "u", "x" * 300_000)]
    for container in (1024, 2):
        assert found(spark, rows, container=container) == brute(rows)
    assert found(spark, [(None, 0, "user", "nobody's")]) == []
    assert found(spark, []) == []
