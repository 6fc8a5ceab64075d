import math
import random

import numpy as np
import pytest
from helpers import SF, smallest_reachable

from tillroll.llm import grid_order

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows):
    """n_links and component of every id, by comparing all pairs."""
    good = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = np.array(v, np.float32).astype(float)
        if v.any():
            good[i] = (label, v / np.linalg.norm(v))

    def linked(a, b):
        (la, x), (lb, y) = good[a], good[b]
        return la == lb and len(x) == len(y) and float(x @ y) >= 0.98

    root = smallest_reachable(good, linked)
    count = {a: sum(a != b and linked(a, b) for b in good) for a in good}
    ids = [r[0] for r in rows]
    return sorted((i, count.get(i, 0), root.get(i, i), root.get(i, i) == i) for i in ids if i is not None)


def found(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    return sorted(tuple(r) for r in grid_order.near_vectors(spark, df).collect())


@pytest.mark.parametrize("block", [8, 64])
def test_equals_brute_force_with_small_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(grid_order, "BLOCK", block)
    monkeypatch.setattr(grid_order, "LEAF", 4)
    rng = np.random.default_rng(1)
    rows = []
    for group in range(25):
        base = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 14))):
            v = base + rng.normal(size=16) * rng.choice([0, 0.03, 0.08, 0.15])
            rows.append((len(rows), [float(x) for x in v * rng.choice([1, 2])], group % 3))
    random.Random(3).shuffle(rows)
    assert found(spark, rows) == expected(rows)


def test_the_embeddings_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]
    got = sorted(tuple(r) for r in grid_order.near_vectors(spark, df).collect())
    assert got == expected(rows)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1),
        (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [], 1),
        (11, [1.0], 1), (12, [1.0, 0.0, 0.0], 1), (13, [-1.0, 0.0], 1), (14, [1e38, 1e30], 1),
    ]
    assert found(spark, rows) == expected(rows)
    twice = [rows[0], rows[0], rows[1], (None, [1.0, 0.0], 1)]
    got = grid_order.near_vectors(spark, spark.createDataFrame(twice, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == [
        (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (None, 0, None, True),
    ]
    assert found(spark, []) == []
