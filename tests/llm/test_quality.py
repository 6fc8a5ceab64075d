import numpy as np
import pyarrow as pa
from helpers import SF

from tillroll.llm.quality import STATISTICS, quality, rules_of, statistics

LARGER = SF.replace("0.001", "0.1")


def test_held_out_accuracy_beats_the_commoner_label(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    got = quality(spark, docs, labels).join(labels, "doc_id").filter("held_out")
    rows = got.select("quality", "predicted", "score").collect()
    right = np.mean([r.quality == r.predicted for r in rows])
    common = np.mean([r.quality == 1 for r in rows])
    print("held out", len(rows), right, common)
    assert right > max(common, 1 - common) + 0.05
    assert all(0 <= r.score <= 1 for r in rows)


def test_statistics_of_small_texts():
    texts = ["Aa aa b.\nx | 1\nx | 1", "", None, "\n\n", "é"]
    got = dict(zip(STATISTICS, statistics(pa.record_batch([pa.array(texts)], names=["text"])), strict=True))
    n_words = np.round(np.expm1(got["log_words"]))
    assert n_words.tolist() == [9, 0, 0, 0, 1]
    assert np.allclose(got["distinct_words"], [5 / 9, 0, 0, 0, 1])
    assert np.allclose(got["commonest_word"], [2 / 9, 0, 0, 0, 1])
    assert np.allclose(got["repeated_words"], [1 / 9, 0, 0, 0, 0])
    assert np.allclose(got["distinct_lines"], [2 / 3, 0, 0, 1 / 2, 1])
    assert all(got[s][1] == got[s][2] == 0 for s in STATISTICS)


def test_rules_are_the_paths_of_a_tree():
    tree = """DecisionTree
  If (feature 0 <= 1.5)
   Predict: 0.0
  Else (feature 0 > 1.5)
   If (feature 2 <= -0.5)
    Predict: 0.0
   Else (feature 2 > -0.5)
    Predict: 1.0
"""
    a, c = STATISTICS[0], STATISTICS[2]
    assert rules_of(tree) == [
        ((a, "<=", 1.5),),
        ((a, ">", 1.5),),
        ((a, ">", 1.5), (c, "<=", -0.5)),
        ((a, ">", 1.5), (c, ">", -0.5)),
    ]


def test_edge_rows(spark):
    docs = [(1, None, 0, 0), (2, "", 0, 0), (2, "", 0, 0), (None, "a b", 0, 0), (4, "x " * 60_000, 0, 0)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, score int, label int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality(spark, docs, none)
    assert [r.score for r in got.collect()] == [0.5] * 5
    assert quality(spark, docs.limit(0), none).count() == 0
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, None), (4, None, 1), (None, 1, 1), (1, 1, 0)], none.schema)
    assert quality(spark, docs, labels).count() == 5
