import numpy as np
import pytest
from helpers import SF

from tillroll.llm.language import codewords, language_id


@pytest.mark.parametrize("n", [2, 3, 4, 6, 7, 20])
def test_codewords_differ_and_every_bit_splits_the_languages(n):
    code = codewords(n)
    assert len({tuple(r) for r in code}) == n
    assert (np.abs(code.sum(axis=0)) < n).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet")
    got = language_id(spark, docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    total = got.count()
    assert total > 150 and got.filter("lang = lang_pred").count() >= 0.95 * total
    assert got.filter("score < 0 OR score > 1").count() == 0


def test_edge_rows(spark):
    schema = "doc_id long, text string, lang string, held_out int, score int"
    rows = [(1, "the cat and the hat", "en", 0, 0), (3, "der Hund und die Katze", "de", 0, 0)] * 2
    rows += [(i, t, None, 9, 9) for i, t in enumerate([None, "", "12 + 3", "·¿ 12", "é", "a"], 20)]
    rows += [(None, "und der", "de", 0, 0), (41, "der und " * 50_000, None, 0, 0)]
    got = {r.doc_id: r for r in language_id(spark, spark.createDataFrame(rows, schema)).collect()}
    assert [got[i].lang_pred for i in range(20, 24)] == ["und"] * 4
    assert {got[24].lang_pred, got[25].lang_pred} <= {"de", "en"}
    assert got[41].lang_pred == "de" and got[None].held_out is False
    none = spark.createDataFrame([], schema)
    assert language_id(spark, none).count() == 0
    unlabelled = spark.createDataFrame([(1, "text", None, 0, 0)], schema)
    assert [tuple(r) for r in language_id(spark, unlabelled).collect()] == [(1, False, "und", 0.0, True)]
    one = spark.createDataFrame([(i, "text", "en", 0, 0) for i in range(3)], schema)
    assert {r.lang_pred for r in language_id(spark, one).collect()} == {"en"}
