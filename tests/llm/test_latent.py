import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import SF, documents

from tillroll.llm import latent

DOCS, ITEMS = "doc_id long, text string, item_id int", "item_id long, text string"


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_subsequences_equal_dynamic_programming():
    rng = random.Random(1)
    for _ in range(500):
        a = tuple(rng.randrange(6) for _ in range(rng.randrange(1, 20)))
        b = [rng.randrange(6) for _ in range(rng.randrange(30))]
        assert latent.common_subsequence(a, b) == longest_common(a, b)


def prose(rng, n):
    return [rng.choice(["the", "of", "and", "a"]) if rng.random() < 0.4 else f"w{rng.randrange(5000)}" for _ in range(n)]


def planted(seed=3):
    """Documents with items as they are, with a tenth of the words changed, and without any."""
    rng = random.Random(seed)
    items = [(i, prose(rng, rng.choice((14, 30, 60, 150)))) for i in range(40)]
    docs, truth = [], set()
    for d in range(300):
        words = prose(rng, rng.randrange(100, 400))
        if d % 3 == 0:
            i, own = items[rng.randrange(len(items))]
            own = [w if rng.random() > 0.1 * (d % 2) else f"x{rng.randrange(99)}" for w in own]
            at = rng.randrange(len(words))
            words[at:at] = [w.upper() + rng.choice(["", ","]) for w in own]
            truth.add((d, i))
        docs.append((d, " ".join(words), 7))
    return docs, [(i, " ".join(w) + ".") for i, w in items], truth


@pytest.mark.parametrize("block", [2000, 15])
def test_planted_items_are_found_and_clean_documents_left_alone(spark, monkeypatch, block):
    monkeypatch.setattr(latent, "QUERIES", block)
    docs, items, truth = planted()
    df, benchmark = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    got = {(r.doc_id, r.item_id) for r in latent.benchmark_matches(spark, df, benchmark).collect()}
    assert len(got & truth) >= 0.97 * len(truth)
    assert got <= truth
    kept = latent.decontaminated(spark, df, benchmark)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, *_ in docs} - {d for d, _ in got}


def test_recall_of_exact_passages_of_the_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = {
        (d["doc_id"], r.item_id)
        for d in documents()
        for r in items.collect()
        if r.text in d["text"]
    }
    got = {(r.doc_id, r.item_id) for r in latent.benchmark_matches(spark, docs, items).collect()}
    assert len(want & got) >= 0.9 * len(want)


def test_answers_must_be_there(spark):
    rng = random.Random(9)
    question, answer = " ".join(prose(rng, 20)), "seven purple kites"
    items = spark.createDataFrame([(1, f"{question}? {answer}")], ITEMS)
    rows = [(1, f"so {question} {answer} it is", 0), (2, f"so {question} nobody knows", 0)]
    got = latent.benchmark_matches(spark, spark.createDataFrame(rows, DOCS), items)
    assert [r.doc_id for r in got.collect()] == [1]


def test_edge_rows(spark):
    docs, items, _ = planted()
    docs = docs[:30] + [(None, docs[0][1], 0), (400, None, 0), (401, "", 0), (402, "w1 " * 60_000, 0)] + docs[:1]
    df, benchmark = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items + items[:2], ITEMS)
    got = [r.doc_id for r in latent.benchmark_matches(spark, df, benchmark).collect()]
    assert got.count(0) == got.count(None) and {400, 401, 402}.isdisjoint(got)
    odd = spark.createDataFrame([(1, None), (None, "a b"), (2, ""), (3, "...")], ITEMS)
    for nothing in (odd, benchmark.limit(0)):
        assert latent.benchmark_matches(spark, df, nothing).count() == 0
        assert latent.decontaminated(spark, df, nothing).count() == len(docs)
    assert latent.benchmark_matches(spark, df.limit(0), benchmark).count() == 0


@pytest.mark.parametrize("count", [600, 2000])
def test_verbatim_items_are_found_however_large_the_benchmark(spark, count):
    rng = random.Random(5)
    # Passages of texts are the items, so the space's 128 dimensions are shared by all of them.
    texts = [prose(rng, 120) for _ in range(count)]
    items = [(i, " ".join(t[40 : 40 + rng.randrange(9, 60)])) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, " ".join(t), 0) for i, t in enumerate(texts)], DOCS)
    got = latent.benchmark_matches(spark, df, spark.createDataFrame(items, ITEMS)).collect()
    own = [r for r in got if r.doc_id == r.item_id]
    assert len(own) == count
    assert all(r.common_words == r.item_words and r.cosine > 0 for r in own)


def test_shared_runs_of_words_find_items_without_a_latent_space(spark, monkeypatch):
    monkeypatch.setattr(latent.Searcher, "_candidates", lambda *_: {})
    docs, items, truth = planted()
    df, benchmark = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    got = {(r.doc_id, r.item_id) for r in latent.benchmark_matches(spark, df, benchmark).collect()}
    assert {(d, i) for d, i in truth if d % 2 == 0} <= got <= truth


def test_paraphrases_without_a_shared_run_are_found_in_a_large_benchmark(spark):
    rng = random.Random(8)
    texts, items = [], []
    for i in range(2000):
        item = prose(rng, rng.randrange(30, 60))
        items.append((i, " ".join(item)))
        # Every fourth word is another: no run of eight words is left.
        own = [f"x{rng.randrange(9999)}" if k % 4 == 1 else w for k, w in enumerate(item)]
        text = prose(rng, 120)
        text[50:50] = own
        texts.append((i, " ".join(text), 0))
    df, benchmark = spark.createDataFrame(texts, DOCS), spark.createDataFrame(items, ITEMS)
    got = {(r.doc_id, r.item_id) for r in latent.benchmark_matches(spark, df, benchmark).collect()}
    assert sum((i, i) in got for i in range(2000)) >= 0.98 * 2000
    assert len(got) <= 2010


def test_the_space_is_fitted_on_every_document(spark, monkeypatch):
    monkeypatch.setattr(latent, "RANK", 2)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(10)]
    texts = [rng.choices(words, [1.5**i for i in range(10)], k=4) for _ in range(25_000)]
    df = spark.createDataFrame([(i, " ".join(t), 0) for i, t in enumerate(texts)], DOCS)
    items = spark.createDataFrame([(1, " ".join(words))], ITEMS)
    ((searcher,),) = latent.searchers(spark, df, items)
    column = {w: int(searcher.vocabulary.columns(latent.bare_words(pa.array([w]))[0])[0]) for w in words}

    def gram(rows):
        a = np.zeros((len(rows), len(words)))
        for own, row in zip(a, rows, strict=True):
            weights = [searcher.idf[column[w]] for w in row]
            for w, weight in zip(row, weights, strict=True):
                own[column[w]] += weight / np.sqrt(np.square(weights).sum())
        return a.T @ a

    corpus, item = gram(texts), gram([words])
    _, vectors = np.linalg.eigh(corpus + item * max(np.linalg.norm(corpus) / np.linalg.norm(item), 1))
    want = vectors[:, -2:] @ vectors[:, -2:].T
    space = searcher.weighted[:-1] / searcher.idf[:-1, None]
    assert np.abs(space @ space.T - want).max() < 1e-4


def test_windows_that_are_skipped_hold_no_match(spark, monkeypatch):
    docs, items, _ = planted(11)
    df, benchmark = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    got = {tuple(r) for r in latent.benchmark_matches(spark, df, benchmark).collect()}
    monkeypatch.setattr(latent.Searcher, "_can_match", lambda self, columns, *_: np.ones(len(columns), bool))
    all_windows = {tuple(r) for r in latent.benchmark_matches(spark, df, benchmark).collect()}
    assert {r[:4] for r in got} == {r[:4] for r in all_windows} and got
