import random
import zlib

import numpy as np
import pyarrow as pa
from helpers import SF

from tillroll.llm import kneser_ney as kn

SCHEMA = "doc_id long, text string, score int, whole int"
LARGER = SF.replace("0.001", "0.1")


def made_up(n, share, seed=0):
    """Prose in which some documents hold insults, and their labels."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [f"w{int(rng.paretovariate(0.7)) % 3000}" for _ in range(rng.randrange(30, 200))]
        toxic = int(rng.random() < share)
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["blah", "meh", "ugh"]))
        docs.append((i, " ".join(words), 0, 0))
        labels.append((i, 1, toxic))
    return docs, labels


def test_held_out_accuracy_of_the_labelled_documents(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    got = kn.toxicity(spark, docs, labels).join(labels, "doc_id").filter("held_out").collect()
    right = np.mean([r.toxic == r.predicted for r in got])
    common = np.mean([r.toxic == 0 for r in got])
    print("held out", len(got), right, common)
    assert right > common + 0.03
    # No ordinary document of the held-out labels is called toxic without reason.
    assert np.mean([r.predicted for r in got if r.toxic == 0]) < 0.03


def test_insults_are_learned_and_clean_rows_are_kept(spark):
    docs, labels = made_up(1500, 0.2)
    df = spark.createDataFrame(docs, SCHEMA)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in kn.toxicity(spark, df, known).collect()}
    held = [i for i in got if got[i].held_out]
    truth = {i: t for i, _, t in labels}
    assert np.mean([got[i].predicted == truth[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = kn.ordinary(spark, df, known)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in got if not got[i].predicted}


def test_edge_rows(spark):
    docs, labels = made_up(600, 0.3, seed=1)
    docs += [(900, None, 0, 0), (901, "", 0, 0), (902, "...", 0, 0), (903, "w1 " * 50_000, 0, 0), (None, "blah", 0, 0)]
    docs += docs[:2]
    df = spark.createDataFrame(docs, SCHEMA)
    known = spark.createDataFrame(labels + labels[:3] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    got = kn.toxicity(spark, df, known)
    assert got.count() == len(docs)
    rows = {r.doc_id: r for r in got.collect()}
    assert len({rows[i].score for i in (900, 901, 902)}) == 1 and rows[900].predicted == 0
    assert rows[None].held_out is False
    assert kn.toxicity(spark, df.limit(0), known).count() == 0
    for nothing in (known.limit(0), known.filter("toxic = 0")):
        assert {(r.score, r.predicted) for r in kn.toxicity(spark, df, nothing).collect()} == {(0.0, 0)}
        assert kn.ordinary(spark, df, nothing).count() == len(docs)


def test_shared_counts_are_distinct_contexts_over_all_documents(spark):
    texts = [(i, f"c{i} rare c{i} c{i % 3} often") for i in range(400)]
    counts = kn.shared_counts(spark.createDataFrame(texts, "doc_id long, text string").repartition(3))
    _, words, _, _ = kn.bigrams(pa.record_batch([pa.array(["rare often c1"])], names=["text"]))
    rare, often, _ = kn.word_slot(words)
    assert 150 < counts[rare] < 800 and 2 <= counts[often] <= 5


def test_every_learned_bigram_keeps_its_ratio(spark, monkeypatch):
    # Once bigrams had 2 ** PAIR_BITS slots and the lighter one of two in a slot was lost.
    monkeypatch.setattr(kn, "PAIR_BITS", 6, raising=False)
    texts = [(f"a{i % 30} b{i % 4}", i % 2) for i in range(400)]
    model = kn.fit_counts(spark.createDataFrame(texts, "text string, label int"), np.zeros(1 << kn.WORD_BITS))
    _, _, pairs, _ = kn.bigrams(pa.record_batch([pa.array([t for t, _ in texts])], names=["text"]))
    assert not np.isnan(model.pair.of(pairs, np.full(len(pairs), np.nan, np.float32))).any()


def test_every_labelled_document_outside_the_folds_is_learned_from_once(spark, monkeypatch):
    # Once the larger class was cut to the size of the smaller one, and both to PER_CLASS.
    docs, labels = made_up(800, 0.1, seed=2)
    df = spark.createDataFrame(docs + docs[:40], SCHEMA)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    learned = []

    def fit_counts(labelled, shared, fit=kn.fit_counts):
        learned.extend((r.doc_id, r.label) for r in labelled.select("doc_id", "label").collect())
        return fit(labelled, shared)

    monkeypatch.setattr(kn, "fit_counts", fit_counts)
    assert kn.fit(df, known) is not None
    wanted = [(i, t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 not in (kn.HELD_OUT, kn.CALIBRATION)]
    assert sorted(learned) == sorted(wanted)


def test_bigrams_of_one_slot_share_a_correction(spark, monkeypatch):
    monkeypatch.setattr(kn, "PAIR_BITS", 1)
    texts = [(f"a{i % 30} b{i % 4}", i % 2) for i in range(400)]
    model = kn.fit_counts(spark.createDataFrame(texts, "text string, label int"), np.zeros(1 << kn.WORD_BITS))
    _, _, pairs, _ = kn.bigrams(pa.record_batch([pa.array([t for t, _ in texts])], names=["text"]))
    assert 1 <= len(set(model.pair.of(pairs, np.zeros(len(pairs), np.float32)).tolist())) <= 2
