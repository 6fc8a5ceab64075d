import base64
import hashlib

import pytest
from helpers import SF, documents, shingle_set, smallest_reachable
from test_bpe import RANKS

import corpus_pipeline
import tiktoken
from public_tokenizers import PATTERN
from tillroll.llm.kneser_ney import toxicity
from tillroll.llm.latent import COMMON, bare_words
from tillroll.llm.pii import base_spans
from tillroll.storage import stored_scratch
from test_latent import longest_common

import pyarrow as pa


def test_every_stage_equals_brute_force_on_what_its_predecessor_kept(spark):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r["doc_id"]: r for r in documents()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near-duplicates", "decontamination", "personal-data", "encoding"]

    def step(name, docs):
        found = stored_scratch(stages[name](spark, docs, SF), name)
        return found, {r["doc_id"]: r for r in map(lambda r: r.asDict(), found.collect())}

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = {r.doc_id: r.predicted for r in toxicity(spark, docs, labels).collect()}
    docs, kept = step("toxicity", docs)
    assert docs.columns == columns
    assert kept == {i: r for i, r in before.items() if not judged[i]}

    sets = {i: shingle_set(r["text"]) for i, r in kept.items()}

    def linked(a, b):
        x, y = sets[a], sets[b]
        return bool(x and y) and 100 * len(x & y) >= 75 * len(x | y)

    root = smallest_reachable(sets, linked)
    before = kept
    docs, kept = step("near-duplicates", docs)
    assert docs.columns == columns
    assert kept == {i: r for i, r in before.items() if root[i] == i}

    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = kept
    docs, kept = step("decontamination", docs)
    assert docs.columns == columns and kept.items() <= before.items()
    queries = [bare_words(pa.array([t]))[0].tolist() for t in items]
    for i, r in before.items():
        if any(t in r["text"] for t in items):
            assert i not in kept
        elif i not in kept:
            own = bare_words(pa.array([r["text"]]))[0].tolist()
            assert any(longest_common(q, own) >= COMMON * len(q) for q in queries)

    before = kept
    docs, kept = step("personal-data", docs)
    assert docs.columns == columns and set(kept) == set(before)
    for i, r in before.items():
        text, spans = r["text"], base_spans(r["text"])
        if not spans:
            assert kept[i]["text"] == text
        for s in spans:
            assert text[s.start : s.end] not in kept[i]["text"]
        assert kept[i]["n_chars"] == len(kept[i]["text"])

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    before = kept
    _, kept = step("encoding", docs)
    assert set(kept) == set(before)
    for i, r in before.items():
        ids = library.encode_ordinary(r["text"])
        assert kept[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert kept[i]["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_empty_tables_nulls_and_repeated_rows(spark, name, stage):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    assert stage(spark, spark.createDataFrame([], schema), SF).count() == 0
    rows = [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", None, None, None)]
    rows += [(3, "some plain words that say nothing", "en", "s", 33)] * 2
    found = [r.doc_id for r in stage(spark, spark.createDataFrame(rows, schema), SF).collect()]
    assert {None, 1, 2, 3} == set(found)


def test_stages_bound_the_batches_that_go_to_workers(spark):
    name, small = "spark.sql.execution.arrow.maxBytesPerBatch", corpus_pipeline.BATCH_BYTES // 2
    docs = spark.range(400, numPartitions=1).selectExpr("id AS doc_id", "repeat('some words ', 4000) AS text")

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], names=["n"])

    try:
        for before, most in ((None, corpus_pipeline.BATCH_BYTES), (str(small), small)):
            if before:
                spark.conf.set(name, before)
            corpus_pipeline.encode(spark, docs, SF)
            largest = max(r.n for r in docs.mapInArrow(sizes, "n long").collect())
            assert largest < most + 200_000
    finally:
        spark.conf.unset(name)
