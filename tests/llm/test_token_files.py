import hashlib
import json
import zlib

import numpy as np
import public_tokenizers
from helpers import documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm.token_files import (
    open_ids,
    read_token_files,
    splits_as_known,
    token_files,
    write_token_files,
)

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, start int, part int"


def expected(rows):
    library, out, base = Tokenizer.from_file(PATH), [], 0

    def place(row):
        return (row[0] is None, row[0] or 0, hashlib.sha256((row[1] or "").encode()).digest())

    for i, text in sorted(rows, key=place):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((i, base, len(ids), zlib.crc32(ids.tobytes())))
        base += len(ids)
    return out


def test_files_hold_what_the_library_encodes_in_order(spark):
    rows = [(r["doc_id"] * 7 % 1009, r["text"]) for r in documents()]
    rows += [(5000, None), (5001, ""), (5002, "a <|endoftext|> b"), (5003, "word " * 30_000)]
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA).repartition(5)
    got = sorted(tuple(r) for r in token_files(spark, df, PATH).collect())
    assert got == expected(rows)


def test_manifest_and_files_agree_and_left_over_files_do_no_harm(spark, tmp_path):
    folder = str(tmp_path / "files")
    df = spark.createDataFrame([(i, f"text number {i}", 0, 0) for i in range(40)], SCHEMA)
    manifest = write_token_files(df.repartition(4), PATH, folder)
    (tmp_path / "files" / "000000-attempt.bin").write_bytes(b"left by a task that was lost")
    rows = manifest.orderBy("part").collect()
    base = 0
    for r in rows:
        ids, offsets, keys = open_ids(folder, r.name, r.n_docs, r.n_tokens)
        assert r.base == base and len(ids) == r.n_tokens == offsets[-1]
        assert ids.dtype == np.dtype("<u2") and (np.diff(keys) > 0).all()
        base += r.n_tokens
    assert read_token_files(manifest, folder).agg(F.sum("n_tokens")).first()[0] == base


def test_no_rows_repeated_and_nameless_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert token_files(spark, none, PATH).count() == 0
    rows = [(3, "same"), (3, "same"), (3, "another"), (None, "nameless"), (None, None), (None, "b"), (7, "z")]
    for partitions in (1, 4):
        df = spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA).repartition(partitions)
        got = [tuple(r) for r in token_files(spark, df, PATH).collect()]
        assert sorted(got, key=lambda r: r[1]) == expected(rows)


def thue_morse(bits, flip):
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(1 << bits))


def test_words_that_defeat_polynomial_hashes_keep_their_ids(spark):
    texts = [thue_morse(bits, flip) + tail for bits in (10, 11) for tail in ("", "c") for flip in (0, 1)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA).coalesce(1)
    got = sorted(tuple(r) for r in token_files(spark, df, PATH).collect())
    assert got == expected(rows)
    assert len({r[3] for r in got}) == len(rows)


def test_a_tokenizer_that_normalises_or_splits_otherwise_gets_whole_texts(spark, tmp_path):
    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    rows = [(1, "Some TEXT, Here"), (2, "it's 12345 a"), (3, None)]
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA)
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}}):
        path = tmp_path / f"{len(list(tmp_path.iterdir()))}.json"
        path.write_text(json.dumps(spec | change))
        assert not splits_as_known(str(path)) and splits_as_known(PATH)
        library, base = Tokenizer.from_file(str(path)), 0
        got = sorted(tuple(r) for r in token_files(spark, df, str(path)).collect())
        for (i, text), row in zip(rows, got, strict=True):
            ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
            assert row == (i, base, len(ids), zlib.crc32(ids.tobytes()))
            base += len(ids)
