import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from helpers import documents

from tillroll.llm import bpe
from tillroll.llm.pretokens import Encoder, split_points
from tillroll.llm.textarrays import span_hashes

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, n_tokens long"
PIECES = ["a", "s", "t", "r", "e", "'", "l", "v", "m", "d", " ", "  ", "\n", "\t", "\x1c", "\xa0", "　",
          "1", "٣", "!", "?", "é", "漢", "😀", "'s", "'re", "'ll", " '", "D", "the", " der"]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def random_texts(n, longest, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(longest))) for _ in range(n)]


def test_splitting_equals_the_regular_expression():
    pattern = regex.compile(public_tokenizers.PATTERN)
    for i in range(0, 12_000, 3):
        texts = random_texts(3, 14, i)
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        starts = np.cumsum([0, *map(len, texts)])
        first = split_points(points, starts).tolist()
        found = [joined[a:b] for a, b in zip(first, [*first, len(joined)][1:], strict=True)]
        assert found == [w for t in texts for w in pattern.findall(t)], texts


def test_every_text_is_encoded_as_by_the_library(spark, library):
    texts = [r["text"] for r in documents()] + random_texts(300, 60, 1)
    texts += ["", None, "ab" * 3000, "x" * 5000, " " * 3000, "\n" * 99, "<|endoftext|>", "é" * 700]
    rows = [(i, t, 0) for i, t in enumerate(texts)]
    got = bpe.encode_decode(spark.createDataFrame(rows, SCHEMA), RANKS).collect()
    assert len(got) == len(rows)
    for r in got:
        text = texts[r.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_words_that_defeat_polynomial_hashes_are_told_apart(spark, library):
    # Thue-Morse words and their complements: equal under any polynomial modulo a power of two.
    texts = [
        "".join(letters[bin(i).count("1") % 2] for i in range(1 << bits)) + tail
        for bits in (10, 12, 13)
        for tail in ("", "s", " x")
        for letters in ("ab", "ba", "éà", "àé")
    ]
    got = bpe.encode_decode(spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], SCHEMA).coalesce(1), RANKS)
    for r in got.collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_word_hashes_tell_structured_words_apart():
    words = [b"".join(p[bin(i).count("1") % 2] for i in range(1 << bits)) for bits in range(13) for p in ((b"a", b"b"), (b"b", b"a"))]
    words += [b"a" * n for n in range(2, 300)] + [b"\0" * n for n in range(1, 40)] + [b"x" + bytes(n) for n in range(30)]
    words = sorted(set(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    begin = end - [len(w) for w in words]
    hashes = span_hashes(data, begin, end)
    assert len(set(hashes.tolist())) == len(words)
    # The same bytes elsewhere have the same hash.
    again = span_hashes(np.append(np.uint8(7), data), begin + 1, end + 1)
    assert (again == hashes).all()


def test_the_matrix_and_the_heap_merge_alike(library):
    vocabulary = bpe.Vocabulary(RANKS)
    rng = random.Random(2)
    pieces = ["".join(rng.choice("abcderéñ ") for _ in range(rng.randrange(1, 120))).encode() for _ in range(300)]
    pieces += [bytes(rng.randrange(256) for _ in range(rng.randrange(1, 100))) for _ in range(200)]
    for piece, ids in zip(pieces, vocabulary.encode(pieces), strict=True):
        assert vocabulary.decode([int(i) for i in ids]) == piece
        if piece not in vocabulary.ids:
            assert list(ids) == vocabulary._long(piece)


def test_memory_is_emptied_and_refilled():
    calls = []
    memory = Encoder(lambda words: calls.append(len(words)) or [[len(w)] for w in words], limit=5)
    for text in ("a bb ccc", "dddd eeeee", "a bb", "f gg hhh iiii jjjjj kkkkkk"):
        slots, per_text = memory.slots([text])
        assert memory.ids(slots).tolist() == [len(w) + (i > 0) for i, w in enumerate(text.split())]
        assert per_text.tolist() == [len(text.split())]
    assert calls == [3, 2, 0, 6] or calls == [3, 2, 2, 6]


def test_no_rows_and_null_ids(spark):
    assert bpe.encode_decode(spark.createDataFrame([], SCHEMA), RANKS).count() == 0
    rows = [(None, "a b", 1), (None, "a b", 1)]
    got = bpe.encode_decode(spark.createDataFrame(rows, SCHEMA), RANKS).collect()
    assert [(r.doc_id, r.n_tokens) for r in got] == [(None, 2)] * 2
