import random
import re

import numpy as np
import pytest

from tillroll.llm import divergence
from tillroll.llm.divergence import source_divergence
from tillroll.llm.transducer import LEAD, Transducer, Walker, build

SCHEMA = "doc_id long, text string, lang string, source string, term string, ord long, n int"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs):
    groups, docs_with = {}, {}
    for text, lang, source in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = TERM.findall(lowered)
        groups.setdefault(lang or "", {}).setdefault(source or "", []).extend(terms)
        for t in set(terms):
            docs_with[lang or "", t] = docs_with.get((lang or "", t), 0) + 1
    out = []
    for lang, sources in groups.items():
        kept = sorted((t for (x, t), n in docs_with.items() if x == lang and n >= min_docs), key=str.encode)

        def shares(found, kept=kept):
            counts = {t: 0 for t in kept}
            for t in found:
                if t in counts:
                    counts[t] += 1
            total = sum(counts.values())
            return counts, {t: 1 + 10**9 * (c + 2) // (total + 2 * len(kept)) for t, c in counts.items()}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        by_source = {s: shares(found) for s, found in sources.items()}
        whole = shares([t for found in sources.values() for t in found])[1]
        for s, (counts, p) in by_source.items():
            pairs = [(-sum(f(p[t], q[t]) for t in kept), o.encode()) for o, (_, q) in by_source.items() if o != s]
            terms = [(-f(p[t], whole[t]), t.encode()) for t in kept if counts[t] and p[t] > whole[t]]
            for part, ranked in (("pair", sorted(pairs)), ("term", sorted(terms)[:10])):
                out += [(lang, s, part, i.decode(), -v, k) for k, (v, i) in enumerate(ranked, 1)]
    return sorted(out)


def found(spark, rows, partitions=4, **kw):
    df = spark.createDataFrame([(1, *r, "x", 0, 0) for r in rows], SCHEMA).repartition(partitions)
    return sorted(tuple(r) for r in source_divergence(spark, df, **kw).collect())


def made(n, seed=5):
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcÉß漢é") for _ in range(draw.randrange(1, 6))) for _ in range(300)]
    out = []
    for _ in range(n):
        lang = draw.choice(["en", "de", None])
        source = f"s{draw.randrange(9)}" if draw.random() < 0.6 else draw.choice(["hot", None])
        chosen = [words[min(299, int(draw.expovariate(0.02)))] for _ in range(draw.randrange(40))]
        out.append((draw.choice([" ", ", ", "\x7f", "0"]).join(chosen), lang, source))
    return out


def test_against_brute_force(spark):
    rows = made(400)
    assert found(spark, rows, min_docs=5) == brute(rows, 5)


def test_shards_passes_and_tiles_do_not_matter(spark, monkeypatch):
    rows = made(300, 6)
    monkeypatch.setattr(divergence, "SOURCES", 3)
    monkeypatch.setattr(divergence, "ORDINALS", 16)
    assert found(spark, rows, min_docs=3, shard_terms=7, block_bytes=20_000) == brute(rows, 3)


def test_nulls_ties_long_texts_and_empty_tables(spark):
    rows = [(None, None, None), ("", "en", "a"), ("1 2 3", "en", "b"), ("Aa aA", "xx", "only")]
    rows += [("same words here", "fr", s) for s in "abab"] * 5 + [("word " * 60_000, "fr", "c")] * 10
    assert found(spark, rows, min_docs=10) == brute(rows, 10)
    assert found(spark, [], 1) == []


@pytest.mark.parametrize("cut", [1, 10, 5000])
def test_a_transducer_gives_every_term_its_place(cut):
    draw = random.Random(cut)
    terms = sorted({"".join(draw.choice("abéß漢") for _ in range(draw.randrange(1, 14))).encode() for _ in range(3000)})
    leads, bases, shards = [], [], []
    for i, t in enumerate(terms):
        if not leads or (i - bases[-1] >= cut and t[:LEAD] != terms[i - 1][:LEAD]):
            leads.append(t[:LEAD])
            bases.append(i)
    for a, b in zip(bases, [*bases[1:], len(terms)], strict=True):
        shards.append(Transducer.unpack(build(terms[a:b]).pack()))
    others = [t[:-1] for t in terms if len(t) > 1] + [t + b"a" for t in terms] + [b"z", b"a", b"\xff"]
    spans = terms + others
    data, end = np.frombuffer(b"".join(spans), np.uint8), np.cumsum([len(t) for t in spans])
    got = Walker(leads, bases, shards).ordinals(data, end - [len(t) for t in spans], end)
    place = {t: i for i, t in enumerate(terms)}
    assert got.tolist() == [place.get(t, -1) for t in spans]


def test_states_with_the_same_future_are_one():
    built = build([b"baking", b"being", b"taking", b"tying"])
    # b(a|e) and t(a|y) lead into shared endings: "king" and "ing" share "ing".
    futures = set()
    for word in (b"baking", b"being", b"taking", b"tying"):
        for k in range(len(word) + 1):
            rest = frozenset(w[k:] for w in (b"baking", b"being", b"taking", b"tying") if w[:k] == word[:k])
            futures.add(rest)
    assert len(built.degree) == len(futures)
