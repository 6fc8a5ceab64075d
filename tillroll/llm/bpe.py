"""Byte-level BPE in numpy: length-bucketed padded matrices, one merge per row and round.

Each distinct pre-token is a row of token ids. Rows of like length share a padded matrix. Every
round looks up all neighbouring pairs in a hash table, merges each row's leftmost pair of minimum
rank, closes the gap, and drops rows that are done. Rows longer than ``WIDEST`` bytes would need as
many rounds as they have bytes; they are merged one by one with a heap instead, in the same order.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.pretokens import Encoder
from tillroll.llm.textarrays import give_back, mixed, runs

# Upper bounds of the length buckets, in bytes.
BUCKETS = (2, 4, 6, 8, 12, 16, 24, 32, 64, 128)
WIDEST = BUCKETS[-1]
# Pre-tokens a worker remembers at most, some 350 bytes each.
REMEMBERED = 150_000
NO_RANK = np.int32(2**31 - 1)
ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PairTable:
    """(left id, right id) -> rank of the token they form; open addressing in two arrays."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        self._bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        size = 1 << self._bits
        self._keys = np.full(size, -1, np.int64)
        self._ranks = np.full(size, NO_RANK, np.int32)
        place, left = self._home(keys), np.arange(len(keys))
        while len(left):
            # One key takes each free place, the others try the next one.
            spot = place[left]
            free = self._keys[spot] == -1
            _, one = np.unique(spot[free], return_index=True)
            taken = left[free][one]
            self._keys[place[taken]] = keys[taken]
            self._ranks[place[taken]] = ranks[taken]
            left = np.setdiff1d(left, taken, assume_unique=True)
            place[left] = (place[left] + 1) & (size - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys.astype(np.uint64)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of any shape; ``NO_RANK`` where a pair forms no token (or is padding)."""
        keys = (left.astype(np.int64) << 32) | (right.astype(np.int64) & 0xFFFFFFFF)
        keys = keys.ravel()
        out = np.full(keys.shape, NO_RANK, np.int32)
        open_ = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        place = self._home(keys[open_])
        while len(open_):
            found = self._keys[place]
            hit = found == keys[open_]
            out[open_[hit]] = self._ranks[place[hit]]
            on = ~hit & (found != -1)
            open_, place = open_[on], (place[on] + 1) & (len(self._keys) - 1)
        return out.reshape(left.shape)


class Vocabulary:
    """A rank file: token bytes by id, ids by token bytes, and the pairs that form a token."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ids = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.bytes_of = {rank: token for token, rank in self.ids.items()}
        self.single = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        keys, ranks = [], []
        for token, rank in self.ids.items():
            for cut in range(1, len(token)):
                a, b = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if a is not None and b is not None:
                    keys.append((a << 32) | b)
                    ranks.append(rank)
        self._keys, self._ranks = np.array(keys, np.int64), np.array(ranks, np.int32)
        self.pairs = PairTable(self._keys, self._ranks)

    @cached_property
    def rank_of_pair(self) -> dict[int, int]:
        """The pair table as a dictionary, for pieces merged one by one; made when one occurs."""
        return dict(zip(self._keys.tolist(), self._ranks.tolist(), strict=True))

    def encode(self, pieces: Sequence[bytes]) -> list[Sequence[int]]:
        """Ids of every piece. A piece that is a token is that token."""
        out: list[Sequence[int]] = [()] * len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        bucket = np.searchsorted(BUCKETS, lengths)
        whole = [self.ids.get(p) for p in pieces]
        for i, token in enumerate(whole):
            if token is not None:
                out[i] = (token,)
                bucket[i] = -1
            elif lengths[i] > WIDEST:
                out[i] = self._long(pieces[i])
        for b, width in enumerate(BUCKETS):
            rows = np.flatnonzero(bucket == b)
            for at in range(0, len(rows), 1 << 14):
                part = rows[at : at + (1 << 14)].tolist()
                for i, ids in zip(part, self._matrix([pieces[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def _matrix(self, pieces: list[bytes], width: int) -> list[list[int]]:
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        padded = b"".join(p.ljust(width, b"\0") for p in pieces)
        raw = np.frombuffer(padded, np.uint8).reshape(len(pieces), width)
        ids = self.single[raw]
        ids[np.arange(width) >= size[:, None]] = -1
        done: list[list[int]] = [[]] * len(pieces)
        row = np.arange(len(pieces))
        ranks = self.pairs.ranks(ids[:, :-1], ids[:, 1:]) if width > 1 else ids[:, :0]
        while len(row):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(row), np.int64)
            here = np.arange(len(row))
            best = ranks[here, at] if ranks.shape[1] else np.full(len(row), NO_RANK)
            ended = best == NO_RANK
            finished = zip(row[ended].tolist(), ids[ended].tolist(), size[ended].tolist(), strict=True)
            for k, merged, length in finished:
                done[k] = merged[:length]
            on = ~ended
            row, ids, ranks, size = row[on], ids[on], ranks[on], size[on]
            at, best, here = at[on], best[on], np.arange(int(on.sum()))
            if not len(row):
                break
            # The pair becomes one id; what is right of it moves left by one.
            w = ids.shape[1]
            source = np.arange(w - 1) + (np.arange(w - 1) > at[:, None])
            ids = np.take_along_axis(ids, source, axis=1)
            ids[here, at] = best
            size = size - 1
            source = np.arange(w - 2) + (np.arange(w - 2) > at[:, None])
            ranks = np.take_along_axis(ranks, source, axis=1)
            for side in (-1, 0):  # only the pairs with the new id have other ranks
                j = at + side
                ok = (j >= 0) & (j < w - 2)
                k, j = here[ok], j[ok]
                ranks[k, j] = self.pairs.ranks(ids[k, j], ids[k, j + 1])
        return done

    def _long(self, piece: bytes) -> list[int]:
        """One long piece: a heap of (rank, place) over a linked list."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank_of_pair
        heap = [
            (r, i, ids[i], ids[i + 1])
            for i in range(n - 1)
            if (r := rank.get((ids[i] << 32) | ids[i + 1])) is not None
        ]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (q := rank.get((ids[x] << 32) | ids[y])) is not None:
                    heapq.heappush(heap, (q, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class BpeEncoder(Encoder):
    """Remembers, for every pre-token, its ids as decimal text and the bytes they decode to."""

    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(path)
        self._decimal = {i: b"%d," % i for i in self.vocabulary.bytes_of}
        super().__init__(
            lambda pretokens: self.vocabulary.encode([p.encode() for p in pretokens]), REMEMBERED
        )

    def spell(self, pretoken: str, ids: Sequence[int]) -> tuple[bytes, bytes]:
        return b"".join([self._decimal[i] for i in ids]), self.vocabulary.decode(ids)


_encoders: dict[str, BpeEncoder] = {}


def bpe_encoder(path: str) -> BpeEncoder:
    """The worker's encoder for a rank file."""
    if path not in _encoders:
        _encoders[path] = BpeEncoder(path)
    return _encoders[path]


def encode_decode(docs: DataFrame, ranks: str) -> DataFrame:
    """Encode every whole text, decode the ids, and return digests of both per document.

    A null text is empty: no tokens, digests of nothing. Rows keep their ``doc_id`` even if it is
    null or repeated; other columns are not looked at.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe_encoder(ranks)
        for batch in batches:
            for run in runs(batch):
                texts = run.column("text").fill_null("").to_pylist()
                slots, per_text = encoder.slots(texts)
                counts = np.cumsum(np.append(0, encoder.lengths(slots)))
                ends = np.cumsum(per_text)
                n_tokens = counts[ends] - counts[ends - per_text]
                ids, decoded, at = [], [], 0
                pieces = slots.tolist()
                for end in ends.tolist():
                    own = [encoder.spelled[s] for s in pieces[at:end]]
                    spelled = b"".join([p[0] for p in own])
                    ids.append(hashlib.sha256(spelled[:-1]).hexdigest())
                    decoded.append(hashlib.sha256(b"".join([p[1] for p in own])).hexdigest())
                    at = end
                yield pa.record_batch(
                    [run.column("doc_id"), pa.array(n_tokens, pa.int64()), ids, decoded],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
        encoder.forget()  # the worker goes on to other tasks, maybe of other operators
        give_back()

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return wanted.mapInArrow(encode, ENCODED)
