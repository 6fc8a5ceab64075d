"""Byte-level pre-tokens of whole texts as arrays, each distinct one encoded once per worker.

Splitting follows the usual byte-level pattern: contractions, an optional space with letters,
digits or other signs, and white space. The pattern is applied to all code points of a run of
texts at once; `tests/llm` holds it against the regular expression itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
import regex

# The white space of the pattern's \s, as code point ranges.
WHITE_SPACE = (
    (0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
)
# The pattern's contractions after the apostrophe.
SHORT, LONG = ("s", "t", "m", "d"), ("re", "ve", "ll")
SPACE, LETTER, DIGIT, OTHER = range(4)
# Code points of remembered pre-tokens at which a worker's memory is emptied.
REMEMBERED_TEXT = 16 << 20


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Class of every code point."""
    kind = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for number, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+")):
        for match in regex.finditer(pattern, every):
            points = np.frombuffer(match[0].encode("utf-32-le"), np.uint32)
            kind[points] = number
    for low, high in WHITE_SPACE:
        kind[low : high + 1] = SPACE
    return kind


def split_points(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of all texts begin; ``starts`` closes with the number of points."""
    n = len(points)
    if n == 0:
        return np.empty(0, np.int64)
    kind = _kinds()[points]
    text_first = np.zeros(n + 1, bool)
    text_first[starts] = True
    run_first = text_first[:n].copy()
    run_first[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    # Within a text, does a sign other than white space follow?
    before_sign = np.zeros(n, bool)
    before_sign[:-1] = ~space[1:] & ~text_first[1:n]
    after_blank = np.zeros(n, bool)
    after_blank[1:] = (points[:-1] == 32) & ~text_first[1:n]
    first = np.where(space, run_first | before_sign, run_first & ~after_blank)
    # Contractions: an apostrophe that begins a pre-token takes its letters with it.
    for i in np.flatnonzero((points == 39) & first):
        tail = "".join(map(chr, points[i + 1 : i + 3]))
        taken = 1 if tail[:1] in SHORT and tail else 2 if tail in LONG else 0
        if not taken or text_first[i + 1 : i + 1 + taken].any():
            continue
        first[i + 1] = False
        rest = i + 1 + taken
        if rest < n and kind[rest] == LETTER and not text_first[rest]:
            first[rest] = True
    return np.flatnonzero(first)


class Encoder:
    """Ids of whole texts; remembers the ids of every distinct pre-token.

    ``encode`` maps a list of distinct pre-tokens to their ids. Pre-tokens are known by their
    text, not by a hash of it. The memory is emptied when it holds ``limit`` pre-tokens or
    ``REMEMBERED_TEXT`` code points of them, so a worker's memory does not grow with the data.
    """

    def __init__(self, encode: Callable[[list[str]], Sequence], limit: int = 300_000) -> None:
        self._encode, self._limit = encode, limit
        self.forget()

    def forget(self) -> None:
        """Empty the memory."""
        self._slot: dict[str, int] = {}
        self._text = 0
        self._flat = np.empty(1 << 16, np.int32)
        self._begin = np.zeros(1, np.int64)
        self.spelled: list = []

    def spell(self, pretoken: str, ids: Sequence[int]) -> object:
        """What else to remember of a pre-token; nothing here."""
        return None

    def _learn(self, pretokens: list[str]) -> None:
        found = self._encode(pretokens)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        used = self._begin[-1]
        need = used + int(lengths.sum())
        if need > len(self._flat):
            self._flat = np.concatenate([self._flat[:used], np.empty(2 * need, np.int32)])
        self._flat[used:need] = np.fromiter(chain.from_iterable(found), np.int32, need - used)
        self._slot.update(zip(pretokens, count(len(self._begin) - 1)))
        self._text += sum(map(len, pretokens))
        self._begin = np.concatenate([self._begin, used + np.cumsum(lengths)])
        if type(self).spell is not Encoder.spell:
            self.spelled += map(self.spell, pretokens, found)

    def slots(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The pre-tokens of all texts as slots, and how many each text has."""
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        starts = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=starts[1:])
        first = split_points(points, starts)
        if len(first) == 0:
            return np.empty(0, np.int64), np.zeros(len(texts), np.int64)
        # Pre-tokens follow each other without gaps; in UTF-8 a code point begins at every byte
        # that is no continuation.
        data = np.frombuffer(joined.encode(), np.uint8)
        begin = first if len(data) == len(points) else np.flatnonzero((data & 0xC0) != 0x80)[first]
        buffers = [pa.py_buffer(np.append(begin, len(data))), pa.py_buffer(data)]
        coded = pa.LargeStringArray.from_buffers(len(first), *buffers).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self._slot) + len(distinct) > self._limit or self._text > REMEMBERED_TEXT:
            self.forget()
        by_code = list(map(self._slot.get, distinct))
        new = [i for i, slot in enumerate(by_code) if slot is None]
        if new:
            at = len(self._begin) - 1
            self._learn([distinct[i] for i in new])
            for slot, i in enumerate(new, at):
                by_code[i] = slot
        slots = np.array(by_code, np.int64)[coded.indices.to_numpy()]
        return slots, np.diff(np.searchsorted(first, starts))

    def lengths(self, slots: np.ndarray) -> np.ndarray:
        """Number of ids of each pre-token."""
        return self._begin[slots + 1] - self._begin[slots]

    def ids(self, slots: np.ndarray) -> np.ndarray:
        """Ids of all pre-tokens, on end."""
        lengths = self.lengths(slots)
        ends = np.cumsum(lengths)
        if len(ends) == 0:
            return np.empty(0, np.int32)
        shift = np.repeat(self._begin[slots] - (ends - lengths), lengths)
        return self._flat[shift + np.arange(ends[-1])]
