"""Whole texts as numpy arrays: the helpers that the operators run inside Spark tasks.

A batch of texts becomes one array of bytes or code points with the position where each text
begins, so that work on every character or word is a vectorised pass.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts of a batch are worked on in runs of about this many bytes, which bounds the arrays made
# from them (some ten times as much). One longer text is a run of its own, never cut.
RUN_BYTES = 1 << 20

# The C library's call that gives freed memory back to the system, where there is one.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)

_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
# Spans of more bytes are hashed one by one; the others in step, eight bytes at a time.
_LONG = 256
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX_A
    x ^= x >> np.uint64(27)
    x *= _MIX_B
    x ^= x >> np.uint64(31)
    return x


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts on end, and where each begins (one more entry closes the last).

    A null text counts as empty.
    """
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.empty(0, np.uint8), starts - starts[0]
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def runs(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``RUN_BYTES`` of text."""
    if batch.num_rows == 0:
        return
    _, starts = utf8(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(starts, starts[first] + RUN_BYTES, side="right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last
    # What the batch's arrays took goes back to the system before the next batch comes.
    give_back()


def give_back() -> None:
    """Freed memory of Arrow and of the C library goes back to the system."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes ``data[begin:end]`` of every span.

    Each step is a bijection of the eight bytes it takes in, mixed before the next ones come: no
    pattern within a span cancels out, as it can in a polynomial. Long spans get a
    cryptographic digest.
    """
    size = end - begin
    out = size.astype(np.uint64) * _STEP
    if len(data) == 0 or len(begin) == 0:
        return mixed(out)
    window = np.lib.stride_tricks.sliding_window_view(np.append(data, np.zeros(8, np.uint8)), 8)
    on = np.flatnonzero((size > 0) & (size <= _LONG))
    at, left = begin[on], size[on]
    while len(on):
        block = window[at].view("<u8").ravel() & _KEEP[np.minimum(left, 8)]
        out[on] = mixed((out[on] ^ block) + _STEP)
        more = left > 8
        on, at, left = on[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > _LONG).tolist():
        digest = hashlib.blake2b(data[begin[i] : end[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z as a-z."""
    return np.where((data >= 65) & (data <= 90), data | 32, data)


def spans(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes that are ``inside``: begin, end, and how many each text has.

    No run spans two texts.
    """
    if len(inside) == 0:
        empty = np.empty(0, np.int64)
        return empty, empty, np.zeros(len(starts) - 1, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    after = np.zeros(len(inside) + 1, bool)
    after[1:][inside] = True
    after[:-1][inside] = False
    # A text that begins with a run ends the run of the text before it.
    cuts = starts[:-1][np.diff(starts) > 0]
    first[cuts] |= inside[cuts]
    cuts = cuts[cuts > 0]
    after[cuts] |= inside[cuts - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(after)
    per_text = np.diff(np.searchsorted(begin, starts))
    return begin, end, per_text


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs without space and \\t-\\r): begin, end, and how many each text has."""
    return spans(~((data == 32) | ((data >= 9) & (data <= 13))), starts)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    return span_hashes(data, begin, end)


def sums_by_text(values: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Sum of the values of every text, 0 for a text without any."""
    ends = np.cumsum(per_text)
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.float64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[ends] - total[ends - per_text]
