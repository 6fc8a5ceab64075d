"""Minimal acyclic transducers over byte strings: from a term to its place in sorted order.

States with the same future are one state. An arc carries the number of terms that come before all
terms through it, so the outputs along a term's path add up to its ordinal. Terms arrive sorted;
only the path of the last one is unfinished at any time.

A language's vocabulary is cut into shards of neighbouring terms, a transducer each. Cuts fall
between terms that differ in their first ``LEAD`` bytes, so a term's shard is known from those.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np

LEAD = 8


@dataclass
class Transducer:
    """Arcs by state, in label order. The root is the last state."""

    degree: np.ndarray  # arcs of each state
    final: np.ndarray  # does a term end here?
    label: np.ndarray
    target: np.ndarray
    output: np.ndarray

    TYPES = {"degree": "<u2", "final": "u1", "label": "u1", "target": "<i4", "output": "<i4"}

    def pack(self) -> dict[str, bytes]:
        return {name: getattr(self, name).astype(kind).tobytes() for name, kind in self.TYPES.items()}

    @classmethod
    def unpack(cls, packed) -> Transducer:
        return cls(*[np.frombuffer(packed[name], kind) for name, kind in cls.TYPES.items()])


def build(terms: Iterable[bytes]) -> Transducer:
    """The minimal transducer of sorted, distinct terms."""
    register: dict[tuple, int] = {}
    degree, final, labels, targets, outputs, reach = [], [], [], [], [], []
    # The unfinished path: does a term end, arcs so far (the last one's target is still open).
    path: list[list] = [[0, [], []]]
    last = b""

    def finish(node: list) -> int:
        ends, out_labels, out_targets = node
        key = (ends, bytes(out_labels), tuple(out_targets))
        state = register.get(key)
        if state is None:
            state = register[key] = len(degree)
            before = ends
            for label, target in zip(out_labels, out_targets, strict=True):
                labels.append(label)
                targets.append(target)
                outputs.append(before)
                before += reach[target]
            degree.append(len(out_labels))
            final.append(ends)
            reach.append(before)
        return state

    def finish_below(depth: int) -> None:
        while len(path) > depth + 1:
            state = finish(path.pop())
            path[-1][2].append(state)

    for term in terms:
        shared = 0
        limit = min(len(term), len(last))
        while shared < limit and term[shared] == last[shared]:
            shared += 1
        finish_below(shared)
        for byte in term[shared:]:
            path[-1][1].append(byte)
            path.append([0, [], []])
        path[-1][0] = 1
        last = term
    finish_below(0)
    finish(path[0])
    return Transducer(
        np.array(degree, np.int64),
        np.array(final, np.uint8),
        np.array(labels, np.uint8),
        np.array(targets, np.int64),
        np.array(outputs, np.int64),
    )


def lead_keys(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The first ``LEAD`` bytes of every span as a number that orders as they do."""
    key = np.zeros(len(begin), np.uint64)
    for k in range(LEAD):
        at = begin + k
        byte = np.where(at < end, data[np.minimum(at, len(data) - 1)] if len(data) else 0, 0)
        key = (key << np.uint64(8)) | byte.astype(np.uint64)
    return key


class Walker:
    """Shards of one language, walked by many terms in step.

    A state's arcs are found through a bitmap of its 256 possible labels and a count of the bits
    before: constant time, and some 70 bytes per state whatever its arcs.
    """

    def __init__(self, leads: Sequence[bytes], bases: Sequence[int], shards: Sequence[Transducer]) -> None:
        order = sorted(range(len(leads)), key=leads.__getitem__)
        shards = [shards[i] for i in order]
        self._bounds = np.array([int.from_bytes(leads[i].ljust(LEAD, b"\0")) for i in order], np.uint64)
        self._bases = np.array([bases[i] for i in order], np.int64)
        states = np.cumsum([0, *[len(s.degree) for s in shards]])
        self._roots = states[1:] - 1
        degree = np.concatenate([s.degree for s in shards]).astype(np.int64)
        self._final = np.concatenate([s.final for s in shards]).astype(bool)
        self._target = np.concatenate([s.target + n for s, n in zip(shards, states, strict=False)]).astype(np.int64)
        self._output = np.concatenate([s.output for s in shards]).astype(np.int64)
        label = np.concatenate([s.label for s in shards]).astype(np.int64)
        word = np.repeat(np.arange(len(degree)), degree) * 4 + (label >> 6)
        self._bits = np.zeros(4 * len(degree), np.uint64)
        np.bitwise_or.at(self._bits, word, np.uint64(1) << (label & 63).astype(np.uint64))
        per_word = np.bitwise_count(self._bits).astype(np.int64)
        self._before = np.cumsum(per_word) - per_word

    def ordinals(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Ordinal of every span of ``data`` that is a term, -1 for others."""
        out = np.full(len(begin), -1, np.int64)
        if len(begin) == 0:
            return out
        shard = np.searchsorted(self._bounds, lead_keys(data, begin, end), side="right") - 1
        on = np.flatnonzero(shard >= 0)
        state, total = self._roots[shard[on]], self._bases[shard[on]]
        at, stop = begin[on], end[on]
        one = np.uint64(1)
        while len(on):
            ended = at == stop
            if ended.any():
                hit = ended & self._final[state]
                out[on[hit]] = total[hit]
                go = ~ended
                on, state, total, at, stop = on[go], state[go], total[go], at[go], stop[go]
            byte = data[at].astype(np.int64)
            word = state * 4 + (byte >> 6)
            bits, bit = self._bits[word], (byte & 63).astype(np.uint64)
            has = (bits >> bit) & one == one
            arc = (self._before[word] + np.bitwise_count(bits & ((one << bit) - one)))[has]
            on, stop = on[has], stop[has]
            state, total, at = self._target[arc], total[has] + self._output[arc], at[has] + 1
        return out
