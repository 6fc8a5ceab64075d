"""Brute-force counterparts shared by the tests."""

import re

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


def shingle_set(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if not words:
        return set()
    if len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def smallest_reachable(nodes, linked):
    """Component (smallest member) of every node, by searching all pairs."""
    nodes = sorted(nodes)
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}
