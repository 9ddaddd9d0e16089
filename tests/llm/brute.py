"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall(text or "")


class Groups:
    """Union of whatever can be compared; the least of a group names it."""

    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(low)
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(rows):
    """rows (id, text) with ids that are unique -> {id: (fingerprint, component)}."""
    prints = {i: fingerprint(t) for i, t in rows}
    groups, ids = Groups(prints), list(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                groups.join(a, b)
    return {i: (f"{prints[i]:016x}", groups.find(i)) for i in ids}


def without_repeats(rows, window=50):
    """rows (id, text) -> {id: (number of words, kept words)}."""
    first, out = {}, {}
    texts = [(i, words(t)) for i, t in rows if i is not None]
    for i, w in texts:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i)
    for i, w in texts:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        out[i] = (len(w), [x for x, g in zip(w, gone, strict=True) if not g])
    return out


def rule_statistics(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    counts, repeated = Counter(windows), [False] * len(w)
    for i, x in enumerate(windows):
        if counts[x] > 1:
            repeated[i : i + 5] = [True] * 5
    symbols = len(re.findall("[#*$%&|<>]", text or ""))
    return (len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), sum(repeated))


def vector_links(rows, threshold):
    """rows (id, vector, label) with unique ids -> {id: (links, component)}."""

    def usable(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    known = {i: (np.array(v, float) / np.abs(v).max(), label) for i, v, label in rows if label is not None and usable(v)}
    groups, links, ids = Groups([r[0] for r in rows]), Counter(), list(known)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            (x, la), (y, lb) = known[a], known[b]
            if la == lb and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links.update([a, b])
                groups.join(a, b)
    return {r[0]: (links[r[0]], groups.find(r[0])) for r in rows}


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def ids_bytes(ids):
    return np.array(ids, "<u4").tobytes()


def crc(ids):
    return zlib.crc32(ids_bytes(ids))
