"""Near-duplicate documents by 64-bit SimHash fingerprints.

Two fingerprints that differ in at most three bits differ in at most three of their eight
bytes, so they share at least five bytes in place. The inverted index has one list per pair of
(byte positions, their values): positions are taken three at a time from each half of the
fingerprint, and five shared bytes always hold three of one half. Within a list the shared
positional bytes of two fingerprints are tallied, pairs with fewer than five are dropped and the
rest are verified by their differing bits.

Copies with one fingerprint are one entry of the index. A long list is cut into blocks, and
every pair of blocks is a unit of work of its own; a unit returns, for each fingerprint, the
smallest one it is linked with, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityfold.llm.common import connected_components, least_reachable, map_batches, materialise

MAX_BITS = 3
MIN_SHARED_BYTES = 5
BLOCK = 1024
POSITIONS = [c for half in (range(4), range(4, 8)) for c in combinations(half, 3)]


def shingle_hashes(text: str | None, words: int, seed: int) -> np.ndarray:
    """The hash of each shingle in order; a shorter text is one shingle, one without a word has none."""
    found = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII blanks split
    if not found:
        return np.empty(0, np.uint64)
    joined, n = b" ".join(found), max(1, len(found) - words + 1)
    ends = list(accumulate(len(w) + 1 for w in found))
    starts, stops = [0, *ends], ends[min(words, len(found)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a : b - 1], seed) for a, b in zip(starts, stops, strict=False)), np.uint64, n)


def fingerprint(text: str | None, words: int, seed: int) -> int:
    """A bit is set if it is set in over half of the hashes of the shingles; no word: zero."""
    hashes = shingle_hashes(text, words, seed)
    n = len(hashes)
    if not n:
        return 0
    bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view(np.uint64)[0])


def fingerprints(
    df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, seed: int = 42
) -> DataFrame:
    """The key and ``fp``, the fingerprint as a signed long, of each row.

    The shingles are of ``words`` words with repeats; a shorter text is one shingle, a null or
    blank one has fingerprint zero.
    """
    taken = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = np.array([fingerprint(t, words, seed) for t in batch.column(1).to_pylist()], np.uint64)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], [key, "fp"])

        return run

    return map_batches(taken, make, f"`{key}` {df.schema[key].dataType.simpleString()}, fp long")


def _mask(positions: tuple[int, ...]) -> int:
    value = sum(0xFF << (8 * p) for p in positions)
    return value - (1 << 64) if value >> 63 else value


def _links(runs: np.ndarray, fps: np.ndarray) -> np.ndarray:
    """For each entry the smallest fingerprint it reaches by links inside its run.

    ``runs`` numbers the runs and is sorted. Entries are compared with those one, two, ...
    places further on as long as they are in the same run.
    """
    n = len(fps)
    left, right = [], []
    longest = int(np.bincount(runs).max()) if n else 0
    for d in range(1, longest):
        at = np.flatnonzero(runs[:-d] == runs[d:]) if d < n else np.empty(0, np.int64)
        if not len(at):
            break
        apart = fps[at] ^ fps[at + d]
        shared = (apart.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        at = at[(shared >= MIN_SHARED_BYTES) & (np.bitwise_count(apart) <= MAX_BITS)]
        left.append(at)
        right.append(at + d)
    a, b = (np.concatenate(x or [np.empty(0, np.int64)]) for x in (left, right))
    return least_reachable(n, a, b)


def _link_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (list, block, block, fp) sorted by the first three; whole lists are kept together."""
    held: list[np.ndarray] = []

    def work(parts: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(parts)
        new = np.r_[True, (rows[1:, :4] != rows[:-1, :4]).any(axis=1)]
        fps = rows[:, 4].copy().view(np.uint64)
        root = _links(np.cumsum(new) - 1, fps)
        moved = root != np.arange(len(root))
        out = fps.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(out[moved]), pa.array(out[root[moved]])], ["a", "b"])

    size = 0
    for b in batches:
        rows = np.column_stack([c.to_numpy() for c in b.columns]).astype(np.int64)
        if not len(rows):
            continue
        held.append(rows)
        size += len(rows)
        if size < 20_000:
            continue
        rows = np.concatenate(held)
        last = np.flatnonzero((rows[:, :4] != rows[-1, :4]).any(axis=1))
        cut = last[-1] + 1 if len(last) else 0
        if cut:
            yield work([rows[:cut]])
        held, size = [rows[cut:]], len(rows) - cut
    if size:
        yield work(held)


def fingerprint_links(fps: DataFrame, column: str = "fp") -> DataFrame:
    """Links ``a``, ``b`` between different fingerprints that join all that reach one another.

    The links span the same groups as all pairs at three or fewer differing bits do.
    """
    distinct = fps.select(F.col(column).alias("fp")).where("fp is not null").distinct()
    entry = F.explode(F.array(*[
        F.struct(F.lit(i).alias("list"), F.col("fp").bitwiseAND(_mask(p)).alias("value")) for i, p in enumerate(POSITIONS)
    ])).alias("e")
    entries = materialise(distinct.select("fp", entry).select("e.list", "e.value", "fp"), "postings")
    long = entries.groupBy("list", "value").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).where("blocks > 1")
    blocks: Column = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), blocks)
    joined = entries.join(long, ["list", "value"], "left").withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other")
    units = joined.select("list", "value", "own", other, "fp").select(
        "list", "value", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "fp"
    )
    dealt = units.repartition("list", "value", "x", "y").sortWithinPartitions("list", "value", "x", "y", "fp")
    return dealt.mapInArrow(_link_sorted, "a long, b long").distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its key, ``fingerprint`` (16 hex digits) and ``component_id``.

    Rows are linked when their fingerprints differ in at most three bits; the component is named
    by the smallest key that can be reached, null if all keys in it are null. Null, empty and
    blank texts share fingerprint zero and are linked like any other. Repeated rows come back
    repeated; an empty table gives an empty one; other columns are not read.
    """
    prints = materialise(fingerprints(df, key, text), "fingerprints")
    firsts = materialise(prints.groupBy("fp").agg(F.min(key).alias("first")), "firsts")
    groups = materialise(connected_components(fingerprint_links(firsts), "a", "b"), "groups")
    grouped = firsts.join(groups.withColumnRenamed("node", "fp"), "fp", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "fp"))
    # A table of its own, so that the join deals out both sides anew and can split a large component.
    names = materialise(grouped.groupBy("component").agg(F.min("first").alias("component_id")), "names")
    named = grouped.join(names, "component").select("fp", "component_id")
    return prints.join(named, "fp").select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
