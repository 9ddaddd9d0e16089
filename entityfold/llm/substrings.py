"""Removal of long passages that repeat across documents, by compacting the graph of word k-mers.

Every window of ``window`` consecutive words is an edge of the graph. The edges of a document
follow one another; those whose least hashed ``anchor``-word gram is the same one form a path,
kept as one row (anchor, digest of its words, document, position, number of edges). Equal
windows have equal anchors, so whatever repeats meets under its anchor.

A path that is found whole in an earlier document is compacted: all its edges repeat, and one
join on its digest says so. Only where an anchor has several different paths (the graph
branches there) are the first copies of those paths opened into single edges and joined edge by
edge. The digests are of 128 bits over the exact words, taken at the source positions, and
stand for the comparison of the words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityfold.llm.common import add_columns, discard, map_batches, materialise

WINDOW = 50
ANCHOR = 12
KEPT_WORDS = 200_000
_FACTOR = 0x9E3779B97F4A7C15


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= 40:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = value
        return value


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` consecutive word hashes."""
    with np.errstate(over="ignore"):
        out, have, bits = words, 1, bin(n)[3:]
        for bit in bits:
            out = out[: len(out) - have] * np.uint64(pow(_FACTOR, have, 1 << 64)) + out[have:]
            have *= 2
            if bit == "1":
                out = out[: len(out) - 1] * np.uint64(_FACTOR) + words[have : have + len(out) - 1]
                have += 1
        out = (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return out ^ (out >> np.uint64(29))


def sliding_min(values: np.ndarray, n: int) -> np.ndarray:
    """The least of each run of ``n`` consecutive values."""
    out, have = values, 1
    while 2 * have <= n:
        out = np.minimum(out[: len(out) - have], out[have:])
        have *= 2
    rest = n - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _offsets(words: list[bytes]) -> np.ndarray:
    """Where each word starts in the words joined by one space; one more entry for the end."""
    return np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1


def _paths(df: DataFrame, key: str, text: str, window: int, anchor: int) -> DataFrame:
    taken = df.where(F.col(key).isNotNull()).select(
        F.col(key).alias("doc"), F.xxhash64(text).alias("version"), F.col(text).alias("text")
    )

    def make():
        known = _Hashes()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            anchors, digests, rows, starts, sizes = [], [], [], [], []
            for row, value in enumerate(batch.column(2).to_pylist()):
                words = (value or "").encode().split()
                if len(words) < window:
                    continue
                hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
                least = sliding_min(gram_hashes(hashes, anchor), window - anchor + 1)
                first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
                size = np.diff(np.r_[first, len(least)])
                joined, ends = b" ".join(words), _offsets(words)
                a = np.r_[0, ends + 1][first].tolist()
                b = ends[first + size + window - 2].tolist()
                digests += [xxhash.xxh3_128_digest(joined[i:j]) for i, j in zip(a, b, strict=True)]
                anchors.append(least[first])
                rows.append(np.full(len(first), row))
                starts.append(first)
                sizes.append(size)
            flat = lambda x, t: np.concatenate(x).astype(t) if x else np.empty(0, t)
            both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            of = pa.array(flat(rows, np.int64))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(flat(anchors, np.uint64).view(np.int64)),
                    pa.array(both[:, 0].copy()),
                    pa.array(both[:, 1].copy()),
                    batch.column(0).take(of),
                    batch.column(1).take(of),
                    pa.array(flat(starts, np.int32)),
                    pa.array(flat(sizes, np.int32)),
                ],
                ["anchor", "d1", "d2", "doc", "version", "start", "edges"],
            )

        return run

    kind = df.schema[key].dataType.simpleString()
    return map_batches(
        taken, make, f"anchor long, d1 long, d2 long, doc {kind}, version long, start int, edges int", rows=128
    )


def _edges(paths: DataFrame, docs: DataFrame, window: int) -> DataFrame:
    """The edges of paths (doc, version, start, edges): digest and position of every window."""
    wanted = paths.groupBy("doc", "version").agg(F.collect_list(F.struct("start", "edges")).alias("paths"))
    met = docs.join(wanted.hint("shuffle_hash"), ["doc", "version"]).select("doc", "version", "text", "paths")

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            digests, rows, places = [], [], []
            for row, (value, wanted) in enumerate(
                zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ):
                words = value.encode().split()
                joined, ends = b" ".join(words), _offsets(words)
                starts = np.r_[0, ends + 1]
                at = np.unique(np.concatenate([np.arange(p["start"], p["start"] + p["edges"]) for p in wanted]))
                a, b = starts[at].tolist(), ends[at + window - 1].tolist()
                digests += [xxhash.xxh3_128_digest(joined[i:j]) for i, j in zip(a, b, strict=True)]
                rows.append(np.full(len(at), row))
                places.append(at.astype(np.int32))
            both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            of = pa.array(np.concatenate(rows) if rows else np.empty(0, np.int64))
            place = np.concatenate(places) if places else np.empty(0, np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), batch.column(0).take(of), batch.column(1).take(of), pa.array(place)],
                ["d1", "d2", "doc", "version", "start"],
            )

        return run

    kind = docs.schema["doc"].dataType.simpleString()
    return map_batches(met, make, f"d1 long, d2 long, doc {kind}, version long, start int", rows=64)


def repeated_spans(
    df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR
) -> DataFrame:
    """Runs of windows that also start in a row with a smaller key.

    Returns ``doc`` (the key), ``version`` (a hash of the text, for keys used twice), ``start``
    (the first window's first word) and ``edges`` (how many windows). Rows with a null key
    neither lose nor lend passages; rows with the same key do not repeat one another.
    """
    docs = df.where(F.col(key).isNotNull()).select(
        F.col(key).alias("doc"), F.xxhash64(text).alias("version"), F.col(text).alias("text")
    )
    paths = materialise(_paths(df, key, text, window, anchor), "paths")
    contents = materialise(
        paths.groupBy("d1", "d2").agg(
            F.min("anchor").alias("anchor"), F.min("doc").alias("source"), F.max("doc").alias("last")
        ),
        "contents",
    )
    branching = (
        contents.groupBy("anchor").agg(F.min("source").alias("least"), F.max("source").alias("most"))
        .where("least < most").select("anchor", F.lit(True).alias("branches"))
    )
    known = contents.join(branching, "anchor", "left").where("source < last or branches")
    known = known.select("d1", "d2", "source", F.coalesce("branches", F.lit(False)).alias("branches"))
    met = materialise(
        paths.select("d1", "d2", "doc", "version", "start", "edges").join(known, ["d1", "d2"])
        .where("doc > source or branches")
        .select("doc", "version", "start", "edges", (F.col("doc") > F.col("source")).alias("whole")),
        "met",
    )
    discard(paths)
    discard(contents)
    edges = materialise(_edges(met.where("not whole"), docs, window), "branches")
    firsts = edges.groupBy("d1", "d2").agg(F.min("doc").alias("source"), F.max("doc").alias("last"))
    # A table of its own, so that the join deals out both sides anew and can split a frequent edge.
    firsts = materialise(firsts.where("source < last").drop("last"), "firsts")
    single = edges.join(firsts, ["d1", "d2"]).where("doc > source")
    return met.where("whole").select("doc", "version", "start", "edges").union(
        single.select("doc", "version", "start", F.lit(1).alias("edges"))
    )


def remove_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns ``keep``, ``n_words``, ``n_removed`` and ``kept_text``.

    A word goes if a window over it also starts in a row with a smaller key; ``kept_text`` is
    the words that stay, unchanged, joined by one space (empty for a null text). Texts shorter
    than a window stay whole. Repeated rows are treated alike; an empty table gives an empty one.
    Kept columns must not be called as the new ones; others may have any name.
    """
    spans = materialise(repeated_spans(df, key, text, window), "spans")
    packed = F.shiftleft(F.col("start").cast("long"), 32) + F.col("edges")
    by_doc = spans.groupBy(F.col("doc").alias("_span_doc"), F.col("version").alias("_span_version"))
    by_doc = by_doc.agg(F.collect_list(packed).alias("_spans"))
    docs = df.withColumns({"_doc": F.col(key), "_version": F.xxhash64(text)})
    met = (F.col("_doc") == F.col("_span_doc")) & (F.col("_version") == F.col("_span_version"))
    joined = docs.join(by_doc.hint("shuffle_hash"), met, "left")

    def make():
        def run(texts: list[str | None], spans: list[list[int] | None]) -> list:
            n_words, n_removed, kept = [], [], []
            for value, own in zip(texts, spans, strict=True):
                words = (value or "").encode().split()
                n_words.append(len(words))
                if own:
                    packed = np.array(own, np.int64)
                    first = packed >> 32
                    depth = np.zeros(len(words) + 1, np.int64)
                    np.add.at(depth, first, 1)
                    np.add.at(depth, first + (packed & 0xFFFFFFFF) + window - 1, -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(depth)[:-1] == 0).tolist()]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            return [n_words, n_removed, kept]

        return run

    return add_columns(joined, keep, (text, "_spans"), "n_words long, n_removed long, kept_text string", make)
