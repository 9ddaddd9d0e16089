"""Phrase collocations counted in FM-indexes over word ids.

Texts are gathered, language by language, in shards of a bounded number of words. A shard numbers
its words and holds two Burrows-Wheeler transforms of the number sequence, one of it and one of its
reverse, both sorted to the depth of the longest phrase. A phrase is an interval in either; the
words before (after) its occurrences stand in the interval of the forward (backward) transform, so
one step extends all phrases of a shard to the left (right), with counts and both new intervals.

Counts are summed across shards by Spark, in two rounds. The first extends single words once and
sums the pairs over all shards, each known by 96 bits of two independent hashes of its language and
words. Each shard then gets back its own frequent pairs, and the second round extends only phrases
that consist of them (there 64 bits do: a hash that two pairs share may let a rare pair through,
never stop a frequent one). The sum of a pair goes to one of its shards, which alone spells it out;
the words of longer phrases, not hashes, are the key of their sums.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityfold.llm.common import discard, materialise

SHARD_WORDS = 2_000_000
LONGEST = 4
LEAST = 30
TOP = 2000
INSIDE_PERCENT = 80
SALTS = 64
_BREAKS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)


class Transform:
    """Burrows-Wheeler transform of ``ids`` (numbers from 0; 0 is a boundary), sorted to ``depth`` words."""

    def __init__(self, ids: np.ndarray, depth: int):
        rank, sorted_to = ids.astype(np.int64), 1
        while sorted_to < depth:  # ranks of twice the length from ranks of the length
            later = np.zeros_like(rank)
            later[:-sorted_to or None] = rank[sorted_to:]
            pair = rank * (int(rank.max(initial=0)) + 1) + later
            order = np.argsort(pair, kind="stable")
            rank = np.empty_like(pair)
            rank[order] = np.cumsum(np.diff(pair[order], prepend=pair[order[:1]]) != 0)
            sorted_to *= 2
        self.last = ids[np.argsort(rank, kind="stable") - 1]  # the word before each suffix; the sequence counts as a circle
        self.lf = np.empty(len(ids), np.int32)  # C[word] + occurrences of the word above the row
        self.lf[np.argsort(self.last, kind="stable")] = np.arange(len(ids), dtype=np.int32)


def extend(index: Transform, low: np.ndarray, other: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """One more word before each phrase: parent, word, interval here, interval in the other transform, size."""
    parent = np.repeat(np.arange(len(size)), size)
    start = np.cumsum(size) - size
    rows = np.arange(len(parent)) - start[parent] + low[parent]
    words = index.last[rows].astype(np.int64)
    order = np.argsort(parent * (int(index.last.max(initial=0)) + 1) + words, kind="stable")
    p, w, r = parent[order], words[order], rows[order]
    new = np.flatnonzero(np.diff(p, prepend=-1) | np.diff(w, prepend=-1))
    ends = np.append(new[1:], len(p))
    p, w = p[new], w[new]
    found = p, w, index.lf[r[new]], other[p] + new - start[p], ends - new
    return tuple(x[w > 0] for x in found)


class WordIndex:
    """Bidirectional FM-index of one shard.

    ``words`` (one row of word numbers per phrase), ``low`` and ``back`` (their intervals in the
    two transforms) and ``size`` describe a set of phrases of one length.
    """

    def __init__(self, ids: np.ndarray, depth: int = LONGEST):
        self.ids, self.depth = ids, depth
        count = np.bincount(ids)
        low = np.cumsum(count) - count
        known = np.flatnonzero(count[1:]) + 1
        self.singles = known[:, None], low[known], low[known], count[known]

    @cached_property
    def forward(self) -> Transform:
        return Transform(self.ids, self.depth)

    @cached_property
    def backward(self) -> Transform:
        return Transform(self.ids[::-1], self.depth)

    def left(self, words: np.ndarray, low: np.ndarray, back: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        p, w, low, back, size = extend(self.forward, low, back, size)
        return np.concatenate([w[:, None], words[p]], axis=1), low, back, size

    def right(self, words: np.ndarray, low: np.ndarray, back: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        p, w, back, low, size = extend(self.backward, back, low, size)
        return np.concatenate([words[p], w[:, None]], axis=1), low, back, size


def hash_words(words: list[str], lang: str) -> np.ndarray:
    """Two independent numbers (rows) per word id from 1; the same in every shard of the language."""
    import xxhash

    digests = b"".join(xxhash.xxh3_128_digest(f"{lang} {w}".encode("utf-8", "surrogatepass")) for w in words)
    out = np.zeros((2, len(words) + 1), np.uint64)
    out[:, 1:] = np.frombuffer(digests, ">u8").reshape(-1, 2).T
    return out


def pair_keys(hashes: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = hashes[pairs[:, 0]] * np.uint64(0x9E3779B97F4A7C15) + hashes[pairs[:, 1]]
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


def pair_checks(hashes: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """32 more bits, from the other hash of the words."""
    with np.errstate(over="ignore"):
        mixed = hashes[pairs[:, 0]] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[pairs[:, 1]]
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return (mixed >> np.uint64(32)).astype(np.uint32).view(np.int32)


def pack_ids(ids: np.ndarray) -> bytes:
    """Numbers as 32-bit little-endian, their bytes by place (the high ones are mostly zero), compressed."""
    planes = np.ascontiguousarray(ids.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack_ids(packed: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 4 * count, codec="zstd"), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


class _Buffer:
    """Word numbers of the texts of one language that the task has read so far."""

    def __init__(self):
        self.number: defaultdict[bytes, int] = defaultdict(count(1).__next__)
        self.parts: list[np.ndarray] = []
        self.held = 0

    def add(self, text: bytes) -> int:
        """Take a text; how many words and boundaries it has."""
        ids, number = [], self.number.__getitem__
        for piece in text.lower().translate(_BREAKS).split(b"\n"):
            if found := piece.split():
                ids.append(0)
                ids += map(number, found)
        self.parts.append(np.array(ids, np.int32))
        self.held += len(ids)
        return len(ids)

    def take(self) -> tuple[list[str], np.ndarray]:
        ids = np.concatenate([*self.parts, np.zeros(1, np.int32)])
        words = [w.decode("utf-8", "surrogatepass") for w in self.number]
        self.__init__()
        return words, ids


def shards(docs: DataFrame, text: str = "text", lang: str = "lang", shard_words: int = SHARD_WORDS) -> DataFrame:
    """``shard``, ``lang``, ``words``, ``counts``, ``size`` and ``ids`` (so many packed numbers into ``words``
    from 1; 0 before, between and after pieces). A text is never divided, so a longer one is a shard of its own."""
    names = {"lang": F.coalesce(docs[lang].cast("string"), F.lit("und")), "text": F.coalesce(docs[text], F.lit("")).cast("binary")}
    schema = "shard long, lang string, words array<string>, counts array<long>, size long, ids binary"
    kinds = [pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.int64(), pa.binary()]
    names_ = ["shard", "lang", "words", "counts", "size", "ids"]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = count((context.partitionId() if context else 0) << 32)
        buffers: defaultdict[str, _Buffer] = defaultdict(_Buffer)
        held = 0

        def row(name: str) -> pa.RecordBatch:
            words, ids = buffers.pop(name).take()
            counts = np.bincount(ids, minlength=len(words) + 1)[1:]
            values = [[next(number)], [name], [words], [counts.tolist()], [len(ids)], [pack_ids(ids)]]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names_)

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held += buffers[name].add(value)
                if held >= shard_words:
                    most = max(buffers, key=lambda b: buffers[b].held)
                    held -= buffers[most].held
                    yield row(most)
        for name in list(buffers):
            if buffers[name].number:
                yield row(name)

    return docs.select(*(c.alias(n) for n, c in names.items())).mapInArrow(gather, schema)


def _shard_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            shard, lang, words, size, ids = (batch.column(c)[i].as_py() for c in range(5))
            index = WordIndex(unpack_ids(ids, size), 2)
            pairs, _, _, size = index.left(*index.singles)
            hashes = hash_words(words, lang)
            keys, checks = pair_keys(hashes[0], pairs), pair_checks(hashes[1], pairs)
            for at in range(0, len(keys), 1 << 16):
                part = slice(at, at + (1 << 16))
                columns = [pa.array(np.full(len(keys[part]), shard)), pa.array(keys[part]), pa.array(checks[part]), pa.array(size[part].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "pair", "mark", "n"])


def _member(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(keys), bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)] == keys


def shard_phrases(shard: pd.DataFrame, pairs: pd.DataFrame, longest: int) -> pd.DataFrame:
    """Phrases of 3 to ``longest`` words of a shard all of whose neighbouring pairs are frequent, with their
    counts in the shard, and the pairs whose count over all shards (``f``, else 0) was given to this one."""
    phrases, counts = [], []
    wanted = np.sort(pairs["pair"].to_numpy(np.int64))
    given = pairs.loc[pairs["f"] > 0, ["pair", "mark", "f"]]
    for _, row in shard.iterrows():
        index, words = WordIndex(unpack_ids(row["ids"], row["size"]), longest), list(row["words"])
        hashes, names = hash_words(words, row["lang"]), np.array(["", *words], object)

        def kept(found: tuple[np.ndarray, ...], ends: slice) -> tuple[np.ndarray, ...]:
            good = _member(wanted, pair_keys(hashes[0], found[0][:, ends]))
            return tuple(x[good] for x in found)

        def spelt(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            known = pd.DataFrame({"pair": pair_keys(hashes[0], pairs), "mark": pair_checks(hashes[1], pairs), "at": np.arange(len(pairs))})
            both = known.merge(given, on=["pair", "mark"])
            return pairs[both["at"].to_numpy()], both["f"].to_numpy()

        known = index.singles
        for length in range(2, longest + 1):  # both ways in turn; either transform alone would do
            known = kept(index.left(*known), slice(0, 2)) if length % 2 == 0 else kept(index.right(*known), slice(-2, None))
            if not len(known[0]):
                break
            found, n = spelt(known[0]) if length == 2 else (known[0], known[3])
            text = names[found[:, 0]]
            for k in range(1, length):
                text = text + " " + names[found[:, k]]
            phrases.append(text)
            counts.append(n)
    lang = shard["lang"].iloc[0] if len(shard) else None
    phrase = np.concatenate(phrases) if phrases else np.empty(0, object)
    n = np.concatenate(counts) if counts else np.empty(0, np.int64)
    return pd.DataFrame({"lang": pd.Series([lang] * len(n), dtype=object), "phrase": phrase, "f": n.astype(np.int64)})


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """Counts of all phrases of 1 to ``longest`` words that occur ``least`` times or more in a language
    (``lang``, ``phrase``, ``f``), and the words of each language (``lang``, ``n``)."""
    held = materialise(shards(docs, text, lang), "shards")
    single = held.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    single = single.groupBy("lang", F.col("w.words").alias("phrase")).agg(F.sum("w.counts").alias("f"))
    single = materialise(single, "words")
    n = single.groupBy("lang").agg(F.sum("f").alias("n"))
    pairs = held.select("shard", "lang", "words", "size", "ids").mapInArrow(_shard_pairs, "shard long, pair long, mark int, n int")
    same = Window.partitionBy("pair", "mark")
    pairs = pairs.withColumns({"n": F.sum("n").over(same), "first": F.min("shard").over(same)}).where(F.col("n") >= least)
    pairs = pairs.select("shard", "pair", "mark", F.when(F.col("shard") == F.col("first"), F.col("n")).otherwise(0).alias("f"))

    def count_in(shard: pd.DataFrame, frequent: pd.DataFrame) -> pd.DataFrame:
        return shard_phrases(shard, frequent, longest)

    both = held.select("shard", "lang", "words", "size", "ids").groupBy("shard").cogroup(pairs.groupBy("shard"))
    counted = both.applyInPandas(count_in, "lang string, phrase string, f long")
    counted = counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    found = materialise(single.union(counted).where(F.col("f") >= least), "phrases")
    return found, n


def word_list(phrase: str | Column) -> Column:
    return F.split(phrase, " ")


def part(phrase: str, first: Column | int, length: Column | int) -> Column:
    """Words ``first`` (from 1) to ``first + length - 1`` of a phrase."""
    return F.array_join(F.slice(word_list(phrase), first, length), " ")


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    top: int = TOP,
    inside_percent: int = INSIDE_PERCENT,
    longest: int = LONGEST,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """Each language's first ``top`` phrases of 2 to ``longest`` words: ``lang``, ``rank``, ``phrase``, ``a``,
    ``l``, ``r``, ``n``, ``score``.

    A-Z are lower-cased; texts end pieces at ``. , ; : ! ?`` and line breaks, pieces end words at
    spaces and tabs. ``a`` counts the phrase (``least`` or more), ``l`` and ``r`` the two parts of the cut of
    lowest score floor(2000000 * a / (l + r)), the first of such cuts. A phrase that lies inside a
    longer one with 100 * its count >= ``inside_percent`` * a is left out. Order: score and ``a`` descending,
    then phrase by bytes.

    A null text is empty, a null language is ``und``. Rows are counted as they come, repeated ones as
    often as they occur. Other columns are not read. A text of any length is counted whole.
    Empty tables give an empty one.
    """
    known, n = frequent_phrases(docs, least, longest, text, lang)
    long = known.where(F.instr("phrase", " ") > 0).withColumnRenamed("f", "a").withColumn("_k", F.size(word_list("phrase")))
    cuts = long.select("lang", "phrase", "a", "_k", F.explode(F.sequence(F.lit(1), F.col("_k") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part("phrase", F.lit(1), F.col("k")).alias("first"), part("phrase", F.col("k") + 1, F.col("_k") - F.col("k")).alias("rest"))
    for name, count_ in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(name), F.col("f").alias(count_)), ["lang", name])
    exact = F.expr("cast(cast(a as decimal(20,0)) * cast(2000000 as decimal(7,0)) div (l + r) as long)")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("cut"))

    lengths = F.sequence(F.lit(2), F.col("_k") - 1)
    spots = F.flatten(F.transform(lengths, lambda m: F.transform(F.sequence(F.lit(1), F.col("_k") - m + 1), lambda i: F.struct(i.alias("i"), m.alias("m")))))
    inner = long.where("_k > 2").select("lang", "a", "phrase", F.explode(spots).alias("s"))
    inner = inner.select("lang", part("phrase", F.col("s.i"), F.col("s.m")).alias("phrase"), F.col("a").alias("f"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    free = best.join(inner, ["lang", "phrase"], "left")
    free = free.where(F.col("f").isNull() | (F.col("f").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * inside_percent))

    order = [F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase")]
    few = Window.partitionBy("lang", "_salt").orderBy(*order)  # best of each part first, so that no task ranks a whole language
    ahead = free.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn("_n", F.row_number().over(few)).where(F.col("_n") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = ahead.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))


PHRASES_SQL = r"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
               FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
    t AS (SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY 1),
    g AS (SELECT lang, k, words[i:i + k - 1] AS phrase, count(*) AS f
          FROM w, unnest(range(1, 5)) AS x(k), unnest(range(1, len(words) - k + 2)) AS y(i) GROUP BY ALL HAVING f >= 30),
    c AS (SELECT g.lang, g.k, g.phrase, g.f AS a, j, l.f AS l, r.f AS r, ((2000000::HUGEINT * g.f) // (l.f + r.f))::BIGINT AS score
          FROM g, unnest(range(1, g.k)) AS z(j)
          JOIN g l ON l.lang = g.lang AND l.phrase = g.phrase[1:j] JOIN g r ON r.lang = g.lang AND r.phrase = g.phrase[j + 1:]),
    b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
    s AS (SELECT lang, phrase[i:i + m - 1] AS phrase, max(f) AS f
          FROM g, unnest(range(2, g.k)) AS u(m), unnest(range(1, g.k - m + 2)) AS v(i) GROUP BY ALL),
    o AS (SELECT b.* FROM b LEFT JOIN s ON s.lang = b.lang AND s.phrase = b.phrase
          WHERE s.f IS NULL OR 100 * s.f < 80 * b.a)
    SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, array_to_string(phrase, ' ')) AS rank,
           array_to_string(phrase, ' ') AS phrase, a, l, r, t.n, score
    FROM o JOIN t ON t.lang = o.lang QUALIFY rank <= 2000"""
