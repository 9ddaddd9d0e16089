"""Hard negatives by Kronecker-packed products.

Vector components become whole numbers. The components of several candidates, biased so that none
is negative, sit in separated fields of one wide integer; it is multiplied once by each (biased)
component of an anchor and the products are summed. The fields are wide enough for the largest
sum, so they never run into one another: unpacking them and taking the biases off again gives the
exact inner products. An integer of up to 53 bits travels in a double, where its arithmetic is
exact; components too large for that are packed in integers of any width.

Spark deals anchors and candidates into blocks and compares every block of anchors with every
block of candidates: first for the positives of each anchor, then for its negatives within the
ranges that the positives set. What a comparison returns is cut to the best of its block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityfold.llm.common import materialise

ANCHORS = 4096
CANDIDATES = 65536
AT_ONCE = 1 << 21  # scores that a task holds
WIDTH = 53
DIGITS = 10**38 - 1
LONGEST = 64  # candidates in one integer of any width


def _packed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x @ y.T of whole numbers from zero, exact as long as every sum is below 2 ** 53."""
    most = int(x.sum(axis=1).max(initial=0)) * int(y.max(initial=0))
    bits = max(1, most.bit_length())
    fields = max(1, WIDTH // bits)
    per = -(-len(y) // fields)
    wide = np.zeros((per, y.shape[1]))
    for f in range(fields):
        part = y[f * per : (f + 1) * per]
        wide[: len(part)] += part * 2.0 ** (bits * f)
    sums = (x.astype(np.float64) @ wide.T).astype(np.int64)
    mask = np.int64((1 << bits) - 1)
    return np.concatenate([(sums >> np.int64(bits * f)) & mask for f in range(fields)], axis=1)[:, : len(y)]


def _packed_wide(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The same in Python's integers of any size."""
    most = max((sum(map(int, r)) for r in x), default=0) * max((int(v) for v in y.flat), default=0)
    octets = max(1, -(-most.bit_length() // 8))
    out = np.zeros((len(x), len(y)), object)
    for start in range(0, len(y), LONGEST):
        part = y[start : start + LONGEST]
        columns = [int.from_bytes(b"".join(int(v).to_bytes(octets, "little") for v in c), "little") for c in part.T]
        for i, row in enumerate(x):
            total = sum(int(v) * c for v, c in zip(row, columns, strict=True))
            raw = total.to_bytes(octets * len(part), "little")
            out[i, start : start + len(part)] = [int.from_bytes(raw[octets * k : octets * (k + 1)], "little") for k in range(len(part))]
    return out


def _any_size(m: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in r] for r in m], object).reshape(m.shape)


def inner_products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows: int64, or objects where they may not fit."""
    if not anchors.size or not rows.size:
        return np.zeros((len(anchors), len(rows)), np.int64)
    reach = [int(max(abs(m.min()), abs(m.max()))) for m in (anchors, rows)]
    fits = 4 * reach[0] * reach[1] * rows.shape[1] < 1 << WIDTH
    anchors, rows = (m.astype(np.int64) if fits else _any_size(m) for m in (anchors, rows))
    low_a, low_r = anchors.min(axis=0), rows.min(axis=0)
    x, y = anchors - low_a, rows - low_r
    sums = _packed(x, y) if fits else _packed_wide(x, y)
    return sums + (x @ low_r)[:, None] + (y @ low_a)[None, :] + low_a @ low_r


def whole_numbers(vectors: pd.Series, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, as doubles that are whole numbers; short vectors get zeros."""
    width = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    out = np.floor(out * scale)
    return out


class Side:
    """Rows of one side of a comparison, in order of ids, each id once."""

    def __init__(self, group: pd.DataFrame, scale: int):
        if group["id"].duplicated().any():
            group = group.assign(_v=[tuple(v) for v in group["vector"]]).sort_values(["id", "label", "_v"]).drop_duplicates("id")
        self.rows = group.sort_values("id", ignore_index=True)
        self.ids, self.labels = self.rows["id"].to_numpy(), self.rows["label"].to_numpy()
        self.values = whole_numbers(self.rows["vector"], scale)


def _widen(a: np.ndarray, width: int) -> np.ndarray:
    return np.concatenate([a, np.zeros((len(a), width - a.shape[1]), a.dtype)], axis=1) if a.shape[1] < width else a


def scored(group: pd.DataFrame, scale: int):
    """Anchors and candidates of a comparison, and slices of (first anchor, score matrix)."""
    anchors, rows = Side(group[group["anchor"]], scale), Side(group[~group["anchor"]], scale)
    width = max(anchors.values.shape[1], rows.values.shape[1])
    a, b = _widen(anchors.values, width), _widen(rows.values, width)
    step = max(1, AT_ONCE // max(1, len(b)))
    return anchors, rows, ((i, inner_products(a[i : i + step], b)) for i in range(0, len(a), step))


class Ranking:
    """Scores of one anchor, ordered by score and then by smaller id; rows not ``allowed`` are out."""

    def __init__(self, scores: np.ndarray, allowed: np.ndarray):
        at = np.flatnonzero(allowed)
        s = scores[at]
        if s.dtype != object and len(s) and (int(s.max()) - int(s.min())).bit_length() + len(scores).bit_length() < 63:
            bits, low = np.int64(len(scores).bit_length()), s.min()
            keys = np.sort(((s - low) << bits) | (np.int64(len(scores)) - at))
            self.at = len(scores) - (keys & ((np.int64(1) << bits) - 1))
            self.scores = (keys >> bits) + low
        else:
            order = sorted(range(len(at)), key=lambda i: (s[i], -at[i]))
            self.at, self.scores = at[order], s[order]

    def best(self, count: int, low: int | None = None, high: int | None = None) -> list[tuple[int, int]]:
        """(position, score) of the first ``count`` with a score from ``low`` to ``high``."""
        end = len(self.at) if high is None else int(np.searchsorted(self.scores, high, "right"))
        found = range(end - 1, max(-1, end - 1 - count), -1)
        return [(int(self.at[i]), int(self.scores[i])) for i in found if low is None or self.scores[i] >= low]


def _within(value: int, limit: int) -> int:
    return max(-limit, min(limit, value))


def hard_negatives(
    df: DataFrame,
    anchors: Column,
    n_positives: int = 5,
    n_negatives: int = 10,
    scale: int = 256,
    least_percent: int = 30,
    most_percent: int = 90,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Per anchor and positive the best rows of another label within a range of the positive's score.

    A component x counts as floor(scale * x) with x as a double, a score is the inner product of
    these; higher scores come first, ties by smaller key. Positives are the first ``n_positives``
    other rows of the anchor's label. Negatives are the first ``n_negatives`` rows of other labels with
    ``least_percent`` <= 100 * score / positive score <= ``most_percent`` (multiplied out, so a
    positive score below zero has none).

    Rows with a null key, label or vector, or with a null component or one that is not finite
    (times ``scale``) take no part. Of rows with one key the least label and vector counts. A vector
    that is shorter than another counts as filled up with zeros. Scores beyond 64 bits are compared
    (up to 38 digits) and then shown as the nearest long. Fewer rows give fewer; an empty table gives none.
    Other columns are not read. Returns ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score``, ``negative_score``.
    """
    spark = df.sparkSession
    finite = F.forall(F.col("vector"), lambda x: x.isNotNull() & (F.abs(x * F.lit(float(scale))) < float("inf")))
    rows = df.select(
        df[key].alias("id"), df[label].cast("long").alias("label"), df[vector].cast("array<double>").alias("vector"), anchors.alias("anchor")
    ).where("id is not null and label is not null and vector is not null")
    rows = rows.where(finite)
    kind = df.schema[key].dataType.simpleString()
    count = rows.count()
    wanted = rows.where("anchor").count()
    cores = spark.sparkContext.defaultParallelism
    n_rows = max(1, -(-count // CANDIDATES), min(4 * cores, -(-count // 1024)))
    n_anchors = max(1, -(-wanted // ANCHORS))
    spread = F.xxhash64("id")

    def blocks(name: str, n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    left = rows.where("anchor").withColumn("a", F.pmod(spread, F.lit(n_anchors)).cast("int"))
    right = rows.select("id", "label", "vector", F.lit(False).alias("anchor"), F.pmod(spread, F.lit(n_rows)).cast("int").alias("r"))
    right = right.select("*", blocks("a", n_anchors))

    def meet(first: DataFrame, extra: list[str]) -> DataFrame:
        """Both sides of every pair of blocks, spread over tasks by both numbers."""
        nothing = [F.lit(None).cast(first.schema[c].dataType).alias(c) for c in extra]
        first = first.select("id", "label", "vector", "anchor", *extra, "a", blocks("r", n_rows))
        both = first.unionByName(right.select("id", "label", "vector", "anchor", *nothing, "a", "r"))
        return both.repartition(n_anchors * n_rows, "a", "r").groupBy("a", "r")

    def positives(group: pd.DataFrame) -> pd.DataFrame:
        anchor, row, parts = scored(group, scale)
        found = []
        for start, scores in parts:
            for i, s in enumerate(scores, start):
                ranked = Ranking(s, (row.labels == anchor.labels[i]) & (row.ids != anchor.ids[i]))
                found += [(anchor.ids[i], row.ids[p], _within(v, DIGITS)) for p, v in ranked.best(n_positives)]
        return pd.DataFrame(found, columns=["anchor_id", "positive_id", "score"]).astype({"score": str})

    def negatives(group: pd.DataFrame) -> pd.DataFrame:
        anchor, row, parts = scored(group, scale)
        found = []
        for start, scores in parts:
            for i, s in enumerate(scores, start):
                ranked = Ranking(s, row.labels != anchor.labels[i])
                for p in anchor.rows["positives"].iloc[i]:
                    of = int(p["score"])
                    low, high = -(-least_percent * of // 100), most_percent * of // 100
                    if s.dtype != object:
                        low, high = _within(low, 2**63 - 1), _within(high, 2**63 - 1)
                    if low <= high:
                        found += [(anchor.ids[i], p["positive_id"], p["score"], row.ids[q], _within(v, DIGITS)) for q, v in ranked.best(n_negatives, low, high)]
        return pd.DataFrame(found, columns=["anchor_id", "positive_id", "positive_score", "negative_id", "score"]).astype({"score": str})

    def first(found: DataFrame, per: list[str], by: str, n: int) -> DataFrame:
        order = Window.partitionBy(*per).orderBy(F.col("score").cast("decimal(38,0)").desc(), by)
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)

    found = meet(left, []).applyInPandas(positives, f"anchor_id {kind}, positive_id {kind}, score string")
    best = first(found, ["anchor_id"], "positive_id", n_positives)
    lists = best.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "score")).alias("positives"))
    ready = materialise(left.join(lists, left["id"] == lists["anchor_id"]).drop("anchor_id"), "positives")
    fields = f"anchor_id {kind}, positive_id {kind}, positive_score string, negative_id {kind}, score string"
    found = meet(ready, ["positives"]).applyInPandas(negatives, fields)
    best = first(found, ["anchor_id", "positive_id", "positive_score"], "negative_id", n_negatives)

    def long(name: str) -> Column:
        value = F.col(name).cast("decimal(38,0)")
        return F.greatest(F.lit(-(2**63)), F.least(F.lit(2**63 - 1), value)).cast("long")

    return best.select(
        "anchor_id", "positive_id", "rank", "negative_id", long("positive_score").alias("positive_score"), long("score").alias("negative_score")
    )


def moved_label(key: str = "vec_id", label: str = "label") -> Column:
    """Labels as op11 reads them: that of every seventh key is the next one of ten."""
    return F.when(F.col(key) % 7 == 0, (F.col(label) + 1) % 10).otherwise(F.col(label))


NEGATIVES_SQL = """
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
               FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
          FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id,
           (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INT AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10"""
