"""Quality scores by a factorisation machine.

Features of a text are its hashed words (weights of length ``WORD_NORM``), structure statistics and the
recorded length as metadata; statistics are cut into ranges, one feature each. Every pair of
features interacts through the product of two low-rank vectors. The sum over pairs is half of
(square of the sum) minus (sum of the squares), so a score takes time in proportion to the
features of a text.

The machine is fitted with numpy on a bounded sample of labelled rows; scoring runs on all rows
in Spark tasks.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityfold.llm.common import add_columns, bounded_sample, map_batches, materialise

WORD_BITS = 16
WORD_NORM = 0.3
RANK = 8
PER_LABEL = 8000
STEPS = 500
BATCH = 256
RATE = 0.1
DECAY = 1e-4
KEPT_WORDS = 150_000
SHARES = np.array([1e-9, 0.002, 0.005, 0.01, 0.015, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3, 0.45, 0.6, 0.75, 0.9, 1.5, 2.5])
BINS = len(SHARES) + 1
_KINDS = np.full(256, 7, np.uint8)
for _i, _chars in enumerate((b" \t\n\r\x0b\x0c", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b".,;:'\"-()", b"!?", b"#*$%&|<>")):
    _KINDS[list(_chars)] = _i
_KINDS[128:] = 8
STATISTICS = 13
FEATURES = (1 << WORD_BITS) + STATISTICS * BINS


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        bucket = xxhash.xxh32_intdigest(word) >> (32 - WORD_BITS)
        if len(word) <= 40:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = bucket
        return bucket


def features(text: str | None, recorded: int | None, buckets: _Buckets) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values; a text without words has its statistics alone."""
    data = (text or "").encode()
    words = data.split()
    n, counts = len(words), Counter(words)
    kinds = np.bincount(_KINDS[np.frombuffer(data, np.uint8)], minlength=9)
    lines = [x for x in data.split(b"\n") if x.strip()]
    letters, some, printed = kinds[1] + kinds[2], max(n, 1), max(len(data) - kinds[0], 1)
    shares = (
        kinds[2] / max(letters, 1),
        kinds[3] / printed,
        kinds[4] / some,
        kinds[5] / some,
        kinds[6] / some,
        kinds[7] / printed,
        kinds[8] / printed,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / some,
        len(counts) / some,
        1 - len(set(lines)) / max(len(lines), 1),
    )
    length = len(text or "") if recorded is None else max(recorded, 0)
    levels = [
        *np.searchsorted(SHARES, shares, "right").tolist(),
        min(BINS - 1, int(n).bit_length()),
        min(BINS - 1, int(length).bit_length()),
        min(BINS - 1, int(2 * printed / some)),
    ]
    fixed = np.arange(STATISTICS) * BINS + levels + (1 << WORD_BITS)
    if not n:
        return fixed, np.ones(STATISTICS, np.float32)
    hashed = np.fromiter(map(buckets.__getitem__, counts), np.int64, len(counts))
    weight = np.sqrt(np.fromiter(counts.values(), np.float32, len(counts)))
    return np.r_[hashed, fixed], np.r_[weight * (WORD_NORM / np.sqrt(n)), np.ones(STATISTICS, np.float32)].astype(np.float32)


@dataclass(frozen=True)
class Machine:
    """``bias``, a weight per feature and a vector of rank ``RANK`` per feature."""

    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def margin(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds per text and the sums of its weighted vectors; texts lie one after another."""
        scaled = self.factor[index] * value[:, None]
        total = np.add.reduceat(scaled, starts)
        pairs = (total * total - np.add.reduceat(scaled * scaled, starts)).sum(axis=1) / 2
        return self.bias + np.add.reduceat(self.weight[index] * value, starts) + pairs, total


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, importance: np.ndarray) -> Machine:
    """Logistic loss, AdaGrad, batches in a fixed random order."""
    random = np.random.default_rng(7)
    weight = np.zeros(FEATURES, np.float32)
    factor = random.normal(0, 0.01, (FEATURES, RANK)).astype(np.float32)
    rate = min(max(float(np.average(labels, weights=importance)), 0.01), 0.99) if len(rows) else 0.5
    bias, seen_w, seen_v = float(np.log(rate / (1 - rate))), np.full(FEATURES, 1e-6, np.float32), np.full((FEATURES, RANK), 1e-6, np.float32)
    order = np.empty(0, np.int64)
    for _ in range(STEPS if len(rows) and 0 < labels.sum() < len(labels) else 0):
        if len(order) < min(BATCH, len(rows)):
            order = np.r_[order, random.permutation(len(rows))]
        batch, order = order[:BATCH], order[BATCH:]
        sizes = np.array([len(rows[i][0]) for i in batch])
        index, value = (np.concatenate([rows[i][k] for i in batch]) for k in (0, 1))
        margin, total = Machine(bias, weight, factor).margin(index, value, np.r_[0, np.cumsum(sizes)[:-1]])
        error = (_sigmoid(margin) - labels[batch]) * importance[batch] / importance[batch].sum()
        each = np.repeat(error, sizes) * value
        used, at = np.unique(index, return_inverse=True)
        step_w = np.bincount(at, each) + DECAY * weight[used] / len(batch)
        slope = each[:, None] * (np.repeat(total, sizes, axis=0) - factor[index] * value[:, None])
        step_v = np.stack([np.bincount(at, slope[:, k]) for k in range(RANK)], axis=1) + DECAY * factor[used] / len(batch)
        seen_w[used] += step_w**2
        seen_v[used] += step_v**2
        weight[used] -= RATE * step_w / np.sqrt(seen_w[used])
        factor[used] -= 0.2 * RATE * step_v / np.sqrt(seen_v[used])
        bias -= RATE * float(error.sum())
    return Machine(bias, weight, factor)


def fit(
    df: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text",
    recorded: str = "n_chars", per_label: int = PER_LABEL,
) -> Machine:
    """Learn ``label`` (0 or 1, in ``labels`` by ``key``); rows without label, key or text do not count.

    ``per_label`` bounds the labelled rows of each class that are fitted; they are weighted back
    to the shares of the classes. Without both classes the score is the share of label 1, or a
    half without any.
    """
    chosen = bounded_sample(labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("_key"), F.col(label).alias("_y")), "_key", "_y", per_label)
    chosen = F.broadcast(materialise(chosen, "sample"))  # at most about 2 x per_label short rows
    known = df.where(F.col(text).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(recorded).cast("long").alias("_n"))

    def make():
        buckets = _Buckets()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, lengths = (batch.column(i).to_pylist() for i in (2, 3))
            found = [features(t, n, buckets) for t, n in zip(texts, lengths, strict=True)]
            sides = [pa.array([f[k].astype(t).tobytes() for f in found], pa.binary()) for k, t in ((0, np.int32), (1, np.float32))]
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(4), *sides], ["key", "y", "share", "i", "v"])

        return run

    joined = known.join(chosen, "_key").select(F.col("_key").cast("string"), F.col("_y").cast("int"), "_text", "_n", "_share")
    rows = map_batches(joined, make, "key string, y int, share double, i binary, v binary").collect()
    rows.sort(key=lambda r: (r["key"], r["i"], r["v"]))
    known_rows = [(np.frombuffer(r["i"], np.int32).astype(np.int64), np.frombuffer(r["v"], np.float32)) for r in rows]
    return train(known_rows, np.array([r["y"] for r in rows], float), np.array([1 / r["share"] for r in rows], float))


def score(
    df: DataFrame, machine: Machine, text: str = "text", recorded: str = "n_chars", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns ``keep`` and ``score`` (0 to 1, higher: label 1 is likelier).

    A null text is an empty one; a null ``recorded`` is taken from the text. Kept columns must
    not be called ``score``; others may have any name. Repeated rows score alike.
    """
    sent = df.sparkSession.sparkContext.broadcast(machine)

    def make():
        buckets = _Buckets()

        def run(texts: list[str | None], lengths: list[int | None]) -> list:
            if not texts:
                return [[]]
            found = [features(t, n, buckets) for t, n in zip(texts, lengths, strict=True)]
            index, value = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            starts = np.r_[0, np.cumsum([len(f[0]) for f in found])[:-1]]
            return [_sigmoid(sent.value.margin(index, value, starts)[0].astype(np.float64))]

        return run

    return add_columns(df, keep, (text, recorded), "score double", make, rows=64)
