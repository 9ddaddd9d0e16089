"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts per language and bucket are summed by Spark from a bounded sample of labelled rows; the
matrix of log-probabilities (languages x buckets) goes to the tasks with the scoring function,
and each batch is scored in numpy by looking up the buckets of its n-grams and summing them per
document.

The posterior says which learned language is likeliest, not whether the text is in any of them.
That is told by the mean log-probability of the n-grams of its words, against what the language
gives on the n-grams of its own texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityfold.llm.common import add_columns, bounded_sample

LETTER = regex.compile(r"\p{L}")
RUN = regex.compile(r"[\p{L}\p{M}]+")
DIGIT = regex.compile(r"\p{N}")
UNKNOWN = "und"
BUCKET_BITS = 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
PER_LANGUAGE = 4000
SHORT = 300  # n-grams; the mean of a text of so many strays sqrt(2) times as far as that of a long one
_STEP = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)


def plain_words(text: str) -> str:
    """Runs of letters of what is written without digits; of everything if nothing else has a letter."""
    found = RUN.findall(" ".join(w for w in text.split() if not DIGIT.search(w)))
    return " ".join(found or RUN.findall(text))


def ngram_buckets(codes: np.ndarray) -> list[np.ndarray]:
    """For each order the bucket of the n-gram that starts at each place (the last n-1 have none)."""
    out, mixed = [], np.zeros(len(codes), np.uint32)
    with np.errstate(over="ignore"):
        for n in range(1, max(ORDERS) + 1):
            mixed = (mixed[: len(codes) - n + 1] if n > 1 else mixed) * _STEP[0] + codes[n - 1 :] * _STEP[1]
            if n in ORDERS:
                hashed = (mixed ^ (mixed >> np.uint32(15))) * _STEP[2] + np.uint32(n)
                out.append(hashed >> np.uint32(32 - BUCKET_BITS))
            if len(mixed) < 2:
                mixed = mixed[:0]
                out += [mixed] * (len([o for o in ORDERS if o > n]))
                break
    return out


@dataclass(frozen=True)
class LanguageModel:
    """``log_p``: one row of log-probabilities per language; ``prior``: their log shares.

    ``level`` and ``spread``: mean and deviation of the log-probability of an n-gram in the texts
    that the language was learned from.
    """

    languages: tuple[str, ...]
    prior: np.ndarray
    log_p: np.ndarray
    level: np.ndarray = field(default_factory=lambda: np.empty(0))
    spread: np.ndarray = field(default_factory=lambda: np.empty(0))

    def _totals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language the sum of log-probabilities and prior; per text its n-grams."""
        parts = [code_points(t) for t in texts]
        sizes = np.array([len(p) for p in parts])
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        codes = np.concatenate(parts)
        # An n-gram that would reach into the next text starts in the last n-1 places of its own.
        total = np.tile(self.prior, (len(texts), 1)).astype(np.float64)
        for n, buckets in zip(ORDERS, ngram_buckets(codes), strict=True):
            padded = np.full(len(codes), 1 << BUCKET_BITS, np.int64)
            padded[: len(buckets)] = buckets
            for back in range(1, n):
                padded[starts + sizes - back] = 1 << BUCKET_BITS
            for k in range(len(self.languages)):
                total[:, k] += np.add.reduceat(self.log_p[k][padded], starts, dtype=np.float64)
        return total, sum(sizes - n + 1 for n in ORDERS)

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The likeliest language and its posterior; ``und`` and 0 without a letter or a model."""
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        rows = [i for i, t in enumerate(texts) if t and self.languages and LETTER.search(t)]
        if not rows:
            return names, scores
        total, _ = self._totals([texts[i] for i in rows])
        best = total.argmax(axis=1)
        weight = np.exp(total - total.max(axis=1, keepdims=True))
        sure = weight[np.arange(len(rows)), best] / weight.sum(axis=1)
        for i, b, s in zip(rows, best, sure, strict=True):
            names[i], scores[i] = self.languages[b], float(s)
        return names, scores

    def likeness(self, texts: list[str | None]) -> list[float | None]:
        """How far the mean log-probability of the words' n-grams is from the level of their likeliest
        language, in deviations that allow for the number of n-grams; null without a letter or a model.
        """
        found: list[float | None] = [None] * len(texts)
        rows = [i for i, t in enumerate(texts) if t and self.languages and LETTER.search(t)]
        if not rows:
            return found
        total, n = self._totals([plain_words(texts[i]) for i in rows])
        best = total.argmax(axis=1)
        mean = (total[np.arange(len(rows)), best] - self.prior[best]) / n
        away = (mean - self.level[best]) / (self.spread[best] * np.sqrt(1 + SHORT / n))
        for i, a in zip(rows, away, strict=True):
            found[i] = float(a)
        return found


def learned(languages: tuple[str, ...], counts: np.ndarray) -> LanguageModel:
    """The model of n-gram counts, one row per language."""
    smooth = counts + SMOOTHING
    log_p = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    share = counts / np.maximum(1, counts.sum(axis=1, keepdims=True))
    level = (share * log_p).sum(axis=1)
    spread = np.sqrt((share * (log_p - level[:, None]) ** 2).sum(axis=1))
    prior = np.full(len(languages), -np.log(max(1, len(languages))))
    log_p = np.pad(log_p.astype(np.float32), ((0, 0), (0, 1)))  # one more bucket, worth nothing, for places without n-gram
    return LanguageModel(languages, prior, log_p, level, np.maximum(spread, 1e-9))


def fit(
    df: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", per_language: int = PER_LANGUAGE
) -> LanguageModel:
    """Learn from rows with a label and a text.

    ``per_language`` bounds the sample of a language, see ``bounded_sample``.
    The priors are uniform. Without labelled rows the model knows no language.
    """
    labelled = df.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(label).alias("_label")
    )
    sample = bounded_sample(labelled, "_key", "_label", per_language).select("_label", "_text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = sums.setdefault(name, np.zeros(1 << BUCKET_BITS, np.int64))
                for buckets in ngram_buckets(code_points(value)):
                    own += np.bincount(buckets, minlength=1 << BUCKET_BITS)
        for name, own in sums.items():
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used), pa.array(own[used])], ["_label", "bucket", "n"]
            )

    def dense(group: pd.DataFrame) -> pd.DataFrame:
        row = np.zeros(1 << BUCKET_BITS, np.float64)
        np.add.at(row, group["bucket"].to_numpy(), group["n"].to_numpy())
        return pd.DataFrame({"label": [group["_label"].iloc[0]], "row": [row.tobytes()]})

    summed = sample.mapInArrow(count, "_label string, bucket long, n long").groupBy("_label", "bucket").agg(F.sum("n").alias("n"))
    rows = sorted(tuple(r) for r in summed.groupBy("_label").applyInPandas(dense, "label string, row binary").collect())
    counts = np.array([np.frombuffer(r[1], np.float64) for r in rows]).reshape(len(rows), 1 << BUCKET_BITS)
    return learned(tuple(r[0] for r in rows), counts)


def predict(
    df: DataFrame, model: LanguageModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",), likeness: bool = False
) -> DataFrame:
    """The columns ``keep``, ``lang_pred`` and ``score``; on demand also ``likeness``.

    A null text, or one without a letter, is ``und`` with score 0; so is every text if the model
    knows no language. Whole texts are read; ties go to the first language by name. Kept columns
    must not be called ``lang_pred``, ``score`` or ``likeness``; others may have any name.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)
    if likeness:
        make = lambda: lambda texts: [*sent.value.score(texts), sent.value.likeness(texts)]
        return add_columns(df, keep, (text,), "lang_pred string, score double, likeness double", make, rows=64)
    make = lambda: lambda texts: list(sent.value.score(texts))
    return add_columns(df, keep, (text,), "lang_pred string, score double", make, rows=64)
