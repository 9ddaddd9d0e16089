"""Quality rules: statistics of texts, and decision lists learned from labelled statistics.

The statistics of all texts are computed once. A decision list is learned by sequential
covering: conditions (statistic against a threshold) are added to a rule while they gain
information on two thirds of the labelled rows, dropped from its end while that helps on the
other third, and the rows it covers are set aside before the next rule. The list is a Spark
expression: ``when`` a rule holds the row is refused, otherwise it is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityfold.llm.common import bounded_sample, map_batches
from entityfold.llm.substrings import _Hashes, gram_hashes

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
UPPER = bytes(range(65, 91))
PHRASE = 5
PER_LABEL = 15_000
MAX_CONDITIONS = 4
MAX_RULES = 20
LEAST_PRECISION = 0.9
CUTS = 64
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_upper", "n_shouts", "n_adjacent")


def repeated_words(words: list[bytes], hashes: _Hashes) -> int:
    """How many words lie in a window of ``PHRASE`` words that the text has twice or more."""
    if len(words) <= PHRASE:
        return 0
    grams = gram_hashes(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)), PHRASE)
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(grams), np.int64)
    twice[order[1:][same]] = 1
    twice[order[:-1][same]] = 1
    return int((np.convolve(twice, np.ones(PHRASE, np.int64)) > 0).sum())


def statistics_of(text: str | None, hashes: _Hashes) -> tuple[int, ...]:
    """The counts ``BASE`` and ``MORE``; a null text has no words."""
    text = text or ""
    data = text.encode()
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (
        len(words),
        len(text) - sum(data.count(c) for c in BLANKS),
        sum(data.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words, hashes),
        len(lines),
        len(data) - len(data.translate(None, UPPER)),
        data.count(b"!"),
        sum(a == b for a, b in zip(words, words[1:], strict=False)),
    )


def statistics(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and the counts of each row, as longs; repeated rows stay repeated."""
    taken = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    names = (*BASE, *MORE)

    def make():
        hashes = _Hashes()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [statistics_of(t, hashes) for t in batch.column(1).to_pylist()]
            columns = np.array(found, np.int64).reshape(len(found), len(names)).T
            return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in columns)], [key, *names])

        return run

    fields = ", ".join(f"{n} long" for n in names)
    return map_batches(taken, make, f"`{key}` {df.schema[key].dataType.simpleString()}, {fields}")


def base_failed() -> Column:
    """Too short, or more than a fifth of the words in repeated windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def ratios() -> dict[str, Column]:
    """The statistics that rules compare, by name; never null.

    None depends on how long a text is or how long its words are, so that clean texts of rare
    lengths are not refused for want of examples.
    """

    def per(a: str, b: str) -> Column:
        return F.col(a).cast("double") / F.greatest(F.col(b), F.lit(1))

    return {
        "symbols": per("n_symbols", "n_words"),
        "dup_lines": per("n_dup_lines", "n_lines"),
        "repeats": per("n_repeat_words", "n_words"),
        "upper": per("n_upper", "word_chars"),
        "shouts": per("n_shouts", "n_words"),
        "adjacent": per("n_adjacent", "n_words"),
    }


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = ratios()[self.statistic]
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def _holds(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        value = x[:, names.index(c.statistic)]
        out &= value > c.threshold if c.above else value <= c.threshold
    return out


def _grow(x: np.ndarray, bad: np.ndarray, weight: np.ndarray, names: list[str]) -> Rule:
    """Add the condition of most information gain until only bad rows are covered."""
    rule: Rule = ()
    held = np.ones(len(x), bool)
    while len(rule) < MAX_CONDITIONS and (held & ~bad).any():
        p, n = weight[held & bad].sum(), weight[held & ~bad].sum()
        if not p:
            break
        best, most = None, 1e-9
        for k, name in enumerate(names):
            values, wb, wg = x[held, k], weight[held] * bad[held], weight[held] * ~bad[held]
            order = np.argsort(values, kind="stable")
            values, below_p, below_n = values[order], np.cumsum(wb[order]), np.cumsum(wg[order])
            ends = np.flatnonzero(values[1:] > values[:-1])
            if len(ends) > CUTS:  # the quantiles, and the widest gaps
                wide = ends[np.argsort(values[ends] - values[ends + 1], kind="stable")[:CUTS]]
                ends = np.unique(np.r_[ends[np.linspace(0, len(ends) - 1, CUTS).astype(int)], wide])
            for above in (True, False):
                pp = p - below_p[ends] if above else below_p[ends]
                nn = n - below_n[ends] if above else below_n[ends]
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pp > 1e-9, pp * (np.log2(pp / (pp + nn)) - np.log2(p / (p + n))), 0)
                if len(gain) and gain.max() > most:
                    at = int(gain.argmax())
                    most = float(gain[at])
                    best = Condition(name, above, float((values[ends[at]] + values[ends[at] + 1]) / 2))
        if best is None:
            break
        rule = (*rule, best)
        held &= _holds((best,), x, names)
    return rule


def learn(x: np.ndarray, bad: np.ndarray, weight: np.ndarray, names: list[str]) -> list[Rule]:
    """Rules that cover bad rows, in the order in which they were found."""
    third = np.arange(len(x)) % 3 == 0
    left = np.ones(len(x), bool)
    rules: list[Rule] = []
    while len(rules) < MAX_RULES and (left & bad & ~third).sum() >= 5:
        grown = left & ~third
        rule = _grow(x[grown], bad[grown], weight[grown], names)
        pruning = left & third

        def worth(r: Rule, on: np.ndarray = pruning) -> tuple[float, float]:
            held = _holds(r, x, names) & on
            p, n = weight[held & bad].sum(), weight[held & ~bad].sum()
            return (p - n) / max(p + n, 1e-9), p

        shorter = [rule[:i] for i in range(1, len(rule) + 1)]
        if not shorter:
            break
        rule = max(shorter, key=worth)
        held = _holds(rule, x, names) & left
        p, n = weight[held & bad].sum(), weight[held & ~bad].sum()
        if p < LEAST_PRECISION * (p + n) or not p:
            break
        rules.append(rule)
        left &= ~held
    return rules


def fit(
    stats: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", per_label: int = PER_LABEL
) -> list[Rule]:
    """Learn rules that refuse label 0 from the statistics of labelled rows.

    ``per_label`` bounds the labelled rows per class; they are weighted back to their shares.
    Without rows of both classes there is no rule.
    """
    named = ratios()
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("_key"), F.col(label).alias("_y"))
    joined = stats.select(F.col(key).alias("_key"), *(c.alias(n) for n, c in named.items())).join(known, "_key")
    rows = bounded_sample(joined, "_key", "_y", per_label).drop("_key").toPandas()
    names = list(named)
    rows = rows.sort_values([*names, "_y"], ignore_index=True)
    order = np.random.default_rng(5).permutation(len(rows))
    rows = rows.iloc[order]
    bad = rows["_y"].to_numpy() == 0
    if not bad.any() or bad.all():
        return []
    return learn(rows[names].to_numpy(float), bad, 1 / rows["_share"].to_numpy(float), names)


def kept(rules: list[Rule]) -> Column:
    """The decision list as an ordered conditional expression: false where a rule holds."""
    if not rules:
        return F.lit(True)
    out = None
    for rule in rules:
        held = rule[0].column()
        for c in rule[1:]:
            held &= c.column()
        out = F.when(held, False) if out is None else out.when(held, False)
    return out.otherwise(True)
