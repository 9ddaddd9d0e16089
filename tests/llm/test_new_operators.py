"""Hard negatives, mixing and phrases: small tables against plain Python, edges, bounds of the methods."""

import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from entityfold.llm import mixing, negatives, phrases
from tests.llm import brute

CLASH = ("size", "target", "copies", "taken", "_row", "_from", "source_size", "f", "a", "l", "n", "k", "phrase", "anchor", "id", "vector", "r", "score")


def clash(df):
    return df.withColumns({c: F.lit("clash") for c in CLASH})


# ---- hard negatives


def plain_negatives(rows, chosen, n_positives=5, n_negatives=10):
    """rows {id: (label, [whole numbers])} -> {(anchor, positive): [(negative, score)]}"""
    out = {}
    for a in chosen:
        label, v = rows[a]
        score = {i: sum(x * y for x, y in zip(v, w, strict=False)) for i, (_, w) in rows.items() if i != a}
        first = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in first if rows[i][0] == label][:n_positives]:
            good = [i for i in first if rows[i][0] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            if good:
                out[a, p, score[p]] = [(i, score[i]) for i in good[:n_negatives]]
    return out


def mined(df, **more):
    found = defaultdict(list)
    for r in negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, **more).orderBy("anchor_id", "positive_id", "rank").collect():
        found[r.anchor_id, r.positive_id, r.positive_score].append((r.negative_id, r.negative_score))
        assert r["rank"] == len(found[r.anchor_id, r.positive_id, r.positive_score])
    return dict(found)


@pytest.mark.parametrize("blocks", [(4096, 65536), (3, 1024)])
@pytest.mark.parametrize("spread", [0.3, 2.0**30, 2.0**50])
def test_negatives_against_plain_version(spark, monkeypatch, blocks, spread):
    monkeypatch.setattr(negatives, "ANCHORS", blocks[0])
    monkeypatch.setattr(negatives, "CANDIDATES", blocks[1])
    pick = random.Random(7)
    rows = [(i, [pick.choice([pick.gauss(0.2, 1) * spread, 0.5]) for _ in range(6)], pick.randrange(3)) for i in range(160)]
    rows += [(i, [0.5] * 6, i % 3) for i in range(160, 200)]  # ties
    whole = {i: (label, [int(np.floor(256 * x)) for x in v]) for i, v, label in rows}
    want = plain_negatives(whole, [i for i in whole if i % 10 == 0])
    if spread > 1:  # scores are shown as the nearest long
        want = {(a, p, min(s, 2**63 - 1)): [(i, min(x, 2**63 - 1)) for i, x in v] for (a, p, s), v in want.items()}
        assert any(s == 2**63 - 1 for _, _, s in want)
    assert mined(clash(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))) == want
    assert want


def test_negatives_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 2), (3, [0.6], 2), (3, [0.6], 2), (4, [], 3)]
    rows += [(10, None, 1), (11, [nan, 1.0], 2), (12, [inf, 0.0], 2), (13, [None, 1.0], 2), (14, [0.7, 0.0], None), (None, [0.7, 0.0], 2), (20, [1.7e308], 2)]
    df = clash(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert mined(df) == {(0, 1, 65536): [(3, 153 * 256), (2, 128 * 256)]}
    assert mined(df.limit(0)) == {}
    assert mined(df.where("vec_id = 0")) == {}


@pytest.mark.parametrize("top", [1, 300, 2**20, 2**27, 2**70])
def test_packed_products_are_exact(top):
    pick = random.Random(top)
    a, b = ([[pick.randint(-top, top) for _ in range(9)] for _ in range(n)] for n in (5, 131))
    kind = object if top > 2**40 else np.float64
    got = negatives.inner_products(np.array(a, kind), np.array(b, kind))
    assert got.tolist() == [[sum(x * y for x, y in zip(p, q, strict=True)) for q in b] for p in a]


def test_several_candidates_share_an_integer():
    x, y = np.ones((1, 64), np.int64), np.full((10, 64), 200, np.int64)
    bits = (64 * 200).bit_length()
    assert negatives.WIDTH // bits == 3  # so one product serves three candidates
    assert (negatives._packed(x, y) == 64 * 200).all()


# ---- mixing


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Shares resharing the excess, as exact fractions."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = Fraction(sum(sizes.values())), {}
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * w[s] / sum(w[t] for t in free) for s in free}
        above = {s: Fraction(most * sizes[s]) for s in free if share[s] > most * sizes[s]}
        if not above:
            return share | capped
        capped |= above


def mixture(spark, sizes, seed=1):
    pick, rows = random.Random(seed), []
    for source, count in sizes.items():
        rows += [(len(rows) + i, " \t".join(["w"] * pick.randrange(1, 80)), source) for i in range(count)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 300, "B": 300, "é": 300, None: 300},
        {"a": 900, "b": 5, "c": 4, "d": 3, "e": 60},
        {"only": 50},
    ],
)
def test_mixture(spark, sizes):
    df = clash(mixture(spark, sizes))
    rows = mixing.mix(df, keep=("doc_id", "source", "text")).collect()
    assert len(rows) == df.count()
    of = Counter()
    for r in rows:
        assert r["size"] == len(brute.words(r.text))
        of[r.source] += r["size"]
    targets = plain_targets(dict(of))
    assert sum(targets.values()) == sum(of.values())
    taken = Counter()
    for r in rows:
        assert r.source_size == of[r.source]
        assert r.target == pytest.approx(float(targets[r.source]), rel=1e-12)
        rate = targets[r.source] / of[r.source]
        assert r.copies in (int(rate), int(rate) + (rate > int(rate)))
        assert r.taken == r.copies * r["size"] <= 3 * r["size"]
        taken[r.source] += r.taken
    for source, target in targets.items():
        assert abs(taken[source] - target) <= max(80, 0.02 * float(target))
    again = mixing.mix(df.repartition(5), keep=("doc_id", "source", "text")).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_mixture_edges(spark):
    rows = [(1, None, "a"), (1, "", "a"), (2, "x\x0by\x1cz\xa0 q", "b"), (2, "x\x0by\x1cz\xa0 q", "b"), (None, "n", None), (3, "w " * 60_000, "c")]
    df = clash(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    found = mixing.mix(df, keep=("doc_id", "size")).collect()
    assert Counter(r["size"] for r in found) == {0: 2, 3: 2, 1: 1, 60_000: 1}
    assert {(r.target, r.taken) for r in found if r["size"] == 0} == {(0.0, 0)}
    assert mixing.mix(df.limit(0)).collect() == []
    blank = mixing.mix(df.where("doc_id = 1")).collect()
    assert [(r.target, r.copies, r.taken) for r in blank] == [(0.0, 0, 0)] * 2


def test_documents_are_emitted_as_often_as_planned(spark):
    planned = mixing.mix(mixture(spark, {"a": 40, "b": 4}), keep=("doc_id", "text"))
    copies = {r.doc_id: r.copies for r in planned.collect()}
    out = Counter((r.doc_id) for r in mixing.emit(planned).collect())
    assert out == {i: n for i, n in copies.items() if n}
    assert max(out.values()) >= 2


def test_mixture_runs_no_python(spark):
    plan = mixing.mix(mixture(spark, {"a": 5}))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


# ---- phrases


def plain_phrases(rows, least=30, top=2000, inside=80):
    import re

    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            f[lang or "und"].update(tuple(w[i : i + k]) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        known = {p: c for p, c in count.items() if len(p) > 1 and c >= least}
        inner = Counter()
        for p, c in known.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inner[p[i : i + m]] = max(inner[p[i : i + m]], c)
        kept = []
        for p, a in known.items():
            cut = min((2000000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
            if not 100 * inner[p] >= inside * a:
                kept.append((-cut[0], -a, " ".join(p).encode(), count[p[: cut[1]]], count[p[cut[1] :]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):  # noqa: E741
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def wordy(count, seed=5):
    pick = random.Random(seed)
    base = ["the", "of", "New", "York", "éa", "x\x00y", "\U0001f600", "a\xa0b", "c\x85d", "B", "b"]
    rows = []
    for _ in range(count):
        words = pick.choices(base, weights=[9, 8, 4, 4, 3, 2, 2, 2, 1, 5, 5], k=pick.randrange(60))
        for _ in range(pick.randrange(4)):
            words.insert(pick.randrange(len(words) + 1), pick.choice(["new york city hall", "in spite of", "rare", "."]))
        rows.append((pick.choice([" ", "\t", "  "]).join(words) + pick.choice(["", "!", "\r\n", "\x0c b"]), pick.choice(["en", None, "und", "de"])))
    return rows


@pytest.mark.parametrize(("shard_words", "least", "top"), [(2_000_000, 30, 2000), (500, 30, 2000), (37, 4, 15)])
def test_phrases_against_plain_version(spark, monkeypatch, shard_words, least, top):
    monkeypatch.setattr(phrases.shards, "__defaults__", ("text", "lang", shard_words))
    rows = [*wordy(300), (None, "en"), ("", "en"), ("w " * 40_000 + "end", "fr"), ("of the " * 50, "de"), ("of the " * 50, "de")]
    df = clash(spark.createDataFrame([(t, x, i) for i, (t, x) in enumerate(rows)], "text string, lang string, doc_id long")).repartition(3)
    got = sorted(map(tuple, phrases.collocations(df, least, top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))
    assert got == plain_phrases(rows, least, top)
    assert len(got) > 10


def test_no_phrases(spark):
    df = spark.createDataFrame([("a b", "en")], "text string, lang string")
    assert phrases.collocations(df).collect() == []
    assert phrases.collocations(df.limit(0)).collect() == []


def test_index_counts_and_extensions():
    pick = random.Random(9)
    ids = np.array([0, *(pick.choice([0, 1, 1, 2, 3, 4]) for _ in range(400)), 0], np.int32)
    index = phrases.WordIndex(ids)
    want = Counter(tuple(ids[i : i + k]) for k in (1, 2, 3, 4) for i in range(len(ids) - k + 1) if ids[i : i + k].all())
    assert {(int(w[0]),): int(s) for w, s in zip(index.singles[0], index.singles[3], strict=True)} == {p: c for p, c in want.items() if len(p) == 1}
    for steps in (["left"] * 3, ["right"] * 3, ["left", "right", "left"], ["right", "left", "right"]):
        known = index.singles
        for length, step in enumerate(steps, 2):
            known = getattr(index, step)(*known)
            got = {tuple(map(int, w)): int(s) for w, s in zip(known[0], known[3], strict=True)}
            assert got == {p: c for p, c in want.items() if len(p) == length}


def test_transform_is_that_of_the_sorted_rotations():
    ids = np.array([0, 2, 1, 2, 1, 0, 2, 1, 3, 0], np.int32)
    order = sorted(range(len(ids)), key=lambda i: ([*ids[i : i + 4], 0, 0, 0, 0][:4], i))
    assert phrases.Transform(ids, 4).last.tolist() == [int(ids[i - 1]) for i in order]


def test_pairs_of_one_hash_do_no_harm(spark, monkeypatch):
    monkeypatch.setattr(phrases, "pair_keys", lambda hashes, pairs: np.zeros(len(pairs), np.int64))
    words = "a b c. a b d. "
    df = spark.createDataFrame([(words * 40, "en")], "text string, lang string")
    frequent, _ = phrases.frequent_phrases(df)
    assert {r.phrase: r.f for r in frequent.collect()} == {"a": 80, "b": 80, "c": 40, "d": 40, "a b": 80, "b c": 40, "b d": 40, "a b c": 40, "a b d": 40}


def test_a_frequent_pair_is_spelt_once(spark, monkeypatch):
    """One row over all shards, with the whole count; a pair that only two languages together make frequent gets none."""
    monkeypatch.setattr(phrases.shards, "__defaults__", ("text", "lang", 20))
    kind = type(spark.range(1))
    made, real = [], kind.groupBy
    monkeypatch.setattr(kind, "groupBy", lambda df, *by: [made.append(df) if df.columns == ["lang", "phrase", "f"] else None, real(df, *by)][1])
    rows = [("a b. c d.", "en")] * 40 + [("c d. e f", x) for x in ("de", "fr") for _ in range(20)]
    frequent, _ = phrases.frequent_phrases(spark.createDataFrame(rows, "text string, lang string").repartition(4))
    assert sorted(map(tuple, made[-1].collect())) == [("en", "a b", 40), ("en", "c d", 40)]
    assert sorted(tuple(r) for r in frequent.collect() if " " in r.phrase) == [("en", "a b", 40), ("en", "c d", 40)]


def test_a_pair_is_known_by_two_hashes(monkeypatch):
    monkeypatch.setattr(phrases, "pair_keys", lambda hashes, pairs: np.zeros(len(pairs), np.int64))
    words, ids = ["a", "b", "c"], np.array([0, 1, 2, 0, 1, 3, 0], np.int32)
    shard = phrases.pd.DataFrame({"lang": ["en"], "words": [words], "size": [len(ids)], "ids": [phrases.pack_ids(ids)]})
    mark = phrases.pair_checks(phrases.hash_words(words, "en")[1], np.array([[1, 2]]))
    given = phrases.pd.DataFrame({"pair": np.zeros(1, np.int64), "mark": mark, "f": [99]})
    assert phrases.shard_phrases(shard, given, 4).values.tolist() == [["en", "a b", 99]]
