"""Nulls, empty and very long texts, ties, repeated rows, empty tables, columns of clashing names."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from entityfold.llm import bpe, common, covertree, langid, licences, packing, quality, rules, sharding, simhash, substrings
from tests.llm import brute
from tests.llm.test_near_copies import groups_of
from tests.llm.test_text_queries import check_pieces

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("_id", "_version", "n_words", "kept_text", "likeness", "odd name", "doc", "version", "ids", "score", "fp", "piece", "label", "node", "key", "start", "shard", "h", "_text", "lang_pred", "u", "v")
PASSAGE = " ".join(f"w{i}" for i in range(60))
LONG = " ".join(random.Random(3).choices([f"word{i}" for i in range(500)], k=40_000))
TEXTS = [
    (1, ""), (2, None), (3, "one"), (3, "one"), (4, LONG), (5, " \n\t "), (6, "a<|endoftext|> b été fin  x"),
    (7, f"start {PASSAGE} end"), (8, f"other {PASSAGE} tail tail"), (8, f"third {PASSAGE} words"), (None, f"no {PASSAGE} id"),
    (None, None), (9, "A B c"), (10, "a b C"), (11, PASSAGE), (12, "12 34 -- !!"), (13, PASSAGE), (14, "x\x1cy z\x85q  \r\n  end \n"),
    (15, "don't I'll we’re 'S 123abc  你好 \U0001f600 ́"),
]


def frame(spark, rows=TEXTS, extra=True):
    full = [(i, t, "en" if i and i % 2 else None, "s", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASH}) if extra else df


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def test_bpe(spark, docs, none):
    model = Tokenizer.from_file(PATH)
    rows = bpe.round_trip(docs, PATH, keep=("doc_id", "text")).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert r.ids == brute.ids_bytes(model.encode(r.text or "", add_special_tokens=False).ids)
        assert r.decoded == (r.text or "")
    assert bpe.decode(bpe.encode(none, PATH), PATH).collect() == []
    assert bpe.decode(bpe.encode(docs, PATH), PATH).where("decoded is null").count() == 0


def test_encoder_on_random_texts():
    model, encoder, pick = Tokenizer.from_file(PATH), bpe.Encoder(PATH), random.Random(5)
    letters = "ab'st \n\t\r\x0b\x1c\x85  éßа你\U0001f600!#1 2."
    for _ in range(1500):
        text = "".join(pick.choices(letters, k=pick.randrange(40)))
        assert encoder.encode(text) == brute.ids_bytes(model.encode(text, add_special_tokens=False).ids), repr(text)


def test_other_vocabulary():
    """A vocabulary that is no byte-level one is encoded by its own library."""
    path = public_tokenizers.path("word_bpe_49k.json")
    assert bpe._ranks(path) is None


def test_forced_boundaries():
    inside = bpe.joined_pairs({0: b"ab", 1: b"bc", 2: b"d"})
    assert inside[ord("a"), ord("b")]
    assert not inside[ord("c"), ord("d")]


def test_packing(spark, docs, none):
    model = Tokenizer.from_file(PATH)
    one_each = frame(spark, [(i, t) for i, t in enumerate(t for _, t in TEXTS)])
    found = packing.pack_documents(one_each, PATH).collect()
    check_pieces(found, one_each.collect(), model)
    again = packing.pack_documents(docs, PATH).collect()
    assert sorted(r.length for r in again) == sorted(r.length for r in found)
    assert packing.pack_documents(none, PATH).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plan_of_bins(seed):
    pick = random.Random(seed)
    counts = {n: pick.randrange(1, 50) for n in pick.sample(range(1, 101), 40 if seed else 1)}
    plan = packing.plan_bins(counts, 100)
    placed = {}
    for how_many, contents in plan:
        assert sum(n * t for n, t in contents) <= 100
        assert sum(t for n, t in contents if 3 * n > 100) <= 2
        for n, t in contents:
            placed[n] = placed.get(n, 0) + how_many * t
    assert placed == counts
    bound = -(-sum(n * c for n, c in counts.items()) // 100)
    big = sum(c for n, c in counts.items() if 2 * n > 100)
    assert sum(m for m, _ in plan) <= 1.1 * max(bound, big) + 1


def test_languages(spark, docs, none):
    model = langid.fit(docs, label="lang")
    rows = langid.predict(docs, model, keep=("doc_id", "text")).collect()
    assert all(r.lang_pred == "en" and r.score == 1 for r in rows if r.text and any(c.isalpha() for c in r.text))
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if not r.text or not any(c.isalpha() for c in r.text))
    empty = langid.fit(none, label="lang")
    assert {r.lang_pred for r in langid.predict(docs, empty).collect()} == {"und"}
    assert langid.predict(none, model).collect() == []


def test_languages_in_batches_and_alone():
    model = langid.LanguageModel(("a", "b"), np.zeros(2), np.random.default_rng(1).normal(size=(2, (1 << langid.BUCKET_BITS) + 1)))
    model.log_p[:, -1] = 0
    texts = ["x", "some words", "", None, "é" * 30, "tail"]
    together = model.score(texts)
    assert list(zip(*together, strict=True)) == [tuple(x[0] for x in model.score([t])) for t in texts]


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 12)] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    machine = quality.fit(docs, labels, "quality")
    rows = quality.score(docs, machine).collect()
    assert len(rows) == len(TEXTS)
    assert all(0 <= r.score <= 1 for r in rows)
    assert quality.score(none, machine).collect() == []
    untaught = quality.fit(none, labels.limit(0), "quality")
    assert {round(r.score, 1) for r in quality.score(docs, untaught).collect()} == {0.5}


def test_machine_equals_sum_over_pairs():
    random_ = np.random.default_rng(2)
    machine = quality.Machine(0.1, random_.normal(size=quality.FEATURES), random_.normal(size=(quality.FEATURES, quality.RANK)))
    index, value = np.array([3, 70, 5000]), np.array([0.5, 1.0, 2.0])
    pairs = sum(machine.factor[a] @ machine.factor[b] * x * y for a, b, x, y in ((3, 70, 0.5, 1), (3, 5000, 0.5, 2), (70, 5000, 1, 2)))
    got = machine.margin(index, value, np.array([0]))[0][0]
    assert got == pytest.approx(0.1 + machine.weight[index] @ value + pairs)


def test_rules(spark, docs, none):
    stats = rules.statistics(docs.withColumn("n", F.lit(1)))
    assert sorted(tuple(r[1:6]) for r in stats.collect()) == sorted(brute.rule_statistics(t) for _, t in TEXTS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 12)], "doc_id long, quality int")
    assert rules.fit(stats, labels.limit(0)) == []
    assert stats.select(rules.kept([]).alias("k")).where("k").count() == len(TEXTS)
    assert rules.statistics(none).collect() == []


def test_rules_learn_conjunctions(spark):
    random_ = np.random.default_rng(4)
    x = random_.uniform(size=(3000, 2))
    bad = (x[:, 0] > 0.8) & (x[:, 1] <= 0.3)
    found = rules.learn(x, bad, np.ones(len(x)), ["symbols", "upper"])
    held = np.zeros(len(x), bool)
    for rule in found:
        held |= rules._holds(rule, x, ["symbols", "upper"])
    assert (held == bad).mean() > 0.98
    rows = spark.createDataFrame([(10, 9, 1, 1), (10, 9, 9, 1), (10, 9, 9, 9)], "n_words long, n_symbols long, word_chars long, n_upper long")
    rule = [(rules.Condition("symbols", True, 0.8), rules.Condition("upper", False, 0.3))]
    more = rows.withColumns({c: F.lit(0) for c in ("n_dup_lines", "n_lines", "n_repeat_words", "n_shouts", "n_adjacent")})
    assert [r.k for r in more.select(rules.kept(rule).alias("k")).collect()] == [True, False, True]


def test_simhash(spark, docs, none):
    unique = [(i, t) for i, t in enumerate(t for _, t in TEXTS)]
    want = brute.near_duplicates(unique)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(frame(spark, unique)).collect()}
    assert got == want
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(TEXTS)
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {1}
    assert simhash.near_duplicates(none).collect() == []


def test_simhash_long_lists(spark, monkeypatch):
    """Lists cut into many blocks give the same groups as lists in one block."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    pick, prints = random.Random(1), set()
    for center in (0, (1 << 64) - 1, 0x0123456789ABCDEF):
        for _ in range(120):
            value = center
            for bit in pick.sample(range(64), pick.randrange(5)):
                value ^= 1 << bit
            prints.add(value)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.fingerprint_links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    found = {r.node: r.component for r in common.connected_components(links, "a", "b").collect()}
    groups = brute.Groups(signed)
    for n, a in enumerate(signed):
        for b in signed[n + 1 :]:
            if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3:
                groups.join(a, b)
    assert {p: found.get(p, p) for p in signed} == {p: groups.find(p) for p in signed}


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)] + [(300, 301), (7, 7), (None, 5)]
    found = {r.node: r.component for r in common.connected_components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert found == {i: 0 for i in range(201)} | {300: 300, 301: 300}


def test_substrings(spark, docs, none):
    rows = substrings.remove_repeats(docs, keep=("doc_id", "text")).collect()
    assert len(rows) == len(TEXTS)
    kept = {(r.doc_id, r.text): (r.n_words, r.kept_text) for r in rows}
    assert kept[7, f"start {PASSAGE} end"][1] == f"start {PASSAGE} end"
    assert kept[8, f"other {PASSAGE} tail tail"] == (63, "other tail tail")
    assert kept[8, f"third {PASSAGE} words"] == (62, "third words")
    assert kept[None, f"no {PASSAGE} id"][1] == f"no {PASSAGE} id"
    assert kept[11, PASSAGE] == kept[13, PASSAGE] == (60, "")
    assert kept[2, None] == (0, "")
    assert substrings.remove_repeats(none).collect() == []


def test_substrings_against_plain_version(spark):
    """Few words and much repetition: paths branch everywhere."""
    pick = random.Random(8)
    blocks = [" ".join(pick.choices("abcdefgh", k=pick.randrange(3, 40))) for _ in range(12)]
    rows = [(i, " ".join(pick.choices(blocks, k=pick.randrange(1, 9)))) for i in range(60)] + [(70, "z " * 300), (71, "z " * 90)]
    want = brute.without_repeats(rows)
    got = {r.doc_id: (r.n_words, r.kept_text) for r in substrings.remove_repeats(frame(spark, rows)).collect()}
    assert got == {i: (n, " ".join(kept)) for i, (n, kept) in want.items()}
    assert sum(n - len(kept) for n, kept in want.values()) > 1000


@pytest.mark.parametrize("n", [1, 2, 3, 12, 39, 50])
def test_runs(n):
    values = np.random.default_rng(n).integers(0, 1 << 63, 200).astype(np.uint64)
    assert substrings.sliding_min(values, n).tolist() == [int(values[i : i + n].min()) for i in range(201 - n)]
    grams = substrings.gram_hashes(np.r_[values, values], n)
    assert len(set(grams.tolist())) == 200
    assert (grams[: 201 - n] == grams[200:]).all()


VECTORS = [
    (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [0.0, 1.0], 1), (5, [0.99, 0.1], 1), (6, [1.0, 0.0], 2),
    (7, None, 1), (8, [0.0, 0.0], 1), (9, [1.0, None], 1), (10, [float("nan"), 1.0], 1), (11, [float("inf"), 1.0], 1),
    (12, [1.0, 0.0], None), (13, [], 1), (14, [1.0, 0.0, 0.0], 1), (15, [1e300, 0.0], 1), (16, [0.9, 0.5], 1),
]


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return df.withColumns({c: F.lit("clash") for c in ("node", "key", "cell", "unit", "size", "copies", "first")})


def test_vectors(spark):
    got = {r.vec_id: (r.n_links, r.component_id) for r in covertree.vector_links(vectors(spark, VECTORS), 0.93).collect()}
    assert got == brute.vector_links(VECTORS, 0.93)
    assert covertree.vector_links(vectors(spark, []), 0.93).collect() == []
    rows = covertree.vector_links(vectors(spark, [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1)]), 0.93).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in rows) == [(0, 0, 0, False), (1, 1, 1, True), (1, 1, 1, True)]


def test_vectors_in_many_cells(spark, monkeypatch):
    monkeypatch.setattr(covertree, "CELL", 40)
    random_ = np.random.default_rng(6)
    centers = random_.normal(size=(6, 8))
    rows = [(i, (centers[i % 6] + random_.normal(size=8) * (0.05 if i % 3 else 0.6)).tolist(), i % 2) for i in range(400)]
    rows += [(500 + i, rows[0][1], 0) for i in range(50)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in covertree.vector_links(vectors(spark, rows), 0.93).collect()}
    assert got == brute.vector_links(rows, 0.93)


def test_traversal_equals_comparison():
    random_ = np.random.default_rng(9)
    rows = np.concatenate([c + random_.normal(size=(150, 5)) * s for c in random_.normal(size=(4, 5)) for s in (0.01, 0.1, 0.5)])
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    links = covertree.Links(rows, np.ones(len(rows), np.int64), 0.93)
    root = covertree.Node(rows, np.arange(len(rows)))
    assert root.parts
    links.traverse(root, root)
    near = rows @ rows.T >= 0.93
    assert links.count.tolist() == (near.sum(axis=1) - 1).tolist()


def test_licences(spark, docs, none):
    notice = licences.TEMPLATES["mit-notice"]
    broken = notice.replace("sublicense", "lend").replace("persons", "people")
    rows = [
        (1, f"{LONG} {notice} {LONG}"), (1, "released under the mit license"), (2, broken), (3, notice[:300]), (4, None), (5, ""),
        (6, "Licensed under the Apache License, Version 2.1."), (None, "see: RELEASED under\nthe MIT-License!"),
    ]
    found = {(r.doc_id, r.template): r for r in licences.scan(frame(spark, rows)).collect()}
    assert set(found) == {(1, "mit-notice"), (1, "mit-line"), (2, "mit-notice"), (None, "mit-line")}
    assert found[1, "mit-notice"].containment == 1
    assert 0.8 <= found[2, "mit-notice"].containment < 1
    assert licences.scan(none).collect() == []
    assert licences.scan(docs, {"no words": " - "}).collect() == []
    assert licences.scan(docs).collect() == []


def test_short_licence_notices(spark):
    rows = [
        (1, f"{LONG} All rights reserved. {LONG}"), (2, "// SPDX-License-Identifier: MIT"), (3, "all rights are reserved"),
        (4, "rights reserved"), (5, "SPDX-License-Identifier: Apache-2.0"), (6, "x. ALL RIGHTS\nRESERVED"), (6, "all rights reserved"),
    ]
    found = {(r.doc_id, r.template, r.word) for r in licences.scan(frame(spark, rows)).collect()}
    at = len(LONG.split())
    assert {(k, t) for k, t, _ in found} == {
        (1, "all-rights-reserved"), (2, "spdx-mit"), (5, "spdx-apache-2.0"), (6, "all-rights-reserved"),
    }
    assert (1, "all-rights-reserved", at) in found
    assert (6, "all-rights-reserved", 0) in found
    few = licences.scan(frame(spark, rows), {"one": "reserved", "two": "rights reserved", "five": "all rights are so reserved"})
    assert {(r.doc_id, r.template) for r in few.collect()} == {(k, t) for k in (1, 3, 4, 6) for t in ("one", "two")} - {(3, "two")}


def test_licences_at_any_place_with_words_between(spark):
    """A notice broken by other words is found wherever it begins, up to half its length."""
    isc = licences.TEMPLATES["isc"].split()
    rows, wanted = [], {}
    for between in (0, 8, 12, 17, 30):
        for before in range(9):
            key = len(rows)
            text = [f"w{i}" for i in range(before)] + isc[:15] + [f"x{i}" for i in range(between)] + isc[15:]
            rows.append((key, " ".join([*text, "end"])))
            if between <= 17:
                wanted[key] = before
    found = licences.scan(frame(spark, rows)).where("template = 'isc'").collect()
    assert {r.doc_id: r.word for r in found} == wanted
    assert {r.containment for r in found} == {1, 26 / 30}


def test_licence_bands_miss_few(spark):
    """A window that holds a passage shares a band with the template but for one case in a million."""
    for r in licences.template_table(spark, licences.TEMPLATES).collect():
        size = len(r.shingles)
        need = -(-size * 4 // 5)
        least = need / (size + licences.width(r.n) - need)
        assert (1 - least) ** licences.BANDS < 1e-6


def test_licence_scan_runs_no_python(spark, docs):
    plan = licences.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert "Arrow" not in plan
    assert "Pandas" not in plan


def sizes(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, n_bytes long")
    return df.withColumns({c: F.lit("clash") for c in ("source", "cell", "prefix")})


def test_shards(spark, tmp_path):
    rows = [(i, 100) for i in range(200)] + [(7, 100)] * 300 + [(None, 50), (500, None), (501, 5000), (501, 5000)]
    found = sharding.assign_shards(common.materialise(sizes(spark, rows), "t"), 1000)
    assert found.count() == len(rows)
    files = found.groupBy("shard", "part").agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n")).collect()
    assert all((f.b or 0) <= 1000 or f.n == 1 for f in files)
    leaves = {r.shard for r in found.select("shard").distinct().collect()}
    assert not any(a != b and b.startswith(a) for a in leaves for b in leaves)
    assert sharding.assign_shards(sizes(spark, []), 1000).collect() == []
    sharding.write_shards(found, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)


def test_pipeline_stages(spark, docs, none, tmp_path):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 12)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    plain = frame(spark, extra=False)
    for df in (plain, plain.limit(0), docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, str(tmp_path))
            rows = out.collect()
            assert out.columns == df.columns or name == "best_fit_packing"
            if len(df.columns) > 5 and name != "best_fit_packing":  # columns of any name go along
                assert {r[c] for r in rows for c in CLASH} <= {"clash"}
            if not df.count():
                assert rows == []
            if name == "simhash_near_dedup" and rows:
                groups = groups_of(list(enumerate(t for _, t in TEXTS)))
                assert len(rows) == len(set(groups.values()))
            if name == "substring_dedup":
                assert len(rows) == df.count()
