"""Every query of the package over whole small tables, against SQL or a plain version."""

import math
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from entityfold.llm import queries, sharding
from queries.registry import Query
from tests import oracle
from tests.llm import brute
from tests.llm.test_near_copies import groups_of

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(queries.BYTE_BPE)


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").collect()


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(PATH)


def run(spark, name):
    return queries.QUERIES[name](spark, FOLDER).collect()


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(queries.SQL) <= set(contract.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_agrees_with_sql(spark, con, name):
    assert oracle.difference(spark, con, Query(queries.QUERIES[name], queries.SQL[name]), FOLDER) is None


@pytest.mark.parametrize("limit", [1 << 20, 50_000, 3_000])
def test_shards_of_other_sizes(spark, con, limit):
    def shards(s, folder):
        size = sharding.F.octet_length("text").cast("long").alias("n_bytes")
        return sharding.assign_shards(s.read.parquet(f"{folder}/documents.parquet").select("doc_id", size), limit)

    assert oracle.difference(spark, con, Query(shards, queries.shards_sql(limit)), FOLDER) is None


def test_vector_links(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    want = brute.vector_links([tuple(r) for r in rows], 0.93)
    got = {r.vec_id: (r.n_links, r.component_id) for r in run(spark, "op1_covertree")}
    assert got == want


def check_pieces(rows, docs, model, capacity=2048):
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    assert set(pieces) == {d.doc_id for d in docs}
    for d in docs:
        ids, at = [*model.encode(d.text or "", add_special_tokens=False).ids, 0], 0
        for n, r in enumerate(sorted(pieces[d.doc_id], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (n, at)
            assert r.ids_crc32 == brute.crc(ids[at : at + r.length])
            assert r.length == capacity or n == 0
            at += r.length
        assert at == len(ids)
    return len(sequences), math.ceil(sum(r.length for r in rows) / capacity)


def test_packing(spark, docs, model):
    bins, bound = check_pieces(run(spark, "op2_pack"), docs, model)
    assert bins <= bound + 1


def test_quality_on_held_out(spark):
    """On the larger tables: the smallest hold 19 held-out labels and some ten bad rows to learn from."""
    folder = "/root/testdata/sf0.1"
    rows = queries.op3_quality(spark, folder).collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == 10_000
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    for wanted in (0, 1):
        tested = [r.predicted == wanted for r in rows if r.held_out and label.get(r.doc_id) == wanted]
        assert sum(tested) >= 0.98 * len(tested) > 100


def test_language_on_held_out(spark, docs):
    lang = {d.doc_id: d.lang for d in docs}
    rows = run(spark, "op6_language")
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    tested = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]
    assert len(rows) == 200
    assert sum(tested) >= 0.95 * len(tested)


def test_substrings(spark, docs):
    want = brute.without_repeats([(d.doc_id, d.text) for d in docs])
    assert any(n > len(kept) for n, kept in want.values())
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in run(spark, "op7_substrings")}
    assert got == {i: (n, n - len(kept), brute.sha(" ".join(kept))) for i, (n, kept) in want.items()}


def test_bpe(spark, docs, model):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in run(spark, "op8_bpe")}
    for d in docs:
        ids = model.encode(d.text or "", add_special_tokens=False).ids
        back = model.decode(ids, skip_special_tokens=False)
        assert got[d.doc_id] == (len(ids), brute.sha(brute.ids_bytes(ids)), brute.sha(back))


def test_rules(spark, docs):
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = run(spark, "op9_rules")
    text = {d.doc_id: d.text for d in docs}
    for r in rows:
        stats = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert stats == brute.rule_statistics(text[r.doc_id])
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    clean = [r.kept for r in rows if label.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(clean) >= 0.95 * len(clean)


def test_simhash(spark, docs):
    want = brute.near_duplicates([(d.doc_id, d.text) for d in docs])
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in run(spark, "op10_simhash")} == want


def test_pipeline(spark, docs, model):
    """Each stage against a plain version of its rule on its own input."""
    now = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = now.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = now
        now = corpus_pipeline.materialise(stage(spark, now, FOLDER), name)
        seen[name] = (before.collect(), now.collect())
        assert now.columns == columns or name == "best_fit_packing"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert len(seen["language_id"][1]) == len(docs)
    before, after = seen["quality_classifier"]
    kept = {r.doc_id for r in after}
    judged = [(r.doc_id in kept) == bool(label[r.doc_id]) for r in before if r.doc_id in label]
    assert sum(judged) >= 0.95 * len(judged)
    before, after = seen["simhash_near_dedup"]
    groups = groups_of([(d.doc_id, d.text) for d in before])
    assert {r.doc_id for r in after} == {i for i, component in groups.items() if i == component}
    before, after = seen["substring_dedup"]
    want = brute.without_repeats([(d.doc_id, d.text) for d in before])
    original = {d.doc_id: d.text for d in before}
    for r in after:
        n, words = want[r.doc_id]
        assert r.text == (original[r.doc_id] if n == len(words) else " ".join(words))
    check_pieces(seen["best_fit_packing"][1], seen["best_fit_packing"][0], model)
    full = corpus_pipeline.run(spark, FOLDER).drop("sequence_id", "offset").collect()
    assert sorted(full) == sorted(tuple(r[:5]) for r in seen["best_fit_packing"][1])
