import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from entityfold import operators as op
from entityfold.operators import relate
from entityfold.operators import GateError
from entityfold.operators.nest import collect_ordered


def as_tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_latest_per_key_orders_nulls_last_and_breaks_ties(rows):
    df = rows(
        [(1, 5, "b"), (1, None, "a"), (1, 5, "a"), (2, None, "z"), (None, 9, "x")],
        "k int, d int, n string",
    )
    assert as_tuples(op.latest_per_key(df, "k", [F.col("d").desc_nulls_last()])) == [
        (1, 5, "a"),
        (2, None, "z"),
    ]


def test_a_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(10_000).select((F.col("id") % 2).alias("k"), F.col("id").alias("d"))
    latest = op.latest_per_key(df, "k", [F.col("d").desc()])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange
    assert as_tuples(latest) == [(0, 9998), (1, 9999)]


def test_first_seen_keeps_every_row_without_a_key(rows):
    df = rows([("a", 2), ("a", 1), (None, 3), (None, 4)], "k string, p int")
    assert as_tuples(op.first_seen(df, "k", ["p"])) == [("a", 1), (None, 3), (None, 4)]


@pytest.fixture
def skewed(spark):
    """A third of the rows share a key, a third have none, the rest have their own."""
    n = 3000
    rng = random.Random(7)
    data = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{rng.randrange(200)}"
        data.append((i, key, "ARBN" if i % 5 == 0 else "ACN"))
    return data, spark.createDataFrame(data, "id long, key string, kind string")


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
@pytest.mark.parametrize("hot_rows", [50, 1_000_000])
def test_lookup_is_the_same_whatever_the_skew(spark, skewed, hot_rows, broadcast):
    data, base = skewed
    dim = {"hot": "H", **{f"k{i}": f"v{i}" for i in range(0, 200, 2)}}
    dims = spark.createDataFrame([*dim.items(), (None, "no key")], "dk string, v string")
    guard = F.col("kind") != "ARBN"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = op.lookup_guarded(base, dims, "key", "dk", guard, "id", hot_rows)
        want = [
            (i, k, kind, dim.get(k) if k is not None and kind != "ARBN" else None)
            for i, k, kind in data
        ]
        assert as_tuples(got) == sorted(want, key=repr)

        sides = {
            "one": dims.select(F.col("dk").alias("key"), F.col("v").alias("one")),
            "many": collect_ordered(
                dims.select(F.col("dk").alias("key"), "v"), "key", "many", {"v": F.col("v")}, ["v"]
            ),
        }
        bridge = op.bridge_secondary(base, "id", "key", guard, sides, hot_rows)
        found = as_tuples(bridge.select("id", "one", "many.v"))
        assert found == sorted(
            ((i, v, [v]) for i, _, _, v in want if v is not None), key=repr
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_wide_base_is_not_moved_by_its_secondary_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = spark.range(100).select("id", F.hash("id").alias("key"), F.lit("wide").alias("text"))
        base = base.withColumn("wide", F.concat("text", F.uuid()))
        dim = spark.range(50).select(F.hash("id").alias("dk"), F.col("id").alias("v"))
        guard = F.col("id") % 3 > 0
        out = op.lookup_guarded(base, dim, "key", "dk", guard, "id")
        plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan if "Exchange hashpartitioning" in line]
    assert exchanges and len([line for line in plan if "uuid" in line]) == 1


def test_hot_keys(rows):
    df = rows([("a",)] * 7 + [("b",)] * 3 + [(None,)] * 9, "k string")
    assert as_tuples(op.hot_keys(df, F.col("k"), 3)) == [("a", 3)]


def test_two_path_never_mixes_fields(rows):
    base = rows(
        [("1", "9", "ACN"), ("2", "9", "undetermined"), ("3", "9", "ARBN"), ("4", None, None)],
        "id string, num string, kind string",
    )
    side = rows(
        [("1", None, None, 5), (None, "9", "by number", 1), (None, "9", "newer", 2)],
        "abn string, acn string, name string, day int",
    )
    guard = ~F.coalesce("kind", F.lit("")).isin("ARBN")
    out = op.two_path(
        base,
        side,
        ("id", "abn"),
        ("num", "acn"),
        guard,
        "found",
        {"name": F.col("name"), "day": F.col("day")},
        [F.col("day").desc_nulls_last()],
    )
    got = {r["id"]: r["found"] and tuple(r["found"]) for r in out.collect()}
    assert got == {"1": (None, 5), "2": ("newer", 2), "3": None, "4": None}


def test_nest_one_tells_absence_from_empty_values(rows):
    base = rows([(1,), (2,)], "k int")
    dim = rows([(1, None)], "k int, v string")
    out = op.nest_one(base, dim, "k", "o", {"v": F.col("v")})
    assert {r["k"]: r["o"] for r in out.collect()}[2] is None
    assert out.where("k = 1 and o is not null").count() == 1


def test_nest_many_orders_nulls_last(rows):
    base = rows([(1,), (2,)], "k int")
    child = rows([(1, "b", 1), (1, None, 2), (1, "a", None), (1, "a", 3)], "k int, n string, d int")
    out = op.nest_many(base, child, "k", "x", {"n": F.col("n"), "d": F.col("d")}, ["n", "d"])
    got = {r["k"]: [tuple(v) for v in r["x"]] for r in out.collect()}
    assert got == {1: [("a", 3), ("a", None), ("b", 1), (None, 2)], 2: []}


def test_pages_hold_a_hot_group_whole_and_in_order(spark):
    child = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.hash("id").alias("v"),
        "id",
    )
    pages = op.nest_pages(child, "k", "x", {"id": F.col("id")}, ["v", "id"], 1700)
    hot = pages.where("k = 'hot'").orderBy("page").collect()
    assert len(hot) > 8 and max(len(r["x"]) for r in hot) < 4000
    ids = [v["id"] for r in hot for v in r["x"]]
    want = child.where("k = 'hot'").orderBy("v", "id").select("id").collect()
    assert ids == [r["id"] for r in want]


def test_long_lists(spark, rows):
    child = rows([(1,), (1,), (2,), (None,)], "k int")
    assert [tuple(r) for r in op.oversized_groups(child, "k", 1).collect()] == [(1, 2)]
    alike = spark.range(300_000).select(F.lit("k").alias("k"), F.lit(1).alias("v"))
    pages = op.nest_pages(alike, "k", "x", {"v": F.col("v")}, ["v"], 20_000)
    sizes = [r["n"] for r in pages.select(F.size("x").alias("n")).collect()]
    assert sum(sizes) == 300_000 and len(sizes) >= 12 and max(sizes) < 40_000
    base = rows([("k",), ("z",)], "k string")
    nested = op.nest_many(base, alike.limit(150_000), "k", "x", {"v": F.col("v")}, ["v"])
    assert {r["k"]: r["n"] for r in nested.select("k", F.size("x").alias("n")).collect()} == {
        "k": 150_000,
        "z": 0,
    }


def test_fanout(rows):
    base, out = rows([(1,), (2,)], "k int"), rows([(1,), (2,), (2,)], "k int")
    op.assert_no_fanout(base, base, "k")
    with pytest.raises(GateError, match="multiplied"):
        op.assert_no_fanout(base, out, "k")
    empty = rows([], "k int")
    assert tuple(op.fanout_report(empty, empty, "k").first()) == (0, 0, 0)
    for bad in ([(1,), (1,)], [(None,)]):
        with pytest.raises(GateError, match="repeated"):
            op.assert_unique(rows(bad, "k int"), "k")


RELEASE = (
    "ocid string, parties array<struct<roles:array<string>,"
    "identifier:struct<scheme:string,id:string>,"
    "additionalIdentifiers:array<struct<scheme:string,id:string>>>>,"
    "contracts array<struct<value:struct<amount:string>,dateSigned:string>>, pos int"
)


def test_extract_releases(rows):
    supplier = (["supplier"], ("AU-ABN", "40 000 000 654"), [("GB-COH", "12345678901")])
    buyer = (["procuringEntity"], None, [("AU-ABN", "33102417032")])
    twice = (["x", "supplier"], None, [("AU-ABN", "40000000654"), ("AU-ABN", "1"), ("AU-ABN", None)])
    data = [
        (
            "a",
            [supplier, buyer, twice],
            [(("1000.50",), "2024-09-01T00:00:00Z"), (("500",), "2018-03-15T00:00:00Z")],
            1,
        ),
        ("b", [(["supplier"], None, None)], [((None,), "short"), (("junk",), None), (None, None)], 2),
        (None, None, None, 3),
        ("c", [(None, ("AU-ABN", "40000000654"), None)], [], 4),
    ]
    got = as_tuples(op.extract_releases(rows(data, RELEASE), ["pos"]))
    assert got == sorted(
        [
            ("a", 1, ["40000000654"], 150050, "2018-03-15"),
            ("b", 2, [], 0, None),
            (None, 3, [], 0, None),
            ("c", 4, [], 0, None),
        ],
        key=repr,
    )


def test_awards(rows):
    data = [("r", 10000, "2022-05-01"), ("r", 25050, "2020-01-15"), ("r", 1, None), (None, 5, None)]
    df = rows(data, "recipient string, cents long, published string")
    assert as_tuples(op.awards_by_recipient(df)) == [("r", 35051, 3, "2020-01-15", "2022-05-01")]


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 30), max_size=40), min_size=1, max_size=3),
    st.sampled_from([1, 2, 7, 100]),
)
def test_order_breaks_for_any_block_size(spark, files, block):
    data = [(f"f{n}", i, v) for n, values in enumerate(files) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "file string, at long, id int")
    want = [
        (f"f{n}", i, values[i], values[i - 1])
        for n, values in enumerate(files)
        for i in range(1, len(values))
        if values[i] <= values[i - 1]
    ]
    assert as_tuples(op.order_breaks(df, "file", "at", "id", block)) == sorted(want, key=repr)


def test_rules_count_null_as_broken(rows):
    doc = rows([(1, "a"), (2, None)], "k int, v string")
    issues = op.check_documents(doc, "k", {"is a": F.col("v") == "a", "any": F.lit(True)})
    assert as_tuples(issues) == [(2, "is a")]
    assert as_tuples(op.rule_counts(issues)) == [("is a", 1)]


def test_coverage_of_nothing(rows):
    cov = op.coverage(rows([], "v string"), {"has v": F.col("v").isNotNull()})
    assert as_tuples(op.percent_coverage(cov)) == [("has v", 0, 0.0)]
    floors = rows([("has v", 1)], "name string, floor long")
    assert as_tuples(op.coverage_shortfalls(cov, floors)) == [("has v", 0, 1)]


def test_floor_of_a_source_that_loaded_nothing(rows):
    out = op.gate_floors(
        rows([("a", 5)], "source string, n long"),
        rows([("a", 5), ("b", 1)], "source string, floor long"),
    )
    assert as_tuples(out) == [("a", 5, 5, True), ("b", 0, 1, False)]


def test_compare_counts_treats_zero_as_absent(rows):
    shape = "k string, n long"
    now = rows([("a", 10), ("b", 0), ("c", 5), ("d", 3)], shape)
    before = rows([("a", 8), ("b", 4), ("c", 0), ("d", 3)], shape)
    out = op.compare_counts(now, before, "k", 0.25)
    assert {r["k"]: r["status"] for r in out.collect()} == {
        "a": "ok",  # exactly the threshold
        "b": "retired",
        "c": "appeared",
        "d": "ok",
    }


def test_shared_lists(spark, rows, monkeypatch):
    """Rows that share a list go to it; rows without a key, a list or the guard's leave stay without."""
    monkeypatch.setattr(relate, "SHARED_ROWS", 3)
    base = [(i, None if i % 5 == 0 else f"n{i % 4}", i % 7 != 0) for i in range(60)]
    items = [(f"n{n}", at) for n in range(3) for at in range(20 * n)] + [(None, 1)] * 50 + [("other", 1)]
    base_df, items_df = rows(base, "id long, key string, able boolean"), rows(items, "key string, at int")
    guard = F.col("able")
    assert relate.shared_lists(base_df, "key", guard, items_df, most=40) is None
    assert relate.shared_lists(base_df, "key", guard, items_df.limit(0)) is None
    assert relate.shared_lists(base_df.limit(0), "key", guard, items_df) is None
    shared = relate.shared_lists(base_df, "key", guard, items_df)
    lists = items_df.where("key is not null").groupBy("key").agg(F.sort_array(F.collect_list("at")).alias("list"))
    assert max(r.shared.parts for r in shared.collect()) > 1
    found = relate.bridge_secondary(base_df, "id", "key", guard, {"shared": shared})
    out = relate.join_shared(base_df.join(found, "id", "left"), "id", lists, "key", shared)
    want = {}
    for i, key, able in base:
        have = sorted(at for k, at in items if k == key) if key and able else []
        want[i] = have or None
    assert out.columns == ["id", "key", "able", "list"]
    got = out.collect()
    assert len(got) == len(base) and {r.id: r.list for r in got} == want
