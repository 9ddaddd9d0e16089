"""One row per key, lookups, nesting."""

from pyspark.sql import functions as F

from entityfold.operators import (
    bridge_secondary,
    fanout_report,
    first_seen,
    hot_keys,
    latest_per_key,
    lookup_guarded,
    nest_many,
    nest_one,
    nest_pages,
    oversized_groups,
    two_path,
)
from entityfold.operators.nest import collect_ordered
from queries.registry import big, query, table

def _day():
    return F.to_date("o_orderdate")



@query("""
    SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, d
    FROM (SELECT o_custkey, o_orderkey,
                 CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS d
          FROM orders)
    ORDER BY o_custkey, d DESC NULLS LAST, o_orderkey
""")
def latest_nulls_last(spark, d):
    orders = table(spark, d, "orders").select(
        "o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") != "P", _day()).alias("d")
    )
    return latest_per_key(orders, "o_custkey", [F.col("d").desc_nulls_last(), F.col("o_orderkey")])


@query("""
    SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, d
    FROM (SELECT o_custkey, o_orderkey,
                 CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS d
          FROM orders)
    ORDER BY o_custkey, d ASC NULLS LAST, o_orderkey
""")
def first_asc(spark, d):
    orders = table(spark, d, "orders").select(
        "o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") != "P", _day()).alias("d")
    )
    return latest_per_key(orders, "o_custkey", [F.col("d").asc_nulls_last(), F.col("o_orderkey")])


@query("""
    SELECT key, event_id
    FROM (SELECT CASE WHEN event_type <> 'error' THEN concat(user_id, '/', event_type) END AS key,
                 event_id, ts
          FROM events)
    QUALIFY key IS NULL OR row_number() OVER (PARTITION BY key ORDER BY ts, event_id) = 1
""")
def first_seen_by_key(spark, d):
    key = F.when(F.col("event_type") != "error", F.concat_ws("/", "user_id", "event_type"))
    events = table(spark, d, "events").select(key.alias("key"), "event_id", "ts")
    return first_seen(events, "key", ["ts", "event_id"]).select("key", "event_id")


@query("""
    SELECT c_custkey, o_orderkey IS NOT NULL AS present, o_orderkey AS order_key,
           CAST(o_orderdate AS DATE) AS order_day
    FROM customer LEFT JOIN (
        SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_orderdate FROM orders
        WHERE o_orderstatus = 'F' AND o_totalprice > 250000
        ORDER BY o_custkey, o_orderdate DESC, o_orderkey) ON o_custkey = c_custkey
""")
def nest_one_object(spark, d):
    big_orders = (
        table(spark, d, "orders")
        .withColumn("wanted", F.expr("o_orderstatus = 'F' and o_totalprice > 250000"))
        .select(F.when(F.col("wanted"), F.col("o_custkey")).alias("c_custkey"), "o_orderkey", "o_orderdate")
    )
    latest = latest_per_key(
        big_orders, "c_custkey", [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey")]
    )
    fields = {"key": F.col("o_orderkey"), "day": _day()}
    out = nest_one(table(spark, d, "customer").select("c_custkey"), latest, "c_custkey", "o", fields)
    return out.select(
        "c_custkey",
        F.col("o").isNotNull().alias("present"),
        F.col("o.key").alias("order_key"),
        F.col("o.day").alias("order_day"),
    )


@query("""
    SELECT c_custkey, coalesce(keys, '') AS keys, coalesce(n, 0) AS n
    FROM customer LEFT JOIN (
        SELECT o_custkey, count(*) AS n,
               string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY d NULLS LAST, o_orderkey) AS keys
        FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS d
              FROM orders WHERE o_totalprice > 250000)
        GROUP BY o_custkey) ON o_custkey = c_custkey
""")
def nest_many_objects(spark, d):
    child = (
        table(spark, d, "orders")
        .select(
            F.when(F.col("o_totalprice") > 250000, F.col("o_custkey")).alias("c_custkey"),
            "o_orderkey",
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("d"),
        )
    )
    fields = {"key": F.col("o_orderkey")}
    base = table(spark, d, "customer").select("c_custkey")
    out = nest_many(base, child, "c_custkey", "orders", fields, ["d", "o_orderkey"])
    keys = F.array_join(F.transform("orders", lambda o: o["key"].cast("string")), ",")
    return out.select("c_custkey", keys.alias("keys"), big(F.size("orders")).alias("n"))


@query("""
    SELECT l_returnflag, CAST(sum(l_orderkey) AS BIGINT) AS keys, count(*) AS items,
           min(l_orderkey) AS first_key, max(l_orderkey) AS last_key
    FROM lineitem GROUP BY l_returnflag
""")
def nest_many_in_pages(spark, d):
    """Three keys hold all rows; each is nested in pages, and the pages add up to the whole."""
    child = table(spark, d, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber")
    fields = {"key": F.col("l_orderkey")}
    pages = nest_pages(child, "l_returnflag", "x", fields, ["l_orderkey", "l_linenumber"], 20_000)
    keys = F.col("x.key")
    total = F.aggregate(keys, F.lit(0).cast("bigint"), lambda a, k: a + k)
    return pages.groupBy("l_returnflag").agg(
        F.sum(total).alias("keys"),
        F.sum(big(F.size("x"))).alias("items"),
        F.min(F.element_at(keys, 1)).alias("first_key"),
        F.max(F.element_at(keys, -1)).alias("last_key"),
    )


@query("""
    SELECT o_custkey, count(*) AS "count" FROM orders GROUP BY o_custkey HAVING count(*) > 15
""")
def nest_oversized_groups(spark, d):
    return oversized_groups(table(spark, d, "orders"), "o_custkey", 15)


_TOP_SUPPLIER = """
    SELECT DISTINCT ON (s_nationkey) s_nationkey, s_suppkey, s_name
    FROM supplier ORDER BY s_nationkey, s_acctbal DESC, s_suppkey
"""


def _top_supplier(spark, d):
    suppliers = table(spark, d, "supplier")
    order = [F.col("s_acctbal").desc_nulls_last(), F.col("s_suppkey")]
    return latest_per_key(suppliers, "s_nationkey", order)


@query(f"""
    SELECT c_custkey, s_suppkey, s_name
    FROM customer LEFT JOIN ({_TOP_SUPPLIER})
      ON s_nationkey = c_nationkey AND c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
""")
def lookup_with_guard(spark, d):
    guard = ~F.coalesce("c_mktsegment", F.lit("")).isin("BUILDING", "MACHINERY")
    top = _top_supplier(spark, d).select("s_nationkey", "s_suppkey", "s_name")
    out = lookup_guarded(
        table(spark, d, "customer"), top, "c_nationkey", "s_nationkey", guard, "c_custkey"
    )
    return out.select("c_custkey", "s_suppkey", "s_name")


@query("""
    SELECT l_returnflag, CAST(ceil(count(*) / 1000.0) AS BIGINT) AS parts FROM lineitem
    GROUP BY l_returnflag HAVING count(*) > 1000
""")
def lookup_hot_keys(spark, d):
    """Values with more than a thousand rows, and the parts a salted join splits them into."""
    hot = hot_keys(table(spark, d, "lineitem"), F.col("l_returnflag"), 1000)
    return hot.toDF("l_returnflag", "parts").select("l_returnflag", big("parts").alias("parts"))


@query(f"""
    SELECT c_custkey, coalesce(p.s_name, s.s_name) AS name,
           CASE WHEN p.s_suppkey IS NOT NULL THEN p.s_acct ELSE s.s_acct END AS acct
    FROM customer
    LEFT JOIN (SELECT s_suppkey, s_name,
                      CASE WHEN s_suppkey % 3 <> 0 THEN s_acctbal END AS s_acct FROM supplier) p
      ON p.s_suppkey = c_custkey
    LEFT JOIN (SELECT t.*, CASE WHEN t.s_suppkey % 3 <> 0 THEN x.s_acctbal END AS s_acct
               FROM ({_TOP_SUPPLIER}) t JOIN supplier x USING (s_suppkey)) s
      ON s.s_nationkey = c_nationkey AND c_mktsegment <> 'BUILDING'
""")
def two_path_lookup(spark, d):
    """By supplier key, else by nation; a null inside the first object is not filled from the other."""
    suppliers = table(spark, d, "supplier")
    fields = {
        "name": F.col("s_name"),
        "acct": F.when(F.col("s_suppkey") % 3 != 0, F.col("s_acctbal")),
    }
    out = two_path(
        table(spark, d, "customer"),
        suppliers,
        ("c_custkey", "s_suppkey"),
        ("c_nationkey", "s_nationkey"),
        F.coalesce(F.col("c_mktsegment") != "BUILDING", F.lit(True)),
        "supplier",
        fields,
        [F.col("s_acctbal").desc_nulls_last(), F.col("s_suppkey")],
    )
    return out.select("c_custkey", "supplier.name", "supplier.acct")


@query(f"""
    SELECT c_custkey, t.s_name AS top_name, n AS suppliers
    FROM customer
    JOIN ({_TOP_SUPPLIER}) t ON t.s_nationkey = c_nationkey
    JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY s_nationkey) k
      ON k.s_nationkey = c_nationkey
    WHERE c_mktsegment <> 'BUILDING'
""")
def bridge_by_secondary_key(spark, d):
    suppliers = table(spark, d, "supplier").withColumnRenamed("s_nationkey", "c_nationkey")
    top = _top_supplier(spark, d).select(
        F.col("s_nationkey").alias("c_nationkey"), F.struct("s_name").alias("top")
    )
    every = collect_ordered(
        suppliers, "c_nationkey", "every", {"name": F.col("s_name")}, ["s_name"]
    )
    guard = F.col("c_mktsegment") != "BUILDING"
    customers = table(spark, d, "customer")
    sides = {"top": top, "every": every}
    bridge = bridge_secondary(customers, "c_custkey", "c_nationkey", guard, sides)
    return bridge.select(
        "c_custkey", F.col("top.s_name").alias("top_name"), big(F.size("every")).alias("suppliers")
    )


@query("""
    SELECT c_custkey, c_acctbal > 0 AS present,
           CASE WHEN c_acctbal > 0 THEN o_orderkey END AS inner_key
    FROM customer LEFT JOIN (
        SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F'
        ORDER BY o_custkey, o_totalprice DESC, o_orderkey) ON o_custkey = c_custkey
""")
def nested_optional(spark, d):
    """An optional object inside an optional object: without the outer one the inner is hidden."""
    customers = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    customer = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("c_custkey")
    best = latest_per_key(
        table(spark, d, "orders").select(customer, "o_orderkey", "o_totalprice"),
        "c_custkey",
        [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey")],
    )
    account = F.when(F.col("c_acctbal") > 0, F.col("c_custkey")).alias("c_custkey")
    accounts = customers.select(account, "c_acctbal")  # the others have no key, and are refused
    outer = nest_one(accounts, best, "c_custkey", "best", {"key": F.col("o_orderkey")})
    out = nest_one(
        customers, outer, "c_custkey", "account", {"bal": F.col("c_acctbal"), "best": F.col("best")}
    )
    return out.select(
        "c_custkey",
        F.col("account").isNotNull().alias("present"),
        F.col("account.best.key").alias("inner_key"),
    )


@query("""
    SELECT count(*) AS base_rows, count(*) AS out_rows, count(DISTINCT c_custkey) AS out_keys
    FROM customer
""")
def no_fanout(spark, d):
    customers = table(spark, d, "customer").select("c_custkey")
    orders = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    out = nest_many(
        customers, orders, "c_custkey", "o", {"k": F.col("o_orderkey")}, ["o_orderkey"]
    )
    return fanout_report(customers, out, "c_custkey")
