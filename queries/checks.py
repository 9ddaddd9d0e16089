"""Gates, coverage, checks over documents, build against build."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityfold import operators as op
from entityfold.operators.compare import with_total
from entityfold.sources import pick_snapshot
from entityfold.sources.snapshots import income_year_in, year_in
from queries.registry import big, query, table

TABLES = ["customer", "orders", "lineitem", "supplier", "part"]

_COUNTS_SQL = " UNION ALL ".join(f"SELECT '{t}' AS source, count(*) AS n FROM {t}" for t in TABLES)
# A floor per source from the size of another table; nation holds no rows of its own here.
_FLOORS_SQL = """
    SELECT 'customer' AS source, (SELECT count(*) FROM part) AS floor
    UNION ALL SELECT 'orders', (SELECT count(*) FROM customer)
    UNION ALL SELECT 'lineitem', (SELECT count(*) FROM orders)
    UNION ALL SELECT 'missing', (SELECT count(*) FROM nation)
"""


def _count(spark, d, name):
    return table(spark, d, name).agg(big(F.count(F.lit(1))).alias("n"))


@query(f"""
    SELECT source, coalesce(n, 0) AS n, floor, coalesce(n, 0) >= floor AS ok
    FROM ({_FLOORS_SQL}) LEFT JOIN ({_COUNTS_SQL}) USING (source)
""")
def floors(spark, d):
    counts = reduce(
        DataFrame.unionByName,
        [_count(spark, d, t).withColumn("source", F.lit(t)) for t in TABLES],
    )
    pairs = [("customer", "part"), ("orders", "customer"), ("lineitem", "orders")]
    pairs.append(("missing", "nation"))
    least = reduce(
        DataFrame.unionByName,
        [
            _count(spark, d, t).select(F.lit(source).alias("source"), F.col("n").alias("floor"))
            for source, t in pairs
        ],
    )
    return op.gate_floors(counts, least)


_COVERAGE_SQL = """
    SELECT count(*) AS total, count(*) FILTER (c_acctbal > 0) AS solvent,
           count(*) FILTER (c_mktsegment = 'BUILDING') AS building,
           count(*) FILTER (n >= 20) AS busy
    FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
      ON o_custkey = c_custkey
"""


def _coverage(spark, d):
    orders = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    n = orders.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n"))
    doc = table(spark, d, "customer").join(n, "c_custkey", "left")
    counters = {
        "solvent": F.col("c_acctbal") > 0,
        "building": F.col("c_mktsegment") == "BUILDING",
        "busy": F.col("n") >= 20,
    }
    return op.coverage(doc, counters)


@query(_COVERAGE_SQL)
def coverage(spark, d):
    return _coverage(spark, d)


@query(f"""
    SELECT name, got, CAST(round(1000.0 * got / total) AS BIGINT) AS tenths
    FROM (UNPIVOT ({_COVERAGE_SQL}) ON solvent, building, busy INTO NAME name VALUE got)
""")
def coverage_percent(spark, d):
    out = op.percent_coverage(_coverage(spark, d))
    return out.select("name", "got", big(F.round(F.col("percent") * 10)).alias("tenths"))


@query(f"""
    SELECT name, got, floor AS required
    FROM (UNPIVOT ({_COVERAGE_SQL}) ON solvent, building, busy INTO NAME name VALUE got)
    JOIN (SELECT 'solvent' AS name, count(*) AS floor FROM nation
          UNION ALL SELECT 'building', count(*) FROM customer
          UNION ALL SELECT 'busy', count(*) FROM supplier) USING (name)
    WHERE got < floor
""")
def coverage_shortfalls(spark, d):
    pairs = [("solvent", "nation"), ("building", "customer"), ("busy", "supplier")]
    least = reduce(
        DataFrame.unionByName,
        [
            _count(spark, d, t).select(F.lit(n).alias("name"), F.col("n").alias("floor"))
            for n, t in pairs
        ],
    )
    return op.coverage_shortfalls(_coverage(spark, d), least)


@query("""
    SELECT coalesce(lower(nullif(trim(s), '')), 'other') AS bucket, count(*) AS n
    FROM (SELECT CASE c_custkey % 5 WHEN 0 THEN ' ' WHEN 1 THEN NULL ELSE c_mktsegment END AS s
          FROM customer) GROUP BY 1
""")
def bucket_counts(spark, d):
    r = F.col("c_custkey") % 5
    s = F.when(r == 0, F.lit(" ")).when(r > 1, F.col("c_mktsegment"))
    return op.bucket_counts(table(spark, d, "customer").select(s.alias("s")), "s")


@query("""
    SELECT bucket, n FROM (
        SELECT lower(c_mktsegment) AS bucket, count(*) AS n FROM customer GROUP BY 1
        UNION ALL SELECT 'total', count(*) FROM customer)
""")
def bucket_counts_with_total(spark, d):
    counts = op.bucket_counts(table(spark, d, "customer"), "c_mktsegment")
    return with_total(counts).select("bucket", big("n").alias("n"))


@query("""
    SELECT CAST(sum(n) AS BIGINT) AS total
    FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)
""")
def shard_total(spark, d):
    """Shards per status, and a bundle of all of them that must not be counted again."""
    orders = table(spark, d, "orders")
    shards = orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("records"))
    bundle = orders.agg(F.lit("all").alias("o_orderstatus"), F.count(F.lit(1)).alias("records"))
    no, yes = F.lit(False).alias("aggregate"), F.lit(True).alias("aggregate")
    return op.shard_total(shards.select("*", no).unionByName(bundle.select("*", yes)))


@query("""
    SELECT key, coalesce(p, 0) AS prior, coalesce(c, 0) AS current,
           CASE WHEN coalesce(p, 0) = 0 AND coalesce(c, 0) > 0 THEN 'appeared'
                WHEN coalesce(p, 0) > 0 AND coalesce(c, 0) = 0 THEN 'retired'
                WHEN abs(c - p) > 0.25 * p THEN 'moved' ELSE 'ok' END AS status
    FROM (SELECT o_custkey % 50 AS key, count(*) AS c FROM orders
          WHERE o_orderstatus <> 'P' AND o_custkey % 50 <> 3 GROUP BY 1)
    FULL JOIN (SELECT o_custkey % 50 AS key, count(*) AS p FROM orders
               WHERE o_orderstatus <> 'F' AND o_custkey % 50 <> 4 GROUP BY 1) USING (key)
""")
def compare_builds(spark, d):
    orders = table(spark, d, "orders").withColumn("key", F.col("o_custkey") % 50)

    def build(status, left_out):
        kept = orders.where((F.col("o_orderstatus") != status) & (F.col("key") != left_out))
        return kept.groupBy("key").agg(F.count(F.lit(1)).alias("n"))

    return op.compare_counts(build("P", 3), build("F", 4), "key", 0.25).drop("change")


@query("""
    SELECT key, CASE WHEN n IS NULL THEN 'shard without a count'
                     WHEN r IS NULL AND n > 0 THEN 'count without a shard'
                     WHEN r <> n THEN 'counts differ' END AS problem
    FROM (SELECT o_custkey % 40 AS key, count(*) FILTER (o_custkey % 40 <> 7) AS n FROM orders
          WHERE o_custkey % 40 <> 5 GROUP BY 1)
    FULL JOIN (SELECT o_custkey % 40 AS key, count(*) FILTER (o_custkey % 40 <> 9) AS r FROM orders
               WHERE o_custkey % 40 NOT IN (7, 8) GROUP BY 1) USING (key)
    WHERE n IS NULL OR (r IS NULL AND n > 0) OR r <> n
""")
def reconcile(spark, d):
    """Bucket 5 has no count, 8 no shard, 9 differs, and the empty bucket 7 needs no shard."""
    key = F.col("o_custkey") % 40
    orders = table(spark, d, "orders").withColumn("key", key)
    counts = orders.where("key <> 5").groupBy("key").agg(F.count_if(F.col("key") != 7).alias("n"))
    shards = (
        orders.where("key not in (7, 8)")
        .groupBy("key", "o_orderstatus")
        .agg(F.count_if(F.col("key") != 9).alias("records"))
    )
    return op.reconcile(counts, shards, "key")


@query("""
    SELECT o_orderkey, CAST(2 AS BIGINT) AS copies FROM orders WHERE o_orderstatus = 'P'
""")
def duplicates(spark, d):
    orders = table(spark, d, "orders")
    twice = orders.unionByName(orders.where("o_orderstatus = 'P'"))
    return op.check_unique(twice, "o_orderkey")


@query("""
    SELECT o_orderkey, o_custkey, previous
    FROM (SELECT o_orderkey, o_custkey, lag(o_custkey) OVER (ORDER BY o_orderkey) AS previous
          FROM orders)
    WHERE o_custkey <= previous
""")
def order_check(spark, d):
    """Customers out of order along the order keys, compared block by block."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.lit("f").alias("file"))
    breaks = op.order_breaks(orders, "file", "o_orderkey", "o_custkey", block=1000)
    return breaks.select("o_orderkey", "o_custkey", "previous")


@query("""
    SELECT event_id AS row_index, user_id, previous
    FROM (SELECT event_id, user_id, lag(user_id) OVER (ORDER BY event_id) AS previous FROM events)
    WHERE user_id <= previous
""")
def order_check_in_file(spark, d):
    """Neighbouring rows by their place in the file; the file holds the events in order."""
    events = table(spark, d, "events").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index"), "user_id"
    )
    breaks = op.order_breaks(events, "file", "row_index", "user_id")
    return breaks.select("row_index", "user_id", "previous")


def _issues(spark, d):
    orders = table(spark, d, "orders")
    rules = {
        "status is known": F.col("o_orderstatus").isin("F", "O"),
        "price is small": F.col("o_totalprice") < 400000,
        "has a customer": F.when(F.col("o_custkey") % 100 != 0, F.col("o_custkey")).isNotNull(),
    }
    return op.check_documents(orders, "o_orderkey", rules)


_ISSUES_SQL = """
    SELECT o_orderkey, 'status is known' AS rule FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
    UNION ALL SELECT o_orderkey, 'price is small' FROM orders WHERE o_totalprice >= 400000
    UNION ALL SELECT o_orderkey, 'has a customer' FROM orders WHERE o_custkey % 100 = 0
"""


@query(_ISSUES_SQL)
def document_issues(spark, d):
    return _issues(spark, d)


@query(f"SELECT rule, count(*) AS issues FROM ({_ISSUES_SQL}) GROUP BY rule")
def issue_counts(spark, d):
    return op.rule_counts(_issues(spark, d))


@query(f"SELECT o_orderkey, rule FROM ({_ISSUES_SQL}) ORDER BY o_orderkey, rule LIMIT 10")
def top_issues(spark, d):
    return op.top_issues(_issues(spark, d), "o_orderkey", 10)


@query("""
    SELECT n_name AS name FROM nation
    WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
""")
def unattributed(spark, d):
    nations = table(spark, d, "nation").select(F.col("n_name").alias("name"), "n_nationkey")
    rich = table(spark, d, "supplier").where("s_acctbal > 5000")
    named = rich.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select("name")
    return op.unattributed_sources(nations.select("name"), named)


_LISTING_SQL = """
    SELECT o_custkey, o_orderkey AS pos, CAST(round(o_totalprice) AS BIGINT) AS size,
           concat(year(o_orderdate), '-', right(CAST(year(o_orderdate) + 1 AS VARCHAR), 2),
                  ' Report', CASE WHEN o_orderstatus = 'P' THEN '.pdf' ELSE '.csv' END) AS name
    FROM orders
"""


def _listing(spark, d):
    year = F.year("o_orderdate")
    name = F.concat(
        year,
        F.lit("-"),
        F.substring((year + 1).cast("string"), 3, 2),
        F.lit(" Report"),
        F.when(F.col("o_orderstatus") == "P", ".pdf").otherwise(".csv"),
    )
    return table(spark, d, "orders").select(
        "o_custkey",
        F.col("o_orderkey").alias("pos"),
        big(F.round("o_totalprice")).alias("size"),
        name.alias("name"),
    )


@query(f"""
    SELECT DISTINCT ON (o_custkey) o_custkey, name, pos
    FROM ({_LISTING_SQL}) WHERE name LIKE '%.csv' ORDER BY o_custkey, size DESC, pos
""")
def pick_largest_snapshot(spark, d):
    order = [F.col("size").desc(), F.col("pos")]
    picked = pick_snapshot(_listing(spark, d), "o_custkey", F.col("name").endswith(".csv"), order)
    return picked.select("o_custkey", "name", "pos")


@query(f"""
    SELECT DISTINCT ON (o_custkey) o_custkey, name, pos, CAST(left(name, 4) AS BIGINT) AS year
    FROM ({_LISTING_SQL}) WHERE name LIKE '%.csv'
    ORDER BY o_custkey, left(name, 4) DESC, size DESC, pos
""")
def pick_latest_snapshot(spark, d):
    listing = _listing(spark, d)
    order = [year_in(F.col("name")).desc(), F.col("size").desc(), F.col("pos")]
    picked = pick_snapshot(listing, "o_custkey", F.col("name").contains(".csv"), order)
    year = big(income_year_in(F.col("name")))
    return picked.select("o_custkey", "name", "pos", year.alias("year"))
