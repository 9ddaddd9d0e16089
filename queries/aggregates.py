"""Money aggregates and load statistics."""

from pyspark.sql import functions as F

from entityfold.functions import to_cents
from entityfold.operators import (
    awards_by_recipient,
    extract_releases,
    flag_capped_chunks,
    ingest_stats,
    spend_by_supplier,
)
from entityfold.operators.aggregate import distinct_releases
from queries.registry import big, query, table

POSITION = ["l_orderkey", "l_linenumber"]


def releases_of(spark, d):
    """A contract release per order line. Every fourth repeats another line's id; some have none.

    The supplier stands in the first identifier or an additional one, with another party
    (a buyer) and another scheme beside it.
    """
    key = (F.lit(51000000000) + F.col("l_suppkey")).cast("string")
    spaced = F.concat(F.substring(key, 1, 2), F.lit(" "), F.substring(key, 3, 9))
    number = (F.col("l_orderkey") + F.col("l_linenumber")) % 4
    ocid = F.when(
        number != 3,
        F.concat_ws("-", F.col("l_orderkey"), F.when(number == 0, 1).otherwise(F.col("l_linenumber"))),
    )

    def identifier(scheme, value):
        return F.struct(F.lit(scheme).alias("scheme"), value.alias("id"))

    none = F.array().cast("array<struct<scheme:string,id:string>>")
    blank = F.lit(None).cast("struct<scheme:string,id:string>")

    def party(role, first, extra):
        return F.struct(
            F.array(F.lit("tenderer"), F.lit(role)).alias("roles"),
            first.alias("identifier"),
            extra.alias("additionalIdentifiers"),
        )

    supplier = F.when(
        number == 1, party("supplier", identifier("AU-ABN", spaced), none)
    ).otherwise(
        party(
            "supplier",
            identifier("GB-COH", F.lit("12345678901")),
            F.array(identifier("AU-ABN", key), identifier("AU-ABN", spaced)),
        )
    )
    buyer = party("buyer", blank, F.array(identifier("AU-ABN", F.lit("33102417032"))))
    amount = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")

    def contract(value, day):
        return F.struct(
            F.struct(value.alias("amount")).alias("value"),
            F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00Z")).alias("dateSigned"),
        )

    day = F.to_date("l_shipdate")
    return table(spark, d, "lineitem").select(
        ocid.alias("ocid"),
        F.array(buyer, supplier).alias("parties"),
        F.array(
            contract(amount, day), contract(F.lit("100.005"), F.date_add(day, 30))
        ).alias("contracts"),
        *POSITION,
    )


RELEASES_SQL = """
    SELECT CASE WHEN n <> 3 THEN concat(l_orderkey, '-', CASE WHEN n = 0 THEN 1
                                                               ELSE l_linenumber END) END AS ocid,
           CAST(51000000000 + l_suppkey AS VARCHAR) AS supplier,
           CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) + 10001 AS cents,
           CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS signed, l_orderkey, l_linenumber
    FROM (SELECT *, (l_orderkey + l_linenumber) % 4 AS n FROM lineitem)
"""
# The test data may hold two lines under one order and line number; all columns set the order.
_FIRST_SQL = f"""
    SELECT * FROM ({RELEASES_SQL})
    QUALIFY ocid IS NULL OR row_number() OVER
            (PARTITION BY ocid ORDER BY l_orderkey, l_linenumber, supplier, cents, signed) = 1
"""
_ORDER = [*POSITION, "supplier", "cents", "signed"]


@query(f"""
    SELECT supplier, CAST(sum(cents) AS BIGINT) AS cents, count(*) AS releases,
           min(signed) AS first_signed, max(signed) AS last_signed
    FROM ({_FIRST_SQL}) GROUP BY supplier
""")
def spend(spark, d):
    extracted = extract_releases(releases_of(spark, d), POSITION)
    ordered = extracted.withColumn("supplier", F.element_at("suppliers", 1))
    return spend_by_supplier(distinct_releases(ordered, _ORDER))


@query(f"""
    SELECT count(*) AS "rows", count(*) FILTER (cents > 0) AS with_value,
           count(*) FILTER (signed IS NOT NULL) AS with_date,
           count(*) FILTER (supplier IS NOT NULL) AS with_supplier,
           count(DISTINCT supplier) AS suppliers
    FROM ({_FIRST_SQL})
""")
def ingest_statistics(spark, d):
    extracted = extract_releases(releases_of(spark, d), POSITION)
    ordered = extracted.withColumn("supplier", F.element_at("suppliers", 1))
    return ingest_stats(
        distinct_releases(ordered, _ORDER),
        {
            "with_value": F.col("cents") > 0,
            "with_date": F.col("signed").isNotNull(),
            "with_supplier": F.size("suppliers") > 0,
        },
        {"suppliers": F.col("supplier")},
    )


@query("""
    SELECT supplier, CAST(sum(cents) AS BIGINT) AS cents, count(*) AS releases,
           min(signed) AS first_signed, max(signed) AS last_signed
    FROM (SELECT DISTINCT l_suppkey AS supplier, o_orderkey,
                 CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
                 CAST(o_orderdate AS DATE) AS signed
          FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
    GROUP BY supplier
""")
def shared_attribution(spark, d):
    """An order's full value goes to each of its suppliers, once."""
    pairs = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    lines = pairs.select("l_orderkey", F.array("l_suppkey").alias("suppliers"))
    releases = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        to_cents(F.col("o_totalprice")).alias("cents"),
        F.to_date("o_orderdate").alias("signed"),
    )
    return spend_by_supplier(releases.join(lines, "l_orderkey"))


@query("""
    SELECT CAST(o_custkey AS VARCHAR) AS recipient,
           CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents,
           count(*) AS awards,
           min(CAST(o_orderdate AS DATE)) FILTER (o_orderstatus <> 'P') AS first_published,
           max(CAST(o_orderdate AS DATE)) FILTER (o_orderstatus <> 'P') AS last_published
    FROM orders WHERE o_custkey % 7 <> 0 GROUP BY o_custkey
""")
def grants(spark, d):
    awards = table(spark, d, "orders").select(
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey").cast("string")).alias("recipient"),
        to_cents(F.col("o_totalprice")).alias("cents"),
        F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate")).alias("published"),
    )
    return awards_by_recipient(awards)


@query("""
    SELECT event_type, CAST(sum(CAST(props->>'$.k' AS BIGINT)) AS BIGINT) AS total,
           count(*) AS n
    FROM events GROUP BY event_type
""")
def json_props(spark, d):
    events = table(spark, d, "events")
    k = F.from_json("props", "k bigint", {"mode": "FAILFAST"})["k"]
    return events.select("event_type", k.alias("k")).groupBy("event_type").agg(
        F.sum("k").alias("total"), F.count(F.lit(1)).alias("n")
    )


@query("""
    SELECT CAST(ts AS DATE) AS chunk, count(*) AS n, count(*) >= 360 AS capped
    FROM events GROUP BY 1
""")
def capped_chunks(spark, d):
    return flag_capped_chunks(table(spark, d, "events"), F.to_date("ts"), 360)


@query("""
    SELECT c_mktsegment AS chunk, count(*) AS n, count(*) >= 300 AS capped
    FROM customer GROUP BY 1
""")
def capped_chunks_by_column(spark, d):
    return flag_capped_chunks(table(spark, d, "customer"), "c_mktsegment", 300).select(
        "chunk", big("n").alias("n"), "capped"
    )
