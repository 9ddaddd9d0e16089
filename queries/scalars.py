"""Scalar functions over whole columns of the test tables."""

from datetime import date

from pyspark.sql import functions as F

from entityfold import functions as fn
from queries.registry import big, query, table


@query("""
    SELECT c_custkey,
           CASE WHEN c_custkey % 3 = 0 THEN c_name
                ELSE nullif(trim(concat_ws(' ', g, f)), '') END AS full_name
    FROM (SELECT *, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS g,
                    CASE WHEN c_custkey % 2 = 0 THEN c_name END AS f FROM customer)
""")
def compose_name(spark, d):
    key = F.col("c_custkey")
    own = F.when(key % 3 == 0, F.col("c_name"))
    given = F.when(key % 5 != 0, F.col("c_mktsegment"))
    family = F.when(key % 2 == 0, F.col("c_name"))
    name = F.coalesce(own, fn.joined(given, family))
    return table(spark, d, "customer").select("c_custkey", name.alias("full_name"))


@query("""
    SELECT o_orderkey, coalesce(s = 'F', false) AS registered,
           CASE WHEN s = 'P' THEN 'CAN' ELSE 'ACT' END AS status,
           CASE WHEN upper(t) IN ('1-URGENT', '5-LOW') THEN upper(t) END AS kind,
           coalesce(s, '') AS code
    FROM (SELECT *, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS s,
                    lower(o_orderpriority) AS t FROM orders)
""")
def status_defaults(spark, d):
    s = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderstatus"))
    t = F.upper(F.lower("o_orderpriority"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.coalesce(s == "F", F.lit(False)).alias("registered"),
        F.when(s == "P", "CAN").otherwise("ACT").alias("status"),
        F.when(t.isin("1-URGENT", "5-LOW"), t).alias("kind"),
        F.coalesce(s, F.lit("")).alias("code"),
    )


@query("""
    SELECT o_orderkey,
           CAST(CASE WHEN d IS NOT NULL THEN greatest(0, 1996 - year(d)
                - CASE WHEN month(d) * 100 + day(d) > 228 THEN 1 ELSE 0 END) END AS BIGINT) AS age
    FROM (SELECT o_orderkey,
                 CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS d FROM orders)
""")
def age_in_years(spark, d):
    day = F.when(F.col("o_orderkey") % 7 != 0, F.to_date("o_orderdate"))
    age = fn.age_years(day, date(1996, 2, 28))
    return table(spark, d, "orders").select("o_orderkey", big(age).alias("age"))


@query("""
    SELECT c_custkey, CASE WHEN s = '' THEN NULL ELSE s END AS segment,
           CASE WHEN s = '' THEN 'other' ELSE lower(s) END AS bucket
    FROM (SELECT c_custkey, trim(CASE WHEN c_custkey % 4 = 0 THEN '   '
                                      ELSE concat('  ', c_mktsegment, ' ') END) AS s FROM customer)
""")
def blank_to_null(spark, d):
    padded = F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))
    s = F.when(F.col("c_custkey") % 4 == 0, F.lit("   ")).otherwise(padded)
    return table(spark, d, "customer").select(
        "c_custkey", fn.trimmed(s).alias("segment"), fn.bucket_key(s).alias("bucket")
    )


@query("""
    SELECT doc_id,
           nullif(regexp_replace(regexp_replace(t, '^\\s+', ''), '\\s+$', ''), '') AS stripped
    FROM (SELECT doc_id, chr(9) || chr(10) || text || chr(13) || chr(10) AS t FROM documents)
""")
def strip_white_space(spark, d):
    t = F.concat(F.lit("\t\n"), "text", F.lit("\r\n"))
    return table(spark, d, "documents").select("doc_id", fn.stripped(t).alias("stripped"))


@query("""
    SELECT c_custkey, coalesce(length(k) = 11 AND (
        (CAST(substr(k, 1, 1) AS BIGINT) - 1) * 10 + CAST(substr(k, 2, 1) AS BIGINT) * 1
      + CAST(substr(k, 3, 1) AS BIGINT) * 3 + CAST(substr(k, 4, 1) AS BIGINT) * 5
      + CAST(substr(k, 5, 1) AS BIGINT) * 7 + CAST(substr(k, 6, 1) AS BIGINT) * 9
      + CAST(substr(k, 7, 1) AS BIGINT) * 11 + CAST(substr(k, 8, 1) AS BIGINT) * 13
      + CAST(substr(k, 9, 1) AS BIGINT) * 15 + CAST(substr(k, 10, 1) AS BIGINT) * 17
      + CAST(substr(k, 11, 1) AS BIGINT) * 19) % 89 = 0, false) AS valid
    FROM (SELECT c_custkey, CASE WHEN c_custkey % 10 <> 9 THEN
                 CAST(51000000000 + c_custkey AS VARCHAR) ELSE '00000000000' END AS k
          FROM customer)
""")
def checksum(spark, d):
    key = (F.lit(51000000000) + F.col("c_custkey")).cast("string")
    k = F.when(F.col("c_custkey") % 10 != 9, key).otherwise(F.lit("00000000000"))
    return table(spark, d, "customer").select("c_custkey", fn.abn_valid(k).alias("valid"))


_PADDED = """
    SELECT o_orderkey, CASE o_orderkey % 4
        WHEN 0 THEN concat('51 000 ', lpad(CAST(o_orderkey AS VARCHAR), 6, '0'))
        WHEN 1 THEN concat('004.', lpad(CAST(o_orderkey AS VARCHAR), 6, '0'))
        WHEN 2 THEN CAST(1000000 + o_orderkey AS VARCHAR)
        ELSE 'none' END AS t
    FROM orders
"""


@query(f"""
    SELECT o_orderkey, CASE WHEN length(x) = 11 THEN x END AS abn,
           CASE WHEN length(x) = 9 THEN x END AS acn,
           CASE WHEN length(x) BETWEEN 6 AND 9 THEN lpad(x, 9, '0') END AS padded_acn
    FROM (SELECT o_orderkey, regexp_replace(t, '[^0-9]', '', 'g') AS x FROM ({_PADDED}))
""")
def digit_routing(spark, d):
    key = F.col("o_orderkey")
    six = F.lpad(key.cast("string"), 6, "0")
    text = (
        F.when(key % 4 == 0, F.concat(F.lit("51 000 "), six))
        .when(key % 4 == 1, F.concat(F.lit("004."), six))
        .when(key % 4 == 2, (F.lit(1000000) + key).cast("string"))
        .otherwise(F.lit("none"))
    )
    abn, acn = fn.routed(text)
    _, padded = fn.routed_padded(text)
    return table(spark, d, "orders").select(
        "o_orderkey", abn.alias("abn"), acn.alias("acn"), padded.alias("padded_acn")
    )


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 3 <> 0
                            THEN CAST(o_orderdate AS DATE) END AS guarded,
           CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS strict
    FROM orders
""")
def guarded_dates(spark, d):
    key = F.col("o_orderkey")
    text = F.date_format("o_orderdate", "dd/MM/yyyy")
    loose = (
        F.when(key % 5 == 0, F.lit("Permanent"))
        .when(key % 3 == 0, F.date_format("o_orderdate", "d/M/yy"))
        .otherwise(F.concat(F.lit(" "), text, F.lit(" ")))
    )
    blank = F.when(key % 5 != 0, F.date_format("o_orderdate", "d/M/yyyy")).otherwise(F.lit("  "))
    return table(spark, d, "orders").select(
        "o_orderkey",
        fn.guarded_date(loose).alias("guarded"),
        fn.strict_date(blank).alias("strict"),
    )


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS day,
           CASE WHEN o_orderkey % 6 = 0 THEN concat(year(o_orderdate), '-99-99')
                ELSE strftime(o_orderdate, '%Y-%m-%d') END AS cut,
           strftime(o_orderdate, '%Y-%m-%d') AS first_ten
    FROM orders
""")
def compact_dates(spark, d):
    key = F.col("o_orderkey")
    text = F.when(key % 5 != 0, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(F.lit("1999"))
    number = F.when(key % 6 == 0, F.year("o_orderdate") * 10000 + 9999).otherwise(
        F.date_format("o_orderdate", "yyyyMMdd").cast("int")
    )
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return table(spark, d, "orders").select(
        "o_orderkey",
        fn.compact_date(text).alias("day"),
        fn.compact_iso(number).alias("cut"),
        fn.first_ten(stamp).alias("first_ten"),
    )


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN CAST(o_orderdate AS DATE) END AS day
    FROM orders
""")
def workbook_dates(spark, d):
    key = F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    serial = F.datediff(day, F.lit("1899-12-30").cast("date")).cast("string")
    cell = (
        F.when(key % 4 == 0, serial)
        .when(key % 4 == 1, F.date_format(day, "d-MMM-yyyy"))
        .when(key % 4 == 2, F.date_format(day, "yyyy-MM-dd"))
        .otherwise(F.lit("soon"))
    )
    return table(spark, d, "orders").select("o_orderkey", fn.sheet_date(cell).alias("day"))


@query("""
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 4 IN (0, 1) THEN
                CAST(round(o_totalprice * 100) * (1 - 2 * (o_orderkey % 4)) AS BIGINT) END AS cents,
           CASE WHEN o_orderkey % 4 = 2 THEN NULL ELSE o_orderkey END AS plain
    FROM orders
""")
def guarded_numbers(spark, d):
    key = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    text = (
        F.when(key % 4 == 0, F.concat(F.lit(" "), price))
        .when(key % 4 == 1, F.concat(F.lit("-"), price))
        .when(key % 4 == 2, F.lit("1e3"))
        .otherwise(F.lit("n/a"))
    )
    whole = F.when(key % 4 == 2, F.lit("7.0")).otherwise(key.cast("string"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        big(fn.guarded_number(text) * 100).alias("cents"),
        fn.guarded_integer(whole).alias("plain"),
    )


@query("""
    SELECT o_orderkey,
           CASE o_orderkey % 3 WHEN 0 THEN CAST(round(o_totalprice * 100) AS BIGINT)
                WHEN 1 THEN CAST(round(o_totalprice) * 100000 AS BIGINT) END AS cents
    FROM orders
""")
def clean_numbers(spark, d):
    key = F.col("o_orderkey")
    dollars = F.format_number("o_totalprice", 2)
    text = (
        F.when(key % 3 == 0, F.concat(F.lit("$ "), dollars))
        .when(key % 3 == 1, F.concat(F.round("o_totalprice").cast("bigint"), F.lit("e3")))
        .otherwise(F.lit("unknown"))
    )
    cents = fn.to_cents(fn.clean_number(text))
    return table(spark, d, "orders").select("o_orderkey", cents.alias("cents"))


@query("""
    SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS positive FROM customer
""")
def positive_numbers(spark, d):
    positive = fn.positive_or_null(F.col("c_acctbal"))
    return table(spark, d, "customer").select("c_custkey", positive.alias("positive"))


@query("""
    SELECT l_orderkey, l_linenumber, CAST(floor((x / 1000 - 30) * 100 + 0.5) AS BIGINT) AS cents
    FROM (SELECT *, l_extendedprice AS x FROM lineitem)
""")
def money_rounding(spark, d):
    """Halves go up, below zero too."""
    dollars = F.col("l_extendedprice") / 1000 - 30
    cents = fn.to_cents(dollars)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", cents.alias("cents"))


@query("""
    SELECT o_orderkey, CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS cents,
           CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS money
    FROM orders
""")
def cents_and_money(spark, d):
    cents = fn.to_cents(F.col("o_totalprice"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        cents.cast("string").alias("cents"),
        fn.cents_to_money(cents).cast("string").alias("money"),
    )


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Filled'
                            WHEN o_orderstatus = 'O' THEN 'Open' ELSE 'p' END AS status
    FROM orders
""")
def code_expansion(spark, d):
    code = F.concat(F.lit(" "), F.lower("o_orderstatus"))
    status = fn.expand_code(code, {"F": "Filled", "O": "Open"})
    return table(spark, d, "orders").select("o_orderkey", status.alias("status"))


@query("""
    SELECT p_partkey, CASE WHEN p_size > 40 THEN 'large' WHEN p_type = 'ECONOMY' THEN 'economy'
                           WHEN p_retailprice < 950 THEN 'cheap' END AS label
    FROM part
""")
def priority_label(spark, d):
    def flag(condition):
        return F.when(condition, "Y").otherwise("N")

    label = fn.first_true_label(
        [
            (flag(F.col("p_size") > 40), "large"),
            (flag(F.col("p_type") == "ECONOMY"), "economy"),
            (flag(F.col("p_retailprice") < 950), "cheap"),
        ]
    )
    return table(spark, d, "part").select("p_partkey", label.alias("label"))


@query("""
    SELECT p_partkey, CASE WHEN regexp_matches(n, '^[a-z]') THEN n ELSE '_' || n END AS name
    FROM (SELECT p_partkey, regexp_replace(regexp_replace(lower(concat(
                 CASE WHEN p_partkey % 3 = 0 THEN '9 ' ELSE ' ' END, p_name, ' (', p_brand, ')')),
                 '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS n FROM part)
""")
def sanitise(spark, d):
    lead = F.when(F.col("p_partkey") % 3 == 0, F.lit("9 ")).otherwise(F.lit(" "))
    label = F.concat(lead, "p_name", F.lit(" ("), "p_brand", F.lit(")"))
    return table(spark, d, "part").select("p_partkey", fn.safe_name_column(label).alias("name"))
