"""Readers and writers: the test tables written out as files, and read back by the readers.

Files go to a new folder under the cluster's shared folder; every query writes and reads
its whole table.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F

from entityfold.functions import iso, to_cents
from entityfold.operators import (
    bucket_counts,
    compare_counts,
    extract_releases,
    spend_by_supplier,
)
from entityfold.operators.aggregate import awards_by_recipient, distinct_releases
from entityfold.plans import normalise
from entityfold.session import fresh_folder
from entityfold.sinks import (
    build_manifest,
    merge_shards,
    write_awards,
    write_bundle,
    write_comparison,
    write_metadata,
    write_ndjson,
    write_shards,
)
from entityfold.sinks.buckets import read_table, write_bucketed
from entityfold.sinks.slices import write_line_bundle, write_line_shards, write_ordered_lines
from entityfold.sources import (
    bad_records,
    decode_workbooks,
    delimited_facts,
    open_records,
    ragged_records,
    read_delimited,
    read_grant_awards,
    read_ocds,
    read_register_xml,
    register_rows,
)
from entityfold.sources.ocds import POSITION
from queries.aggregates import releases_of
from queries.registry import big, query, table
from queries.workbooks import encode_workbook


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _literal_file(spark, d):
    folder = fresh_folder(spark, "literal")
    odd = F.concat(F.lit('"'), "p_name", F.lit('" C:\\P\\N'))
    (
        table(spark, d, "part")
        .select(
            F.col("p_partkey").cast("string").alias("Part Key"),
            odd.alias("9 Part-Name"),
            F.col("p_brand").alias("P_BRAND"),
        )
        .write.option("header", True)
        .option("sep", "\t")
        .option("quote", "")
        .option("escape", "")
        .csv(folder)
    )
    return folder


@query("""
    SELECT CAST(p_partkey AS VARCHAR) AS part_key,
           concat('"', p_name, '" C:\\P\\N') AS _9_part_name, p_brand FROM part
""")
def delimited_literal(spark, d):
    """Tab-separated, with quotes and backslashes that are data."""
    return read_delimited(spark, _literal_file(spark, d), "\t", quoting=False)


@query("""
    SELECT count(*) AS records, 2 * count(*) AS quotes, CAST(0 AS BIGINT) AS open_lines FROM part
""")
def delimited_file_facts(spark, d):
    facts = delimited_facts(spark, _literal_file(spark, d))
    return facts.agg(
        big(F.sum("lines") - F.count(F.lit(1))).alias("records"),
        F.sum("quotes").alias("quotes"),
        F.sum("open_lines").alias("open_lines"),
    )


@query("""
    SELECT count(*) AS ragged FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0
""")
def ragged_files(spark, d):
    """Records that are wider or narrower than their header, found ahead of a load."""
    folder = fresh_folder(spark, "ragged")
    key = F.col("o_orderkey")
    line = F.concat_ws(
        ",",
        key.cast("string"),
        F.when(key % 7 == 0, F.concat("o_orderpriority", F.lit(",more"))).when(
            key % 11 != 0, F.col("o_orderpriority")
        ),
    )
    # One column without quoting: its name is the header line and its values are the records.
    (
        table(spark, d, "orders")
        .select(line.alias("key,priority"))
        .write.option("header", True)
        .option("quote", "")
        .option("escape", "")
        .option("sep", "\x01")
        .csv(folder)
    )
    found = ragged_records(spark, folder, ["key", "priority"], ",", True)
    return found.where("example is not null and line > 1").agg(F.sum("records").alias("ragged"))


def _monthly_files(spark, orders, record, name):
    """A file of raw records per month of the orders, in order of their keys, under a header."""
    folder = fresh_folder(spark, name)
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    rows = orders.select(month, "o_orderkey", record.alias("value"))
    header = F.lit("key,priority,note").alias("value")
    heads = orders.select(month).distinct().select("month", F.lit(None).alias("o_orderkey"), header)
    (
        rows.union(heads)
        .repartition("month")
        .sortWithinPartitions("month", F.col("o_orderkey").asc_nulls_first())
        .select("month", "value")
        .write.partitionBy("month")
        .text(folder)
    )
    return folder


def _in_month(path="path"):
    return F.regexp_extract(path, "month=([0-9-]+)", 1).alias("month")


@query("""
    WITH o AS (
        SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderkey,
               2 + coalesce(sum(1 + o_orderkey % 3) OVER (
                   PARTITION BY month ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line
        FROM orders)
    SELECT month, CAST(line AS BIGINT) AS line, CAST(o_orderkey AS VARCHAR) AS key
    FROM o WHERE o_orderkey % 41 = 0 OR o_orderkey % 59 = 0
""")
def bad_record_lines(spark, d):
    """The line on which each record of a wrong width begins, in files with line breaks in quotes."""
    key = F.col("o_orderkey")
    note = F.concat(F.lit('"a, ""b""'), F.repeat(F.lit('\n""'), (key % 3).cast("int")), F.lit('"'))
    wide = F.when(key % 41 == 0, F.concat_ws(",", key.cast("string"), "o_orderpriority", note, F.lit("more")))
    narrow = F.when(key % 59 == 0, F.concat_ws(",", key.cast("string"), note))
    record = F.coalesce(wide, narrow, F.concat_ws(",", key.cast("string"), "o_orderpriority", note))
    folder = _monthly_files(spark, table(spark, d, "orders"), record, "bad-records")
    found = bad_records(spark, folder, ["key", "priority", "note"], ",", True)
    return found.select(_in_month(), "line", F.substring_index("text", ",", 1).alias("key"))


@query("""
    WITH o AS (
        SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderkey,
               row_number() OVER (PARTITION BY month ORDER BY o_orderkey DESC) AS from_end,
               1 + count(*) OVER (PARTITION BY month ORDER BY o_orderkey) AS line
        FROM orders)
    SELECT month, CAST(line AS BIGINT) AS line FROM o WHERE from_end = 1 AND o_orderkey % 2 = 0
""")
def open_record_lines(spark, d):
    """Files whose last record has a quote that never closes, and the line on which it begins."""
    orders = table(spark, d, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    ends = orders.groupBy("month").agg(F.max("o_orderkey").alias("last")).where("last % 2 = 0")
    known = orders.join(ends, "month", "left")
    note = F.when(F.col("last") == F.col("o_orderkey"), F.lit('"open')).otherwise(F.lit('"note"'))
    record = F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderpriority", note)
    folder = _monthly_files(spark, known, record, "open-records")
    return open_records(spark, folder).select(_in_month(), "line")


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, source FROM documents")
def delimited_quoted(spark, d):
    """Comma-separated, with commas, quotes and line breaks inside quoted fields."""
    folder = fresh_folder(spark, "quoted")
    (
        table(spark, d, "documents")
        .select("doc_id", "text", "source")
        .write.option("header", True)
        .option("escape", '"')
        .option("quoteAll", True)
        .option("maxRecordsPerFile", 50_000)
        .csv(folder)
    )
    return read_delimited(spark, folder, ",", quoting=True)


@query("""
    SELECT CAST(51000000000 + c_custkey AS VARCHAR) AS abn,
           CASE WHEN c_custkey % 2 = 0 THEN concat(c_name, ' & <Co>') END AS entity_name,
           CASE WHEN c_custkey % 2 <> 0 THEN concat('A ', c_mktsegment) END AS given_names,
           CASE WHEN c_custkey % 3 <> 0 THEN concat('00', c_nationkey) END AS asic_number,
           c_mktsegment AS address_state,
           CASE WHEN c_custkey % 2 = 0 THEN 'BN1|BN2' ELSE '' END AS business_names,
           CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE '' END AS trading_names,
           CASE WHEN c_custkey % 5 = 0 THEN 'FUND@2011-01-01|@-' ELSE '' END AS endorsements,
           strftime(DATE '2000-01-01' + CAST(c_custkey % 5000 AS INTEGER), '%Y-%m-%d') AS since,
           20260601 + CAST(c_custkey % 20 AS BIGINT) AS updated
    FROM customer
""")
def register_xml(spark, d):
    """The register's XML: one document per file, names told apart by an attribute."""
    folder = fresh_folder(spark, "register")
    k = F.col("c_custkey")
    even = k % 2 == 0

    def name(kind, c):
        text = c.alias("NonIndividualNameText")
        return F.array(F.struct(F.lit(kind).alias("_type"), text)).alias("NonIndividualName")

    def where(c):
        return F.struct(F.struct(c.alias("State"), F.lit("2000").alias("Postcode"))
                        .alias("AddressDetails")).alias("BusinessAddress")

    segment = F.col("c_mktsegment")
    own = F.struct(name("MN", F.concat("c_name", F.lit(" & <Co>"))), where(segment))
    person = F.struct(
        F.struct(
            F.lit("LGL").alias("_type"),
            F.array(F.lit("A"), segment).alias("GivenName"),
            F.col("c_name").alias("FamilyName"),
        ).alias("IndividualName"),
        where(segment),
    )
    others = F.array(
        F.struct(name("BN", F.lit("BN1"))),
        F.struct(name("TRD", F.col("c_name"))),
        F.struct(name("BN", F.lit("BN2"))),
    )
    since = F.date_add(F.lit("2000-01-01").cast("date"), (k % 5000).cast("int"))
    fund = F.struct(
        F.lit("20110101").alias("_DGRStatusFromDate"),
        F.struct(F.lit("DGR").alias("_type"), F.lit("FUND").alias("NonIndividualNameText"))
        .alias("NonIndividualName"),
    )
    bare = F.struct(F.lit("soon").alias("_DGRStatusFromDate"), F.lit(None).cast(
        "struct<_type:string,NonIndividualNameText:string>").alias("NonIndividualName"))
    (
        table(spark, d, "customer")
        .select(
            (F.lit(20260601) + k % 20).alias("_recordLastUpdatedDate"),
            F.struct(
                (F.lit(51000000000) + k).alias("_VALUE"),
                F.lit("ACT").alias("_status"),
                F.date_format(since, "yyyyMMdd").alias("_ABNStatusFromDate"),
            ).alias("ABN"),
            F.when(even, own).alias("MainEntity"),
            F.when(~even, person).alias("LegalEntity"),
            F.when(
                k % 3 != 0,
                F.struct(
                    F.concat(F.lit("00"), "c_nationkey").alias("_VALUE"),
                    F.lit("undetermined").alias("_ASICNumberType"),
                ),
            ).alias("ASICNumber"),
            F.when(k % 5 == 0, F.array(fund, bare)).alias("DGR"),
            F.when(even, others).alias("OtherEntity"),
        )
        .write.format("xml")
        .option("rootTag", "Transfer")
        .option("rowTag", "ABR")
        .save(folder)
    )
    rows = register_rows(read_register_xml(spark, f"{folder}/*.xml"))
    funds = F.transform(
        "dgr",
        lambda g: F.concat_ws(
            "@", F.coalesce(g["name"], F.lit("")), F.coalesce(iso(g["statusFromDate"]), F.lit("-"))
        ),
    )
    return rows.select(
        "abn",
        "entity_name",
        "given_names",
        "asic_number",
        "address_state",
        F.array_join("business_names", "|").alias("business_names"),
        F.array_join("trading_names", "|").alias("trading_names"),
        F.array_join(funds, "|").alias("endorsements"),
        iso(F.col("abn_status_from_date")).alias("since"),
        big("record_last_updated").alias("updated"),
    )


def release_lines(spark, d):
    """Releases with an id alone and in a package, others in a package; each is made JSON once."""
    content = F.xxhash64("l_orderkey", "l_linenumber", F.to_json("parties"), F.to_json("contracts"))
    ocid = F.when(F.col("l_linenumber") != 2, content.cast("string")).alias("ocid")
    one = releases_of(spark, d).select(ocid, "parties", "contracts")
    one = one.select("ocid", F.to_json(F.struct("ocid", "parties", "contracts")).alias("bare"))
    package = F.concat(F.lit('{"releases":['), "bare", F.lit("]}"))
    both = F.when(F.col("ocid").isNull(), F.array(package)).otherwise(F.array("bare", package))
    return one.select(F.explode(both).alias("value"))


@query("""
    SELECT CAST(51000000000 + l_suppkey AS VARCHAR) AS supplier, CAST(sum(c) AS BIGINT) AS cents,
           count(*) AS releases, min(s) AS first_signed, max(s) AS last_signed
    FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey,
                 CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) + 10001 AS c,
                 CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS s
          FROM lineitem WHERE l_linenumber <> 2
          UNION ALL
          SELECT l_orderkey, l_linenumber, l_suppkey,
                 CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) + 10001,
                 CAST(CAST(l_shipdate AS DATE) AS VARCHAR)
          FROM lineitem WHERE l_linenumber = 2)
    GROUP BY l_suppkey
""")
def ocds_releases(spark, d):
    """Gzipped JSON lines, every release there twice; second lines have no id and all count."""
    folder = fresh_folder(spark, "releases")
    # A gzipped file is read by one task, so none gets too many lines.
    files = release_lines(spark, d).write.option("maxRecordsPerFile", 50_000)
    files.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(folder)
    extracted = extract_releases(read_ocds(spark, folder), POSITION)
    return spend_by_supplier(distinct_releases(extracted, POSITION))


def _workbooks(rows, label, preamble, columns):
    """Rows in workbooks of at most 500, one prose sheet before the data sheet."""

    def encode(pdf: pd.DataFrame) -> pd.DataFrame:
        data = pdf[list(columns)].astype(object).where(pdf[list(columns)].notna(), None)
        cells = [list(columns.values()), *data.values.tolist()]
        sheets = [("Data", [*preamble, *cells])]
        if label:
            sheets.insert(0, (label, [["Notes"], ["More notes"]]))
        path = f"book-{pdf['book'].iloc[0]}.xlsx"
        return pd.DataFrame({"path": [path], "content": [encode_workbook(sheets)]})

    # Small in bytes but long in work, so the number of tasks is set, not left to the size.
    tasks = 2 * rows.sparkSession.sparkContext.defaultParallelism
    spread = rows.repartition(tasks, "book")
    return spread.groupBy("book").applyInPandas(encode, "path string, content binary")


@query("""
    SELECT CAST(51000000000 + c_custkey AS VARCHAR) AS abn, '2023-24' AS income_year,
           CAST(round(c_acctbal * 100) AS BIGINT) AS income,
           CASE WHEN c_acctbal > 0 THEN CAST(round(c_acctbal * 100) AS BIGINT) END AS taxable
    FROM customer WHERE c_custkey % 10 <> 0
""")
def workbook_tax_transparency(spark, d):
    """A prose sheet first; numbers as numbers and as text with signs; blank rows between."""
    k = F.col("c_custkey")
    amount = F.col("c_acctbal")
    rows = table(spark, d, "customer").select(
        (F.lit(51000000000) + k).cast("double").alias("key"),
        F.when(k % 10 != 0, F.concat(F.lit("$ "), F.format_number("c_acctbal", 2))).alias("total"),
        amount.alias("taxable"),
        F.lit(None).cast("double").alias("payable"),
        F.lit(" 2023-24 ").alias("year"),
        F.floor(k / 500).alias("book"),
    )
    columns = {
        "key": "ABN",
        "total": "Total income $",
        "taxable": "Taxable income $",
        "payable": "Tax payable $",
        "year": "Income year",
    }
    grid = decode_workbooks(_workbooks(rows, "Information", [["Title"], []], columns))
    return normalise.tax_transparency(grid).select(
        "abn",
        "income_year",
        big(F.col("total_income") * 100).alias("income"),
        big(F.col("taxable_income") * 100).alias("taxable"),
    )


@query("""
    SELECT CASE WHEN c_custkey % 2 = 0 THEN CAST(51000000000 + c_custkey AS VARCHAR) END AS abn,
           CASE WHEN c_custkey % 2 <> 0 THEN lpad(CAST(4000000 + c_custkey AS VARCHAR), 9, '0') END
               AS acn, '2022-23' AS income_year, CAST(round(c_acctbal * 100) AS BIGINT) AS spent
    FROM customer WHERE c_custkey % 7 <> 0
""")
def workbook_rd_incentive(spark, d):
    """Keys that lost their leading zeros; an amended column that must not be taken."""
    k = F.col("c_custkey")
    key = F.when(k % 7 == 0, 12345).otherwise(
        F.when(k % 2 == 0, F.lit(51000000000) + k).otherwise(F.lit(4000000) + k)
    )
    rows = table(spark, d, "customer").select(
        F.col("c_name").alias("name"),
        key.alias("key"),
        F.lit(1.0).alias("amended"),
        F.col("c_acctbal").alias("spent"),
        F.lit("2022-23").alias("year"),
        F.floor(k / 500).alias("book"),
    )
    columns = {
        "name": "Company name",
        "key": "ABN/ACN",
        "amended": "Total amended R&D expenditure $",
        "spent": "Total R&D expenditure (notional) $",
        "year": "Income Year",
    }
    grid = decode_workbooks(_workbooks(rows, None, [["Report of entities"]], columns))
    return normalise.rd_tax_incentive(grid).select(
        "abn", "acn", "income_year", big(F.col("total_rd_expenditure") * 100).alias("spent")
    )


@query("""
    SELECT CAST(51000000000 + o_custkey AS VARCHAR) AS recipient,
           CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents,
           count(*) AS awards, min(CAST(o_orderdate AS DATE)) AS first_published,
           max(CAST(o_orderdate AS DATE)) AS last_published
    FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 GROUP BY o_custkey
""")
def workbook_grants(spark, d):
    """Grant reports: the header below a block of criteria, dates as serial numbers."""
    k = F.col("o_orderkey")
    key = F.concat_ws(" ", F.lit("51"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    serial = F.datediff(F.to_date("o_orderdate"), F.lit("1899-12-30").cast("date"))
    rows = table(spark, d, "orders").select(
        F.when(k % 11 != 0, F.concat(F.lit("GA"), k)).alias("award"),
        F.when(k % 7 != 0, key).otherwise(F.lit("")).alias("recipient"),
        serial.cast("double").alias("day"),
        F.col("o_totalprice").alias("value"),
        F.floor(k / 500).alias("book"),
    )
    columns = {
        "award": "GA ID",
        "recipient": "Recipient ABN",
        "day": "Publish Date",
        "value": "Value (AUD)",
    }
    preamble = [["Grant Award Published"], [], ["Date Range", "3-Mar-2025 to 9-Mar-2025"]]
    grid = decode_workbooks(_workbooks(rows, None, preamble, columns))
    return awards_by_recipient(read_grant_awards(grid))


def _order_documents(spark, d):
    return table(spark, d, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 11, "0").alias("_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("state"),
        to_cents(F.col("o_totalprice")).alias("cents"),
    )


def _shards(spark, d):
    folder = fresh_folder(spark, "shards")
    orders = _order_documents(spark, d)
    write_shards(orders, folder, "state", shards=12)
    return orders, folder


@query("""
    SELECT CASE WHEN o_orderstatus = 'P' THEN 'other' ELSE lower(o_orderpriority) END AS bucket,
           count(*) AS records, true AS hashed
    FROM orders GROUP BY 1
""")
def shards_and_manifest(spark, d):
    """Compressed, ordered shards per bucket; sizes and hashes; counts agree both ways."""
    orders, folder = _shards(spark, d)
    manifest = build_manifest(spark, folder, bucket_counts(orders, "state"))
    return manifest.groupBy("bucket").agg(
        F.sum("records").alias("records"),
        F.bool_and((F.length("sha256") == 64) & (F.col("bytes") > 0)).alias("hashed"),
    )


@query("""
    SELECT lpad(CAST(o_orderkey AS VARCHAR), 11, '0') AS _id,
           concat('{"_id":"', lpad(CAST(o_orderkey AS VARCHAR), 11, '0'), '","state":',
                  CASE WHEN o_orderstatus = 'P' THEN 'null'
                       ELSE concat('"', o_orderpriority, '"') END,
                  ',"cents":', CAST(round(o_totalprice * 100) AS BIGINT), '}') AS value
    FROM orders
""")
def merged_shards(spark, d):
    _, folder = _shards(spark, d)
    return merge_shards(spark, folder)


@query("""
    SELECT aggregate, CAST(n AS BIGINT) AS records
    FROM (SELECT count(*) AS n FROM orders), (VALUES (true), (false)) v(aggregate)
""")
def release_bundle(spark, d):
    """Shards, and the bundle that repeats them: both hold every record once."""
    orders, folder = _shards(spark, d)
    manifest = build_manifest(spark, folder, bucket_counts(orders, "state"))
    both = write_bundle(spark, folder, fresh_folder(spark, "bundle"), manifest)
    return both.groupBy("aggregate").agg(F.sum("records").alias("records"))


@query("""
    WITH o AS (SELECT CASE WHEN o_orderstatus = 'P' THEN 'other' ELSE lower(o_orderpriority) END AS bucket FROM orders)
    SELECT bucket, false AS aggregate, count(*) AS records, true AS hashed FROM o GROUP BY 1
    UNION ALL SELECT 'all', true, count(*), true FROM o
""")
def sliced_release(spark, d):
    """Shards and bundle cut by bytes from one sorted layout; both hold every record once."""
    orders = _order_documents(spark, d)
    lines, shards, bundle = (fresh_folder(spark, n) for n in ("lines", "shards", "bundle"))
    write_ordered_lines(orders, lines, "state")
    write_line_shards(spark, lines, shards, max_bytes=1 << 20)
    manifest = build_manifest(spark, shards, bucket_counts(orders, "state"))
    both = write_line_bundle(spark, lines, bundle, manifest, max_bytes=1 << 20)
    hashed = F.bool_and((F.length("sha256") == 64) & F.col("bytes").between(1, 1 << 20))
    return both.groupBy("bucket", "aggregate").agg(F.sum("records").alias("records"), hashed.alias("hashed"))


@query("""
    SELECT lower(n_name) AS bucket, count(*) AS n, '2026.06.28' AS version, '1' AS "schemaVersion"
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
""")
def metadata_counts(spark, d):
    """The counts of a release's metadata, written and read back."""
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    counts = bucket_counts(table(spark, d, "customer").join(nations, "c_nationkey"), "n_name")
    folder = fresh_folder(spark, "metadata")
    write_metadata(folder, "2026.06.28", "1", counts, counts.select(F.col("bucket").alias("shard")), counts)
    return spark.read.schema("version string, schemaVersion string, bucket string, n bigint").json(f"{folder}/counts")


@query("""
    SELECT c_custkey AS key, count(o_orderkey) AS orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1
""")
def bucketed_join(spark, d):
    """Two tables laid out in buckets of their key, joined where they are."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    customers, orders = fresh_folder(spark, "customers"), fresh_folder(spark, "orders")
    own = table(spark, d, "customer").select(F.col("c_custkey").alias("key"))
    other = table(spark, d, "orders").select(F.col("o_custkey").alias("key"), "o_orderkey")
    write_bucketed(own, customers, "key", buckets)
    write_bucketed(other, orders, "key", buckets)
    made = read_table(spark, orders, other.schema).groupBy("key").agg(F.count("o_orderkey").alias("orders"))
    joined = read_table(spark, customers, own.schema).join(made, "key", "left")
    return joined.select("key", F.coalesce("orders", F.lit(0)).cast("bigint").alias("orders"))


@query("""
    SELECT '| ' || bucket || ' | ' || p || ' | ' || c || ' | '
           || printf('%+.1f%%', 100.0 * (c - p) / p) || ' | '
           || CASE WHEN abs(c - p) > 0.02 * p THEN 'moved' ELSE 'ok' END || ' |' AS line
    FROM (SELECT lower(o_orderpriority) AS bucket, count(*) FILTER (o_orderstatus <> 'P') AS c,
                 count(*) FILTER (o_orderstatus <> 'F') AS p
          FROM orders GROUP BY 1)
    UNION ALL SELECT '| bucket | prior orders | current orders | change | status |'
    UNION ALL SELECT '|---|---|---|---|---|'
""")
def comparison_report(spark, d):
    orders = table(spark, d, "orders")
    current = bucket_counts(orders.where("o_orderstatus <> 'P'"), "o_orderpriority")
    prior = bucket_counts(orders.where("o_orderstatus <> 'F'"), "o_orderpriority")
    folder = fresh_folder(spark, "comparison")
    write_comparison(compare_counts(current, prior, "bucket", 0.02), folder, "orders")
    return spark.read.text(f"{folder}/markdown").withColumnRenamed("value", "line")


@query("""
    SELECT CAST(o_custkey AS VARCHAR) AS abn,
           CAST(CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS VARCHAR) AS cents,
           count(*) AS grants
    FROM orders GROUP BY o_custkey
""")
def awards_file(spark, d):
    awards = table(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("recipient"),
        to_cents(F.col("o_totalprice")).alias("cents"),
        F.to_date("o_orderdate").alias("published"),
    )
    folder = fresh_folder(spark, "awards")
    write_awards(awards_by_recipient(awards), folder)
    held = spark.read.schema("abn string, totalValueCents string, grantCount bigint").json(folder)
    return held.toDF("abn", "cents", "grants")


@query("""
    SELECT concat('{"_id":', o_orderkey, ',"status":"', o_orderstatus, '"}') AS value FROM orders
""")
def ordered_ndjson(spark, d):
    """All lines, in order of the id over all files."""
    folder = fresh_folder(spark, "ndjson")
    orders = table(spark, d, "orders")
    doc = orders.select(F.col("o_orderkey").alias("_id"), F.col("o_orderstatus").alias("status"))
    write_ndjson(doc, folder)
    return spark.read.text(folder)


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey DESC")
def ordered_output(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey").orderBy(F.desc("o_orderkey"))
