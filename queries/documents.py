"""Whole documents: the test tables play the register and all its side registers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from entityfold.functions import cents_to_money, to_cents
from entityfold.operators import (
    awards_by_recipient,
    check_documents,
    coverage,
    rule_counts,
)
from entityfold.plans import fixed_values as fixed
from entityfold.plans.contract import contract_rules, coverage_counters
from entityfold.plans.document import build_documents, derive_flags
from entityfold.sinks import json_line
from queries.registry import big, query, table

VERSION = "2026.06.28"


def _abn(c):
    return (F.lit(51000000000) + F.col(c)).cast("string")


def _acn(c):
    return F.lpad(c.cast("string"), 9, "0")


def _as(df: DataFrame, name: str) -> DataFrame:
    """Only the columns of a typed table, missing ones null."""
    have = set(df.columns)
    return df.selectExpr(
        *[
            f"cast({f.name if f.name in have else 'null'} as {f.dataType.simpleString()})"
            f" as {f.name}"
            for f in StructType.fromDDL(fixed.TABLES[name])
        ]
    )


def register_base(spark: SparkSession, d: str) -> DataFrame:
    """Customers as the register. A fifth has no number; the others share few numbers."""
    k = F.col("c_custkey")
    individual = k % 6 == 0
    none = F.array().cast("array<string>")
    endorsement = F.struct(
        F.col("c_name").alias("name"),
        F.lit("ACT").alias("status"),
        F.lit("2011-01-01").cast("date").alias("statusFromDate"),
    )
    base = table(spark, d, "customer").select(
        _abn("c_custkey").alias("abn"),
        F.when(F.col("c_mktsegment") == "FURNITURE", "CAN").otherwise("ACT").alias("abn_status"),
        F.when(
            k % 11 != 0, F.date_add(F.lit("2000-01-01").cast("date"), (k % 9000).cast("int"))
        ).alias("abn_status_from_date"),
        F.when(individual, "IND").otherwise("PRV").alias("entity_type_code"),
        F.when(~individual, F.col("c_name")).alias("entity_name"),
        F.when(individual & (k % 4 == 0), F.lit("GIVEN")).alias("given_names"),
        F.when(individual, F.col("c_name")).alias("family_name"),
        F.when(k % 5 != 0, _acn(k % 200)).alias("asic_number"),
        F.when(k % 7 == 0, "ARBN").when(k % 7 == 1, "acn").otherwise("undetermined")
        .alias("asic_number_type"),
        F.when(F.col("c_acctbal") > 0, "ACT").when(k % 2 == 0, "CAN").alias("gst_status"),
        F.when(k % 8 == 0, F.lit(" ")).otherwise(F.col("c_mktsegment")).alias("address_state"),
        F.when(k % 3 == 0, F.array("c_name", "c_mktsegment")).otherwise(none)
        .alias("business_names"),
        F.when(k % 9 == 0, F.array(endorsement)).alias("dgr"),
        (F.lit(20260000) + k % 10000).cast("int").alias("record_last_updated"),
    )
    return _as(base, "abn")


def _keyed(df: DataFrame, condition: str, *keys: str) -> DataFrame:
    """Keys only on some rows; the others reach the operators, which have to refuse them."""
    return df.withColumns({k: F.when(F.expr(condition), F.col(k)) for k in keys})


def register_dims(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Orders, lines, suppliers and parts as the fifteen side registers."""
    orders = table(spark, d, "orders").withColumns(
        {
            "abn": _abn("o_custkey"),
            "day": F.to_date("o_orderdate"),
            "cents": to_cents(F.col("o_totalprice")),
            "year": F.year("o_orderdate").cast("string"),
        }
    )
    suppliers = table(spark, d, "supplier")
    s = F.col("s_suppkey")
    even = s % 2 == 0
    keyed = suppliers.withColumns(
        {
            "abn": F.when(even, _abn("s_suppkey")),
            "acn": F.when(~even, _acn(s)),
            "licence_number": s.cast("string"),
            "rep_number": F.concat(F.lit("R"), s),
            "name": F.col("s_name"),
            "start_date": F.when(
                s % 3 != 0, F.date_add(F.lit("2005-01-01").cast("date"), s.cast("int"))
            ),
        }
    )
    big_orders = _keyed(orders, "o_totalprice > 400000", "abn")
    lines = table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.sum(to_cents(F.col("l_extendedprice"))).alias("cents"),
        F.count(F.lit(1)).alias("contract_count"),
        F.min(F.to_date("l_shipdate")).alias("first_contract_date"),
        F.max(F.to_date("l_shipdate")).alias("last_contract_date"),
    )
    awards = awards_by_recipient(
        _keyed(orders, "o_orderstatus = 'P'", "abn").select(
            F.col("abn").alias("recipient"), "cents", F.col("day").alias("published")
        )
    )
    code = F.when(F.col("o_orderkey") % 5 == 0, "EXAD").when(
        F.col("o_orderkey") % 5 == 1, "SOFF"
    ).when(F.col("o_orderkey") % 5 == 2, "Deregistered").otherwise("Registered")
    tables = {
        "asic_company": _keyed(orders, "o_orderstatus = 'F'", "abn").select(
            "abn",
            F.concat("o_orderpriority", F.lit("/"), "o_orderkey").alias("company_name"),
            code.alias("status"),
            F.col("day").alias("registration_date"),
            F.when(F.col("o_orderkey") % 3 != 0, F.col("day")).alias("current_name_start_date"),
        ),
        "asic_business_name": _keyed(orders, "o_totalprice > 300000", "abn").select(
            "abn",
            F.col("o_orderpriority").alias("business_name"),
            F.col("o_orderstatus").alias("status"),
            F.when(F.col("o_orderkey") % 4 != 0, F.col("day")).alias("registration_date"),
            F.lit(None).cast("date").alias("cancellation_date"),
        ),
        "acnc_charity": _keyed(orders, "o_totalprice > 450000", "abn").select(
            "abn",
            F.col("o_orderkey").cast("string").alias("charity_name"),
            F.lit("Registered").alias("status"),
            F.col("day").alias("registration_date"),
        ),
        "acnc_ais": _keyed(orders, "o_orderstatus = 'O'", "abn").select(
            "abn",
            F.col("day").alias("reporting_period_end"),
            cents_to_money(F.col("cents")).alias("total_revenue"),
            F.col("o_orderkey").alias("volunteers"),
        ),
        "asic_afs_licence": keyed,
        "asic_credit_licence": _keyed(keyed, "licence_number % 3 <> 1", "abn", "acn").withColumn("status", F.lit("APPR")),
        "asic_banned_disqualified": table(spark, d, "part").select(
            F.when(F.col("p_size") > 40, _acn(F.col("p_partkey") % 300)).alias("acn"),
            F.col("p_type").alias("type"),
            F.when(
                F.col("p_partkey") % 4 != 0,
                F.date_add(F.lit("2010-01-01").cast("date"), (F.col("p_partkey") % 50).cast("int")),
            ).alias("start_date"),
            F.col("p_partkey").cast("string").alias("comment"),
        ),
        "gov_spend": lines.select(
            _abn("l_suppkey").alias("abn"),
            cents_to_money(F.col("cents")).alias("total_value_aud"),
            "contract_count",
            "first_contract_date",
            "last_contract_date",
        ),
        "gov_grants": awards.select(
            F.col("recipient").alias("abn"),
            cents_to_money(F.col("cents")).alias("total_value_aud"),
            F.col("awards").alias("grant_count"),
            F.col("first_published").alias("first_grant_date"),
            F.col("last_published").alias("last_grant_date"),
        ),
        "tax_transparency": big_orders.select(
            "abn",
            F.col("year").alias("income_year"),
            cents_to_money(F.col("cents")).alias("total_income"),
        ),
        "rd_tax_incentive": big_orders.select(
            F.when(F.col("o_orderkey") % 2 == 0, F.col("abn")).alias("abn"),
            F.when(
                F.col("abn").isNotNull() & (F.col("o_orderkey") % 2 != 0),
                _acn(F.col("o_custkey") % 200),
            ).alias("acn"),
            F.col("year").alias("income_year"),
            cents_to_money(F.col("cents")).alias("total_rd_expenditure"),
        ),
        "asic_afs_rep": keyed,
        "asic_credit_rep": _keyed(keyed, "licence_number % 3 <> 2", "abn", "acn"),
        "wgea_reporter": _keyed(orders, "o_totalprice > 480000", "abn").select(
            "abn", F.col("o_orderpriority").alias("primary_organisation")
        ),
        "asic_smsf_auditor": _keyed(orders, "o_totalprice < 20000", "abn").select(
            "abn",
            F.col("o_orderkey").cast("string").alias("auditor_number"),
            F.col("day").alias("registration_date"),
        ),
    }
    return {name: _as(df, name) for name, df in tables.items()}


def documents(spark: SparkSession, d: str) -> DataFrame:
    dims = register_dims(spark, d)
    return build_documents(register_base(spark, d), dims, VERSION)


_TABLES_SQL = """
    o AS (SELECT *, CAST(51000000000 + o_custkey AS VARCHAR) AS abn,
                 CAST(o_orderdate AS DATE) AS day,
                 CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
                 CAST(year(o_orderdate) AS VARCHAR) AS y FROM orders),
    k AS (SELECT *, CASE WHEN s_suppkey % 2 = 0 THEN CAST(51000000000 + s_suppkey AS VARCHAR) END
                    AS abn,
                 CASE WHEN s_suppkey % 2 <> 0 THEN lpad(CAST(s_suppkey AS VARCHAR), 9, '0') END
                    AS acn,
                 CAST(s_suppkey AS VARCHAR) AS licence, concat('R', s_suppkey) AS rep
          FROM supplier),
    base AS (SELECT *, CAST(51000000000 + c_custkey AS VARCHAR) AS id,
                 CASE WHEN c_custkey % 5 <> 0 THEN lpad(CAST(c_custkey % 200 AS VARCHAR), 9, '0')
                 END AS acn,
                 c_custkey % 7 <> 0 AS able,
                 CASE WHEN c_custkey % 11 <> 0
                      THEN DATE '2000-01-01' + CAST(c_custkey % 9000 AS INTEGER) END AS since
             FROM customer),
    company AS (SELECT DISTINCT ON (abn) abn, concat(o_orderpriority, '/', o_orderkey) AS name,
                 CASE o_orderkey % 5 WHEN 0 THEN 'EXAD' WHEN 1 THEN 'SOFF'
                      WHEN 2 THEN 'Deregistered' ELSE 'Registered' END AS status
             FROM o WHERE o_orderstatus = 'F'
             ORDER BY abn, CASE WHEN o_orderkey % 3 <> 0 THEN day END DESC NULLS LAST,
                      concat(o_orderpriority, '/', o_orderkey)),
    bn AS (SELECT abn, count(*) AS n,
                  string_agg(concat(o_orderpriority, ':', coalesce(strftime(r, '%Y-%m-%d'), '-'),
                                    ':', o_orderstatus), '|'
                             ORDER BY o_orderpriority, r NULLS LAST, o_orderstatus) AS names
           FROM (SELECT *, CASE WHEN o_orderkey % 4 <> 0 THEN day END AS r FROM o
                 WHERE o_totalprice > 300000) GROUP BY abn),
    charity AS (SELECT DISTINCT ON (abn) abn, CAST(o_orderkey AS VARCHAR) AS name FROM o
             WHERE o_totalprice > 450000 ORDER BY abn, day DESC, CAST(o_orderkey AS VARCHAR)),
    ais AS (SELECT DISTINCT ON (abn) abn, cents, o_orderkey AS volunteers FROM o
             WHERE o_orderstatus = 'O' ORDER BY abn, day DESC, cents, o_orderkey),
    spend AS (SELECT CAST(51000000000 + l_suppkey AS VARCHAR) AS abn, count(*) AS n,
                 CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents
              FROM lineitem GROUP BY l_suppkey),
    awards AS (SELECT abn, CAST(sum(cents) AS BIGINT) AS cents, min(day) AS first_day FROM o
             WHERE o_orderstatus = 'P' GROUP BY abn),
    tax AS (SELECT DISTINCT ON (abn) abn, y, cents FROM o WHERE o_totalprice > 400000
             ORDER BY abn, y DESC, cents),
    rda AS (SELECT DISTINCT ON (abn) abn, y, cents FROM o
             WHERE o_totalprice > 400000 AND o_orderkey % 2 = 0 ORDER BY abn, y DESC, cents),
    rdc AS (SELECT DISTINCT ON (acn) acn, y, cents
             FROM (SELECT *, lpad(CAST(o_custkey % 200 AS VARCHAR), 9, '0') AS acn FROM o
                   WHERE o_totalprice > 400000 AND o_orderkey % 2 <> 0)
             ORDER BY acn, y DESC, cents),
    banned AS (SELECT acn, count(*) AS n,
                 string_agg(concat(p_type, '@', coalesce(strftime(d, '%Y-%m-%d'), '-')), '|'
                            ORDER BY d NULLS LAST, p_type, CAST(p_partkey AS VARCHAR)) AS acts
             FROM (SELECT *, lpad(CAST(p_partkey % 300 AS VARCHAR), 9, '0') AS acn,
                          CASE WHEN p_partkey % 4 <> 0 THEN DATE '2010-01-01'
                               + CAST(p_partkey % 50 AS INTEGER) END AS d
                   FROM part WHERE p_size > 40) GROUP BY acn),
    wgea AS (SELECT abn, min(o_orderpriority) AS org FROM o WHERE o_totalprice > 480000
             GROUP BY abn),
    smsf AS (SELECT DISTINCT ON (abn) abn, CAST(o_orderkey AS VARCHAR) AS n FROM o
             WHERE o_totalprice < 20000 ORDER BY abn, day, CAST(o_orderkey AS VARCHAR))
"""


_JOINS_SQL = """
    FROM base
    LEFT JOIN company ON company.abn = id LEFT JOIN bn ON bn.abn = id
    LEFT JOIN charity ON charity.abn = id LEFT JOIN ais ON ais.abn = id
    LEFT JOIN spend ON spend.abn = id LEFT JOIN awards ON awards.abn = id
    LEFT JOIN tax ON tax.abn = id LEFT JOIN wgea ON wgea.abn = id
    LEFT JOIN smsf ON smsf.abn = id LEFT JOIN rda ON rda.abn = id
    LEFT JOIN k ka ON ka.abn = id
    LEFT JOIN k kc ON kc.acn = base.acn AND able
    LEFT JOIN rdc ON rdc.acn = base.acn AND able
    LEFT JOIN banned ON banned.acn = base.acn AND able
"""


@query(f"""
    WITH {_TABLES_SQL}
    SELECT id, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'CAN' ELSE 'ACT' END AS status,
        CASE WHEN c_custkey % 12 = 0 THEN concat('GIVEN ', c_name) ELSE c_name END AS name,
        CASE WHEN c_custkey % 6 = 0 THEN 'IND' ELSE 'PRV' END AS code,
        base.acn AS acn, CASE c_custkey % 7 WHEN 0 THEN 'ARBN' WHEN 1 THEN 'ACN' END AS acn_type,
        c_acctbal > 0 AS gst, CASE WHEN c_custkey % 8 <> 0 THEN c_mktsegment END AS state,
        CAST(CASE WHEN since IS NOT NULL THEN 2026 - year(since)
             - CASE WHEN month(since) * 100 + day(since) > 628 THEN 1 ELSE 0 END END AS BIGINT)
             AS age,
        CASE WHEN c_custkey % 3 = 0 THEN concat(c_name, ',', c_mktsegment) ELSE '' END AS own_names,
        CAST(CASE WHEN c_custkey % 9 = 0 THEN 1 ELSE 0 END AS BIGINT) AS endorsements,
        company.name AS company_name, company.status AS company_status,
        coalesce(bn.names, '') AS registered_names,
        charity.name AS charity_name,
        CASE WHEN charity.name IS NOT NULL THEN ais.cents END AS revenue_cents,
        CASE WHEN charity.name IS NOT NULL THEN ais.volunteers END AS volunteers,
        coalesce(ka.licence, kc.licence) AS licence,
        CASE WHEN ka.s_suppkey % 3 <> 1 THEN ka.licence
             WHEN kc.s_suppkey % 3 <> 1 THEN kc.licence END AS credit_licence,
        coalesce(ka.rep, kc.rep) AS rep,
        CASE WHEN ka.s_suppkey % 3 <> 2 THEN ka.rep
             WHEN kc.s_suppkey % 3 <> 2 THEN kc.rep END AS credit_rep,
        coalesce(banned.acts, '') AS actions,
        spend.cents AS spend_cents, spend.n AS contracts,
        awards.cents AS grant_cents, strftime(awards.first_day, '%Y-%m-%d') AS first_grant,
        tax.y AS tax_year, tax.cents AS income_cents,
        coalesce(rda.y, rdc.y) AS rd_year, coalesce(rda.cents, rdc.cents) AS rd_cents,
        wgea.org AS organisation, smsf.n AS auditor,
        coalesce(company.status = 'EXAD', false) AS in_administration,
        coalesce(company.status = 'SOFF', false) AS struck_off,
        ka.licence IS NOT NULL OR kc.licence IS NOT NULL AS licensed
    {_JOINS_SQL}
""")
def entity_documents(spark, d):
    doc = documents(spark, d)

    def cents(c):
        return big(F.col(c) * 100)

    names = F.transform(
        "registeredBusinessNames",
        lambda n: F.concat_ws(
            ":", n["name"], F.coalesce(n["registrationDate"], F.lit("-")), n["status"]
        ),
    )
    actions = F.transform(
        "bannedDisqualified",
        lambda a: F.concat_ws("@", a["type"], F.coalesce(a["startDate"], F.lit("-"))),
    )
    return doc.select(
        F.col("_id").alias("id"),
        F.col("abnStatus").alias("status"),
        F.col("entityName").alias("name"),
        F.col("entityTypeCode").alias("code"),
        "acn",
        F.col("acnType").alias("acn_type"),
        F.col("gstRegistered").alias("gst"),
        "state",
        big("ageYears").alias("age"),
        F.array_join("businessNames", ",").alias("own_names"),
        big(F.size("dgr")).alias("endorsements"),
        F.col("company.name").alias("company_name"),
        F.col("company.status").alias("company_status"),
        F.array_join(names, "|").alias("registered_names"),
        F.col("charity.name").alias("charity_name"),
        cents("charity.financials.totalRevenue").alias("revenue_cents"),
        F.col("charity.financials.volunteers").alias("volunteers"),
        F.col("financialServicesLicence.number").alias("licence"),
        F.col("creditLicence.number").alias("credit_licence"),
        F.col("afsAuthorisedRep.number").alias("rep"),
        F.col("creditRep.number").alias("credit_rep"),
        F.array_join(actions, "|").alias("actions"),
        cents("govSpend.totalValueAud").alias("spend_cents"),
        F.col("govSpend.contractCount").alias("contracts"),
        cents("govGrants.totalValueAud").alias("grant_cents"),
        F.col("govGrants.firstGrantDate").alias("first_grant"),
        F.col("taxTransparency.incomeYear").alias("tax_year"),
        cents("taxTransparency.totalIncome").alias("income_cents"),
        F.col("rdTaxIncentive.incomeYear").alias("rd_year"),
        cents("rdTaxIncentive.totalRdExpenditure").alias("rd_cents"),
        F.col("wgeaReporter.primaryOrganisation").alias("organisation"),
        F.col("smsfAuditor.number").alias("auditor"),
        F.col("flags.isExternalAdministration").alias("in_administration"),
        F.col("flags.isStrikeOffInProgress").alias("struck_off"),
        F.col("flags.isLicensed").alias("licensed"),
    )


@query(f"""
    WITH {_TABLES_SQL}
    SELECT count(*) AS total, count(company.abn) AS company, count(charity.abn) AS charity,
        count(*) FILTER (charity.abn IS NOT NULL AND ais.abn IS NOT NULL) AS "charityFinancials",
        count(bn.abn) AS "registeredBusinessNames",
        count(coalesce(ka.rep, kc.rep)) AS "financialServicesLicence",
        count(CASE WHEN ka.s_suppkey % 3 <> 1 THEN ka.licence
                   WHEN kc.s_suppkey % 3 <> 1 THEN kc.licence END) AS "creditLicence",
        count(banned.acn) AS "bannedDisqualified", count(spend.abn) AS "govSpend",
        count(awards.abn) AS "govGrants", count(tax.abn) AS "taxTransparency",
        count(coalesce(rda.y, rdc.y)) AS "rdTaxIncentive",
        count(coalesce(ka.rep, kc.rep)) AS "afsAuthorisedRep",
        count(CASE WHEN ka.s_suppkey % 3 <> 2 THEN ka.rep
                   WHEN kc.s_suppkey % 3 <> 2 THEN kc.rep END) AS "creditRep",
        count(wgea.abn) AS "wgeaReporter", count(smsf.abn) AS "smsfAuditor",
        count(*) FILTER (c_custkey % 3 = 0) AS "businessNames",
        count(*) FILTER (c_custkey % 9 = 0) AS dgr
    {_JOINS_SQL}
""")
def entity_coverage(spark, d):
    return coverage(documents(spark, d), coverage_counters())


@query(f"""
    WITH {_TABLES_SQL}
    SELECT id, c_custkey % 6 = 0 AS "isIndividual", company.abn IS NOT NULL AS "isCompany",
        charity.abn IS NOT NULL AS "isCharity", coalesce(ka.rep, kc.rep) IS NOT NULL AS "isLicensed",
        banned.acn IS NOT NULL AS "hasEnforcementAction", c_custkey % 9 = 0 AS "isDgr",
        spend.abn IS NOT NULL AS "hasGovContracts", awards.abn IS NOT NULL AS "receivesGovGrants",
        tax.abn IS NOT NULL AS "isLargeCorporateTaxpayer",
        coalesce(rda.y, rdc.y) IS NOT NULL AS "claimsRdTaxIncentive",
        coalesce(ka.rep, kc.rep) IS NOT NULL AS "isAfsAuthorisedRep",
        coalesce(CASE WHEN ka.s_suppkey % 3 <> 2 THEN ka.rep END,
                 CASE WHEN ka.s_suppkey IS NULL OR ka.s_suppkey % 3 = 2
                      THEN CASE WHEN kc.s_suppkey % 3 <> 2 THEN kc.rep END END)
            IS NOT NULL AS "isCreditRep",
        wgea.abn IS NOT NULL AS "isWgeaReporter", smsf.abn IS NOT NULL AS "isSmsfAuditor",
        coalesce(company.status = 'EXAD', false) AS "isExternalAdministration",
        coalesce(company.status = 'SOFF', false) AS "isStrikeOffInProgress",
        coalesce(company.status = 'DRGD' OR company.status = 'Deregistered', false)
            AS "isDeregistered"
    {_JOINS_SQL}
""")
def entity_flags(spark, d):
    """All derived flags of all documents."""
    return documents(spark, d).select(F.col("_id").alias("id"), "flags.*")


@query("""
    SELECT CAST(51000000000 + c_custkey AS VARCHAR) AS id, 'ACT' AS status, '' AS code,
           false AS gst, true AS active, CAST(NULL AS VARCHAR) AS since, CAST(NULL AS BIGINT) AS age,
           CAST(0 AS BIGINT) AS listed, false AS "isIndividual", false AS "isDeregistered"
    FROM customer
""")
def bare_documents(spark, d):
    """Base rows that have nothing but their key, and no side table: what a document defaults to."""
    base = _as(table(spark, d, "customer").select(_abn("c_custkey").alias("abn")), "abn")
    dims = {n: _as(spark.range(0), n) for n in fixed.TABLES if n != "abn"}
    doc = build_documents(base, dims, VERSION)
    lists = ["businessNames", "tradingNames", "otherNames", "dgr", "registeredBusinessNames"]
    listed = sum((F.size(c) for c in [*lists, "bannedDisqualified"]), F.lit(0))
    return doc.select(
        F.col("_id").alias("id"),
        F.col("abnStatus").alias("status"),
        F.col("entityTypeCode").alias("code"),
        F.col("gstRegistered").alias("gst"),
        F.col("isActive").alias("active"),
        F.col("abnStatusFromDate").alias("since"),
        big("ageYears").alias("age"),
        big(listed).alias("listed"),
        "flags.isIndividual",
        "flags.isDeregistered",
    )


@query("""
    SELECT rule, count(*) AS issues FROM (
        SELECT unnest([
            CASE WHEN k % 13 = 0 THEN 'required _version' END,
            CASE WHEN k % 17 = 0 THEN 'required entityTypeCode' END,
            CASE WHEN k % 7 = 0 THEN 'choice abnStatus' END,
            CASE WHEN k % 5 = 1 THEN 'choice acnType' END,
            CASE WHEN k % 4 = 0 THEN 'no null in businessNames' END,
            CASE WHEN k % 6 = 0 THEN 'required flags.isDgr' END,
            CASE WHEN k % 3 = 0 THEN 'required govSpend.totalValueAud' END,
            CASE WHEN k % 9 = 0 OR k % 10 = 0 THEN 'required registeredBusinessNames[].name' END,
            CASE WHEN k % 10 = 0 THEN 'no null in registeredBusinessNames' END
        ]) AS rule FROM (SELECT c_custkey AS k FROM customer))
    WHERE rule IS NOT NULL GROUP BY rule
""")
def contract_breaches(spark, d):
    """Documents broken on purpose, one way for each kind of rule."""
    doc = documents(spark, d).withColumn("k", F.col("_id").cast("bigint") - 51000000000)
    k = F.col("k")
    kinds = {f.name: f.dataType for f in doc.schema}
    null = F.lit(None)
    spend = F.struct(
        null.cast("decimal(38,2)").alias("totalValueAud"),
        F.lit(1).cast("bigint").alias("contractCount"),
        null.cast("string").alias("firstContractDate"),
        null.cast("string").alias("lastContractDate"),
    )
    nameless = F.array(
        F.struct(*[null.cast("string").alias(n) for n in kinds["registeredBusinessNames"].elementType.names])
    )
    own = F.col("registeredBusinessNames")
    nothing = F.array(null.cast(kinds["registeredBusinessNames"].elementType))
    broken = doc.withColumns(
        {
            "_version": F.when(k % 13 != 0, F.col("_version")),
            "entityTypeCode": F.when(k % 17 != 0, F.col("entityTypeCode")),
            "abnStatus": F.when(k % 7 == 0, "XXX").otherwise(F.col("abnStatus")),
            "acnType": F.when(k % 5 == 1, "ABC").otherwise(F.col("acnType")),
            "businessNames": F.when(
                k % 4 == 0, F.array_append("businessNames", null.cast("string"))
            ).otherwise(F.col("businessNames")),
            "flags": F.col("flags").withField(
                "isDgr", F.when(k % 6 != 0, F.col("flags.isDgr"))
            ),
            "govSpend": F.when(k % 3 == 0, spend).otherwise(F.col("govSpend")),
            "registeredBusinessNames": F.concat(
                own,
                F.when(k % 9 == 0, nameless).otherwise(F.slice(nameless, 1, 0)),
                F.when(k % 10 == 0, nothing).otherwise(F.slice(nothing, 1, 0)),
            ),
        }
    )
    rules = {n: c for n, c in contract_rules().items() if n != "checksum"}
    return rule_counts(check_documents(broken, "_id", rules))


@query("""
    SELECT 'checksum' AS rule, count(*) AS issues
    FROM (SELECT CAST(51000000000 + c_custkey AS VARCHAR) AS k FROM customer)
    WHERE (SELECT sum((CAST(substr(k, CAST(i AS INTEGER), 1) AS BIGINT)
                       - CASE WHEN i = 1 THEN 1 ELSE 0 END)
                      * CASE WHEN i = 1 THEN 10 ELSE 2 * i - 3 END)
           FROM range(1, 12) r(i)) % 89 <> 0
""")
def contract_issues(spark, d):
    """The full contract over all documents; most made-up keys fail their check digits."""
    issues = check_documents(documents(spark, d), "_id", contract_rules())
    return rule_counts(issues)


@query("""
    SELECT o_orderkey, coalesce(s = 'F', false) AS filled, coalesce(s = 'O', false) AS open,
           o_totalprice > 400000 OR coalesce(s = 'P', false) AS special
    FROM (SELECT *, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS s FROM orders)
""")
def derived_flags(spark, d):
    s = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderstatus"))
    orders = table(spark, d, "orders").withColumn("s", s)
    rules = {
        "filled": F.col("s") == "F",
        "open": F.col("s") == "O",
        "special": (F.col("o_totalprice") > 400000) | (F.col("s") == "P"),
    }
    return derive_flags(orders, rules).select("o_orderkey", "flags.*")


@query("""
    SELECT c_custkey, concat('{"key":', c_custkey, ',"name":',
           CASE WHEN c_custkey % 3 = 0 THEN 'null' ELSE concat('"', c_name, '"') END,
           ',"rich":', CASE WHEN c_acctbal > 5000 THEN 'true' ELSE 'false' END,
           ',"whole":', c_custkey, ',"tags":["', c_mktsegment, '"]}') AS line
    FROM customer
""")
def ndjson_lines(spark, d):
    key = F.col("c_custkey")
    doc = table(spark, d, "customer").select(
        key.alias("key"),
        F.when(key % 3 != 0, F.col("c_name")).alias("name"),
        (F.col("c_acctbal") > 5000).alias("rich"),
        key.cast("decimal(38,2)").alias("whole"),
        F.array("c_mktsegment").alias("tags"),
    )
    return doc.select(F.col("key").alias("c_custkey"), json_line(doc).alias("line"))
