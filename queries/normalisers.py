"""Raw register tables, derived from the test tables, through every delimited normaliser.

The raw columns carry what the published files carry: padding, blanks, junk keys, free
text in date columns, keys with spaces, and rows that must be left out.
"""

from pyspark.sql import functions as F

from entityfold.plans import normalise
from entityfold.plans.fixed_values import CHARITY_SUBTYPES
from queries.registry import big, query, table

# The raw rows in Spark SQL; text of the same name in the queries below.
_KEY = "cast(51000000000 + o_custkey as string)"
_DAY = "date_format(o_orderdate, 'dd/MM/yyyy')"


@query("""
    SELECT CAST(51000000000 + o_custkey AS VARCHAR) AS abn, CAST(o_orderkey AS VARCHAR) AS acn,
           o_orderpriority AS company_name,
           CASE o_orderstatus WHEN 'F' THEN 'Registered' WHEN 'O' THEN 'Deregistered'
                ELSE 'SOFF' END AS status,
           CAST(o_orderdate AS DATE) AS registration_date,
           CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) END
               AS current_name_start_date,
           CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS current_name, 'APTY' AS type,
           o_orderstatus AS class, CAST(NULL AS VARCHAR) AS sub_class,
           CASE WHEN o_orderkey % 9 = 0 THEN CAST(o_orderdate AS DATE) END AS deregistration_date,
           CASE WHEN o_orderkey % 11 = 0 THEN 'VIC' END AS previous_state,
           CASE WHEN o_orderkey % 11 = 0 THEN CAST(o_custkey AS VARCHAR) END
               AS state_registration_number
    FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0
""")
def normalise_company(spark, d):
    raw = table(spark, d, "orders").selectExpr(
        f"if(o_orderkey % 5 = 0, concat(' ', {_KEY}), {_KEY}) as abn",
        "concat(' ', o_orderkey) as acn",
        "if(o_orderkey % 7 = 0, '  ', concat(' ', o_orderpriority, ' ')) as company_name",
        "if(o_orderkey % 2 = 0, concat(o_orderpriority, '  '), ' ') as current_name",
        "' APTY' as type",
        "o_orderstatus as class",
        "'' as sub_class",
        "case o_orderstatus when 'F' then ' regd' when 'O' then 'DRGD' else 'SOFF' end as status",
        f"{_DAY} as date_of_registration",
        f"if(o_orderkey % 9 = 0, {_DAY}, ' ') as date_of_deregistration",
        "if(o_orderkey % 11 = 0, 'VIC ', null) as previous_state_of_registration",
        "if(o_orderkey % 11 = 0, cast(o_custkey as string), '') as state_registration_number",
        f"if(o_orderkey % 3 = 0, {_DAY}, '') as current_name_start_date",
        "if(o_orderkey % 4 = 0, '', 'Y') as current_name_indicator",
    )
    return normalise.company(raw)


@query("""
    SELECT CAST(51000000000 + o_custkey AS VARCHAR) AS abn, o_orderpriority AS business_name,
           CAST(o_orderdate AS DATE) AS registration_date,
           CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) END AS cancellation_date,
           o_orderstatus AS status, concat('B', o_custkey) AS bn_number,
           CASE WHEN o_orderkey % 2 = 0 THEN 'NSW' END AS state
    FROM orders WHERE o_orderkey % 5 <> 0
""")
def normalise_business_name(spark, d):
    raw = table(spark, d, "orders").selectExpr(
        f"if(o_orderkey % 5 = 0, '123', {_KEY}) as bn_abn",
        "concat('    ', o_orderpriority) as bn_name",
        "o_orderstatus as bn_status",
        f"concat(' ', {_DAY}) as bn_reg_dt",
        f"if(o_orderkey % 3 = 0, {_DAY}, '  ') as bn_cancel_dt",
        "concat('B', o_custkey, ' ') as bn_state_num",
        "if(o_orderkey % 2 = 0, 'NSW', '') as bn_state_of_reg",
    )
    return normalise.business_name(raw)


@query("""
    SELECT CAST(51000000000 + c_custkey AS VARCHAR) AS abn, c_name AS charity_name,
           'Registered' AS status,
           CASE WHEN c_custkey % 4 = 0 THEN 'Public Benevolent Institution'
                WHEN c_custkey % 3 = 0 THEN 'Advancing health'
                WHEN c_custkey % 5 = 0 THEN 'Advancing the natural environment' END AS subtype,
           CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS size,
           CASE WHEN c_custkey % 7 = 0 THEN DATE '2012-06-01' END AS registration_date
    FROM customer WHERE c_custkey % 11 <> 0
""")
def normalise_charity(spark, d):
    yes = {
        "pbi": "if(c_custkey % 4 = 0, 'Y', 'N')",
        "advancing_health": "if(c_custkey % 3 = 0, 'Y', '')",
        "advancing_natual_environment": "if(c_custkey % 5 = 0, 'Y', null)",
        "advancing_religion": "'y'",
    }
    raw = table(spark, d, "customer").selectExpr(
        "cast(51000000000 + c_custkey as string) as abn",
        "if(c_custkey % 11 = 0, ' ', c_name) as charity_legal_name",
        "if(c_custkey % 2 = 0, c_mktsegment, ' ') as charity_size",
        "if(c_custkey % 7 = 0, '01/06/2012', null) as registration_date",
        *[f"{yes.get(flag, 'null')} as {flag}" for flag, _ in CHARITY_SUBTYPES],
    )
    return normalise.charity(raw)


@query("""
    SELECT CAST(51000000000 + o_custkey AS VARCHAR) AS abn,
           CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) END AS period_end,
           CASE WHEN o_orderkey % 4 <> 0 THEN CAST(round(o_totalprice * 100) AS BIGINT) END
               AS revenue_cents,
           CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END AS volunteers,
           CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) END AS period_start,
           CASE WHEN o_orderkey % 7 = 0 THEN -100 * o_custkey END AS expenses_cents,
           CAST(NULL AS BIGINT) AS assets_cents, CAST(NULL AS BIGINT) AS liabilities_cents,
           CAST(1250 AS BIGINT) AS staff_hundredths
    FROM orders
""")
def normalise_ais(spark, d):
    price = "cast(cast(o_totalprice as decimal(18,2)) as string)"
    raw = table(spark, d, "orders").selectExpr(
        f"{_KEY} as abn",
        f"if(o_orderkey % 2 = 0, {_DAY}, 'unknown') as fin_report_from",
        f"if(o_orderkey % 3 = 0, 'n/a', {_DAY}) as fin_report_to",
        f"if(o_orderkey % 4 = 0, '1e5', concat(' ', {price})) as total_revenue",
        "if(o_orderkey % 7 = 0, concat('-', o_custkey), '') as total_expenses",
        "'-' as total_assets",
        "null as total_liabilities",
        "'12.5' as total_full_time_equivalent_staff",
        "if(o_orderkey % 5 = 0, '1.5', cast(o_orderkey as string)) as staff_volunteers",
    )
    return normalise.ais(raw).select(
        "abn",
        F.col("reporting_period_start").alias("period_start"),
        F.col("reporting_period_end").alias("period_end"),
        big(F.col("total_revenue") * 100).alias("revenue_cents"),
        big(F.col("total_expenses") * 100).alias("expenses_cents"),
        big(F.col("total_assets") * 100).alias("assets_cents"),
        big(F.col("total_liabilities") * 100).alias("liabilities_cents"),
        big(F.col("staff_full_time_equivalent") * 100).alias("staff_hundredths"),
        "volunteers",
    )


_MIXED_SQL = """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0
                            THEN CAST(51000000000 + o_custkey AS VARCHAR) END AS abn,
           CASE WHEN o_orderkey % 3 = 1 THEN lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS acn,
           CAST(o_orderkey AS VARCHAR) AS number,
           CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) END AS start_date,
           o_orderpriority AS name, o_orderstatus AS status,
           CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS note,
           CAST(o_custkey AS VARCHAR) AS licence
    FROM orders WHERE o_orderkey % 3 <> 2
"""
_MIXED = (
    "case o_orderkey % 3 when 0 then concat('51 ', lpad(o_custkey, 9, '0')) "
    "when 1 then concat('ACN ', lpad(o_custkey, 9, '0')) else cast(o_custkey as string) end"
)
_MAYBE_DAY = f"if(o_orderkey % 4 = 0, 'Permanent', {_DAY})"


@query(f"""
    SELECT abn, acn, number AS licence_number, name, start_date, note AS conditions
    FROM ({_MIXED_SQL}) WHERE o_orderkey % 10 <> 0
""")
def normalise_afs_licence(spark, d):
    raw = table(spark, d, "orders").selectExpr(
        f"{_MIXED} as afs_lic_abn_acn",
        "if(o_orderkey % 10 = 0, ' ', cast(o_orderkey as string)) as afs_lic_num",
        "o_orderpriority as afs_lic_name",
        f"{_MAYBE_DAY} as afs_lic_start_dt",
        "if(o_orderkey % 2 = 0, o_orderpriority, ' ') as afs_lic_condition",
    )
    return normalise.afs_licence(raw)


@query(f"""
    SELECT abn, acn, number AS licence_number, name, status, start_date, start_date AS end_date
    FROM ({_MIXED_SQL}) WHERE o_orderkey % 10 <> 0
""")
def normalise_credit_licence(spark, d):
    raw = table(spark, d, "orders").selectExpr(
        f"{_MIXED} as cred_lic_abn_acn",
        "if(o_orderkey % 10 = 0, ' ', cast(o_orderkey as string)) as cred_lic_num",
        "o_orderpriority as cred_lic_name",
        "concat(o_orderstatus, ' ') as cred_lic_status",
        f"{_MAYBE_DAY} as cred_lic_start_dt",
        f"concat(' ', {_MAYBE_DAY}) as cred_lic_end_dt",
    )
    return normalise.credit_licence(raw)


@query(f"""
    SELECT abn, acn, CASE WHEN o_orderkey % 10 <> 0 THEN number END AS rep_number,
           licence AS licence_number, start_date, CAST(NULL AS DATE) AS end_date
    FROM ({_MIXED_SQL})
""")
def normalise_credit_rep(spark, d):
    """A representative may have no number; the contract check finds it later."""
    raw = table(spark, d, "orders").selectExpr(
        f"{_MIXED} as cred_rep_abn_acn",
        "if(o_orderkey % 10 = 0, ' ', cast(o_orderkey as string)) as cred_rep_num",
        "concat(o_custkey, ' ') as cred_lic_num",
        f"{_MAYBE_DAY} as cred_rep_start_dt",
        "'' as cred_rep_end_dt",
    )
    return normalise.credit_rep(raw)


@query("""
    SELECT CASE WHEN o_orderkey % 3 <> 0 THEN CAST(51000000000 + o_custkey AS VARCHAR) END AS abn,
           CASE WHEN o_orderkey % 2 <> 0 THEN lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS acn,
           CAST(o_orderkey AS VARCHAR) AS rep_number,
           CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) END AS licence_number,
           o_orderstatus AS status,
           CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) END AS start_date,
           CAST(o_orderdate AS DATE) AS end_date
    FROM orders WHERE o_orderkey % 6 <> 0
""")
def normalise_afs_rep(spark, d):
    """Two key columns: a row may fill both, and is left out when neither is a key."""
    raw = table(spark, d, "orders").selectExpr(
        f"if(o_orderkey % 3 = 0, 'none', {_KEY}) as afs_rep_abn",
        "if(o_orderkey % 2 = 0, '', lpad(o_custkey, 9, '0')) as afs_rep_acn",
        "cast(o_orderkey as string) as afs_rep_num",
        "if(o_orderkey % 2 = 0, cast(o_custkey as string), '') as afs_lic_num",
        "concat(' ', o_orderstatus) as afs_rep_status",
        f"{_MAYBE_DAY} as afs_rep_start_dt",
        f"{_DAY} as afs_rep_end_dt",
    )
    return normalise.afs_rep(raw)


@query("""
    SELECT lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS acn, o_orderpriority AS type,
           CAST(o_orderdate AS DATE) AS start_date,
           CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) END AS end_date,
           o_orderpriority AS name, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS comment
    FROM orders WHERE o_orderkey % 3 <> 0
""")
def normalise_banned(spark, d):
    raw = table(spark, d, "orders").selectExpr(
        "if(o_orderkey % 3 = 0, '12', lpad(o_custkey, 9, '0')) as bd_org_acn",
        "concat(' ', o_orderpriority) as bd_org_name",
        "o_orderpriority as bd_org_type",
        f"{_DAY} as bd_org_start_dt",
        f"{_MAYBE_DAY} as bd_org_end_dt",
        "if(o_orderkey % 2 = 0, o_orderstatus, '') as bd_org_comment",
    )
    return normalise.banned(raw)


@query("""
    SELECT CAST(51000000000 + o_custkey AS VARCHAR) AS abn,
           min(concat(o_orderpriority, '#', lpad(CAST(o_orderkey AS VARCHAR), 9, '0')))
               AS primary_organisation, '51000000000' AS primary_abn
    FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY o_custkey
""")
def normalise_wgea(spark, d):
    raw = table(spark, d, "orders").selectExpr(
        f"if(o_orderkey % 3 = 0, '12', {_KEY}) as abn",
        "'51 000 000 000' as primary_abn",
        "concat(o_orderpriority, '#', lpad(o_orderkey, 9, '0')) as primary_organisation",
    )
    return normalise.wgea(raw)


@query("""
    SELECT abn, auditor_number, registration_date, status, CAST(NULL AS DATE) AS
           suspension_start_date, registration_date AS suspension_end_date FROM (
        SELECT DISTINCT ON (abn) abn, number AS auditor_number, d AS registration_date,
               o_orderstatus AS status
        FROM (SELECT o_orderstatus, CAST(51000000000 + o_custkey AS VARCHAR) AS abn,
                     lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS number,
                     CAST(o_orderdate AS DATE) AS d, strftime(o_orderdate, '%d/%m/%Y') AS t
              FROM orders)
        ORDER BY abn, t, number)
""")
def normalise_smsf_auditor(spark, d):
    """Chosen by the text of the date, day first, not by the day it means."""
    raw = table(spark, d, "orders").selectExpr(
        f"{_KEY} as smsf_person_abn",
        "lpad(o_orderkey, 9, '0') as smsf_num",
        "o_orderstatus as smsf_status",
        f"{_DAY} as smsf_reg_dt",
        "'' as smsf_susp_start_dt",
        f"{_DAY} as smsf_susp_end_dt",
    )
    return normalise.smsf_auditor(raw)
