"""Raw text tables to typed tables, one function per source.

Each takes the reader's DataFrame (all text, safe column names) and keeps the rows that
can be joined and that the output contract allows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityfold.functions import (
    cents_to_money,
    clean_number,
    digits,
    expand_code,
    first_true_label,
    guarded_date,
    guarded_integer,
    guarded_number,
    has_digits,
    positive_or_null,
    routed,
    routed_padded,
    strict_date,
    stripped,
    trimmed,
)
from entityfold.operators import awards_by_recipient, latest_per_key, spend_by_supplier
from entityfold.operators.aggregate import distinct_releases, extract_releases
from entityfold.plans import fixed_values as fixed
from entityfold.sources.ocds import POSITION
from entityfold.sources.workbook import cell_at, has_any, table_rows


def _abn(c: str) -> Column:
    return has_digits(F.col(c), 11)


def _named(raw: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return raw.select(*[c.alias(n) for n, c in columns.items()])


def _text(c: str) -> Column:
    return trimmed(F.col(c))


def _day(c: str) -> Column:
    return guarded_date(F.col(c))


def company(raw: DataFrame) -> DataFrame:
    keep = (
        (F.col("current_name_indicator") == "Y")
        & _abn("abn")
        & _text("company_name").isNotNull()
        & _text("status").isNotNull()
    )
    return _named(
        raw.where(keep),
        {
            "abn": F.col("abn"),
            "acn": _text("acn"),
            "company_name": _text("company_name"),
            "current_name": _text("current_name"),
            "type": _text("type"),
            "class": _text("class"),
            "sub_class": _text("sub_class"),
            "status": expand_code(F.col("status"), fixed.COMPANY_STATUS_NAMES),
            "registration_date": strict_date(F.col("date_of_registration")),
            "deregistration_date": strict_date(F.col("date_of_deregistration")),
            "previous_state": _text("previous_state_of_registration"),
            "state_registration_number": _text("state_registration_number"),
            "current_name_start_date": strict_date(F.col("current_name_start_date")),
        },
    )


def business_name(raw: DataFrame) -> DataFrame:
    return _named(
        raw.where(_abn("bn_abn") & _text("bn_name").isNotNull()),
        {
            "abn": F.col("bn_abn"),
            "business_name": _text("bn_name"),
            "status": _text("bn_status"),
            "registration_date": strict_date(F.col("bn_reg_dt")),
            "cancellation_date": strict_date(F.col("bn_cancel_dt")),
            "bn_number": _text("bn_state_num"),
            "state": _text("bn_state_of_reg"),
        },
    )


def charity(raw: DataFrame) -> DataFrame:
    return _named(
        raw.where(_abn("abn") & _text("charity_legal_name").isNotNull()),
        {
            "abn": F.col("abn"),
            "charity_name": _text("charity_legal_name"),
            "status": F.lit(fixed.CHARITY_STATUS),
            "size": _text("charity_size"),
            "subtype": first_true_label([(F.col(c), n) for c, n in fixed.CHARITY_SUBTYPES]),
            "registration_date": strict_date(F.col("registration_date")),
        },
    )


def ais(raw: DataFrame) -> DataFrame:
    return _named(
        raw.where(_abn("abn")),
        {
            "abn": F.col("abn"),
            "reporting_period_start": _day("fin_report_from"),
            "reporting_period_end": _day("fin_report_to"),
            "total_revenue": guarded_number(F.col("total_revenue")),
            "total_expenses": guarded_number(F.col("total_expenses")),
            "total_assets": guarded_number(F.col("total_assets")),
            "total_liabilities": guarded_number(F.col("total_liabilities")),
            "staff_full_time_equivalent": guarded_number(
                F.col("total_full_time_equivalent_staff")
            ),
            "volunteers": guarded_integer(F.col("staff_volunteers")),
        },
    )


def afs_licence(raw: DataFrame) -> DataFrame:
    abn, acn = routed(F.col("afs_lic_abn_acn"))
    return _named(
        raw.where(F.coalesce(abn, acn).isNotNull() & _text("afs_lic_num").isNotNull()),
        {
            "abn": abn,
            "acn": acn,
            "licence_number": _text("afs_lic_num"),
            "name": _text("afs_lic_name"),
            "start_date": _day("afs_lic_start_dt"),
            "conditions": _text("afs_lic_condition"),
        },
    )


def credit_licence(raw: DataFrame) -> DataFrame:
    abn, acn = routed(F.col("cred_lic_abn_acn"))
    return _named(
        raw.where(F.coalesce(abn, acn).isNotNull() & _text("cred_lic_num").isNotNull()),
        {
            "abn": abn,
            "acn": acn,
            "licence_number": _text("cred_lic_num"),
            "name": _text("cred_lic_name"),
            "status": _text("cred_lic_status"),
            "start_date": _day("cred_lic_start_dt"),
            "end_date": _day("cred_lic_end_dt"),
        },
    )


def afs_rep(raw: DataFrame) -> DataFrame:
    abn, _ = routed(F.col("afs_rep_abn"))
    _, acn = routed(F.col("afs_rep_acn"))
    return _named(
        raw.where(F.coalesce(abn, acn).isNotNull()),
        {
            "abn": abn,
            "acn": acn,
            "rep_number": _text("afs_rep_num"),
            "licence_number": _text("afs_lic_num"),
            "status": _text("afs_rep_status"),
            "start_date": _day("afs_rep_start_dt"),
            "end_date": _day("afs_rep_end_dt"),
        },
    )


def credit_rep(raw: DataFrame) -> DataFrame:
    abn, acn = routed(F.col("cred_rep_abn_acn"))
    return _named(
        raw.where(F.coalesce(abn, acn).isNotNull()),
        {
            "abn": abn,
            "acn": acn,
            "rep_number": _text("cred_rep_num"),
            "licence_number": _text("cred_lic_num"),
            "start_date": _day("cred_rep_start_dt"),
            "end_date": _day("cred_rep_end_dt"),
        },
    )


def banned(raw: DataFrame) -> DataFrame:
    _, acn = routed(F.col("bd_org_acn"))
    return _named(
        raw.where(acn.isNotNull()),
        {
            "acn": acn,
            "name": _text("bd_org_name"),
            "type": _text("bd_org_type"),
            "start_date": _day("bd_org_start_dt"),
            "end_date": _day("bd_org_end_dt"),
            "comment": _text("bd_org_comment"),
        },
    )


def wgea(raw: DataFrame) -> DataFrame:
    own, _ = routed(F.col("abn"))
    group, _ = routed(F.col("primary_abn"))
    typed = raw.select(
        own.alias("abn"),
        group.alias("primary_abn"),
        _text("primary_organisation").alias("primary_organisation"),
        F.col("primary_organisation").alias("raw_order"),
    )
    order = [F.col("raw_order").asc_nulls_last()]
    return latest_per_key(typed, "abn", order).drop("raw_order")


def smsf_auditor(raw: DataFrame) -> DataFrame:
    abn, _ = routed(F.col("smsf_person_abn"))
    typed = raw.select(
        abn.alias("abn"),
        _text("smsf_num").alias("auditor_number"),
        _text("smsf_status").alias("status"),
        _day("smsf_reg_dt").alias("registration_date"),
        _day("smsf_susp_start_dt").alias("suspension_start_date"),
        _day("smsf_susp_end_dt").alias("suspension_end_date"),
        F.col("smsf_reg_dt").alias("raw_order"),
    )
    # By the text of the date, day first, as the register's own rows are told apart.
    order = [F.col("raw_order").asc_nulls_last()]
    return latest_per_key(typed, "abn", order).drop("raw_order")


def _table(grid: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """The wanted cells of a workbook's table, each looked up once per row."""
    return _named(table_rows(grid, has_any(["abn", "abn/acn"]), 10), columns)


def tax_transparency(grid: DataFrame) -> DataFrame:
    cells = _table(
        grid,
        {
            "abn": digits(cell_at("abn")),
            "year": cell_at("income year"),
            "total": clean_number(cell_at("total income $", ["total income"])),
            "taxable": clean_number(cell_at("taxable income $", ["taxable income"])),
            "payable": clean_number(cell_at("tax payable $", ["tax payable"])),
        },
    )
    money = "decimal(38,2)"
    return _named(
        cells.where(_abn("abn") & F.col("total").isNotNull()),
        {
            "abn": F.col("abn"),
            "income_year": stripped(F.col("year")),
            "total_income": F.col("total").cast(money),
            "taxable_income": positive_or_null(F.col("taxable")).cast(money),
            "tax_payable": positive_or_null(F.col("payable")).cast(money),
        },
    )


def rd_tax_incentive(grid: DataFrame) -> DataFrame:
    cells = _table(
        grid,
        {
            "key": cell_at("abn/acn", ["abn"]),
            "year": cell_at("income year"),
            "spent": cell_at(None, ["total r&d expenditure"], excluding=["amended"]),
        },
    )
    abn, acn = routed_padded(F.col("key"))
    return _named(
        cells.where(F.coalesce(abn, acn).isNotNull()),
        {
            "abn": abn,
            "acn": acn,
            "income_year": stripped(F.col("year")),
            "total_rd_expenditure": clean_number(F.col("spent")).cast("decimal(38,2)"),
        },
    )


def gov_spend(releases: DataFrame) -> DataFrame:
    distinct = distinct_releases(extract_releases(releases, POSITION), POSITION)
    return _named(
        spend_by_supplier(distinct),
        {
            "abn": F.col("supplier"),
            "total_value_aud": cents_to_money(F.col("cents")),
            "contract_count": F.col("releases"),
            "first_contract_date": F.col("first_signed").cast("date"),
            "last_contract_date": F.col("last_signed").cast("date"),
        },
    )


def gov_grants(awards: DataFrame) -> DataFrame:
    return _named(
        awards_by_recipient(awards),
        {
            "abn": F.col("recipient"),
            "total_value_aud": cents_to_money(F.col("cents")),
            "grant_count": F.col("awards"),
            "first_grant_date": F.col("first_published"),
            "last_grant_date": F.col("last_published"),
        },
    )


@dataclass(frozen=True)
class SourceSpec:
    """A side register: how its files look, which file to take, how its rows become typed."""

    key: str
    form: str  # "quoted", "literal", "workbook", "releases" or "grants"
    match: str  # lower-case part of the name of its file
    pick: str  # "largest", "latest-year", "latest-income-year" or "all"
    normalise: Callable[[DataFrame], DataFrame]

    @property
    def floor(self) -> int:
        return fixed.ROW_FLOORS[self.key]

    @property
    def suffix(self) -> str:
        """How the names of its files end."""
        endings = {"workbook": ".xlsx", "grants": ".xlsx", "releases": ".jsonl.gz"}
        return endings.get(self.form, ".csv")


SOURCES = [
    SourceSpec("asic_company", "literal", "company", "largest", company),
    SourceSpec("asic_business_name", "literal", "business_names", "largest", business_name),
    SourceSpec("acnc_charity", "quoted", "datadotgov_main", "largest", charity),
    SourceSpec("acnc_ais", "quoted", "datadotgov_ais24", "largest", ais),
    SourceSpec("asic_afs_licence", "quoted", "current", "largest", afs_licence),
    SourceSpec("asic_credit_licence", "quoted", "current", "largest", credit_licence),
    SourceSpec("asic_banned_disqualified", "literal", "current", "largest", banned),
    SourceSpec("asic_afs_rep", "literal", "afs_rep", "largest", afs_rep),
    SourceSpec("asic_credit_rep", "quoted", "credit_rep", "largest", credit_rep),
    SourceSpec(
        "wgea_reporter", "quoted", "included_organisations_per_abn", "latest-year", wgea
    ),
    SourceSpec("asic_smsf_auditor", "literal", "smsf_auditor", "largest", smsf_auditor),
    SourceSpec(
        "tax_transparency",
        "workbook",
        "report of entity tax information",
        "latest-income-year",
        tax_transparency,
    ),
    SourceSpec(
        "rd_tax_incentive",
        "workbook",
        "research and development",
        "latest-income-year",
        rd_tax_incentive,
    ),
    SourceSpec("gov_spend", "releases", "", "largest", gov_spend),
    SourceSpec("gov_grants", "grants", "", "all", gov_grants),
]
