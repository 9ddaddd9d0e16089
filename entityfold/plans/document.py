"""One nested document per entity."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityfold.functions import age_years, compact_iso, iso, joined, stripped
from entityfold.operators import (
    bridge_secondary,
    join_shared,
    latest_per_key,
    nest_many,
    nest_one,
    shared_lists,
)
from entityfold.operators.nest import collect_ordered
from entityfold.plans import fixed_values as fixed

# Fields of the nested objects, as (name in the document, column).
COMPANY = [
    ("acn", "acn"),
    ("name", "company_name"),
    ("currentName", "current_name"),
    ("type", "type"),
    ("class", "class"),
    ("subClass", "sub_class"),
    ("status", "status"),
    ("registrationDate", "registration_date"),
    ("deregistrationDate", "deregistration_date"),
    ("previousState", "previous_state"),
    ("stateRegistrationNumber", "state_registration_number"),
]
REGISTERED_NAME = [
    ("name", "business_name"),
    ("status", "status"),
    ("registrationDate", "registration_date"),
    ("cancellationDate", "cancellation_date"),
]
FINANCIALS = [
    ("reportingPeriodStart", "reporting_period_start"),
    ("reportingPeriodEnd", "reporting_period_end"),
    ("totalRevenue", "total_revenue"),
    ("totalExpenses", "total_expenses"),
    ("totalAssets", "total_assets"),
    ("totalLiabilities", "total_liabilities"),
    ("staffFullTimeEquivalent", "staff_full_time_equivalent"),
    ("volunteers", "volunteers"),
]
CHARITY = [
    ("name", "charity_name"),
    ("status", "status"),
    ("size", "size"),
    ("subtype", "subtype"),
    ("registrationDate", "registration_date"),
]
AFS_LICENCE = [
    ("number", "licence_number"),
    ("name", "name"),
    ("startDate", "start_date"),
    ("conditions", "conditions"),
]
CREDIT_LICENCE = [
    ("number", "licence_number"),
    ("name", "name"),
    ("status", "status"),
    ("startDate", "start_date"),
    ("endDate", "end_date"),
]
BANNED = [
    ("type", "type"),
    ("startDate", "start_date"),
    ("endDate", "end_date"),
    ("comment", "comment"),
]
GOV_SPEND = [
    ("totalValueAud", "total_value_aud"),
    ("contractCount", "contract_count"),
    ("firstContractDate", "first_contract_date"),
    ("lastContractDate", "last_contract_date"),
]
GOV_GRANTS = [
    ("totalValueAud", "total_value_aud"),
    ("grantCount", "grant_count"),
    ("firstGrantDate", "first_grant_date"),
    ("lastGrantDate", "last_grant_date"),
]
TAX = [
    ("incomeYear", "income_year"),
    ("totalIncome", "total_income"),
    ("taxableIncome", "taxable_income"),
    ("taxPayable", "tax_payable"),
]
RD = [("incomeYear", "income_year"), ("totalRdExpenditure", "total_rd_expenditure")]
AFS_REP = [
    ("number", "rep_number"),
    ("licenceNumber", "licence_number"),
    ("status", "status"),
    ("startDate", "start_date"),
    ("endDate", "end_date"),
]
CREDIT_REP = [
    ("number", "rep_number"),
    ("licenceNumber", "licence_number"),
    ("startDate", "start_date"),
    ("endDate", "end_date"),
]
WGEA = [("primaryAbn", "primary_abn"), ("primaryOrganisation", "primary_organisation")]
SMSF = [
    ("number", "auditor_number"),
    ("status", "status"),
    ("registrationDate", "registration_date"),
    ("suspensionStartDate", "suspension_start_date"),
    ("suspensionEndDate", "suspension_end_date"),
]


def version_date(version: str) -> date:
    """The day of a version written YYYY.MM.DD; anything else is an error."""
    found = re.sub("[^0-9]", "", version)
    if not re.fullmatch("[0-9]{8}", found):
        raise ValueError(f"version {version!r} is not YYYY.MM.DD")
    return date(int(found[:4]), int(found[4:6]), int(found[6:]))


def _fields(side: DataFrame, spec: list[tuple[str, str]]) -> dict[str, Column]:
    """The fields of an object; dates as ISO text."""
    kinds = dict(side.dtypes)
    return {n: iso(F.col(c)) if kinds[c] == "date" else F.col(c) for n, c in spec}


def _down(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_last() for n in names]


def _up(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def _charities(dims: Mapping[str, DataFrame]) -> DataFrame:
    """One row per charity with its newest filed statement as an object, null without one."""
    ais = latest_per_key(dims["acnc_ais"], "abn", _down("reporting_period_end"))
    charity = latest_per_key(
        dims["acnc_charity"], "abn", _down("registration_date") + _up("charity_name")
    )
    return nest_one(charity, ais, "abn", "financials", _fields(ais, FINANCIALS))


def _with_own_sides(base: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Sides keyed by the primary key only. They all join on it, so the base moves once."""
    one_row = [
        (
            "company",
            "asic_company",
            COMPANY,
            _down("current_name_start_date") + _up("company_name"),
        ),
        ("govSpend", "gov_spend", GOV_SPEND, _down("total_value_aud")),
        ("govGrants", "gov_grants", GOV_GRANTS, _down("total_value_aud")),
        ("taxTransparency", "tax_transparency", TAX, _down("income_year")),
        ("wgeaReporter", "wgea_reporter", WGEA, _up("primary_organisation")),
        ("smsfAuditor", "asic_smsf_auditor", SMSF, _up("registration_date")),
    ]
    out = base
    for name, table, spec, order in one_row:
        side = latest_per_key(dims[table], "abn", order)
        out = nest_one(out, side, "abn", name, _fields(side, spec))

    charity = _charities(dims)
    charity_fields = _fields(charity, CHARITY) | {"financials": F.col("financials")}
    out = nest_one(out, charity, "abn", "charity", charity_fields)

    names = dims["asic_business_name"]
    return nest_many(
        out,
        names,
        "abn",
        "registeredBusinessNames",
        _fields(names, REGISTERED_NAME),
        ["business_name", "registration_date", "status", "cancellation_date"],
    )


def _with_two_path_sides(
    out: DataFrame, base: DataFrame, dims: Mapping[str, DataFrame]
) -> DataFrame:
    """Sides keyed by the primary or by the secondary key, and the actions keyed by the latter.

    The whole object comes from the primary path when there is one. All secondary matches
    are brought to the primary key together, through a narrow scan of the base of its own
    (id and number only), and join ``out``, the base with its other sides, once. Where many
    entities share long lists of actions, a reference to the list comes this way, and ``out``
    moves to the lists.
    """
    by_start = _down("start_date")
    sides = [
        (
            "financialServicesLicence",
            "asic_afs_licence",
            AFS_LICENCE,
            by_start + _up("licence_number"),
        ),
        ("creditLicence", "asic_credit_licence", CREDIT_LICENCE, by_start + _up("licence_number")),
        ("rdTaxIncentive", "rd_tax_incentive", RD, _down("income_year")),
        ("afsAuthorisedRep", "asic_afs_rep", AFS_REP, by_start + _up("rep_number")),
        ("creditRep", "asic_credit_rep", CREDIT_REP, by_start + _up("rep_number")),
    ]
    by_number: dict[str, DataFrame] = {}
    for name, table, spec, order in sides:
        side = dims[table]
        value = F.struct(*[c.alias(n) for n, c in _fields(side, spec).items()])
        direct = latest_per_key(side.drop("acn"), "abn", order)
        out = out.join(direct.select("abn", value.alias(f"{name}_direct")), "abn", "left")
        other = latest_per_key(side.drop("abn"), "acn", order)
        by_number[f"{name}_other"] = other.select(
            F.col("acn").alias("asic_number"), value.alias(f"{name}_other")
        )

    actions = dims["asic_banned_disqualified"].withColumnRenamed("acn", "asic_number")
    lists = collect_ordered(
        actions,
        "asic_number",
        "actions",
        _fields(actions, BANNED),
        ["start_date", "type", "end_date", "comment"],
    )

    # The published register leaves most numbers untyped, so the guard excludes the
    # known other kinds rather than asking for company numbers. It looks at the exact case.
    guard = ~F.coalesce("asic_number_type", F.lit("")).isin(*fixed.FOREIGN_TYPES)
    shared = shared_lists(base, "asic_number", guard, actions)
    if shared is None:
        by_number["actions"] = lists
    else:
        by_number["shared"] = shared
    bridge = bridge_secondary(base, "abn", "asic_number", guard, by_number)
    out = out.join(bridge, "abn", "left")
    if shared is not None:
        out = join_shared(out, "abn", lists, "asic_number", shared)
    no_actions = F.array().cast(lists.schema["actions"].dataType)
    return out.withColumns(
        {n: F.coalesce(f"{n}_direct", f"{n}_other") for n, *_ in sides}
        | {"bannedDisqualified": F.coalesce("actions", no_actions)}
    )


def flag_rules() -> dict[str, Column]:
    """The derived flags of a document, each a condition on its other fields."""

    def present(name: str) -> Column:
        return F.col(name).isNotNull()

    def some(name: str) -> Column:
        return F.size(name) > 0

    status = F.col("company.status")
    return {
        "isIndividual": F.col("entityTypeCode") == fixed.INDIVIDUAL,
        "isCompany": present("company"),
        "isCharity": present("charity"),
        "isLicensed": present("financialServicesLicence") | present("creditLicence"),
        "hasEnforcementAction": some("bannedDisqualified"),
        "isDgr": some("dgr"),
        "hasGovContracts": present("govSpend"),
        "receivesGovGrants": present("govGrants"),
        "isLargeCorporateTaxpayer": present("taxTransparency"),
        "claimsRdTaxIncentive": present("rdTaxIncentive"),
        "isAfsAuthorisedRep": present("afsAuthorisedRep"),
        "isCreditRep": present("creditRep"),
        "isWgeaReporter": present("wgeaReporter"),
        "isSmsfAuditor": present("smsfAuditor"),
        "isExternalAdministration": status == fixed.STATUS_EXTERNAL_ADMINISTRATION,
        "isStrikeOffInProgress": status == fixed.STATUS_STRIKE_OFF,
        "isDeregistered": status == fixed.STATUS_DEREGISTERED,
    }


def derive_flags(doc: DataFrame, rules: Mapping[str, Column], name: str = "flags") -> DataFrame:
    """Add one object of booleans; a condition that is null counts as false."""
    flags = [F.coalesce(c, F.lit(False)).alias(n) for n, c in rules.items()]
    return doc.withColumn(name, F.struct(*flags))


# Fields of a document in their order.
DOCUMENT_FIELDS = [
    "_id",
    "_version",
    "abnStatus",
    "abnStatusFromDate",
    "entityName",
    "entityTypeCode",
    "entityTypeText",
    "givenName",
    "familyName",
    "acn",
    "acnType",
    "gstRegistered",
    "gstStatusFromDate",
    "recordLastUpdated",
    "state",
    "postcode",
    "businessNames",
    "tradingNames",
    "otherNames",
    "dgr",
    "registeredBusinessNames",
    "company",
    "charity",
    "financialServicesLicence",
    "creditLicence",
    "bannedDisqualified",
    "govSpend",
    "govGrants",
    "taxTransparency",
    "rdTaxIncentive",
    "afsAuthorisedRep",
    "creditRep",
    "wgeaReporter",
    "smsfAuditor",
    "ageYears",
    "isActive",
    "flags",
]


def _own_fields(version: str) -> dict[str, Column]:
    """The fields that come from the base row alone."""
    cancelled = F.coalesce(F.col("abn_status") == fixed.STATUS_CANCELLED, F.lit(False))
    number_type = F.upper("asic_number_type")
    no_text = F.array().cast("array<string>")
    no_dgr = F.array().cast("array<struct<name:string,statusFromDate:string>>")
    endorsements = F.transform(
        "dgr",
        lambda d: F.struct(d["name"].alias("name"), iso(d["statusFromDate"]).alias("statusFromDate")),
    )
    return {
        "_id": F.col("abn"),
        "_version": F.lit(version),
        "abnStatus": F.when(cancelled, fixed.STATUS_CANCELLED).otherwise(fixed.STATUS_ACTIVE),
        "abnStatusFromDate": iso(F.col("abn_status_from_date")),
        "entityName": F.coalesce("entity_name", joined(F.col("given_names"), F.col("family_name"))),
        "entityTypeCode": F.coalesce("entity_type_code", F.lit("")),
        "entityTypeText": F.col("entity_type_text"),
        "givenName": F.col("given_names"),
        "familyName": F.col("family_name"),
        "acn": F.col("asic_number"),
        "acnType": F.when(number_type.isin(*fixed.SECONDARY_TYPES), number_type),
        "gstRegistered": F.coalesce(F.col("gst_status") == fixed.STATUS_ACTIVE, F.lit(False)),
        "gstStatusFromDate": iso(F.col("gst_status_from_date")),
        "recordLastUpdated": compact_iso(F.col("record_last_updated")),
        "state": stripped(F.col("address_state")),
        "postcode": stripped(F.col("address_postcode")),
        "businessNames": F.coalesce("business_names", no_text),
        "tradingNames": F.coalesce("trading_names", no_text),
        "otherNames": F.coalesce("other_names", no_text),
        "dgr": F.coalesce(endorsements, no_dgr),
        "ageYears": age_years(F.col("abn_status_from_date"), version_date(version)),
        "isActive": ~cancelled,
    }


def build_documents(base: DataFrame, dims: Mapping[str, DataFrame], version: str) -> DataFrame:
    """One document per base row, fields in contract order; rows come in no set order.

    The base is shuffled at most once, on its key; every side is one row per key before
    it joins. Sides small enough are broadcast by Spark on their measured size.
    """
    own = _own_fields(version)
    out = _with_two_path_sides(_with_own_sides(base, dims), base, dims)
    sides = [f for f in DOCUMENT_FIELDS if f not in own and f != "flags"]
    doc = out.select(*[c.alias(n) for n, c in own.items()], *sides)
    return derive_flags(doc, flag_rules()).select(*DOCUMENT_FIELDS)
