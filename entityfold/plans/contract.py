"""The output contract as rules, and the coverage counters of a document."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityfold.functions import abn_valid
from entityfold.plans import fixed_values as fixed
from entityfold.plans.document import flag_rules

# Fields that are never null, at the top and inside the objects.
REQUIRED = [
    "_id",
    "_version",
    "abnStatus",
    "entityTypeCode",
    "gstRegistered",
    "businessNames",
    "tradingNames",
    "otherNames",
    "dgr",
    "registeredBusinessNames",
    "bannedDisqualified",
    "isActive",
    "flags",
]
REQUIRED_IN_OBJECTS = {
    "company": ["name", "status"],
    "charity": ["name", "status"],
    "financialServicesLicence": ["number"],
    "creditLicence": ["number"],
    "govSpend": ["totalValueAud", "contractCount"],
    "govGrants": ["totalValueAud", "grantCount"],
    "taxTransparency": ["incomeYear", "totalIncome"],
    "rdTaxIncentive": ["incomeYear"],
    "afsAuthorisedRep": ["number"],
    "creditRep": ["number"],
    "smsfAuditor": ["number"],
}
REQUIRED_IN_LISTS = {"registeredBusinessNames": ["name"]}
TEXT_LISTS = ["businessNames", "tradingNames", "otherNames"]
OBJECT_LISTS = ["dgr", "registeredBusinessNames", "bannedDisqualified"]
CHOICES = {
    "abnStatus": (fixed.STATUS_ACTIVE, fixed.STATUS_CANCELLED),
    "acnType": fixed.SECONDARY_TYPES,
}


def _has(field: str):
    return lambda item: item[field].isNotNull()


def contract_rules() -> dict[str, Column]:
    """Rule name to condition. A document meets the contract when it meets every rule."""
    rules = {f"required {f}": F.col(f).isNotNull() for f in REQUIRED}
    for name, values in CHOICES.items():
        rules[f"choice {name}"] = F.col(name).isNull() | F.col(name).isin(*values)
    for name, fields in REQUIRED_IN_OBJECTS.items():
        for f in fields:
            rules[f"required {name}.{f}"] = F.col(name).isNull() | F.col(f"{name}.{f}").isNotNull()
    for name, fields in REQUIRED_IN_LISTS.items():
        for f in fields:
            rules[f"required {name}[].{f}"] = F.forall(name, _has(f))
    for name in TEXT_LISTS + OBJECT_LISTS:
        rules[f"no null in {name}"] = F.forall(name, lambda x: x.isNotNull())
    for f in flag_rules():
        rules[f"required flags.{f}"] = F.col(f"flags.{f}").isNotNull()
    rules["checksum"] = abn_valid(F.col("_id"))
    return rules


def coverage_counters() -> dict[str, Column]:
    """Counter name to condition: the gated parts of a document, then two for information."""

    def present(name: str) -> Column:
        return F.col(name).isNotNull()

    def some(name: str) -> Column:
        return F.size(name) > 0

    return {
        "company": present("company"),
        "charity": present("charity"),
        "charityFinancials": present("charity.financials"),
        "registeredBusinessNames": some("registeredBusinessNames"),
        "financialServicesLicence": present("financialServicesLicence"),
        "creditLicence": present("creditLicence"),
        "bannedDisqualified": some("bannedDisqualified"),
        "govSpend": present("govSpend"),
        "govGrants": present("govGrants"),
        "taxTransparency": present("taxTransparency"),
        "rdTaxIncentive": present("rdTaxIncentive"),
        "afsAuthorisedRep": present("afsAuthorisedRep"),
        "creditRep": present("creditRep"),
        "wgeaReporter": present("wgeaReporter"),
        "smsfAuditor": present("smsfAuditor"),
        "businessNames": some("businessNames"),
        "dgr": some("dgr"),
    }


def coverage_floors(profile: str) -> dict[str, int] | None:
    """The floors of a profile: ``production``, ``fixture`` (one document each) or ``off``."""
    match profile.lower():
        case "production":
            return dict(fixed.COVERAGE_FLOORS)
        case "fixture":
            return {name: 1 for name in fixed.COVERAGE_FLOORS}
        case "off":
            return None
    raise ValueError(f"coverage profile {profile!r}: production, fixture or off")
