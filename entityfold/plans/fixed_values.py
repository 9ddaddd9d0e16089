"""Fixed values of the business register and its side registers.

Everything here has to equal the published data or the output contract: codes, labels,
column names, floors, licences. They are stated as they are and hold no logic.
"""

from __future__ import annotations

# --- Codes ---

STATUS_ACTIVE = "ACT"
STATUS_CANCELLED = "CAN"
INDIVIDUAL = "IND"

# Kinds of secondary number that a document may state.
SECONDARY_TYPES = ("ACN", "ARBN", "ARSN", "ARFN")
# Kinds that share digits with company numbers without being company numbers.
FOREIGN_TYPES = ("ARBN", "ARSN", "ARFN")

COMPANY_STATUS_NAMES = {"REGD": "Registered", "DRGD": "Deregistered"}
STATUS_EXTERNAL_ADMINISTRATION = "EXAD"
STATUS_STRIKE_OFF = "SOFF"
STATUS_DEREGISTERED = "Deregistered"
CHARITY_STATUS = "Registered"

# Purpose flags of a charity in order of priority, and their labels.
CHARITY_SUBTYPES = [
    ("pbi", "Public Benevolent Institution"),
    ("hpc", "Health Promotion Charity"),
    ("advancing_health", "Advancing health"),
    ("advancing_education", "Advancing education"),
    ("advancing_social_or_public_welfare", "Advancing social or public welfare"),
    ("advancing_religion", "Advancing religion"),
    ("advancing_culture", "Advancing culture"),
    (
        "promoting_reconciliation_mutual_respect_and_tolerance",
        "Promoting reconciliation, mutual respect and tolerance",
    ),
    ("promoting_or_protecting_human_rights", "Promoting or protecting human rights"),
    (
        "advancing_security_or_safety_of_australia_or_australian_public",
        "Advancing the security or safety of Australia or the Australian public",
    ),
    (
        "preventing_or_relieving_suffering_of_animals",
        "Preventing or relieving the suffering of animals",
    ),
    ("advancing_natual_environment", "Advancing the natural environment"),
    (
        "promote_or_oppose_a_change_to_law_government_poll_or_prac",
        "Promoting or opposing a change to law, government policy or practice",
    ),
    (
        "purposes_beneficial_to_ther_general_public_and_other_analogous",
        "Purposes beneficial to the general public and other analogous purposes",
    ),
]

# --- Typed tables ---

ENDORSEMENTS = "array<struct<name:string,status:string,statusFromDate:date>>"

TABLES = {
    "abn": (
        "abn string, abn_status string, abn_status_from_date date, entity_type_code string, "
        "entity_type_text string, entity_name string, given_names string, family_name string, "
        "asic_number string, asic_number_type string, gst_status string, "
        "gst_status_from_date date, address_state string, address_postcode string, "
        "business_names array<string>, trading_names array<string>, other_names array<string>, "
        f"dgr {ENDORSEMENTS}, record_last_updated int"
    ),
    "asic_company": (
        "abn string, acn string, company_name string, current_name string, type string, "
        "class string, sub_class string, status string, registration_date date, "
        "deregistration_date date, previous_state string, state_registration_number string, "
        "current_name_start_date date"
    ),
    "asic_business_name": (
        "abn string, business_name string, status string, registration_date date, "
        "cancellation_date date, bn_number string, state string"
    ),
    "acnc_charity": (
        "abn string, charity_name string, status string, size string, subtype string, "
        "registration_date date"
    ),
    "acnc_ais": (
        "abn string, reporting_period_start date, reporting_period_end date, "
        "total_revenue decimal(38,6), total_expenses decimal(38,6), "
        "total_assets decimal(38,6), total_liabilities decimal(38,6), "
        "staff_full_time_equivalent decimal(38,6), volunteers bigint"
    ),
    "asic_afs_licence": (
        "abn string, acn string, licence_number string, name string, start_date date, "
        "conditions string"
    ),
    "asic_credit_licence": (
        "abn string, acn string, licence_number string, name string, status string, "
        "start_date date, end_date date"
    ),
    "asic_banned_disqualified": (
        "acn string, name string, type string, start_date date, end_date date, comment string"
    ),
    "gov_spend": (
        "abn string, total_value_aud decimal(38,2), contract_count bigint, "
        "first_contract_date date, last_contract_date date"
    ),
    "gov_grants": (
        "abn string, total_value_aud decimal(38,2), grant_count bigint, "
        "first_grant_date date, last_grant_date date"
    ),
    "tax_transparency": (
        "abn string, income_year string, total_income decimal(38,2), "
        "taxable_income decimal(38,2), tax_payable decimal(38,2)"
    ),
    "rd_tax_incentive": (
        "abn string, acn string, income_year string, total_rd_expenditure decimal(38,2)"
    ),
    "asic_afs_rep": (
        "abn string, acn string, rep_number string, licence_number string, status string, "
        "start_date date, end_date date"
    ),
    "asic_credit_rep": (
        "abn string, acn string, rep_number string, licence_number string, start_date date, "
        "end_date date"
    ),
    "wgea_reporter": "abn string, primary_abn string, primary_organisation string",
    "asic_smsf_auditor": (
        "abn string, auditor_number string, status string, registration_date date, "
        "suspension_start_date date, suspension_end_date date"
    ),
}

# --- Completeness floors ---

# Least typed rows of a healthy load.
ROW_FLOORS = {
    "asic_company": 1_000_000,
    "asic_business_name": 1_000_000,
    "acnc_charity": 20_000,
    "acnc_ais": 20_000,
    "asic_afs_licence": 1_000,
    "asic_credit_licence": 1_000,
    "asic_banned_disqualified": 5,
    "asic_afs_rep": 50_000,
    "asic_credit_rep": 5_000,
    "wgea_reporter": 5_000,
    "asic_smsf_auditor": 300,
    "gov_spend": 30_000,
    "gov_grants": 15_000,
    "tax_transparency": 2_000,
    "rd_tax_incentive": 5_000,
}

# Least documents that carry each part, in a full build.
COVERAGE_FLOORS = {
    "company": 1_000_000,
    "charity": 20_000,
    "charityFinancials": 20_000,
    "registeredBusinessNames": 1_000_000,
    "financialServicesLicence": 1_000,
    "creditLicence": 1_000,
    "bannedDisqualified": 5,
    "govSpend": 30_000,
    "govGrants": 15_000,
    "taxTransparency": 2_000,
    "rdTaxIncentive": 5_000,
    "afsAuthorisedRep": 40_000,
    "creditRep": 5_000,
    "wgeaReporter": 3_000,
    "smsfAuditor": 300,
}

# Rows at which a downloaded grant report is cut off.
GRANT_REPORT_CAP = 50_000

# --- Attribution ---

_AU3 = "CC-BY 3.0 AU"
_AU25 = "CC-BY 2.5 AU"
_ABR = "© Commonwealth of Australia (Australian Business Register)"
_ASIC = "© Australian Securities and Investments Commission"
_ACNC = "© Australian Charities and Not-for-profits Commission"
_TENDERS = "© Commonwealth of Australia (Department of Finance / AusTender)"
_GRANTS = "© Commonwealth of Australia (Department of Finance / GrantConnect)"
_ATO = "© Commonwealth of Australia (Australian Taxation Office)"
_WGEA = "© Commonwealth of Australia (Workplace Gender Equality Agency)"

# Published datasets that documents derive from: table, name, licence, attribution.
ATTRIBUTIONS = [
    ("abn", "ABR ABN Bulk Extract", _AU3, _ABR),
    ("asic_company", "ASIC Company Dataset", _AU3, _ASIC),
    ("asic_business_name", "ASIC Business Names Dataset", _AU3, _ASIC),
    ("asic_afs_licence", "ASIC AFS Licensees", _AU3, _ASIC),
    ("asic_credit_licence", "ASIC Credit Licensees", _AU3, _ASIC),
    ("asic_banned_disqualified", "ASIC Banned & Disqualified Organisations", _AU3, _ASIC),
    ("acnc_charity", "ACNC Registered Charities", _AU3, _ACNC),
    ("acnc_ais", "ACNC Annual Information Statement", _AU3, _ACNC),
    ("gov_spend", "AusTender Contract Notices (OCDS)", _AU3, _TENDERS),
    ("gov_grants", "GrantConnect Grant Awards", _AU3, _GRANTS),
    ("tax_transparency", "ATO Corporate Tax Transparency", _AU3, _ATO),
    ("rd_tax_incentive", "ATO R&D Tax Incentive", _AU25, _ATO),
    ("asic_afs_rep", "ASIC AFS Authorised Representatives", _AU3, _ASIC),
    ("asic_credit_rep", "ASIC Credit Representatives", _AU3, _ASIC),
    ("wgea_reporter", "WGEA Reporting Organisations", _AU3, _WGEA),
    ("asic_smsf_auditor", "ASIC SMSF Auditors", _AU3, _ASIC),
]
