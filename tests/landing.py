"""A small landing folder in the shapes of the published files. All entities are made up."""

from __future__ import annotations

import gzip
import json
from pathlib import Path

from entityfold.functions.keys import ABN_MODULUS, ABN_WEIGHTS
from queries.workbooks import encode_workbook


def abn(serial: int) -> str:
    """A valid 11-digit key ending in ``serial``: the two leading digits carry the check."""
    tail = f"{serial:09d}"
    for lead in range(10, 99):
        text = f"{lead}{tail}"
        total = sum(
            (int(d) - (i == 0)) * w for i, (d, w) in enumerate(zip(text, ABN_WEIGHTS, strict=True))
        )
        if total % ABN_MODULUS == 0:
            return text
    raise ValueError(serial)


SOLE, FIRM, TRUST, MATCH, CLASH, GONE, MONO, BARE = (abn(n) for n in range(401, 409))
SHARED_NUMBER = "004080199"


def record(key: str, *parts: str, status: str = "ACT", since: str = "20010615") -> str:
    return (
        f'<ABR recordLastUpdatedDate="20260601" replaced="N">'
        f'<ABN status="{status}" ABNStatusFromDate="{since}">{key}</ABN>{"".join(parts)}</ABR>\n'
    )


def kind(code: str, text: str) -> str:
    return (
        f"<EntityType><EntityTypeInd>{code}</EntityTypeInd>"
        f"<EntityTypeText>{text}</EntityTypeText></EntityType>"
    )


def address(state: str, postcode: str) -> str:
    return (
        f"<BusinessAddress><AddressDetails><State>{state}</State>"
        f"<Postcode>{postcode}</Postcode></AddressDetails></BusinessAddress>"
    )


def name(code: str, text: str) -> str:
    return (
        f'<NonIndividualName type="{code}"><NonIndividualNameText>{text}'
        "</NonIndividualNameText></NonIndividualName>"
    )


def document(*records: str) -> str:
    return (
        '<?xml version="1.0" encoding="UTF-8"?>\n<Transfer>\n<TransferInfo>'
        "<ExtractTime>2026-06-28T00:00:00</ExtractTime></TransferInfo>\n"
        + "".join(records)
        + "</Transfer>\n"
    )


PRIVATE = kind("PRV", "Australian Private Company")


def register_files(folder: Path) -> list[str]:
    first = document(
        record(
            SOLE,
            kind("IND", "Individual/Sole Trader"),
            "<LegalEntity><IndividualName type='LGL'><GivenName>ADA</GivenName>"
            "<GivenName>MAY</GivenName><FamilyName>QUILL</FamilyName></IndividualName>"
            + address("NSW", "2000")
            + "</LegalEntity>",
            since="20240229",
        ),
        record(
            FIRM,
            PRIVATE,
            "<MainEntity>" + name("MN", "TRD") + address("VIC", "3000") + "</MainEntity>",
            "<ASICNumber ASICNumberType='acn'>004000111</ASICNumber>",
            "<GST status='ACT' GSTStatusFromDate='20010701'/>",
            "<OtherEntity>" + name("BN", "Quill &amp; Sons") + "</OtherEntity>",
            "<OtherEntity>" + name("TRD", "IND") + "</OtherEntity>",
            "<OtherEntity>" + name("OTN", "  ") + "</OtherEntity>",
        ),
        record(
            TRUST,
            kind("DTT", "Discretionary Trust"),
            "<MainEntity>" + name("MN", "ÉMILE Ø TRUST") + address("", "") + "</MainEntity>",
            "<DGR DGRStatusFromDate='20110101'>" + name("DGR", "FUND A") + "</DGR>",
            "<DGR DGRStatusFromDate='20130601' status='ACT'>" + name("DGR", "FUND B") + "</DGR>",
        ),
    )
    second = document(
        record(
            MATCH,
            PRIVATE,
            "<MainEntity>" + name("MN", "MATCHED PTY LTD") + address("AAT", "7150"),
            "</MainEntity>",
            f"<ASICNumber ASICNumberType='undetermined'>{SHARED_NUMBER}</ASICNumber>",
            "<GST status='CAN' GSTStatusFromDate='20050101'/>",
        ),
        record(
            CLASH,
            kind("PUB", "Australian Public Company"),
            "<MainEntity>" + name("MN", "FOREIGN LTD") + address("qld", "4000") + "</MainEntity>",
            f"<ASICNumber ASICNumberType='ARBN'>{SHARED_NUMBER}</ASICNumber>",
        ),
        record(GONE, PRIVATE, status="CAN"),
        record(
            MONO,
            kind("IND", "Individual/Sole Trader"),
            "<LegalEntity><IndividualName type='LGL'><FamilyName>MONO</FamilyName>"
            "</IndividualName></LegalEntity>",
        ),
        record(BARE, since=""),
    )
    paths = []
    for at, text in enumerate([first, second]):
        path = folder / f"register{at}.xml"
        path.write_text(text, encoding="utf-8")
        paths.append(str(path))
    return paths


def _tab(header: str, *lines: str) -> str:
    return "\ufeff" + "\r\n".join([header, *lines]).replace("|", "\t") + "\r\n"


def _comma(*lines: str) -> str:
    return "\n".join(lines) + "\n"


def release(ocid: str | None, keys: list[str], amount, signed: str | None, role="supplier"):
    return {
        "ocid": ocid,
        "parties": [
            {"roles": [role], "additionalIdentifiers": [{"scheme": "AU-ABN", "id": k}]}
            for k in keys
        ],
        "contracts": [{"value": {"amount": amount}, "dateSigned": signed}],
    }


def side_files(folder: Path) -> dict[str, str]:
    texts = {
        "asic_company": _tab(
            "Company Name|ACN|Type|Class|Sub Class|Status|Date of Registration|"
            "Date of Deregistration|Previous State of Registration|State Registration number|"
            "Modified since last report|Current Name Indicator|ABN|Current Name|"
            "Current Name Start Date",
            f"QUILL PTY LTD|004000111|APTY|LMSH|PROP|REGD|15/06/2001|||||Y|{FIRM}||15/06/2001",
            f"QUILL TWO PTY LTD|004000111|APTY|LMSH|PROP|exad|15/06/2001|||||Y|{FIRM}||01/02/2010",
            f"OLD QUILL PTY LTD|004000111|APTY|LMSH|PROP|REGD|15/06/2001||||||{FIRM}||01/01/2020",
            f"GONE PTY LTD|004000222|APTY|LMSH|PROP|drgd|01/01/2019|01/05/2024||||Y|{GONE}||",
            f"FOREIGN LTD|004000333|APUB|LMPL||SOFF|01/01/1995||VIC|C99||Y|{CLASH}||",
            "NO KEY PTY LTD|004000444|APTY|LMSH|PROP|REGD|01/01/2020|||||Y|||",
        ),
        "asic_business_name": _tab(
            "REGISTER_NAME|BN_NAME|BN_STATUS|BN_REG_DT|BN_CANCEL_DT|BN_STATE_NUM|"
            "BN_STATE_OF_REG|BN_ABN",
            f"BUSINESS NAMES|ZED \"QUOTED\" CO|Registered|01/03/2017||B2|NSW|{FIRM}",
            f"BUSINESS NAMES|   ALPHA|Cancelled|01/02/2016|10/11/2019|B1|NSW|{FIRM}",
            f"BUSINESS NAMES|C:\\PATH|Registered|05/05/2020||B4|QLD|{SOLE}",
            f"BUSINESS NAMES| |Registered|05/05/2020||B5|QLD|{SOLE}",
            "BUSINESS NAMES|BAD KEY|Registered|01/01/2020||B9|NSW|123",
        ),
        "acnc_charity": _comma(
            "ABN,Charity_Legal_Name,Registration_Date,Charity_Size,PBI,HPC,"
            "Preventing_or_relieving_suffering_of_animals,Advancing_Culture,Advancing_Education,"
            "Advancing_Health,Promote_or_oppose_a_change_to_law__government_poll_or_prac,"
            "Advancing_natual_environment,Promoting_or_protecting_human_rights,"
            "Purposes_beneficial_to_ther_general_public_and_other_analogous,"
            "Promoting_reconciliation__mutual_respect_and_tolerance,Advancing_Religion,"
            "Advancing_social_or_public_welfare,"
            "Advancing_security_or_safety_of_Australia_or_Australian_public",
            f'{TRUST},"THE ÉMILE ""GIFT"" FUND, INC",01/06/2012,Medium,,,,Y,,Y,,,,,,,,',
            f"{SOLE},NO PURPOSE,,,,,,,,,,,,,,,,",
            "123,BAD KEY,01/06/2012,Small,,,,,,,,,,,,,,",
        ),
        "acnc_ais": _comma(
            "abn,fin report from,fin report to,total revenue,total expenses,total assets,"
            "total liabilities,total full time equivalent staff,staff - volunteers,notes",
            f'{TRUST},01/07/2022,30/06/2023,100,1e3,5.5,-7,12.5,45,"two\nlines"',
            f"{TRUST},01/07/2023,30/06/2024,1250000.75,900000,none,,12.5,45,",
        ),
        "asic_afs_licence": _comma(
            "AFS_LIC_ABN_ACN,AFS_LIC_NUM,AFS_LIC_NAME,AFS_LIC_START_DT,AFS_LIC_CONDITION",
            f'"{FIRM[:2]} {FIRM[2:5]} {FIRM[5:8]} {FIRM[8:]}",617001,QUILL,01/05/2003,',
            f"{SHARED_NUMBER},617002,MATCHED,01/05/2004,limited",
            f"{SHARED_NUMBER},240003,MATCHED OLD,01/05/2002,",
            "4000111,240009,SHORT,01/05/2004,",
        ),
        "asic_credit_licence": _comma(
            "CRED_LIC_ABN_ACN,CRED_LIC_NUM,CRED_LIC_NAME,CRED_LIC_STATUS,CRED_LIC_START_DT,"
            "CRED_LIC_END_DT",
            f"{SHARED_NUMBER},718001,MATCHED,APPR,01/05/2011,",
            f"{FIRM},,NO NUMBER,APPR,01/05/2011,",
        ),
        "asic_banned_disqualified": _tab(
            "BD_ORG_ACN|BD_ORG_NAME|BD_ORG_TYPE|BD_ORG_START_DT|BD_ORG_END_DT|BD_ORG_COMMENT",
            f"{SHARED_NUMBER}|MATCHED|AFS Banned|01/03/2015|Permanent banning|first",
            f"{SHARED_NUMBER}|MATCHED|Credit Banned|01/02/2014|01/02/2019|",
        ),
        "asic_afs_rep": _tab(
            "AFS_REP_ABN|AFS_REP_ACN|AFS_REP_NUM|AFS_LIC_NUM|AFS_REP_STATUS|AFS_REP_START_DT|"
            "AFS_REP_END_DT",
            f"{FIRM}|004000111|1617001|617001|Current|01/01/2010|",
            f"|{SHARED_NUMBER}|1617002|617001|Current|01/01/2011|",
        ),
        "asic_credit_rep": _comma(
            "CRED_REP_ABN_ACN,CRED_REP_NUM,CRED_LIC_NUM,CRED_REP_START_DT,CRED_REP_END_DT",
            f"{GONE},500001,718001,01/01/2012,31/12/2015",
        ),
        "wgea_reporter": _comma(
            "Primary ABN,Primary Organisation,ABN,Company Name",
            f"{FIRM},QUILL GROUP,{FIRM},QUILL PTY LTD",
            f"{FIRM},ALPHA GROUP,{FIRM},QUILL PTY LTD",
            f"12,QUILL GROUP,{CLASH},FOREIGN LTD",
        ),
        "asic_smsf_auditor": _tab(
            "SMSF_PERSON_ABN|SMSF_NUM|SMSF_STATUS|SMSF_REG_DT|SMSF_SUSP_START_DT|SMSF_SUSP_END_DT",
            f"{SOLE}|204417733|Registered|10/02/2016||",
            f"{SOLE}|204417733|Registered|09/03/2017||",
        ),
    }
    paths = {}
    for key, text in texts.items():
        path = folder / f"{key}.csv"
        path.write_bytes(text.encode("utf-8"))
        paths[key] = str(path)

    releases = [
        release("a", [FIRM, CLASH, FIRM], "1000.50", "2024-09-01T00:00:00Z"),
        {"releases": [release("b", [FIRM], 500, "2018-03-15T00:00:00Z")]},
        release("b", [FIRM], "9999", "2023-01-01T00:00:00Z"),
        release("c", [TRUST], "77", "2020-01-01", role="buyer"),
        release("d", [], "12", None),
    ]
    spend = folder / "gov_spend.jsonl.gz"
    lines = "\n".join(json.dumps(r) for r in releases) + "\n\n"
    spend.write_bytes(gzip.compress(lines.encode()))
    paths["gov_spend"] = str(spend)

    books = {
        "tax_transparency": [
            ("Information", [["Some words"], ["More words"]]),
            (
                "Income tax details",
                [
                    [
                        "Name",
                        "ABN",
                        "Total income $",
                        "Taxable income $",
                        "Tax payable $",
                        "Income year",
                    ],
                    ["QUILL", int(FIRM), 88120000, 0, -5, "2023-24"],
                    [None, None, " "],
                    ["FOREIGN", CLASH, "$500,000,000", 31250000, 9375000, "2023-24"],
                    ["NO TOTAL", int(SOLE), None, 1, 1, "2023-24"],
                ],
            ),
        ],
        "rd_tax_incentive": [
            (
                "2022-23 Report",
                [
                    ["Entities"],
                    [
                        "Company name",
                        "ABN/ACN",
                        "Total amended R&D expenditure $",
                        "Total R&D expenditure (x) $",
                        "Income Year",
                    ],
                    ["QUILL", int(FIRM), 1, 318204, "2022-23"],
                    ["MATCHED", int(SHARED_NUMBER), 1, 55310, "2022-23"],
                    ["SHORT", 12345, 1, 5, "2022-23"],
                ],
            )
        ],
        "gov_grants": [
            (
                "Grant Award Published",
                [
                    ["Grant Award Published"],
                    [],
                    ["Date Range", "3-Mar-2025 to 9-Mar-2025"],
                    ["GA ID", "Recipient Name", "Recipient ABN", "Publish Date", "Value (AUD)"],
                    ["GA1", "TRUST", f"{TRUST[:2]} {TRUST[2:]}", 46176, 21874.35],
                    ["GA2", "Somebody", "", "4-Jun-2026", 5000],
                    ["GA3", "TRUST", int(TRUST), "2026-06-05", "$1,000.00"],
                ],
            )
        ],
    }
    for key, sheets in books.items():
        path = folder / f"{key}.xlsx"
        path.write_bytes(encode_workbook(sheets))
        paths[key] = str(path)
    return paths
