"""Files to documents, end to end, with made-up entities for every case that matters."""

import gzip
import hashlib
import json
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from entityfold.operators import GateError, bucket_counts
from entityfold.plans import build
from entityfold.plans import fixed_values as fixed
from entityfold.plans.build import (
    LoadReport,
    build_release,
    choose_files,
    compare_releases,
    load_base,
    load_sources,
    read_dims,
    released,
    verify,
)
from entityfold.plans.contract import coverage_counters, coverage_floors
from entityfold.plans.document import DOCUMENT_FIELDS, build_documents
from entityfold.plans.normalise import SOURCES
from entityfold.sinks import (
    build_manifest,
    json_line,
    merge_shards,
    shard_order_breaks,
    slices,
    store,
    write_awards,
    write_bundle,
    write_comparison,
    write_shards,
)
from entityfold.sinks.buckets import buckets_kept, read_table
from queries.documents import documents as documents_of
from tests import landing
from tests.landing import BARE, CLASH, FIRM, GONE, MATCH, MONO, SOLE, TRUST

VERSION = "2026.06.28"

# The output contract. A change here is a change for every reader of the documents.
DOCUMENT_SCHEMA = """
    _id string,
    _version string,
    abnStatus string,
    abnStatusFromDate string,
    entityName string,
    entityTypeCode string,
    entityTypeText string,
    givenName string,
    familyName string,
    acn string,
    acnType string,
    gstRegistered boolean,
    gstStatusFromDate string,
    recordLastUpdated string,
    state string,
    postcode string,
    businessNames array<string>,
    tradingNames array<string>,
    otherNames array<string>,
    dgr array<struct<name:string,statusFromDate:string>>,
    registeredBusinessNames array<struct<
        name:string, status:string, registrationDate:string, cancellationDate:string>>,
    company struct<
        acn:string, name:string, currentName:string, type:string, class:string,
        subClass:string, status:string, registrationDate:string, deregistrationDate:string,
        previousState:string, stateRegistrationNumber:string>,
    charity struct<
        name:string, status:string, size:string, subtype:string, registrationDate:string,
        financials:struct<reportingPeriodStart:string, reportingPeriodEnd:string,
        totalRevenue:decimal(38, 6), totalExpenses:decimal(38, 6), totalAssets:decimal(38,
        6), totalLiabilities:decimal(38, 6), staffFullTimeEquivalent:decimal(38, 6),
        volunteers:bigint>>,
    financialServicesLicence struct<
        number:string, name:string, startDate:string, conditions:string>,
    creditLicence struct<
        number:string, name:string, status:string, startDate:string, endDate:string>,
    bannedDisqualified array<struct<
        type:string, startDate:string, endDate:string, comment:string>>,
    govSpend struct<
        totalValueAud:decimal(38, 2), contractCount:bigint, firstContractDate:string,
        lastContractDate:string>,
    govGrants struct<
        totalValueAud:decimal(38, 2), grantCount:bigint, firstGrantDate:string,
        lastGrantDate:string>,
    taxTransparency struct<
        incomeYear:string, totalIncome:decimal(38, 2), taxableIncome:decimal(38, 2),
        taxPayable:decimal(38, 2)>,
    rdTaxIncentive struct<incomeYear:string,totalRdExpenditure:decimal(38,2)>,
    afsAuthorisedRep struct<
        number:string, licenceNumber:string, status:string, startDate:string, endDate:string>,
    creditRep struct<number:string,licenceNumber:string,startDate:string,endDate:string>,
    wgeaReporter struct<primaryAbn:string,primaryOrganisation:string>,
    smsfAuditor struct<
        number:string, status:string, registrationDate:string, suspensionStartDate:string,
        suspensionEndDate:string>,
    ageYears int,
    isActive boolean,
    flags struct<
        isIndividual:boolean, isCompany:boolean, isCharity:boolean, isLicensed:boolean,
        hasEnforcementAction:boolean, isDgr:boolean, hasGovContracts:boolean,
        receivesGovGrants:boolean, isLargeCorporateTaxpayer:boolean,
        claimsRdTaxIncentive:boolean, isAfsAuthorisedRep:boolean, isCreditRep:boolean,
        isWgeaReporter:boolean, isSmsfAuditor:boolean, isExternalAdministration:boolean,
        isStrikeOffInProgress:boolean, isDeregistered:boolean>
"""


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    tables = str(tmp_path_factory.mktemp("tables"))
    out = str(tmp_path_factory.mktemp("out") / "release")
    load_base(spark, landing.register_files(folder), tables, VERSION)
    paths = landing.side_files(folder)
    report = load_sources(spark, SOURCES, paths, tables, VERSION, floors={})
    assert report.failures == {}
    prior = spark.createDataFrame([("nsw", 1), ("tas", 2)], "bucket string, n bigint")
    counts = build_release(
        spark, tables, VERSION, out, profile="fixture", shards=3, report=report,
        extracted={"abn": "2026-06-24"}, prior=prior,
    )
    docs = spark.read.parquet(f"{tables}/version=20260628/documents")
    return {"tables": tables, "out": out, "counts": counts, "docs": docs, "report": report}


@pytest.fixture(scope="module")
def docs(built):
    lines = built["docs"].select(json_line(built["docs"]).alias("v")).collect()
    found = [json.loads(r["v"]) for r in lines]
    return {d["_id"]: d for d in found}


def test_every_entity_once_in_contract_order(docs):
    assert sorted(docs) == sorted([SOLE, FIRM, TRUST, MATCH, CLASH, GONE, MONO, BARE])
    assert all(list(d) == DOCUMENT_FIELDS for d in docs.values())
    assert all(d["_version"] == VERSION for d in docs.values())


def test_individual(docs):
    d = docs[SOLE]
    assert (d["entityName"], d["givenName"], d["familyName"]) == (
        "ADA MAY QUILL",
        "ADA MAY",
        "QUILL",
    )
    assert d["ageYears"] == 2 and d["abnStatusFromDate"] == "2024-02-29"
    assert d["flags"]["isIndividual"] and d["flags"]["isSmsfAuditor"]
    # two rows of one auditor: the smaller date text, day first, is kept
    assert d["smsfAuditor"]["registrationDate"] == "2017-03-09"
    assert d["registeredBusinessNames"] == [
        {
            "name": "C:\\PATH",
            "status": "Registered",
            "registrationDate": "2020-05-05",
            "cancellationDate": None,
        }
    ]
    assert docs[MONO]["entityName"] == "MONO" and docs[MONO]["givenName"] is None


def test_company(docs):
    d = docs[FIRM]
    assert d["entityName"] == "TRD"  # a name that looks like a type code stays a name
    assert (d["businessNames"], d["tradingNames"], d["otherNames"]) == (
        ["Quill & Sons"],
        ["IND"],
        [],
    )
    assert d["acn"] == "004000111" and d["acnType"] == "ACN"
    assert d["company"]["name"] == "QUILL TWO PTY LTD" and d["company"]["status"] == "exad"
    assert not d["flags"]["isExternalAdministration"]  # exact code only
    assert [n["name"] for n in d["registeredBusinessNames"]] == ["ALPHA", 'ZED "QUOTED" CO']
    assert d["financialServicesLicence"]["number"] == "617001"
    assert d["creditLicence"] is None
    assert d["govSpend"] == {
        "totalValueAud": 1500.5,
        "contractCount": 2,
        "firstContractDate": "2018-03-15",
        "lastContractDate": "2024-09-01",
    }
    assert d["taxTransparency"] == {
        "incomeYear": "2023-24",
        "totalIncome": 88120000,
        "taxableIncome": None,
        "taxPayable": None,
    }
    assert d["rdTaxIncentive"] == {"incomeYear": "2022-23", "totalRdExpenditure": 318204}
    assert d["wgeaReporter"] == {"primaryAbn": FIRM, "primaryOrganisation": "ALPHA GROUP"}
    assert d["afsAuthorisedRep"]["number"] == "1617001"
    assert d["recordLastUpdated"] == "2026-06-01" and d["gstRegistered"]


def test_charity(docs):
    d = docs[TRUST]
    assert d["entityName"] == "ÉMILE Ø TRUST"
    assert d["state"] is None and d["postcode"] is None
    assert d["dgr"] == [
        {"name": "FUND A", "statusFromDate": "2011-01-01"},
        {"name": "FUND B", "statusFromDate": "2013-06-01"},
    ]
    assert d["charity"] == {
        "name": 'THE ÉMILE "GIFT" FUND, INC',
        "status": "Registered",
        "size": "Medium",
        "subtype": "Advancing health",
        "registrationDate": "2012-06-01",
        "financials": {
            "reportingPeriodStart": "2023-07-01",
            "reportingPeriodEnd": "2024-06-30",
            "totalRevenue": 1250000.75,
            "totalExpenses": 900000,
            "totalAssets": None,
            "totalLiabilities": None,
            "staffFullTimeEquivalent": 12.5,
            "volunteers": 45,
        },
    }
    assert docs[SOLE]["charity"]["financials"] is None and docs[SOLE]["charity"]["subtype"] is None
    assert d["govGrants"] == {
        "totalValueAud": 22874.35,
        "grantCount": 2,
        "firstGrantDate": "2026-06-03",
        "lastGrantDate": "2026-06-05",
    }


def test_secondary_key_matches_untyped_and_skips_other_types(docs):
    d = docs[MATCH]
    assert d["acnType"] is None
    assert d["financialServicesLicence"]["number"] == "617002"  # latest start date
    assert d["creditLicence"]["number"] == "718001"
    assert d["rdTaxIncentive"]["totalRdExpenditure"] == 55310
    assert d["afsAuthorisedRep"]["number"] == "1617002"
    assert d["bannedDisqualified"] == [
        {
            "type": "Credit Banned",
            "startDate": "2014-02-01",
            "endDate": "2019-02-01",
            "comment": None,
        },
        {"type": "AFS Banned", "startDate": "2015-03-01", "endDate": None, "comment": "first"},
    ]
    assert d["flags"]["hasEnforcementAction"] and not d["gstRegistered"]

    clash = docs[CLASH]
    assert clash["acn"] == d["acn"] and clash["acnType"] == "ARBN"
    assert clash["financialServicesLicence"] is None and clash["creditLicence"] is None
    assert clash["bannedDisqualified"] == [] and clash["rdTaxIncentive"] is None
    assert clash["company"]["status"] == "SOFF" and clash["flags"]["isStrikeOffInProgress"]
    assert clash["govSpend"]["totalValueAud"] == 1000.5
    assert clash["wgeaReporter"]["primaryAbn"] is None


def test_cancelled_and_bare(docs):
    gone, bare = docs[GONE], docs[BARE]
    assert gone["abnStatus"] == "CAN" and not gone["isActive"]
    assert gone["flags"]["isDeregistered"]
    assert gone["creditRep"]["endDate"] == "2015-12-31"
    assert bare["entityTypeCode"] == "" and bare["entityName"] is None
    assert bare["abnStatusFromDate"] is None and bare["ageYears"] is None
    assert not any(bare["flags"].values())


def test_shards_manifest_and_metadata(spark, built):
    counts = {r["bucket"]: r["n"] for r in built["counts"].collect()}
    assert counts == {"nsw": 1, "vic": 1, "aat": 1, "qld": 1, "other": 4}
    merged = merge_shards(spark, f"{built['out']}/shards").collect()
    assert [r["_id"] for r in merged] == sorted(r["_id"] for r in merged) and len(merged) == 8
    files = spark.read.json(f"{built['out']}/metadata/files").collect()
    assert sum(r["records"] for r in files if not r["aggregate"]) == 8
    assert sum(r["records"] for r in files if r["aggregate"]) == 8
    bundle = spark.read.text(f"{built['out']}/bundle").collect()
    assert len(bundle) == 8
    awards = spark.read.json(f"{built['out']}/awards").collect()
    assert [(r["abn"], r["totalValueCents"]) for r in awards] == [(TRUST, "2287435")]
    compared = spark.read.json(f"{built['out']}/comparison/json").collect()
    assert {r["bucket"]: r["status"] for r in compared}["tas"] == "retired"
    assert all(len(r["sha256"]) == 64 and r["bytes"] > 0 for r in files)
    sources = spark.read.json(f"{built['out']}/metadata/sources")
    assert sources.where("attribution is null or licence is null").isEmpty()
    assert sources.count() == 16
    assert [r["source"] for r in sources.where("extracted = '2026-06-24'").collect()] == ["abn"]


def test_shards_are_sorted_slices(spark, tmp_path):
    ids = spark.range(5000).select(
        F.lpad((F.col("id") * 7919 % 5003).cast("string"), 6, "0").alias("_id"),
        F.when(F.col("id") % 3 == 0, "NSW").when(F.col("id") % 50 == 1, "VIC").alias("state"),
    )
    path = str(tmp_path / "shards")
    write_shards(ids, path, "state", shards=9, max_records=400)
    files = sorted(Path(path).glob("bucket=*/*.gz"))
    held = {}
    for file in files:
        lines = gzip.decompress(file.read_bytes()).decode().splitlines()
        found = [json.loads(line)["_id"] for line in lines]
        assert found == sorted(found) and len(found) <= 400
        held.setdefault(file.parent.name, []).append((found[0], found[-1], len(found)))
    assert {b: sum(n for *_, n in parts) for b, parts in held.items()} == {
        f"bucket={r['bucket']}": r["n"] for r in bucket_counts(ids, "state").collect()
    }
    for parts in held.values():
        ordered = sorted(parts)
        assert all(a[1] < b[0] for a, b in zip(ordered, ordered[1:], strict=False))

    manifest = build_manifest(spark, path, bucket_counts(ids, "state"))
    both = write_bundle(spark, path, str(tmp_path / "all"), manifest, max_records=1000).collect()
    bundle = [r for r in both if r["aggregate"]]
    assert sum(r["records"] for r in bundle) == 5000 and len(bundle) >= 5
    one = next(r for r in bundle if r["records"])
    content = (tmp_path / "all" / one["shard"]).read_bytes()
    assert one["sha256"] == hashlib.sha256(content).hexdigest() and one["bytes"] == len(content)

    assert shard_order_breaks(spark, path).isEmpty()
    broken = files[0].read_bytes()
    lines = gzip.decompress(broken).splitlines(keepends=True)
    lines[3], lines[4] = lines[4], lines[3]
    files[0].write_bytes(gzip.compress(b"".join(lines)))
    (files[0].parent / f".{files[0].name}.crc").unlink()
    breaks = shard_order_breaks(spark, path).collect()
    assert [b["id"] for b in breaks] == [json.loads(lines[4])["_id"]]

    with pytest.raises(GateError, match="counts differ"):
        build_manifest(spark, path, bucket_counts(ids.where("_id <> '000007'"), "state"))
    with pytest.raises(GateError, match="no shards"):
        (tmp_path / "empty").mkdir()
        build_manifest(spark, str(tmp_path / "empty"), bucket_counts(ids, "state"))


@pytest.mark.parametrize("block", [None, "20000"])
def test_files_are_cut_by_bytes_without_a_shuffle(spark, tmp_path, block):
    text = F.repeat(F.lit("é"), F.when(F.col("id") % 1000 == 7, 3000).otherwise(F.col("id") % 40).cast("int"))
    docs = spark.range(4000).select(
        F.lpad((F.col("id") * 7919 % 5003).cast("string"), 6, "0").alias("_id"),
        F.when(F.col("id") % 3 == 0, "NSW").when(F.col("id") % 50 == 1, "VIC").alias("state"),
        text.alias("text"),
    )
    lines, shards, out = (str(tmp_path / n) for n in ("lines", "shards", "all"))
    if block:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("parquet.block.size", "20000")
    try:
        slices.write_ordered_lines(docs, lines, "state", ranges=3)
        for made in (slices.line_shards, slices.line_bundle):
            plan = made(slices.sliced_lines(spark, lines))._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan
        slices.write_line_shards(spark, lines, shards, max_bytes=5000)
        manifest = build_manifest(spark, shards, bucket_counts(docs, "state"))
        both = slices.write_line_bundle(spark, lines, out, manifest, max_bytes=5000).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("parquet.block.size")
    ids = sorted(r["_id"] for r in docs.collect())
    for folder, aggregate, groups in ((shards, False, "bucket=*/"), (out, True, "")):
        listed = {r["shard"]: r for r in both if r["aggregate"] == aggregate}
        held = {}
        for file in sorted(Path(folder).glob(f"{groups}part=*/*.gz")):
            content = file.read_bytes()
            text = gzip.decompress(content)
            found = [json.loads(line)["_id"] for line in text.decode().splitlines()]
            assert len(text) <= 5000 or len(found) == 1
            row = listed.pop(str(file.relative_to(folder)))
            assert (row["records"], row["bytes"], row["sha256"]) == (len(found), len(content), hashlib.sha256(content).hexdigest())
            held.setdefault(file.parts[-3] if groups else "", []).extend(found)
        assert not listed
        assert all(f == sorted(f) for f in held.values())  # in the order of the files' names
        assert sorted(i for f in held.values() for i in f) == ids
    assert shard_order_breaks(spark, shards).isEmpty()


def test_files_are_chosen_per_source(spark, tmp_path):
    names = {
        "asic_company": {"company_202606.csv": 9, "company_dictionary.csv": 2, "x.csv": 50},
        "wgea_reporter": {
            "2020 list included_organisations_per_abn.csv": 90,
            "2022 list included_organisations_per_abn.csv": 5,
        },
        "tax_transparency": {
            "2022-23 Report of entity tax information.xlsx": 9,
            "2023-24 Report of Entity Tax Information.xlsx": 1,
            "2024-25 Report of entity tax information.pdf": 1,
        },
        "gov_grants": {"2024.xlsx": 1, "2025.xlsx": 1},
    }
    for source, files in names.items():
        (tmp_path / source).mkdir()
        for name, size in files.items():
            (tmp_path / source / name).write_text("x" * size)
    chosen = choose_files(spark, str(tmp_path), SOURCES)
    assert {k: v.split("/")[-1] for k, v in chosen.items()} == {
        "asic_company": "company_202606.csv",
        "wgea_reporter": "2022 list included_organisations_per_abn.csv",
        "tax_transparency": "2023-24 Report of Entity Tax Information.xlsx",
        "gov_grants": "gov_grants",
    }
    specs = [s for s in SOURCES if s.key == "acnc_ais"]
    report = load_sources(spark, specs, chosen, str(tmp_path / "t"), VERSION)
    assert report.failures == {"acnc_ais": "GateError: no file for this source"}


def test_reports(spark, rows, tmp_path):
    awards = rows([("b", 5, 1, None, None), ("a", 35051, 2, "2020-01-15", "2022-05-01")],
                  "recipient string, cents long, awards long, first_published string, "
                  "last_published string")  # fmt: skip
    write_awards(awards, str(tmp_path / "awards"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "awards")).collect()]
    assert sorted(lines)[0] == (
        '{"abn":"a","totalValueCents":"35051","grantCount":2,'
        '"firstPublishDate":"2020-01-15","lastPublishDate":"2022-05-01"}'
    )
    shape = "bucket string, n long"
    report, odd = compare_releases(rows([("nsw", 11)], shape), rows([("nsw", 10)], shape), 0.25)
    assert not odd
    write_comparison(report, str(tmp_path / "cmp"))
    text = {r["value"] for r in spark.read.text(str(tmp_path / "cmp/markdown")).collect()}
    assert "| nsw | 10 | 11 | +10.0% | ok |" in text and len(text) == 4


def test_the_base_is_shuffled_once_without_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        documents = documents_of(spark, "/root/testdata/sf0.001")
        plan = documents._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    wide = [line for line in plan.splitlines() if "FileScan" in line and "c_acctbal" in line]
    assert len(wide) == 1  # other scans of the base read the key columns only
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert sum("Exchange" in line for line in _ancestors(plan.splitlines(), wide[0])) == 1


def test_lists_many_entities_share_do_not_move_with_them(spark):
    """At sf0.1 a number has 13 actions and 50 entities: the lists stay on their numbers."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        documents = documents_of(spark, "/root/testdata/sf0.1")
        lines = documents._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lists = [line for line in lines if "FileScan" in line and "p_type" in line]
    assert len(lists) == 1
    moves = [line for line in _ancestors(lines, lists[0]) if "Exchange" in line]
    assert moves and not any("hashpartitioning(abn" in line for line in moves)


def _ancestors(lines, leaf):
    """The operators above a leaf of a plan printed as a tree."""

    def depth(line):
        return len(line) - len(line.lstrip(" :+-"))

    found, level = [], depth(leaf)
    for line in reversed(lines[: lines.index(leaf)]):
        if depth(line) < level:
            found.append(line)
            level = depth(line)
    return found


def test_a_version_is_loaded_once(spark, built, tmp_path):
    with pytest.raises(GateError, match="is there already"):
        load_base(spark, landing.register_files(tmp_path), built["tables"], VERSION)


def test_a_failed_load_leaves_nothing(spark, tmp_path):
    tables = tmp_path / "t"
    files = landing.register_files(tmp_path)
    text = Path(files[0]).read_text()
    bad = tmp_path / "bad.xml"
    for broken in (text, text.replace("</GivenName>", "", 1)):  # repeated keys, malformed
        bad.write_text(broken)
        with pytest.raises(Exception, match="null or repeated key|MALFORMED|Malformed"):
            load_base(spark, [*files, str(bad)], str(tables), VERSION)
        assert list(tables.glob("*/*")) == []
    load_base(spark, files, str(tables), VERSION)
    assert [p.name for p in tables.glob("*/*")] == ["abn"]


def test_every_table_is_attributed():
    assert {source for source, *_ in fixed.ATTRIBUTIONS} == set(fixed.TABLES)
    assert set(fixed.ROW_FLOORS) == {s.key for s in SOURCES} == set(fixed.TABLES) - {"abn"}


def test_document_schema(built):
    wanted = StructType.fromDDL(DOCUMENT_SCHEMA)
    assert built["docs"].schema.simpleString() == wanted.simpleString()
    assert set(coverage_counters()) - set(coverage_floors("production")) == {"businessNames", "dgr"}


def test_checks_refuse_a_build_below_its_floors(built):
    verdict = verify(built["docs"], "production")
    assert not verdict.ok and not verdict.failures and not verdict.repeated_ids
    assert "company: 3 < required 1000000" in verdict.shortfalls


def test_checks_name_broken_documents(spark, built):
    docs = built["docs"]
    broken = docs.unionByName(docs.where(f"_id = '{FIRM}'")).replace(SOLE, "12345678901", "_id")
    verdict = verify(broken, "off")
    assert verdict.failures == {"checksum": 1} and verdict.repeated_ids == 1
    assert verdict.examples == ["[checksum] 12345678901"]


def test_bucketed_tables_are_joined_where_they_are(spark, built, tmp_path):
    folder, landed = str(tmp_path / "t"), tmp_path / "landing"
    landed.mkdir()
    load_base(spark, landing.register_files(landed), folder, VERSION, buckets=8)
    report = load_sources(spark, SOURCES, landing.side_files(landed), folder, VERSION, {}, buckets=8)
    assert report.failures == {}
    wide, dims = read_table(spark, f"{folder}/version=20260628/abn", fixed.TABLES["abn"]), read_dims(spark, folder, VERSION)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with buckets_kept(spark):
            docs = build_documents(wide, dims, VERSION)
            plan = docs._jdf.queryExecution().executedPlan().toString()
            got = docs.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    got.sort(key=lambda d: d["_id"])
    assert got == built["docs"].orderBy("_id").collect()
    lines = plan.splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan" in line]

    def moved(column):
        found = [i for i in scans if column in lines[i]]
        assert found
        return [sum("Exchange" in line for line in _ancestors(lines, lines[i])) for i in found]

    for column in ("business_names#", "company_name#", "total_value_aud#", "charity_name#", "primary_organisation#", "taxable_income#"):
        assert moved(column) in ([0], [0, 0]), column
    counts = [sum(1 for _ in files.glob("*.parquet")) for files in Path(folder).glob("*/asic_company")]
    assert counts and max(counts) <= 8


def test_checks_are_counted_in_the_writing_pass(spark, built, tmp_path):
    docs, seen = built["docs"], {}
    odd = docs.unionByName(docs.where(f"_id = '{FIRM}'")).replace(SOLE, "12345678901", "_id")
    copy = build.publish(odd, str(tmp_path / "odd"), lambda t, tally: seen.update(tally), build.document_counters())
    assert seen == build.coverage(copy, build.document_counters()).first().asDict()
    assert verify(copy, "production", seen) == verify(copy, "production")
    assert seen["total"] == 9 and seen["rule checksum"] == 1


def test_failed_source_is_reported_and_others_go_on(spark, tmp_path):
    paths = landing.side_files(tmp_path)
    Path(paths["wgea_reporter"]).write_text("Primary ABN,Primary Organisation,ABN\n1,2\n")
    specs = [s for s in SOURCES if s.key in ("wgea_reporter", "gov_spend", "asic_credit_rep")]
    floors = {"asic_credit_rep": 2}
    report = load_sources(spark, specs, paths, str(tmp_path / "t"), VERSION, floors)
    assert "wgea_reporter.csv at line 2" in report.failures["wgea_reporter"]
    assert report.failures["asic_credit_rep"] == "GateError: 1 rows, fewer than 2"
    assert report.rows == {"asic_credit_rep": 1, "gov_spend": 2}
    assert [p.name for p in (tmp_path / "t").glob("*/*")] == ["gov_spend"]
    again = load_sources(spark, specs[:1], paths, str(tmp_path / "t"), VERSION, {})
    assert set(again.failures) | set(again.rows)  # nothing is in the way of a second load
    Path(paths["gov_spend"]).write_bytes(gzip.compress(b'\n{"releases": []}\n'))
    empty = load_sources(spark, specs[-1:], paths, str(tmp_path / "u"), VERSION, {})
    assert "no releases" in empty.failures["gov_spend"]
    with pytest.raises(GateError, match="wgea_reporter"):
        read_dims(spark, str(tmp_path / "t"), VERSION)
    dims = read_dims(spark, str(tmp_path / "t"), VERSION, absent=set(fixed.TABLES) - {"gov_spend"})
    assert dims["wgea_reporter"].isEmpty() and dims["gov_spend"].count() == 2


def test_release_needs_complete_sources(spark, tmp_path):
    tables = str(tmp_path / "t")
    load_base(spark, landing.register_files(tmp_path), tables, VERSION)
    out, every = str(tmp_path / "out"), set(fixed.TABLES)
    with pytest.raises(GateError, match="not loaded"):
        build_release(spark, tables, VERSION, out, profile="off")
    with pytest.raises(GateError, match="grants': 'no file"):
        failed = LoadReport(failures={"grants": "no file"})
        build_release(spark, tables, VERSION, out, profile="off", report=failed, absent=every)
    with pytest.raises(GateError, match="company: 0 < required 1"):
        build_release(spark, tables, VERSION, out, profile="fixture", absent=every)
    assert not (tmp_path / "out").exists()
    assert [p.name for p in (tmp_path / "t").glob("*/*")] == ["abn"]


BROKEN = {
    "documents": ("write_ordered_lines", "_lines"),
    "shards": ("build_manifest", "manifest"),
}


@pytest.mark.parametrize("after", BROKEN)
def test_release_goes_on_after_a_failure(spark, tmp_path, built, monkeypatch, after):
    tables, out = tmp_path / "t", tmp_path / "out" / "release"
    shutil.copytree(built["tables"], tables, ignore=shutil.ignore_patterns("documents", "_RELEASED", "._*"))
    call, target = BROKEN[after]
    whole = getattr(build, call)

    def half(*args, **more):
        whole(*args, **more)
        raise OSError("a lost disk")

    def release(**more):
        return build_release(spark, str(tables), VERSION, str(out), profile="fixture", shards=3, **more)

    documents = tables / "version=20260628" / "documents"
    with monkeypatch.context() as broken, pytest.raises(OSError, match="a lost disk"):
        broken.setattr(build, call, half)
        release()
    assert released(spark, str(tables), VERSION) is None and not out.exists()
    first = {f.name for f in documents.glob("*.parquet")}
    left = {f.name for f in (out.parent / "_staging-release" / target).glob("**/*.gz")}
    assert release().agg(F.sum("n")).first()[0] == 8
    assert {f.name for f in documents.glob("*.parquet")} == first  # kept, not built again
    assert not left & {f.name for f in (out / target).glob("**/*.gz")}  # dropped and made anew
    assert released(spark, str(tables), VERSION) == str(out)
    assert not (out.parent / "_staging-release").exists()
    assert spark.read.json(f"{out}/metadata/files").where("aggregate").agg(F.sum("records")).first()[0] == 8
    with pytest.raises(GateError, match="released already"):
        release()


def test_what_a_release_keeps_depends_on_its_settings(spark, tmp_path, built, monkeypatch):
    tables, out = tmp_path / "t", tmp_path / "release"
    shutil.copytree(built["tables"], tables, ignore=shutil.ignore_patterns("documents", "_RELEASED", "._*"))

    def stop(*args, **more):
        raise OSError("a lost disk")

    def release(profile):
        return build_release(spark, str(tables), VERSION, str(out), profile=profile, urls={"abn": "https://x.test/abn"})

    with monkeypatch.context() as broken, pytest.raises(OSError, match="a lost disk"):
        broken.setattr(build, "write_line_bundle", stop)
        release("off")
    documents = tables / "version=20260628" / "documents"
    first = {f.name for f in documents.glob("*.parquet")}
    release("fixture")  # other floors: all is checked and made again
    assert not first & {f.name for f in documents.glob("*.parquet")}
    sources = spark.read.json(f"{out}/metadata/sources")
    assert [r["source"] for r in sources.where("url = 'https://x.test/abn'").collect()] == ["abn"]


def test_a_folder_of_something_else_is_left_alone(spark, tmp_path, built):
    tables, out = tmp_path / "t", tmp_path / "release"
    shutil.copytree(built["tables"], tables, ignore=shutil.ignore_patterns("documents", "_RELEASED", "._*"))
    out.mkdir()
    (out / "mine.txt").write_text("mine")
    with pytest.raises(GateError, match="something else"):
        build_release(spark, str(tables), VERSION, str(out), profile="fixture")
    assert (out / "mine.txt").read_text() == "mine"


def test_a_move_that_was_interrupted_is_finished(spark, tmp_path, built, monkeypatch):
    tables, out = tmp_path / "t", tmp_path / "release"
    shutil.copytree(built["tables"], tables, ignore=shutil.ignore_patterns("documents", "_RELEASED", "._*"))
    write = store.Store.write

    def lost(self, path, content):
        if path.endswith("_RELEASED"):
            raise OSError("a lost disk")
        write(self, path, content)

    with monkeypatch.context() as broken, pytest.raises(OSError, match="a lost disk"):
        broken.setattr(store.Store, "write", lost)
        build_release(spark, str(tables), VERSION, str(out), profile="fixture")
    assert out.exists() and released(spark, str(tables), VERSION) is None
    bundle = {f.name for f in (out / "bundle").glob("*/*.gz")}
    build_release(spark, str(tables), VERSION, str(out), profile="fixture")
    assert released(spark, str(tables), VERSION) == str(out)
    assert bundle and {f.name for f in (out / "bundle").glob("*/*.gz")} == bundle


def test_compare_releases(rows, built):
    prior = rows([("nsw", 1), ("vic", 1), ("tas", 2), ("other", 2)], "bucket string, n bigint")
    report, odd = compare_releases(built["counts"], prior, 0.25)
    status = {r["bucket"]: r["status"] for r in report.collect()}
    assert odd and status == {
        "nsw": "ok",
        "vic": "ok",
        "tas": "retired",
        "other": "moved",
        "aat": "appeared",
        "qld": "appeared",
        "total": "moved",
    }
