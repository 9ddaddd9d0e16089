"""From files in a landing folder to a checked, published set of documents."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entityfold.operators import (
    GateError,
    assert_unique,
    bucket_counts,
    check_documents,
    check_unique,
    compare_counts,
    count_on_the_way,
    coverage,
    coverage_shortfalls,
    flag_capped_chunks,
    require_empty,
    top_issues,
)
from entityfold.operators.compare import with_total
from entityfold.plans import fixed_values as fixed
from entityfold.plans.contract import contract_rules, coverage_counters, coverage_floors
from entityfold.plans.document import build_documents, version_date
from entityfold.plans.normalise import SourceSpec
from entityfold.sinks import (
    build_manifest,
    shard_order_breaks,
    write_awards,
    write_comparison,
    write_metadata,
)
from entityfold.sinks.buckets import buckets_kept, read_table, write_bucketed
from entityfold.sinks.slices import FILE_BYTES, write_line_bundle, write_line_shards, write_ordered_lines
from entityfold.sinks.store import Steps, Store
from entityfold.sources import (
    first_bad_record,
    pick_snapshot,
    read_delimited,
    read_grant_awards,
    read_listing,
    read_ocds,
    read_register_xml,
    read_workbook_grid,
    register_rows,
)
from entityfold.sources.snapshots import income_year_in, year_in


# Tables in which a row may lack the primary key.
SECOND_KEY = (
    "asic_afs_licence",
    "asic_credit_licence",
    "asic_afs_rep",
    "asic_credit_rep",
    "asic_banned_disqualified",
    "rd_tax_incentive",
)
# The last file of a release: without it nothing of a version counts as released.
MARK = "_RELEASED"
SEPARATORS = {"literal": ("\t", False), "quoted": (",", True)}


def typed_source(spark: SparkSession, spec: SourceSpec, path: str) -> DataFrame:
    """Read one side register's file and bring it to its typed table."""
    match spec.form:
        case "literal" | "quoted":
            raw = read_delimited(spark, path, *SEPARATORS[spec.form])
        case "workbook":
            raw = read_workbook_grid(spark, path)
        case "releases":
            raw = read_ocds(spark, path)
            if raw.isEmpty():
                raise GateError(f"no releases in {path}")
        case "grants":
            raw = read_grant_awards(read_workbook_grid(spark, path))
            capped = flag_capped_chunks(raw, "path", fixed.GRANT_REPORT_CAP).where("capped")
            require_empty(capped, "report is cut off at its cap")
        case other:
            raise ValueError(f"form {other!r}")
    return spec.normalise(raw)


def _table(folder: str, version: str, name: str) -> str:
    return f"{folder}/version={version_date(version):%Y%m%d}/{name}"


def publish(
    rows: DataFrame,
    target: str,
    gate: Callable[..., object] | None = None,
    counters: Mapping[str, Column] | None = None,
    key: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Write a table beside its target, check it there, and only then move it into place.

    After a failure nothing is at the target and nothing is left beside it. A table that is
    already there is an error. With ``counters`` the gate also gets ``total`` and the number of
    rows that meet each of them, counted as the rows are written. With ``buckets`` the table is
    laid out in so many buckets of ``key``.
    """
    spark = rows.sparkSession
    store = Store(spark, target)
    if store.exists(target):
        raise GateError(f"{target} is there already")
    parent, _, name = target.rpartition("/")
    beside = f"{parent}/_staging-{name}-{uuid.uuid4().hex}"
    written, seen = (rows, None) if counters is None else count_on_the_way(rows, counters)
    try:
        if buckets and key:
            write_bucketed(written, beside, key, buckets)
        else:
            written.write.parquet(beside)
        if gate is not None:
            gate(spark.read.schema(rows.schema).parquet(beside), *([] if seen is None else [seen.get]))
        store.rename(beside, target)
    finally:
        store.delete(beside)
    return read_table(spark, target, rows.schema)


def choose_files(spark: SparkSession, landing: str, specs: list[SourceSpec]) -> dict[str, str]:
    """The file of each source among the snapshots in ``landing/<source>/``.

    Sources whose files are all to be read give their folder. A source with no matching
    file is left out, and will be reported as failed when it is loaded.
    """
    chosen = {s.key: f"{landing}/{s.key}" for s in specs if s.pick == "all"}
    wanted = spark.createDataFrame(
        [(s.key, s.match, s.pick, s.suffix) for s in specs if s.pick != "all"],
        "source string, match string, pick string, suffix string",
    )
    name = F.lower("name")
    listing = (
        read_listing(spark, f"{landing}/*")
        .withColumn("source", F.element_at(F.split("path", "/"), -2))
        .join(wanted, "source")
    )
    year = (
        F.when(F.col("pick") == "latest-year", year_in(F.col("name")))
        .when(F.col("pick") == "latest-income-year", income_year_in(F.col("name")))
        .otherwise(0)
    )
    size = F.when(F.col("pick") != "latest-income-year", F.col("size")).otherwise(0)
    picked = pick_snapshot(
        listing,
        "source",
        F.endswith(name, F.col("suffix")) & F.contains(name, F.col("match")),
        [year.desc(), size.desc(), F.col("pos")],
    )
    # One row per source of the registry.
    return chosen | {r["source"]: r["path"] for r in picked.select("source", "path").collect()}


@dataclass
class LoadReport:
    """What each source gave, and why a source failed."""

    rows: dict[str, int] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)


def load_base(
    spark: SparkSession, paths: str | list[str], folder: str, version: str, buckets: int | None = None
) -> DataFrame:
    """Load the register's XML files into the base table of a version: all of it or nothing.

    With ``buckets``, here and in ``load_sources`` the same, tables are laid out by their key, and a
    build of documents joins them without moving them.
    """
    rows = register_rows(read_register_xml(spark, paths))
    target = _table(folder, version, "abn")
    return publish(rows, target, lambda t: assert_unique(t, "abn"), key="abn", buckets=buckets)


def load_sources(
    spark: SparkSession,
    specs: list[SourceSpec],
    paths: Mapping[str, str],
    folder: str,
    version: str,
    floors: Mapping[str, int] | None = None,
    buckets: int | None = None,
) -> LoadReport:
    """Load the side registers, each on its own: one that fails does not stop the others.

    With ``buckets``, tables in which every row has the primary key are laid out by it. Those with
    a second key are not: their rows without the first would share a bucket.

    ``floors`` defaults to the published ones. A source that fails or gives fewer rows than
    its floor leaves no table.
    """
    report = LoadReport()
    for spec in specs:
        floor = spec.floor if floors is None else floors.get(spec.key, 0)

        def gate(loaded: DataFrame, spec: SourceSpec = spec, floor: int = floor) -> None:
            report.rows[spec.key] = n = loaded.count()
            if n < floor:
                raise GateError(f"{n} rows, fewer than {floor}")

        try:
            if spec.key not in paths:
                raise GateError("no file for this source")
            rows = typed_source(spark, spec, paths[spec.key])
            key = None if spec.key in SECOND_KEY else "abn"
            publish(rows, _table(folder, version, spec.key), gate, key=key, buckets=buckets)
        except Exception as error:  # noqa: BLE001 - reported per source, raised by the caller
            why = f"{type(error).__name__}: {error}"
            if "MALFORMED_RECORD" in why and spec.form in SEPARATORS:
                sep, quoting = SEPARATORS[spec.form]
                why += f"; first bad record: {first_bad_record(spark, paths[spec.key], sep, quoting)}"
            report.failures[spec.key] = why
    return report


def read_dims(
    spark: SparkSession, folder: str, version: str, absent: Collection[str] = ()
) -> dict[str, DataFrame]:
    """The typed side tables of a version. Only those named in ``absent`` may be missing."""
    dims, missing = {}, []
    for name, schema in fixed.TABLES.items():
        if name == "abn":
            continue
        try:
            dims[name] = read_table(spark, _table(folder, version, name), schema)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            if name not in absent:
                missing.append(name)
            dims[name] = spark.createDataFrame([], schema)
    if missing:
        raise GateError(f"side tables that were not loaded: {missing}")
    return dims


@dataclass
class Verdict:
    """The outcome of the checks over a set of documents."""

    total: int
    covered: dict[str, int]
    failures: dict[str, int]
    repeated_ids: int
    shortfalls: list[str]
    examples: list[str]

    @property
    def ok(self) -> bool:
        return not (self.failures or self.repeated_ids or self.shortfalls)


def document_counters() -> dict[str, Column]:
    """What ``verify`` counts over documents: the covered parts, and the breaches of each rule."""
    broken = {f"rule {n}": ~F.coalesce(ok, F.lit(False)) for n, ok in contract_rules().items()}
    return coverage_counters() | broken


def verify(docs: DataFrame, profile: str, tally: Mapping[str, int] | None = None) -> Verdict:
    """Contract, checksum, uniqueness and coverage of written documents.

    ``tally`` has the counts of ``document_counters`` if they were gathered as the documents were
    written; else they are counted in one pass. Offending documents are looked up only when a
    rule has failed.
    """
    spark = docs.sparkSession
    counters, rules = coverage_counters(), contract_rules()
    if tally is None:
        tally = coverage(docs, document_counters()).first()
    covered = {n: tally[n] for n in counters}
    failures = {n: tally[f"rule {n}"] for n in rules if tally[f"rule {n}"]}

    floors = coverage_floors(profile)
    shortfalls = []
    if floors is not None:
        wanted = spark.createDataFrame(list(floors.items()), "name string, floor bigint")
        shape = ", ".join(f"{n} bigint" for n in ["total", *covered])
        got = spark.createDataFrame([(tally["total"], *covered.values())], shape)
        shortfalls = [
            f"{r['name']}: {r['got']} < required {r['required']}"
            for r in coverage_shortfalls(got, wanted).orderBy("name").collect()
        ]
    examples = []
    if failures:
        issues = check_documents(docs, "_id", {n: rules[n] for n in failures})
        examples = [f"[{r['rule']}] {r['_id']}" for r in top_issues(issues, "_id").collect()]
    repeated = check_unique(docs, "_id").count()
    return Verdict(tally["total"], covered, failures, repeated, shortfalls, examples)


def build_release(
    spark: SparkSession,
    folder: str,
    version: str,
    out: str,
    profile: str = "production",
    shards: int | None = None,
    max_bytes: int = FILE_BYTES,
    schema_version: str = "1",
    report: LoadReport | None = None,
    absent: Collection[str] = (),
    extracted: Mapping[str, str] | None = None,
    urls: Mapping[str, str] | None = None,
    prior: DataFrame | None = None,
    threshold: float = 0.1,
) -> DataFrame:
    """Build, check and release the documents of a loaded version; return its bucket counts.

    The documents are written once as a table; checks, counts and shards all read that
    table. Sources that ``report`` calls failed, and side tables that are missing, stop the build
    unless they are named in ``absent``.

    ``shards`` is the number of ranges of ids that the lines are laid out in (Spark's choice without
    it), ``max_bytes`` bounds the text in a file of a shard or of the bundle.

    A release is shards, one bundle in order of ids, the awards per recipient, and metadata:
    counts, files, and sources with the day each was extracted on (``extracted``) and where it came
    from (``urls``), by source. With ``prior``, the counts of the release before, it also has the
    comparison with it.

    All of it is made in a folder beside ``out``, step by step, and moved to ``out`` when it is whole;
    the mark of the release, in the version's tables and in ``out``, is written last. Until then
    the version counts as not released (``released``). A build that failed half-way is run again:
    steps that were finished under the same settings are kept, all else is dropped and made anew.
    A released version is not written again.
    """
    failed = {n: why for n, why in (report.failures if report else {}).items() if n not in absent}
    if failed:
        raise GateError(f"sources that were not loaded: {failed}")
    out = out.rstrip("/")
    store, tables = Store(spark, out), Store(spark, folder)
    if (known := released(spark, folder, version)) is not None:
        raise GateError(f"version {version} is released already, in {known}")
    parent, _, name = out.rpartition("/")
    beside = f"{parent}/_staging-{name}"
    if store.exists(out) and not store.exists(f"{out}/_steps"):
        raise GateError(f"{out} is there already and holds something else")
    if store.exists(out) and store.exists(beside):  # moving it was interrupted
        store.delete(out)
    if store.exists(out):
        store.rename(out, beside)

    base = read_table(spark, _table(folder, version, "abn"), fixed.TABLES["abn"])
    dims = read_dims(spark, folder, version, absent)

    def gate(docs: DataFrame, tally: Mapping[str, int]) -> None:
        entities = base.count()
        if tally["total"] != entities:
            raise GateError(f"rows were multiplied or lost: {tally['total']} documents of {entities} entities")
        verdict = verify(docs, profile, tally)
        if not verdict.ok:
            raise GateError(f"documents are not fit to publish: {verdict}")

    target = _table(folder, version, "documents")
    loaded = {t: tables.changed(_table(folder, version, t)) for t in fixed.TABLES}
    settings = {"version": version, "loaded": loaded, "absent": sorted(absent), "profile": profile}
    steps = Steps(store, beside, settings)
    built = build_documents(base, dims, version)
    with buckets_kept(spark):
        steps.run("documents", target, lambda: publish(built, target, gate, document_counters()))
    docs = spark.read.schema(built.schema).parquet(target)
    counts = bucket_counts(docs, "state")

    lines = f"{beside}/_lines"
    steps.run("lines", lines, lambda: write_ordered_lines(docs, lines, "state", ranges=shards), ranges=shards)

    def in_order() -> None:
        write_line_shards(spark, lines, f"{beside}/shards", max_bytes)
        breaks = shard_order_breaks(spark, f"{beside}/shards")
        require_empty(breaks, "shard is not in order of its ids")

    steps.run("shards", f"{beside}/shards", in_order, max_bytes=max_bytes)
    hashed = f"{beside}/manifest"  # hashed once, read by all that follows
    steps.run("manifest", hashed, lambda: build_manifest(spark, f"{beside}/shards", counts).write.parquet(hashed))
    files = f"{beside}/files"

    def bundled() -> None:
        both = write_line_bundle(spark, lines, f"{beside}/bundle", spark.read.parquet(hashed), max_bytes)
        both.write.mode("overwrite").parquet(files)

    steps.run("bundle", f"{beside}/bundle", bundled)
    awards = dims["gov_grants"].select(
        F.col("abn").alias("recipient"),
        (F.col("total_value_aud") * 100).cast("bigint").alias("cents"),
        F.col("grant_count").alias("awards"),
        F.col("first_grant_date").alias("first_published"),
        F.col("last_grant_date").alias("last_published"),
    )
    steps.run("awards", f"{beside}/awards", lambda: write_awards(awards, f"{beside}/awards"))
    days, places = extracted or {}, urls or {}
    rows = [(*row, places.get(row[0]), days.get(row[0])) for row in fixed.ATTRIBUTIONS]
    shape = "source string, name string, licence string, attribution string, url string, extracted string"

    def described() -> None:
        sources, held = spark.createDataFrame(rows, shape), spark.read.parquet(files)
        write_metadata(f"{beside}/metadata", version, schema_version, counts, held, sources)

    steps.run("metadata", f"{beside}/metadata", described, schema=schema_version, sources=rows)
    if prior is not None:
        report_of = compare_releases(counts, prior, threshold)[0]
        before = sorted(tuple(r) for r in with_total(prior).collect())  # one row per bucket
        steps.run(
            "comparison", f"{beside}/comparison",
            lambda: write_comparison(report_of, f"{beside}/comparison"), prior=before, threshold=threshold,
        )
    else:
        store.delete(f"{beside}/comparison")
    store.rename(beside, out)
    mark = json.dumps({"version": version, "out": out})
    store.write(f"{out}/{MARK}", mark)
    tables.write(_table(folder, version, MARK), mark)
    store.delete(f"{out}/_lines")
    return counts


def released(spark: SparkSession, folder: str, version: str) -> str | None:
    """The folder of a version's release, or None as long as it is not released in full."""
    mark = Store(spark, folder).read(_table(folder, version, MARK))
    return None if mark is None else json.loads(mark)["out"]


def compare_releases(
    current: DataFrame, prior: DataFrame, threshold: float
) -> tuple[DataFrame, bool]:
    """(comparison per bucket and in total, whether anything needs a person to look at it)."""
    report = compare_counts(with_total(current), with_total(prior), "bucket", threshold)
    return report, not report.where(F.col("status") != "ok").isEmpty()
