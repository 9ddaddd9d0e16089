"""The base register: XML files with one element per entity, read in splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entityfold.functions import compact_date, stripped
from entityfold.operators.gates import require_empty

# Shape of one register record. Attributes start with "_", text is "_VALUE".
RECORD_SCHEMA = """
_recordLastUpdatedDate string,
ABN struct<_VALUE:string,_status:string,_ABNStatusFromDate:string>,
EntityType struct<EntityTypeInd:string,EntityTypeText:string>,
MainEntity struct<
  NonIndividualName:array<struct<_type:string,NonIndividualNameText:string>>,
  BusinessAddress:struct<AddressDetails:struct<State:string,Postcode:string>>>,
LegalEntity struct<
  IndividualName:struct<_type:string,GivenName:array<string>,FamilyName:string>,
  BusinessAddress:struct<AddressDetails:struct<State:string,Postcode:string>>>,
ASICNumber struct<_VALUE:string,_ASICNumberType:string>,
GST struct<_status:string,_GSTStatusFromDate:string>,
DGR array<struct<
  _DGRStatusFromDate:string,
  _status:string,
  NonIndividualName:array<struct<_type:string,NonIndividualNameText:string>>>>,
OtherEntity array<struct<
  NonIndividualName:array<struct<_type:string,NonIndividualNameText:string>>>>
"""
RECORD_TAG = "ABR"
ROOT_TAG = "Transfer"


def _pieces(spark: SparkSession, paths: str | list[str], record_tag: str) -> DataFrame:
    """One row per text between two record ends: splits of a file meet at record ends."""
    return (
        spark.read.option("lineSep", f"</{record_tag}>")
        .text(paths)
        .select("value", F.col("_metadata.file_path").alias("path"))
    )


def _attributes() -> str:
    return r"""(?:[^<>"']|"[^"]*"|'[^']*')*?"""


def _starts(c: Column, tag: str) -> Column:
    # The plain search is much cheaper, and most texts end with it.
    return c.contains(f"<{tag}") & c.rlike(rf"<{tag}[\s/>]")


def _without_comments(value: Column) -> Column:
    return F.when(
        value.contains("<!--"), F.regexp_replace(value, r"(?s)<!--.*?-->", "")
    ).otherwise(value)


def _elements(value: Column, tag: str) -> Column:
    """The text from each record start of a piece up to the next one, or to the piece's end."""
    after = F.split(F.concat(F.lit(" "), value), rf"(?=<{tag}[\s/>])")
    return F.slice(after, 2, F.size(after))


def _empty_element(element: Column, tag: str) -> Column:
    return element.rlike(rf"^<{tag}(?:\s{_attributes()})?/>")


def _open_element(element: Column, tag: str) -> Column:
    """Neither an empty element nor closed by an end tag inside the piece."""
    return ~_empty_element(element, tag) & ~element.rlike(rf"</{tag}\s*>")


def _records(value: Column, tag: str, root: str) -> Column:
    """Every record of a piece as one XML text.

    Most pieces hold one record that ends with the piece; plain searches find them. Empty elements
    and end tags with white space in them do not end a piece, so a piece may hold several records. A
    record that is open before another starts is left open, which the parser refuses.
    """
    start, end = f"<{tag}", F.lit(f"</{tag}>")
    after = F.substring_index(value, start, -1)
    one = F.length(value) - F.length(after) == F.length(F.substring_index(value, start, 1)) + len(start)
    plain = after.rlike(r"^(?:>|\s[^<>/]*>)") & ~value.contains(f"</{tag}") & ~value.contains(f"</{root}")
    return F.when(one & plain, F.array(F.concat(F.lit(start), after, end))).otherwise(_several(value, tag))


def _several(value: Column, tag: str) -> Column:
    end = F.lit(f"</{tag}>")
    found = _elements(value, tag)
    last = F.size(found) - 1

    def whole(element: Column, at: Column) -> Column:
        empty = F.regexp_extract(element, rf"^<{tag}(?:\s{_attributes()})?/>", 0)
        closed = F.regexp_extract(element, rf"(?s)^.*?</{tag}\s*>", 0)
        return (
            F.when(_empty_element(element, tag), empty)
            .when(element.rlike(rf"</{tag}\s*>"), closed)
            .when(at == last, F.concat(element, end))
            .otherwise(element)
        )

    return F.transform(found, whole)


def gate_whole_documents(
    spark: SparkSession,
    paths: str | list[str],
    record_tag: str = RECORD_TAG,
    root_tag: str = ROOT_TAG,
) -> None:
    """Fail when a file was cut off: its root is not closed, or a record lies open at its end.

    A comment that holds a record's end tag is cut by it and fails here, too.
    """
    value = _without_comments(F.col("value"))
    closed = value.contains(f"</{root_tag}>")
    # An empty array has no last element: null, no open record.
    last = F.try_element_at(F.when(closed, _elements(value, record_tag)), F.lit(-1))
    opened = closed & F.coalesce(_open_element(last, record_tag), F.lit(False))
    files = (
        _pieces(spark, paths, record_tag)
        .groupBy("path")
        .agg(
            F.count_if(_starts(value, root_tag)).alias("roots"),
            F.count_if(closed).alias("closed_roots"),
            F.count_if(opened).alias("open_records"),
            F.count_if(value.contains("<!--")).alias("cut_comments"),
        )
    )
    sound = (
        (F.col("roots") == 1)
        & (F.col("closed_roots") == 1)
        & (F.col("open_records") == 0)
        & (F.col("cut_comments") == 0)
    )
    require_empty(files.where(~sound), "not one whole XML document")


def read_register_xml(
    spark: SparkSession,
    paths: str | list[str],
    record_tag: str = RECORD_TAG,
    schema: str = RECORD_SCHEMA,
    root_tag: str = ROOT_TAG,
) -> DataFrame:
    """One row per record start, in the given schema. A malformed record fails the job.

    The text is cut at the record's end tag, so that large files are read by many tasks, and
    then at every record start, so that each start gives one row or an error.
    """
    gate_whole_documents(spark, paths, record_tag, root_tag)
    value = _without_comments(F.col("value"))
    return (
        _pieces(spark, paths, record_tag)
        .where(F.col("value").contains(f"<{record_tag}"))
        .select(F.explode(_records(value, record_tag, root_tag)).alias("record"))
        .select(F.from_xml("record", schema, {"mode": "FAILFAST"}).alias("r"))
        .select("r.*")
    )


def _names(all_names: Column, kind: str) -> Column:
    """Non-blank names of one kind, in document order."""
    of_kind = F.filter(all_names, lambda n: n["_type"] == kind)
    texts = F.transform(of_kind, lambda n: stripped(n["NonIndividualNameText"]))
    return F.array_compact(texts)


def register_rows(records: DataFrame) -> DataFrame:
    """Register records as flat base rows: one per entity, names and endorsements as lists.

    Names go by the kind that their attribute states, never by their text: MN is the
    entity's own name (the last one wins), BN, TRD and OTN are lists.
    """
    no_names = F.array().cast("array<struct<_type:string,NonIndividualNameText:string>>")
    other = F.flatten(F.array_compact("OtherEntity.NonIndividualName"))
    both = F.concat(F.coalesce("MainEntity.NonIndividualName", no_names), F.coalesce(other, no_names))
    # A step of its own: read four times below, made once.
    records, names = records.withColumn("__names", both), F.col("__names")
    own = F.try_element_at(F.filter(names, lambda n: n["_type"] == "MN"), F.lit(-1))
    given = F.array_compact(F.transform("LegalEntity.IndividualName.GivenName", stripped))

    def endorsement(d: Column) -> Column:
        name = F.try_element_at(d["NonIndividualName"], F.lit(-1))["NonIndividualNameText"]
        return F.struct(
            stripped(name).alias("name"),
            stripped(d["_status"]).alias("status"),
            compact_date(d["_DGRStatusFromDate"]).alias("statusFromDate"),
        )

    def address(part: str) -> Column:
        # The last address of a record counts; the legal entity's follows the main one's.
        return F.coalesce(
            F.col(f"LegalEntity.BusinessAddress.AddressDetails.{part}"),
            F.col(f"MainEntity.BusinessAddress.AddressDetails.{part}"),
        )

    no_endorsements = F.array().cast(
        "array<struct<name:string,status:string,statusFromDate:date>>"
    )
    return records.select(
        F.coalesce(stripped(F.col("ABN._VALUE")), F.lit("")).alias("abn"),
        stripped(F.col("ABN._status")).alias("abn_status"),
        compact_date(F.col("ABN._ABNStatusFromDate")).alias("abn_status_from_date"),
        stripped(F.col("EntityType.EntityTypeInd")).alias("entity_type_code"),
        stripped(F.col("EntityType.EntityTypeText")).alias("entity_type_text"),
        stripped(own["NonIndividualNameText"]).alias("entity_name"),
        F.nullif(F.array_join(given, " "), F.lit("")).alias("given_names"),
        stripped(F.col("LegalEntity.IndividualName.FamilyName")).alias("family_name"),
        stripped(F.col("ASICNumber._VALUE")).alias("asic_number"),
        stripped(F.col("ASICNumber._ASICNumberType")).alias("asic_number_type"),
        stripped(F.col("GST._status")).alias("gst_status"),
        compact_date(F.col("GST._GSTStatusFromDate")).alias("gst_status_from_date"),
        F.trim(address("State")).alias("address_state"),
        stripped(address("Postcode")).alias("address_postcode"),
        _names(names, "BN").alias("business_names"),
        _names(names, "TRD").alias("trading_names"),
        _names(names, "OTN").alias("other_names"),
        F.coalesce(F.transform("DGR", endorsement), no_endorsements).alias("dgr"),
        stripped(F.col("_recordLastUpdatedDate")).cast("int").alias("record_last_updated"),
    )
