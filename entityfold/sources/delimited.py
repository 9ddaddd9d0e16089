"""Delimited text, quoted (comma) or literal (tab), read whole or not at all.

Files are read in splits. Where records run over several lines, a first pass counts lines and
quotes per block of a file. A running sum over a file's blocks then tells where each block stands:
its first line number, and whether it begins inside quotes. With that, every block is cut into
records on its own; a record that runs on into the next blocks is completed with their first lines.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityfold.functions import safe_name
from entityfold.operators.gates import GateError, require_empty
from entityfold.session import fresh_folder

# The functions that run on batches travel to the executors, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BAD = "__bad_record"
_BLOCK = ["path", "block"]

# Blocks that are joined by broadcast: about 150 bytes each, one per split of 128 MB.
MOST_BLOCKS = 200_000


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, block, place, value): lines as they are, with a carriage return at their end if any.

    ``place`` orders the lines of a block. It compares only with places of the same scan.
    """
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )


def _without_return(name: str) -> Column:
    """A text without the carriage return at its end."""
    return F.when(F.endswith(name, F.lit("\r")), F.left(F.col(name), F.length(name) - 1)).otherwise(F.col(name))


def block_facts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, block, lines, quotes, blank_lines, header, header_at, odd_lines, last_odd, lone_returns)
    per block of a file, in one pass; places count from 0 in the block.

    ``odd_lines`` have an odd number of quotes: there a quoted field that runs over several lines
    begins or ends. ``lone_returns`` are lines with a carriage return inside.
    """
    value = _without_return("value")
    count = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    lines = _lines(spark, path).select(
        *_BLOCK,
        "place",
        value.alias("value"),
        count.alias("q"),
        (F.trim(value) == "").alias("blank"),
        value.contains("\r").alias("lone"),
    )
    text = F.when(~F.col("blank"), F.struct("place", "value"))
    odd = F.col("q") % 2 == 1
    first = F.min("place")
    return lines.groupBy(*_BLOCK).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("q").cast("bigint").alias("quotes"),
        F.count_if("blank").alias("blank_lines"),
        F.min(text)["value"].alias("header"),
        (F.min(text)["place"] - first).alias("header_at"),
        F.count_if(odd).alias("odd_lines"),
        (F.max(F.when(odd, F.col("place"))) - first).alias("last_odd"),
        F.count_if("lone").alias("lone_returns"),
    )


def placed_blocks(facts: DataFrame) -> DataFrame:
    """Blocks with what comes before them in their file: one row per block, ordered per file.

    Adds ``first_line`` (from 1), ``inside`` (the block begins inside quotes), ``owner`` (the block in
    which the record that is open at its start began), ``header_line`` and ``open_line`` (where the
    file's last record with an odd quote began, if that is not closed).
    """
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    first = F.coalesce(F.sum("lines").over(before), F.lit(0)) + 1
    placed = facts.withColumns(
        {
            "first_line": first,
            "inside": F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1,
            "owner": F.last(F.when(F.col("odd_lines") > 0, F.col("block")), True).over(before),
        }
    )
    ends_open = F.sum("quotes").over(whole) % 2 == 1
    return placed.withColumns(
        {
            "header_line": F.min(F.col("first_line") + F.col("header_at")).over(whole),
            "open_line": F.when(ends_open, F.max(F.col("first_line") + F.col("last_odd")).over(whole)),
        }
    )


def _blocks_of(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Facts of all blocks, placed, as a written table: small, and read by all that follows."""
    target = fresh_folder(spark, "blocks")
    placed = placed_blocks(block_facts(spark, path))
    placed.write.parquet(target)
    return spark.read.schema(placed.schema).parquet(target)


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block that begins inside quotes the text up to the line that closes them."""
    at, held, closed = None, [], False

    def row() -> pa.RecordBatch:
        (path, owner, block), text = at, "\n".join(held)
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        columns = [pa.array([v], k) for v, k in zip((path, owner, block, text), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["path", "owner", "block", "text"])

    for batch in batches:
        path, owner, block, value = (batch.column(i) for i in range(4))
        odd = pc.equal(pc.bit_wise_and(pc.count_substring(value, '"'), 1), 1).to_numpy(False)
        for start, end in _runs(path, block):
            key = (path[start].as_py(), owner[start].as_py(), block[start].as_py())
            if key != at:
                if at:
                    yield row()
                at, held, closed = key, [], False
            if not closed:
                ends = np.flatnonzero(odd[start:end])
                closed = len(ends) > 0
                stop = start + ends[0] + 1 if closed else end
                held += value.slice(start, stop - start).to_pylist()
    if at:
        yield row()


def _runs(path: pa.Array, block: pa.Array) -> list[tuple[int, int]]:
    """Slices of a batch that lie in one block of one file."""
    n = len(block)
    if not n:
        return []
    new = np.diff(block.to_numpy()) != 0
    new |= pc.not_equal(path.slice(1), path.slice(0, n - 1)).to_numpy(False)
    edges = [0, *(np.flatnonzero(new) + 1).tolist(), n]
    return list(zip(edges[:-1], edges[1:], strict=True))


def _glued(batches: Iterator[pa.RecordBatch], quoting: bool) -> Iterator[pa.RecordBatch]:
    """Records that begin in a block, each with the line it begins on."""
    at, line, inside, skipping, rest = None, 0, False, False, None
    pending, begun = [], 0

    def made(paths: str, lines: Sequence[int], texts: list[str]) -> pa.RecordBatch:
        columns = [pa.array([paths] * len(texts), pa.string()), pa.array(lines, pa.int64()), pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["path", "line", "text"])

    def last() -> Iterator[pa.RecordBatch]:
        if pending:  # the record goes on in the next blocks
            yield made(at[0], [begun], ["\n".join([*pending, *([] if rest is None else [rest])])])

    for batch in batches:
        path, block, value, first, opened, more = (batch.column(i) for i in range(6))
        count = pc.count_substring(value, '"').to_numpy(False) if quoting else np.zeros(len(value), np.int32)
        for start, end in _runs(path, block):
            key = (path[start].as_py(), block[start].as_py())
            if key != at:
                yield from last()
                at, line, pending, rest = key, first[start].as_py(), [], more[start].as_py()
                inside = skipping = quoting and opened[start].as_py()
            state = (np.cumsum(count[start:end]) + inside) % 2 == 1  # open after the line
            texts = value.slice(start, end - start).to_pylist()
            ends = np.flatnonzero(~state)
            lines, found, done = [], [], 0
            for stop in (ends + 1).tolist():
                if skipping:  # the record began in a block before
                    skipping = False
                elif pending:
                    lines.append(begun)
                    found.append("\n".join([*pending, *texts[done:stop]]))
                    pending = []
                else:
                    lines.append(line + done)
                    found.append(texts[done] if stop - done == 1 else "\n".join(texts[done:stop]))
                done = stop
            if done < end - start and not skipping:
                begun = begun if pending else line + done
                pending += texts[done:]
            line, inside = line + end - start, bool(state[-1])
            if found:
                yield made(at[0], lines, found)
    yield from last()


def numbered_records(
    spark: SparkSession, path: str | list[str], quoting: bool, blocks: DataFrame | None = None
) -> DataFrame:
    """(path, line, text) of every record but the headers: the line it begins on, from 1, and its text.

    No text is shuffled: lines pass through in the order of their block, and only the first lines
    of blocks that begin inside quotes are brought to the block where their record began.
    """
    blocks = _blocks_of(spark, path) if blocks is None else blocks
    lines = _lines(spark, path)
    known = blocks.agg(F.count(F.lit(1)), F.count_if("inside")).first()
    small = known[0] <= MOST_BLOCKS

    def beside(facts: DataFrame, *columns: str) -> DataFrame:
        if small:
            return lines.join(F.broadcast(facts), _BLOCK).select(*columns)
        met = lines.join(facts, _BLOCK).repartition(*_BLOCK)
        return met.sortWithinPartitions(*_BLOCK, "place").select(*columns)

    starts = blocks.select(*_BLOCK, "first_line", "inside", F.lit(None).cast("string").alias("rest"))
    if quoting and known[1]:
        inside = blocks.where("inside").select(*_BLOCK, "owner")
        schema = "path string, owner bigint, block bigint, text string"
        firsts = beside(inside, "path", "owner", "block", "value").mapInArrow(_first_lines, schema)
        pieces = F.array_sort(F.collect_list(F.struct("block", "text")))
        text = F.array_join(F.transform(pieces, lambda p: p["text"]), "\n")
        rests = firsts.groupBy("path", F.col("owner").alias("block")).agg(text.alias("rest"))
        starts = starts.drop("rest").join(rests, _BLOCK, "left")

    def glue(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _glued(batches, quoting)

    ordered = beside(starts, *_BLOCK, "value", "first_line", "inside", "rest")
    records = ordered.mapInArrow(glue, "path string, line bigint, text string")
    headers = blocks.where("block = 0").select("path", "header_line")
    records = records.join(F.broadcast(headers) if small else headers, "path")
    records = records.where(F.col("line") != F.coalesce("header_line", F.lit(0)))
    return records.select("path", "line", _without_return("text").alias("text"))


def parsed_records(records: DataFrame, names: Sequence[str], sep: str, quoting: bool) -> DataFrame:
    """(path, line, text, r, bad): the fields of each record, and whether its width differs."""
    fields = ", ".join(f"`{n}` string" for n in [*names, _BAD])
    options = {
        "sep": sep,
        "quote": '"' if quoting else "",
        "escape": '"' if quoting else "",
        "lineSep": "\n",
        "maxCharsPerColumn": "-1",
        "maxColumns": str(len(names) + 1),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _BAD,
    }
    blank = F.trim("text") == ""
    if len(names) == 1:
        records = records.where(~blank)
    parsed = records.withColumn("r", F.from_csv("text", fields, options))
    return parsed.withColumn("bad", F.col(f"r.{_BAD}").isNotNull() | blank)


def bad_records(
    spark: SparkSession, path: str | list[str], names: Sequence[str], sep: str, quoting: bool, blocks: DataFrame | None = None
) -> DataFrame:
    """(path, line, text) of the records that are wider or narrower than the header, or blank."""
    parsed = parsed_records(numbered_records(spark, path, quoting, blocks), names, sep, quoting)
    return parsed.where("bad").select("path", "line", "text")


def first_bad_record(spark: SparkSession, path: str | list[str], sep: str, quoting: bool) -> str | None:
    """File and line of the first record that makes ``read_delimited`` fail; None if there is none."""
    blocks = _blocks_of(spark, path)
    labels = _profile(blocks, sep, quoting)[0]
    names = [f"c{i}" for i in range(len(labels))]
    found = bad_records(spark, path, names, sep, quoting, blocks)
    first = found.orderBy("path", "line").select("path", "line").first()
    return first and f"{first['path']} at line {first['line']}"


def delimited_facts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, header, lines, quotes, open_lines, blank_lines) per file, in one splittable pass.

    ``open_lines`` are lines with an odd number of quotes: quoted fields that run over
    the end of the line.
    """
    return _file_facts(block_facts(spark, path))


def _file_facts(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("path").agg(
        F.min_by("header", F.when(F.col("header").isNotNull(), F.col("block"))).alias("header"),
        F.sum("lines").alias("lines"),
        F.sum("quotes").alias("quotes"),
        F.sum("odd_lines").alias("open_lines"),
        F.sum("blank_lines").alias("blank_lines"),
    )


def open_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, line) of the files that end inside a quoted field, and where its record begins."""
    placed = placed_blocks(block_facts(spark, path)).where(F.col("open_line").isNotNull())
    return placed.select("path", F.col("open_line").alias("line")).distinct()


def gate_quotes(spark: SparkSession, path: str | list[str]) -> None:
    """Fail when a file ends inside a quoted field (an odd number of quotes in the file)."""
    require_empty(open_records(spark, path), "unterminated quoted field")


def _reader(spark: SparkSession, names: Sequence[str], sep: str, quoting: bool):
    fields = [T.StructField(n, T.StringType()) for n in names]
    return (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"' if quoting else "")
        .option("escape", '"' if quoting else "")
        .option("maxCharsPerColumn", -1)
        .option("maxColumns", len(names) + 1)
        # Spark checks the width of a record only when it parses all of it.
        .option("columnPruning", False)
    )


def _profile(blocks: DataFrame, sep: str, quoting: bool) -> tuple[list[str], bool, bool]:
    """The one header of all files, whether any record runs over several lines, and whether there
    are blank lines that then may or may not be records.

    One job over the facts of blocks; fails on a missing or differing header, on a quoted
    field that never ends, and on a blank line outside quotes.
    """
    files = blocks.groupBy("path").agg(
        F.min_by("header", F.when(F.col("header").isNotNull(), F.col("block"))).alias("header"),
        F.sum("odd_lines").alias("open_lines"),
        F.sum("lone_returns").alias("lone_returns"),
        F.max("open_line").alias("open_line"),
        F.sum("blank_lines").alias("blank_lines"),
    )
    open_ended = F.when(F.col("open_line").isNotNull(), F.struct("path", "open_line"))
    seen = files.agg(
        F.count(F.lit(1)).alias("files"),
        F.min("header").alias("header"),
        F.max("header").alias("other"),
        F.count_if(F.col("header").isNull()).alias("headless"),
        F.sum("open_lines").alias("open_lines"),
        F.sum("lone_returns").alias("lone_returns"),
        F.min(open_ended).alias("open_ended"),
        F.min(F.when(F.col("blank_lines") > 0, F.col("path"))).alias("blank"),
    ).first()
    if not seen["files"] or seen["headless"]:
        raise GateError("a file has no header line")
    if seen["header"] != seen["other"]:
        raise GateError(f"files differ in their header: {seen['header']!r}, {seen['other']!r}")
    if "\r" in seen["header"] or quoting and seen["header"].count('"') % 2:
        raise GateError(f"a header has a line break: {seen['header'][:200]!r}")
    if quoting and seen["open_ended"]:
        found = seen["open_ended"]
        raise GateError(f"unterminated quoted field in {found['path']} starting at line {found['open_line']}")
    quotes = csv.QUOTE_MINIMAL if quoting else csv.QUOTE_NONE
    labels = next(csv.reader([seen["header"]], delimiter=sep, quoting=quotes))
    multi_line = bool(quoting and (seen["open_lines"] or seen["lone_returns"]))
    if seen["blank"] and not multi_line and len(labels) > 1:
        raise GateError(f"blank line, fewer fields than the header, in {seen['blank']}")
    return labels, multi_line, bool(seen["blank"])


def _names(labels: Sequence[str], expected: Sequence[str] | None) -> list[str]:
    names = [safe_name(label) for label in labels]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise GateError(f"header labels collapse to the same name: {twice}")
    if expected is not None and len(names) != len(expected):
        raise GateError(f"{len(names)} columns in the file, {len(expected)} in the target")
    return names


def ragged_records(
    spark: SparkSession, path: str | list[str], names: Sequence[str], sep: str, quoting: bool
) -> DataFrame:
    """(path, records, line, example) of the files with records wider or narrower than the header:
    how many there are, and the first of them with the line it begins on."""
    bad = bad_records(spark, path, names, sep, quoting)
    first = F.min(F.struct("line", "text"))
    return bad.groupBy("path").agg(
        F.count(F.lit(1)).alias("records"), first["line"].alias("line"), first["text"].alias("example")
    )


def gate_rectangular(
    spark: SparkSession, path: str | list[str], sep: str, quoting: bool
) -> tuple[list[str], bool]:
    """Fail when a record is wider or narrower than the header, or a line is blank.

    The error names files and lines. Returns the header labels, and whether any record runs
    over several lines.
    """
    blocks = _blocks_of(spark, path)
    labels, multi_line, _ = _profile(blocks, sep, quoting)
    names = [f"c{i}" for i in range(len(labels))]
    bad = bad_records(spark, path, names, sep, quoting, blocks)
    require_empty(bad.orderBy("path", "line"), "blank line, or record width differs from the header")
    return labels, multi_line


def _whole(parsed: DataFrame, names: Sequence[str]) -> DataFrame:
    """The fields; a bad record fails whatever columns are used."""
    where = F.concat(F.col("path"), F.lit(" at line "), F.col("line").cast("string"))
    what = F.when(F.trim("text") == "", F.lit("blank line, fewer fields than the header, in "))
    what = what.otherwise(F.lit("MALFORMED_RECORD: record width differs from the header in "))
    failed = F.raise_error(F.concat(what, where)).cast("boolean")
    sound: Column = F.when(F.col("bad"), failed).otherwise(F.lit(True))
    return parsed.where(sound).select(*(F.col("r")[n].alias(n) for n in names))


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str,
    quoting: bool,
    expected_cols: Sequence[str] | None = None,
) -> DataFrame:
    """All columns as text under safe names; rows keep every character.

    One cheap pass over the lines first: header, quotes that never close, blank lines.
    The width of every record is checked as it is parsed, whatever columns are used
    later, and a wrong one fails the job; ``gate_rectangular`` checks it ahead instead, and
    ``first_bad_record`` finds its line afterwards.

    Files are read in splits, with and without line breaks inside quotes; the first pass finds out
    which it is. With line breaks, lines are joined to records first (``numbered_records``), and
    errors name file and line. A carriage return alone ends no record then.
    """
    blocks = _blocks_of(spark, path)
    labels, multi_line, blank = _profile(blocks, sep, quoting)
    names = _names(labels, expected_cols)
    if multi_line:
        records = numbered_records(spark, path, quoting, blocks)
        if blank and len(names) > 1:
            found = records.where(F.trim("text") == "").select("path", "line")
            require_empty(found, "blank line, fewer fields than the header")
        return _whole(parsed_records(records, names, sep, quoting), names)
    return _reader(spark, names, sep, quoting).option("mode", "FAILFAST").csv(path)
