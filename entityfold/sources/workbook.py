"""Workbooks as grids of text cells, and the tables inside them.

A workbook is a zip archive and cannot be read in part; its sheets hold at most
1,048,576 rows, which bounds the work of one task. Only the decoding of the archive is
Python; header search, column choice and row mapping are Spark expressions.
"""

from __future__ import annotations

import io
import re
import sys
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from entityfold.functions import clean_number, digits, has_digits, sheet_date, stripped, to_cents

# The decoder travels to the executors with the job; they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRID_SCHEMA = "path string, sheet_no int, sheet string, row_no int, cells array<string>"
_BATCH_ROWS = 5_000


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _rich_text(node: ElementTree.Element) -> str:
    """The text of a string item: its own, or that of its runs; readings aids are left out."""
    runs = [n for n in node if _local(n.tag) in ("t", "r")]
    return "".join(
        t.text or "" for run in runs for t in run.iter() if _local(t.tag) == "t"
    )


def _number_text(raw: str) -> str:
    """A stored number as it is written by hand: no exponent, no trailing zeros."""
    value = float(raw)
    return str(int(value)) if value.is_integer() and abs(value) < 1e21 else repr(value)


def _cell(node: ElementTree.Element, shared: Sequence[str]) -> str | None:
    kind = node.get("t", "n")
    parts = {_local(n.tag): n for n in node}
    if kind == "inlineStr":
        return _rich_text(parts["is"]) if "is" in parts else None
    raw = parts["v"].text if "v" in parts else None  # for a formula, its stored result
    if raw is None:
        return None
    if kind == "s":
        return shared[int(raw)]
    if kind == "b":
        return "true" if raw == "1" else "false"
    return _number_text(raw) if kind == "n" else raw


def _column_number(reference: str) -> int:
    number = 0
    for letter in re.match("[A-Z]+", reference)[0]:
        number = number * 26 + ord(letter) - 64
    return number - 1


def _sheet_rows(stream, shared: Sequence[str]) -> Iterator[tuple[int, list[str | None]]]:
    row_no = 0
    for _, node in ElementTree.iterparse(stream):
        if _local(node.tag) != "row":
            continue
        row_no = int(node.get("r", row_no + 1))
        cells: list[str | None] = []
        for cell in node:
            at = _column_number(cell.get("r")) if cell.get("r") else len(cells)
            cells.extend([None] * (at + 1 - len(cells)))
            cells[at] = _cell(cell, shared)
        node.clear()
        yield row_no, cells


def _sheets(book: zipfile.ZipFile) -> Iterator[tuple[str, str]]:
    """(name, archive member) of the sheets in the order of the workbook."""
    links = {
        n.get("Id"): n.get("Target")
        for n in ElementTree.parse(book.open("xl/_rels/workbook.xml.rels")).getroot()
    }
    for node in ElementTree.parse(book.open("xl/workbook.xml")).getroot().iter():
        if _local(node.tag) == "sheet":
            link = next(v for k, v in node.attrib.items() if _local(k) == "id")
            target = links[link]
            yield node.get("name"), target.lstrip("/") if target[0] == "/" else f"xl/{target}"


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["path", "sheet_no", "sheet", "row_no", "cells"]
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            with zipfile.ZipFile(io.BytesIO(content)) as book:
                shared: list[str] = []
                if "xl/sharedStrings.xml" in book.namelist():
                    items = ElementTree.parse(book.open("xl/sharedStrings.xml")).getroot()
                    shared = [_rich_text(n) for n in items if _local(n.tag) == "si"]
                rows: list[tuple] = []
                for sheet_no, (sheet, member) in enumerate(_sheets(book)):
                    with book.open(member) as stream:
                        for row_no, cells in _sheet_rows(stream, shared):
                            rows.append((path, sheet_no, sheet, row_no, cells))
                            if len(rows) == _BATCH_ROWS:
                                yield pd.DataFrame(rows, columns=names)
                                rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=names)


def decode_workbooks(files: DataFrame) -> DataFrame:
    """(path, content) rows as one row per sheet row."""
    return files.select("path", "content").mapInPandas(_decode, GRID_SCHEMA)


def read_workbook_grid(spark: SparkSession, path: str) -> DataFrame:
    """Every sheet row of the workbooks at ``path`` (a file, folder or glob)."""
    return decode_workbooks(spark.read.format("binaryFile").load(path))


def _lowered(cells: Column) -> Column:
    return F.transform(cells, lambda c: F.coalesce(F.lower(stripped(c)), F.lit("")))


def _header_row(is_header, max_scan: int, first_sheet_only: bool) -> Column:
    """The position and labels of a row that is a header, null for any other row."""
    labels = _lowered(F.col("cells"))
    candidate = (F.col("row_no") <= max_scan) & is_header(labels)
    if first_sheet_only:
        candidate = candidate & (F.col("sheet_no") == 0)
    return F.when(candidate, F.struct("sheet_no", "row_no", labels.alias("header")))


def _found(header: Column) -> Column:
    """The header of a workbook; a workbook without one fails the job."""
    missing = F.raise_error(F.concat(F.lit("no header row in "), "path"))
    return F.when(header.isNotNull(), header).otherwise(missing)


def locate_header(
    grid: DataFrame, is_header, max_scan: int, first_sheet_only: bool = False
) -> DataFrame:
    """(path, sheet_no, row_no, header): the first header row of each workbook.

    ``is_header`` is a function of the lower-case cells of a row.
    """
    first = F.min(_header_row(is_header, max_scan, first_sheet_only))
    found = grid.groupBy("path").agg(first.alias("h"))
    return found.select("path", _found(F.col("h")).alias("h")).select("path", "h.*")


def has_any(tokens: Sequence[str]):
    """A row is a header when one of its cells is one of these labels."""
    return lambda labels: F.arrays_overlap(labels, F.array(*[F.lit(t) for t in tokens]))


def table_rows(
    grid: DataFrame, is_header, max_scan: int, first_sheet_only: bool = False
) -> DataFrame:
    """(path, row_no, header, cells): the rows below the header on its sheet, blank rows left out.

    The header reaches its rows through a window over the workbook, so that a workbook is
    decoded once; the size of a workbook is bounded by its format.
    """
    book = Window.partitionBy("path")
    first = F.min(_header_row(is_header, max_scan, first_sheet_only)).over(book)
    filled = F.exists("cells", lambda c: stripped(c).isNotNull())
    same_sheet = F.col("sheet_no") == F.col("h.sheet_no")
    return (
        grid.where(filled)
        .withColumn("h", first)
        .withColumn("h", _found(F.col("h")))
        .where(same_sheet & (F.col("row_no") > F.col("h.row_no")))
        .select("path", "row_no", "h.header", "cells")
    )


def cell_at(
    exact: str | None,
    contains: Sequence[str] = (),
    excluding: Sequence[str] = (),
    starts: str | None = None,
    required: bool = True,
) -> Column:
    """The cell under a header label: the exact label, else the first one that fits.

    A label fits when it contains all of ``contains`` and none of ``excluding``, or
    starts with ``starts``. Without such a column the job fails, or the cell is null
    when it is not required.
    """
    labels = F.col("header")
    found: list[Column] = []
    if exact is not None:
        found.append(F.nullif(F.array_position(labels, exact), F.lit(0)))
    if contains or starts:

        def fits(label: Column) -> Column:
            ok = label.startswith(starts) if starts else F.lit(True)
            for part in contains:
                ok = ok & label.contains(part)
            for part in excluding:
                ok = ok & ~label.contains(part)
            return ok

        found.append(F.nullif(F.array_position(F.transform(labels, fits), True), F.lit(0)))
    if required:
        wanted = exact or " ".join(contains) or starts
        found.append(
            F.raise_error(F.concat(F.lit(f"column not found: {wanted} in "), "path"))
        )
    return F.try_element_at("cells", F.coalesce(*found).cast("int"))


def read_grant_awards(grid: DataFrame) -> DataFrame:
    """(path, recipient, cents, published): every award row of the grant reports.

    The header lies below a title and a block of criteria, on the first sheet. A row is
    an award when it has an award id (or, in reports without that column, a value).
    ``recipient`` is null for recipients without an 11-digit key; such rows count towards
    a report's size but cannot be joined.
    """

    def is_header(labels: Column) -> Column:
        return F.array_contains(labels, "recipient abn") & F.exists(
            labels, lambda c: c.startswith("value")
        )

    rows = table_rows(grid, is_header, 40, first_sheet_only=True)
    value = cell_at(None, starts="value")
    has_ids = F.array_contains("header", "ga id")
    cells = rows.select(
        "path",
        F.when(has_ids, cell_at("ga id", required=False)).otherwise(value).alias("marker"),
        value.alias("value"),
        digits(cell_at("recipient abn")).alias("key"),
        cell_at("publish date", required=False).alias("day"),
    )
    blank = stripped(F.col("value")).isNull()
    dollars = F.when(blank, F.lit(0.0)).otherwise(clean_number(F.col("value")))
    return cells.where(stripped(F.col("marker")).isNotNull()).select(
        "path",
        F.when(has_digits(F.col("key"), 11), F.col("key")).alias("recipient"),
        to_cents(dollars).alias("cents"),
        sheet_date(F.col("day")).alias("published"),
    )
