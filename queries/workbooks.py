"""Write a small workbook, so that the workbook reader has something to read."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Sequence
from xml.sax.saxutils import escape, quoteattr

from pyspark import cloudpickle

# Travels to the executors with the job; they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_LINK = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def _cell(value) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, (int, float)):
        return f"<c><v>{value!r}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'


def encode_workbook(sheets: Sequence[tuple[str, Sequence[Sequence]]]) -> bytes:
    """Sheets as (name, rows of cells), top to bottom."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        listed, links = "", ""
        for n, (name, rows) in enumerate(sheets, start=1):
            listed += f'<sheet name={quoteattr(name)} sheetId="{n}" r:id="r{n}"/>'
            links += f'<Relationship Id="r{n}" Type="{_LINK}/worksheet" '
            links += f'Target="worksheets/sheet{n}.xml"/>'
            body = "".join(
                f'<row r="{at}">{"".join(_cell(v) for v in row)}</row>'
                for at, row in enumerate(rows, start=1)
            )
            book.writestr(
                f"xl/worksheets/sheet{n}.xml",
                f'<worksheet xmlns="{_MAIN}"><sheetData>{body}</sheetData></worksheet>',
            )
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{_MAIN}" xmlns:r="{_LINK}"><sheets>{listed}</sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{_PACKAGE}">{links}</Relationships>',
        )
    return out.getvalue()
