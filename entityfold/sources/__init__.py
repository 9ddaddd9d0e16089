"""Readers. Each returns a DataFrame and fails on malformed input instead of skipping it."""

from entityfold.sources.delimited import (
    bad_records,
    delimited_facts,
    first_bad_record,
    gate_quotes,
    gate_rectangular,
    numbered_records,
    open_records,
    ragged_records,
    read_delimited,
)
from entityfold.sources.ocds import read_ocds
from entityfold.sources.register_xml import (
    gate_whole_documents,
    read_register_xml,
    register_rows,
)
from entityfold.sources.snapshots import pick_snapshot, read_listing
from entityfold.sources.workbook import (
    cell_at,
    decode_workbooks,
    locate_header,
    read_grant_awards,
    read_workbook_grid,
    table_rows,
)

__all__ = [
    "bad_records",
    "cell_at",
    "decode_workbooks",
    "delimited_facts",
    "first_bad_record",
    "gate_quotes",
    "gate_rectangular",
    "gate_whole_documents",
    "locate_header",
    "numbered_records",
    "open_records",
    "pick_snapshot",
    "ragged_records",
    "read_delimited",
    "read_grant_awards",
    "read_listing",
    "read_ocds",
    "read_register_xml",
    "read_workbook_grid",
    "register_rows",
    "table_rows",
]
