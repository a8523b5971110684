"""Readers for landed files. Every data column comes back as text.

Each reader also adds the file columns and the scan order that
:func:`tierline.operators.rows.with_row_index` turns into row positions.
"""

from tierline.sources.delimited import read_csv, read_delimited
from tierline.sources.files import (
    file_manifest,
    list_files,
    match_file_pattern,
    require_matches,
    select_files,
    unmatched_files,
)
from tierline.sources.fixed_width import read_fixed_width
from tierline.sources.json_records import read_json_records
from tierline.sources.registry import READERS, read_records, register_reader
from tierline.sources.tables import sample_table, staging_view
from tierline.sources.xml_records import flatten_record, read_xml_records

__all__ = [
    "READERS", "file_manifest", "flatten_record", "list_files", "match_file_pattern", "read_csv",
    "read_delimited", "read_fixed_width", "read_json_records", "read_records", "read_xml_records",
    "register_reader", "require_matches", "sample_table", "select_files", "staging_view",
    "unmatched_files",
]
