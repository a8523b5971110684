"""Readers by format name; feeds can add their own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierline.functions.names import BLOCK_START, FILE_NAME, FILE_PATH, SCAN_ORDER, SYSTEM
from tierline.sources.delimited import read_csv, read_delimited
from tierline.sources.fixed_width import read_fixed_width
from tierline.sources.json_records import read_json_records
from tierline.sources.xml_records import read_xml_records

Reader = Callable[..., DataFrame]
#: What readers add themselves.
_ADDED = (FILE_PATH, FILE_NAME, BLOCK_START, SCAN_ORDER)

READERS: dict[str, Reader] = {
    "csv": read_csv,
    "delimited": read_delimited,
    "fixed_width": read_fixed_width,
    "json": read_json_records,
    "xml": read_xml_records,
}


def register_reader(name: str, reader: Reader) -> None:
    """Makes ``reader(spark, path, **options)`` available as a format."""
    READERS[name] = reader


def read_records(spark: SparkSession, fmt: str, path: str | list[str], **options: object) -> DataFrame:
    if fmt not in READERS:
        raise ValueError(f"no reader for format {fmt!r}; known: {', '.join(sorted(READERS))}")
    found = READERS[fmt](spark, path, **options)
    # Columns that would be taken for those a row carries about its file, and be left out of silver.
    names = found.columns
    taken = sorted({n for n in names if n.startswith("_dq_") or (n in SYSTEM and (n not in _ADDED or names.count(n) > 1))})
    if taken:
        raise ValueError(f"the files hold columns with reserved names: {', '.join(taken)}")
    return found
