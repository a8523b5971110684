"""Column-name helpers. Silver keeps source names, including dots and ``@``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Columns a row carries about the file it came from (never data columns).
FILE_NAME = "file_name"
FILE_PATH = "file_path"
FILE_CHECKSUM = "file_checksum"
LOAD_TIMESTAMP = "load_timestamp"
BATCH_ID = "batch_id"
BLOCK_START = "_block_start"
SCAN_ORDER = "_scan_order"
ROW_INDEX = "_row_index"

METADATA = (FILE_NAME, FILE_PATH, FILE_CHECKSUM, LOAD_TIMESTAMP, BATCH_ID)
SYSTEM = METADATA + (BLOCK_START, SCAN_ORDER, ROW_INDEX)


def quoted(name: str) -> str:
    """``name`` as one identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """A column by its literal name, so ``a.b`` is one column and not a struct field."""
    return F.col(quoted(name))


def data_columns(columns: list[str]) -> list[str]:
    """The columns that came out of the file itself."""
    return [c for c in columns if c not in SYSTEM and not c.startswith("_dq_")]
