"""Delimited text and CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.names import col
from tierline.sources.scan import Paths, file_columns, in_scan_order

# Fixed value: a marker no feed sends, so an unquoted empty cell is NULL while a
# quoted empty cell stays an empty text.
_NO_NULL_MARKER = "\u0001"
_RECORD = "__record"


def _too_many_fields(record: Column, n_columns: int, sep: str, quote: str) -> Column:
    """Whether a record flagged by the parser holds more fields than the header."""
    q = f"\\x{ord(quote):02x}"
    unquoted = F.regexp_replace(record, f"{q}[^{q}]*{q}", "")
    return F.size(F.split(unquoted, f"\\Q{sep}\\E", -1)) > n_columns


def read_delimited(
    spark: SparkSession,
    path: Paths,
    *,
    sep: str = ",",
    quote: str = '"',
    header: bool = True,
    columns: list[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Rows of delimited files as text.

    Quotes are escaped by doubling. Without a header the columns are ``column_1``
    and so on. Rows with fewer fields are filled with NULL, rows with more fields
    stop the read, and so does a file whose header differs from the others.
    ``multi_line`` allows line breaks in quotes at the price of unsplit files.
    """
    options = dict(
        sep=sep, quote=quote, escape=quote, header=header, multiLine=multi_line,
        nullValue=_NO_NULL_MARKER, emptyValue="", encoding="UTF-8",
    )
    if columns is None:
        # Reads the first line only; no type inference.
        found = spark.read.options(**options, inferSchema=False).csv(path).columns
        columns = found if header else [f"column_{i}" for i in range(1, len(found) + 1)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns + [_RECORD]])
    scanned = (
        spark.read.schema(schema)
        .options(**options, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=_RECORD)
        .csv(path)
        .select(*[col(c) for c in columns], _RECORD, *file_columns())
    )
    overflow = F.col(_RECORD).isNotNull() & _too_many_fields(F.col(_RECORD), len(columns), sep, quote)
    checked = scanned.filter(
        F.when(~overflow, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("more fields than columns in "), F.col("file_name"), F.lit(": "), F.col(_RECORD)))
            .cast("boolean")
        )
    )
    return in_scan_order(checked.drop(_RECORD))


def read_csv(
    spark: SparkSession, path: Paths, *, quote: str = '"', header: bool = True,
    columns: list[str] | None = None, multi_line: bool = False, **_ignored: str,
) -> DataFrame:
    """Comma-separated files; a configured separator is not used."""
    return read_delimited(
        spark, path, sep=",", quote=quote, header=header, columns=columns, multi_line=multi_line
    )
