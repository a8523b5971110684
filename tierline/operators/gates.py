"""Whole-file gates: size and row count, before anything is landed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.sources.scan import Paths

Bounds = tuple[int, int]


def line_counts(spark: SparkSession, path: Paths) -> DataFrame:
    """Per file: number of lines, their bytes and whether the first one ends in CR.

    Lines are cut at ``\\n`` only, so their number is the newline count plus one for
    an unterminated last line. Files are split, counted in part and summed up.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.octet_length("value").cast("long").alias("bytes"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
            F.endswith("value", F.lit("\r")).alias("cr"),
        ).alias("place"),
    )
    return lines.groupBy("file_path").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("bytes").alias("line_bytes"), F.min("place")["cr"].alias("first_has_cr")
    )


def fixed_width_rows(length: Column, record_length: int, lines: Column, line_bytes: Column, first_has_cr: Column) -> Column:
    """Rows by arithmetic: bytes over record length plus terminator (0, 1 or 2 bytes)."""
    no_newline = (lines <= 1) & (line_bytes == length)
    terminator = F.when(no_newline, 0).when(first_has_cr, 2).otherwise(1)
    return F.floor(length / (F.lit(record_length) + terminator))


def control_gates(
    manifest: DataFrame,
    counts: DataFrame | None,
    *,
    size: Bounds,
    rows: Bounds,
    fmt: str,
    columns: list[tuple[str, int, int]] | None = None,
    header: bool = True,
    exact: bool = False,
) -> DataFrame:
    """The manifest with ``row_count``, ``failures`` and ``passed`` per file.

    ``counts`` comes from :func:`line_counts`; with None only sizes are tested. Fixed-width rows follow from the file
    size unless ``exact`` asks for counted lines; a header counts for delimited text
    only. All bounds are tested, so one file can carry several messages.
    """
    if size[0] > size[1] or rows[0] > rows[1]:
        raise ValueError("gate bounds need lower <= upper")
    if counts is None:
        joined = manifest.select(
            "*", F.lit(None).cast("long").alias("lines"), F.lit(None).cast("long").alias("line_bytes"),
            F.lit(None).cast("boolean").alias("first_has_cr"),
        )
    else:
        joined = manifest.join(counts, "file_path", "left")
    lines = F.coalesce("lines", F.lit(0))
    if fmt == "fixed_width" and not exact:
        if not columns:
            raise ValueError("the fixed-width row gate needs columns")
        counted = fixed_width_rows(
            F.col("length"), max(end for _, _, end in columns), lines,
            F.coalesce("line_bytes", F.lit(0)), F.coalesce("first_has_cr", F.lit(False)),
        )
    elif fmt in ("csv", "delimited") and header:
        counted = F.greatest(lines - 1, F.lit(0))
    else:
        counted = lines
    counted = F.when(F.col("length") == 0, F.lit(0)).otherwise(counted).cast("long")
    if counts is None:
        counted = F.lit(None).cast("long")
    size_col, rows_col = F.col("length"), F.col("row_count")
    failures = F.array_compact(
        F.array(
            F.when(size_col < size[0], F.format_string(f"file_size %d below min_bytes {size[0]}", size_col)),
            F.when(size_col > size[1], F.format_string(f"file_size %d above max_bytes {size[1]}", size_col)),
            F.when(rows_col < rows[0], F.format_string(f"row_count %d below min_rows {rows[0]}", rows_col)),
            F.when(rows_col > rows[1], F.format_string(f"row_count %d above max_rows {rows[1]}", rows_col)),
        )
    )
    return (
        joined.withColumn("row_count", counted)
        .withColumn("failures", failures)
        .withColumn("passed", F.size("failures") == 0)
        .drop("lines", "line_bytes", "first_has_cr")
    )
