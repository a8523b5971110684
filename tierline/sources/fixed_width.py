"""Fixed-width text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.text import stripped
from tierline.sources.scan import Paths, file_columns, in_scan_order


def read_fixed_width(
    spark: SparkSession, path: Paths, columns: list[tuple[str, int, int]]
) -> DataFrame:
    """Character slices ``(name, start, end)``, 1-based and inclusive, stripped.

    Blank lines are left out; a line that ends early gives empty text. Large files
    are split by Spark at line ends, so one file is parsed by many tasks.
    """
    if not columns:
        raise ValueError("fixed-width files need columns as (name, start, end)")
    lines = spark.read.text(path).select("value", *file_columns()).filter(stripped(F.col("value")) != "")
    fields = [
        stripped(F.substring("value", start, end - start + 1)).alias(name) for name, start, end in columns
    ]
    return in_scan_order(lines.select(*fields, "file_path", "file_name", "_block_start"))
