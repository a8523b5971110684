"""The file columns every reader adds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.names import BLOCK_START, FILE_NAME, FILE_PATH, SCAN_ORDER

Paths = str | list[str]


def file_columns() -> list[Column]:
    """Where a row was read from; select these directly on the scan."""
    return [
        F.col("_metadata.file_path").alias(FILE_PATH),
        F.col("_metadata.file_name").alias(FILE_NAME),
        F.col("_metadata.file_block_start").alias(BLOCK_START),
    ]


def in_scan_order(df: DataFrame) -> DataFrame:
    """Adds a number that grows with the position inside one file split."""
    return df.withColumn(SCAN_ORDER, F.monotonically_increasing_id())
