"""Position of a row in its file."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions.names import BLOCK_START, FILE_PATH, ROW_INDEX, SCAN_ORDER
from tierline.functions.spread import estimated_bytes, materialize

# One row per file split; this bound is checked against the written table.
_BLOCK_TABLE_BYTES = 256 * 1024 * 1024


def with_row_index(rows: DataFrame) -> DataFrame:
    """Adds ``_row_index``, the 0-based position of each row in its file.

    The scan numbers rows inside a split; the position is the number of rows in the
    earlier splits of the file plus that. Only the per-split counts are aggregated,
    so one huge file is never ordered in a single task. ``rows`` must be a landed
    table (or a single scan), so the split columns cannot change between reads.
    """
    blocks = rows.groupBy(FILE_PATH, BLOCK_START).agg(
        F.min(SCAN_ORDER).alias("__first"), F.count(F.lit(1)).alias("__rows")
    )
    earlier = Window.partitionBy(FILE_PATH).orderBy(BLOCK_START).rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        FILE_PATH, BLOCK_START, (F.coalesce(F.sum("__rows").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift")
    )
    starts = materialize(starts, "blocks")
    if estimated_bytes(starts) <= _BLOCK_TABLE_BYTES:
        starts = F.broadcast(starts)
    return (
        rows.join(starts, [FILE_PATH, BLOCK_START], "left")
        .withColumn(ROW_INDEX, F.col(SCAN_ORDER) + F.col("__shift"))
        .drop("__shift")
        .select(*[F.col("`" + c + "`") for c in rows.columns], ROW_INDEX)
    )
