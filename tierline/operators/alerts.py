"""Data-quality alerts as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.names import FILE_NAME, FILE_PATH, ROW_INDEX, col
from tierline.operators.checks import REASONS


def gate_alerts(gated: DataFrame) -> DataFrame:
    """One alert per file that failed a gate, with every failed bound."""
    return gated.filter(~F.col("passed")).select(
        FILE_NAME,
        F.lit(None).cast("long").alias("row_index"),
        F.concat(
            F.col(FILE_NAME), F.lit(": file quarantined at control gate - "), F.array_join("failures", "; ")
        ).alias("message"),
    )


def row_alerts(bad: DataFrame, integrity_mode: str, *, reasons: str = REASONS, row_index: str = ROW_INDEX) -> DataFrame:
    """``strict``: one alert per file with failing rows; otherwise one per failing row."""
    if integrity_mode == "strict":
        per_file = bad.groupBy(FILE_PATH, FILE_NAME).agg(F.count(F.lit(1)).alias("n"))
        return per_file.select(
            FILE_NAME,
            F.lit(None).cast("long").alias("row_index"),
            F.format_string(
                "%s: entire file quarantined (strict integrity_mode) - %d row(s) failed DQ", F.col(FILE_NAME), F.col("n")
            ).alias("message"),
        )
    return bad.select(
        FILE_NAME,
        col(row_index).cast("long").alias("row_index"),
        F.concat(
            F.col(FILE_NAME), F.lit(": row "), col(row_index).cast("string"), F.lit(" quarantined - "),
            F.array_join(reasons, "; "),
        ).alias("message"),
    )
