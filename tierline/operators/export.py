"""Optional table export for analytics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tierline.operators.tables import path_exists


@dataclass(frozen=True)
class ExportResult:
    table: str
    row_count: int
    created: bool


def export_table(df: DataFrame, table: str, *, enabled: bool = True, location: str | None = None) -> ExportResult:
    """Creates ``namespace.table`` on the first export and appends to it afterwards.

    With ``location`` the table is a parquet folder below it; otherwise it is written
    through the session catalog, in whatever table format that is configured for.
    """
    if not enabled:
        raise ValueError("this export is not enabled")
    namespace, dot, name = table.rpartition(".")
    if not dot or not namespace or not name:
        raise ValueError(f"export table must be namespace.table, got {table!r}")
    spark = df.sparkSession
    if location is not None:
        folder = f"{location.rstrip('/')}/{namespace.replace('.', '/')}/{name}"
        created = not path_exists(spark, folder)
        before = 0 if created else spark.read.parquet(folder).count()
        df.write.mode("append").parquet(folder)
        return ExportResult(table, spark.read.parquet(folder).count() - before, created)
    created = not spark.catalog.tableExists(table)
    before = 0 if created else spark.table(table).count()
    if created:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
        df.writeTo(table).create()
    else:
        df.writeTo(table).append()
    return ExportResult(table, spark.table(table).count() - before, created)
