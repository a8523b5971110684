"""Reading from tables that are already in place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.names import METADATA, SYSTEM, col


def staging_view(table: DataFrame, columns: dict[str, str]) -> DataFrame:
    """A renaming projection ``{source: name}`` over a silver table."""
    return table.select(*[col(source).alias(name) for source, name in columns.items()])


def sample_table(table: DataFrame, n: int = 500, *, seed: int | None = None) -> DataFrame:
    """``n`` random rows without file columns, as a distributed top-n over random numbers."""
    data = table.drop(*[c for c in table.columns if c in METADATA or c in SYSTEM])
    return data.orderBy(F.rand(seed)).limit(n)
