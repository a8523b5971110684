"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.spread import materialize

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers ``fn(spark, folder)``; ``sql`` is left out where there is no SQL form."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def landed(df: DataFrame) -> DataFrame:
    """``df`` as a written table, as bronze is when rows are checked.

    A test table is one row group and would be read by one task; where the scan has
    fewer parts than there are cores, the rows are spread over all of them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return materialize(df.repartition(cores) if df.rdd.getNumPartitions() < cores else df, "landed")


def money(name: str, scale: int = 2) -> Column:
    """A double column as exact decimal."""
    return F.col(name).cast(f"decimal(18,{scale})")


def joined(reasons: str) -> Column:
    return F.array_join(reasons, ";")
