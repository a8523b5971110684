"""What the operators' queries share: tables, identity of rows, registration."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.spread import materialize

ROW = "__row"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers ``fn(spark, sf_dir)`` under ``name``, with its SQL where there is one."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The whole text as a string; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def partitions_for(df: DataFrame) -> int:
    """As many shuffle partitions as the session asks for."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame) -> DataFrame:
    """``df`` written with a number of each row: null and reused ids do not tell rows apart."""
    return materialize(df.withColumn(ROW, F.monotonically_increasing_id()), "rows")
