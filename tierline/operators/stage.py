"""Write modes of the silver layer and merges by business key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.names import col
from tierline.functions.spread import materialize, same_key, scratch_folders, top_per_key
from tierline.operators.tables import SnapshotTable, path_exists


def latest_per_key(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the last one in ``order``. NULL keys never match, so all of them stay."""
    complete = ~F.greatest(*[col(k).isNull() for k in key], F.lit(False))
    return top_per_key(df.filter(complete), key, order).unionByName(df.filter(~complete))


def merge_upsert(
    target: DataFrame | None, source: DataFrame, key: list[str], *, order: list[Column] | None = None
) -> DataFrame:
    """``target`` with the rows of ``source`` replacing those of equal key.

    ``order`` sorts best-first where several files of a batch carry the same key;
    without it ``source`` must be unique on the key.
    """
    incoming = latest_per_key(source, key, order) if order else source
    if target is None:
        return incoming
    incoming = incoming.select(*[col(c) for c in target.columns])
    return target.join(incoming.select(*[col(k) for k in key]), key, "left_anti").select(
        *[col(c) for c in target.columns]
    ).unionByName(incoming)


def insert_missing(target: DataFrame | None, seed: DataFrame, key: list[str]) -> DataFrame:
    """The seed rows whose key is not in ``target`` yet; existing rows are never touched."""
    once = seed.dropDuplicates(key)
    return once if target is None else once.join(target.select(*[col(k) for k in key]).distinct(), key, "left_anti")


def upsert_table(table, df: DataFrame, key: list[str], *, order: list[Column] | None = None) -> None:
    """Upsert into a table that knows how (by bucket), else into a new snapshot of the whole table."""
    own = getattr(table, "upsert", None)
    if own is not None:
        own(df, key, order=order)
    else:
        table.replace(merge_upsert(table.read(), df, key, order=order))


def write_stage(
    df: DataFrame, table: SnapshotTable, mode: str, *, key: list[str] | None = None, order: list[Column] | None = None,
    batch_id: str | None = None,
) -> DataFrame:
    """``append``, ``truncate_load`` or ``upsert`` into a silver table.

    A ``batch_id`` makes appends repeatable; the other modes are by themselves.
    """
    if mode == "append":
        table.append(df, batch_id=batch_id)
    elif mode == "truncate_load":
        table.replace(df)
    elif mode == "upsert":
        if not key:
            raise ValueError("upsert needs a business key")
        upsert_table(table, df, key, order=order)
    else:
        raise ValueError(f"unsupported write mode {mode!r}")
    return table.read()


def upsert_partitions(
    df: DataFrame, path: str, key: list[str], partition_by: list[str], *, order: list[Column] | None = None,
    current: DataFrame | None = None,
) -> None:
    """Upsert that rewrites only the partitions the batch touches.

    For tables partitioned by part of the business key, such as a date: a key cannot
    change its partition, so all others stay untouched. The merged rows are written
    to the shared folder first, because a path cannot be read and replaced at once;
    repeating the call after a failure gives the same table.
    """
    spark = df.sparkSession
    if not set(partition_by) <= set(key):
        raise ValueError("partition columns must belong to the business key")
    odd = [p for p in partition_by if not isinstance(df.schema[p].dataType, (T.DateType, T.IntegerType, T.LongType))]
    if odd:
        # Folder names carry no types; texts such as 007 would come back as numbers.
        raise ValueError(f"partition columns must be dates or whole numbers: {odd}")
    merged = latest_per_key(df, key, order) if order else df
    with scratch_folders(spark):
        if current is not None or path_exists(spark, path):
            current = spark.read.parquet(path) if current is None else current
            # NULL is a partition like any other and is overwritten as one.
            touched = merged.select(*[col(p).alias(f"__touched_{i}") for i, p in enumerate(partition_by)]).distinct()
            on = same_key([col(p) for p in partition_by], [F.col(f"__touched_{i}") for i in range(len(partition_by))])
            merged = merge_upsert(current.join(touched, on, "left_semi"), merged, key)
        merged = materialize(merged, "upsert")
        if _fits_partitions(merged, partition_by):
            merged = merged.repartition(*[col(p) for p in partition_by])
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def _fits_partitions(df: DataFrame, partition_by: list[str], limit: int = 5_000_000) -> bool:
    """Whether every partition value holds few enough rows for one writing task."""
    largest = df.groupBy(*[col(p) for p in partition_by]).count().agg(F.max("count").alias("n")).first()
    return (largest.n or 0) <= limit


def merge_into(df: DataFrame, table: str, key: list[str]) -> None:
    """The same upsert as ``MERGE INTO`` where the catalog's table format supports it."""
    columns = {f"`{c}`": F.col(f"s.`{c}`") for c in df.columns}
    updates = {c: v for c, v in columns.items() if c.strip("`") not in key}
    builder = df.alias("s").mergeInto(table, F.expr(" AND ".join(f"{table}.`{k}` = s.`{k}`" for k in key)))
    builder.whenMatched().update(updates).whenNotMatched().insert(columns).merge()

