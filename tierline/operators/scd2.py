"""Slowly changing dimensions, type 2: versions with validity instead of overwrites."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.names import col
from tierline.functions.text import surrogate_key

HISTORY = ["version", "effective_datetime", "expiry_datetime", "active_flag", "scd_pk"]


def _version_rows(df: DataFrame, key: list[str], tracked: list[str], version: Column, now: Column) -> DataFrame:
    return df.select(
        *[col(k) for k in key], *[col(t) for t in tracked],
        version.cast("int").alias("version"), now.alias("effective_datetime"),
        F.lit(None).cast("timestamp").alias("expiry_datetime"), F.lit(True).alias("active_flag"),
        surrogate_key([col(k) for k in key], version.cast("int")).alias("scd_pk"),
    )


def _without_null_keys(snapshot: DataFrame, key: list[str]) -> DataFrame:
    missing = reduce(lambda a, b: a | b, (col(k).isNull() for k in key))
    stop = F.raise_error(F.lit(f"NULL in a business key column of {key}")).cast("boolean")
    return snapshot.filter(F.when(missing, stop).otherwise(F.lit(True)))


def scd2_changes(
    target: DataFrame | None, snapshot: DataFrame, key: list[str], tracked: list[str], now: str
) -> DataFrame:
    """The rows a run writes: new versions, and the versions they expire.

    A key is written when it has no active version or any tracked column differs
    (NULL-safe). Unchanged keys give nothing and keys missing from the snapshot stay
    as they are. All joins are on the key, where each side has one row.
    """
    if not tracked or set(tracked) & set(key):
        raise ValueError("tracked columns must be given and differ from the key")
    at = F.lit(now).cast("timestamp")
    current = _without_null_keys(snapshot.select(*[col(c) for c in key + tracked]), key)
    if target is None:
        return _version_rows(current, key, tracked, F.lit(1), at)

    active = target.filter("active_flag").select(
        *[col(k) for k in key],
        F.struct(*[col(t) for t in tracked], *[F.col(h) for h in HISTORY]).alias("__old"),
    )
    newest = target.groupBy(*[col(k) for k in key]).agg(F.max("version").alias("__newest"))
    old = F.col("__old")
    differs = reduce(lambda a, b: a | b, (~col(t).eqNullSafe(old.getField(t)) for t in tracked))
    changed = current.join(active, key, "left").filter(old.isNull() | differs).join(newest, key, "left")

    version = (F.coalesce("__newest", F.lit(0)) + 1).cast("int")
    fresh = F.struct(
        *[col(t) for t in tracked], version.alias("version"), at.alias("effective_datetime"),
        F.lit(None).cast("timestamp").alias("expiry_datetime"), F.lit(True).alias("active_flag"),
        surrogate_key([col(k) for k in key], version).alias("scd_pk"),
    )
    expired = F.struct(
        *[old.getField(t).alias(t) for t in tracked], old["version"].alias("version"),
        old["effective_datetime"].alias("effective_datetime"), at.alias("expiry_datetime"),
        F.lit(False).alias("active_flag"), old["scd_pk"].alias("scd_pk"),
    )
    versions = F.array_compact(F.array(fresh, F.when(old.isNotNull(), expired)))
    return changed.select(*[col(k) for k in key], F.explode(versions).alias("__v")).select(
        *[col(k) for k in key],
        *[F.col("__v").getField(t).alias(t) for t in tracked],
        *[F.col("__v").getField(h).alias(h) for h in HISTORY],
    )


def scd2_merge(
    target: DataFrame | None, snapshot: DataFrame, key: list[str], tracked: list[str], now: str
) -> DataFrame:
    """The whole history table after a run; rows are replaced by their surrogate key."""
    changes = scd2_changes(target, snapshot, key, tracked, now)
    if target is None:
        return changes
    kept = target.join(changes.select("scd_pk"), "scd_pk", "left_anti")
    return kept.select(*[col(c) for c in changes.columns]).unionByName(changes)


def current_versions(history: DataFrame) -> DataFrame:
    return history.filter("active_flag")
