"""Shuffle helpers that hold when a single key owns a large share of the rows.

A window partitioned by a hot key puts every row of that key into one task. The
helpers here reduce per key first (partial aggregation runs before the shuffle)
and bring the result back to the rows: keys above ``hot_rows`` through a map-side
join, so their rows never move, everything else through an ordinary join. There
can be at most ``total rows / hot_rows`` hot keys, which bounds what is broadcast.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.functions.names import col

HOT_ROWS = 1_000_000
_KEY = "__key_{}"
_ROWS = "__key_rows"
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for local sessions without it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = "file:" + tempfile.mkdtemp(prefix="tierline-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    folder = f"{shared_folder(spark)}/tierline/{label}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(folder)
    return folder


@contextmanager
def scratch_folders(spark: SparkSession) -> Iterator[None]:
    """Removes the intermediate tables written inside the block when it ends."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        conf = spark._jsc.hadoopConfiguration()
        for folder in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def materialize(df: DataFrame, label: str, *, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts lineage in a way that survives lost executors, and makes every later
    branch read columns from parquet instead of repeating the work.
    """
    spark = df.sparkSession
    folder = new_folder(spark, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df``; an upper bound for scans with filters."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(raw) if raw != "-1" else -1


def is_small(df: DataFrame) -> bool:
    """Whether ``df`` is known to fit under the session's broadcast limit."""
    return estimated_bytes(df) <= broadcast_limit(df.sparkSession)


def same_key(left: list[Column], right: list[Column]) -> Column:
    """Null-safe equality, so NULL key values form a group as they do in a window."""
    return reduce(lambda a, b: a & b, (x.eqNullSafe(y) for x, y in zip(left, right)))


def attach_by_key(
    df: DataFrame,
    per_key: DataFrame,
    keys: list[str],
    values: list[str],
    *,
    rows: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``df`` left-joined to ``per_key`` (one row per key), adding ``values``.

    ``rows`` names the column of ``per_key`` that counts the rows of ``df`` with
    that key. ``df`` should be a scan or a materialized table: it is read twice.
    """
    names = [_KEY.format(i) for i in range(len(keys))]
    lookup = per_key.select(
        *[col(k).alias(n) for k, n in zip(keys, names)],
        *[col(v).alias("__v_" + v) for v in values],
        col(rows).alias(_ROWS),
    )
    outputs = [col(c) for c in df.columns] + [F.col("`__v_" + v + "`").alias(v) for v in values]
    on = same_key([col(k) for k in keys], [F.col(n) for n in names])

    # Both branches use the same columns of ``per_key``, so Spark aggregates it once.
    hot = F.broadcast(lookup.filter(F.col(_ROWS) >= hot_rows))
    hot_part = df.join(hot, on & (F.col(_ROWS) >= hot_rows), "inner").select(*outputs)

    spared = hot.select(
        *[F.col(n).alias("__hot" + n) for n in names],
        *[F.col("`__v_" + v + "`").alias("__hot_" + v) for v in values],
        F.col(_ROWS).alias("__hot_rows"),
    )
    spared_on = same_key([col(k) for k in keys], [F.col("__hot" + n) for n in names])
    cold = lookup.filter(F.col(_ROWS) < hot_rows)
    cold_outputs = [col(c) for c in df.columns] + [
        F.coalesce("`__hot_" + v + "`", "`__v_" + v + "`").alias(v) for v in values
    ]
    cold_part = (
        df.join(spared, spared_on, "left").filter(F.col("__hot_rows").isNull()).join(cold, on, "left").select(*cold_outputs)
    )
    return hot_part.unionByName(cold_part)


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1, *, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows per key in ``order``.

    Spark plans a rank filter as a group limit that already runs before the
    shuffle, so each map task sends at most ``n`` rows of a hot key.
    """
    name = rank or "__rank"
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order)
    ranked = df.withColumn(name, F.row_number().over(window)).filter(col(name) <= n)
    return ranked if rank else ranked.drop(name)


def trailing_frame(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    chunk: Column,
    lookback: int,
    measures: dict[str, Column],
    *,
    block_rows: int = 100_000,
) -> DataFrame:
    """Aggregates over the previous ``lookback`` rows of each key, in ``order``.

    The plain window would sort a whole key in one task. Here rows get their exact
    position from per-chunk counts (``chunk`` must grow with ``order``, e.g. the
    month of the order date), are cut into blocks of ``block_rows`` positions, and
    each block receives a copy of the ``lookback`` rows before it.
    """
    k = [col(c) for c in keys]
    chunked = df.withColumn("__chunk", chunk)
    sizes = chunked.groupBy(*k, "__chunk").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*k).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[col(c).alias(_KEY.format(i)) for i, c in enumerate(keys)],
        F.col("__chunk").alias("__c"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"),
    )
    local = Window.partitionBy(*k, F.col("__chunk")).orderBy(*[col(o) for o in order])
    on = same_key(
        [*k, F.col("__chunk")], [*[F.col(_KEY.format(i)) for i in range(len(keys))], F.col("__c")]
    )
    placed = (
        chunked.withColumn("__local", F.row_number().over(local) - 1)
        .join(offsets, on, "left")
        .withColumn("__pos", F.col("__offset") + F.col("__local"))
    )
    own = F.floor(F.col("__pos") / block_rows)
    reach = F.floor((F.col("__pos") + lookback) / block_rows)
    blocks = placed.withColumn("__own", own).withColumn("__block", F.explode(F.sequence(own, reach)))
    frame = Window.partitionBy(*k, F.col("__block")).orderBy("__pos").rowsBetween(-lookback, -1)
    out = blocks.select(
        *[col(c) for c in df.columns],
        F.col("__own"), F.col("__block"),
        *[m.over(frame).alias(name) for name, m in measures.items()],
    )
    return out.filter(F.col("__own") == F.col("__block")).drop("__own", "__block")
