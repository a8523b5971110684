"""What files are there, which of them belong to a feed and in which order."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.formats import spark_pattern
from tierline.functions.spread import top_per_key
from tierline.functions.text import last_path_element


class NoMatchingFiles(ValueError):
    """Nothing in the location belongs to the feed; ``unmatched`` is the listing of all that is there."""

    def __init__(self, message: str, unmatched: DataFrame):
        super().__init__(message)
        self.unmatched = unmatched


def _empty_files(spark: SparkSession, paths: list[str], recursive: bool) -> DataFrame:
    """Files of zero length, which Spark's file sources leave out of their listing."""
    jvm = spark._jvm
    rows = []
    for path in paths:
        pattern = jvm.org.apache.hadoop.fs.Path(path)
        fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
        for place in fs.globStatus(pattern) or []:
            found = fs.listFiles(place.getPath(), recursive)
            while found.hasNext():
                status = found.next()
                if status.getLen() > 0:
                    continue
                at = status.getPath()
                encoded = jvm.org.apache.spark.paths.SparkPath.fromPath(at).urlEncoded()
                rows.append((encoded, at.getName(), at.toString(), status.getModificationTime()))
    visible = [r for r in rows if not r[1].startswith(("_", "."))]
    made = spark.createDataFrame(visible, "file_path string, file_name string, path string, millis long")
    return made.select(
        "file_path", "file_name", "path", F.timestamp_millis("millis").alias("modified_at"), F.lit(0).cast("long").alias("length")
    )


def list_files(spark: SparkSession, path: str | list[str], *, recursive: bool = False) -> DataFrame:
    """One row per file. Reads no content: only the listing columns are selected."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", recursive)
        .load(path)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            last_path_element(F.col("path")).alias("file_name"),
            "path",
            F.col("modificationTime").alias("modified_at"),
            "length",
        )
    )
    return listed.unionByName(_empty_files(spark, [path] if isinstance(path, str) else path, recursive))


def pattern_regex(file_pattern: str) -> str:
    """``HOLDINGS_{date}.txt`` as an anchored regular expression with one group at most."""
    parts = re.split(r"\{\w+\}", file_pattern)
    if len(parts) > 2:
        raise ValueError(f"file pattern {file_pattern!r} may hold one {{token}} only")
    literals = [re.sub(r"([^\w])", r"\\\1", p) for p in parts]
    return "^" + "(.+?)".join(literals) + "$"


def match_file_pattern(name: Column, file_pattern: str) -> Column:
    """The token of a matching name (empty without a token), NULL where it does not match."""
    regex = pattern_regex(file_pattern)
    token = F.regexp_extract(name, regex, 1) if "(.+?)" in regex else F.lit("")
    return F.when(name.rlike(regex), token)


def file_sort_key(listing: DataFrame, file_pattern: str, *, order_by: str, ts_format: str | None, strict: bool) -> DataFrame:
    """Matching files with ``token`` and ``sort_key``.

    With ``strict`` a name whose token is no timestamp stops the job, otherwise
    such files are left out.
    """
    matched = listing.withColumn("token", match_file_pattern(F.col("file_name"), file_pattern)).filter(
        F.col("token").isNotNull()
    )
    if order_by == "arrival_time":
        return matched.withColumn("sort_key", F.col("modified_at"))
    if order_by != "filename_timestamp":
        raise ValueError(f"unknown order_by {order_by!r}")
    if not ts_format:
        raise ValueError("filename_timestamp needs ts_format")
    parsed = F.try_to_timestamp("token", F.lit(spark_pattern(ts_format)))
    if not strict:
        return matched.withColumn("sort_key", parsed).filter(F.col("sort_key").isNotNull())
    problem = F.concat(
        F.lit("file name "), F.col("file_name"), F.lit(f" has a token that is no {ts_format}: "), F.col("token")
    )
    return matched.withColumn(
        "sort_key", F.when(parsed.isNotNull(), parsed).otherwise(F.raise_error(problem).cast("timestamp"))
    )


def file_manifest(
    spark: SparkSession,
    path: str,
    file_pattern: str,
    *,
    order_by: str = "arrival_time",
    ts_format: str | None = None,
    strict: bool = True,
    recursive: bool = False,
) -> DataFrame:
    """The files of a feed with their sort key."""
    listing = list_files(spark, path, recursive=recursive)
    return file_sort_key(listing, file_pattern, order_by=order_by, ts_format=ts_format, strict=strict)


def select_files(manifest: DataFrame, mode: str, order: str = "asc", *, feed: list[str] | None = None) -> DataFrame:
    """``latest`` / ``earliest`` keep one file per feed, ``all`` keeps and orders them."""
    keys = feed or []
    if mode == "all":
        direction = F.desc if order == "desc" else F.asc
        return manifest.orderBy(*[F.col(k) for k in keys], direction("sort_key"), direction("file_path"))
    if mode not in ("latest", "earliest"):
        raise ValueError(f"unknown selection mode {mode!r}")
    direction = F.desc_nulls_last if mode == "latest" else F.asc_nulls_last
    scoped = manifest if keys else manifest.withColumn("__all", F.lit(0))
    best = top_per_key(scoped, keys or ["__all"], [direction("sort_key"), F.asc("file_path")])
    return best.drop("__all")


def unmatched_files(listing: DataFrame, file_pattern: str) -> DataFrame:
    """Files that are present but do not belong to the feed."""
    return listing.filter(match_file_pattern(F.col("file_name"), file_pattern).isNull())


def require_matches(listing: DataFrame, file_pattern: str, *, shown: int = 50) -> None:
    """Raises when no file belongs to the feed. The message names ``shown`` of those that are there and how many more there are."""
    if not listing.filter(match_file_pattern(F.col("file_name"), file_pattern).isNotNull()).isEmpty():
        return
    names = [r.file_name for r in listing.select("file_name").orderBy("file_name").limit(shown).collect()]
    more = listing.count() - len(names)
    rest = f" and {more} more" if more else ""
    hint = f" (present: {', '.join(names)}{rest})" if names else ""
    raise NoMatchingFiles(f"no file matches {file_pattern!r}{hint}", listing)
