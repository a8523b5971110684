"""Watching folders with Structured Streaming.

The stream carries file paths, not rows, so every format (also whole-document JSON
and XML) goes through the batch pipeline. The checkpoint remembers which files were
seen; bronze is partitioned by batch, so a replayed micro-batch replaces its own rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierline.operators.lineage import edges_from_events
from tierline.operators.tables import replace_batch
from tierline.plans.ingest import Feed, Warehouse, run_batch
from tierline.sources.files import match_file_pattern

_FILES = "path string, modificationTime timestamp, length long, content binary"


def name_glob(file_pattern: str) -> str:
    """The file pattern as a glob; the exact match follows on the name itself."""
    return re.sub(r"\{\w+\}", "*", file_pattern)


def file_stream(
    spark: SparkSession, path: str, file_pattern: str, *, max_files: int | None = None, archive_to: str | None = None
) -> DataFrame:
    """Arriving files of a feed as a streaming listing; contents are not read.

    ``archive_to`` lets Spark move files after the micro-batch that follows theirs.
    It moves every processed file, whatever its outcome was.
    """
    reader = (
        spark.readStream.format("binaryFile").schema(_FILES)
        .option("pathGlobFilter", name_glob(file_pattern))
        .option("maxFileAge", "36500d")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive_to:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_to)
    name = F.substring_index("path", "/", -1)
    return reader.load(path).select("path", "modificationTime", "length").filter(
        match_file_pattern(name, file_pattern).isNotNull()
    )


def stream_ingest(
    files: DataFrame,
    process: Callable[[list[str], str], None],
    checkpoint: str,
    *,
    query_name: str,
    available_now: bool = True,
    poll_seconds: int = 30,
) -> StreamingQuery:
    """Calls ``process(paths, batch_id)`` for every micro-batch of files.

    The batch id is the query name, a digest of the checkpoint and the micro-batch number: the
    same on a replay, another one for another checkpoint.
    Paths are listing metadata: Spark's own file source keeps them on the driver too.
    """

    origin = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def handle(batch: DataFrame, number: int) -> None:
        paths = [r.path for r in batch.select("path").orderBy("path").collect()]
        if paths:
            process(paths, f"{query_name}-{origin}-{number:08d}")

    writer = files.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).queryName(query_name)
    trigger = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{poll_seconds} seconds")
    return trigger.start()


def watch_and_ingest(
    spark: SparkSession,
    feed: Feed,
    path: str,
    house: Warehouse,
    checkpoint: str,
    *,
    clock: Callable[[], str],
    references: Mapping[str, tuple[DataFrame, str]] | None = None,
    available_now: bool = True,
    poll_seconds: int = 30,
    max_files: int | None = None,
    archive_to: str | None = None,
) -> StreamingQuery:
    """Runs the batch pipeline on files as they arrive.

    Names whose token is no timestamp are left out instead of stopping the watch.
    Corrections for keys sent before overwrite them where the feed upserts, and the
    feed's marts are rebuilt from the whole silver table.
    """

    def process(paths: list[str], batch_id: str) -> None:
        run_batch(spark, feed, paths, house, now=clock(), batch_id=batch_id, references=references, strict_names=False)

    return stream_ingest(
        file_stream(spark, path, feed.file_pattern, max_files=max_files, archive_to=archive_to),
        process, checkpoint, query_name=f"watch-{feed.name}", available_now=available_now, poll_seconds=poll_seconds,
    )


def stream_lineage_edges(
    spark: SparkSession, events_path: str, edges_path: str, checkpoint: str, *, available_now: bool = True
) -> StreamingQuery:
    """Appends the edges of steps that completed in a micro-batch of lineage events.

    Inputs may have come in earlier micro-batches, so the step's events are taken from
    the event table; only completed steps of this micro-batch are looked up.
    """
    schema = spark.read.parquet(events_path).schema

    def handle(batch: DataFrame, number: int) -> None:
        done = batch.filter(F.col("event_type") == "COMPLETE").select("run_id", "job").distinct()
        history = spark.read.schema(schema).parquet(events_path).join(done, ["run_id", "job"], "left_semi")
        replace_batch(edges_from_events(history), edges_path, "batch_no", str(number))

    writer = spark.readStream.schema(schema).parquet(events_path).writeStream.foreachBatch(handle)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()

