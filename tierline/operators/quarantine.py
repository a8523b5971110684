"""Quarantined rows and files as tables, and the correct-and-resubmit loop."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.names import FILE_NAME, FILE_PATH, ROW_INDEX, col, data_columns
from tierline.operators.bucket_table import BucketTable
from tierline.operators.checks import FAILED, REASONS, Rule, apply_casts, check_rows, original_row
from tierline.operators.stage import upsert_table
from tierline.operators.tables import SnapshotTable, replace_batch

_BINARY_BYTES = 512 * 1024 * 1024
_CHUNK_BYTES = 1024 * 1024


def quarantine_rows(bad: DataFrame, *, pipeline_name: str, batch_id: str, now: str) -> DataFrame:
    """Failing rows as quarantine records: original text, reasons, position and time.

    A record is a file. Files of one name in several folders get the digest of their path in their ids.
    """
    shared = (
        bad.groupBy(FILE_NAME).agg(F.min(FILE_PATH).alias("__first"), F.max(FILE_PATH).alias("__last"))
        .filter(F.col("__first") != F.col("__last")).select(col(FILE_NAME), F.lit(True).alias("__shared"))
    )
    apart = F.when(F.col("__shared"), F.concat(F.lit("."), F.left(F.md5(FILE_PATH), F.lit(12)))).otherwise("")
    return bad.join(shared, FILE_NAME, "left").select(
        F.lit(pipeline_name).alias("pipeline_name"),
        F.concat(F.col(FILE_NAME), apart, F.lit("." + batch_id)).alias("quarantine_id"),
        FILE_NAME,
        FILE_PATH,
        F.lit(batch_id).alias("batch_id"),
        F.col(ROW_INDEX).alias("row_index"),
        original_row(bad).alias("row_data"),
        F.col(REASONS).alias("reasons"),
        F.lit(now).cast("timestamp").alias("quarantined_at"),
    )


def quarantine_json(records: DataFrame) -> DataFrame:
    """One JSON object per record with the four agreed fields, NULLs kept."""
    at = F.date_format("quarantined_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("quarantined_at")
    payload = F.to_json(F.struct("row_index", "row_data", "reasons", at), {"ignoreNullFields": "false"})
    return records.select("pipeline_name", "quarantine_id", "row_index", payload.alias("value"))


def file_chunks(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file_path, block, position, chunk`` of these files.

    The chunks of a file in the order of block and position are its bytes. They are cut at
    ``\\n`` and at ``_CHUNK_BYTES``, split over many tasks. Of a compressed file they are the
    text in it, each line terminated, because Spark's reader unpacks it.
    """
    key = F.col("_metadata.file_path").alias(FILE_PATH)
    text = spark.read.option("lineSep", "\n").text(paths)
    lines = text.select(key, F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))
    sizes = spark.read.format("binaryFile").load(paths).select(key, "length")
    ends = lines.groupBy(FILE_PATH).agg(F.sum(F.length("value") + F.lit(1)).alias("size"), F.max("block").alias("last"))
    # What the reader took away: a byte order mark (3 bytes); what it did not: a terminator of the last line.
    tails = {r[FILE_PATH]: (r["last"], r["length"] - r["size"]) for r in ends.join(sizes, FILE_PATH).collect()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, at, held = None, 0, None
        out: list[tuple] = []

        def put(value: bytes) -> None:
            nonlocal at
            for first in range(0, len(value), _CHUNK_BYTES):
                out.append((*key, at, value[first : first + _CHUNK_BYTES]))
                at += 1

        def close() -> None:
            last, extra = tails[key[0]]
            put(held if key[1] == last and extra in (-1, 2) else held + b"\n")

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[]] * 4
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())
            made = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=[FILE_PATH, "block", "position", "chunk"])
            out.clear()
            return made

        for batch in batches:
            for path, block, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if key == (path, block):
                    put(held + b"\n")
                else:
                    if key is not None:
                        close()
                    key, at = (path, block), 0
                    if block == 0 and tails[path][1] in (2, 3):
                        value = b"\xef\xbb\xbf" + value
                held = value
            yield batch_of()
        if key is not None:
            close()
            yield batch_of()

    return lines.mapInArrow(cut, f"{FILE_PATH} string, block long, position long, chunk binary")


def quarantine_files(
    spark: SparkSession, gated: DataFrame, path: str, *, now: str, pipeline_name: str, batch_id: str, binary_bytes: int = _BINARY_BYTES
) -> int:
    """Keeps the bytes of files that failed a gate; returns how many there were.

    Files too large for one value are kept as chunks of their bytes, split over many tasks.
    """
    failed = gated.filter(~F.col("passed"))
    names = failed.select("path", "length").collect()
    if not names:
        return 0
    record = failed.select(
        F.lit(pipeline_name).alias("pipeline_name"), F.lit(batch_id).alias("batch_id"), FILE_PATH, FILE_NAME,
        "failures", F.lit(now).cast("timestamp").alias("quarantined_at"),
    )
    small = [r.path for r in names if r.length <= binary_bytes]
    large = [r.path for r in names if r.length > binary_bytes]
    key = F.col("_metadata.file_path").alias(FILE_PATH)
    if small:
        content = spark.read.format("binaryFile").load(small).select(key, "content")
        replace_batch(record.join(content, FILE_PATH, "inner"), f"{path}/files", "batch_id", batch_id)
    if large:
        replace_batch(file_chunks(spark, large), f"{path}/chunks", "batch_id", batch_id)
        large_records = record.join(gated.filter(F.col("length") > binary_bytes).select(FILE_PATH), FILE_PATH, "left_semi")
        replace_batch(large_records, f"{path}/large_files", "batch_id", batch_id)
    return len(names)


def with_status(records: DataFrame, resolved: DataFrame | None) -> DataFrame:
    """Records with ``status``: resolved ones stay in the table and are only marked."""
    if resolved is None:
        return records.withColumn("status", F.lit("pending"))
    done = resolved.select("pipeline_name", "quarantine_id").distinct().withColumn("__done", F.lit(True))
    return records.join(done, ["pipeline_name", "quarantine_id"], "left").withColumn(
        "status", F.when(F.col("__done"), "resolved").otherwise("pending")
    ).drop("__done")


def list_quarantine(records: DataFrame, resolved: DataFrame | None = None, *, pipeline_name: str | None = None) -> DataFrame:
    """Pending quarantine records with their row counts, by name.

    Rows are counted before the resolved ids are taken out, so only one row per
    record is joined.
    """
    scoped = records if pipeline_name is None else records.filter(F.col("pipeline_name") == pipeline_name)
    counted = scoped.groupBy("pipeline_name", "quarantine_id", FILE_NAME).agg(F.count(F.lit(1)).alias("row_count"))
    if resolved is not None:
        counted = counted.join(resolved.select("pipeline_name", "quarantine_id").distinct(), ["pipeline_name", "quarantine_id"], "left_anti")
    return counted.orderBy("pipeline_name", "quarantine_id")


def read_quarantine(records: DataFrame, quarantine_id: str, *, pipeline_name: str | None = None) -> DataFrame:
    """The rows of one record."""
    rows = records.filter(F.col("quarantine_id") == quarantine_id)
    return rows if pipeline_name is None else rows.filter(F.col("pipeline_name") == pipeline_name)


def quarantine_summary(records: DataFrame, resolved: DataFrame | None = None) -> DataFrame:
    """Pending records and rows per pipeline; pipelines without any do not appear."""
    return list_quarantine(records, resolved).groupBy("pipeline_name").agg(
        F.count(F.lit(1)).alias("pending_records"), F.sum("row_count").alias("pending_rows")
    )


def mark_resolved(table: SnapshotTable, *, pipeline_name: str, quarantine_id: str, now: str) -> None:
    row = [(pipeline_name, quarantine_id, now)]
    resolved = table.spark.createDataFrame(row, "pipeline_name string, quarantine_id string, at string")
    table.append(resolved.withColumn("resolved_at", F.col("at").cast("timestamp")).drop("at"))


def corrections_from(records: DataFrame, columns: list[str]) -> DataFrame:
    """Quarantined rows as a frame of text columns, ready to be corrected."""
    return records.select("row_index", *[F.col("row_data")[c].alias(c) for c in columns])


def check_corrections(
    corrections: DataFrame,
    rules: list[Rule],
    key: list[str],
    *,
    lookups: Mapping[str, tuple[DataFrame, str]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(typed rows, failures by original row index). No group is swept here."""
    checked = check_rows(
        corrections, rules, lookups=lookups, business_key=key, file_columns=[], row_index="row_index"
    )
    failures = checked.filter(FAILED).select("row_index", F.col(REASONS).alias("reasons"))
    return apply_casts(checked.filter(~F.col(FAILED)).drop(REASONS, FAILED, "row_index"), rules), failures


@dataclass(frozen=True)
class Resubmission:
    accepted: bool
    failures: DataFrame | None
    layer_reached: str | None
    error: str | None = None


def resubmit(
    corrections: DataFrame,
    rules: list[Rule],
    key: list[str],
    stage: SnapshotTable | BucketTable,
    resolved: SnapshotTable,
    *,
    pipeline_name: str,
    quarantine_id: str,
    now: str,
    lookups: Mapping[str, tuple[DataFrame, str]] | None = None,
    refresh_gold: Callable[[], None] | None = None,
) -> Resubmission:
    """Checks corrected rows and, only if all of them pass, upserts them into silver.

    The correction is a keyed fix whatever the write mode of the pipeline is. The
    record is then marked resolved, and gold is refreshed where a refresh is given;
    a failing refresh leaves the correction in silver and is reported.
    """
    if corrections.isEmpty():
        return Resubmission(False, None, None, "no rows submitted")
    valid, failures = check_corrections(corrections, rules, key, lookups=lookups)
    if not failures.isEmpty():
        return Resubmission(False, failures, None)
    current = stage.read()
    if current is not None:
        extra = [c for c in current.columns if c not in valid.columns]
        valid = valid.select(*[col(c) for c in valid.columns], *[F.lit(None).cast(current.schema[c].dataType).alias(c) for c in extra])
    upsert_table(stage, valid, key)
    mark_resolved(resolved, pipeline_name=pipeline_name, quarantine_id=quarantine_id, now=now)
    if refresh_gold is None:
        return Resubmission(True, None, "stage")
    try:
        refresh_gold()
    except Exception as problem:
        return Resubmission(True, None, "stage", str(problem))
    return Resubmission(True, None, "gold")
