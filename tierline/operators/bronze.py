"""Landing files as text with their metadata, each content once."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.names import (
    BATCH_ID,
    BLOCK_START,
    FILE_CHECKSUM,
    FILE_NAME,
    FILE_PATH,
    LOAD_TIMESTAMP,
    METADATA,
    SCAN_ORDER,
    col,
    data_columns,
)
from tierline.functions.spread import attach_by_key, is_small, top_per_key
from tierline.operators.tables import partition_folders, path_exists, replace_batch
from tierline.sources.scan import Paths

# A file up to this size gets the SHA-256 of its bytes; larger ones are digested by line, in their order.
WHOLE_FILE_BYTES = 256 * 1024 * 1024
# Up to this size the bytes are one value, of which a task holds several copies; beyond it they are hashed as they are read.
_VALUE_BYTES = 16 * 1024 * 1024
# A prime and a base of the polynomial over the lines' hashes.
_PRIME = (1 << 255) - 19
_BASE = int.from_bytes(hashlib.sha256(b"lines").digest(), "big") % _PRIME
# Files of a gigabyte and more count as hot when file columns are joined to rows.
_HOT_FILE_BYTES = 1024 * 1024 * 1024


def line_digests(lines: DataFrame) -> DataFrame:
    """``file_path, checksum`` over ``file_path, block, value`` (bytes of the lines of each split, in order).

    A polynomial over the SHA-256 of the lines: splits are folded apart and joined in
    the order of their start, so the result depends on every line and its position but
    not on how the file was split.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, total = None, 0, 0
        done: list[tuple] = []
        for batch in batches:
            for path, block, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if key != (path, block):
                    if key is not None:
                        done.append((*key, n, total.to_bytes(32, "big")))
                    key, n, total = (path, block), 0, 0
                total = (total * _BASE + int.from_bytes(hashlib.sha256(value).digest(), "big")) % _PRIME
                n += 1
        if key is not None:
            done.append((*key, n, total.to_bytes(32, "big")))
        columns = list(zip(*done)) if done else [[]] * 4
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=[FILE_PATH, "block", "n", "part"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = []
            for parts in batch.column(1).to_pylist():
                n = total = 0
                for part in parts:
                    total = (total * pow(_BASE, part["n"], _PRIME) + int.from_bytes(part["part"], "big")) % _PRIME
                    n += part["n"]
                sums.append(f"{n}:{total:064x}")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums, pa.string())], names=[FILE_PATH, "checksum"])

    parts = lines.select(FILE_PATH, "block", F.col("value").cast("binary").alias("value")).mapInArrow(
        fold, f"{FILE_PATH} string, block long, n long, part binary"
    )
    of_file = parts.groupBy(FILE_PATH).agg(F.sort_array(F.collect_list(F.struct("block", "n", "part"))).alias("parts"))
    return of_file.mapInArrow(join, f"{FILE_PATH} string, checksum string")


def streamed_digests(spark: SparkSession, paths: list[str], most: int) -> DataFrame:
    """``file_path, file_checksum``: SHA-256 of the bytes of these files of at most ``most`` bytes, none of them packed.

    One task reads a file as lines, in their order, and holds one batch of them. The length of the
    file tells what the reader took away: the last terminator and a byte order mark (3 bytes).
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, read, plain, marked = None, 0, hashlib.sha256(), hashlib.sha256()
        done: list[tuple] = []

        def close() -> None:
            rest = key[1] - read
            if rest not in (-1, 0, 2, 3):
                raise ValueError(f"{key[0]} was not read as a whole: {read} of {key[1]} bytes")
            found = plain if rest <= 0 else marked
            if rest in (0, 3):
                found.update(b"\n")
            done.append((key[0], found.hexdigest()))

        for batch in batches:
            first = 0
            for end in pc.run_end_encode(batch.column(0)).run_ends.to_pylist():
                of = batch.column(0)[first].as_py(), batch.column(1)[first].as_py()
                lines = pa.ListArray.from_arrays(pa.array([first, end], pa.int32()), batch.column(2))
                text = pc.binary_join(lines, b"\n")[0].as_buffer()
                first = end
                if key != of:
                    if key is not None:
                        close()
                    key, read, plain, marked = of, 0, hashlib.sha256(), hashlib.sha256(b"\xef\xbb\xbf")
                else:
                    plain.update(b"\n")
                    marked.update(b"\n")
                plain.update(text)
                marked.update(text)
                read += text.size + 1
        if key is not None:
            close()
        columns = list(zip(*done)) if done else [[]] * 2
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in columns], names=[FILE_PATH, FILE_CHECKSUM])

    # How files are cut is a setting of the session that reads them: here none is, and each is a task.
    uncut = spark.newSession()
    for name in ("maxPartitionBytes", "openCostInBytes"):
        uncut.conf.set(f"spark.sql.files.{name}", str(most))
    lines = uncut.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias(FILE_PATH), F.col("_metadata.file_size").alias("length"), F.col("value").cast("binary").alias("value")
    )
    return lines.mapInArrow(digest, f"{FILE_PATH} string, {FILE_CHECKSUM} string")


def file_checksums(
    spark: SparkSession, path: Paths, *, whole_file_bytes: int = WHOLE_FILE_BYTES, value_bytes: int = _VALUE_BYTES
) -> DataFrame:
    """``file_path, file_checksum``: SHA-256 of the bytes.

    A file above ``value_bytes`` is hashed as it is read, unless it is packed, which Spark's line
    reader would unpack. A file above ``whole_file_bytes`` would keep one task busy for too long; it is
    digested by its lines in their order across its splits instead, marked with
    ``lines:``. Lines end at ``\\n`` only, and the length of the file enters too, which
    tells the last terminator and a byte order mark. Copies have the same length, so
    they always get the same kind of digest.
    """
    scan = spark.read.format("binaryFile").load(path)
    file_path = F.col("_metadata.file_path").alias(FILE_PATH)
    value_bytes = min(value_bytes, whole_file_bytes)

    def as_values(files: DataFrame) -> DataFrame:
        return files.select(file_path, F.sha2("content", 256).alias(FILE_CHECKSUM))

    whole = as_values(scan.filter(F.col("length") <= value_bytes))
    over = scan.filter(F.col("length") > value_bytes).select("path", "length").collect()
    # Names may hold what would be read as a pattern.
    big, middle = ([re.sub(r"([\\{}\[\]*?])", r"\\\1", r.path) for r in over if (r.length > whole_file_bytes) == kind] for kind in (True, False))
    if middle:
        jvm = spark._jvm
        codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
        packed = [p for p in middle if codecs.getCodec(jvm.org.apache.hadoop.fs.Path(p)) is not None]
        if packed:
            whole = whole.unionByName(as_values(spark.read.format("binaryFile").load(packed)))
        if plain := sorted({*middle} - {*packed}):
            whole = whole.unionByName(streamed_digests(spark, plain, whole_file_bytes))
    if not big:
        return whole
    large = scan.filter(F.col("length") > whole_file_bytes).select(file_path, "length")
    lines = spark.read.option("lineSep", "\n").text(big).select(file_path, F.col("_metadata.file_block_start").alias("block"), "value")
    digest = F.sha2(F.concat_ws(":", "length", "checksum"), 256)
    return whole.unionByName(
        line_digests(lines).join(large, FILE_PATH).select(FILE_PATH, F.concat(F.lit("lines:"), digest).alias(FILE_CHECKSUM))
    )


def checksum_dedup(
    manifest: DataFrame, landed: DataFrame | None, *, keys: list[str] | None = None, order: str = "sort_key"
) -> DataFrame:
    """Files whose content is new: not landed before, and the earliest copy in the batch.

    ``keys`` widens the identity, e.g. ``["pipeline", "file_checksum"]`` against a run
    log, where a content seen before counts whatever its outcome was.
    """
    identity = keys or [FILE_CHECKSUM]
    fresh = manifest
    if landed is not None:
        seen = landed.select(*[col(k) for k in identity]).distinct()
        fresh = manifest.join(seen, identity, "left_anti")
    return top_per_key(fresh, identity, [F.asc_nulls_last(order), F.asc(FILE_PATH)])


def run_dedup(manifest: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files to run, files already run with their existing ``run_id``) per pipeline and content."""
    keys = ["pipeline_name", FILE_CHECKSUM]
    to_run = checksum_dedup(manifest, runs, keys=keys)
    first = runs.groupBy(*keys).agg(F.min_by("run_id", "started_at").alias("run_id"))
    return to_run, manifest.join(first, keys, "inner")


def add_file_columns(rows: DataFrame, manifest: DataFrame, *, hot_bytes: int = _HOT_FILE_BYTES) -> DataFrame:
    """Rows with the checksum of their file. ``manifest`` should be a written table."""
    narrow = manifest.select(FILE_PATH, FILE_CHECKSUM, "length")
    if is_small(narrow):
        return rows.join(F.broadcast(narrow.drop("length")), FILE_PATH, "left")
    return attach_by_key(rows, narrow, [FILE_PATH], [FILE_CHECKSUM], rows="length", hot_rows=hot_bytes)


def bronze_frame(
    rows: DataFrame, manifest: DataFrame, *, batch_id: str, now: str, metadata: tuple[str, ...] = METADATA
) -> DataFrame:
    """Text columns plus the requested metadata and the scan position."""
    unknown = [m for m in metadata if m not in METADATA]
    if unknown:
        raise ValueError(f"unknown metadata columns: {unknown}")
    full = add_file_columns(rows, manifest) if FILE_CHECKSUM in metadata else rows
    values = {
        FILE_NAME: F.col(FILE_NAME), FILE_PATH: F.col(FILE_PATH), FILE_CHECKSUM: F.col(FILE_CHECKSUM),
        LOAD_TIMESTAMP: F.lit(now).cast("timestamp"), BATCH_ID: F.lit(batch_id),
    }
    # The file path and scan position always stay: later steps work per file.
    kept = [m for m in METADATA if m in metadata or m == FILE_PATH]
    return full.select(
        *[col(c).cast("string").alias(c) for c in data_columns(rows.columns)],
        *[values[m].alias(m) for m in kept],
        BLOCK_START, SCAN_ORDER,
    )


def land_bronze(
    rows: DataFrame,
    manifest: DataFrame,
    path: str,
    *,
    batch_id: str,
    now: str,
    metadata: tuple[str, ...] = METADATA,
) -> DataFrame:
    """Appends a batch to the bronze table and returns what was written.

    The table is partitioned by batch, so repeating a batch replaces its own rows
    instead of adding them twice.
    """
    frame = bronze_frame(rows, manifest, batch_id=batch_id, now=now, metadata=metadata)
    replace_batch(frame, path, BATCH_ID, batch_id)
    return read_batch(rows.sparkSession, path, batch_id)


def read_batch(spark: SparkSession, path: str, batch_id: str) -> DataFrame:
    """The rows of one batch; only its partition is read."""
    return spark.read.option("mergeSchema", False).parquet(path).filter(F.col(BATCH_ID) == batch_id)


def landed_checksums(spark: SparkSession, path: str, file_log: DataFrame | None, *, batch_id: str) -> DataFrame | None:
    """The contents that other batches landed, or None before the first batch.

    ``file_log`` has one row per landed file (``file_checksum, batch_id``), so bronze
    itself is not scanned. Only batches that stopped before they were logged are
    looked up there, each of them one partition.
    """
    if not path_exists(spark, path):
        return None
    present = set(partition_folders(spark, path, BATCH_ID))
    logged: set[str] = set()
    found = None
    if file_log is not None:
        # A batch that stopped between its log and bronze has landed nothing.
        others = file_log.filter((F.col(BATCH_ID) != batch_id) & F.col(BATCH_ID).isin(sorted(present)))
        # One id per batch, as many as there are partition folders.
        logged = {r[0] for r in others.select(BATCH_ID).distinct().collect()}
        found = others.select(FILE_CHECKSUM)
    open_batches = sorted(present - logged - {batch_id})
    if open_batches:
        rest = spark.read.parquet(path).filter(F.col(BATCH_ID).isin(open_batches)).select(FILE_CHECKSUM).distinct()
        found = rest if found is None else found.unionByName(rest)
    return found
