"""Token-id files: frequency-ranked ids in a byte-aligned variable-length code.

The more frequent an id is in the corpus, the smaller the number that stands for it. Numbers
are written as groups of four: one control byte holds four 2-bit lengths, the data bytes
follow in a stream of their own. A table over the 256 control bytes gives lengths and sums,
so numpy decodes a block without a loop over ids. A file is a folder of Parquet parts, whose rows
are blocks of whole documents in ascending doc_id order; beside it lies the table of ranks.

Null and empty texts hold the end id only. Repeated rows are written once each, side by side.
Only ``doc_id`` and ``text`` are read. A null doc_id comes first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.functions.spread import materialize, new_folder
from tierline.llm.common import partitions_for, query, read
from tierline.llm.hashing import slices, text_bytes
from tierline.llm.tokens import encoder, with_end

END = 1
BLOCK_TOKENS = 1 << 18

_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1  # bytes of each of the four numbers of a control byte


def encode_numbers(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes."""
    n = len(numbers)
    padded = np.zeros(-(-n // 4) * 4, np.uint32)
    padded[:n] = numbers
    size = 1 + (padded > 0xFF) + (padded > 0xFFFF).astype(int) + (padded > 0xFFFFFF)
    codes = (size - 1).reshape(-1, 4).astype(np.uint8)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    used = np.arange(4) < size[:, None]
    used[n:] = False
    return control.astype(np.uint8).tobytes(), padded.astype("<u4").view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_numbers(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    start = np.cumsum(size) - size
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(4, np.uint8)]).astype(np.uint32)
    out = raw[start]
    for k in (1, 2, 3):
        longer = np.flatnonzero(size > k)
        out[longer] |= raw[start[longer] + k] << np.uint32(8 * k)
    return out


def _pack(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The ids of each row as little-endian integers of 2 or 4 bytes."""
    if ids.max(initial=0) <= 0xFFFF and bounds[-1] < 1 << 30:
        at = pa.py_buffer((2 * bounds).astype(np.int32))
        return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, at, pa.py_buffer(ids.astype("<u2"))])
    rows = (ids[a:b] for a, b in zip(bounds, bounds[1:]))
    return pa.array([x.astype("<u4" if len(x) and x.max() > 0xFFFF else "<u2").tobytes() for x in rows], pa.binary())


TOKENS = "doc_id long, n long, ids binary"


def tokenized(documents: DataFrame, vocabulary: str, end: int) -> DataFrame:
    """doc_id, number of ids with the end id, and the ids as little-endian integers of 2 or 4 bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = encoder(vocabulary)
        for part in slices(batches, "text", 4 << 20):
            ids, bounds = with_end(*to_ids.encode(part.column(1)), end)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(bounds), pa.int64()), _pack(ids, bounds)], names=["doc_id", "n", "ids"]
            )

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(work, TOKENS)


def unpack(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4")


def unpack_all(ids: pa.Array, n: np.ndarray) -> np.ndarray:
    """The ids of all rows one after the other."""
    data, at = text_bytes(ids)
    wide = np.diff(at) != 2 * n
    if not wide.any():
        return data.view("<u2")
    return np.concatenate([data[a:b].view("<u4" if w else "<u2") for a, b, w in zip(at, at[1:], wide)])


def frequencies(tokens: DataFrame) -> DataFrame:
    """id and how often it occurs; each task sends at most one row for each id of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            ids = unpack_all(batch.column(1), batch.column(0).to_numpy())
            for a in range(0, len(ids), 1 << 20):  # counting makes 8 bytes of each id
                got = np.bincount(ids[a : a + (1 << 20)])
                if len(got) > len(total):
                    total = np.pad(total, (0, len(got) - len(total)))
                total[: len(got)] += got
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    return tokens.select("n", "ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


BLOCKS = "shard int, block int, docs array<long>, sizes array<long>, n long, control binary, data binary"


def write_token_file(documents: DataFrame, folder: str, vocabulary: str, *, end: int = END, block: int = BLOCK_TOKENS) -> None:
    """Writes ``folder/ranks`` (ids by falling frequency) and ``folder/blocks``."""
    spark = documents.sparkSession
    tokens = materialize(tokenized(documents, vocabulary, end), "tokens")
    counted = frequencies(tokens)
    # One row an id of the vocabulary, whatever the size of the corpus.
    order = np.array([r[0] for r in sorted(counted.collect(), key=lambda r: (-r[1], r[0]))], np.int64)
    rank = np.zeros(int(order.max()) + 1 if len(order) else 1, np.uint32)
    rank[order] = np.arange(len(order))
    shared = spark.sparkContext.broadcast(rank)
    spark.createDataFrame([(order.astype("<u4").tobytes(),)], "ids binary").coalesce(1).write.parquet(f"{folder}/ranks")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, number = TaskContext.get().partitionId(), 0
        docs: list = []
        sizes: list[int] = []
        held: list[np.ndarray] = []
        total = 0

        def flush() -> pa.RecordBatch:
            control, data = encode_numbers(shared.value[np.concatenate(held)])
            row = [[shard], [number], [docs], [sizes], [total], [control], [data]]
            kinds = (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=["shard", "block", "docs", "sizes", "n", "control", "data"])

        for batch in batches:
            n = batch.column(1).to_numpy()
            ids, ends, first = unpack_all(batch.column(2), n), np.cumsum(n), 0
            while first < len(n):
                before = ends[first - 1] if first else 0
                # Up to the document that fills the block.
                last = min(int(np.searchsorted(ends, before + block - total)) + 1, len(n))
                docs += batch.column(0)[first:last].to_pylist()
                sizes += n[first:last].tolist()
                held.append(ids[before : ends[last - 1]])
                total += int(ends[last - 1] - before)
                first = last
                if total >= block:
                    yield flush()
                    number, docs, sizes, held, total = number + 1, [], [], [], 0
        if docs:
            yield flush()

    ordered = tokens.repartitionByRange(partitions_for(tokens), "doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(pack, BLOCKS).write.parquet(f"{folder}/blocks")


READ = "doc_id long, start long, n_tokens long, ids binary"


def read_token_file(spark: SparkSession, folder: str, measure=None, schema: str = "ids binary") -> DataFrame:
    """doc_id, start, n_tokens and, from the decoded ids of each document, what ``measure`` makes of them (an Arrow array).

    Without ``measure`` the ids themselves, as little-endian unsigned 32-bit integers.
    """
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    ids = np.frombuffer(spark.read.parquet(f"{folder}/ranks").first()[0], "<u4")  # at most the vocabulary
    shared = spark.sparkContext.broadcast(ids)
    # Shards are partitions of the writer, so their number is small; blocks are ordered within their shard.
    shards = blocks.groupBy("shard").agg(F.sum("n").alias("total"), F.min(F.get("docs", F.lit(0))).alias("first"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shard_start = shards.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("shard", "block", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("block_start")).join(shard_start, "shard")
    placed = blocks.join(starts.select("shard", "block", (F.col("shard_start") + F.col("block_start")).alias("start")), ["shard", "block"])
    take = measure or (lambda parts: pa.array([p.tobytes() for p in parts], pa.binary()))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", schema.split()[0]]
        for batch in batches:
            for docs, sizes, n, control, data, start in zip(*(c.to_pylist() for c in batch.columns)):
                got = shared.value[decode_numbers(control, data, n)]
                ends = np.cumsum(sizes)
                parts = np.split(got, ends[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(ends - sizes + start, pa.int64()), pa.array(sizes, pa.int64()), take(parts)], names=names
                )

    return placed.select("docs", "sizes", "n", "control", "data", "start").mapInArrow(decode, f"doc_id long, start long, n_tokens long, {schema}")


def crc32_of(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([zlib.crc32(p.astype("<u4", copy=False).tobytes()) for p in parts], pa.int64())


@query("op2_token_files")
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = new_folder(spark, "token-file")
    write_token_file(read(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_file(spark, folder, crc32_of, "ids_crc32 long")
