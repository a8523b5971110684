"""Exact top-k inner products over a bit-sliced index.

Rows are dealt into blocks of about ``BLOCK_ROWS``. A block keeps, for each dimension, one
bitmap of its rows for every bit of the (non-negative, shifted) component, and the same for
the sums over all subsets of four neighbouring dimensions. A query splits into its own bits:
for each bit the slices of the subsets it selects are added with bitmap arithmetic (ripple-carry
adders over whole bitmaps), and the sums are added by weight, the sign bit's negatively. The top
rows are then selected from the most significant slice downward; what is left when all slices
are used are ties, taken by smaller vec_id. So scores and order are exact.

Queries are a stated set, dealt in blocks to every block of rows; each block returns its best
``k`` per query, and the best of those are kept. Vectors that are null, empty or hold null or
non-finite components take no part; vectors meet those of their own length only. Repeated rows count once; rows
that share a vec_id but not the vector stay apart. Scores must fit in 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.functions.spread import materialize
from tierline.llm.common import partitions_for, query, read
from tierline.llm.hashing import slices

BLOCK_ROWS = 8192
QUERY_ROWS = 256
TOP = 20
_GROUP = 4  # dimensions whose subset sums are kept
_STEP = 4  # queries added at once


def quantized(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id, floor(scale * x) of every component, and the length; only vectors that take part."""
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), doubles.alias("v")).filter("v IS NOT NULL AND size(v) > 0 AND vec_id IS NOT NULL")
    return rows.filter(~bad).select("vec_id", F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x)).alias("q"), F.size("v").alias("dim")).distinct()


def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of two stacks of slices (least significant first); one slice more than the taller."""
    if len(a) < len(b):
        a, b = b, a
    out = np.empty((len(a) + 1, *a.shape[1:]), np.uint64)
    carry = None
    for i, x in enumerate(a):
        if i < len(b):
            y = b[i]
            half = x ^ y
            both = x & y
            if carry is None:
                out[i], carry = half, both
            else:
                np.bitwise_xor(half, carry, out=out[i])
                carry = both | (carry & half)
        elif carry is None:
            out[i] = x
        else:
            np.bitwise_xor(x, carry, out=out[i])
            carry = x & carry
    out[-1] = 0 if carry is None else carry
    return out


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a - b as two's complement; the last slice is the sign."""
    width = max(len(a), len(b)) + 1
    out = np.empty((width, *np.broadcast_shapes(a.shape[1:], b.shape[1:])), np.uint64)
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    carry = np.full(out.shape[1:], ones)
    zero = np.zeros(out.shape[1:], np.uint64)
    for i in range(width):
        x = a[i] if i < len(a) else zero
        y = ~b[i] if i < len(b) else zero ^ ones
        half = x ^ y
        out[i] = half ^ carry
        carry = (x & y) | (carry & half)
    return out


class Index:
    """Bit slices of a block of rows, in ascending vec_id."""

    def __init__(self, ids: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, values = ids[order], values[order]
        rows, dim = values.shape
        self.low = int(values.min())
        shifted = (values - self.low).astype(np.uint64)
        bits = max(1, int(shifted.max()).bit_length())
        self.words = -(-rows // 64)
        groups = -(-dim // _GROUP)
        padded = np.zeros((self.words * 64, groups * _GROUP), np.uint64)
        padded[:rows, :dim] = shifted
        planes = np.empty((bits, groups * _GROUP, self.words), np.uint64)
        for b in range(bits):
            plane = ((padded >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
            planes[b] = np.ascontiguousarray(np.packbits(plane.T, axis=1, bitorder="little")).view(np.uint64)
        planes = planes.reshape(bits, groups, _GROUP, self.words)
        # subset sums: slices x groups x subsets x words
        sums = np.zeros((bits + _GROUP, groups, 1 << _GROUP, self.words), np.uint64)
        for subset in range(1, 1 << _GROUP):
            lowest = (subset & -subset).bit_length() - 1
            total = add(sums[: bits + _GROUP - 1, :, subset & (subset - 1)], planes[:, :, lowest])
            sums[:, :, subset] = total[: bits + _GROUP]
        used = [i for i in range(len(sums)) if sums[i].any()]
        self.sums = sums[: (used[-1] + 1 if used else 1)]
        self.valid = np.packbits(np.arange(self.words * 64) < rows, bitorder="little").view(np.uint64)

    def scores(self, queries: np.ndarray) -> np.ndarray:
        """Slices of the inner products with the shifted rows (two's complement): slices x queries x words."""
        groups = self.sums.shape[1]
        n, dim = queries.shape
        padded = np.zeros((n, groups * _GROUP), np.int64)
        padded[:, :dim] = queries
        magnitude = int(np.abs(padded).max()) if padded.size else 0
        bits = magnitude.bit_length() + 1
        chosen = (padded[:, :, None] >> np.arange(bits)) & 1
        nibble = (chosen.reshape(n, groups, _GROUP, bits) << np.arange(_GROUP)[None, None, :, None]).sum(axis=2)
        parts = self.sums[:, np.arange(groups)[:, None, None], nibble.transpose(1, 2, 0)]  # slices, groups, bits, queries, words
        while parts.shape[1] > 1:
            if parts.shape[1] % 2:
                parts = np.concatenate([parts, np.zeros_like(parts[:, :1])], axis=1)
            parts = add(parts[:, ::2], parts[:, 1::2])
        by_bit = parts[:, 0]
        total = by_bit[:, bits - 2] if bits > 1 else np.zeros_like(by_bit[:, 0])
        for b in range(bits - 3, -1, -1):
            doubled = np.concatenate([np.zeros_like(total[:1]), total])
            total = add(doubled, by_bit[:, b])
        sign = np.concatenate([np.zeros((bits - 1, *by_bit.shape[2:]), np.uint64), by_bit[:, bits - 1]])
        return difference(total, sign)

    def top(self, ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each query its best rows: query number, vec_id, score."""
        slices_ = self.scores(queries)
        n = len(queries)
        left = np.repeat(self.valid[None], n, axis=0)
        own_from, own_to = np.searchsorted(self.ids, ids), np.searchsorted(self.ids, ids, "right")
        for q in np.flatnonzero(own_to > own_from):
            for r in range(own_from[q], own_to[q]):
                left[q, r >> 6] &= ~(np.uint64(1) << np.uint64(r & 63))
        taken = np.zeros_like(left)
        for i in range(len(slices_) - 1, -1, -1):
            plane = ~slices_[i] if i == len(slices_) - 1 else slices_[i]
            more = taken | (left & plane)
            size = np.bitwise_count(more).sum(axis=1)
            over = (size > k)[:, None]
            taken = np.where(over, taken, more)
            left = np.where(over, left & plane, np.where((size == k)[:, None], np.uint64(0), left & ~plane))
        missing = k - np.bitwise_count(taken).sum(axis=1).astype(np.int64)
        ties = np.unpackbits(np.ascontiguousarray(left).view(np.uint8), axis=1, bitorder="little")
        bits = np.unpackbits(np.ascontiguousarray(taken).view(np.uint8), axis=1, bitorder="little").astype(bool)
        bits |= (ties == 1) & (np.cumsum(ties, axis=1, dtype=np.int64) <= missing[:, None])
        query_no, row = np.nonzero(bits)
        score = np.zeros(len(row), np.int64)
        for i in range(len(slices_)):
            bit = ((slices_[i][query_no, row >> 6] >> (row & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
            score += (-bit if i == len(slices_) - 1 else bit) << min(i, 63)
        return query_no, self.ids[row], score + self.low * queries.sum(axis=1)[query_no]


def _matrix(part: pa.RecordBatch, column: int) -> np.ndarray:
    lists = part.column(column)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), -1)


_PACKED = "dim int, block int, kind int, ids binary, vectors binary"


def _blocks(rows: DataFrame, size: int, kind: int) -> DataFrame:
    """Rows of ``rows`` packed by hash into blocks of about ``size``; blocks of a dimension are numbered from 0."""
    counts = {r["dim"]: -(-r["n"] // size) for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}  # a number for each vector length
    of = F.create_map(*[F.lit(x) for item in counts.items() for x in item]) if counts else F.create_map(F.lit(0), F.lit(1))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "q"), of[F.col("dim")]).cast("int"))
    dealt = dealt.repartition(partitions_for(rows), "dim", "block").sortWithinPartitions("dim", "block", "vec_id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, vectors = None, [], []

        def flush() -> pa.RecordBatch:
            row = [[key[0]], [key[1]], [kind], [np.concatenate(ids).tobytes()], [np.concatenate(vectors).tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["dim", "block", "kind", "ids", "vectors"])

        for batch in batches:
            if not batch.num_rows:
                continue
            dims, blocks = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            cuts = np.flatnonzero((np.diff(dims) != 0) | (np.diff(blocks) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                now = (int(dims[a]), int(blocks[a]))
                if now != key:
                    if ids:
                        yield flush()
                    key, ids, vectors = now, [], []
                piece = batch.slice(a, b - a)
                ids.append(piece.column(0).to_numpy().astype(np.int64))
                vectors.append(_matrix(piece, 1))
        if ids:
            yield flush()

    return dealt.select("vec_id", "q", "dim", "block").mapInArrow(pack, _PACKED)


FOUND = "query_id long, query_key long, vec_id long, score long"


def top_k(vectors: DataFrame, queries: DataFrame, *, k: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score; both sides as from ``quantized``."""
    rows = materialize(vectors, "vectors")
    asked = materialize(queries, "queries")
    index = _blocks(rows, BLOCK_ROWS, 0)
    numbers = materialize(index, "index")
    of_queries = materialize(_blocks(asked, QUERY_ROWS, 1), "asked")
    # Every block of queries goes to every block of rows of its vector length.
    last = numbers.groupBy("dim").agg(F.max("block").alias("last"))
    sent = of_queries.join(last, "dim").select("dim", F.explode(F.sequence(F.lit(0), "last")).alias("to"), F.col("block").alias("part"), "kind", "ids", "vectors")
    held = numbers.select("dim", F.col("block").alias("to"), F.lit(0).alias("part"), "kind", "ids", "vectors")
    dealt = held.unionByName(sent)
    dealt = dealt.repartition(partitions_for(dealt), "dim", "to").sortWithinPartitions("dim", "to", "kind", "part")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for batch in slices(batches, "vectors", 1 << 20):
            for dim, kind, ids, vectors in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4, 5))):
                ids, values = np.frombuffer(ids, np.int64), np.frombuffer(vectors, np.int64).reshape(-1, dim)
                if kind == 0:
                    index = Index(ids, values)
                    continue
                found = []
                for a in range(0, len(ids), _STEP):
                    query_no, vec, score = index.top(ids[a : a + _STEP], values[a : a + _STEP], k)
                    found.append((query_no + a, vec, score))
                number, vec, score = (np.concatenate(x) for x in zip(*found))
                with np.errstate(over="ignore"):
                    keys = (values * (np.arange(dim, dtype=np.int64) * 2 + 0x5DEECE66D)).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[number], keys[number], vec, score)], names=["query_id", "query_key", "vec_id", "score"])

    found = dealt.select("dim", "to", "part", "kind", "ids", "vectors").mapInArrow(search, FOUND)
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


OP1_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
    SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""


@query("op1_top_k", OP1_SQL)
def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantized(read(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.filter("vec_id % 20 = 0"))
