"""Packing of documents into fixed-length sequences.

Documents are dealt to random groups of about ``GROUP_TOKENS`` tokens. Within a group, full
sequences are cut off the front of long documents; what is left is packed first-fit decreasing:
a tournament tree over the bins' free places finds the first bin that takes a piece in
logarithmic time. Bins that stay open are emptied into each other by cutting, and the last
one is cut at powers of two, so no sequence needs padding.

Null and empty texts hold the end id only. Repeated rows are packed once each. Only ``doc_id``
and ``text`` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import partitions_for, query, read
from tierline.llm.token_files import tokenized, unpack

CAPACITY = 4096
END = 2
GROUP_TOKENS = 1 << 21


class Tournament:
    """First bin with at least a given number of free places: a tree whose inner nodes hold the larger child."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.width = 1 << max(0, (bins - 1).bit_length())
        self.tree = [capacity] * (2 * self.width)

    def first(self, need: int) -> int:
        node, tree, width = 1, self.tree, self.width
        while node < width:
            node *= 2
            if tree[node] < need:
                node += 1
        return node - width

    def take(self, bin_: int, amount: int) -> int:
        """Takes places of a bin and returns how many were taken before."""
        tree, node = self.tree, bin_ + self.width
        free = tree[node]
        tree[node] = free - amount
        node //= 2
        while node:
            best = tree[2 * node] if tree[2 * node] >= tree[2 * node + 1] else tree[2 * node + 1]
            if tree[node] == best:
                break
            tree[node] = best
            node //= 2
        return free


def plan(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one group's documents by their lengths."""
    pieces, rest, sequence = [], [], 0
    for doc, n in enumerate(lengths):
        full = n // capacity
        for k in range(full):
            pieces.append((doc, k * capacity, capacity, sequence, 0))
            sequence += 1
        if n % capacity:
            rest.append((n % capacity, doc, full * capacity))
    rest.sort(key=lambda r: (-r[0], r[1]))
    tree = Tournament(max(1, len(rest)), capacity)
    bins: list[list[tuple[int, int, int]]] = []
    for length, doc, start in rest:
        at = tree.first(length)
        tree.take(at, length)
        if at == len(bins):
            bins.append([])
        bins[at].append((doc, start, length))
    loose = []
    for content in bins:
        used = sum(p[2] for p in content)
        if used == capacity:
            offset = 0
            for doc, start, length in content:
                pieces.append((doc, start, length, sequence, offset))
                offset += length
            sequence += 1
        else:
            loose.append((used, content))
    # Fullest first: the places left in a bin go to the front of what the emptiest holds.
    loose.sort(key=lambda b: -b[0])
    stream = [p for _, content in loose for p in content]
    total = sum(p[2] for p in stream)
    sizes = [capacity] * (total // capacity) + [1 << b for b in range(capacity.bit_length(), -1, -1) if (total % capacity) >> b & 1]
    i, used = 0, 0
    for size in sizes:
        offset = 0
        while offset < size:
            doc, start, length = stream[i]
            part = min(length - used, size - offset)
            pieces.append((doc, start + used, part, sequence, offset))
            offset += part
            used += part
            if used == length:
                i, used = i + 1, 0
        sequence += 1
    return pieces


PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(documents: DataFrame, vocabulary: str, *, end: int = END, capacity: int = CAPACITY, group: int = GROUP_TOKENS, measure=None, schema="ids binary") -> DataFrame:
    """Pieces with their place; ``measure`` makes an Arrow array of the pieces' ids (without it, the ids as 32-bit integers)."""
    bytes_ = documents.select(F.sum(F.octet_length(F.col("text").cast("string"))).alias("b")).first()["b"] or 0
    groups = max(1, -(-int(bytes_) // (2 * group)))  # a token spans about two to three bytes
    tokens = tokenized(documents, vocabulary, end)
    dealt = tokens.withColumn("group", F.pmod(F.xxhash64("doc_id", F.crc32("ids"), F.lit(17)), F.lit(groups)))
    dealt = dealt.repartition(partitions_for(dealt), "group").sortWithinPartitions("group", "doc_id")
    take = measure or (lambda parts: pa.array([p.astype("<u4").tobytes() for p in parts], pa.binary()))

    def flush(key: int, rows: list[tuple]) -> pa.RecordBatch:
        ids = [unpack(r[2], r[1]) for r in rows]
        placed = plan([len(x) for x in ids], capacity)
        doc, start, length, sequence, offset = zip(*placed)
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[d][0] for d in doc], pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
             take([ids[d][s : s + n] for d, s, n in zip(doc, start, length)]), pa.array([rows[d][1] for d in doc], pa.int64()),
             pa.array([(key << 32) + s for s in sequence], pa.int64()), pa.array(offset, pa.int64())],
            names=["doc_id", "start", "length", schema.split()[0], "doc_tokens", "sequence_id", "offset"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            for doc, n, ids, g in zip(*(c.to_pylist() for c in batch.columns)):
                if g != key:
                    if rows:
                        yield flush(key, rows)
                    key, rows = g, []
                rows.append((doc, n, ids))
        if rows:
            yield flush(key, rows)

    return dealt.select("doc_id", "n", "ids", "group").mapInArrow(work, PIECES.replace("ids binary", schema))


def crc32_of(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([zlib.crc32(p.astype("<u4").tobytes()) for p in parts], pa.int64())


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), measure=crc32_of, schema="ids_crc32 long")
