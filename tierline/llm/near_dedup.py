"""Near-duplicate documents by b-bit MinHash.

A document's set holds its distinct shingles of ``SHINGLE`` words, hashed to 64 bits.
Documents with the same set are one class, and one of them stands for it. Bands of
minima give candidate buckets; the low bits of all minima, packed, estimate the
similarity of a candidate pair from the number of equal slots, corrected for slots that
agree by chance. Pairs whose estimate lies more than 4.6 standard deviations below the
threshold or whose set sizes differ too much are dropped, all others are confirmed on the
full sets.

Buckets of up to ``ALL_PAIRS`` classes compare every pair. Larger ones compare all members
with a pivot, the member that shares most buckets with others, and join what is linked into
components; only members of different components meet in later rounds, which take sixteen times
the pivots of the round before, until no pair of different components in a bucket is left.
So a group of thousands of near copies costs a few comparisons per member. From the second
round on signatures of 4096 minima sort out members that are only loosely alike, and two
members meet in one of their common buckets only.

A pair at the threshold shares none of the 24 bands of 4 with probability 2e-8. The exact binomial
probability that its estimate falls short of the fixed slack is 1.5e-5 at a threshold of 0.85 and 1.2e-4 at 0.80.

Null and empty texts have an empty set and link with nothing. A text with fewer words than
a shingle is one shingle. Repeated rows are copies of each other, whatever their ids. Only ``doc_id``
and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.functions.names import col
from tierline.functions.spread import materialize
from tierline.llm.common import ROW, numbered, partitions_for, query, read
from tierline.llm.hashing import Words, mix, slices

SHINGLE = 3
PERCENT = 85
BANDS, ROWS = 24, 4
ALL_PAIRS = 16
PIECE = 64

_KEPT = np.ones(256, bool)
_KEPT[[0x20, *range(0x09, 0x0E)]] = False


@dataclass(frozen=True)
class Signature:
    """``slots`` minima of which ``bits`` bits are kept; ``slack`` is 4.6 standard deviations of the estimate."""

    slots: int
    bits: int
    slack: float

    def functions(self) -> tuple[np.ndarray, np.ndarray]:
        seeds = mix(np.arange(1, 1 + 2 * self.slots, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return seeds[::2] | np.uint64(1), seeds[1::2]


COARSE = Signature(BANDS * ROWS, 2, 0.2)
FINE = Signature(4096, 1, 0.04)
FINE_HEAD = Signature(512, 1, 0.11)


def shingle_sets(column: pa.Array, shingle: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    words = Words(column, _KEPT)
    full = words.grams(shingle)
    short = {n: words.grams(n) for n in range(1, shingle)}
    out = []
    for first, end in zip(words.rows, words.rows[1:]):
        n = end - first
        if n >= shingle:
            h = np.sort(full[first : end - shingle + 1])
            keep = np.ones(len(h), bool)
            keep[1:] = h[1:] != h[:-1]
            out.append(h[keep])
        else:
            out.append(short[n][first : first + 1] if n else full[:0])
    return out


def minima(hashes: np.ndarray, times: np.ndarray, plus: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over one set."""
    low = np.full(len(times), np.iinfo(np.uint64).max, np.uint64)
    step = max(1, (1 << 18) // len(times))
    for part in range(0, len(hashes), step):
        low = np.minimum(low, (hashes[part : part + step, None] * times + plus).min(axis=0))
    return low


def pack(low: np.ndarray, bits: int) -> np.ndarray:
    """The low bits (of the mixed minima) as 64-bit words, one plane after the other."""
    mixed = mix(low)
    planes = [np.packbits(((mixed >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)) for b in range(bits)]
    return np.concatenate([np.pad(p, (0, -len(p) % 8)).view(np.int64) for p in planes])


SIGNED = "doc_id long, n_shingles long, class binary, bands array<long>, signature array<long>"


def signatures(documents: DataFrame, shingle: int = SHINGLE, plan: Signature = COARSE) -> DataFrame:
    """Per row: set size, digest of the set, hash of each band and packed signature (null for an empty set)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times, plus = plan.functions()
        for part in slices(batches, "text"):
            sizes, digests, bands, packed = [], [], [], []
            for h in shingle_sets(part.column(1), shingle):
                sizes.append(len(h))
                if not len(h):
                    digests.append(None), bands.append(None), packed.append(None)
                    continue
                low = minima(h, times, plus)
                other = mix(h ^ np.uint64(0xA0761D6478BD642F))
                digests.append(np.array([h.sum(), other.sum(), len(h)], np.uint64).tobytes())
                keys = np.zeros(BANDS, np.uint64)
                for r in range(ROWS):
                    keys = mix(keys + low[r : BANDS * ROWS : ROWS] * np.uint64(0xD6E8FEB86659FD93))
                bands.append((keys ^ np.arange(BANDS, dtype=np.uint64)).view(np.int64))
                packed.append(pack(low, plan.bits))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(packed, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "class", "bands", "signature"],
            )

    return _texts(documents).mapInArrow(sign, SIGNED)


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def estimate(x: Column, y: Column, plan: Signature) -> Column:
    """Similarity from the slots whose bits are all equal, less those equal by chance."""
    if plan.bits == 1:
        differ = F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, d: n + d)
    else:
        words = -(-plan.slots // 64)
        differ = F.lit(0)
        for w in range(words):
            unequal = F.lit(0).cast("long")
            for b in range(plan.bits):
                unequal = unequal.bitwiseOR(F.get(x, F.lit(b * words + w)).bitwiseXOR(F.get(y, F.lit(b * words + w))))
            differ = differ + F.bit_count(unequal)
    chance = 1 / 2**plan.bits
    return (1 - differ / plan.slots - chance) / (1 - chance)


def confirm(pairs: DataFrame, texts: DataFrame, *, shingle: int, percent: int) -> DataFrame:
    """The pairs (x, y) whose full sets overlap enough. A hub's partners are dealt in pieces of ``PIECE``."""
    hub = F.struct("x", (F.xxhash64("y") % F.lit(1 << 20)).alias("h"))
    sizes = pairs.groupBy("x").agg(F.ceil(F.count(F.lit(1)) / PIECE).cast("int").alias("pieces"))
    dealt = pairs.join(sizes, "x").select("x", "y", F.pmod(hub["h"], "pieces").alias("piece"))
    partner = dealt.select(F.col("y").alias("doc_id"), "x", "piece", F.lit(1).alias("side"))
    center = dealt.select(F.col("x").alias("doc_id"), "x", "piece", F.lit(0).alias("side")).distinct()
    wanted = partner.unionByName(center).groupBy("doc_id").agg(F.collect_list(F.struct("x", "piece", "side")).alias("roles"))
    rows = texts.join(wanted, "doc_id").select(F.explode("roles").alias("r"), "doc_id", "text").select("r.x", "r.piece", "r.side", "doc_id", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for part in slices(batches, "text"):
            xs, ys = [], []
            columns = [part.column(i).to_pylist() for i in range(4)]
            for x, piece, side, doc, h in zip(*columns, shingle_sets(part.column(4), shingle)):
                if side == 0:
                    key, held = (x, piece), h
                elif key == (x, piece):
                    small, large = (h, held) if len(h) <= len(held) else (held, h)
                    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                    both = int((large[at] == small).sum())
                    if both and 100 * both >= percent * (len(h) + len(held) - both):
                        xs.append(x), ys.append(doc)
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array(ys, pa.int64())], names=["x", "y"])

    sorted_rows = rows.repartition(partitions_for(rows), "x", "piece").sortWithinPartitions("x", "piece", "side")
    return sorted_rows.mapInArrow(compare, "x long, y long")


def components(links: DataFrame, labels: DataFrame) -> DataFrame:
    """``labels`` (id, label) after joining the components of both ends of every link (x, y); the smallest label wins."""
    ends = links.select("x", "y")
    both = ends.unionByName(ends.select(F.col("y").alias("x"), F.col("x").alias("y")))
    tie = materialize(
        both.join(labels.withColumnRenamed("id", "x").withColumnRenamed("label", "a"), "x")
        .join(labels.withColumnRenamed("id", "y").withColumnRenamed("label", "b"), "y")
        .filter("a <> b").select("a", "b").distinct(), "ties",
    )
    names = tie.select(F.col("a").alias("id")).distinct().withColumn("root", F.col("id"))
    while True:
        # The smallest root among a node's neighbours and itself, then the root of that root.
        near = tie.join(names.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("root").alias("low"))
        lower = names.join(near.withColumnRenamed("a", "id"), "id", "left").select("id", "root", F.least("root", "low").alias("low"))
        jumped = lower.select("id", "root", "low").join(
            lower.select(F.col("id").alias("low"), F.col("low").alias("lowest")), "low"
        )
        new = materialize(jumped.select("id", F.col("lowest").alias("root"), (F.col("root") != F.col("lowest")).alias("moved")), "roots")
        names = new.select("id", "root")
        if new.filter("moved").isEmpty():
            break
    return labels.join(names.withColumnRenamed("id", "label"), "label", "left").select("id", F.coalesce("root", "label").alias("label"))


def near_duplicates(documents: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id of its component).

    Rows are linked by their own texts: an id that comes again with another text links nothing by itself,
    and rows without an id are linked by their texts like others (their component has the smallest id there is, or null).
    """
    rows = numbered(documents.select("doc_id", "text"))
    found = near_rows(rows.select(F.col(ROW).alias("doc_id"), "text"), **options).withColumnRenamed("doc_id", ROW)
    named = rows.select(ROW, "doc_id").join(found, ROW)
    smallest = named.groupBy("component_id").agg(F.min("doc_id").alias("smallest"))
    return named.join(smallest, "component_id").select("doc_id", "n_shingles", F.col("smallest").alias("component_id"))


def near_rows(
    documents: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT, all_pairs: int = ALL_PAIRS
) -> DataFrame:
    """As ``near_duplicates`` for rows whose ids are all different and not null."""
    signed = materialize(signatures(documents, shingle), "signed")
    classes = signed.filter("class IS NOT NULL").groupBy("class").agg(
        F.min_by(F.struct("bands", "signature", "n_shingles"), "doc_id").alias("s"), F.min("doc_id").alias("id")
    )
    members = classes.select("id", "class", "s.bands", F.struct(F.col("s.signature").alias("bits"), F.col("s.n_shingles").alias("n")).alias("s"))
    buckets = members.select("id", "s", F.posexplode("bands").alias("band", "bucket"))
    counts = buckets.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = materialize(buckets.join(counts, ["band", "bucket"]), "buckets")

    def close(x: Column, y: Column, plan: Signature) -> Column:
        return estimate(x, y, plan) >= percent / 100 - plan.slack

    def near(p: Column, q: Column) -> Column:
        return (100 * F.least(p["n"], q["n"]) >= percent * F.greatest(p["n"], q["n"])) & close(p["bits"], q["bits"], COARSE)

    # Buckets with the same members are one bucket.
    grouped = shared.filter(F.col("n") <= all_pairs).groupBy("band", "bucket").agg(F.sort_array(F.collect_list(F.struct("id", "s"))).alias("m"))
    alike = grouped.select(F.col("m"), F.col("m.id").alias("ids")).groupBy("ids").agg(F.first("m").alias("m"))
    pair = alike.select(F.posexplode("m").alias("i", "p"), "m").select("p", F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias("q"))
    small = pair.filter(near(F.col("p.s"), F.col("q.s"))).select(F.col("p.id").alias("x"), F.col("q.id").alias("y")).distinct()
    small = materialize(small, "pairs")
    labels = materialize(members.select("id", F.col("id").alias("label")).distinct(), "labels")

    large = shared.filter(F.col("n") > all_pairs)
    candidates = small.select(F.col("x").alias("doc_id")).union(small.select("y")).union(large.select("id")).distinct()
    texts = materialize(_texts(documents).join(candidates, "doc_id").dropDuplicates(["doc_id"]), "candidates")
    links = materialize(confirm(small, texts, shingle=shingle, percent=percent), "links")
    tested = links.limit(0)
    labels = materialize(components(links, labels), "labels")
    degrees = large.groupBy("id").agg(F.sum("n").alias("degree"))
    left = materialize(
        large.join(degrees, "id").join(labels, "id").select("band", "bucket", "id", "s", F.array().cast("array<long>").alias("fine"), F.array().cast("array<long>").alias("places"), "degree", "label"), "large"
    )
    pivots_a_round = 1

    def place(id_: str) -> Column:
        return F.struct((-F.col("degree")).alias("d"), F.hash(id_).alias("h"), F.col(id_).alias("i"))

    while True:
        mixed = left.groupBy("band", "bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi")
        left = materialize(left.join(mixed.drop("lo", "hi"), ["band", "bucket"]), "large")
        if left.isEmpty():
            break
        if pivots_a_round == 16:
            finer = signatures(texts.join(left.select(F.col("id").alias("doc_id")).distinct(), "doc_id"), shingle, FINE)
            finer = finer.select(F.col("doc_id").alias("id"), F.col("signature").alias("fine"))
            places = left.groupBy("id").agg(F.collect_set("bucket").alias("places"))
            left = materialize(left.drop("fine", "places").join(finer, "id").join(places, "id"), "large")
        first = Window.partitionBy("band", "bucket").orderBy(place("id"))
        pivots = left.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= pivots_a_round)
        pivots = materialize(
            pivots.select("band", "bucket", F.col("id").alias("x"), F.col("s").alias("xs"), F.col("fine").alias("xf"), F.col("places").alias("xo"), F.col("label").alias("xl"), place("id").alias("xp")), "pivots"
        )
        head = lambda c: F.slice(c, 1, FINE_HEAD.slots // 64)
        # Members of several common buckets meet in the smallest of them. It stays until one of the two was its pivot or all its members are one component.
        once = F.array_min(F.array_intersect("places", "xo")) == F.col("bucket")
        finer_too = F.lit(True) if pivots_a_round == 1 else once & close(head("fine"), head("xf"), FINE_HEAD) & close(F.col("fine"), F.col("xf"), FINE)
        # Two pivots meet once: the one that comes first asks the other.
        asked = left.join(pivots, ["band", "bucket"]).filter((F.col("xp") < place("id")) & (F.col("label") != F.col("xl")) & near(F.col("s"), F.col("xs")) & finer_too)
        asked = asked.select("x", F.col("id").alias("y")).distinct()
        asked = materialize(asked.join(tested, ["x", "y"], "left_anti"), "asked")
        tested = tested.unionByName(asked)
        links = materialize(confirm(asked, texts, shingle=shingle, percent=percent), "links")
        labels = materialize(components(links, labels), "labels")
        # A pivot has met all others of other components and leaves the bucket. Written, because the next round reads it twice.
        left = left.drop("label").join(pivots.select("band", "bucket", F.col("x").alias("id")), ["band", "bucket", "id"], "left_anti")
        left = materialize(left.join(labels, "id"), "remaining")
        pivots_a_round *= 16
    of_class = members.join(labels, "id").select("class", F.col("label").alias("component_id"))
    return signed.select("doc_id", "n_shingles", "class").join(of_class, "class", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one(documents: DataFrame, **options) -> DataFrame:
    """One row of each component, with all its columns: the smallest id (null ids last), and of repeated rows one.

    Rows are told apart by a number, so null and reused ids link nothing: only rows with near
    texts, or with the same id and the same text without words, are copies of each other.
    """
    rows = numbered(documents)
    found = near_rows(rows.select(F.col(ROW).alias("doc_id"), "text"), **options).withColumnRenamed("doc_id", ROW)
    blank = F.struct(F.col("doc_id"), F.col("text"))
    named = rows.select(ROW, "doc_id", "text").join(found, ROW)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW))[ROW].alias(ROW)
    winners = named.filter("n_shingles > 0").groupBy("component_id").agg(first).select(ROW)
    winners = winners.unionByName(named.filter("n_shingles = 0").groupBy(blank).agg(F.min(ROW).alias(ROW)).select(ROW))
    return rows.join(winners, ROW, "left_semi").select(*[col(c) for c in documents.columns])


OP5_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
s AS (
    SELECT DISTINCT doc_id, hash(CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END) AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
),
l AS (SELECT x, y FROM p JOIN n u ON u.doc_id = x JOIN n v ON v.doc_id = y WHERE 100 * c >= 85 * (u.n + v.n - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l)
"""
OP5_SQL = OP5_SQL.replace("WITH d AS", "WITH RECURSIVE d AS", 1) + """,
r(doc_id, low) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.y, r.low FROM r JOIN e ON e.x = r.doc_id AND r.low < e.y)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, k.component_id, d.doc_id = k.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(low) AS component_id FROM r GROUP BY doc_id) k USING (doc_id)
"""


@query("op5_near_dedup", OP5_SQL)
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
