"""Benchmark decontamination by winnowing.

Of the ``GRAM``-word grams in each window of ``WINDOW`` words the one with the least hash is
selected (of equal ones the last). The selection depends on the window's words alone, so a
window that a document shares with a benchmark item selects the same gram on both sides: all
shared windows are found from selected grams. Selected grams of both sides are joined by hash,
words and the hash of a window that selects them (a gram that is frequent in both tables meets
only contexts it shares a window with), and each match is extended word by word to the left and
right. A span of a whole window or more is a hit; as words are compared, hits are exact. An item of
fewer words is one window, with grams of at most its length.

Two bitmaps of the benchmark, of selected grams and of windows, thin the documents before the
shuffle. They are sized by the number of windows; beyond ``BITMAP_MOST`` bits more is shuffled,
with the same result.

Null and empty texts have no words. Repeated documents each get a row; repeated
items count once. Only ``doc_id, text`` and ``item_id, text`` are read, so further columns
of any name do no harm. Empty tables give no rows or no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.names import col
from tierline.functions.spread import materialize
from tierline.llm.common import ROW, numbered, query, read
from tierline.llm.hashing import Words, mix, slices, sliding_min

WINDOW = 13
GRAM = 5
#: Bits of a bitmap for each window of the benchmark, and the least and most bits of one.
BITS_PER_WINDOW = 16
BITMAP_LEAST, BITMAP_MOST = 1 << 23, 1 << 28
_BUCKET_BITS = 32768  # of Spark's bitmap functions

_KEPT = np.zeros(256, bool)
_KEPT[0x30:0x3A] = _KEPT[0x41:0x5B] = _KEPT[0x61:0x7B] = _KEPT[0x80:] = True
_LOWER = {i: i + 32 for i in range(65, 91)}


class _Windows:
    """Windows of ``length`` words: their hashes, and the gram that each selects."""

    def __init__(self, words: Words, length: int, gram: int) -> None:
        self.words, self.length, self.gram = words, length, min(gram, length)
        self.width = length - self.gram + 1
        self.grams = words.grams(self.gram)
        self.least = sliding_min(self.grams, self.width)
        self.hashes = mix(words.grams(length) ^ np.uint64(0x5851F42D4C957F2D))

    def selected(self, first: np.ndarray) -> np.ndarray:
        """Position of the last least gram of the windows at ``first``; grows with them."""
        at = first.copy()
        for i in range(1, self.width):
            at = np.where(self.grams[first + i] == self.least[first], first + i, at)
        return at

    def seeds(self, first: np.ndarray) -> Iterator[tuple[int, dict]]:
        """Row and seed for each gram that the windows at ``first`` (ascending) select: where it is, what is around it and who selects it."""
        if not len(first):
            return
        at, begin = np.unique(self.selected(first), return_index=True)
        rows = np.searchsorted(self.words.rows, at, side="right") - 1
        for p, row, own in zip(at.tolist(), rows.tolist(), np.split(self.hashes[first].view(np.int64), begin[1:])):
            low, high = int(self.words.rows[row]), int(self.words.rows[row + 1])
            end = p + self.gram
            yield row, {
                "at": p - low, "n": self.length, "print": int(self.grams[p].view(np.int64)), "gram": " ".join(self._spell(p, end)),
                "left": self._spell(max(low, end - self.length), p)[::-1], "right": self._spell(end, min(high, p + self.length)), "windows": own.tolist(),
            }

    def _spell(self, first: int, end: int) -> list[str]:
        words = self.words
        return [words.data[words.start[i] : words.end[i]].tobytes().decode("utf-8", "replace").translate(_LOWER) for i in range(first, end)]


_SEED_FIELDS = "n int, print long, gram string, left array<string>, right array<string>, windows array<long>"
_SEED = [
    ("n", pa.int32()), ("print", pa.int64()), ("gram", pa.string()), ("left", pa.list_(pa.string())), ("right", pa.list_(pa.string())),
    ("windows", pa.list_(pa.int64())),
]


def benchmark_seeds(benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per item and selected gram with its words, the words around it (nearest first) and the windows that select it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words = Words(part.column(1), _KEPT)
            ids, counts = part.column(0).to_pylist(), words.counts()
            found: list[dict] = []
            for length in sorted({min(int(n), window) for n in counts if n}):
                rows = np.flatnonzero(np.minimum(counts, window) == length)
                first = np.concatenate([np.arange(words.rows[i], words.rows[i + 1] - length + 1) for i in rows])
                found += [{"item_id": ids[row], **seed} for row, seed in _Windows(words, length, gram).seeds(first)]
            fields = [("item_id", pa.int64()), *_SEED]
            yield pa.RecordBatch.from_arrays([pa.array([r[name] for r in found], kind) for name, kind in fields], names=[name for name, _ in fields])

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return items.mapInArrow(cut, f"item_id long, {_SEED_FIELDS}").distinct()


def _bitmap(values: DataFrame, bits: int) -> np.ndarray:
    """Which low bits of the column ``value`` occur; at most ``BITMAP_MOST`` bits reach the driver."""
    low = F.pmod(F.col("value"), F.lit(bits))
    rows = (
        values.select(F.floor(low / _BUCKET_BITS).alias("bucket"), (low % _BUCKET_BITS).alias("bit"))
        .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    )
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        out[r["bucket"] * _BUCKET_BITS // 8 :][: _BUCKET_BITS // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def bitmap_bits(windows: int) -> int:
    """A power of two with ``BITS_PER_WINDOW`` bits a window, within the least and the most."""
    return min(max(1 << (BITS_PER_WINDOW * windows - 1).bit_length(), BITMAP_LEAST), BITMAP_MOST) if windows else BITMAP_LEAST


def _has(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    low = values & np.uint64(len(bits) * 8 - 1)
    return (bits[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 == 1


SCAN_SCHEMA = f"doc_id long, n_words long, found array<struct<at: int, {', '.join(f.replace(' ', ': ', 1) for f in _SEED_FIELDS.split(', '))}>>"


def scan_documents(documents: DataFrame, lengths: list[int], prints: np.ndarray, hashes: np.ndarray, gram: int = GRAM) -> DataFrame:
    """Per document the number of words and the grams selected by windows that the bitmaps hold."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast((prints, hashes))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_prints, known_hashes = shared.value
        for part in slices(batches, "text"):
            words = Words(part.column(1), _KEPT)
            row_of = np.repeat(np.arange(part.num_rows), words.counts())
            found: list[list[dict]] = [[] for _ in range(part.num_rows)]
            for n in lengths:
                windows = _Windows(words, n, gram)
                near = np.flatnonzero(_has(known_prints, windows.least))
                near = near[row_of[near] == row_of[near + n - 1]]
                for row, seed in windows.seeds(near[_has(known_hashes, windows.hashes[near])]):
                    found[row].append(seed)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(words.counts(), pa.int64()), pa.array(found, pa.list_(pa.struct([("at", pa.int32()), *_SEED])))],
                names=["doc_id", "n_words", "found"],
            )

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(scan, SCAN_SCHEMA)


def _common(a: str, b: str) -> Column:
    """How many words two lists share from their beginning on."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    return (F.array_position(F.concat(same, F.array(F.lit(False))), False) - 1).cast("int")


def contamination(documents: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items and item_ids (sorted as strings)."""
    seeds = materialize(benchmark_seeds(benchmark, window, gram), "seeds")
    around = ["n", "print", "gram", "left", "right", "windows"]
    contexts = materialize(seeds.select(*around).distinct().withColumn("context", F.monotonically_increasing_id()), "contexts")
    members = seeds.join(contexts, around).select("context", "item_id")

    lengths = sorted(r[0] for r in contexts.select("n").distinct().collect())  # at most ``window`` numbers
    bits = bitmap_bits(contexts.agg(F.sum(F.size("windows"))).first()[0] or 0)
    prints = _bitmap(contexts.select(F.col("print").alias("value")), bits)
    hashes = _bitmap(contexts.select(F.explode("windows").alias("value")), bits)
    scanned = scan_documents(documents, lengths, prints, hashes, gram)
    scanned = materialize(scanned.withColumn("row", F.monotonically_increasing_id()), "scanned")

    seen = scanned.filter(F.size("found") > 0).select("row", F.inline("found"))
    seen = seen.select("row", "at", "n", "print", "gram", "left", "right", F.explode("windows").alias("window"))
    known = contexts.select(
        "context", "n", "print", "gram", F.col("left").alias("item_left"), F.col("right").alias("item_right"), F.explode("windows").alias("window")
    )
    words = F.least(F.lit(gram), F.col("n"))
    spans = seen.join(known, ["n", "print", "gram", "window"]).select(
        "row", "context", "n", (F.col("at") - _common("left", "item_left")).alias("start"),
        (F.col("at") + words + _common("right", "item_right")).alias("end"),
    )
    hits = materialize(spans.filter(F.col("end") - F.col("start") >= F.col("n")).select("row", "context", "start", "end").distinct(), "hits")
    # Spans of a document in order; a fold adds what each adds beyond the end of those before it.
    ordered = hits.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("runs"))
    covered = F.aggregate(
        "runs", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("hit")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["end"]).alias("end"),
            (a["hit"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["end"], s["start"]))).cast("long").alias("hit"),
        ),
        lambda a: a["hit"],
    )
    hit = ordered.select("row", covered.alias("n_hit"))
    items = (
        hits.select("row", "context").distinct().join(members, "context").select("row", F.col("item_id").cast("string").alias("item")).distinct()
        .groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("item_ids"))
    )
    return scanned.select("row", "doc_id", "n_words").join(hit.join(items, "row"), "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def is_contaminated(n_hit="n_hit", n_words="n_words"):
    """Five percent of the words or more are hit."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns; each row is judged by its own text."""
    rows = numbered(documents)
    found = contamination(rows.select(F.col(ROW).alias("doc_id"), "text"), benchmark)
    bad = found.filter(is_contaminated()).select(F.col("doc_id").alias(ROW))
    return rows.join(bad, ROW, "left_anti").select(*[col(c) for c in documents.columns])


_WORDS_SQL = r"regexp_extract_all(regexp_replace(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[^ ]+')"

OP4_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS_SQL.format(text="coalesce(text, '')")} AS w FROM documents),
b AS (SELECT item_id, {_WORDS_SQL.format(text="coalesce(text, '')")} AS w FROM benchmark),
bw AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS s
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)
),
dw AS (
    SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS s
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
),
h AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, s)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM h)) GROUP BY doc_id),
t AS (
    SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM h) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@query("op4_decontamination", OP4_SQL)
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )
