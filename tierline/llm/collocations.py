"""Phrase collocations mined with Rabin-Karp fingerprints.

A text is cut into pieces at ``.,;:!?`` and line ends, and pieces into words at blanks and tabs,
with A-Z lowered. A prefix polynomial over the bytes hashes every word and another one over the
words hashes every phrase of up to ``LONGEST`` words, whatever its length, by two lookups. All
counts are per language (null: ``und``), which is part of the fingerprint.

1. A shuffle adds up the counts of fingerprints, level by level: pairs only of words that are frequent,
   longer phrases only where every pair in them is. What is frequent is known to the tasks as a
   bitmap of hashes of bounded size; its false positives cost rows in the shuffle, nothing else.
2. The texts are read once more: each occurrence of a frequent fingerprint is compared with
   the text it stands for in its slice, and counts are added up by the words themselves with a pointer
   to an occurrence (document, word), so phrases that share a fingerprint are told apart. Only
   frequent phrases are ever spelt out. Pointers go with these rows only, because they would double the
   shuffle of all the others.
3. Every cut of a candidate is scored from the counts of its parts, which are frequent as well.

Rows are counted in each slice of a task before they are shuffled, so a hot word or phrase sends one
row a slice. Counts of parts are joined by key, those of the few most frequent parts by a broadcast.
Null and empty texts have no words; repeated rows count as often as they occur; ties go to the shorter
first part and to the phrase that comes first in byte order. A pointer of rows that share an id (or have none) names the id only. ``doc_id``,
``text`` and ``lang`` are read, other columns may have any name. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.names import col
from tierline.functions.spread import materialize, top_per_key
from tierline.llm.common import query, read
from tierline.llm.hashing import Words, mix, signed, slices

LONGEST, LEAST, SHARE, TOP = 4, 30, 80, 2000
SCALE = 2_000_000
NO_LANGUAGE = "und"
#: Bits of the bitmap of frequent fingerprints: this many for each, up to the bound.
BITS_EACH, MOST_BITS = 64, 1 << 28
_BUCKET_BITS = 32768  # of Spark's bitmap functions
_RANKERS = 64
#: Parts that make up this share of all words or more are joined by a broadcast: so many of each length at most.
MOST_HOT = 1000
# Longer words are compared as strings of bytes.
_STEPS = 24

_KEPT = np.ones(256, bool)
_KEPT[[ord(c) for c in " \t.,;:!?\n\v\f\r"]] = False
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_U = np.uint64
_BASE = 0x9FB21C651E98DF25
_INVERSE = pow(_BASE, -1, 1 << 64)


class Phrases:
    """The words of a slice, where pieces end, and hashes of phrases by their first word."""

    def __init__(self, part: pa.RecordBatch, bits: int = 64) -> None:
        self.shift = _U(64 - bits)
        self.words = Words(part.column(1), _KEPT)
        self.count = len(self.words.start)
        self.row = np.repeat(np.arange(part.num_rows), self.words.counts())
        langs = part.column(2).dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.lang = langs.indices.to_numpy(zero_copy_only=False)
        salt = np.array([mix(np.array([_text_hash(x)], np.uint64))[0] for x in self.langs] or [0], np.uint64)
        breaks = np.concatenate([[0], np.cumsum(_BREAK[self.words.data])])
        cut = np.ones(self.count, bool)
        if self.count:
            cut[1:] = (breaks[self.words.end[:-1]] != breaks[self.words.start[1:]]) | (self.row[1:] != self.row[:-1])
        self.piece = np.cumsum(cut)
        self.salt = salt[self.lang[self.row]] if self.count else np.zeros(0, np.uint64)
        up = np.cumprod(np.concatenate([[_U(1)], np.full(self.count, _U(_BASE))]), dtype=np.uint64)
        self.down = np.cumprod(np.concatenate([[_U(1)], np.full(self.count, _U(_INVERSE))]), dtype=np.uint64)
        self.sums = np.concatenate([[_U(0)], np.cumsum(self.words.hash * up[:-1], dtype=np.uint64)])

    def starts(self, n: int) -> np.ndarray:
        """First words of all phrases of ``n`` words that lie in one piece."""
        m = self.count - n + 1
        return np.flatnonzero(self.piece[:m] == self.piece[n - 1 :]) if m > 0 else np.zeros(0, np.int64)

    def hashes(self, first: np.ndarray, n: int) -> np.ndarray:
        return mix((self.sums[first + n] - self.sums[first]) * self.down[first] + self.salt[first] + _U(n)) >> self.shift

    def frequent(self, n: int, bitmaps: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of phrases of ``n`` words of which all known parts of most words may be frequent."""
        first = self.starts(n)
        known = max((k for k in bitmaps if k <= n), default=0)
        if known == n:
            h = self.hashes(first, n)
            kept = holds(bitmaps[n], h)
            return first[kept], h[kept]
        if known:
            may = np.zeros(self.count + 1, bool)
            part = self.starts(known)
            may[part] = holds(bitmaps[known], self.hashes(part, known))
            for k in range(n - known + 1):
                first = first[may[first + k]]
        return first, self.hashes(first, n)

    def text(self, first: np.ndarray, n: int) -> pa.Array:
        """The words of each phrase with one blank between them, gathered from the bytes of the slice."""
        data = np.frombuffer(self._lowered() + b" ", np.uint8)
        words = first[:, None] + np.arange(n)
        start, end = self.words.start[words].ravel(), self.words.end[words].ravel()
        blank = np.ones(len(start), np.int64)
        blank[n - 1 :: n] = 0
        length = end - start + blank
        after = np.cumsum(length)
        at = np.repeat(start - (after - length), length) + np.arange(after[-1] if len(after) else 0)
        at[after[blank == 1] - 1] = len(data) - 1
        offsets = np.concatenate([[0], after[n - 1 :: n]]).astype(np.int64)
        spelt = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data[at])])
        return spelt.cast(pa.large_string()).cast(pa.string())

    def _lowered(self) -> bytes:
        if not hasattr(self, "_raw"):
            self._raw = self.words.data.tobytes().lower()
        return self._raw

    def same(self, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
        """Whether the phrases at ``a`` and ``b`` have the same words, byte by byte, and the same language."""
        raw = self._lowered()
        data = np.frombuffer(raw, np.uint8)
        equal = self.lang[self.row[a]] == self.lang[self.row[b]]
        for k in range(n):
            sa, sb = self.words.start[a + k], self.words.start[b + k]
            length = self.words.end[a + k] - sa
            equal &= length == self.words.end[b + k] - sb
            left = np.flatnonzero(equal)
            for step in range(_STEPS):
                left = left[length[left] > step]
                differs = data[sa[left] + step] != data[sb[left] + step]
                equal[left[differs]] = False
                left = left[~differs]
            for i in left[length[left] > _STEPS]:
                equal[i] = raw[sa[i] : sa[i] + length[i]] == raw[sb[i] : sb[i] + length[i]]
        return equal


def _text_hash(text: str) -> int:
    h = 0
    for b in text.encode("utf-8", "replace"):
        h = (h * _BASE + b + 1) % (1 << 64)
    return h


def holds(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & _U(len(bitmap) * 8 - 1)
    return (bitmap[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8)) & 1 == 1


def bitmap_of(frequent: DataFrame) -> np.ndarray:
    """The low bits of the fingerprints as a bitmap, put together from buckets that Spark builds; at most ``MOST_BITS`` bits."""
    n = frequent.count()
    bits = _BUCKET_BITS
    while bits < min(n * BITS_EACH, MOST_BITS):
        bits *= 2
    # Spark's bitmaps hold positions from 1 in buckets from 1, of which the first has position 0 as well.
    at = F.col("print").bitwiseAND(F.lit(bits - 1)) + 1
    parts = frequent.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("place"))
    out = np.zeros(bits // 8, np.uint8)
    for bucket, raw in parts.groupBy("bucket").agg(F.bitmap_construct_agg("place")).collect():
        first = (bucket - 1) * _BUCKET_BITS // 8
        out[first : first + len(raw)] = np.frombuffer(bytes(raw), np.uint8)
    return out


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(
        col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
    )


def fingerprints(documents: DataFrame, sizes: range, bitmaps: dict[int, np.ndarray], least: int = LEAST, bits: int = 64) -> DataFrame:
    """Fingerprints of phrases of ``sizes`` words with at least ``least`` occurrences."""
    shared = documents.sparkSession.sparkContext.broadcast(bitmaps)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = Phrases(part, bits)
            for n in sizes:
                prints, counts = np.unique(found.frequent(n, shared.value)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([signed(prints), pa.array(counts.astype(np.int64))], names=["print", "a"])

    found = _texts(documents).mapInArrow(scan, "print long, a long")
    # Words come back in every slice of a task, so they are added up in it; nearly all phrases of a task differ, so they are dealt first.
    dealt = found if sizes[0] == 1 else found.repartition(F.col("print"))
    return dealt.groupBy("print").agg(F.sum("a").alias("a")).filter(F.col("a") >= least).select("print")


SPELT = "lang string, phrase string, a long, doc_id long, word long"


def verified(documents: DataFrame, bitmaps: dict[int, np.ndarray], longest: int, bits: int = 64) -> DataFrame:
    """Frequent phrases by their words, with exact counts and a pointer; the phrase of no words counts all words of the language."""
    shared = documents.sparkSession.sparkContext.broadcast(bitmaps)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = Phrases(part, bits)
            langs = pa.array(found.langs, pa.string())
            words = np.bincount(found.lang[found.row], minlength=len(langs)) if found.count else np.zeros(len(langs), np.int64)
            nowhere = pa.nulls(len(langs), pa.int64())
            totals = [langs, pa.array([""] * len(langs), pa.string()), pa.array(words.astype(np.int64)), nowhere, nowhere]
            yield pa.RecordBatch.from_arrays(totals, names=["lang", "phrase", "a", "doc_id", "word"])
            for n in range(1, longest + 1):
                first, h = found.frequent(n, shared.value)
                while len(first):
                    _, at, group = np.unique(h, return_index=True, return_inverse=True)
                    shown = first[at]
                    equal = found.same(first, shown[group], n)
                    counts = np.bincount(group[equal], minlength=len(shown)).astype(np.int64)
                    row = found.row[shown]
                    lang, ids = langs.take(pa.array(found.lang[row])), part.column(0).take(pa.array(row))
                    rows = [lang, found.text(shown, n), pa.array(counts), ids, pa.array(shown - found.words.rows[row])]
                    yield pa.RecordBatch.from_arrays(rows, names=["lang", "phrase", "a", "doc_id", "word"])
                    # Another phrase with the same fingerprint is counted as one of its own.
                    first, h = first[~equal], h[~equal]

    spelt = _texts(documents).mapInArrow(scan, SPELT).groupBy("lang", "phrase")
    return spelt.agg(F.sum("a").alias("a"), F.min("doc_id").alias("doc_id"), F.min_by("word", "doc_id").alias("word"))


def _with_part(cuts: DataFrame, parts: DataFrame, side: str, name: str, hot: int) -> DataFrame:
    """``cuts`` with the count of the part in ``side``.

    A part that occurs ``hot`` times may be a part of many phrases, but there are few such parts:
    they are joined where the cuts are. Any other one is a part of at most hot / 10 of them.
    """
    part = parts.select("lang", F.col("phrase").alias(side), F.col("a").alias(name))
    found = cuts.join(F.broadcast(part.filter(F.col(name) >= hot)), ["lang", side], "left")
    rest = found.filter(F.col(name).isNull()).drop(name).join(part.filter(F.col(name) < hot), ["lang", side])
    return found.filter(F.col(name).isNotNull()).unionByName(rest)


def _words(phrase: Column, first: Column, n: Column) -> Column:
    return F.array_join(F.slice(phrase, first, n), " ")


def collocations(
    documents: DataFrame, longest: int = LONGEST, least: int = LEAST, share: int = SHARE, top: int | None = TOP, bits: int = 64
) -> DataFrame:
    """The first ``top`` phrases of each language (all: None) by their weakest cut: counts, score and a pointer to an occurrence.

    Fingerprints have ``bits`` bits; fewer make more of them collide, which changes no result.
    """
    bitmaps: dict[int, np.ndarray] = {}
    levels = [sizes for sizes in (range(1, 2), range(2, 3), range(3, longest + 1)) if len(sizes)]
    for sizes in levels:
        bitmap = bitmap_of(materialize(fingerprints(documents, sizes, bitmaps, least, bits), "fingerprints"))
        bitmaps |= {n: bitmap for n in sizes}
    spelt = materialize(verified(documents, bitmaps, longest, bits), "phrases")
    total = spelt.filter(F.col("phrase") == "").select("lang", F.col("a").alias("n"))
    words = F.split("phrase", " ", -1)
    phrases = spelt.filter((F.col("phrase") != "") & (F.col("a") >= least)).withColumn("n_words", F.size(words))

    candidates = phrases.filter("n_words > 1").withColumn("w", words)
    k = F.col("k")
    cuts = candidates.select("lang", "phrase", "n_words", "a", "w", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"))
    scored = cuts.select("lang", "phrase", "a", "k", _words(F.col("w"), F.lit(1), k).alias("left"), _words(F.col("w"), k + 1, F.col("n_words") - k).alias("right"))
    parts = phrases.filter(F.col("n_words") < longest)
    hot = max(least, (total.agg(F.sum("n")).first()[0] or 0) // MOST_HOT)
    for side, name in (("left", "l"), ("right", "r")):
        scored = _with_part(scored, parts, side, name, hot)
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    score = F.expr(f"(cast({SCALE} as decimal(8,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    weakest = scored.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = F.expr("flatten(transform(sequence(2, n_words - 1), m -> transform(sequence(1, n_words - m + 1), i -> array_join(slice(w, i, m), ' '))))")
    inside = (
        candidates.filter("n_words > 2").select("lang", "a", F.explode(F.array_distinct(inner)).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    )
    kept = (
        candidates.select("lang", "phrase", "a", "doc_id", "word").join(inside, ["lang", "phrase"], "left")
        .filter(F.col("longer").isNull() | (100 * wide("longer") < share * wide("a")))
        .join(weakest, ["lang", "phrase"])
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", "doc_id", "word")
    )
    if top is not None:
        # The rows of one language are first cut down in several tasks.
        order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
        dealt = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(_RANKERS)))
        kept = top_per_key(top_per_key(dealt, ["lang", "part"], order, top).drop("part"), ["lang"], order, top, rank="rank")
    return kept.join(total, "lang")


_SQL = r"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, p.i AS piece,
         list_filter(regexp_split_to_array(p.t, '[ \t]+'), lambda x: x <> '') AS w
  FROM (SELECT doc_id, lang, unnest(list_transform(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]'), lambda t, i: {'t': t, 'i': i})) AS p FROM documents)),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
  FROM starts, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 30),
cand AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM grams WHERE k >= 2),
cuts AS (SELECT lang, k, phrase, a, w, unnest(range(1, k)) AS c FROM cand),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, c, l.a AS l, r.a AS r, ((2000000::HUGEINT * cuts.a) // (l.a + r.a))::BIGINT AS score
  FROM cuts JOIN grams l ON l.lang = cuts.lang AND l.phrase = array_to_string(w[1:c], ' ')
            JOIN grams r ON r.lang = cuts.lang AND r.phrase = array_to_string(w[c + 1:cuts.k], ' ')),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_parts AS (
  SELECT q.lang, q.a, array_to_string(q.w[i:i + m - 1], ' ') AS phrase
  FROM cand q, (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS i) WHERE m < q.k AND i + m - 1 <= q.k),
dropped AS (
  SELECT DISTINCT c.lang, c.phrase FROM cand c JOIN inner_parts p ON p.lang = c.lang AND p.phrase = c.phrase AND 100::HUGEINT * p.a >= 80::HUGEINT * c.a),
kept AS (SELECT * FROM weakest WHERE (lang, phrase) NOT IN (SELECT (lang, phrase) FROM dropped)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total ON total.lang = ranked.lang WHERE rank <= 2000
"""


@query("op12_collocations", _SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations(read(spark, sf_dir, "documents"))
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
