"""Language identification of whole, possibly mixed texts.

Words are runs of letters. The script of a word (by code point ranges) narrows its candidates
to the languages of whose own words the training texts write at least ``SCRIPT_SHARE`` in that
script, however rare the language is among all; a word in a script of no language has all
languages as candidates. Each candidate gets the log-likelihood
of the word's letter trigrams, and a Viterbi pass with a penalty for switching labels every word,
so short foreign insertions and single misleading words don't break spans.

The predicted language is the one that labels most letters (ties: the smaller name), the
score its share of the letters. Null texts and texts without letters are ``und`` with score 0, as
is everything where nothing could be learned. Repeated rows are predicted alike. The model
counts trigrams over all training rows. Only ``doc_id``, ``text`` and, for training, ``lang`` are read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.names import col
from tierline.llm.common import query, read
from tierline.llm.hashing import slices, text_bytes

BUCKETS = 1 << 16
SWITCH = 12.0
#: Words labelled in one pass, and bytes of text cut into words at once: what a worker holds besides the model.
BATCH_WORDS = 1_000_000
SLICE_BYTES = 512 << 10
UNKNOWN = "und"
#: Share of a language's words from which it counts as written in a script.
SCRIPT_SHARE = 0.001

# First and last code point of each script's letters (Unicode blocks).
SCRIPTS = (
    ("latin", 0x41, 0x24F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x370, 0x3FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x6FF),
    ("arabic", 0x750, 0x77F), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF), ("tamil", 0xB80, 0xBFF),
    ("thai", 0xE00, 0xE7F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("hangul", 0xAC00, 0xD7AF),
    ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF), ("han", 0x20000, 0x2FA1F),
)
SCRIPT_NAMES = ("other", *dict.fromkeys(s[0] for s in SCRIPTS))


class _Characters:
    """Tables over code points: letter, lower case, script. Built once a worker."""

    def __init__(self) -> None:
        n = 0x110000
        self.letter = np.zeros(n, bool)
        self.lower = np.arange(n, dtype=np.uint32)
        for c in range(0x32000):
            s = chr(c)
            if unicodedata.category(s)[0] == "L":
                self.letter[c] = True
                small = s.lower()
                if len(small) == 1:
                    self.lower[c] = ord(small)
        self.script = np.zeros(n, np.uint8)
        for name, first, last in SCRIPTS:
            self.script[first : last + 1] = SCRIPT_NAMES.index(name)


_characters: list[_Characters] = []


def characters() -> _Characters:
    if not _characters:
        _characters.append(_Characters())
    return _characters[0]


class Letters:
    """Words of a text column in code points: start, end, row ranges, scripts, and trigram buckets of every letter."""

    def __init__(self, column: pa.Array) -> None:
        table = characters()
        data, at = text_bytes(column)
        code = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
        ends = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[at]
        n = len(code)
        inside = table.letter[code]
        begins, stops = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
        begins[:-1], stops[1:] = inside, inside
        begins[1:-1] &= ~inside[:-1]
        stops[1:-1] &= ~inside[1:]
        edges = ends[(ends > 0) & (ends < n)]
        edges = edges[inside[edges] & inside[edges - 1]] if n else edges
        begins[edges] = stops[edges] = True
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(stops)
        self.rows, self.offsets = np.searchsorted(self.start, ends), ends
        small = np.where(inside, table.lower[code], 0).astype(np.uint64)
        before, after = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        before[1:], after[:-1] = small[:-1], small[1:]
        before[self.start] = 0
        after[self.end - 1] = 0
        mixed = before * np.uint64(0x9E3779B97F4A7C15) + small * np.uint64(0xC2B2AE3D27D4EB4F) + after * np.uint64(0x165667B19E3779F9)
        self.bucket = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(48)).astype(np.int64)
        self.inside = inside
        self.script = table.script[code[self.start]] if n else np.zeros(0, np.uint8)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    log: np.ndarray  # languages x buckets
    allowed: np.ndarray  # scripts x languages


def train(documents: DataFrame) -> Model:
    """Trigram counts of all rows with text and ``lang``; the driver gets one row a language and bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for part in slices(batches, "text", SLICE_BYTES):
            words = Letters(part.column(1))
            langs = part.column(0).to_pylist()
            for i, lang in enumerate(langs):
                if lang not in totals:
                    totals[lang] = np.zeros(BUCKETS + len(SCRIPT_NAMES), np.int64)
                a, b = words.offsets[i], words.offsets[i + 1]
                chosen = words.bucket[a:b][words.inside[a:b]]
                if len(chosen) > 2000:
                    totals[lang][:BUCKETS] += np.bincount(chosen, minlength=BUCKETS)
                else:
                    np.add.at(totals[lang], chosen, 1)
                mine = words.script[words.rows[i] : words.rows[i + 1]].astype(np.int64)
                totals[lang][BUCKETS:] += np.bincount(mine, minlength=len(SCRIPT_NAMES))
        for lang, total in totals.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(seen), pa.string()), pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["lang", "bucket", "n"]
            )

    known = documents.filter("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = known.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(rows["lang"].unique()))
    counts = np.zeros((len(languages), BUCKETS + len(SCRIPT_NAMES)))
    counts[np.searchsorted(np.array(languages, dtype=object), rows["lang"].to_numpy()) if languages else [], rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    grams, scripts = counts[:, :BUCKETS] + 0.05, counts[:, BUCKETS:].T
    log = np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32)
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0, keepdims=True), 1)
    allowed[~allowed.any(axis=1)] = True
    return Model(languages, log, allowed)


def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every word; rows of ``scores`` are the words of the texts one after the other, ``counts`` words each."""
    labels = np.zeros(len(scores), np.int32)
    order = np.argsort(-counts, kind="stable")
    sizes = counts[order]
    starts = (np.cumsum(counts) - counts)[order]
    order = order[sizes > 0]
    starts, sizes = starts[: len(order)], sizes[: len(order)]
    if not len(order):
        return labels
    active = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
    stay = np.ones(scores.shape, bool)
    jump = np.zeros(len(scores), np.int32)
    value = scores[starts].astype(np.float64)
    last = np.zeros(len(order), np.int64)
    for t in range(1, int(sizes[0])):
        m = active[t]
        if m < len(value):
            last[m : len(value)] = value[m:].argmax(axis=1)
            value = value[:m]
        at = starts[:m] + t
        best = value.argmax(axis=1)
        top = value[np.arange(m), best] - penalty
        stay[at] = value >= top[:, None]
        jump[at] = best
        value = np.maximum(value, top[:, None]) + scores[at]
    last[: len(value)] = value.argmax(axis=1)
    now = last
    for t in range(int(sizes[0]) - 1, -1, -1):
        m = active[t]
        at = starts[:m] + t
        labels[at] = now[:m]
        if t:
            now[:m] = np.where(stay[at, now[:m]], now[:m], jump[at])
    return labels


PREDICTED = (
    T.StructType().add("lang_pred", "string").add("score", "double")
    .add("spans", T.ArrayType(T.StructType().add("start", "integer").add("end", "integer").add("lang", "string")))
)
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))


def _finish(held: list, languages: tuple[str, ...], penalty: float) -> pa.RecordBatch:
    counts = np.concatenate([h[1] for h in held])
    labels = viterbi(np.concatenate([h[2] for h in held]), counts, penalty)
    start, end = np.concatenate([h[3] for h in held]), np.concatenate([h[4] for h in held])
    bounds = np.concatenate([[0], np.cumsum(counts)])
    row = np.repeat(np.arange(len(counts)), counts)
    letters = np.zeros((len(counts), len(languages)))
    np.add.at(letters, (row, labels), end - start)
    new = np.ones(len(labels), bool)
    new[1:] = (labels[1:] != labels[:-1]) | (row[1:] != row[:-1])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(labels)) - 1 if len(heads) else heads
    spans = pa.StructArray.from_arrays(
        [pa.array(start[heads], pa.int32()), pa.array(end[tails], pa.int32()), pa.array(languages, pa.string()).take(pa.array(labels[heads]))], names=["start", "end", "lang"]
    )
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(heads, bounds), pa.int32()), spans)
    best = letters.argmax(axis=1)
    total = letters.sum(axis=1)
    share = letters[np.arange(len(best)), best] / np.maximum(total, 1)
    names = [languages[b] if t else UNKNOWN for b, t in zip(best, total)]
    return pa.RecordBatch.from_arrays(
        [pa.concat_arrays([h[0] for h in held]), pa.array(names, pa.string()), pa.array(share, pa.float64()), lists.cast(_SPAN)],
        names=["doc_id", "lang_pred", "score", "spans"],
    )


def _with_text(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows that come whole bring their text; a second copy beside them would only fill the worker."""
    if batch.num_columns > 1:
        return batch
    text = batch.column(0).field("text")
    return pa.RecordBatch.from_arrays([batch.column(0), text if pa.types.is_string(text.type) else text.cast(pa.string())], names=["doc_id", "text"])


def label(batches: Iterator[pa.RecordBatch], model: Model, penalty: float = SWITCH) -> Iterator[pa.RecordBatch]:
    """Batches of doc_id and text, or of whole rows as structs, with the columns of ``PREDICTED`` instead of the text."""
    held, size = [], 0
    for part in slices(map(_with_text, batches), "text", SLICE_BYTES):
        ids = part.column(0)
        if not model.languages:
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([UNKNOWN] * len(ids)), pa.array([0.0] * len(ids)), pa.array([[]] * len(ids), _SPAN)], names=["doc_id", "lang_pred", "score", "spans"]
            )
            continue
        words = Letters(part.column(1))
        scores = np.zeros((len(words.start), len(model.languages)), np.float32)
        for k in range(len(model.languages)):
            sums = np.concatenate([[0.0], np.cumsum(np.where(words.inside, model.log[k][words.bucket], 0.0), dtype=np.float64)])
            scores[:, k] = sums[words.end] - sums[words.start]
        scores[~model.allowed[words.script]] = -1e6
        row = np.repeat(np.arange(len(ids)), np.diff(words.rows))
        base = words.offsets[row]
        held.append((ids, np.diff(words.rows), scores, (words.start - base).astype(np.int32), (words.end - base).astype(np.int32)))
        size += len(scores)
        if size >= BATCH_WORDS:
            done, held, size = _finish(held, model.languages, penalty), [], 0
            yield done
    if held:
        yield _finish(held, model.languages, penalty)


def identify(documents: DataFrame, model: Model, *, penalty: float = SWITCH, key: Column | None = None, whole_rows: bool = False) -> DataFrame:
    """Per row: doc_id (or ``key``, or with ``whole_rows`` the row as a struct), lang_pred, score and the labelled spans (code points)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    if whole_rows:
        docs = documents.select(F.struct(*[col(c) for c in documents.columns]).alias("doc_id"))
    else:
        key = F.col("doc_id").cast("long") if key is None else key
        docs = documents.select(key.alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(lambda batches: label(batches, shared.value, penalty), T.StructType([docs.schema[0], *PREDICTED]))


def held_out(doc_id: Column) -> Column:
    """The fourth of the ids that no model learns from."""
    return F.crc32(doc_id.cast("string")) % 4 == 2


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    model = train(documents.filter(~F.coalesce(held_out(F.col("doc_id")), F.lit(False))))
    return identify(documents, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
