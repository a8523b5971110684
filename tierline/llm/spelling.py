"""Spelling variants: words one edit apart, found by Bloom-guided neighbourhoods.

A word is a maximal run of letters (``A-Z a-z`` and U+00C0 to U+00FF) with A-Z lowered. The
vocabulary with its counts is a table; no task and no driver holds it. Each length has a
blocked Bloom filter of the words of that length. Every word generates the words one deletion
or one replacement away (an insertion is a deletion of the other word, and of two words
that differ by a replacement only the one with the smaller letter generates the other), the
hashes of these edits are probed against the filters, and only positives are spelt out and
joined with the vocabulary, which removes the false ones. So each pair is met once.

Filters are broadcast. Their size is bounded by ``ROUND_BYTES`` whatever the vocabulary: a
larger one is cut into slices by hash and probed in rounds, each with its own filters.

Null texts have no words; a null id counts as an empty one where the id is part of a hash.
Repeated rows count as often as they occur. Ties between neighbours go to the smaller word in
code-point order. Only ``doc_id`` and ``text`` are read, other columns may have any name.
Empty tables give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.names import col
from tierline.functions.spread import materialize
from tierline.llm.common import query, read
from tierline.llm.hashing import mix

LEAST_LETTERS, LEAST_COUNT, RATIO = 5, 3, 2
#: Of the occurrences whose hash it divides, one letter is left out.
DAMAGED = 97

WORD_BITS = 16
BLOCK_BITS, PROBES = 512, 6
#: Blocks of one piece of a filter, which one task builds.
PIECE_BLOCKS = 1024
#: Filters held at once by the driver and each task.
ROUND_BYTES = 32 << 20
#: Words of this length and all longer ones share filters.
LAST_LENGTH = 64

_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
_FLUSH_ENTRIES, _FLUSH_BYTES, _LONG_TEXT = 400_000, 32 << 20, 4 << 20
_CELLS = 1 << 20
_U = np.uint64
_BASE = _U(0xD1342543DE82EF95)
_BACK = _U(pow(int(_BASE), -1, 1 << 64))
_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


def _counts(key, text: str) -> Iterator[tuple[bytes, int]]:
    """Words of one text with their counts, after the damage that id and word decide."""
    data = text.encode("utf-8", "surrogatepass").lower()
    # findall is faster, but would hold every run of a very long text.
    runs = _RUN.findall(data) if len(data) < _LONG_TEXT else (m.group() for m in _RUN.finditer(data))
    start = zlib.crc32(f"{'' if key is None else key}:".encode())
    for run, n in Counter(runs).items():
        h = zlib.crc32(run, start)
        if h % DAMAGED == 0:
            word = run.decode()
            at = h % len(word)
            run = (word[:at] + word[at + 1 :]).encode()
        yield run, n


def vocabulary(documents: DataFrame, letters: int = LEAST_LETTERS, least: int = LEAST_COUNT) -> DataFrame:
    """Words of at least ``letters`` letters with at least ``least`` occurrences: word, n. Counted in each task first."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        size = 0

        def rows() -> pa.RecordBatch:
            words = pa.array(list(held), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for run, n in _counts(key, text.as_py() or ""):
                    if len(run) - run.count(b"\xc3") < letters:
                        continue
                    size += 0 if run in held else len(run)
                    held[run] = held.get(run, 0) + n
                    if len(held) >= _FLUSH_ENTRIES or size >= _FLUSH_BYTES:
                        yield rows()
                        held.clear()
                        size = 0
        yield rows()

    texts = documents.select(col("doc_id").cast("string").alias("key"), col("text").cast("string").alias("text"))
    parts = texts.mapInArrow(tally, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


class _Group:
    """Words of one length as a matrix of letters, with their polynomial hashes."""

    def __init__(self, words: list[str]) -> None:
        self.words, self.length = words, len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), self.length)
        self.codes = codes.astype(np.uint8)
        self.up = np.cumprod(np.concatenate([[_U(1)], np.full(self.length, _BASE)]), dtype=np.uint64)
        self.terms = _VALUES[self.codes] * self.up[:-1]
        self.raw = self.terms.sum(axis=1, dtype=np.uint64)

    def hashes(self) -> np.ndarray:
        return _final(self.raw, self.length)

    def deletions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word, position and hash of every word one letter shorter; the first of equal letters in a row stands for all."""
        first = np.ones(self.codes.shape, bool)
        first[:, 1:] = self.codes[:, 1:] != self.codes[:, :-1]
        upto = np.cumsum(self.terms, axis=1, dtype=np.uint64)
        row, at = np.nonzero(first)
        rest = (self.raw[row] - upto[row, at]) * _BACK
        return row, at, _final(upto[row, at] - self.terms[row, at] + rest, self.length - 1)

    def replacements(self, letter: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``deletions``, with ``letter`` in place of each smaller one."""
        row, at = np.nonzero(self.codes < letter)
        raw = self.raw[row] + (_VALUES[letter] - _VALUES[self.codes[row, at]]) * self.up[at]
        return row, at, _final(raw, self.length)


def _final(raw: np.ndarray, length: int) -> np.ndarray:
    return mix(raw + _U(length * 0xA24BAED4963EE407 % (1 << 64)))


def _groups(words: list[str]) -> Iterator[_Group]:
    """The words by length, in pieces of about ``_CELLS`` letters."""
    by_length: dict[int, list[str]] = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for length, same in by_length.items():
        step = max(1, _CELLS // length)
        for i in range(0, len(same), step):
            yield _Group(same[i : i + step])


def _scaled(h: np.ndarray, shift: int, n: int) -> np.ndarray:
    """``n`` equal ranges of 32 bits of ``h``: the number of the range, 0 to n - 1."""
    return ((((h >> _U(shift)) & _U(0xFFFFFFFF)) * _U(n)) >> _U(32)).astype(np.int64)


class Plan:
    """Which filters there are: for each length its slices, and for each of them a number of blocks."""

    def __init__(self, sizes: dict[int, int], round_bytes: int = ROUND_BYTES) -> None:
        most = max(1, round_bytes * 8 // BLOCK_BITS)
        self.shards: dict[int, tuple[int, int]] = {}
        for shard, words in sorted(sizes.items()):
            blocks = -(-words * WORD_BITS // BLOCK_BITS) + 1
            slices = -(-blocks // most)
            self.shards[shard] = (slices, -(-blocks // slices))
        self.rounds: list[dict[tuple[int, int], int]] = []
        room = 0
        for shard, (slices, blocks) in self.shards.items():
            for part in range(slices):
                if blocks > room:
                    self.rounds.append({})
                    room = most
                self.rounds[-1][shard, part] = most - room
                room -= blocks

    def slice_of(self, shard: int, h: np.ndarray) -> np.ndarray:
        return _scaled(mix(h ^ _U(0x6A09E667F3BCC909)), 0, self.shards[shard][0])

    def block_of(self, shard: int, h: np.ndarray) -> np.ndarray:
        return _scaled(h, 32, self.shards[shard][1])

    def blocks(self, number: int) -> int:
        return max(first + self.shards[shard][1] for (shard, _), first in self.rounds[number].items())


def _bits(h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The 64-bit word of the block and the bit in it, for each probe."""
    other = mix(h ^ _U(0xBB67AE8584CAA73B))
    for i in range(PROBES):
        place = (other >> _U(9 * i)) & _U(BLOCK_BITS - 1)
        yield (place >> _U(6)).astype(np.int64), _U(1) << (place & _U(63))


def build_filters(words: DataFrame, plan: Plan, number: int) -> np.ndarray:
    """The filters of one round, a row of 64-bit words per block; pieces are built in tasks."""
    wanted = plan.rounds[number]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in _groups(batch.column(0).to_pylist()):
                shard, h = min(group.length, LAST_LENGTH), group.hashes()
                if shard not in plan.shards:
                    continue
                parts, blocks = plan.slice_of(shard, h), plan.block_of(shard, h)
                for part in np.unique(parts):
                    if (shard, int(part)) in wanted:
                        mine = parts == part
                        at = wanted[shard, int(part)] + blocks[mine]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(at // PIECE_BLOCKS), pa.array(at % PIECE_BLOCKS), pa.array(h[mine].view(np.int64))], names=["piece", "at", "h"]
                        )

    def fill(table: pa.Table) -> pa.Table:
        bits = np.zeros((PIECE_BLOCKS, BLOCK_BITS // 64), np.uint64)
        at, h = table.column("at").to_numpy(), table.column("h").to_numpy().view(np.uint64)
        for word, bit in _bits(h):
            np.bitwise_or.at(bits, (at, word), bit)
        return pa.table({"piece": pa.array([table.column("piece")[0].as_py()], pa.int64()), "bits": pa.array([bits.tobytes()], pa.binary())})

    dealt = words.select("word").mapInArrow(deal, "piece long, at long, h long")
    pieces = dealt.groupBy("piece").applyInArrow(fill, "piece long, bits binary").collect()
    out = np.zeros((-(-plan.blocks(number) // PIECE_BLOCKS) * PIECE_BLOCKS, BLOCK_BITS // 64), np.uint64)
    for piece, bits in pieces:
        out[piece * PIECE_BLOCKS : (piece + 1) * PIECE_BLOCKS] = np.frombuffer(bits, np.uint64).reshape(PIECE_BLOCKS, -1)
    return out


def _probe(h: np.ndarray, length: int, plan: Plan, number: int, filters: np.ndarray) -> np.ndarray:
    """Positions of the hashes that the filters of this round hold."""
    shard = min(length, LAST_LENGTH)
    if shard not in plan.shards:
        return np.zeros(0, np.int64)
    wanted = plan.rounds[number]
    starts = np.array([wanted.get((shard, part), -1) for part in range(plan.shards[shard][0])])
    if (starts < 0).all():
        return np.zeros(0, np.int64)
    first = starts[plan.slice_of(shard, h)] if len(starts) > 1 else np.full(len(h), starts[0])
    left = np.flatnonzero(first >= 0)
    block = first[left] + plan.block_of(shard, h[left])
    other = mix(h[left] ^ _U(0xBB67AE8584CAA73B))
    for i in range(PROBES):
        place = (other >> _U(9 * i)) & _U(BLOCK_BITS - 1)
        hit = (filters[block, (place >> _U(6)).astype(np.int64)] >> (place & _U(63))) & _U(1) == 1
        left, block, other = left[hit], block[hit], other[hit]
    return left


def candidates(words: DataFrame, plan: Plan, number: int, filters: np.ndarray, alphabet: list[int]) -> DataFrame:
    """Generated edits that the filters of this round hold: word, n, near."""
    shared = words.sparkSession.sparkContext.broadcast(filters)

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            counts = dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for group in _groups(list(counts)):
                edits = [(group.length - 1, "", group.deletions)]
                edits += [(group.length, chr(a), lambda a=a: group.replacements(a)) for a in alphabet]
                for length, letter, make in edits:
                    if min(length, LAST_LENGTH) not in plan.shards:
                        continue
                    row, at, h = make()
                    found = _probe(h, length, plan, number, table)
                    # Long words are spelt out in small batches.
                    step = max(1, _CELLS // group.length)
                    for i in range(0, len(found), step):
                        some = found[i : i + step]
                        own = [group.words[r] for r in row[some]]
                        near = [w[:p] + letter + w[p + 1 :] for w, p in zip(own, at[some])]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(own, pa.string()), pa.array([counts[w] for w in own], pa.int64()), pa.array(near, pa.string())],
                            names=["word", "n", "near"],
                        )

    return words.select("word", "n").mapInArrow(generate, "word string, n long, near string")


def near_words(words: DataFrame, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """Pairs of words of the table (word, n) that differ by one letter, each once: word, n, near, near_n."""
    lengths = F.least(F.length("word"), F.lit(LAST_LENGTH))
    plan = Plan({r.shard: r.n for r in words.groupBy(lengths.alias("shard")).agg(F.count(F.lit(1)).alias("n")).collect()}, round_bytes)
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).distinct()
    alphabet = sorted(ord(r.letter) for r in letters.collect() if r.letter)
    found = None
    for number in range(len(plan.rounds)):
        some = candidates(words, plan, number, build_filters(words, plan, number), alphabet)
        found = some if found is None else found.unionByName(some)
    exact = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    if found is None:
        return words.select("word", "n").join(exact, F.lit(False))
    return found.join(exact, "near").select("word", "n", "near", "near_n")


def _roots(links: DataFrame) -> DataFrame:
    """Follows word to form to the last form; each round doubles the way, so a chain of k forms takes log2(k) rounds."""
    at = links.select("word", F.col("form").alias("root"))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(
            at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots"
        )
        at = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return at


def variants(documents: DataFrame, letters: int = LEAST_LETTERS, least: int = LEAST_COUNT, ratio: int = RATIO, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """Per word its near words, the form it is a variant of and the root of that form.

    The form is the near word of largest count, where that is at least ``ratio`` times the word's
    own. Counts grow along a chain of forms, so it ends; without a form a word is its own root.
    """
    words = materialize(vocabulary(documents, letters, least), "vocabulary")
    pairs = near_words(words, round_bytes)
    both = F.explode(
        F.array(
            F.struct("word", "n", "near", "near_n"),
            F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")),
        )
    )
    best = F.min(F.struct(-F.col("near_n"), "near"))
    per_word = pairs.select(both.alias("p")).select("p.*").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    largest = F.when(-F.col("best.col1") >= ratio * F.col("n"), F.col("best"))
    table = materialize(
        words.join(per_word, "word", "left").select(
            "word", largest["near"].alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), (-largest["col1"]).alias("form_n")
        ),
        "forms",
    )
    roots = _roots(table.filter(F.col("form").isNotNull()))
    return table.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT id, run, count(*) AS c FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run
    FROM documents) GROUP BY ALL),
bytes AS (
  SELECT run, c, [4294967295::UBIGINT] || flatten(list_transform(
    list_filter(string_split(id || ':' || run, ''), lambda x: x <> ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::UBIGINT, 256, 256, 256, 256, 256, 256, 256, 256]
         ELSE [195, 256, 256, 256, 256, 256, 256, 256, 256, (unicode(x) - 64)::UBIGINT, 256, 256, 256, 256, 256, 256, 256, 256] END)) AS b
  FROM runs),
hashed AS (
  SELECT run, c, xor(4294967295::UBIGINT, list_reduce(b, lambda a, x:
    CASE WHEN x < 256 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::UBIGINT) ELSE a // 2 END)) AS h
  FROM bytes),
damaged AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, c FROM hashed),
words AS (SELECT word, sum(c)::BIGINT AS n FROM damaged WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
cut AS (SELECT DISTINCT word, n, substr(word, 1, (i - 1)::INT) || substr(word, (i + 1)::INT) AS rest FROM places),
holes AS (SELECT word, n, i, substr(word, 1, (i - 1)::INT) || substr(word, (i + 1)::INT) AS rest FROM places),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION ALL SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, n, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word, n),
forms AS (SELECT word, near AS form, near_n AS form_n FROM best WHERE near_n >= 2 * n),
chain AS (
  SELECT word, form AS now FROM forms UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.now = f.word),
roots AS (SELECT word, now AS root FROM chain WHERE now NOT IN (SELECT word FROM forms))
SELECT w.word, f.form, coalesce(r.root, w.word) AS root, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near, f.form_n
FROM words w LEFT JOIN best b ON b.word = w.word LEFT JOIN forms f ON f.word = w.word LEFT JOIN roots r ON r.word = w.word
"""


@query("op11_spelling_variants", _SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(read(spark, sf_dir, "documents"))
