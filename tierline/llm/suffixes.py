"""Removal of repeated byte strings by hash-compared suffix sorting.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts anywhere else.
Comparing every suffix of the corpus with every other would move each byte many times,
so suffixes are first dealt by anchors: the anchor of a window of ``LENGTH`` bytes is the
rightmost minimal ``GRAM``-byte gram hash in it. Equal windows have equal anchors at equal
offsets, and each anchor owns a run of consecutive windows. Then

1. anchors that occur once own no repeated window; runs that occur twice as a whole are
   repeated as a whole (compared by hash and length),
2. the other runs of an anchor, one copy of each, meet as suffixes at their anchor: a merge
   sort whose comparisons find the common extension by binary search over prefix hashes
   gives each suffix its longest match to the right, a second sort of the reversed left
   sides the longest to the left. Both bound the windows that can repeat; those are matched
   by hash and verified byte by byte,
3. an anchor with more than ``GROUP`` different runs is split by ranges of window hashes.

Null and empty texts have no bytes. Each row counts as an occurrence, so repeated rows of
500 bytes remove each other as copies under different ids do. Only ``doc_id`` and ``text``
are read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.spread import materialize
from tierline.llm.common import partitions_for, query, read
from tierline.llm.hashing import Prefix, mix, slices, sliding_min, text_bytes

LENGTH = 400
GRAM = 32
GROUP = 512
_PLACE_BITS = 28
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)
_U = np.uint64


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    """Anchors of the rows: row, position, first and last window start it owns, gram hash and hash of the whole run."""
    prefix = Prefix(data)
    n = len(data)
    if n < length:
        empty = np.zeros(0, np.int64)
        return {"row": empty, "at": empty, "first": empty, "last": empty, "gram": empty.view(np.uint64), "run": empty.view(np.uint64)}
    starts = np.arange(n - gram + 1)
    grams = mix(prefix.raw(starts, starts + gram))
    ranked = (grams & ~_PLACE) | (_PLACE - starts.astype(np.uint64) % (_PLACE + _U(1)))
    best = sliding_min(ranked, length - gram + 1)
    begin = np.arange(len(best))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(best)]
    valid = begin + length <= offsets[row + 1]
    begin, row, at = begin[valid], row[valid], (_PLACE - (best[valid] & _PLACE)).astype(np.int64)
    new = np.ones(len(begin), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    heads = np.flatnonzero(new)
    first = begin[heads]
    last = begin[np.append(heads[1:], len(begin)) - 1] if len(heads) else first
    at, row = at[heads], row[heads]
    run = mix(prefix.spans(first, last + length) + (at - first).astype(np.uint64) * _U(0x2545F4914F6CDD1D)) if len(heads) else first.view(np.uint64)
    base = offsets[row]
    return {"row": row, "at": at - base, "first": first - base, "last": last - base, "gram": grams[at] if len(heads) else run, "run": run}


ANCHORS = "doc_id long, print long, gram long, run long, at long, first long, last long"


def _keyed(documents: DataFrame) -> DataFrame:
    """Rows by id and fingerprint of the text, so that ids that repeat with another text stay apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("print"), text.alias("text"))


def find_anchors(keyed: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            a = anchors(*text_bytes(part.column(2)), length, gram)
            rows = pa.array(a["row"])
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(rows), part.column(1).take(rows), pa.array(a["gram"].view(np.int64)), pa.array(a["run"].view(np.int64)),
                 pa.array(a["at"]), pa.array(a["first"]), pa.array(a["last"])],
                names=["doc_id", "print", "gram", "run", "at", "first", "last"],
            )

    return keyed.mapInArrow(scan, ANCHORS)


class Suffixes:
    """Different runs of one anchor; ``anchor[i]`` is the anchor's place in ``texts[i]``."""

    def __init__(self, texts: list[bytes], anchor: list[int]) -> None:
        self.texts, self.anchor = texts, anchor
        self.sums, self.down = [], None
        self.arrays = [Prefix(np.frombuffer(t, np.uint8)) for t in texts]
        self.sums = [p.sums.tolist() for p in self.arrays]

    def _same(self, i: int, a: int, j: int, b: int, n: int) -> bool:
        """Whether ``n`` bytes from a in i and from b in j have one hash."""
        x, y = self.sums[i], self.sums[j]
        left, right = (x[a + n] - x[a]) & _MASK, (y[b + n] - y[b]) & _MASK
        if a >= b:
            return left == (right * _power(a - b)) & _MASK
        return right == (left * _power(b - a)) & _MASK

    def right(self, i: int, j: int) -> int:
        """Bytes that i and j share from the anchor on: binary search over prefix hashes."""
        a, b = self.anchor[i], self.anchor[j]
        lo, hi = 0, min(len(self.texts[i]) - a, len(self.texts[j]) - b)
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if self._same(i, a, j, b, mid):
                lo = mid
            else:
                hi = mid - 1
        if self.texts[i][a : a + lo] != self.texts[j][b : b + lo]:  # a collision: count byte by byte
            lo = next(k for k in range(lo) if self.texts[i][a + k] != self.texts[j][b + k])
        return lo

    def left(self, i: int, j: int) -> int:
        """Bytes that i and j share before the anchor."""
        a, b = self.anchor[i], self.anchor[j]
        lo, hi = 0, min(a, b)
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if self._same(i, a - mid, j, b - mid, mid):
                lo = mid
            else:
                hi = mid - 1
        if self.texts[i][a - lo : a] != self.texts[j][b - lo : b]:
            lo = next(k for k in range(lo) if self.texts[i][a - 1 - k] != self.texts[j][b - 1 - k])
        return lo

    def longest(self, shared, byte) -> list[int]:
        """For each suffix the longest extension it shares with any other, after a merge sort by ``shared``."""

        def compare(i: int, j: int) -> int:
            n = shared(i, j)
            return byte(i, n) - byte(j, n)

        order = sorted(range(len(self.texts)), key=functools.cmp_to_key(compare))
        best = [0] * len(order)
        for i, j in zip(order, order[1:]):
            n = shared(i, j)
            best[i], best[j] = max(best[i], n), max(best[j], n)
        return best

    def bounds(self) -> tuple[list[int], list[int]]:
        def after(i: int, n: int) -> int:
            at = self.anchor[i] + n
            return self.texts[i][at] if at < len(self.texts[i]) else -1

        def before(i: int, n: int) -> int:
            at = self.anchor[i] - 1 - n
            return self.texts[i][at] if at >= 0 else -1

        if len(self.texts) == 2:
            r, left = self.right(0, 1), self.left(0, 1)
            return [r, r], [left, left]
        return self.longest(self.right, after), self.longest(self.left, before)

    def repeated(self, length: int) -> list[tuple[int, int, int]]:
        """(run, first, last): windows, by start in the run, that some other run holds too."""
        right, left = self.bounds()
        kept = []
        for i, text in enumerate(self.texts):
            a = self.anchor[i]
            first, last = max(0, a - left[i]), min(len(text), a + right[i]) - length
            if first <= last:
                kept.append((i, first, last))
        if len(self.texts) == 2:
            return kept
        who = np.concatenate([np.full(last - first + 1, i) for i, first, last in kept]) if kept else np.zeros(0, int)
        if not len(who):
            return []
        start = np.concatenate([np.arange(first, last + 1) for _, first, last in kept])
        hashes = np.concatenate([self.arrays[i].raw(np.arange(f, last + 1), np.arange(f, last + 1) + length) for i, f, last in kept])
        offset = np.array(self.anchor)[who] - start
        order = np.lexsort((who, offset, hashes))
        h, o, w, s = hashes[order], offset[order], who[order], start[order]
        head = np.ones(len(h), bool)
        head[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
        group = np.cumsum(head) - 1
        size = np.bincount(group)
        partner = w[np.flatnonzero(head)][group]
        second = np.flatnonzero(head) + 1
        heads_partner = w[np.minimum(second, len(w) - 1)][group]
        partner = np.where(head, heads_partner, partner)
        twice = size[group] > 1
        w, s, o, partner = w[twice], s[twice], o[twice], partner[twice]
        order = np.lexsort((s, w))
        w, s, o, partner = w[order], s[order], o[order], partner[order]
        cut = np.ones(len(w) + 1, bool)
        if len(w):
            cut[1:-1] = (w[1:] != w[:-1]) | (s[1:] != s[:-1] + 1) | (partner[1:] != partner[:-1])
        edges = np.flatnonzero(cut)
        out = []
        for x, y in zip(edges, edges[1:]):
            i, j = int(w[x]), int(partner[x])
            first, last = int(s[x]), int(s[y - 1])
            other = self.anchor[j] - int(o[x])
            if self.texts[i][first : last + length] == self.texts[j][other : other + last - first + length]:
                out.append((i, first, last))
            else:  # a collision: each window by its bytes against every other run
                for t in range(first, last + 1):
                    part, gap = self.texts[i][t : t + length], self.anchor[i] - t
                    if any(k != i and self.anchor[k] >= gap and self.texts[k][self.anchor[k] - gap :][:length] == part for k in range(len(self.texts))):
                        out.append((i, t, t))
        return out


_MASK = (1 << 64) - 1


@functools.lru_cache(maxsize=4096)
def _power(n: int) -> int:
    from tierline.llm.hashing import BASE

    return pow(int(BASE), n, 1 << 64)


RUNS = "gram long, part int, run long, anchor int, body binary"
FOUND = "gram long, run long, first int, last int"


def _cut_runs(rows: DataFrame, length: int) -> DataFrame:
    """The bytes of each chosen run; of an anchor with many runs, its window hashes by range of hash instead."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 20):
            data, offsets = text_bytes(part.column(0))
            out: list[tuple] = []
            for i, chosen in enumerate(part.column(1).to_pylist()):
                text = data[offsets[i] : offsets[i + 1]]
                for c in chosen:
                    body = text[c["first"] : c["last"] + length]
                    anchor = c["at"] - c["first"]
                    if c["parts"] == 1:
                        out.append((c["gram"], 0, c["run"], anchor, body.tobytes()))
                        continue
                    begin = np.arange(c["last"] - c["first"] + 1)
                    hashes = mix(Prefix(body).raw(begin, begin + length) + (anchor - begin).astype(np.uint64))
                    bucket = (hashes >> _U(40)) % _U(c["parts"])
                    for b in np.unique(bucket):
                        mine = bucket == b
                        packed = np.concatenate([hashes[mine], begin[mine].astype(np.uint64)])
                        out.append((c["gram"], int(b) + 1, c["run"], anchor, packed.tobytes()))
            columns = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()))],
                names=["gram", "part", "run", "anchor", "body"],
            )

    return rows.mapInArrow(cut, RUNS)


def _in_ranges(start: np.ndarray) -> list[tuple[int, int]]:
    start = np.sort(start)
    cuts = np.flatnonzero(np.diff(start) != 1) + 1
    return [(int(x[0]), int(x[-1])) for x in np.split(start, cuts) if len(x)]


def _group(gram: int, part: int, rows: list[tuple[int, int, bytes]], length: int) -> list[tuple[int, int, int, int]]:
    if len({r[0] for r in rows}) < 2:
        return []
    if part == 0:
        found = Suffixes([r[2] for r in rows], [r[1] for r in rows]).repeated(length)
        return [(gram, rows[i][0], first, last) for i, first, last in found]
    halves = [np.frombuffer(r[2], np.uint64).reshape(2, -1) for r in rows]
    hashes, start = np.concatenate([x[0] for x in halves]), np.concatenate([x[1] for x in halves]).astype(np.int64)
    who = np.repeat(np.arange(len(rows)), [x.shape[1] for x in halves])
    _, inverse, size = np.unique(hashes, return_inverse=True, return_counts=True)
    twice = size[inverse] > 1
    return [(gram, rows[i][0], a, b) for i in np.unique(who[twice]) for a, b in _in_ranges(start[twice & (who == i)])]


def _match(runs: DataFrame, length: int) -> DataFrame:
    """Repeated windows of each run; the runs of an anchor are consecutive rows of one sorted partition."""

    def flush(out: list) -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["gram", "run", "first", "last"]
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, [], []
        for batch in slices(batches, "body"):
            for gram, part, run, anchor, body in zip(*(c.to_pylist() for c in batch.columns)):
                if (gram, part) != key:
                    if key:
                        out += _group(*key, rows, length)
                    key, rows = (gram, part), []
                rows.append((run, anchor, body))
            yield flush(out)
            out = []
        yield flush(_group(*key, rows, length) if key else [])

    dealt = runs.repartition(partitions_for(runs), "gram", "part").sortWithinPartitions("gram", "part", "run")
    return dealt.mapInArrow(work, FOUND)


def repeated_spans(documents: DataFrame, *, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Every row with ``doc_id``, its whole ``text`` (null: empty) and ``cuts``: start and end of byte runs to remove."""
    keyed = _keyed(documents)
    found = materialize(find_anchors(keyed, length, gram), "anchors")
    runs = found.groupBy("gram", "run").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "print", "at", "first", "last")).alias("one")
    )
    by_gram = runs.groupBy("gram").agg(
        F.sum("n").alias("all"), F.count(F.lit(1)).alias("different"), F.min("n").alias("rarest")
    ).filter("all > 1")
    runs = materialize(runs.join(by_gram, "gram"), "runs")

    # Each different run once, where an anchor has several and one of them may hold unique windows.
    open_runs = runs.filter("different > 1 AND rarest = 1").select(
        F.col("one.doc_id").alias("doc_id"), F.col("one.print").alias("print"),
        F.struct("gram", "run", "one.at", "one.first", "one.last", F.ceil(F.col("different") / GROUP).cast("int").alias("parts")).alias("c"),
    )
    chosen = open_runs.groupBy("doc_id", "print").agg(F.collect_list("c").alias("chosen"))
    # Null ids are ids like others.
    def same() -> Column:
        return F.col("print").eqNullSafe(F.col("__print")) & F.col("doc_id").eqNullSafe(F.col("__id"))

    chosen = chosen.withColumnsRenamed({"doc_id": "__id", "print": "__print"})
    one_each = keyed.join(chosen, same()).dropDuplicates(["doc_id", "print"]).select("text", "chosen")
    partly = _match(_cut_runs(one_each, length), length)

    whole = runs.filter("n > 1").select("gram", "run", F.lit(0).alias("a"), (F.col("one.last") - F.col("one.first")).cast("int").alias("b"))
    once = runs.filter("n = 1").select("gram", "run")
    partly = partly.join(once, ["gram", "run"], "left_semi").select("gram", "run", F.col("first").alias("a"), F.col("last").alias("b"))
    windows = whole.unionByName(partly)
    cuts = found.join(windows, ["gram", "run"]).groupBy("doc_id", "print").agg(
        F.sort_array(F.collect_set(F.struct((F.col("first") + F.col("a")).alias("start"), (F.col("first") + F.col("b") + length).alias("end")))).alias("cuts")
    )
    merged = F.aggregate(
        "cuts", F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda done, c: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= c["start"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], c["end"]).alias("end")))),
        ).otherwise(F.concat(done, F.array(c))),
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    cuts = cuts.withColumn("cuts", merged).withColumnsRenamed({"doc_id": "__id", "print": "__print"})
    return keyed.join(cuts, same(), "left").select(
        "doc_id", "text", F.coalesce("cuts", none).alias("cuts")
    )


def kept_bytes(text: bytes, cuts: list[dict]) -> bytes:
    kept, at = [], 0
    for c in cuts:
        kept.append(text[at : c["start"]])
        at = c["end"]
    return b"".join([*kept, text[at:]])


@query("op10_suffix_dedup")
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests, and as a further column the text that is left (a character cut in two shows as U+FFFD)."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts, cuts = part.column(1).cast(pa.large_binary()).to_pylist(), part.column(2).to_pylist()
            left = [kept_bytes(t, c) for t, c in zip(texts, cuts)]
            removed = [sum(c["end"] - c["start"] for c in x) for x in cuts]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(removed, pa.int64()),
                 pa.array([len(x) for x in cuts], pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in left], pa.string()),
                 pa.array([t.decode("utf-8", "replace") for t in left], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"],
            )

    return repeated_spans(read(spark, sf_dir, "documents")).mapInArrow(
        digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string"
    )
