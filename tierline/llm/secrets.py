"""Secrets in texts: fixed forms, and strings that a Markov model takes for random.

Fixed forms (``assign``, ``access``, ``hex``) are found by patterns. Other long tokens are
scored with two character Markov models, one of random strings and one of ordinary
identifiers: the sum over the token of log P(next | this; random) - log P(next | this; identifier).
A token above ``MARGIN`` per step becomes a span of kind ``markov``. Where a fixed form covers
a part of a token, what is left on either side is scored by itself, so a span never overlaps
one of a fixed form and a secret beside one is not lost. Tokens and parts below
``CANDIDATE_LENGTH`` characters are not scored. The models are counts of character pairs in
labelled samples.

DataFrame functions only. A pattern's matches and what lies between them (``split`` by the same
pattern) give the positions, in code points, by a running sum; patterns see every whole text, the
sums only texts with a match. Null and empty texts have no spans; repeated rows are scanned
alike; ties are ordered by start, then kind. Only ``doc_id`` and ``text`` are read, other columns
are handed on by ``redact``.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import query, read, text_of

# The patterns of the base kinds, in their order.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "markov")

CANDIDATE_LENGTH = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{CANDIDATE_LENGTH},}}"
ASSIGN_VALUE = 8
MARGIN = 0.5
#: Documents (those with the smallest hash of their id) whose words are the labelled identifiers.
TRAINING_DOCUMENTS = 2000
#: Generated random strings of each form among the labelled samples.
RANDOM_SAMPLES = 2000
#: Weight of a character's own frequency against the pairs seen after another one.
BACKOFF = 5.0
IDENTIFIER = r"[A-Za-z][A-Za-z0-9_-]{5,}"
_CODES = 128
_CHUNK = 512
_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _starts(lengths: Column) -> Column:
    """Sum of all lengths before each; in chunks, so that many matches stay linear."""
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _CHUNK).cast("int")), lambda c: F.slice(lengths, c * _CHUNK + 1, F.lit(_CHUNK)))

    def within(base: Column, chunk: Column) -> Column:
        first = F.struct(F.array().cast("array<int>").alias("at"), base.alias("sum"))
        return F.aggregate(chunk, first, lambda a, n: F.struct(F.concat(a["at"], F.array(a["sum"])).alias("at"), (a["sum"] + n).alias("sum")))

    def step(acc: Column, chunk: Column) -> Column:
        return F.struct(
            F.concat(acc["parts"], F.array(within(acc["sum"], chunk)["at"])).alias("parts"),
            (acc["sum"] + F.aggregate(chunk, F.lit(0), lambda s, n: s + n)).alias("sum"),
        )

    return F.aggregate(chunks, F.struct(F.array().cast("array<array<int>>").alias("parts"), F.lit(0).alias("sum")), step, lambda a: F.flatten(a["parts"]))


def _matches(text: Column, pattern: str, kind: int, keep: Callable[[Column], Column] | None = None, group: int = 0) -> Column:
    """Spans of the pattern's matches whose ``group`` passes ``keep``."""
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    judged = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(group + 1)) if group else found
    steps = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda a, b: F.length(a) + F.length(b))
    rows = F.zip_with(
        F.zip_with(_starts(steps), F.zip_with(steps, found, lambda s, m: F.struct((s - F.length(m)).alias("gap"), s.alias("step"))),
                   lambda at, x: F.struct((at + x["gap"]).alias("start"), (at + x["step"]).alias("end"))),
        judged, lambda span, value: F.struct(span["start"].alias("start"), F.lit(kind).alias("kind"), span["end"].alias("end"), value.alias("value")),
    )
    if keep is not None:
        rows = F.filter(rows, lambda r: keep(r["value"]))
    return F.when(text.rlike(pattern), rows)


def _plain(spans: Column) -> Column:
    return F.transform(spans, lambda r: F.struct(r["start"].cast("int").alias("start"), r["kind"].alias("kind"), r["end"].cast("int").alias("end")))


@dataclass(frozen=True)
class Markov:
    """Log-likelihood ratio of every pair of ASCII characters, row by row of the first."""

    ratios: tuple[float, ...]

    def score(self, token: Column) -> Column:
        """Mean ratio of the steps of an ASCII token."""
        table = F.split(F.lit(",".join(map(str, self.ratios))), ",").cast("array<double>")  # a constant of the plan
        steps = F.transform(F.sequence(F.lit(1), F.length(token) - 1), lambda i: F.ascii(F.substring(token, i, F.lit(1))) * _CODES + F.ascii(F.substring(token, i + 1, F.lit(1))))
        return F.aggregate(steps, F.lit(0.0), lambda s, i: s + F.get(table, i)) / F.greatest(F.length(token) - 1, F.lit(1))


def train(samples: DataFrame) -> Markov:
    """From labelled samples (``sample``, ``random``). The driver gets at most two rows a pair of ASCII characters."""
    ascii_only = samples.filter(F.col("sample").rlike(r"^[\x01-\x7F]{2,}$"))
    pairs = ascii_only.select("random", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("sample") - 1),
        lambda i: F.ascii(F.substring(F.col("sample"), i, F.lit(1))) * _CODES + F.ascii(F.substring(F.col("sample"), i + 1, F.lit(1))),
    )).alias("pair"))
    counts = {True: [0] * _CODES**2, False: [0] * _CODES**2}
    for r in pairs.groupBy("random", "pair").count().collect():
        counts[r["random"]][r["pair"]] = r["count"]
    seen = sorted({c for n in counts.values() for i, x in enumerate(n) if x for c in divmod(i, _CODES)})

    def logs(n: list[int]) -> list[float]:
        """Pairs smoothed with how often their second character occurs at all."""
        first = [sum(n[a * _CODES : (a + 1) * _CODES]) for a in range(_CODES)]
        second = [sum(n[b::_CODES]) for b in range(_CODES)]
        whole = sum(second) + 0.5 * max(len(seen), 1)
        return [math.log((x + BACKOFF * (second[i % _CODES] + 0.5) / whole) / (first[i // _CODES] + BACKOFF)) for i, x in enumerate(n)]

    random, ordinary = logs(counts[True]), logs(counts[False])
    known = set(seen)
    ratios = [round(a - b, 4) if i // _CODES in known and i % _CODES in known else 0.0 for i, (a, b) in enumerate(zip(random, ordinary))]
    return Markov(tuple(ratios))


def labelled_samples(documents: DataFrame, limit: int = TRAINING_DOCUMENTS, generated: int = RANDOM_SAMPLES) -> DataFrame:
    """Random: generated digests in the usual alphabets. Ordinary: words of ``limit`` documents, without what the fixed forms find."""
    spark = documents.sparkSession
    digest = F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")), 256)
    forms = F.array(
        digest, F.rtrim(F.base64(F.unhex(digest)), F.lit("=")), F.translate(F.base64(F.unhex(digest)), "+/=", "-_"), F.upper(F.conv(F.substring(digest, 1, 15), 16, 36)),
        F.concat(F.conv(F.substring(digest, 1, 15), 16, 36), F.conv(F.substring(digest, 16, 15), 16, 36)),
    )
    random = spark.range(generated).select(F.explode(forms).alias("sample"), F.lit(True).alias("random"))
    ids = documents.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)  # ``limit`` numbers
    chosen = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi")
    clean = F.regexp_replace(F.regexp_replace(text_of(), ASSIGN, " "), f"{ACCESS}|{HEX}", " ")
    words = chosen.select(F.explode(F.regexp_extract_all(clean, F.lit(f"({IDENTIFIER})"), F.lit(1))).alias("sample"), F.lit(False).alias("random"))
    return random.unionByName(words)


def _beside(tokens: Column, base: Column) -> Column:
    """The tokens without what the base spans cover, in parts of ``CANDIDATE_LENGTH`` characters or more."""

    def parts(t: Column) -> Column:
        inside = F.array_sort(F.filter(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
        part = lambda start, end: F.array(F.struct(start.alias("start"), end.alias("end")))
        long_enough = lambda start, end: end - start >= CANDIDATE_LENGTH
        first = F.struct(F.array().cast("array<struct<start:int,end:int>>").alias("out"), t["start"].alias("at"))

        def step(acc: Column, b: Column) -> Column:
            out = F.when(long_enough(acc["at"], b["start"]), F.concat(acc["out"], part(acc["at"], b["start"]))).otherwise(acc["out"])
            return F.struct(out.alias("out"), F.greatest(acc["at"], b["end"]).alias("at"))

        left = F.aggregate(inside, first, step, lambda a: F.when(long_enough(a["at"], t["end"]), F.concat(a["out"], part(a["at"], t["end"]))).otherwise(a["out"]))
        return F.transform(left, lambda g: F.struct(
            g["start"].alias("start"), t["kind"].alias("kind"), g["end"].alias("end"), F.substring(t["value"], g["start"] - t["start"] + 1, g["end"] - g["start"]).alias("value")
        ))

    return F.flatten(F.transform(tokens, parts))


def with_spans(documents: DataFrame, model: Markov, *, margin: float = MARGIN, into: str = "secrets") -> DataFrame:
    """``documents`` with ``into``: all spans by start, then kind (a number into ``KINDS``)."""
    text = text_of()
    none = F.array().cast(_SPANS)
    base = F.concat(
        F.coalesce(_plain(_matches(text, ASSIGN, 0, lambda v: F.length(v) >= ASSIGN_VALUE, 1)), none),
        F.coalesce(_plain(_matches(text, ACCESS, 1)), none), F.coalesce(_plain(_matches(text, HEX, 2)), none),
    )
    tokens = _matches(text, CANDIDATE, 3)
    staged = documents.withColumn("__base", base).withColumn("__tokens", F.coalesce(tokens, F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")))
    odd = F.filter(_beside(F.col("__tokens"), F.col("__base")), lambda t: model.score(t["value"]) > margin)
    found = F.when(F.size("__tokens") > 0, F.concat("__base", _plain(odd))).otherwise(F.col("__base"))
    return staged.withColumn(into, F.array_sort(found)).drop("__base", "__tokens")


def spelled(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(documents: DataFrame, model: Markov, *, mark: str = "[secret]") -> DataFrame:
    """``documents`` with the same columns; every span, overlapping ones as one, replaced by ``mark``."""
    marked = with_spans(documents, model, into="__secrets")
    text = F.col("text")
    first = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        new = F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))
        return F.struct(F.when(s["start"] >= acc["at"], new).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    kept = F.aggregate("__secrets", first, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text))))
    hit = F.size("__secrets") > 0
    out = marked.withColumn("text", F.when(hit, kept).otherwise(text))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(hit, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in documents.columns])


@query("op3_secrets")
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(labelled_samples(documents))
    found = with_spans(documents, model).select("doc_id", "secrets")
    base = F.filter("secrets", lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(spelled(base), 256).alias("base_sha256"), spelled(F.col("secrets")).alias("spans"),
    )
