"""Chat formatting: conversations of typed content parts as one training text each.

A message has content parts of type ``text`` or of an attachment type (``image``, ``audio``,
``document``; anything else counts as ``document``). Flattening visits the parts in order: text is
escaped, an attachment leaves a placeholder with its place (turn, part), and its reference and the
number of tokens it expands to are recorded. A turn is ``<turn:role>content</turn>``;
the loss mask covers the content of assistant turns.

Texts and roles escape the characters that open control strings, so none of those can be
forged and reading back gives the same strings. DataFrame functions only. The rows of a conversation
are ordered by turn, then role, then content; one conversation is one record and is put together in one
row. Null texts and roles are empty, null parts give an empty turn, a null conv_id is a conversation
of its own, and a repeated row is a turn of its own. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.functions.spread import materialize
from tierline.llm.common import query, read

TOKENS = {"image": 256, "audio": 128, "document": 512}
ASSISTANT = "assistant"
CLOSE = "</turn>"
PART = "struct<type:string,text:string,ref:string,tokens:int>"
# Each escaped character and what stands for it; the escape character itself comes first.
ESCAPES = (("\\", "\\e"), ("<", "\\l"), (">", "\\g"), ("[", "\\b"))


def escape(text: Column) -> Column:
    for raw, code in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for raw, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def text_part(text: Column) -> Column:
    """The single part of a plain message."""
    none = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"), none.cast("string").alias("ref"), none.cast("int").alias("tokens")))


def _kind(part: Column) -> Column:
    kind = F.coalesce(part["type"], F.lit("document"))
    return F.when(kind.isin("text", *TOKENS), kind).otherwise("document")


def format_conversations(messages: DataFrame, *, tokens: dict[str, int] = TOKENS) -> DataFrame:
    """From rows (conv_id, turn, role, parts): conv_id, formatted, loss (spans in code points), attachments, expanded_tokens."""
    parts = F.coalesce(F.col("parts").cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
    rows = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "parts")
    rows = rows.withColumn("i", F.row_number().over(order) - 1)

    def visit(part: Column, j: Column) -> Column:
        place = F.concat(F.lit("["), _kind(part), F.lit(":"), F.col("i").cast("string"), F.lit("."), j.cast("string"), F.lit("]"))
        return F.when(_kind(part) == "text", escape(F.coalesce(part["text"], F.lit("")))).otherwise(place)

    expands = lambda p: F.coalesce(p["tokens"], *[F.when(_kind(p) == k, F.lit(n)) for k, n in tokens.items()], F.lit(0))
    placed = F.transform("parts", lambda p, j: F.struct(
        F.col("i").alias("turn"), j.alias("part"), _kind(p).alias("type"), p["ref"].alias("ref"), expands(p).cast("int").alias("tokens")))
    turns = rows.select(
        "conv_id", "i", "role", F.concat(F.lit("<turn:"), escape(F.col("role")), F.lit(">")).alias("head"),
        F.array_join(F.transform("parts", visit), "").alias("content"), F.filter(placed, lambda a: a["type"] != "text").alias("attached"),
    ).withColumn("piece", F.concat("head", "content", F.lit(CLOSE)))
    before = Window.partitionBy("conv_id").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + F.length("head")
    spans = turns.withColumn("span", F.when(F.col("role") == ASSISTANT, F.struct(start.alias("start"), (start + F.length("content")).alias("end"))))
    grouped = spans.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("i", "piece", "span", "attached"))).alias("t"))
    attachments = F.flatten(F.col("t.attached"))
    return grouped.select(
        "conv_id", F.array_join("t.piece", "").alias("formatted"), F.filter("t.span", lambda s: s.isNotNull()).alias("loss"),
        attachments.alias("attachments"), F.aggregate(attachments, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )


def parse_turns(formatted: Column) -> Column:
    """Role and content (unescaped; placeholders stay) of each turn of a formatted text."""
    pieces = F.split(formatted, F.lit(CLOSE), -1)
    closed = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    return F.transform(closed, lambda p: F.struct(
        unescape(F.substring(F.substring_index(p, ">", 1), 7, 1 << 30)).alias("role"),
        unescape(F.substring(p, F.instr(p, F.lit(">")) + 1, F.length(p))).alias("text"),
    ))


def loss_text(formatted: Column, loss: Column) -> Column:
    return unescape(F.array_join(F.transform(loss, lambda s: F.substring(formatted, s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int"))), ""))


_ESCAPED_SQL = r"replace(replace(replace(replace({}, '\', '\e'), '<', '\l'), '>', '\g'), '[', '\b')"

OP8_SQL = rf"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
    CAST(coalesce(sum(length(t)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length({_ESCAPED_SQL.format('role')}) + length({_ESCAPED_SQL.format('t')}) + 14) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""


@query("op8_chat_format", OP8_SQL)
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"), F.lit(said).alias("text")
    )
    messages = rows.unionByName(own).select("conv_id", "turn", "role", text_part(F.col("text")).alias("parts"))
    written = materialize(format_conversations(messages), "chat")
    loss = loss_text(F.col("formatted"), F.col("loss"))
    turns = parse_turns(F.col("formatted"))
    return written.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
