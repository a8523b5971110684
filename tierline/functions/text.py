"""Expressions over text cells. All of them stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierline.functions.formats import spark_pattern

# Fixed value: what counts as a number in a text cell.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# Fixed value: the characters Python's str.strip() removes.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def stripped(value: Column) -> Column:
    """``value`` without leading and trailing whitespace of any kind."""
    return F.btrim(value, F.lit(WHITESPACE))


def blank_to_null(value: Column) -> Column:
    return F.nullif(stripped(value), F.lit(""))


def as_number(value: Column) -> Column:
    """Text as double, NULL where it is not a plain number.

    Spark's own cast also takes surrounding blanks and the ``1d`` / ``1f``
    suffixes, so the pattern decides and the cast only converts.
    """
    return F.when(value.rlike(NUMBER_PATTERN), value.try_cast("double"))


def as_date(value: Column, strptime_format: str) -> Column:
    """Text as date by a strptime format, NULL where it does not parse."""
    return F.try_to_timestamp(value, F.lit(spark_pattern(strptime_format))).cast("date")


def as_decimal(value: Column, precision: int | None, scale: int | None) -> Column:
    target = f"decimal({precision or 38},{scale or 0})"
    return F.when(value.rlike(NUMBER_PATTERN), value.try_cast(target))


def quoted_literal(value: Column) -> Column:
    """``value`` the way key values are shown in reasons: ``'x'``, or ``None`` for NULL."""
    text = value.cast("string")
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(shown))
    has_single, has_double = F.contains(text, F.lit("'")), F.contains(text, F.lit('"'))
    return (
        F.when(text.isNull(), F.lit("None"))
        .when(has_single & ~has_double, F.concat(F.lit('"'), escaped, F.lit('"')))
        .otherwise(F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'")))
    )


def described_key(pairs: list[tuple[str, Column]]) -> Column:
    """``(a='x', b=None)`` from named columns."""
    parts: list[Column] = []
    for n, (name, value) in enumerate(pairs):
        parts += [F.lit(("" if n == 0 else ", ") + name + "="), quoted_literal(value)]
    return F.concat(F.lit("("), *parts, F.lit(")"))


def surrogate_key(values: list[Column], version: Column) -> Column:
    """md5 over the key values (NULL as empty text) and the version, joined by ``|``."""
    parts = [F.coalesce(v.cast("string"), F.lit("")) for v in values]
    return F.md5(F.concat_ws("|", *parts, version.cast("string")))


def last_path_element(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def date_in_file_name(name: Column) -> Column:
    """The first run of eight digits in a file name as a date, else NULL."""
    digits = F.regexp_extract(name, r"([0-9]{8})", 1)
    return F.when(digits != "", F.try_to_timestamp(digits, F.lit("yyyyMMdd")).cast("date"))


def bucket_and_prefix(uri: Column) -> tuple[Column, Column]:
    """Bucket and key of an object-store URI such as ``s3a://bucket/some/key``."""
    pattern = r"^[a-z0-9]+://([^/]+)/?(.*)$"
    return F.regexp_extract(uri, pattern, 1), F.regexp_extract(uri, pattern, 2)


def nested_to_text(value: Column) -> Column:
    """Structs, arrays and maps as JSON text, NULL members kept."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def metrics_to_json(metrics: Column) -> Column:
    return F.to_json(metrics)


def metrics_from_json(text: Column) -> Column:
    return F.from_json(text, "map<string,double>")
