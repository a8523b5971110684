"""Draft rules from what the text columns of a batch look like."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.names import col, data_columns
from tierline.functions.text import as_date, as_number

# Date formats that are tried, in order of preference.
DATE_FORMATS = ("%Y%m%d", "%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y", "%Y%d%m")


def profile_text_columns(df: DataFrame, *, formats: tuple[str, ...] = DATE_FORMATS) -> DataFrame:
    """Per text column: NULLs, empty cells, numbers, dates per format and the smallest number.

    One aggregation over all columns, then one row per column.
    """
    names = data_columns(df.columns)
    parts = [F.count(F.lit(1)).alias("__rows")]
    for i, name in enumerate(names):
        value = col(name).cast("string")
        number = as_number(value)
        parts += [
            F.count_if(value.isNull()).alias(f"__{i}_null"),
            F.count_if(F.length(value) == 0).alias(f"__{i}_empty"),
            F.count(number).alias(f"__{i}_num"),
            F.min(number).alias(f"__{i}_min"),
            F.coalesce(F.max(F.length(F.regexp_extract(value, r"^[+-]?[0-9]+\.([0-9]+)$", 1))), F.lit(0)).alias(f"__{i}_scale"),
        ]
        parts += [F.count(as_date(value, f)).alias(f"__{i}_date{j}") for j, f in enumerate(formats)]
    totals = df.agg(*parts)
    entries = []
    for i, name in enumerate(names):
        hits = [F.col(f"__{i}_date{j}") for j in range(len(formats))]
        best = F.greatest(*hits, F.lit(0))
        chosen = F.coalesce(*[F.when((h == best) & (h > 0), F.lit(f)) for h, f in zip(hits, formats)])
        entries.append(
            F.struct(
                F.lit(i).alias("column_no"), F.lit(name).alias("column_name"), F.col(f"__{i}_null").alias("null_count"),
                F.col(f"__{i}_empty").alias("empty_count"), F.col(f"__{i}_num").alias("numeric_count"),
                F.col(f"__{i}_min").alias("min_number"), F.col(f"__{i}_scale").alias("max_scale"),
                best.cast("long").alias("date_count"), chosen.alias("date_format"),
            )
        )
    return totals.select(F.col("__rows").alias("row_count"), F.explode(F.array(*entries)).alias("e")).select("row_count", "e.*")


def _confidence(rate: Column) -> Column:
    return F.when(rate >= 1, "high").when(rate >= 0.99, "medium").otherwise("low")


def suggest_rules(df: DataFrame, *, formats: tuple[str, ...] = DATE_FORMATS, least: float = 0.95) -> DataFrame:
    """Suggested checks and casts with a reason and a confidence; nothing is applied.

    A check is proposed where at least ``least`` of the values would pass it.
    """
    stats = profile_text_columns(df, formats=formats)
    filled = F.col("row_count") - F.col("null_count")
    present = F.coalesce(F.try_divide(filled, F.col("row_count")), F.lit(0.0))
    non_empty = F.coalesce(F.try_divide(filled - F.col("empty_count"), filled), F.lit(0.0))
    dates = F.coalesce(F.try_divide(F.col("date_count"), filled), F.lit(0.0))
    numbers = F.coalesce(F.try_divide(F.col("numeric_count"), filled), F.lit(0.0))
    is_date = dates >= least
    is_number = (numbers >= least) & ~is_date
    none = F.lit(None).cast("string")

    def rule(when: Column, check: str, rate: Column, why: str, fmt: Column = none, cast: Column = none) -> Column:
        why_text = F.format_string(f"%.1f%% of %d values {why}", rate * 100, F.col("row_count"))
        return F.when(
            when,
            F.struct(
                F.lit(check).alias("check_name"), fmt.alias("format"), cast.alias("cast_to"),
                why_text.alias("rationale"), _confidence(rate).alias("confidence"),
            ),
        )

    decimal = F.concat(F.lit("decimal(38,"), F.col("max_scale").cast("string"), F.lit(")"))
    proposals = F.array_compact(
        F.array(
            rule(present >= least, "not_null", present, "are present"),
            rule((non_empty >= least) & (filled > 0), "non_empty", non_empty, "are not empty"),
            rule(is_date, "valid_date", dates, "parse as dates", F.col("date_format"), F.lit("date")),
            rule(is_number, "is_numeric", numbers, "are numbers", none, decimal),
            rule(is_number & (F.col("min_number") >= 0), "greater_than_or_equal 0", numbers, "are numbers, none below zero"),
        )
    )
    return stats.select("column_no", "column_name", F.posexplode(proposals).alias("rule_no", "r")).select(
        "column_no", "column_name", "rule_no", "r.*"
    )
