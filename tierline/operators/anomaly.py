"""Comparing a run's profile with the runs before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.names import col
from tierline.functions.spread import top_per_key, trailing_frame
from tierline.operators.profile import metric_value, profile_rows
from tierline.operators.tables import SnapshotTable

METHODS = ("zscore", "pct_change")
_KEYS = ["pipeline_name", "process_id", "run_date"]
#: The number a batch takes when it adds to the history; ids need not grow with time.
RUN_NUMBER = "run_number"


def _run_order(history: DataFrame) -> list[str]:
    return ["run_date", *([RUN_NUMBER] if RUN_NUMBER in history.columns else []), "process_id"]


def append_profile_history(
    table: SnapshotTable, profiles: DataFrame, *, process_id: str, pipeline_name: str, run_date: str
) -> None:
    """Adds a run to the history, also when it is anomalous."""
    table.append(
        profiles.select(
            F.lit(process_id).alias("process_id"), F.lit(pipeline_name).alias("pipeline_name"),
            F.lit(run_date).cast("date").alias("run_date"), "row_count", "metrics",
        )
    )


def trailing_profiles(history: DataFrame, current: DataFrame, *, window: int = 20) -> DataFrame:
    """The last ``window`` runs of each pipeline, the current runs left out."""
    if window < 2:
        raise ValueError("a baseline needs a window of at least 2 runs")
    others = history.join(current.select("process_id").distinct(), "process_id", "left_anti")
    return top_per_key(others, ["pipeline_name"], [F.desc(c) for c in _run_order(history)], window)


def _score(method: str, value: Column, n: Column, mean: Column, stdev: Column, low: Column, high: Column) -> Column:
    infinite = F.lit(float("inf"))
    if method == "pct_change":
        return F.when(mean == 0, F.when(value == 0, 0.0).otherwise(infinite)).otherwise(
            F.try_divide(value - mean, mean)
        )
    # Position of the value among the baseline and itself, with the population
    # deviation of that set, from the baseline's own count, mean and deviation.
    gap = value - mean
    shifted = gap * n / (n + 1)
    spread = F.sqrt(((n - 1) * stdev * stdev + gap * gap * n / (n + 1)) / (n + 1))
    return F.when(low == high, F.when(value == low, 0.0).otherwise(infinite)).otherwise(F.try_divide(shifted, spread))


def _verdicts(df: DataFrame, method: str, threshold: float, keys: list[str]) -> DataFrame:
    if method not in METHODS:
        raise ValueError(f"unsupported method {method!r}")
    score = _score(
        method, F.col("current_value"), F.col("baseline_size").cast("double"), F.col("baseline_mean"),
        F.col("baseline_stdev"), F.col("__low"), F.col("__high"),
    )
    return (
        df.filter(F.col("baseline_size") >= 2)
        .withColumn("method", F.lit(method))
        .withColumn("threshold", F.lit(float(threshold)))
        .withColumn("score", score)
        .withColumn("is_anomaly", F.abs("score") >= F.col("threshold"))
        .select(
            *[col(k) for k in keys], "metric", "current_value", "baseline_mean", "baseline_stdev", "baseline_size",
            "method", "threshold", "score", "is_anomaly",
        )
    )


def detect_anomalies(
    current: DataFrame,
    history: DataFrame,
    metrics: list[str],
    *,
    method: str = "zscore",
    threshold: float = 3.0,
    window: int = 20,
) -> DataFrame:
    """Verdicts for the current runs, one row per metric with at least two baseline values."""
    trailing = trailing_profiles(history, current, window=window)
    baseline = (
        profile_rows(trailing, metrics, ["pipeline_name"])
        .groupBy("pipeline_name", "metric")
        .agg(
            F.count("value").alias("baseline_size"), F.avg("value").alias("baseline_mean"),
            F.stddev_samp("value").alias("baseline_stdev"), F.min("value").alias("__low"), F.max("value").alias("__high"),
        )
    )
    values = profile_rows(current, metrics, _KEYS).withColumnRenamed("value", "current_value")
    return _verdicts(values.join(baseline, ["pipeline_name", "metric"], "inner"), method, threshold, _KEYS)


def score_history(
    history: DataFrame,
    metrics: list[str],
    *,
    method: str = "zscore",
    threshold: float = 3.0,
    window: int = 20,
    block_rows: int = 100_000,
) -> DataFrame:
    """The same verdicts for every run in the history, each against the runs before it."""
    if window < 2:
        raise ValueError("a baseline needs a window of at least 2 runs")
    measures: dict[str, Column] = {}
    for i, m in enumerate(metrics):
        v = F.col(f"__v{i}")
        measures |= {
            f"__n{i}": F.count(v), f"__mean{i}": F.avg(v), f"__sd{i}": F.stddev_samp(v),
            f"__low{i}": F.min(v), f"__high{i}": F.max(v),
        }
    order = _run_order(history)
    wide = history.select(*_KEYS, *order[1:-1], *[metric_value(m).alias(f"__v{i}") for i, m in enumerate(metrics)])
    framed = trailing_frame(
        wide, ["pipeline_name"], order, F.trunc("run_date", "month"), window, measures,
        block_rows=block_rows,
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"), F.col(f"__v{i}").alias("current_value"), F.col(f"__n{i}").alias("baseline_size"),
                F.col(f"__mean{i}").alias("baseline_mean"), F.col(f"__sd{i}").alias("baseline_stdev"),
                F.col(f"__low{i}").alias("__low"), F.col(f"__high{i}").alias("__high"),
            )
            for i, m in enumerate(metrics)
        ]
    )
    rows = framed.select(*_KEYS, F.explode(entries).alias("__e")).select(*_KEYS, "__e.*")
    return _verdicts(rows.filter(F.col("current_value").isNotNull()), method, threshold, _KEYS)


def _shown(value: Column) -> Column:
    whole = (value == F.floor(value)) & (F.abs(value) < 1e16)
    return F.when(whole, F.format_string("%.1f", value)).otherwise(value.cast("string"))


def anomaly_messages(verdicts: DataFrame) -> DataFrame:
    """Alert texts of the flagged metrics."""
    return verdicts.filter("is_anomaly").withColumn(
        "message",
        F.format_string(
            "%s: anomaly detected in %s (current=%s, baseline_mean=%.4f, %s score=%.3f, threshold=%s)",
            F.col("pipeline_name"), F.col("metric"), _shown(F.col("current_value")), F.col("baseline_mean"),
            F.col("method"), F.col("score"), F.col("threshold").cast("string"),
        ),
    )


def anomaly_reasons(verdicts: DataFrame) -> DataFrame:
    """Failure reasons of the flagged metrics, as run results carry them."""
    return verdicts.filter("is_anomaly").withColumn(
        "reason",
        F.format_string(
            "%s: %s score %.3f exceeds threshold %s",
            F.col("metric"), F.col("method"), F.col("score"), F.col("threshold").cast("string"),
        ),
    )


def blocked_runs(verdicts: DataFrame, on_anomaly: str) -> DataFrame:
    """Runs that must not reach gold: those with a flagged metric when the policy is ``quarantine``."""
    if on_anomaly not in ("alert", "quarantine"):
        raise ValueError(f"unknown policy {on_anomaly!r}")
    flagged = verdicts.filter("is_anomaly").select("pipeline_name", "process_id").distinct()
    return flagged if on_anomaly == "quarantine" else flagged.filter(F.lit(False))
