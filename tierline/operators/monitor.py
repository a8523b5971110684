"""Step and run logs, and outcomes of ordered batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.names import col
from tierline.functions.spread import HOT_ROWS, attach_by_key, top_per_key

LAYERS = ("raw", "stage", "gold")
STATUSES = ("begin", "complete", "failed", "quarantined")

STEP_EVENT = (
    "process_id string, pipeline_name string, step string, target_table string, "
    "row_count_in long, row_count_out long, status string, event_at timestamp"
)
RUN_RESULT = (
    "run_id string, pipeline_name string, file_path string, file_checksum string, status string, "
    "layer_reached string, failure_reasons array<string>, started_at timestamp"
)


def layers_to_run(stop_after: str) -> tuple[str, ...]:
    """The layers up to and including ``stop_after``."""
    if stop_after not in LAYERS:
        raise ValueError(f"unknown layer {stop_after!r}; one of {LAYERS}")
    return LAYERS[: LAYERS.index(stop_after) + 1]


def step_event(
    spark: SparkSession, process_id: str, pipeline_name: str, step: str, target: str, status: str, at: str,
    rows_in: int | None = None, rows_out: int | None = None,
) -> DataFrame:
    """One event to append to the step log."""
    if status not in STATUSES:
        raise ValueError(f"unknown status {status!r}")
    schema = STEP_EVENT.replace("event_at timestamp", "event_at string")
    row = spark.createDataFrame([(process_id, pipeline_name, step, target, rows_in, rows_out, status, at)], schema)
    return row.withColumn("event_at", F.col("event_at").cast("timestamp"))


def monitor_view(events: DataFrame) -> DataFrame:
    """One row per (process, step): the latest state, started when it began.

    The step log is append-only; repeated steps and late corrections are resolved
    here by one aggregation that reduces before it shuffles.
    """
    began = F.col("status") == "begin"
    latest = F.struct("event_at", (~began).cast("int").alias("ended"), F.col("status"))
    state = F.struct("pipeline_name", "target_table", "row_count_in", "row_count_out", "status", "event_at")
    view = events.groupBy("process_id", "step").agg(
        F.max_by(state, latest).alias("s"),
        F.min(F.when(began, F.col("event_at"))).alias("began_at"),
        F.min("event_at").alias("first_at"),
    )
    return view.select(
        "process_id", F.col("s.pipeline_name").alias("pipeline_name"), "step",
        F.col("s.target_table").alias("target_table"), F.col("s.row_count_in").alias("row_count_in"),
        F.col("s.row_count_out").alias("row_count_out"), F.col("s.status").alias("status"),
        F.coalesce("began_at", "first_at").alias("started_at"),
        F.when(F.col("s.status") != "begin", F.col("s.event_at")).alias("completed_at"),
    )


def step_status(view: DataFrame, process_id: str, step: str) -> DataFrame:
    return view.filter((F.col("process_id") == process_id) & (F.col("step") == step)).select(
        "status", "row_count_in", "row_count_out"
    )


def latest_status(view: DataFrame, day: Column) -> DataFrame:
    """The last status per pipeline, step and day."""
    return view.groupBy("pipeline_name", "step", day.alias("business_date")).agg(
        F.max_by("status", F.struct("started_at", "process_id")).alias("last_status")
    )


def batch_outcomes(
    runs: DataFrame, policy: str, *, batch: list[str] | None = None, order: str = "sort_key", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Runs of ordered batches with ``outcome``.

    With policy ``stop`` everything after the first failed file of its batch is
    ``skipped``; quarantined files do not stop a batch. The first failure per batch is
    an aggregate, so a batch with very many files is not ordered in one task.
    """
    if policy not in ("stop", "continue"):
        raise ValueError(f"unknown policy {policy!r}")
    if policy == "continue":
        return runs.withColumn("outcome", F.col("status"))
    keys = batch or ["batch_id"]
    place = F.struct(col(order).alias("o"), F.col("file_path").alias("f"))
    first = runs.groupBy(*[col(k) for k in keys]).agg(
        F.min(F.when(F.col("status") == "failed", place)).alias("__stop"), F.count(F.lit(1)).alias("__n")
    ).filter(F.col("__stop").isNotNull())
    marked = attach_by_key(runs, first, keys, ["__stop"], rows="__n", hot_rows=hot_rows)
    after = F.coalesce(place > F.col("__stop"), F.lit(False))
    return marked.withColumn("outcome", F.when(after, "skipped").otherwise(F.col("status"))).drop("__stop")


def last_runs(runs: DataFrame, n: int = 1) -> DataFrame:
    """The newest ``n`` runs per pipeline."""
    return top_per_key(runs, ["pipeline_name"], [F.desc("started_at"), F.desc("run_id")], n)
