"""Service levels of business processes, and files that did not arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.zones import at_clock, local_date, quarter_hour, wall_clock


def sla_member_states(
    monitor: DataFrame, members: DataFrame, processes: DataFrame, now: str, *, business_date: str | None = None
) -> DataFrame:
    """``met`` / ``in_progress`` / ``pending`` per member pipeline on the business date.

    ``members``: process_name, pipeline_name, success_layer. ``processes``:
    process_name, complete_by (HH:MM), timezone. The step log is first reduced to the
    last status per quarter hour around the business date, so a pipeline with very
    many runs brings a few hundred rows to the join.
    """
    instant = F.lit(now).cast("timestamp")
    zone = F.col("timezone")
    groups = processes.withColumn("now_local", wall_clock(instant, zone)).withColumn(
        "business_date", F.lit(business_date).cast("date") if business_date else F.to_date("now_local")
    )
    centre = F.to_timestamp(F.lit(business_date or now)) if business_date else instant
    near = monitor.filter(
        (F.col("started_at") >= centre - F.expr("interval 3 days"))
        & (F.col("started_at") < centre + F.expr("interval 4 days"))
    )
    slots = near.groupBy("pipeline_name", "step", quarter_hour(F.col("started_at")).alias("slot")).agg(
        F.max(F.struct("started_at", "process_id", "status")).alias("last")
    )
    wanted = members.join(groups, "process_name", "inner")
    today = wanted.join(
        slots, (wanted.pipeline_name == slots.pipeline_name) & (wanted.success_layer == slots.step), "left"
    ).select(
        wanted.process_name, wanted.pipeline_name, "success_layer", "complete_by", "timezone", "now_local", "business_date",
        F.when(local_date(F.col("last.started_at"), zone) == F.col("business_date"), F.col("last")).alias("last"),
    )
    keys = ["process_name", "pipeline_name", "success_layer", "complete_by", "timezone", "now_local", "business_date"]
    latest = today.groupBy(*keys).agg(F.max("last")["status"].alias("last_status"))
    return latest.withColumn(
        "state",
        F.when(F.col("last_status") == "complete", "met").when(F.col("last_status").isNotNull(), "in_progress").otherwise(
            "pending"
        ),
    )


def sla_states(
    monitor: DataFrame, members: DataFrame, processes: DataFrame, now: str, *, business_date: str | None = None
) -> DataFrame:
    """``met`` / ``breached`` / ``in_progress`` / ``pending`` per business process."""
    states = sla_member_states(monitor, members, processes, now, business_date=business_date)
    grouped = states.groupBy("process_name", "complete_by", "timezone", "now_local", "business_date").agg(
        F.bool_and(F.col("state") == "met").alias("all_met"),
        F.bool_or(F.col("state") != "pending").alias("any_started"),
        F.count(F.lit(1)).alias("members"),
    )
    deadline = at_clock(F.col("business_date"), F.col("complete_by"))
    return grouped.withColumn("sla_deadline", deadline).withColumn(
        "state",
        F.when(F.col("all_met"), "met")
        .when(F.col("now_local") > F.col("sla_deadline"), "breached")
        .when(F.col("any_started"), "in_progress")
        .otherwise("pending"),
    )


def missed_arrivals(arrivals: DataFrame, feeds: DataFrame, alerts: DataFrame | None, now: str) -> DataFrame:
    """One alert per feed whose file of today is late and that was not alerted today.

    ``arrivals``: pipeline_name, sort_key. ``feeds``: pipeline_name, file_pattern,
    expected_by (HH:MM), timezone. ``alerts``: pipeline_name, alert_date. A file counts
    by its own date, so an old file left in place does not hide a missing one.
    """
    zone = F.col("timezone")
    instant = F.lit(now).cast("timestamp")
    due = (
        feeds.withColumn("now_local", wall_clock(instant, zone))
        .withColumn("alert_date", F.to_date("now_local"))
        .filter(F.col("now_local") >= at_clock(F.col("alert_date"), F.col("expected_by")))
    )
    near = arrivals.filter(
        (F.col("sort_key") >= instant - F.expr("interval 2 days")) & (F.col("sort_key") < instant + F.expr("interval 2 days"))
    )
    slots = near.select("pipeline_name", quarter_hour(F.col("sort_key")).alias("slot")).distinct()
    seen = slots.join(due.select("pipeline_name", "timezone", "alert_date"), "pipeline_name", "inner").filter(
        local_date(F.timestamp_seconds(F.col("slot") * 900), zone) == F.col("alert_date")
    )
    missing = due.join(seen.select("pipeline_name").distinct(), "pipeline_name", "left_anti")
    if alerts is not None:
        missing = missing.join(alerts.select("pipeline_name", "alert_date").distinct(), ["pipeline_name", "alert_date"], "left_anti")
    return missing.select(
        "pipeline_name", "alert_date", "expected_by",
        F.format_string(
            "%s: no file matching '%s' has arrived by %s %s",
            F.col("pipeline_name"), F.col("file_pattern"), F.col("expected_by"), F.col("timezone"),
        ).alias("message"),
    )
