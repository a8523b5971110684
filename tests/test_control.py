import datetime as dt
import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierline.functions.formats import spark_pattern
from tierline.functions.spread import attach_by_key, top_per_key, trailing_frame
from tierline.functions.text import bucket_and_prefix, date_in_file_name, metrics_from_json, metrics_to_json
from tierline.operators.anomaly import blocked_runs, detect_anomalies, score_history
from tierline.operators.checks import Rule
from tierline.operators.lineage import (
    column_edges_from_events, dataset_columns, edges_from_events, gold_dependents, lineage_event, raw_to_stage_edges,
)
from tierline.operators.monitor import RUN_RESULT, batch_outcomes, layers_to_run, monitor_view, step_event, step_status
from tierline.operators.profile import compute_profile
from tierline.operators.sla import missed_arrivals, sla_member_states, sla_states
from tierline.operators.suggest import suggest_rules


# Shuffle helpers -----------------------------------------------------------------

@pytest.mark.parametrize("hot_rows", [1, 50, 10**6])
def test_attach_equals_a_plain_join(spark, rows_of, hot_rows):
    df = spark.range(400).select(F.when(F.col("id") % 3 > 0, 7).when(F.col("id") % 12 == 0, None).otherwise(F.col("id")).alias("k"), "id")
    per_key = df.groupBy("k").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n")).filter("n > 1 or k > 100")
    got = attach_by_key(df, per_key, ["k"], ["top"], rows="n", hot_rows=hot_rows)
    want = df.join(per_key.withColumnRenamed("k", "kk"), F.col("k").eqNullSafe(F.col("kk")), "left").select("k", "id", "top")
    assert rows_of(got, "k", "id", "top") == rows_of(want, "k", "id", "top")


@pytest.mark.parametrize("block_rows", [1, 3, 1000])
def test_trailing_frame_equals_the_window(spark, rows_of, block_rows):
    df = spark.range(300).select(
        F.when(F.col("id") % 4 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 3)).alias("k"),
        F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") * 7 % 91).cast("int")).alias("d"), "id",
    )
    got = trailing_frame(df, ["k"], ["d", "id"], F.trunc("d", "month"), 5, {"s": F.sum("id"), "n": F.count("id")}, block_rows=block_rows)
    w = Window.partitionBy("k").orderBy("d", "id").rowsBetween(-5, -1)
    want = df.withColumn("s", F.sum("id").over(w)).withColumn("n", F.count("id").over(w))
    assert rows_of(got, "k", "id", "s", "n") == rows_of(want, "k", "id", "s", "n")


def test_top_per_key_limits_before_the_shuffle(spark):
    df = top_per_key(spark.range(100).withColumn("k", F.col("id") % 2), ["k"], [F.desc("id")], 2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert sorted(r.id for r in df.collect()) == [96, 97, 98, 99]


# Expressions ---------------------------------------------------------------------

@pytest.mark.parametrize("fmt,want", [("%Y%m%d", "yyyyMMdd"), ("%m/%d/%Y", "M/d/yyyy"), ("%Y-%m-%d", "yyyy-M-d"), ("%Y%d%m", "yyyyddMM"), ("%Y%m%d%H%M", "yyyyMMddHHmm"), ("%Y%m%dT%H%M", "yyyyMMdd'T'HHmm"), ("%Y-%m", "yyyy-M")])
def test_patterns(fmt, want):
    got = spark_pattern(fmt)
    assert got == want


def test_small_expressions(spark):
    row = spark.sql("select 'prices_20260830-Correction.csv' a, 'x.csv' b, 's3a://bkt/some/key' u, map('m', 1.5D) m").select(
        date_in_file_name(F.col("a")).alias("a"), date_in_file_name(F.col("b")).alias("b"), *[c for c in bucket_and_prefix(F.col("u"))],
        metrics_from_json(metrics_to_json(F.col("m"))).alias("m")).first()
    assert row.a == dt.date(2026, 8, 30) and row.b is None and (row[2], row[3]) == ("bkt", "some/key") and row.m == {"m": 1.5}


# Profiles and anomalies ------------------------------------------------------------

def test_profile_values(spark):
    df = spark.createDataFrame([("100", "10", "USD"), ("200", "20", None), ("300", "30", "EUR"), ("x", None, None)], "market_value string, quantity string, currency string")
    r = compute_profile(df, ["row_count", "market_value_sum", "quantity_avg", "currency_null_rate", "currency_distinct_count"]).first()
    assert r.row_count == 4
    assert r.metrics == {"market_value_sum": 600.0, "quantity_avg": 20.0, "currency_null_rate": 0.5, "currency_distinct_count": 3.0}
    empty = compute_profile(df.limit(0), ["market_value_sum", "quantity_avg", "currency_null_rate", "currency_distinct_count"]).first()
    assert empty.row_count == 0 and set(empty.metrics.values()) == {0.0}
    for bad in ("nope", "gone_sum"):
        with pytest.raises(ValueError):
            compute_profile(df, [bad])


def history(spark, values, pipeline="p"):
    rows = [(f"r{i:03d}", pipeline, dt.date(2026, 1, 1) + dt.timedelta(days=i), int(v), {"m": float(v)}) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "process_id string, pipeline_name string, run_date date, row_count long, metrics map<string,double>")


def last(df):
    return df.orderBy(F.desc("process_id")).first()


def test_zscore_flags_an_outlier(spark):
    values = [1000 + (i % 5) for i in range(20)] + [50]
    h = history(spark, values)
    r = detect_anomalies(h.filter("process_id = 'r020'"), h, ["row_count", "gone"], threshold=3).collect()
    assert len(r) == 1 and r[0].is_anomaly and r[0].score < -3 and r[0].baseline_size == 20
    combined = values
    mean = sum(combined) / 21
    sd = math.sqrt(sum((v - mean) ** 2 for v in combined) / 21)
    assert r[0].score == pytest.approx((50 - mean) / sd)
    assert last(score_history(h, ["row_count"])).score == pytest.approx(r[0].score)


def test_constant_baseline_and_short_history(spark):
    h = history(spark, [5, 5, 5, 6])
    assert last(score_history(h, ["m"])).score == float("inf")
    assert score_history(history(spark, [5, 5, 5]), ["m"]).filter("process_id = 'r002'").first().score == 0.0
    assert score_history(history(spark, [5, 9]), ["m"]).count() == 0


def test_pct_change(spark):
    h = history(spark, [1000] * 10 + [1250])
    r = last(score_history(h, ["row_count"], method="pct_change", threshold=0.2))
    assert r.is_anomaly and r.score == pytest.approx(0.25)
    zero = history(spark, [0, 0, 3])
    assert last(score_history(zero, ["m"], method="pct_change", threshold=1)).score == float("inf")
    verdicts = score_history(h, ["row_count"], method="pct_change", threshold=0.2)
    assert blocked_runs(verdicts, "quarantine").count() == 1 and blocked_runs(verdicts, "alert").count() == 0
    for call in (dict(method="mad"), dict(window=1)):
        with pytest.raises(ValueError):
            score_history(h, ["m"], **call)


# Monitoring ------------------------------------------------------------------------

def test_steps(spark):
    log = step_event(spark, "r1", "p", "raw", "t", "begin", "2026-01-01 10:00:00").unionByName(
        step_event(spark, "r1", "p", "raw", "t", "complete", "2026-01-01 10:00:00", 5, 4)).unionByName(
        step_event(spark, "r1", "p", "stage", "t", "begin", "2026-01-01 10:01:00"))
    view = monitor_view(log)
    assert tuple(step_status(view, "r1", "raw").first()) == ("complete", 5, 4)
    stage = view.filter("step = 'stage'").first()
    assert stage.status == "begin" and stage.completed_at is None and step_status(view, "r2", "raw").count() == 0
    assert layers_to_run("stage") == ("raw", "stage")
    with pytest.raises(ValueError):
        layers_to_run("bronze")
    with pytest.raises(ValueError):
        step_event(spark, "r", "p", "raw", "t", "done", "2026-01-01")


@pytest.mark.parametrize("statuses,now,want", [
    ({"a": "complete", "b": "complete"}, "2026-03-02 23:00:00", "met"),
    ({"a": "complete"}, "2026-03-02 15:00:00", "breached"),
    ({"a": "complete"}, "2026-03-02 13:00:00", "in_progress"),
    ({"a": "failed"}, "2026-03-02 13:00:00", "in_progress"),
    ({}, "2026-03-02 13:00:00", "pending"), ({}, "2026-03-02 15:00:00", "breached"),
])
def test_sla(spark, statuses, now, want):
    """Deadline 09:00 in New York is 14:00 UTC."""
    log = step_event(spark, "old", "b", "stage", "t", "complete", "2026-03-01 12:00:00")
    for name, status in statuses.items():
        log = log.unionByName(step_event(spark, "r" + name, name, "stage", "t", status, "2026-03-02 12:00:00"))
    members = spark.createDataFrame([("recon", "a", "stage"), ("recon", "b", "stage")], "process_name string, pipeline_name string, success_layer string")
    processes = spark.createDataFrame([("recon", "09:00", "America/New_York")], "process_name string, complete_by string, timezone string")
    view = monitor_view(log)
    assert sla_states(view, members, processes, now).first().state == want
    assert sla_member_states(view, members, processes, now).count() == 2
    past = sla_member_states(view, members, processes, now, business_date="2026-03-01")
    assert {r.pipeline_name: r.state for r in past.collect()} == {"a": "pending", "b": "met"}


def test_missed_arrivals(spark):
    feeds = spark.createDataFrame([("a", "A_{d}.csv", "09:00", "UTC"), ("b", "B.csv", "09:00", "UTC"), ("c", "C.csv", "23:00", "UTC"), ("d", "D.csv", "09:00", "UTC")],
                                  "pipeline_name string, file_pattern string, expected_by string, timezone string")
    files = spark.sql("select 'b' pipeline_name, timestamp'2026-03-02 08:00:00' sort_key union all select 'a', timestamp'2026-03-01 08:00:00'")
    sent = spark.sql("select 'd' pipeline_name, date'2026-03-02' alert_date")
    got = missed_arrivals(files, feeds, sent, "2026-03-02 10:00:00").collect()
    assert [r.message for r in got] == ["a: no file matching 'A_{d}.csv' has arrived by 09:00 UTC"]


@pytest.mark.parametrize("hot_rows", [1, 1000])
def test_stop_policy(spark, hot_rows):
    runs = spark.createDataFrame([("b", i, f"f{i}", s) for i, s in enumerate(["succeeded", "quarantined", "failed", "succeeded"])] + [("c", 0, "f0", "succeeded")],
                                 "batch_id string, sort_key int, file_path string, status string")
    got = [r.outcome for r in batch_outcomes(runs, "stop", hot_rows=hot_rows).orderBy("batch_id", "sort_key").collect()]
    assert got == ["succeeded", "quarantined", "failed", "skipped", "succeeded"]
    with pytest.raises(ValueError):
        batch_outcomes(runs, "retry")


# Lineage ---------------------------------------------------------------------------

def test_feed_edges(spark):
    rules = [Rule("q", ("not_null", {"greater_than": 0}), "decimal", 18, 4), Rule("c", lookup="currencies"), Rule("plain")]
    got = [(r.source_column, r.transformation) for r in raw_to_stage_edges(spark, rules, ["q", "k"], "raw.t", "stage.t").collect()]
    assert got == [("q", "cast_to=decimal; checks=[not_null, {'greater_than': 0}]"), ("c", "sql lookup validation"), ("plain", "passthrough"),
                   ("k", "passthrough (no quality.rules entry)")]


def test_edges_need_complete_and_both_sides(spark, rows_of):
    def ev(kind, at, run, job, **kw):
        return lineage_event(spark, kind, f"2026-01-01 00:00:0{at}", run, job, **kw)

    log = ev("START", 1, "r", "p.raw", inputs=["/in/a.csv"], outputs=["raw.t"])
    for e in (
        ev("COMPLETE", 2, "r", "p.raw", outputs=["raw.t"]),
        ev("START", 3, "r", "p.stage", inputs=["raw.t", "raw.u"], schemas={"raw.t": [("a", "TEXT")]}),
        ev("COMPLETE", 4, "r", "p.stage", outputs=["stage.t"], edges=[("stage.t", "x", "raw.t", "a", "sum"), ("stage.t", "x", "raw.t", "a", "sum")]),
        ev("COMPLETE", 5, "r", "p.stage"),
        ev("START", 6, "r2", "p.stage", inputs=["raw.t"], outputs=["stage.z"]), ev("FAIL", 7, "r2", "p.stage"),
    ):
        log = log.unionByName(e)
    assert rows_of(edges_from_events(log), "job", "source_table", "target_table") == [("p.stage", "raw.t", "stage.t"), ("p.stage", "raw.u", "stage.t")]
    assert rows_of(column_edges_from_events(log), "source_column", "target_column", "function") == [("a", "x", "sum")]
    assert rows_of(dataset_columns(log), "dataset", "column", "type") == [("raw.t", "a", "TEXT"), ("stage.t", "x", None)]
    builds = spark.createDataFrame([("g1", "gold.a", ["p", "q"]), ("g2", "gold.b", ["q"])], "build_name string, target_table string, depends_on array<string>")
    assert rows_of(gold_dependents(builds, "q"), "build_name") == [("g1",), ("g2",)]


def test_suggestions(spark):
    df = spark.createDataFrame([(str(i), f"0{i % 9 + 1}/15/2026", "x" if i else None, "") for i in range(50)], "n string, d string, t string, e string")
    got = {(r.column_name, r.check_name): (r.format, r.cast_to, r.confidence) for r in suggest_rules(df).collect()}
    assert got[("n", "is_numeric")] == (None, "decimal(38,0)", "high") and ("n", "greater_than_or_equal 0") in got
    assert got[("d", "valid_date")] == ("%m/%d/%Y", "date", "high")
    assert got[("t", "not_null")][2] == "low" and ("e", "non_empty") not in got
