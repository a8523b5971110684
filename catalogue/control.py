"""Profiles, anomalies, monitoring, service levels, quarantine review, lineage and suggestions.

The event table serves as step log, run log and lineage log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.checks import ORDER_FAILS, ORDER_RULES, ORDERS_CHECKED, orders_checked
from catalogue.registry import joined, money, query, table
from tierline.operators.anomaly import anomaly_messages, blocked_runs, detect_anomalies, score_history, trailing_profiles
from tierline.operators.checks import split_batch
from tierline.operators.lineage import column_edges_from_events, dataset_columns, edges_from_events, gold_dependents
from tierline.operators.monitor import batch_outcomes, last_runs, latest_status, monitor_view
from tierline.operators.profile import compute_profile, profile_rows
from tierline.operators.quarantine import (
    check_corrections, corrections_from, list_quarantine, quarantine_json, quarantine_rows, quarantine_summary, with_status,
)
from tierline.operators.sla import missed_arrivals, sla_member_states, sla_states
from tierline.operators.suggest import profile_text_columns, suggest_rules

NOW = "2024-01-30 18:00:00"


def instant(name: str = "ts"):
    return F.col(name).cast("timestamp")


# Profiles and anomalies: one run per event type and day ------------------------

METRICS = ["row_count", "value_sum", "value_avg", "user_id_distinct_count", "big_null_rate"]
_PROFILE = """WITH e AS (SELECT event_type AS pipeline_name, CAST(ts AS DATE) AS run_date, user_id, CAST(value AS DECIMAL(18,2)) AS value,
                         CASE WHEN value < 100 THEN value END AS big FROM events),
     p AS (SELECT pipeline_name, run_date, count(*) AS row_count, CAST(sum(value) AS DOUBLE) AS value_sum,
                  CAST(sum(value) AS DOUBLE) / count(*) AS value_avg, CAST(count(DISTINCT user_id) AS DOUBLE) AS user_id_distinct_count,
                  CAST(count(*) FILTER (WHERE big IS NULL) AS DOUBLE) / count(*) AS big_null_rate FROM e GROUP BY 1, 2),
     m AS (SELECT pipeline_name, run_date, 'row_count' AS metric, CAST(row_count AS DOUBLE) AS value FROM p
           UNION ALL SELECT pipeline_name, run_date, 'value_sum', value_sum FROM p
           UNION ALL SELECT pipeline_name, run_date, 'value_avg', value_avg FROM p
           UNION ALL SELECT pipeline_name, run_date, 'user_id_distinct_count', user_id_distinct_count FROM p
           UNION ALL SELECT pipeline_name, run_date, 'big_null_rate', big_null_rate FROM p) """


def profiles(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        F.col("event_type").alias("pipeline_name"), F.to_date("ts").alias("run_date"), "user_id", money("value").alias("value"),
        F.when(F.col("value") < 100, F.col("value")).alias("big"),
    )
    found = compute_profile(events, METRICS, by=["pipeline_name", "run_date"])
    return found.select(
        F.concat_ws("-", "pipeline_name", "run_date").alias("process_id"), "pipeline_name", "run_date", "row_count", "metrics"
    )


@query("profile_runs", _PROFILE + "SELECT pipeline_name, run_date, metric, round(value, 9) AS value FROM m")
def profile_runs(spark: SparkSession, folder: str) -> DataFrame:
    rows = profile_rows(profiles(spark, folder), METRICS, ["pipeline_name", "run_date"])
    return rows.select("pipeline_name", "run_date", "metric", F.round("value", 9).alias("value"))


@query(
    "profile_whole_table",
    """SELECT count(*) AS row_count, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity_sum,
              CAST(count(DISTINCT l_suppkey) AS DOUBLE) AS suppliers, CAST(count(DISTINCT l_partkey) AS DOUBLE) AS parts FROM lineitem""",
)
def profile_whole_table(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(money("l_quantity").alias("q"), F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("p"))
    found = compute_profile(lines, ["row_count", "q_sum", "s_distinct_count", "p_distinct_count"])
    m = F.col("metrics")
    return found.select(
        "row_count", m["q_sum"].alias("quantity_sum"), m["s_distinct_count"].alias("suppliers"), m["p_distinct_count"].alias("parts")
    )


_FRAME = _PROFILE + """, b AS (SELECT *, count(value) OVER w AS n, avg(value) OVER w AS mean, stddev_samp(value) OVER w AS sd,
           min(value) OVER w AS lo, max(value) OVER w AS hi FROM m
           WINDOW w AS (PARTITION BY pipeline_name, metric ORDER BY run_date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)),
     z AS (SELECT *, CASE WHEN lo = hi THEN CASE WHEN value = lo THEN 0 ELSE CAST('inf' AS DOUBLE) END
                     ELSE (value - mean) * n / (n + 1) / sqrt(((n - 1) * sd * sd + (value - mean) * (value - mean) * n / (n + 1)) / (n + 1)) END AS zscore,
                  CASE WHEN mean = 0 THEN CASE WHEN value = 0 THEN 0 ELSE CAST('inf' AS DOUBLE) END ELSE (value - mean) / mean END AS pct FROM b WHERE n >= 2) """


def _verdicts(df: DataFrame) -> DataFrame:
    return df.select(
        "pipeline_name", "run_date", "metric", F.round("current_value", 9).alias("current_value"),
        F.round("baseline_mean", 6).alias("baseline_mean"), "baseline_size", F.round("score", 6).alias("score"), "is_anomaly",
    )


def _verdict_sql(score: str, threshold: float, where: str = "TRUE") -> str:
    return _FRAME + f"""SELECT pipeline_name, run_date, metric, round(value, 9) AS current_value, round(mean, 6) AS baseline_mean, n AS baseline_size,
                        round({score}, 6) AS score, abs({score}) >= {threshold} AS is_anomaly FROM z WHERE {where}"""


@query("anomaly_zscore", _verdict_sql("zscore", 2.0))
def anomaly_zscore(spark: SparkSession, folder: str) -> DataFrame:
    return _verdicts(score_history(profiles(spark, folder), METRICS, method="zscore", threshold=2.0, window=5))


@query("anomaly_run_order", _verdict_sql("zscore", 2.0))
def anomaly_run_order(spark: SparkSession, folder: str) -> DataFrame:
    """The same runs as batches of one day whose ids fall: the numbers they took order them."""
    number = F.datediff("run_date", F.lit("2000-01-01")).cast("long")
    fallen = F.concat_ws("|", F.lpad((F.lit(10**6) - number).cast("string"), 7, "0"), F.col("run_date").cast("string"), F.col("pipeline_name"))
    runs = profiles(spark, folder).withColumn("run_number", number).withColumn("process_id", fallen)
    found = score_history(runs.withColumn("run_date", F.lit("2024-01-30").cast("date")), METRICS, method="zscore", threshold=2.0, window=5)
    return _verdicts(found.withColumn("run_date", F.to_date(F.split("process_id", r"\|")[1])))


@query("anomaly_pct", _verdict_sql("pct", 0.2))
def anomaly_pct(spark: SparkSession, folder: str) -> DataFrame:
    found = profiles(spark, folder)
    return _verdicts(score_history(found, METRICS, method="pct_change", threshold=0.2, window=5, block_rows=7))


def last_day(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    found = profiles(spark, folder)
    return found.filter("run_date = '2024-01-30'"), found


@query("anomaly_current", _verdict_sql("zscore", 1.5, "run_date = '2024-01-30'"))
def anomaly_current(spark: SparkSession, folder: str) -> DataFrame:
    """The last day's runs against the five before them."""
    return _verdicts(detect_anomalies(*last_day(spark, folder), METRICS, threshold=1.5, window=5))


@query(
    "anomaly_trailing",
    _PROFILE + """SELECT pipeline_name, run_date, row_count FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_name ORDER BY run_date DESC) AS rn
                  FROM p WHERE run_date <> '2024-01-30') WHERE rn <= 5""",
)
def anomaly_trailing(spark: SparkSession, folder: str) -> DataFrame:
    current, found = last_day(spark, folder)
    return trailing_profiles(found, current, window=5).select("pipeline_name", "run_date", "row_count")


@query(
    "anomaly_messages",
    _FRAME + """SELECT pipeline_name, run_date, pipeline_name || ': anomaly detected in ' || metric || ' (current=' || format('{:.1f}', value) || ', baseline_mean='
                || format('{:.4f}', mean) || ', pct_change score=' || format('{:.3f}', pct) || ', threshold=0.2)' AS message
                FROM z WHERE abs(pct) >= 0.2 AND metric = 'row_count'""",
)
def anomaly_messages_query(spark: SparkSession, folder: str) -> DataFrame:
    verdicts = score_history(profiles(spark, folder), ["row_count"], method="pct_change", threshold=0.2, window=5)
    return anomaly_messages(verdicts).select("pipeline_name", "run_date", "message")


@query("anomaly_blocked", _FRAME + "SELECT DISTINCT pipeline_name, pipeline_name || '-' || run_date AS process_id FROM z WHERE abs(zscore) >= 2.0")
def anomaly_blocked(spark: SparkSession, folder: str) -> DataFrame:
    verdicts = score_history(profiles(spark, folder), METRICS, method="zscore", threshold=2.0, window=5)
    return blocked_runs(verdicts, "quarantine")


# Monitoring ---------------------------------------------------------------------

_STEPS = """WITH e AS (SELECT CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS process_id, 'feed' || (user_id % 20) AS pipeline_name,
                      CASE CAST(json_extract_string(props, '$.k') AS INT) % 3 WHEN 0 THEN 'raw' WHEN 1 THEN 'stage' ELSE 'gold' END AS step,
                      CASE event_type WHEN 'purchase' THEN 'complete' WHEN 'error' THEN 'failed' WHEN 'click' THEN 'quarantined' ELSE 'begin' END AS status,
                      CAST(json_extract_string(props, '$.k') AS INT) AS n, ts, user_id FROM events),
     v AS (SELECT process_id, step, arg_max(pipeline_name, ts) AS pipeline_name, arg_max(status, ts) AS status, arg_max(n, ts) AS row_count_in,
                  coalesce(min(CASE WHEN status = 'begin' THEN ts END), min(ts)) AS started_at, max(ts) AS last_at FROM e GROUP BY 1, 2) """


def step_log(spark: SparkSession, folder: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.concat_ws("-", "user_id", F.date_format("ts", "yyyyMMdd")).alias("process_id"),
        F.concat(F.lit("feed"), (F.col("user_id") % 20).cast("string")).alias("pipeline_name"),
        F.when(k % 3 == 0, "raw").when(k % 3 == 1, "stage").otherwise("gold").alias("step"),
        F.lit("t").alias("target_table"), k.cast("long").alias("row_count_in"), k.cast("long").alias("row_count_out"),
        F.when(kind == "purchase", "complete").when(kind == "error", "failed").when(kind == "click", "quarantined")
        .otherwise("begin").alias("status"),
        instant().alias("event_at"),
    )


def _at(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss")


@query(
    "monitor_latest",
    _STEPS + """SELECT process_id, pipeline_name, step, status, CAST(row_count_in AS BIGINT) AS row_count_in, strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at,
                CASE WHEN status <> 'begin' THEN strftime(last_at, '%Y-%m-%d %H:%M:%S') END AS completed_at FROM v""",
)
def monitor_latest(spark: SparkSession, folder: str) -> DataFrame:
    view = monitor_view(step_log(spark, folder))
    return view.select(
        "process_id", "pipeline_name", "step", "status", "row_count_in", _at("started_at").alias("started_at"),
        _at("completed_at").alias("completed_at"),
    )


@query(
    "monitor_daily_status",
    _STEPS + "SELECT pipeline_name, step, CAST(started_at AS DATE) AS business_date, arg_max(status, started_at) AS last_status FROM v GROUP BY 1, 2, 3",
)
def monitor_daily_status(spark: SparkSession, folder: str) -> DataFrame:
    return latest_status(monitor_view(step_log(spark, folder)), F.to_date("started_at"))


# Processes of five feeds each; the deadline depends on the number, the zone on its parity.
_SLA = _STEPS + """, g AS (SELECT DISTINCT user_id % 4 AS g FROM events),
     groups AS (SELECT 'process' || g AS process_name, (8 + 3 * g) || ':30' AS complete_by, CASE WHEN g % 2 = 0 THEN 'UTC' ELSE 'America/New_York' END AS zone FROM g),
     members AS (SELECT DISTINCT 'process' || (user_id % 4) AS process_name, 'feed' || (user_id % 20) AS pipeline_name FROM events),
     locals AS (SELECT *, timezone(zone, TIMESTAMPTZ '2024-01-30 18:00:00+00') AS now_local FROM groups),
     s AS (SELECT m.process_name, m.pipeline_name, l.complete_by, l.zone, l.now_local, CAST(l.now_local AS DATE) AS business_date,
                  arg_max(v.status, v.started_at) AS last_status
           FROM members m JOIN locals l USING (process_name)
           LEFT JOIN v ON v.pipeline_name = m.pipeline_name AND v.step = 'gold'
             AND CAST(timezone(l.zone, timezone('UTC', v.started_at)) AS DATE) = CAST(l.now_local AS DATE) GROUP BY 1, 2, 3, 4, 5, 6),
     t AS (SELECT *, CASE WHEN last_status = 'complete' THEN 'met' WHEN last_status IS NOT NULL THEN 'in_progress' ELSE 'pending' END AS state FROM s) """


def sla_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    events = table(spark, folder, "events")
    group = F.concat(F.lit("process"), (F.col("user_id") % 4).cast("string")).alias("process_name")
    members = events.select(
        group, F.concat(F.lit("feed"), (F.col("user_id") % 20).cast("string")).alias("pipeline_name"), F.lit("gold").alias("success_layer")
    ).distinct()
    number = F.col("user_id") % 4
    processes = events.select(
        group, F.concat((8 + 3 * number).cast("string"), F.lit(":30")).alias("complete_by"),
        F.when(number % 2 == 0, "UTC").otherwise("America/New_York").alias("timezone"),
    ).distinct()
    return monitor_view(step_log(spark, folder)), members, processes


@query("sla_members", _SLA + "SELECT process_name, pipeline_name, business_date, last_status, state FROM t")
def sla_members(spark: SparkSession, folder: str) -> DataFrame:
    return sla_member_states(*sla_inputs(spark, folder), NOW).select(
        "process_name", "pipeline_name", "business_date", "last_status", "state"
    )


@query(
    "sla_states",
    _SLA + """SELECT process_name, count(*) AS members, CASE WHEN bool_and(state = 'met') THEN 'met'
                WHEN any_value(now_local) > any_value(CAST(business_date AS TIMESTAMP) + to_hours(CAST(string_split(complete_by, ':')[1] AS INT)) + to_minutes(30)) THEN 'breached'
                WHEN bool_or(state <> 'pending') THEN 'in_progress' ELSE 'pending' END AS state FROM t GROUP BY 1""",
)
def sla_states_query(spark: SparkSession, folder: str) -> DataFrame:
    return sla_states(*sla_inputs(spark, folder), NOW).select("process_name", "members", "state")


@query(
    "missed_arrivals",
    """WITH f AS (SELECT DISTINCT 'u' || user_id AS pipeline_name, CASE WHEN user_id % 2 = 0 THEN 'UTC' ELSE 'Asia/Tokyo' END AS zone,
                  CASE WHEN user_id % 3 = 0 THEN '23:00' ELSE '02:15' END AS expected_by FROM events),
     n AS (SELECT *, timezone(zone, TIMESTAMPTZ '2024-01-30 18:00:00+00') AS now_local FROM f),
     d AS (SELECT *, CAST(now_local AS DATE) AS alert_date FROM n WHERE strftime(now_local, '%H:%M') >= expected_by)
     SELECT pipeline_name, alert_date, pipeline_name || ': no file matching ''F_{date}.csv'' has arrived by ' || expected_by || ' ' || zone AS message
     FROM d WHERE NOT EXISTS (SELECT 1 FROM events e WHERE 'u' || e.user_id = d.pipeline_name AND e.event_type <> 'view'
                              AND CAST(timezone(d.zone, timezone('UTC', e.ts)) AS DATE) = d.alert_date)
       AND NOT EXISTS (SELECT 1 FROM events e WHERE 'u' || e.user_id = d.pipeline_name AND e.event_type = 'view' AND CAST(e.ts AS DATE) = d.alert_date)""",
)
def missed_arrivals_query(spark: SparkSession, folder: str) -> DataFrame:
    """Files are the events that are no views; views stand for alerts already sent."""
    events = table(spark, folder, "events").withColumn("pipeline_name", F.concat(F.lit("u"), F.col("user_id").cast("string")))
    feeds = events.select(
        "pipeline_name", F.lit("F_{date}.csv").alias("file_pattern"),
        F.when(F.col("user_id") % 3 == 0, "23:00").otherwise("02:15").alias("expected_by"),
        F.when(F.col("user_id") % 2 == 0, "UTC").otherwise("Asia/Tokyo").alias("timezone"),
    ).distinct()
    arrivals = events.filter("event_type <> 'view'").select("pipeline_name", instant().alias("sort_key"))
    sent = events.filter("event_type = 'view'").select("pipeline_name", F.to_date("ts").alias("alert_date"))
    return missed_arrivals(arrivals, feeds, sent, NOW).select("pipeline_name", "alert_date", "message")


_BATCHES = """WITH r AS (SELECT event_id, user_id AS batch_id, ts, CASE WHEN event_type = 'error' AND CAST(json_extract_string(props, '$.k') AS INT) < 10 THEN 'failed'
                         WHEN event_type = 'click' THEN 'quarantined' ELSE 'succeeded' END AS status FROM events) """


def runs(spark: SparkSession, folder: str) -> DataFrame:
    failed = (F.col("event_type") == "error") & (F.get_json_object("props", "$.k").cast("int") < 10)
    return table(spark, folder, "events").select(
        "event_id", F.col("user_id").alias("batch_id"), F.col("ts").alias("sort_key"), F.col("event_id").cast("string").alias("file_path"),
        F.when(failed, "failed").when(F.col("event_type") == "click", "quarantined").otherwise("succeeded").alias("status"),
    )


@query(
    "batch_outcomes",
    _BATCHES + """SELECT event_id, batch_id, CASE WHEN coalesce(max(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) OVER
                  (PARTITION BY batch_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 THEN 'skipped' ELSE status END AS outcome FROM r""",
)
def batch_outcomes_query(spark: SparkSession, folder: str) -> DataFrame:
    return batch_outcomes(runs(spark, folder), "stop").select("event_id", "batch_id", "outcome")


@query("batch_outcomes_continue", _BATCHES + "SELECT status AS outcome, count(*) AS n FROM r GROUP BY 1")
def batch_outcomes_continue(spark: SparkSession, folder: str) -> DataFrame:
    return batch_outcomes(runs(spark, folder), "continue").groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query(
    "last_runs",
    "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) WHERE rn <= 3",
)
def last_runs_query(spark: SparkSession, folder: str) -> DataFrame:
    log = table(spark, folder, "events").select(
        F.col("user_id").alias("pipeline_name"), F.col("event_id").alias("run_id"), F.col("ts").alias("started_at")
    )
    return last_runs(log, 3).select(F.col("pipeline_name").alias("user_id"), F.col("run_id").alias("event_id"))


# Quarantine review ---------------------------------------------------------------

_RECORDS = ORDERS_CHECKED.rstrip() + """, q AS (SELECT priority AS pipeline_name, 'orders.' || priority || '.b1' AS quarantine_id, * FROM c WHERE reasons <> ''),
     done AS (SELECT DISTINCT pipeline_name, quarantine_id FROM q WHERE priority IN ('1-URGENT', '5-LOW')) """


def records(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    _, bad = split_batch(orders_checked(spark, folder), ORDER_RULES, "row_level")
    named = bad.withColumn("file_name", F.concat(F.lit("orders."), "priority"))
    kept = quarantine_rows(named, pipeline_name="x", batch_id="b1", now=NOW).withColumn("pipeline_name", F.col("row_data")["priority"])
    resolved = kept.filter(F.col("pipeline_name").isin("1-URGENT", "5-LOW")).select("pipeline_name", "quarantine_id").distinct()
    return kept, resolved


@query(
    "quarantine_list",
    _RECORDS + """SELECT pipeline_name, quarantine_id, count(*) AS row_count FROM q
                  WHERE quarantine_id NOT IN (SELECT quarantine_id FROM done) GROUP BY 1, 2""",
)
def quarantine_list(spark: SparkSession, folder: str) -> DataFrame:
    return list_quarantine(*records(spark, folder)).select("pipeline_name", "quarantine_id", "row_count")


@query(
    "quarantine_summary",
    _RECORDS + """SELECT pipeline_name, count(DISTINCT quarantine_id) AS pending_records, count(*) AS pending_rows FROM q
                  WHERE quarantine_id NOT IN (SELECT quarantine_id FROM done) GROUP BY 1""",
)
def quarantine_summary_query(spark: SparkSession, folder: str) -> DataFrame:
    return quarantine_summary(*records(spark, folder))


@query(
    "quarantine_status",
    _RECORDS + "SELECT CASE WHEN quarantine_id IN (SELECT quarantine_id FROM done) THEN 'resolved' ELSE 'pending' END AS status, count(*) AS n_rows FROM q GROUP BY 1",
)
def quarantine_status(spark: SparkSession, folder: str) -> DataFrame:
    return with_status(*records(spark, folder)).groupBy("status").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "quarantine_rows",
    _RECORDS + "SELECT quarantine_id, o_orderkey AS row_index, customer, price, ordered_on, reasons FROM q",
)
def quarantine_rows_query(spark: SparkSession, folder: str) -> DataFrame:
    kept, _ = records(spark, folder)
    cell = F.col("row_data")
    return kept.select(
        "quarantine_id", "row_index", cell["customer"].alias("customer"), cell["price"].alias("price"),
        cell["ordered_on"].alias("ordered_on"), joined("reasons").alias("reasons"),
    )


@query("quarantine_json", _RECORDS + "SELECT o_orderkey AS row_index, reasons, price FROM q")
def quarantine_json_query(spark: SparkSession, folder: str) -> DataFrame:
    """The JSON form, read back."""
    kept, _ = records(spark, folder)
    parsed = F.from_json("value", "row_index long, row_data map<string,string>, reasons array<string>, quarantined_at string")
    return quarantine_json(kept).select(parsed.alias("j")).select(
        "j.row_index", joined("j.reasons").alias("reasons"), F.col("j.row_data")["price"].alias("price")
    )


_FIXED = _RECORDS + """, fixed AS (SELECT o_orderkey, customer, CASE WHEN price IS NULL OR NOT regexp_full_match(price, '-?[0-9.]+') THEN '0' ELSE ltrim(price, '-') END AS price,
                       CASE WHEN try_strptime(ordered_on, '%Y%m%d') IS NULL THEN '20260101' ELSE ordered_on END AS ordered_on FROM q),
     again AS (SELECT *, concat_ws(';', """ + ORDER_FAILS + """) AS still FROM fixed) """


def corrections(spark: SparkSession, folder: str) -> DataFrame:
    """Reviewed rows: prices and dates are repaired, customers are left as they are."""
    kept, _ = records(spark, folder)
    draft = corrections_from(kept, ["o_orderkey", "customer", "price", "ordered_on"])
    number = F.col("price").rlike("^-?[0-9.]+$")
    dated = F.try_to_timestamp("ordered_on", F.lit("yyyyMMdd")).isNotNull()
    return draft.withColumn("price", F.when(F.coalesce(number, F.lit(False)), F.ltrim("price", F.lit("-"))).otherwise("0")).withColumn(
        "ordered_on", F.when(F.coalesce(dated, F.lit(False)), F.col("ordered_on")).otherwise("20260101")
    )


@query("resubmit_failures", _FIXED + "SELECT o_orderkey AS row_index, still AS reasons FROM again WHERE still <> ''")
def resubmit_failures(spark: SparkSession, folder: str) -> DataFrame:
    _, failures = check_corrections(corrections(spark, folder), ORDER_RULES, ["o_orderkey"])
    return failures.select("row_index", joined("reasons").alias("reasons"))


@query(
    "resubmit_accepted",
    _FIXED + """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, customer, CAST(CAST(price AS DECIMAL(18,2)) AS DOUBLE) AS price,
                CAST(strptime(ordered_on, '%Y%m%d') AS DATE) AS ordered_on FROM again WHERE still = ''""",
)
def resubmit_accepted(spark: SparkSession, folder: str) -> DataFrame:
    typed, _ = check_corrections(corrections(spark, folder), ORDER_RULES, ["o_orderkey"])
    return typed.select("o_orderkey", "customer", F.col("price").cast("double").alias("price"), "ordered_on")


# Lineage -----------------------------------------------------------------------

_LINEAGE = """WITH e AS (SELECT user_id || '-' || strftime(ts, '%Y%m%d') AS run_id, 'etl.' || (user_id % 3) AS job, ts, event_id,
                        CASE WHEN event_type IN ('purchase', 'click') THEN 'COMPLETE' WHEN event_type = 'error' THEN 'FAIL' ELSE 'START' END AS event_type,
                        'raw.t' || (CAST(json_extract_string(props, '$.k') AS INT) % 7) AS input, 'stage.t' || (CAST(json_extract_string(props, '$.k') AS INT) % 5) AS output,
                        'c' || (CAST(json_extract_string(props, '$.k') AS INT) % 4) AS col, CASE WHEN value < 20 THEN 'd' || (event_id % 10) END AS descr FROM events),
     done AS (SELECT DISTINCT run_id, job FROM e WHERE event_type = 'COMPLETE'),
     i AS (SELECT DISTINCT run_id, job, input FROM e WHERE event_type <> 'COMPLETE'), o AS (SELECT DISTINCT run_id, job, output FROM e WHERE event_type <> 'FAIL'),
     edges AS (SELECT run_id, job, input, output FROM done JOIN i USING (run_id, job) JOIN o USING (run_id, job)) """


def lineage_log(spark: SparkSession, folder: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    source = F.concat(F.lit("raw.t"), (k % 7).cast("string"))
    target = F.concat(F.lit("stage.t"), (k % 5).cast("string"))
    column = F.concat(F.lit("c"), (k % 4).cast("string"))
    described = F.when(F.col("value") < 20, F.concat(F.lit("d"), (F.col("event_id") % 10).cast("string")))
    state = F.when(kind.isin("purchase", "click"), "COMPLETE").when(kind == "error", "FAIL").otherwise("START")
    # START and FAIL carry inputs (and a file), START and COMPLETE carry outputs.
    return table(spark, folder, "events").select(
        state.alias("event_type"), instant().alias("event_time"),
        F.concat_ws("-", "user_id", F.date_format("ts", "yyyyMMdd")).alias("run_id"),
        F.concat(F.lit("etl."), (F.col("user_id") % 3).cast("string")).alias("job"),
        F.when(state != "COMPLETE", F.array(source, F.lit("/landing/a.csv"))).otherwise(F.array().cast("array<string>")).alias("inputs"),
        F.when(state != "FAIL", F.array(target)).otherwise(F.array().cast("array<string>")).alias("outputs"),
        F.array(F.struct(target.alias("dataset"), column.alias("column"), F.lit("TEXT").alias("type"))).alias("schema_fields"),
        F.array(F.struct(
            target.alias("output"), column.alias("output_column"), source.alias("input"), column.alias("input_column"), described.alias("description")
        )).alias("column_lineage"),
    )


@query("lineage_edges_from_events", _LINEAGE + "SELECT run_id, job, input AS source_table, output AS target_table FROM edges")
def lineage_edges(spark: SparkSession, folder: str) -> DataFrame:
    return edges_from_events(lineage_log(spark, folder))


@query(
    "lineage_column_edges",
    _LINEAGE + """, m AS (SELECT DISTINCT run_id, job, input, output, col FROM e),
    f AS (SELECT run_id, job, output, col, arg_min(descr, ts) AS function FROM e WHERE descr IS NOT NULL GROUP BY 1, 2, 3, 4)
    SELECT m.run_id, m.job, m.input AS source_table, m.col AS source_column, m.output AS target_table, m.col AS target_column, f.function
    FROM m JOIN edges USING (run_id, job, input, output) LEFT JOIN f USING (run_id, job, output, col)""",
)
def lineage_column_edges(spark: SparkSession, folder: str) -> DataFrame:
    return column_edges_from_events(lineage_log(spark, folder))


@query(
    "lineage_dataset_columns",
    _LINEAGE + """SELECT dataset, col AS "column", max(type) AS type FROM (SELECT run_id, job, output AS dataset, col, 'TEXT' AS type FROM e
                  UNION ALL SELECT run_id, job, input, col, NULL FROM e) JOIN done USING (run_id, job) GROUP BY 1, 2""",
)
def lineage_dataset_columns(spark: SparkSession, folder: str) -> DataFrame:
    return dataset_columns(lineage_log(spark, folder))


@query(
    "lineage_gold_dependents",
    """SELECT DISTINCT 'build' || o_custkey AS build_name, 'gold.t' || o_custkey AS target_table, x AS pipeline_name
       FROM (SELECT o_custkey, unnest([o_orderpriority, o_orderstatus]) AS x FROM orders)""",
)
def lineage_gold_dependents(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_custkey").cast("string")
    builds = table(spark, folder, "orders").select(
        F.concat(F.lit("build"), key).alias("build_name"), F.concat(F.lit("gold.t"), key).alias("target_table"),
        F.array("o_orderpriority", "o_orderstatus").alias("depends_on"),
    )
    return gold_dependents(builds)


# Suggestions -------------------------------------------------------------------

_CUSTOMER_TEXT = """WITH t AS (SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_name END AS name,
                             CASE WHEN c_custkey % 200 = 7 THEN 'n/a' ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS balance,
                             strftime(DATE '2020-01-01' + CAST(c_custkey % 365 AS INT), '%m/%d/%Y') AS since, CASE WHEN c_nationkey = 3 THEN '' ELSE c_mktsegment END AS segment FROM customer) """


def customer_text(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.cast("string").alias("id"), F.when(key % 50 == 0, None).otherwise(F.col("c_name")).alias("name"),
        F.when(key % 200 == 7, "n/a").otherwise(money("c_acctbal").cast("string")).alias("balance"),
        F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (key % 365).cast("int")), "MM/dd/yyyy").alias("since"),
        F.when(F.col("c_nationkey") == 3, "").otherwise(F.col("c_mktsegment")).alias("segment"),
    )


@query(
    "suggest_profile",
    _CUSTOMER_TEXT + """, u AS (SELECT 'id' AS column_name, id AS v FROM t UNION ALL SELECT 'name', name FROM t UNION ALL SELECT 'balance', balance FROM t
                      UNION ALL SELECT 'since', since FROM t UNION ALL SELECT 'segment', segment FROM t)
    SELECT column_name, count(*) AS row_count, count(*) FILTER (WHERE v IS NULL) AS null_count, count(*) FILTER (WHERE v = '') AS empty_count,
           count(*) FILTER (WHERE regexp_full_match(v, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)')) AS numeric_count,
           min(CASE WHEN regexp_full_match(v, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)') THEN TRY_CAST(v AS DOUBLE) END) AS min_number FROM u GROUP BY 1""",
)
def suggest_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile_text_columns(customer_text(spark, folder)).select(
        "column_name", "row_count", "null_count", "empty_count", "numeric_count", "min_number"
    )


@query(
    "suggest_rules",
    _CUSTOMER_TEXT + """, s AS (SELECT column_name, count(*) AS n, count(v) AS filled, count(*) FILTER (WHERE v = '') AS empty,
           count(*) FILTER (WHERE regexp_full_match(v, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)')) AS num, count(*) FILTER (WHERE try_strptime(v, '%m/%d/%Y') IS NOT NULL) AS dates,
           coalesce(min(CASE WHEN regexp_full_match(v, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)') THEN TRY_CAST(v AS DOUBLE) END), -1) AS least
         FROM (SELECT 'id' AS column_name, id AS v FROM t UNION ALL SELECT 'name', name FROM t UNION ALL SELECT 'balance', balance FROM t
               UNION ALL SELECT 'since', since FROM t UNION ALL SELECT 'segment', segment FROM t) GROUP BY 1),
    r AS (SELECT column_name, 'not_null' AS check_name, filled / n AS rate, NULL AS format, filled / n >= 0.95 AS ok FROM s
          UNION ALL SELECT column_name, 'non_empty', (filled - empty) / filled, NULL, (filled - empty) / filled >= 0.95 FROM s
          UNION ALL SELECT column_name, 'valid_date', dates / filled, '%m/%d/%Y', dates / filled >= 0.95 FROM s
          UNION ALL SELECT column_name, 'is_numeric', num / filled, NULL, num / filled >= 0.95 FROM s
          UNION ALL SELECT column_name, 'greater_than_or_equal 0', num / filled, NULL, num / filled >= 0.95 AND least >= 0 FROM s)
    SELECT column_name, check_name, format, CASE WHEN rate >= 1 THEN 'high' WHEN rate >= 0.99 THEN 'medium' ELSE 'low' END AS confidence FROM r WHERE ok""",
)
def suggest_rules_query(spark: SparkSession, folder: str) -> DataFrame:
    found = suggest_rules(customer_text(spark, folder), formats=("%Y-%m-%d", "%m/%d/%Y"))
    return found.select("column_name", "check_name", "format", "confidence")
