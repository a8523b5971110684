import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tierline.operators.checks import Rule
from tierline.operators.lineage import edges_from_events
from tierline.operators.monitor import monitor_view, step_status
from tierline.operators.quarantine import corrections_from, list_quarantine, mark_resolved, quarantine_json, quarantine_summary, read_quarantine, resubmit
from tierline.plans.gold import GoldBuild, latest_rates, fx_view
from tierline.plans.ingest import AnomalyPolicy, Feed, run_batch
from tierline.sources.files import NoMatchingFiles
from tierline.streaming.watch import stream_lineage_edges, watch_and_ingest

NOW = "2026-09-20 10:00:00"
COLUMNS = [("account_id", 1, 12), ("security_id", 13, 24), ("as_of_date", 25, 32), ("quantity", 33, 47), ("market_value", 48, 62), ("currency", 63, 65)]
HOLDINGS = Feed(
    name="holdings", fmt="fixed_width", file_pattern="HOLDINGS_{date}.txt", reader={"columns": COLUMNS},
    order_by="filename_timestamp", ts_format="%Y%m%d",
    rules=(
        Rule("account_id", ("not_null", "non_empty")), Rule("security_id", ("not_null", "non_empty")),
        Rule("as_of_date", ("not_null", "valid_date"), "date", format="%Y%m%d"),
        Rule("quantity", ("not_null", "is_numeric", {"greater_than_or_equal": 0}), "decimal", 18, 4),
        Rule("market_value", ("not_null", "is_numeric"), "decimal", 18, 2),
        Rule("currency", ("not_null",), lookup="currencies"),
    ),
    business_key=("account_id", "security_id", "as_of_date"), write_mode="upsert",
    integrity_mode="group_level", group_by=("account_id", "as_of_date"), file_size=(60, 10**6), row_count=(1, 1000),
)
FX = Feed(
    name="fx_rates", fmt="csv", file_pattern="FX_RATES_{date}.csv", order_by="filename_timestamp", ts_format="%Y%m%d%H%M",
    rules=(
        Rule("fxDate", ("not_null", "valid_date"), "date", format="%Y%m%d"),
        Rule("fromCCY", ("not_null", "non_empty"), lookup="currencies"), Rule("toCCY", ("not_null", "non_empty"), lookup="currencies"),
        Rule("fxRate", ("not_null", "is_numeric", {"greater_than": 0}), "decimal", 18, 8), Rule("sourceType", ("not_null", "non_empty")),
    ),
    business_key=("fxDate", "fromCCY", "toCCY", "sourceType"), write_mode="upsert", stop_after="gold",
    gold=(GoldBuild("fx_rates_gold", ("fx_rates",), lambda fx: latest_rates(fx_view(fx), now=NOW)),),
)


@pytest.fixture
def refs(spark):
    return {"currencies": (spark.createDataFrame([("USD",), ("EUR",), ("GBP",), ("INR",)], "code string"), "code")}


def holding(acc, sec="SEC1", day="20260301", qty="1.0000", mv="10.00", ccy="EUR"):
    return f"{acc:<12}{sec:<12}{day:<8}{qty:<15}{mv:<15}{ccy:<3}\n"


def land(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return f"file:{folder}"


def fx_file(*rows):
    return "fxDate,fromCCY,toCCY,fxRate,sourceType\n" + "".join(",".join(r) + "\n" for r in rows)


def by_file(result):
    return {r.file_path.rsplit("/", 1)[-1]: r for r in result.runs.collect()}


def test_holdings_end_to_end(spark, house, tmp_path, refs, rows_of):
    src = land(tmp_path / "in", "HOLDINGS_20260301.txt", holding("A1") + holding("A2", qty="-1") + holding("A2", "SEC2") + holding("A3", ccy="ZZZ"))
    land(tmp_path / "in", "HOLDINGS_20260302.txt", holding("A1", mv="99.00") + holding("A1", mv="98.00", day="20260302") + holding("A9"))
    land(tmp_path / "in", "HOLDINGS_20260303.txt", "tiny")
    result = run_batch(spark, HOLDINGS, src, house, now=NOW, batch_id="b1", references=refs)
    runs = by_file(result)
    assert {n: (r.status, r.layer_reached) for n, r in runs.items()} == {
        "HOLDINGS_20260301.txt": ("succeeded", "stage"), "HOLDINGS_20260302.txt": ("succeeded", "stage"), "HOLDINGS_20260303.txt": ("quarantined", None)}
    assert (runs["HOLDINGS_20260301.txt"].rows_in, runs["HOLDINGS_20260301.txt"].rows_out) == (4, 1)
    assert runs["HOLDINGS_20260301.txt"].failure_reasons == ["currency: sql_lookup", "quantity: greater_than_or_equal",
        "quarantined with group (account_id='A2', as_of_date='20260301') - another row in this group failed DQ",
    ]
    assert runs["HOLDINGS_20260303.txt"].failure_reasons == ["file_size 4 below min_bytes 60", "row_count 0 below min_rows 1"]
    # The later file wins on the shared key; the batch date of A1 exists twice.
    assert [(a, str(d), str(m)) for a, d, m in rows_of(house.stage("holdings").read(), "account_id", "as_of_date", "market_value")] == [
        ("A1", "2026-03-01", "99.00"), ("A1", "2026-03-02", "98.00"), ("A9", "2026-03-01", "10.00")]
    assert [(r.row_index, r.row_data["account_id"]) for r in house.control("quarantine").orderBy("row_index").collect()] == [(1, "A2"), (2, "A2"), (3, "A3")]
    view = monitor_view(house.control("step_events"))
    done = runs["HOLDINGS_20260301.txt"].run_id
    assert tuple(step_status(view, done, "stage").first()) == ("complete", 4, 1)
    assert step_status(view, runs["HOLDINGS_20260303.txt"].run_id, "control_gate").first().status == "quarantined"
    assert house.control("alerts").filter("message like '%control gate%'").count() == 1
    assert house.control("alerts").count() == 4
    kept = spark.read.parquet(house.folder("quarantined_files") + "/files").first()
    assert bytes(kept.content) == b"tiny" and len(kept.failures) == 2

    # The same content again changes nothing in any layer.
    again = by_file(run_batch(spark, HOLDINGS, src, house, now=NOW, batch_id="b2", references=refs))
    assert again["HOLDINGS_20260301.txt"].status == "skipped"
    assert spark.read.parquet(house.bronze("holdings")).count() == 7
    # The same batch again replaces its own rows.
    run_batch(spark, HOLDINGS, src, house, now=NOW, batch_id="b1", references=refs)
    assert spark.read.parquet(house.bronze("holdings")).count() == 7


def test_strict_blocks_one_file_only(spark, house, tmp_path, rows_of):
    feed = Feed(name="assets", fmt="csv", file_pattern="A_{d}.csv", rules=(Rule("v", ("is_numeric",), "decimal", 10, 2),),
                business_key=("k",), write_mode="append", integrity_mode="strict")
    src = land(tmp_path / "in", "A_1.csv", "k,v\na,1\nb,2\n")
    land(tmp_path / "in", "A_2.csv", "k,v\nc,x\nd,2\n")
    runs = by_file(run_batch(spark, feed, src, house, now=NOW))
    assert (runs["A_1.csv"].status, runs["A_2.csv"].status, runs["A_2.csv"].layer_reached) == ("succeeded", "quarantined", "raw")
    assert rows_of(house.stage("assets").read(), "k") == [("a",), ("b",)]
    assert house.control("alerts").first().message == "A_2.csv: entire file quarantined (strict integrity_mode) - 1 row(s) failed DQ"
    with pytest.raises(NoMatchingFiles):
        run_batch(spark, Feed(name="z", fmt="csv", file_pattern="Z.csv", rules=(), business_key=()), src, house, now=NOW)


def test_stop_after_raw_and_truncate_load(spark, house, tmp_path, rows_of):
    feed = Feed(name="t", fmt="csv", file_pattern="T_{d}.csv", rules=(), business_key=("k",), write_mode="truncate_load",
                order_by="filename_timestamp", ts_format="%Y%m%d")
    src = land(tmp_path / "in", "T_20260101.csv", "k\na\n")
    land(tmp_path / "in", "T_20260102.csv", "k\nb\n")
    raw = by_file(run_batch(spark, feed, src, house, now=NOW, batch_id="r", stop_after="raw"))
    assert {r.layer_reached for r in raw.values()} == {"raw"} and house.stage("t").read() is None
    run_batch(spark, feed, src, house, now=NOW, batch_id="r")
    assert rows_of(house.stage("t").read()) == [("b",)]
    with pytest.raises(ValueError):
        run_batch(spark, feed, src, house, now=NOW, stop_after="platinum")


def test_partitioned_upsert_feed(spark, house, tmp_path, rows_of):
    feed = Feed(name="p", fmt="csv", file_pattern="P_{d}.csv", rules=(Rule("day", ("valid_date",), "date", format="%Y%m%d"),),
                business_key=("k", "day"), write_mode="upsert", partition_by=("day",), order_by="filename_timestamp", ts_format="%Y%m%d")
    src = land(tmp_path / "in", "P_20260101.csv", "k,day,v\na,20260101,1\na,20260102,1\n")
    run_batch(spark, feed, src, house, now=NOW)
    src = land(tmp_path / "in2", "P_20260102.csv", "k,day,v\na,20260102,2\nb,20260102,3\n")
    run_batch(spark, feed, src, house, now=NOW)
    assert [(k, str(d), v) for k, d, v in rows_of(house.stage("p").read(), "k", "day", "v")] == [
        ("a", "2026-01-01", "1"), ("a", "2026-01-02", "2"), ("b", "2026-01-02", "3")]


def test_failure_is_recorded(spark, house, tmp_path):
    feed = Feed(name="f", fmt="csv", file_pattern="F.csv", rules=(Rule("gone", ("not_null",)),), business_key=("k",))
    src = land(tmp_path / "in", "F.csv", "k\na\n")
    with pytest.raises(ValueError, match="gone"):
        run_batch(spark, feed, src, house, now=NOW)
    view = monitor_view(house.control("step_events"))
    assert {(r.step, r.status) for r in view.collect()} == {("control_gate", "complete"), ("raw", "complete"), ("stage", "failed")}
    events = house.control("lineage_events")
    assert events.filter("job = 'f.stage' and event_type = 'FAIL'").count() == 1
    assert [r.target_table for r in edges_from_events(events).collect()] == []


def test_anomaly_blocks_gold(spark, house, tmp_path, refs):
    policy = AnomalyPolicy(("row_count", "fxRate_sum"), "pct_change", 0.5, 5, "quarantine")
    from dataclasses import replace

    feed = replace(FX, anomaly=policy)
    row = lambda day, n: fx_file(*[(f"202609{day}", "USD", "EUR", "1.5", f"s{i}") for i in range(n)])
    for day in ("01", "02", "03"):
        src = land(tmp_path / f"d{day}", f"FX_RATES_202609{day}1200.csv", row(day, 4))
        assert by_file(run_batch(spark, feed, src, house, now=f"2026-09-{day} 12:00:00", references=refs)).popitem()[1].status == "succeeded"
    src = land(tmp_path / "d04", "FX_RATES_202609041200.csv", row("04", 9))
    last = by_file(run_batch(spark, feed, src, house, now="2026-09-04 12:00:00", references=refs)).popitem()[1]
    assert (last.status, last.layer_reached) == ("quarantined", "stage")
    assert last.failure_reasons == ["fxRate_sum: pct_change score 1.250 exceeds threshold 0.5", "row_count: pct_change score 1.250 exceeds threshold 0.5"]
    assert house.stage("fx_rates").read().count() == 21
    assert house.control("profile_history").count() == 4
    text = [r.message for r in house.control("alerts").filter("message like '%row_count%'").collect()]
    assert text == ["fx_rates: anomaly detected in row_count (current=9.0, baseline_mean=4.0000, pct_change score=1.250, threshold=0.5)"]


def test_review_loop(spark, house, tmp_path, refs, rows_of):
    src = land(tmp_path / "in", "FX_RATES_202609201200.csv", fx_file(
        ("20260920", "USD", "INR", "100", "7AM"), ("20260920", "USD", "ZZZ", "1", "7AM"), ("20260920", "USD", "EUR", "-3", "7AM")))
    run_batch(spark, FX, src, house, now=NOW, batch_id="b", references=refs)
    records = house.control("quarantine")
    listed = list_quarantine(records).collect()
    assert [(r.pipeline_name, r.quarantine_id, r.row_count) for r in listed] == [("fx_rates", "FX_RATES_202609201200.csv.b", 2)]
    rid = listed[0].quarantine_id
    assert '"reasons":["toCCY: sql_lookup"]' in quarantine_json(read_quarantine(records, rid)).orderBy("row_index").first().value
    cols = [r.column for r in FX.rules]
    draft = corrections_from(read_quarantine(records, rid), cols)
    args = dict(pipeline_name="fx_rates", quarantine_id=rid, now=NOW, lookups=refs)
    tables = (list(FX.rules), list(FX.business_key), house.stage("fx_rates"), house.resolved())
    assert resubmit(draft.limit(0), *tables, **args).error == "no rows submitted"
    refused = resubmit(draft, *tables, **args)
    assert not refused.accepted and [(r.row_index, list(r.reasons)) for r in refused.failures.orderBy("row_index").collect()] == [
        (1, ["toCCY: sql_lookup"]), (2, ["fxRate: greater_than"])]
    assert house.stage("fx_rates").read().count() == 1
    fixed = draft.withColumn("toCCY", F.lit("GBP")).filter("row_index = 1").unionByName(draft.withColumn("fxRate", F.lit("3")).filter("row_index = 2"))
    done = resubmit(fixed, *tables, refresh_gold=lambda: None, **args)
    assert done.accepted and done.layer_reached == "gold"
    assert rows_of(house.stage("fx_rates").read(), "toCCY") == [("EUR",), ("GBP",), ("INR",)]
    resolved = house.resolved().read()
    assert list_quarantine(records, resolved).count() == 0 and quarantine_summary(records, resolved).count() == 0
    assert quarantine_summary(records).first().pending_rows == 2

    def broken():
        raise RuntimeError("gold is down")

    assert resubmit(fixed, *tables, refresh_gold=broken, **args).error == "gold is down"


def test_watch_processes_each_file_once(spark, house, tmp_path, refs, rows_of):
    folder = tmp_path / "in"
    src = land(folder, "FX_RATES_202609191200.csv", fx_file(("20260919", "USD", "INR", "80", "12PM")))
    land(folder, "FX_RATES_bad.csv", fx_file(("20260919", "USD", "EUR", "80", "12PM")))
    land(folder, "notes.txt", "x")

    def run():
        watch_and_ingest(spark, FX, src, house, f"file:{tmp_path}/cp", clock=lambda: NOW, references=refs).awaitTermination()

    run()
    assert spark.read.parquet(house.bronze("fx_rates")).count() == 1
    land(folder, "FX_RATES_202609201200.csv", fx_file(("20260920", "USD", "INR", "100", "12PM"), ("20260919", "USD", "INR", "50", "12PM")))
    run()
    run()
    assert spark.read.parquet(house.bronze("fx_rates")).count() == 3
    got = house.gold("fx_rates_gold").read().first()
    assert (float(got.latest_rate), float(got.prior_rate), float(got.change_pct)) == (100.0, 50.0, 100.0)

    stream_lineage_edges(spark, house.folder("lineage_events"), f"file:{tmp_path}/edges", f"file:{tmp_path}/cp2").awaitTermination()
    edges = spark.read.parquet(f"file:{tmp_path}/edges")
    assert rows_of(edges.select("source_table", "target_table").distinct()) == [("bronze.fx_rates", "silver.fx_rates"), ("silver.fx_rates", "gold.fx_rates_gold")]
    assert rows_of(edges, "run_id", "job", "target_table") == rows_of(edges_from_events(house.control("lineage_events")), "run_id", "job", "target_table")



PLAIN = Feed(
    name="plain", fmt="csv", file_pattern="P_{date}.csv", order_by="filename_timestamp", ts_format="%Y%m%d",
    rules=(Rule("k", ("not_null", "is_numeric")), Rule("c", ("not_null",), lookup="currencies")), business_key=("k",),
)


def test_failed_batch_is_finished_from_bronze(spark, house, tmp_path, refs):
    src = land(tmp_path / "in", "P_20260301.csv", "k,c\n1,USD\n2,EUR\n")
    with pytest.raises(Exception):
        run_batch(spark, PLAIN, src, house, now=NOW, references={"currencies": (refs["currencies"][0], "nowhere")})
    land(tmp_path / "in", "P_20260302.csv", "k,c\n3,USD\n")
    runs = by_file(run_batch(spark, PLAIN, src, house, now=NOW, references=refs))
    assert {n: (r.status, r.layer_reached, r.rows_out) for n, r in runs.items()} == {
        "P_20260301.csv": ("succeeded", "stage", 2), "P_20260302.csv": ("succeeded", "stage", 1)}
    assert sorted(r.k for r in house.stage("plain").read().collect()) == ["1", "2", "3"]
    assert spark.read.parquet(house.bronze("plain")).count() == 3
    again = by_file(run_batch(spark, PLAIN, src, house, now=NOW, references=refs))
    assert {n: (r.status, r.run_id) for n, r in again.items()} == {n: ("skipped", r.run_id) for n, r in runs.items()}
    assert house.stage("plain").read().count() == 3


def test_landed_content_goes_on_to_later_layers(spark, house, tmp_path, refs):
    src = land(tmp_path / "in", "FX_RATES_202609200900.csv", fx_file(("20260920", "USD", "INR", "100", "R"), ("20260920", "USD", "EUR", "0.9", "R")))
    ids = set()
    for layer in ("raw", "stage", "gold"):
        (run,) = run_batch(spark, FX, src, house, now=NOW, references=refs, stop_after=layer).runs.collect()
        assert (run.status, run.layer_reached, run.rows_out) == ("succeeded", layer, 2)
        ids.add(run.run_id)
    assert len(ids) == 1 and house.stage("fx_rates").read().count() == 2 and house.gold("fx_rates_gold").read().count() == 2
    assert spark.read.parquet(house.bronze("fx_rates")).count() == 2


def test_first_append_without_valid_rows(spark, house, tmp_path, refs):
    src = land(tmp_path / "in", "P_20260301.csv", "k,c\nx,USD\n")
    (run,) = run_batch(spark, PLAIN, src, house, now=NOW, references=refs).runs.collect()
    assert (run.status, run.rows_in, run.rows_out) == ("succeeded", 1, 0)
    assert house.stage("plain").read().count() == 0
    land(tmp_path / "in", "P_20260302.csv", "k,c\n3,USD\n")
    run_batch(spark, PLAIN, src, house, now=NOW, references=refs)
    assert [r.k for r in house.stage("plain").read().collect()] == ["3"]


RATES = replace(FX, write_mode="append", business_key=(), gold=(), stop_after="stage")


def test_truncate_load_takes_the_last_promoted_file(spark, house, tmp_path, refs):
    feed = replace(RATES, write_mode="truncate_load", business_key=())
    land(tmp_path / "in", "FX_RATES_202609200900.csv", fx_file(["20260920", "USD", "EUR", "0.9", "x"]))
    src = land(tmp_path / "in", "FX_RATES_202609201000.csv", fx_file(["20260920", "USD", "EUR", "bad", "x"]))
    run_batch(spark, feed, src, house, now=NOW, references=refs)
    assert house.stage("fx_rates").read().count() == 0


def test_batches_of_one_day_are_compared_in_the_order_they_ran(spark, house, tmp_path, refs):
    feed = replace(RATES, anomaly=AnomalyPolicy(("row_count",), threshold=1.5), business_key=())
    for i, (name, rows) in enumerate(zip("edcba", (3, 4, 5, 3, 40))):
        body = fx_file(*[["20260920", "USD", "EUR", f"{k}.5", f"s{i}"] for k in range(1, rows + 1)])
        src = land(tmp_path / f"in{i}", f"FX_RATES_20260920100{i}.csv", body)
        run_batch(spark, feed, src, house, now=NOW, batch_id=name, references=refs)
        assert house.control("alerts").count() == (1 if name == "a" else 0)
    history = house.control("profile_history").orderBy("run_number").collect()
    assert [(r.run_number, r.batch_id) for r in history] == list(enumerate("edcba", 1))
    # A repeated batch keeps its place.
    run_batch(spark, feed, f"file:{tmp_path}/in2", house, now=NOW, batch_id="c", references=refs)
    assert {r.batch_id: r.run_number for r in house.control("profile_history").collect()}["c"] == 3


def test_files_of_one_name_are_records_of_their_own(spark, house, tmp_path, refs):
    bad = fx_file(["20260920", "USD", "EUR", "bad", "x"])
    places = [land(tmp_path / f"q{i}", "FX_RATES_202609201000.csv", bad + "\n" * i) for i in (1, 2)]
    places.append(land(tmp_path / "q3", "FX_RATES_202609201100.csv", bad))
    run_batch(spark, RATES, places, house, now=NOW, batch_id="b", references=refs)
    ids = sorted(r.quarantine_id for r in list_quarantine(house.control("quarantine")).collect())
    assert len(ids) == 3 and ids[2] == "FX_RATES_202609201100.csv.b"
    mark_resolved(house.resolved(), pipeline_name="fx_rates", quarantine_id=ids[0], now=NOW)
    assert sorted(r.quarantine_id for r in list_quarantine(house.control("quarantine"), house.resolved().read()).collect()) == ids[1:]


def test_a_file_that_cannot_be_read_fails_alone(spark, house, tmp_path):
    feed = Feed(
        name="j", fmt="json", file_pattern="J_{date}.json", order_by="filename_timestamp", ts_format="%Y%m%d", rules=(), business_key=("id",),
        write_mode="upsert", on_earlier_failure="stop", buckets=4,
    )
    good = '[{"id": "%s", "v": "x"}]'
    land(tmp_path / "in", "J_20260101.json", good % 1)
    land(tmp_path / "in", "J_20260102.json", '[{"id": "2", "v": "x"')
    src = land(tmp_path / "in", "J_20260103.json", good % 3)
    runs = {r.file_path[-13:-5]: r for r in run_batch(spark, feed, src, house, now=NOW, batch_id="a").runs.collect()}
    assert [runs[f"2026010{d}"].status for d in (1, 2, 3)] == ["succeeded", "failed", "skipped"]
    assert runs["20260102"].failure_reasons and house.stage("j").read().count() == 1
    # Mended, it runs with what waited for it.
    (tmp_path / "in" / "J_20260102.json").write_text(good % 2)
    runs = {r.file_path[-13:-5]: r for r in run_batch(spark, feed, src, house, now=NOW, batch_id="b").runs.collect()}
    assert [runs[f"2026010{d}"].status for d in (1, 2, 3)] == ["skipped", "succeeded", "succeeded"]
    assert sorted(r.id for r in house.stage("j").read().collect()) == ["1", "2", "3"]
    land(tmp_path / "in", "J_20260104.json", "[{")
    land(tmp_path / "in", "J_20260105.json", good % 5)
    runs = run_batch(spark, replace(feed, on_earlier_failure="continue"), src, house, now=NOW, batch_id="c").runs
    assert {(r.status, r.file_path[-6]) for r in runs.collect()} >= {("failed", "4"), ("succeeded", "5")}
    land(tmp_path / "alone", "J_20260106.json", "[{")
    with pytest.raises(Exception):
        run_batch(spark, feed, f"file:{tmp_path}/alone", house, now=NOW)
