from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tierline.operators.checks import Rule
from tierline.operators.commits import BatchJournal
from tierline.plans.gold import GoldBuild
from tierline.plans.ingest import Feed, Warehouse, run_batch

NOW = "2026-09-20 10:00:00"
FEED = Feed(
    name="f", fmt="csv", file_pattern="F_{date}.csv", order_by="filename_timestamp", ts_format="%Y%m%d",
    rules=(Rule("k", ("not_null",)), Rule("v", ("is_numeric",))), business_key=("k",), stop_after="gold",
    gold=(
        GoldBuild("counts", ("f",), lambda f: f.groupBy("v").agg(F.count(F.lit(1)).alias("n"))),
        GoldBuild("history", ("f",), lambda f: f.select("k", "v"), "scd2", ("k",), ("v",)),
    ),
)
MODES = {"append": {}, "upsert": {"write_mode": "upsert"}, "buckets": {"write_mode": "upsert", "buckets": 4}, "truncate_load": {"write_mode": "truncate_load"}}


class Died(BaseException):
    pass


def dying(house, log):
    """The warehouse of a process that ends in front of its first write to a log, or of its commit."""

    class Dying(Warehouse):
        def log(self, df, name, batch_id, part):
            if name == log:
                raise Died
            super().log(df, name, batch_id, part)

    made = Dying(house.spark, house.root)
    if log == "commit":
        def die(batch_id):
            raise Died

        made.journal.commit = die
    return made


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("k,v\n" + text)
    return f"file:{folder}"


def seen(house):
    """All a reader sees of the feed, by table."""
    tables = {name: house.control(name) for name in ("runs", "quarantine", "run_reasons", "step_events", "lineage_events", "alerts", "landed_files")}
    tables |= {"bronze": house.landed("f"), "silver": house.stage("f").read(), "counts": house.gold("counts").read()}
    tables["history"] = house.gold("history", "scd2").read()
    return {n: None if df is None else sorted(map(str, df.drop("load_timestamp").collect())) for n, df in tables.items()}


def keys(house):
    return sorted((r.k, r.v) for r in house.stage("f").read().select("k", "v").collect())


@pytest.mark.parametrize("mode, log", [
    ("append", "quarantine"), ("upsert", "runs"), ("buckets", "commit"), ("truncate_load", "landed_files"),
])
def test_a_dead_run_shows_nothing_and_is_finished(spark, house, tmp_path, mode, log):
    feed = replace(FEED, **MODES[mode])
    run_batch(spark, feed, put(tmp_path / "a", "F_20260101.csv", "a,1\nb,2\nc,x\n"), house, now=NOW, batch_id="1")
    before = seen(house)
    src = put(tmp_path / "b", "F_20260102.csv", "a,3\nd,4\ne,y\n")
    with pytest.raises(Died):
        run_batch(spark, feed, src, dying(house, log), now=NOW, batch_id="2")
    assert seen(house) == before and house.journal.states() == {"2": "open"}
    with pytest.raises(RuntimeError):
        house.stage("f", feed.buckets).drop_old()
    done = {r.status for r in run_batch(spark, feed, src, house, now=NOW, batch_id="3").runs.collect()}
    # A batch that landed nothing has nothing to be finished; its files ran with the next one.
    assert done == {"succeeded"} and house.journal.states() == ({"2": "undone"} if log == "landed_files" else {})
    merged = {"append": [("a", "1"), ("a", "3"), ("b", "2"), ("d", "4")], "truncate_load": [("a", "3"), ("d", "4")]}
    assert keys(house) == merged.get(mode, [("a", "3"), ("b", "2"), ("d", "4")])
    after = seen(house)
    assert len(after["bronze"]) == 6 and len(after["quarantine"]) == 2
    assert sum(r.n for r in house.gold("counts").read().collect()) == len(after["silver"])


def test_a_dead_first_run_and_recover(spark, house, tmp_path):
    src = put(tmp_path / "a", "F_20260101.csv", "a,1\nc,x\n")
    with pytest.raises(Died):
        run_batch(spark, FEED, src, dying(house, "commit"), now=NOW, batch_id="0 a/b+%:1")
    assert set(map(str, seen(house).values())) <= {"None", "[]"}
    assert house.recover() == ["0 a/b+%:1"] and house.journal.states() == {"0 a/b+%:1": "undone"}
    assert house.writing().stage("f").read() is None and house.gold("counts").read() is None and house.landed("f") is None
    # The same batch again, which stops behind bronze, and then goes on.
    run_batch(spark, FEED, src, house, now=NOW, batch_id="0 a/b+%:1", stop_after="raw")
    assert [r.batch_id for r in house.landed("f").select("batch_id").distinct().collect()] == ["0 a/b+%:1"]
    run_batch(spark, FEED, src, house, now=NOW, batch_id="2")
    assert keys(house) == [("a", "1")] and house.recover() == []


def test_landed_content_of_a_dead_run_is_committed_where_landing_is_enough(spark, house, tmp_path):
    src = put(tmp_path / "a", "F_20260101.csv", "a,1\n")
    with pytest.raises(Died):
        run_batch(spark, FEED, src, dying(house, "runs"), now=NOW, batch_id="1", stop_after="raw")
    assert house.landed("f") is None
    (run,) = run_batch(spark, FEED, src, house, now=NOW, batch_id="2", stop_after="raw").runs.collect()
    assert (run.status, run.layer_reached, run.rows_in) == ("succeeded", "raw", 1)
    assert house.landed("f").count() == 1 and house.journal.states() == {}


def test_a_failed_run_shows_its_steps_only(spark, house, tmp_path):
    src = put(tmp_path / "a", "F_20260101.csv", "a,1\nc,x\n")

    def down(f):
        raise ValueError("mart is down")

    feed = replace(FEED, gold=(*FEED.gold, GoldBuild("down", ("f",), down)))
    with pytest.raises(ValueError, match="down"):
        run_batch(spark, feed, src, house, now=NOW, batch_id="1")
    got = seen(house)
    assert house.journal.states() == {"1": "failed"}
    assert [bool(got[n]) for n in ("step_events", "lineage_events", "alerts")] == [True] * 3
    assert not any(got[n] for n in ("runs", "quarantine", "bronze", "silver", "counts", "history"))
    run_batch(spark, FEED, src, house, now=NOW, batch_id="2")
    assert keys(house) == [("a", "1")] and house.journal.states() == {} and house.control("quarantine").count() == 1


def test_markers(spark, tmp_path):
    journal = BatchJournal(spark, f"file:{tmp_path}/j")
    journal.begin("a/1", "x", {"silver/x": (2, 0)})
    assert [(h.place, h.snapshot, h.manifest) for h in journal.held_at("silver/x")] == [("silver/x", 2, 0)]
    with pytest.raises(RuntimeError, match="recover"):
        journal.begin("b", "y", {"silver/x": (3, 0)})
    journal.close("a/1", "failed")
    assert journal.hidden() == {"a/1"} and journal.hidden(but_failed=True) == frozenset()
    with pytest.raises(RuntimeError, match="taken back"):
        journal.commit("a/1")
    journal.begin("a/1", "x", {})
    assert journal.open_batches("x") == ["a/1"] and journal.open_batches("y") == []
    journal.commit("a/1")
    assert journal.states() == {}
