"""Marts that follow a keyed silver table against the same marts computed as a whole."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierline.operators.bucket_table import BucketTable
from tierline.operators.incremental import KeyMart, SumMart


def rows(spark, *values):
    text = [(i, r, d, None if a is None else str(a), u) for i, r, d, a, u in values]
    made = spark.createDataFrame(text, "id long, region string, day string, amount string, units int")
    return made.selectExpr("id", "region", "cast(day as date) day", "cast(amount as decimal(18,2)) amount", "units", "cast(units as double) ratio")


FIRST = [(1, "A", "2026-01-01", 10, 1), (2, "A", "2026-01-02", None, 2), (3, None, "2026-01-01", 5, 3), (4, "B", "2026-01-01", None, None), (5, "", "2026-01-01", "0.01", 0)]
BATCHES = [
    FIRST,
    [(1, "B", "2026-01-01", 10, 1), (4, "B", "2026-01-01", -7, None)],  # a row changes its group, a sum gets its first value
    [(3, "C", "2026-01-01", 5, 3), (6, None, "2026-01-03", 1, 9)],  # one leaves the NULL group, one comes
    [(5, "C", "2026-01-01", None, 0), (2, "A", "2026-01-02", None, 2)],  # a group loses its last row, a row comes again as it is
]


def whole(silver):
    return silver.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"), F.sum("units").alias("units"))


def latest(silver):
    top = F.max_by(F.struct("day", "amount"), F.struct("day", "id"))
    return silver.groupBy(F.col("region").alias("area")).agg(top.alias("top")).select("area", "top.day", "top.amount")


def as_set(df):
    return sorted(map(repr, df.collect()))


def marts(spark, path):
    silver = BucketTable(spark, f"file:{path}/silver", buckets=4)
    sums = SumMart(silver, BucketTable(spark, f"file:{path}/sums", buckets=4), ["region"], {"total": "amount", "units": "units"}, count="n")
    newest = KeyMart(silver, BucketTable(spark, f"file:{path}/latest", buckets=4), {"region": "area"}, latest)
    return silver, sums, newest


def test_marts_equal_the_whole_after_every_batch(spark, tmp_path):
    silver, sums, newest = marts(spark, tmp_path)
    assert sums.update() is None and newest.update() is None
    for batch in BATCHES:
        silver.upsert(rows(spark, *batch), ["id"])
        now = silver.read()
        assert as_set(sums.update()) == as_set(whole(now))
        assert as_set(newest.update()) == as_set(latest(now))
    assert dict(sums.read().dtypes)["total"] == dict(whole(now).dtypes)["total"]
    before = (sums.state.versions(), newest.state.versions())
    sums.update(), newest.update()
    assert (sums.state.versions(), newest.state.versions()) == before and sums.followed() == silver.versions()[-1]


def test_several_versions_at_once_and_removed_ones(spark, tmp_path):
    silver, sums, newest = marts(spark, tmp_path)
    silver.upsert(rows(spark, *BATCHES[0]), ["id"])
    sums.update(), newest.update()
    for batch in BATCHES[1:3]:
        silver.upsert(rows(spark, *batch), ["id"])
    assert as_set(sums.update()) == as_set(whole(silver.read()))
    assert as_set(newest.update()) == as_set(latest(silver.read()))
    silver.upsert(rows(spark, *BATCHES[3]), ["id"])
    silver.upsert(rows(spark, (9, "Z", "2026-02-01", 2, 2)), ["id"])
    silver.drop_old(keep=1)  # the version that the marts stand for is gone
    assert sums.followed() not in silver.versions()
    assert as_set(sums.update()) == as_set(whole(silver.read()))
    assert as_set(newest.update()) == as_set(latest(silver.read()))


def test_a_batch_reads_and_writes_touched_buckets_only(spark, tmp_path):
    silver, sums, _ = marts(spark, tmp_path)
    silver.upsert(rows(spark, *[(i, f"r{i % 7}", "2026-01-01", i, 1) for i in range(200)]), ["id"])
    sums.update()
    held = sums.state.manifest().folders
    silver.upsert(rows(spark, (3, "r3", "2026-01-01", 1000, 1)), ["id"])
    signed = silver.changes(1, 2, "sign")
    assert 0 < signed.count() < 200 and signed.agg(F.sum("sign")).first()[0] == 0
    got = {r.region: r.total for r in sums.update().collect()}
    assert got["r3"] == sum(i for i in range(200) if i % 7 == 3) - 3 + Decimal(1000)
    after = sums.state.manifest().folders
    assert sum(held[b] != after[b] for b in held) == 1


def test_an_update_that_fails_changes_nothing(spark, tmp_path):
    silver, sums, _ = marts(spark, tmp_path)
    silver.upsert(rows(spark, *FIRST), ["id"])
    before = as_set(sums.update())
    silver.upsert(rows(spark, *BATCHES[1]), ["id"])
    commit = sums.state._commit
    sums.state._commit = lambda manifest: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        sums.update()
    sums.state._commit = commit
    assert as_set(sums.read()) == before
    assert as_set(sums.update()) == as_set(whole(silver.read()))


def test_sums_of_doubles_are_refused(spark, tmp_path):
    silver, _, _ = marts(spark, tmp_path)
    silver.upsert(rows(spark, *FIRST), ["id"])
    with pytest.raises(ValueError, match="ratio"):
        SumMart(silver, BucketTable(spark, f"file:{tmp_path}/x"), ["region"], {"r": "ratio"}, count="n").update()
