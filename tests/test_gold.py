from decimal import Decimal

import pytest

from tierline.operators.tables import SnapshotTable
from tierline.plans.gold import (
    daily_aum, fx_view, latest_rates, position_weights, price_returns, run_gold_build, standard_builds, stock_returns,
)

NOW = "2026-09-20 10:00:00"


def test_fx_rates(spark):
    rows = [("2026-09-19", "USD", "INR", "80", "12PM"), ("2026-09-20", "USD", "INR", "100", "12PM"),
            ("2026-09-20", "USD", "INR", "90", "7AM"), ("2026-09-20", "USD", "USD", "1", "7AM")]
    stage = spark.createDataFrame(rows, "fxDate string, fromCCY string, toCCY string, fxRate string, sourceType string").selectExpr(
        "cast(fxDate as date) fxDate", "fromCCY", "toCCY", "cast(fxRate as decimal(18,8)) fxRate", "sourceType")
    got = {(r.to_ccy, r.source_type): r for r in latest_rates(fx_view(stage), now=NOW).collect()}
    assert len(got) == 3
    noon = got[("INR", "12PM")]
    assert (noon.latest_rate, noon.prior_rate, noon.change_pct, noon.inverse_rate) == (
        Decimal(100), Decimal(80), Decimal("25.0000"), Decimal("0.01000000"))
    assert got[("INR", "7AM")].prior_rate is None and got[("INR", "7AM")].inverse_rate == Decimal("0.01111111")


def test_daily_aum(spark):
    stage = spark.sql("select date'2026-01-01' as_of_date, cast(100 as decimal(18,2)) total_net_assets_usd union all "
                      "select date'2026-01-01', 100 union all select date'2026-01-02', 250 union all select date'2026-01-03', 0 "
                      "union all select date'2026-01-04', 5")
    got = [(str(r.as_of_date), float(r.company_aum), r.daily_aum_change_pct) for r in daily_aum(stage).orderBy("as_of_date").collect()]
    assert got == [("2026-01-01", 200.0, None), ("2026-01-02", 250.0, 0.25), ("2026-01-03", 0.0, -1.0), ("2026-01-04", 5.0, None)]


def test_price_returns(spark):
    stage = spark.sql("select date'2026-01-01' Date, 'A' Ticker, cast(10 as decimal(18,10)) Close, cast(5 as decimal(18,0)) Volume "
                      "union all select date'2026-01-03', 'A', 15, 7 union all select date'2026-01-02', 'A', 99, 9")
    r = price_returns(stage, as_of="2026-01-31").first()
    assert (r.ticker, float(r.avg_volume), r.total_return, str(r.as_of_date)) == ("A", 7.0, 0.5, "2026-01-31")


def test_stock_returns(spark):
    stage = spark.sql("select 'S' symbol, cast(10 as decimal(12,4)) initial_price, cast(20 as decimal(12,4)) price_2002, cast(30 as decimal(12,4)) price_2007")
    r = stock_returns(stage).first()
    assert (r.total_return_pct, r.return_2002_to_2007_pct) == (2.0, 0.5)


@pytest.mark.parametrize("hot_rows", [1, 1000])
def test_weights(spark, hot_rows):
    stage = spark.sql("select p portfolio, s security, date'2026-01-01' date, cast(q as decimal(18,4)) shares, cast(2 as decimal(18,4)) price, 'USD' currency, cast(0.5 as decimal(10,6)) fx "
                      "from values ('P','a',1),('P','b',3),('Q','a',5),('Z','a',0) t(p,s,q)")
    got = {(r.portfolio, r.security): (float(r.market_value), r.weight) for r in position_weights(stage, as_of="2026-02-01", hot_rows=hot_rows).collect()}
    assert got == {("P", "a"): (1.0, 0.25), ("P", "b"): (3.0, 0.75), ("Q", "a"): (5.0, 1.0), ("Z", "a"): (0.0, None)}


def test_builds(spark, tmp_path, rows_of):
    builds = standard_builds(now=NOW, as_of="2026-09-20")
    holdings = spark.sql("select 'P' account_id, 's' security_id, date'2026-01-01' as_of_date, 1.0 quantity, cast(40 as decimal(18,2)) market_value, 'USD' currency "
                         "union all select 'R', 's', date'2026-01-01', 1.0, 7, 'USD'")
    asset = spark.sql("select 'P' portfolio_cd, date'2026-01-01' as_of_date, cast(100 as decimal(18,2)) total_net_assets_usd, 'USD' base_currency "
                      "union all select 'Q', date'2026-01-01', 9, 'EUR'")
    inputs = {"holdings": holdings, "asset": asset}
    table = SnapshotTable(spark, f"file:{tmp_path}/g")
    got = run_gold_build(builds["portfolio_summary_gold"], inputs, table, now=NOW)
    assert rows_of(got, "portfolio_id", "reconciliation_diff", "holding_count") == [
        ("P", Decimal("60.00"), 1), ("Q", None, None), ("R", None, 1)]
    with pytest.raises(ValueError, match="needs"):
        run_gold_build(builds["portfolio_summary_gold"], {"asset": asset}, table, now=NOW)
    history = SnapshotTable(spark, f"file:{tmp_path}/a")
    for _ in range(2):
        out = run_gold_build(builds["asset_gold"], inputs, history, now=NOW)
    assert rows_of(out, "version", "active_flag") == [(1, True)]
