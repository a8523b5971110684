"""Gold marts and version history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import landed, money, query, table
from tierline.functions.spread import new_folder
from tierline.operators.bucket_table import BucketTable, Scd2Table
from tierline.operators.incremental import KeyMart, SumMart
from tierline.operators.scd2 import current_versions, scd2_changes, scd2_merge
from tierline.operators.tables import SnapshotTable
from tierline.plans.gold import (
    GoldBuild, asset_view, daily_aum, fx_view, holdings_view, latest_rates, pass_through, portfolio_positions,
    portfolio_summary, position_weights, price_returns, regional_sales, run_gold_build, sales_view, stock_returns,
)

NOW = "2026-01-31 12:00:00"


@query("gold_pass_through", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def gold_pass_through(spark: SparkSession, folder: str) -> DataFrame:
    return pass_through(table(spark, folder, "part"))


_AUM = """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS as_of_date, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS aum FROM orders GROUP BY 1),
     l AS (SELECT *, lag(aum) OVER (ORDER BY as_of_date) AS before FROM d)
     SELECT as_of_date, CAST(aum AS DOUBLE) AS company_aum,
            round(CAST(aum - before AS DOUBLE) / CAST(before AS DOUBLE), 9) AS daily_aum_change_pct FROM l"""


def assets(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("portfolio_cd"), F.to_date("o_orderdate").alias("as_of_date"),
        money("o_totalprice").alias("total_net_assets_usd"), F.lit("USD").alias("base_currency"),
    )


@query("gold_aum", _AUM)
def gold_aum(spark: SparkSession, folder: str) -> DataFrame:
    return daily_aum(assets(spark, folder)).select(
        "as_of_date", F.col("company_aum").cast("double").alias("company_aum"),
        F.round("daily_aum_change_pct", 9).alias("daily_aum_change_pct"),
    )


@query("gold_build_scd2", f"SELECT as_of_date, company_aum, daily_aum_change_pct, 1 AS version, TRUE AS active_flag FROM ({_AUM})")
def gold_build_scd2(spark: SparkSession, folder: str) -> DataFrame:
    """A mart kept with history; building it again from the same input writes no version."""
    build = GoldBuild("asset_gold", ("asset",), daily_aum, "scd2", ("as_of_date",), ("company_aum", "daily_aum_change_pct"))
    history = SnapshotTable(spark, new_folder(spark, "gold"))
    for _ in range(2):
        out = run_gold_build(build, {"asset": assets(spark, folder)}, history, now=NOW)
    return out.select(
        "as_of_date", F.col("company_aum").cast("double").alias("company_aum"),
        F.round("daily_aum_change_pct", 9).alias("daily_aum_change_pct"), "version", "active_flag",
    )


@query(
    "gold_price",
    """WITH e AS (SELECT event_type, user_id, ts, CAST(value AS DECIMAL(18,2)) AS value, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
       r AS (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts) AS f, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC) AS l FROM e),
       p AS (SELECT event_type || '-' || user_id AS ticker, avg(k) AS avg_volume, max(CASE WHEN f = 1 THEN value END) AS first_close,
                    max(CASE WHEN l = 1 THEN value END) AS last_close FROM r GROUP BY 1)
       SELECT ticker, round(avg_volume, 6) AS avg_volume, round(CAST(last_close - first_close AS DOUBLE) / CAST(first_close AS DOUBLE), 9) AS total_return,
              DATE '2026-01-31' AS as_of_date FROM p""",
)
def gold_price(spark: SparkSession, folder: str) -> DataFrame:
    prices = table(spark, folder, "events").select(
        F.col("ts").alias("Date"), F.concat_ws("-", "event_type", "user_id").alias("Ticker"), money("value").alias("Close"),
        F.get_json_object("props", "$.k").cast("int").alias("Volume"),
    )
    return price_returns(prices, as_of="2026-01-31").select(
        "ticker", F.round("avg_volume", 6).alias("avg_volume"), F.round("total_return", 9).alias("total_return"), "as_of_date"
    )


@query(
    "gold_stocks",
    """SELECT p_partkey AS symbol, round((CAST(p_retailprice AS DECIMAL(12,4)) * 2 + p_size - CAST(p_retailprice AS DECIMAL(12,4)))::DOUBLE
                / CAST(p_retailprice AS DECIMAL(12,4))::DOUBLE, 9) AS total_return_pct,
              round((CAST(p_retailprice AS DECIMAL(12,4)) * 2 + p_size - (CAST(p_retailprice AS DECIMAL(12,4)) + p_size))::DOUBLE
                / (CAST(p_retailprice AS DECIMAL(12,4)) + p_size)::DOUBLE, 9) AS return_2002_to_2007_pct FROM part""",
)
def gold_stocks(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("p_retailprice").cast("decimal(12,4)")
    stage = table(spark, folder, "part").select(
        F.col("p_partkey").alias("symbol"), price.alias("initial_price"), (price + F.col("p_size")).alias("price_2002"),
        (price * 2 + F.col("p_size")).alias("price_2007"),
    )
    return stock_returns(stage).select(
        "symbol", F.round("total_return_pct", 9).alias("total_return_pct"),
        F.round("return_2002_to_2007_pct", 9).alias("return_2002_to_2007_pct"),
    )


@query(
    "gold_weights",
    """WITH p AS (SELECT l_suppkey AS portfolio, l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS source_date,
                    CAST(l_quantity AS DECIMAL(8,2)) * CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(1 - l_discount AS DECIMAL(4,2)) AS mv FROM lineitem)
       SELECT portfolio, l_orderkey, l_linenumber, l_partkey, source_date, CAST(mv AS DOUBLE) AS market_value,
              round(CAST(mv AS DOUBLE) / CAST(sum(mv) OVER (PARTITION BY portfolio) AS DOUBLE), 12) AS weight FROM p""",
)
def gold_weights(spark: SparkSession, folder: str) -> DataFrame:
    stage = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("portfolio"), F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("security"),
        F.to_date("l_shipdate").alias("date"), F.col("l_quantity").cast("decimal(18,4)").alias("shares"),
        F.col("l_extendedprice").cast("decimal(18,4)").alias("price"), F.lit("USD").alias("currency"),
        (1 - F.col("l_discount")).cast("decimal(4,2)").cast("decimal(10,6)").alias("fx"),
    )
    return position_weights(landed(stage), as_of="2026-01-31").select(
        "portfolio", "security.l_orderkey", "security.l_linenumber", "security.l_partkey", "source_date",
        F.col("market_value").cast("double").alias("market_value"), F.round("weight", 12).alias("weight"),
    )


_RECON = """WITH h AS (SELECT l_suppkey AS portfolio_id, CAST(l_shipdate AS DATE) AS as_of_date, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS mv, count(*) AS n
                      FROM lineitem GROUP BY 1, 2),
     a AS (SELECT o_custkey AS portfolio_id, CAST(o_orderdate AS DATE) AS as_of_date, CAST(o_totalprice AS DECIMAL(18,2)) AS nav, o_orderpriority AS base_currency
           FROM orders),
     j AS (SELECT coalesce(h.portfolio_id, a.portfolio_id) AS portfolio_id, coalesce(h.as_of_date, a.as_of_date) AS as_of_date, mv, n, nav, base_currency
           FROM h FULL JOIN a ON h.portfolio_id = a.portfolio_id AND h.as_of_date = a.as_of_date) """


def reconciliation_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers and customers share key values on some days only, so both sides keep rows without a partner."""
    holdings = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("account_id"), F.col("l_partkey").alias("security_id"), F.to_date("l_shipdate").alias("as_of_date"),
        F.col("l_quantity").alias("quantity"), money("l_extendedprice").alias("market_value"), F.lit("USD").alias("currency"),
    )
    reported = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("portfolio_cd"), F.to_date("o_orderdate").alias("as_of_date"), money("o_totalprice").alias("total_net_assets_usd"),
        F.col("o_orderpriority").alias("base_currency"),
    )
    return holdings_view(holdings), asset_view(reported)


@query(
    "gold_recon",
    _RECON + """SELECT portfolio_id, as_of_date, CAST(mv AS DOUBLE) AS holdings_market_value, n AS holding_count, CAST(nav AS DOUBLE) AS total_net_assets_usd,
                base_currency, CAST(nav - mv AS DOUBLE) AS reconciliation_diff FROM j""",
)
def gold_recon(spark: SparkSession, folder: str) -> DataFrame:
    return portfolio_summary(*reconciliation_inputs(spark, folder), now=NOW).select(
        "portfolio_id", "as_of_date", F.col("holdings_market_value").cast("double").alias("holdings_market_value"), "holding_count",
        F.col("total_net_assets_usd").cast("double").alias("total_net_assets_usd"), "base_currency",
        F.col("reconciliation_diff").cast("double").alias("reconciliation_diff"),
    )


@query(
    "gold_positions",
    _RECON + "SELECT base_currency, count(*) AS n_rows, count(mv) AS with_holdings, count(nav) AS with_assets FROM j GROUP BY 1",
)
def gold_positions(spark: SparkSession, folder: str) -> DataFrame:
    return portfolio_positions(*reconciliation_inputs(spark, folder)).groupBy("base_currency").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("holdings_market_value").alias("with_holdings"),
        F.count("total_net_assets_usd").alias("with_assets"),
    )


@query(
    "gold_rollup",
    """SELECT r_name AS region, p_type AS item_type, count(*) AS order_count, CAST(sum(CAST(l_quantity AS DECIMAL(12,0))) AS BIGINT) AS total_units_sold,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(l_quantity AS DECIMAL(12,0)) * CAST(p_retailprice AS DECIMAL(12,2))) AS DOUBLE) AS total_profit
       FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
       JOIN part ON p_partkey = l_partkey GROUP BY 1, 2""",
)
def gold_rollup(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").join(table(spark, folder, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    lines = lines.join(table(spark, folder, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    lines = lines.join(table(spark, folder, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    lines = lines.join(table(spark, folder, "part"), F.col("p_partkey") == F.col("l_partkey"))
    units = F.col("l_quantity").cast("decimal(12,0)")
    sales = lines.select(
        F.col("l_orderkey").alias("order_id"), F.col("r_name").alias("region"), F.col("n_name").alias("country"),
        F.col("p_type").alias("item_type"), F.lit("Online").alias("sales_channel"), F.col("l_shipdate").alias("order_date"),
        units.alias("units_sold"), money("l_extendedprice").alias("total_revenue"),
        (money("l_extendedprice") - units * F.col("p_retailprice").cast("decimal(12,2)")).alias("total_profit"),
    )
    return regional_sales(sales_view(sales), now=NOW).select(
        "region", "item_type", "order_count", F.col("total_units_sold").cast("long").alias("total_units_sold"),
        F.col("total_revenue").cast("double").alias("total_revenue"), F.col("total_profit").cast("double").alias("total_profit"),
    )


_FX = """WITH d AS (SELECT user_id, event_type, CASE WHEN hour(ts) < 12 THEN 'am' ELSE 'pm' END AS source_type, CAST(ts AS DATE) AS fx_date,
                         CAST(sum(CAST(value AS DECIMAL(10,2))) AS DECIMAL(18,8)) AS rate FROM events GROUP BY 1, 2, 3, 4),
       r AS (SELECT *, lag(rate) OVER (PARTITION BY user_id, event_type, source_type ORDER BY fx_date) AS prior_rate,
                    row_number() OVER (PARTITION BY user_id, event_type, source_type ORDER BY fx_date DESC) AS recency FROM d)
       SELECT user_id AS from_ccy, event_type AS to_ccy, source_type, fx_date AS latest_fx_date, CAST(rate AS DOUBLE) AS latest_rate,
              CAST(prior_rate AS DOUBLE) AS prior_rate,
              CASE WHEN prior_rate IS NULL OR prior_rate = 0 THEN NULL ELSE round(CAST(rate - prior_rate AS DOUBLE) / CAST(prior_rate AS DOUBLE) * 100, 4) END AS change_pct,
              round(1 / CAST(rate AS DOUBLE), 8) AS inverse_rate FROM r WHERE recency = 1"""


def exchange_rates(spark: SparkSession, folder: str) -> DataFrame:
    half = F.when(F.hour("ts") < 12, "am").otherwise("pm")
    return table(spark, folder, "events").groupBy(
        F.col("user_id").alias("fromCCY"), F.col("event_type").alias("toCCY"), half.alias("sourceType"), F.to_date("ts").alias("fxDate")
    ).agg(F.sum(F.col("value").cast("decimal(10,2)")).cast("decimal(18,8)").alias("fxRate"))


def _rates_as_doubles(rates: DataFrame) -> DataFrame:
    return rates.select(
        "from_ccy", "to_ccy", "source_type", "latest_fx_date",
        *[F.col(c).cast("double").alias(c) for c in ("latest_rate", "prior_rate", "change_pct", "inverse_rate")],
    )


@query("gold_fx", _FX)
def gold_fx(spark: SparkSession, folder: str) -> DataFrame:
    return _rates_as_doubles(latest_rates(fx_view(exchange_rates(spark, folder)), now=NOW))


# Marts that follow silver by its changes -----------------------------------------

@query("gold_incremental", _AUM)
def gold_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Daily assets over three batches: some rows come with a wrong amount, some under a wrong day, and are corrected later."""
    right = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("as_of_date"), money("o_totalprice").alias("total_net_assets_usd"))
    amount, day = F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "P"
    wrong = right.withColumns({
        "total_net_assets_usd": F.when(amount, F.col("total_net_assets_usd") + 1).otherwise(F.col("total_net_assets_usd")),
        "as_of_date": F.when(day, F.date_add("as_of_date", 4000)).otherwise(F.col("as_of_date")),
    })
    silver = BucketTable(spark, new_folder(spark, "silver"))
    mart = SumMart(silver, BucketTable(spark, new_folder(spark, "mart")), ["as_of_date"], {"total_net_assets_usd": "total_net_assets_usd"}, count="positions")
    for batch in (wrong, right.filter(amount), right.filter(day)):
        silver.upsert(batch, ["o_orderkey"])
        out = mart.update()
    return daily_aum(out).select(
        "as_of_date", F.col("company_aum").cast("double").alias("company_aum"),
        F.round("daily_aum_change_pct", 9).alias("daily_aum_change_pct"),
    )


@query("gold_incremental_fx", _FX)
def gold_incremental_fx(spark: SparkSession, folder: str) -> DataFrame:
    """Latest rates of which those before noon come wrong at first; the second update computes their pairs alone."""
    right = landed(exchange_rates(spark, folder))
    early = F.col("sourceType") == "am"
    wrong = right.withColumn("fxRate", F.when(early, (F.col("fxRate") + 1).cast("decimal(18,8)")).otherwise(F.col("fxRate")))
    silver = BucketTable(spark, new_folder(spark, "silver"))
    mart = KeyMart(
        silver, BucketTable(spark, new_folder(spark, "mart")), {"fromCCY": "from_ccy", "toCCY": "to_ccy", "sourceType": "source_type"},
        lambda rows: latest_rates(fx_view(rows), now=NOW),
    )
    for batch in (wrong, right.filter(early)):
        silver.upsert(batch, ["fromCCY", "toCCY", "sourceType", "fxDate"])
        out = mart.update()
    return _rates_as_doubles(out)


# History over two states of the customers' order totals ------------------------

_SNAPSHOTS = """WITH s1 AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS orders
                           FROM orders WHERE o_orderdate < '2001-01-01' GROUP BY 1),
     s2 AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS orders FROM orders GROUP BY 1),
     target AS (SELECT *, 1 AS version, '2026-01-01' AS effective, CAST(NULL AS VARCHAR) AS expiry, TRUE AS active_flag,
                       md5(o_custkey || '|' || 1) AS scd_pk FROM s1),
     changed AS (SELECT s2.* FROM s2 LEFT JOIN target t ON s2.o_custkey = t.o_custkey AND t.active_flag
                 WHERE t.o_custkey IS NULL OR s2.total IS DISTINCT FROM t.total OR s2.orders IS DISTINCT FROM t.orders),
     prior AS (SELECT o_custkey, max(version) AS v FROM target GROUP BY 1),
     changes AS (SELECT c.o_custkey, c.total, c.orders, coalesce(p.v, 0) + 1 AS version, '2026-01-02' AS effective, CAST(NULL AS VARCHAR) AS expiry,
                        TRUE AS active_flag, md5(c.o_custkey || '|' || (coalesce(p.v, 0) + 1)) AS scd_pk
                 FROM changed c LEFT JOIN prior p USING (o_custkey)
                 UNION ALL SELECT t.o_custkey, t.total, t.orders, t.version, t.effective, '2026-01-02', FALSE, t.scd_pk
                 FROM target t JOIN changed c ON c.o_custkey = t.o_custkey WHERE t.active_flag),
     merged AS (SELECT * FROM changes UNION ALL SELECT * FROM target WHERE scd_pk NOT IN (SELECT scd_pk FROM changes)) """


def _totals(orders: DataFrame) -> DataFrame:
    return orders.groupBy("o_custkey").agg(
        F.sum(money("o_totalprice")).cast("double").alias("total"), F.count(F.lit(1)).alias("orders")
    )


def history(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, folder, "orders")
    first = scd2_merge(None, _totals(orders.filter("o_orderdate < '2001-01-01'")), ["o_custkey"], ["total", "orders"], "2026-01-01 00:00:00")
    return first, _totals(orders)


def _versions(df: DataFrame) -> DataFrame:
    return df.select(
        "o_custkey", "total", "orders", "version", F.date_format("effective_datetime", "yyyy-MM-dd").alias("effective"),
        F.date_format("expiry_datetime", "yyyy-MM-dd").alias("expiry"), "active_flag", "scd_pk",
    )


@query("scd2_first", _SNAPSHOTS + "SELECT * FROM target")
def scd2_first(spark: SparkSession, folder: str) -> DataFrame:
    return _versions(history(spark, folder)[0])


@query("scd2_changes", _SNAPSHOTS + "SELECT * FROM changes")
def scd2_changes_query(spark: SparkSession, folder: str) -> DataFrame:
    first, now = history(spark, folder)
    return _versions(scd2_changes(first, now, ["o_custkey"], ["total", "orders"], "2026-01-02 00:00:00"))


@query("scd2_incremental", _SNAPSHOTS + "SELECT * FROM merged")
def scd2_incremental(spark: SparkSession, folder: str) -> DataFrame:
    first, now = history(spark, folder)
    return _versions(scd2_merge(first, now, ["o_custkey"], ["total", "orders"], "2026-01-02 00:00:00"))


@query("scd2_current", _SNAPSHOTS + "SELECT o_custkey, total, version FROM merged WHERE active_flag")
def scd2_current(spark: SparkSession, folder: str) -> DataFrame:
    first, now = history(spark, folder)
    merged = scd2_merge(first, now, ["o_custkey"], ["total", "orders"], "2026-01-02 00:00:00")
    return current_versions(merged).select("o_custkey", "total", "version")


@query("scd2_unchanged", _SNAPSHOTS + "SELECT * FROM merged")
def scd2_unchanged(spark: SparkSession, folder: str) -> DataFrame:
    """A third run on the same state adds nothing."""
    first, now = history(spark, folder)
    merged = scd2_merge(first, now, ["o_custkey"], ["total", "orders"], "2026-01-02 00:00:00")
    return _versions(scd2_merge(merged, now, ["o_custkey"], ["total", "orders"], "2026-01-03 00:00:00"))


_THIRD = _SNAPSHOTS + """, s3 AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS orders
                                  FROM orders WHERE o_orderdate >= '1994-01-01' GROUP BY 1),
     again AS (SELECT s3.*, t.version AS v FROM s3 JOIN merged t ON s3.o_custkey = t.o_custkey AND t.active_flag
               WHERE s3.total IS DISTINCT FROM t.total OR s3.orders IS DISTINCT FROM t.orders)
    SELECT o_custkey, total, orders, v + 1 AS version, '2026-01-03' AS effective, CAST(NULL AS VARCHAR) AS expiry, TRUE AS active_flag,
           md5(o_custkey || '|' || (v + 1)) AS scd_pk FROM again
    UNION ALL SELECT m.o_custkey, m.total, m.orders, m.version, m.effective, CASE WHEN m.active_flag AND a.v IS NOT NULL THEN '2026-01-03' ELSE m.expiry END,
           m.active_flag AND a.v IS NULL, m.scd_pk FROM merged m LEFT JOIN again a USING (o_custkey)"""


@query("scd2_table", _THIRD)
def scd2_table(spark: SparkSession, folder: str) -> DataFrame:
    """Three runs and one without changes on a table of which a run writes only changed buckets and closed versions."""
    orders = table(spark, folder, "orders")
    states = [orders.filter("o_orderdate < '2001-01-01'"), orders, orders.filter("o_orderdate >= '1994-01-01'")]
    kept = Scd2Table(spark, new_folder(spark, "history"))
    for day, state in enumerate([*states, states[-1]], 1):
        kept.merge(_totals(state), ["o_custkey"], ["total", "orders"], f"2026-01-0{day} 00:00:00")
    return _versions(kept.read())
