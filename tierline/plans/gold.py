"""Gold marts over silver tables.

Inputs keep the silver column names; staging projections are plain selects that
Catalyst folds into the mart's plan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions.spread import HOT_ROWS, attach_by_key, top_per_key
from tierline.operators.bucket_table import Scd2Table
from tierline.operators.scd2 import scd2_merge
from tierline.operators.tables import SnapshotTable
from tierline.sources.tables import staging_view


def pass_through(stage: DataFrame) -> DataFrame:
    """A mart that is the silver table itself."""
    return stage.select("*")


# Staging projections --------------------------------------------------------

def asset_view(stage: DataFrame) -> DataFrame:
    return staging_view(stage, {
        "portfolio_cd": "portfolio_id", "as_of_date": "as_of_date",
        "total_net_assets_usd": "total_net_assets_usd", "base_currency": "base_currency",
    })


def holdings_view(stage: DataFrame) -> DataFrame:
    return staging_view(stage, {
        "account_id": "portfolio_id", "security_id": "security_id", "as_of_date": "as_of_date",
        "quantity": "quantity", "market_value": "market_value", "currency": "currency",
    })


def fx_view(stage: DataFrame) -> DataFrame:
    return staging_view(stage, {
        "fxDate": "fx_date", "fromCCY": "from_ccy", "toCCY": "to_ccy", "fxRate": "fx_rate", "sourceType": "source_type",
    })


def sales_view(stage: DataFrame) -> DataFrame:
    return staging_view(stage, {c: c for c in (
        "order_id", "region", "country", "item_type", "sales_channel", "order_date", "units_sold", "total_revenue",
        "total_profit",
    )})


# Marts ----------------------------------------------------------------------

def _ratio(part: Column, whole: Column) -> Column:
    """A quotient as double; NULL instead of an error where the divisor is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def daily_aum(stage: DataFrame) -> DataFrame:
    """Company assets per day and their change on the day before.

    The lag runs over one row per calendar date, whatever the size of the input.
    """
    per_day = stage.groupBy("as_of_date").agg(F.sum("total_net_assets_usd").alias("company_aum"))
    before = F.lag("company_aum").over(Window.orderBy("as_of_date"))
    return per_day.withColumn("daily_aum_change_pct", _ratio(F.col("company_aum") - before, before))


def price_returns(stage: DataFrame, *, as_of: str) -> DataFrame:
    """Average volume and total return per ticker, first to last close, in one aggregation."""
    first = F.min(F.struct("Date", "Close"))["Close"]
    last = F.max(F.struct("Date", "Close"))["Close"]
    return stage.groupBy(F.col("Ticker").alias("ticker")).agg(
        F.avg("Volume").alias("avg_volume"), first.alias("__first"), last.alias("__last")
    ).select(
        "ticker", "avg_volume", _ratio(F.col("__last") - F.col("__first"), F.col("__first")).alias("total_return"),
        F.lit(as_of).cast("date").alias("as_of_date"),
    )


def stock_returns(stage: DataFrame) -> DataFrame:
    return stage.select(
        "symbol",
        _ratio(F.col("price_2007") - F.col("initial_price"), F.col("initial_price")).alias("total_return_pct"),
        _ratio(F.col("price_2007") - F.col("price_2002"), F.col("price_2002")).alias("return_2002_to_2007_pct"),
    )


def position_weights(stage: DataFrame, *, as_of: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Market value of each position and its weight in the portfolio.

    Portfolio totals are aggregated and brought back, so a portfolio with very many
    positions is not collected in one task.
    """
    # Scale is set by hand: a three-factor product would be cut to six digits.
    value = (F.col("shares") * F.col("price")).cast("decimal(28,8)") * F.col("fx")
    rows = stage.select(
        "portfolio", "security", F.col("date").alias("source_date"), "shares", "price", "currency", "fx",
        value.alias("market_value"), F.lit(as_of).cast("date").alias("holding_date"),
    )
    totals = rows.groupBy("portfolio").agg(F.sum("market_value").alias("__total"), F.count(F.lit(1)).alias("__n"))
    joined = attach_by_key(rows, totals, ["portfolio"], ["__total"], rows="__n", hot_rows=hot_rows)
    return joined.withColumn("weight", _ratio(F.col("market_value"), F.col("__total"))).drop("__total")


def portfolio_positions(holdings: DataFrame, assets: DataFrame) -> DataFrame:
    """Rolled-up holdings against reported assets, rows of either side kept."""
    rolled = holdings.groupBy("portfolio_id", "as_of_date").agg(
        F.sum("market_value").alias("holdings_market_value"), F.count(F.lit(1)).alias("holding_count")
    )
    return rolled.join(assets, ["portfolio_id", "as_of_date"], "full").select(
        "portfolio_id", "as_of_date", "holdings_market_value", "holding_count", "total_net_assets_usd", "base_currency"
    )


def portfolio_summary(holdings: DataFrame, assets: DataFrame, *, now: str) -> DataFrame:
    """The reconciliation mart: reported assets minus holdings, NULL if a side is missing."""
    return portfolio_positions(holdings, assets).select(
        "*", (F.col("total_net_assets_usd") - F.col("holdings_market_value")).alias("reconciliation_diff"),
        F.lit(now).cast("timestamp").alias("gold_loaded_at"),
    )


def regional_sales(sales: DataFrame, *, now: str) -> DataFrame:
    return sales.groupBy("region", "item_type").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("units_sold").alias("total_units_sold"),
        F.sum("total_revenue").alias("total_revenue"), F.sum("total_profit").alias("total_profit"),
    ).withColumn("gold_loaded_at", F.lit(now).cast("timestamp"))


def latest_rates(rates: DataFrame, *, now: str) -> DataFrame:
    """Latest rate, the one before, change and inverse per currency pair and source.

    Only the last two dates of a pair leave each map task (group limit), so pairs with
    a long history do not pile up anywhere.
    """
    keys = ["from_ccy", "to_ccy", "source_type"]
    recent = top_per_key(rates, keys, [F.desc("fx_date")], 2, rank="recency")
    pick = {n: F.col("recency") == n for n in (1, 2)}
    paired = recent.groupBy(*keys).agg(
        F.max(F.when(pick[1], F.col("fx_date"))).alias("latest_fx_date"),
        F.max(F.when(pick[1], F.col("fx_rate"))).alias("latest_rate"),
        F.max(F.when(pick[2], F.col("fx_rate"))).alias("prior_rate"),
    )
    rate, prior = F.col("latest_rate"), F.col("prior_rate")
    return paired.select(
        *keys, "latest_fx_date", "latest_rate", "prior_rate",
        F.round(F.try_divide(rate - prior, prior) * 100, 4).alias("change_pct"),
        F.round(F.try_divide(F.lit(1).cast("decimal(1,0)"), rate), 8).alias("inverse_rate"),
        F.lit(now).cast("timestamp").alias("gold_loaded_at"),
    )


# Builds ---------------------------------------------------------------------

@dataclass(frozen=True)
class GoldBuild:
    """A named mart: its inputs by name, how it is computed and how it is kept.

    ``materialized``: ``view`` (nothing is written), ``table`` (rebuilt as a whole) or
    ``scd2`` (history by ``key`` over the ``tracked`` columns).
    """

    name: str
    depends_on: tuple[str, ...]
    compute: Callable[..., DataFrame]
    materialized: str = "table"
    key: tuple[str, ...] = ()
    tracked: tuple[str, ...] = ()
    options: Mapping[str, str] = field(default_factory=dict)


def standard_builds(*, now: str, as_of: str) -> dict[str, GoldBuild]:
    """The marts of this module by name."""
    builds = [
        GoldBuild("holdings_gold", ("holdings",), pass_through),
        GoldBuild("asset_gold", ("asset",), daily_aum, "scd2", ("as_of_date",), ("company_aum", "daily_aum_change_pct")),
        GoldBuild("price_gold", ("price",), lambda price: price_returns(price, as_of=as_of), "scd2",
                  ("ticker", "as_of_date"), ("avg_volume", "total_return")),
        GoldBuild("stocks_gold", ("stocks",), stock_returns, "scd2", ("symbol",),
                  ("total_return_pct", "return_2002_to_2007_pct")),
        GoldBuild("portfolio_holdings_gold", ("portfolio_holdings",),
                  lambda positions: position_weights(positions, as_of=as_of)),
        GoldBuild("portfolio_summary_gold", ("holdings", "asset"),
                  lambda holdings, asset: portfolio_summary(holdings_view(holdings), asset_view(asset), now=now)),
        GoldBuild("regional_sales_gold", ("sales",), lambda sales: regional_sales(sales_view(sales), now=now)),
        GoldBuild("fx_rates_gold", ("fx_rates",), lambda fx: latest_rates(fx_view(fx), now=now)),
    ]
    return {b.name: b for b in builds}


def run_gold_build(build: GoldBuild, inputs: Mapping[str, DataFrame], table: SnapshotTable | Scd2Table | None, *, now: str) -> DataFrame:
    """Computes a mart from its inputs and stores it as its materialization says; a history only takes its changes."""
    missing = [d for d in build.depends_on if d not in inputs]
    if missing:
        raise ValueError(f"{build.name} needs {missing}")
    result = build.compute(*[inputs[d] for d in build.depends_on])
    if build.materialized == "view":
        result.createOrReplaceTempView(build.name)
        return result
    if table is None:
        raise ValueError(f"{build.name} needs a table to be written to")
    if build.materialized == "scd2" and isinstance(table, Scd2Table):
        return table.merge(result, list(build.key), list(build.tracked), now)
    if build.materialized == "scd2":
        return table.replace(scd2_merge(table.read(), result, list(build.key), list(build.tracked), now))
    if build.materialized == "table":
        return table.replace(result)
    raise ValueError(f"unknown materialization {build.materialized!r}")
