"""Facts, marts and the daily report.

Series marts add their measures to the cleaned price rows, which already carry the asset
attributes, instead of joining separately built tables on (asset, day).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioloom.functions.calendar import date_key
from folioloom.functions.text import first_match
from folioloom.operators import series
from folioloom.operators.ranking import position_in_group

# Signal instruments of the regime mart.
REGIME_TICKERS = {
    "equity_index": "^GSPC",
    "bond": "AGGG.L",
    "gold": "GC=F",
    "oil": "CL=F",
    "fx": "GBPUSD=X",
}
GROWTH_TYPES = ["ETF", "Stock", "Index"]


def fact_asset_price_daily(prices: DataFrame) -> DataFrame:
    return prices.select(
        "date_key",
        "asset_key",
        "full_date",
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "adj_close_price",
        "volume",
    )


def only_funds(prices: DataFrame, profile: DataFrame) -> DataFrame:
    """Price rows of assets with a fund profile, cut before any window: the key is the window key."""
    return prices.join(profile.select("asset_key"), "asset_key", "left_semi")


def fact_etf_daily(fund_prices: DataFrame, profile: DataFrame) -> DataFrame:
    risk = series.measure(fund_prices, series.with_risk)
    return risk.join(profile.select("asset_key"), "asset_key").select(
        "date_key",
        F.col("asset_key").alias("etf_key"),
        "close_price",
        "return_1d",
        "return_1w",
        "return_1m",
        "return_3m",
        "return_6m",
        "return_1y",
        "volatility_30d",
        "drawdown_52w",
        F.col("sharpe_proxy_1y").alias("sharpe_proxy"),
    )


def mart_asset_returns(prices: DataFrame) -> DataFrame:
    return series.measure(prices, series.with_returns).select(
        "date_key", "full_date", "asset_key", "ticker", "asset_name", "asset_type", "asset_subtype",
        "region", "country", "currency", "close_price", "adj_close_price", "price_for_returns",
        *[f"return_{h}" for h in series.HORIZONS], "daily_return",
    )


def mart_asset_risk(prices: DataFrame) -> DataFrame:
    return series.measure(prices, series.with_risk).select(
        "date_key", "full_date", "asset_key", "ticker", "asset_name", "asset_type", "asset_subtype",
        "region", "currency", "volatility_30d", "volatility_90d", "drawdown_52w",
        "drawdown_since_inception", "sharpe_proxy_1y",
    )


def mart_asset_trend(prices: DataFrame) -> DataFrame:
    return series.measure(prices, series.with_trend).select(
        "date_key", "full_date", "asset_key", "ticker", "asset_name", "asset_type", "asset_subtype",
        "region", "price_for_returns", *series.TREND_COLUMNS,
    )


def mart_asset_moves(prices: DataFrame) -> DataFrame:
    """Rank of each asset's move within its day, largest first; a day holds every asset of the universe."""
    moved = (
        series.measure(prices, series.with_returns)
        .filter("return_1d is not null")
        .withColumn("abs_return_1d", F.abs("return_1d"))
        .select("full_date", "date_key", "asset_key", "ticker", "asset_name", "asset_type", "region",
                "return_1d", "abs_return_1d")
    )
    size = F.col("abs_return_1d")
    ranked = position_in_group(moved, "full_date", [size.desc(), F.col("ticker").asc()], "move_rank")
    change = F.col("return_1d")
    return ranked.withColumn(
        "move_direction", first_match([(change > 0, "Up"), (change < 0, "Down")], "Flat")
    )


def mart_fx_intelligence(prices: DataFrame) -> DataFrame:
    """Currency pairs with their measures; other asset types are cut before the windows."""
    pairs = prices.filter(F.col("asset_type") == "FX")
    return series.risk_and_trend(pairs).select(
        "full_date",
        "date_key",
        "asset_key",
        "ticker",
        "asset_name",
        F.split_part("ticker", F.lit("="), F.lit(1)).alias("fx_pair_code"),
        "return_1d",
        "return_1w",
        "return_1m",
        "volatility_30d",
        "drawdown_52w",
        "trend_label",
        "above_sma_50_flag",
        "above_sma_200_flag",
    )


def regime_label(index: Column, above: Column, bond: Column, gold: Column, oil: Column) -> Column:
    """Ordered rules; a missing index return falls through to the later ones."""

    def zero(c: Column) -> Column:
        return F.coalesce(c, F.lit(0.0))

    return first_match(
        [
            ((index > 0) & F.coalesce(above, F.lit(False)) & (zero(bond) >= 0), "Risk On"),
            ((index < 0) & (zero(bond) > 0), "Defensive"),
            ((zero(oil) > 0) & (zero(gold) > 0) & (zero(bond) < 0), "Inflationary"),
        ],
        "Mixed",
    )


def mart_market_regime(prices: DataFrame, tickers: Mapping[str, str] = REGIME_TICKERS) -> DataFrame:
    """Five signals a day and their label.

    Only the index needs a moving average, so it is taken over the one row per day that is left of the
    index after the aggregation, not over every asset's series.
    """
    measured = series.measure(prices, series.with_returns)
    ticker = F.col("ticker")

    def month_return(role: str, name: str) -> Column:
        return F.max(F.when(ticker == tickers[role], F.col("return_1m"))).alias(name)

    is_index = ticker == tickers["equity_index"]
    daily = measured.groupBy("full_date").agg(
        month_return("equity_index", "sp500_return_1m"),
        month_return("bond", "global_bond_return_1m"),
        month_return("gold", "gold_return_1m"),
        month_return("oil", "oil_return_1m"),
        month_return("fx", "gbpusd_return_1m"),
        F.max(F.when(is_index, F.col("price_for_returns"))).alias("_index"),
        F.avg(F.when(F.col("asset_type").isin(GROWTH_TYPES), F.col("return_1d"))).alias(
            "growth_asset_avg_return_1d"
        ),
    )
    price = F.col("_index")
    # days without the index are a partition of their own
    latest = W.partitionBy(price.isNull()).orderBy("full_date").rowsBetween(-199, W.currentRow)
    above = F.when(price.isNotNull(), F.coalesce(price > F.avg(price).over(latest), F.lit(False)))
    growth = "growth_asset_avg_return_1d"
    daily = daily.withColumn("sp500_above_sma_200_flag", above)
    daily = daily.select(*[c for c in daily.columns if c not in ("_index", growth)], growth)
    label = regime_label(
        F.col("sp500_return_1m"),
        F.col("sp500_above_sma_200_flag"),
        F.col("global_bond_return_1m"),
        F.col("gold_return_1m"),
        F.col("oil_return_1m"),
    )
    return daily.select(date_key("full_date").alias("date_key"), "*", label.alias("regime_label"))


def mart_fee_benchmarks(profile: DataFrame, assets: DataFrame, groups: DataFrame) -> DataFrame:
    """Fund fee against its group: average, range and percent rank (missing fees rank last).

    Funds with one fee share a rank, so funds are counted per (group, fee) first; ranks and group
    figures come from these counts and are joined back. A group (or the funds without one) of a third of all
    funds, even all at one fee, is a row per distinct fee there.
    """
    ter, code, n = F.col("ter"), F.col("equivalence_group_code"), F.col("n")
    funds = (
        profile.select("asset_key", "equivalence_group_code", "ter")
        .join(assets.select("asset_key", "ticker", "asset_name"), "asset_key")
        .join(groups.select("equivalence_group_code", "equivalence_group_name"), "equivalence_group_code", "left")
    )
    fees = funds.groupBy("equivalence_group_code", "ter").agg(F.count(F.lit(1)).alias("n"))
    group = W.partitionBy("equivalence_group_code")
    lower = group.orderBy(ter.asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    size = F.sum(n).over(group)
    known = F.sum(F.when(ter.isNotNull(), n)).over(group)
    ranked = fees.select(
        code.alias("_code"),
        ter.alias("_ter"),
        (F.sum(ter * n).over(group) / known).alias("group_avg_ter"),
        F.min("ter").over(group).alias("group_min_ter"),
        F.max("ter").over(group).alias("group_max_ter"),
        F.when(size > 1, F.coalesce(F.sum(n).over(lower), F.lit(0)) / (size - 1)).otherwise(0.0).alias("ter_percentile"),
    )
    same = code.eqNullSafe(F.col("_code")) & ter.eqNullSafe(F.col("_ter"))
    return funds.join(ranked, same).select(
        "asset_key",
        "ticker",
        "asset_name",
        "equivalence_group_code",
        "equivalence_group_name",
        "ter",
        "group_avg_ter",
        "group_min_ter",
        "group_max_ter",
        "ter_percentile",
    )


def fund_star(
    etf: DataFrame, profile: DataFrame, provider: DataFrame, index: DataFrame, group: DataFrame
) -> DataFrame:
    """Report attributes per fund, joined at fund grain.

    Fact rows never meet the provider, index or group keys, many of which may be missing:
    outer joins on them happen here, on one row per fund.
    """
    return (
        etf.select("etf_key", "provider_key", "index_key", "equivalence_group_key")
        .join(profile.select(F.col("asset_key").alias("etf_key"), "fund_name"), "etf_key", "left")
        .join(provider.select("provider_key", "provider_name"), "provider_key", "left")
        .join(index.select("index_key", "index_name"), "index_key", "left")
        .join(group.select("equivalence_group_key", "equivalence_group_name"), "equivalence_group_key", "left")
        .select("etf_key", "fund_name", "provider_name", "index_name", "equivalence_group_name")
    )


def daily_prices(fund_prices: DataFrame, funds: DataFrame) -> DataFrame:
    """Daily fund report: series measures of fund rows with the fund's attributes."""
    measured = series.measure(fund_prices, series.with_risk)
    return measured.join(funds, F.col("asset_key") == F.col("etf_key")).select(
        "full_date",
        "ticker",
        "fund_name",
        "provider_name",
        "index_name",
        "equivalence_group_name",
        "close_price",
        *[f"return_{h}" for h in series.HORIZONS],
        "volatility_30d",
        "drawdown_52w",
        F.col("sharpe_proxy_1y").alias("sharpe_proxy"),
    )
