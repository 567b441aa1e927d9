"""Scoped views and the recurring analyst questions over active UCITS funds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ucits_funds(etf: DataFrame) -> DataFrame:
    """Funds flagged UCITS (missing counts as no) and active (missing counts as yes)."""
    listed = F.coalesce("ucits_flag", F.lit(False)) & F.coalesce("is_active", F.lit(True))
    return etf.filter(listed)


def ucits_scope(df: DataFrame, etf: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is a fund in scope."""
    funds = ucits_funds(etf).select(F.col("etf_key").alias("_fund"))
    return df.join(funds, F.col(key) == F.col("_fund"), "left_semi")


def latest_year(df: DataFrame, date: str = "full_date") -> DataFrame:
    """Rows of the newest twelve months present; the bound is a scalar subquery."""
    newest = df.select(F.max(date).alias("d")).scalar()
    return df.filter(F.col(date) > F.add_months(newest, -12))


def _named(etf: DataFrame, tickers: list[str] | None) -> DataFrame:
    return etf if tickers is None else etf.filter(F.col("ticker").isin(tickers))


def compare_funds(fund_days: DataFrame, etf: DataFrame, tickers: list[str] | None = None) -> DataFrame:
    """Latest one-year return, volatility and drawdown of each fund beside its fee."""
    funds = _named(etf, tickers).select("etf_key", "ticker", "ter")
    day = "date_key"
    latest = (
        fund_days.join(funds.select("etf_key"), "etf_key", "left_semi")
        .groupBy("etf_key")
        .agg(
            F.max(day).alias("as_of_date_key"),
            F.max_by("return_1y", day).alias("return_1y"),
            F.max_by("volatility_30d", day).alias("volatility_30d"),
            F.max_by("drawdown_52w", day).alias("drawdown_52w"),
        )
    )
    return latest.join(funds, "etf_key").select(
        "ticker", "as_of_date_key", "return_1y", "volatility_30d", "drawdown_52w", "ter"
    )


def price_range(prices: DataFrame, etf: DataFrame, tickers: list[str] | None = None) -> DataFrame:
    """Latest close and the high and low of the newest twelve months, per fund."""
    funds = _named(etf, tickers).select(F.col("etf_key").alias("asset_key"), "ticker")
    year = latest_year(prices.join(funds.select("asset_key"), "asset_key", "left_semi"))
    ranged = year.groupBy("asset_key").agg(
        F.max("full_date").alias("latest_date"),
        F.max_by("close_price", "full_date").alias("latest_close"),
        F.max("high_price").alias("high_12m"),
        F.min("low_price").alias("low_12m"),
    )
    return ranged.join(funds, "asset_key").drop("asset_key")


def peer_group(etf: DataFrame, group: DataFrame, asked: DataFrame) -> DataFrame:
    """Group of each asked fund (column ``ticker``) with one row per member; the asked fund is marked.

    The result has as many rows as the asked funds' groups have members; only the asked side multiplies them.
    """
    members = etf.select("equivalence_group_key", F.col("ticker").alias("peer_ticker"), F.col("ter").alias("peer_ter"))
    names = group.select("equivalence_group_key", "equivalence_group_code", "equivalence_group_name")
    wanted = etf.join(asked.select("ticker").distinct(), "ticker", "left_semi").select("ticker", "equivalence_group_key")
    return (
        wanted.join(names, "equivalence_group_key")
        .join(members, "equivalence_group_key")
        .select(
            "ticker",
            "equivalence_group_code",
            "equivalence_group_name",
            "peer_ticker",
            "peer_ter",
            (F.col("ticker") == F.col("peer_ticker")).alias("is_self"),
        )
    )


def exposures(
    etf: DataFrame, bridge_sector: DataFrame, sector: DataFrame, bridge_geography: DataFrame,
    geography: DataFrame, tickers: list[str] | None = None,
) -> DataFrame:
    """Sector and geography weights of each asked fund in one list."""
    funds = _named(etf, tickers).select("etf_key", "ticker")

    def side(bridge: DataFrame, dim: DataFrame, key: str, name: str, kind: str) -> DataFrame:
        return (
            bridge.join(funds, "etf_key")
            .join(dim.select(key, name), key)
            .select(
                "ticker", F.lit(kind).alias("exposure_type"), F.col(name).alias("exposure_name"), "exposure_weight"
            )
        )

    return side(bridge_sector, sector, "sector_key", "sector_name", "sector").unionByName(
        side(bridge_geography, geography, "geography_key", "geography_name", "geography")
    )
