"""Staging models: typing, cleaning and joining of the raw tables.

Joins here go from a large side to the asset or fund universe. None carries a broadcast
hint: the optimiser broadcasts the universe while its measured size is under the session
threshold and otherwise shuffles, where adaptive skew handling splits a hot asset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.functions.calendar import date_key
from folioloom.functions.numeric import positive
from folioloom.functions.text import canonical, clean, clean_lower, clean_upper, yes_no

# Canonical spellings.
ASSET_TYPES = ["ETF", "Stock", "Index", "FX", "Commodity", "Bond Proxy"]
PROVIDERS = ["Vanguard", "iShares", "Invesco", "SPDR", "Amundi", "L&G"]

ASSET_ATTRIBUTES = [
    "asset_name", "asset_type", "asset_subtype", "region", "country", "currency", "exchange",
]


def stg_asset_master(asset_master: DataFrame) -> DataFrame:
    ticker = clean_upper("ticker")
    active = F.coalesce(F.col("is_active").cast("boolean"), F.lit(True))
    texts = ["asset_subtype", "region", "country", "currency", "provider_name", "exchange"]
    return asset_master.filter(ticker.isNotNull() & active).select(
        F.md5(ticker).alias("asset_key"),
        ticker.alias("ticker"),
        clean("asset_name").alias("asset_name"),
        canonical("asset_type", ASSET_TYPES).alias("asset_type"),
        *[clean(c).alias(c) for c in texts],
        active.alias("is_active"),
    )


def stg_asset_prices(asset_prices: DataFrame, assets: DataFrame) -> DataFrame:
    """One cleaned bar per asset and day; the day's range is widened to include open and close."""
    bars = asset_prices.select(
        F.col("date").cast("date").alias("full_date"),
        F.upper(F.col("ticker").cast("string")).alias("ticker"),
        positive("open").alias("open_price"),
        positive("high").alias("reported_high"),
        positive("low").alias("reported_low"),
        positive("close").alias("close_price"),
        positive("adj_close").alias("adj_close_price"),
        F.col("volume").cast("double").alias("volume"),
    ).filter(F.col("full_date").isNotNull() & F.col("close_price").isNotNull())
    quotes = ["reported_high", "reported_low", "open_price", "close_price"]
    universe = assets.select("asset_key", "ticker", *ASSET_ATTRIBUTES)
    return bars.join(universe, "ticker").select(
        date_key("full_date").alias("date_key"),
        "full_date",
        "asset_key",
        "ticker",
        *ASSET_ATTRIBUTES,
        "open_price",
        F.greatest(*quotes).alias("high_price"),
        F.least(*quotes).alias("low_price"),
        "close_price",
        "adj_close_price",
        F.coalesce("adj_close_price", "close_price").alias("price_for_returns"),
        "volume",
    )


def stg_etf_metadata(etf_metadata: DataFrame, assets: DataFrame) -> DataFrame:
    index_code = clean("index")
    as_text = ["asset_class", "category", "distribution_type", "replication_method", "currency", "domicile"]
    funds = etf_metadata.filter(clean("etf").isNotNull()).select(
        F.upper(F.col("ticker").cast("string")).alias("ticker"),
        clean_upper("etf").alias("etf_code"),
        clean("isin").alias("isin"),
        clean("fund_name").alias("fund_name"),
        canonical("provider", PROVIDERS).alias("provider_name"),
        index_code.alias("index_code"),
        F.replace(index_code, F.lit("_"), F.lit(" ")).alias("index_name"),
        clean_lower("equivalence_group_code").alias("equivalence_group_code"),
        clean_lower("relationship_to_group").alias("relationship_to_group"),
        *[clean(c).alias(c) for c in as_text],
        yes_no("hedged_flag").alias("hedged_flag"),
        yes_no("ucits_flag").alias("ucits_flag"),
        F.col("ter").cast("double").alias("ter"),
        F.col("inception_date").cast("date").alias("inception_date"),
        yes_no("is_active").alias("is_active"),
        clean("notes").alias("notes"),
    )
    attributes = [c for c in funds.columns if c not in ("ticker", "etf_code")]
    return funds.join(assets.select("asset_key", "ticker", "asset_name"), "ticker").select(
        "asset_key", "etf_code", "ticker", "asset_name", *attributes
    )


def stg_etf(metadata: DataFrame) -> DataFrame:
    return metadata.drop("asset_key", "asset_name", "index_name")


def _exposure(raw: DataFrame, metadata: DataFrame, category: str, name: str) -> DataFrame:
    rows = raw.select(
        F.upper(F.col("etf").cast("string")).alias("etf_code"),
        clean(category).alias(name),
        F.col("exposure_weight").cast("double").alias("exposure_weight"),
    ).filter(F.col(name).isNotNull())
    return rows.join(metadata.select("asset_key", "etf_code", "ticker"), "etf_code").select(
        "asset_key", "etf_code", "ticker", name, "exposure_weight"
    )


def stg_etf_geography(etf_geography: DataFrame, metadata: DataFrame) -> DataFrame:
    return _exposure(etf_geography, metadata, "geography", "geography_name")


def stg_etf_sector(etf_sector: DataFrame, metadata: DataFrame) -> DataFrame:
    return _exposure(etf_sector, metadata, "sector", "sector_name")


def stg_geography(geography: DataFrame) -> DataFrame:
    return geography.select("etf_code", "geography_name", "exposure_weight")


def stg_sector(sector: DataFrame) -> DataFrame:
    return sector.select("etf_code", "sector_name", "exposure_weight")


def stg_equivalence_group(groups: DataFrame) -> DataFrame:
    code = clean_lower("equivalence_group_code")
    return groups.filter(code.isNotNull()).select(
        code.alias("equivalence_group_code"),
        clean("equivalence_group_name").alias("equivalence_group_name"),
        clean_lower("group_type").alias("group_type"),
        clean("canonical_exposure").alias("canonical_exposure"),
        clean("description").alias("description"),
    )


def stg_equivalence_group_relationships(relationships: DataFrame) -> DataFrame:
    source, target = clean_lower("source_group_code"), clean_lower("target_group_code")
    return relationships.filter(source.isNotNull() & target.isNotNull()).select(
        source.alias("source_group_code"),
        target.alias("target_group_code"),
        clean_lower("relationship_type").alias("relationship_type"),
        F.col("priority_rank").cast("int").alias("priority_rank"),
        clean("notes").alias("notes"),
    )


def stg_yfinance(prices: DataFrame) -> DataFrame:
    return prices.select(
        "ticker",
        F.col("full_date").alias("trading_date"),
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "adj_close_price",
        "volume",
    )
