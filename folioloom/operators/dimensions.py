"""Dimensions and bridges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.functions import calendar as cal
from folioloom.functions.text import first_match, lookup

# Display names and region flags of known benchmark codes.
INDEX_NAMES = {
    "FTSE_ALL_WORLD": "FTSE All-World",
    "S&P_500": "S&P 500",
    "MSCI_ACWI": "MSCI ACWI",
    "FTSE_EMERGING": "FTSE Emerging",
    "BLOOMBERG_GLOBAL_AGGREGATE": "Bloomberg Global Aggregate",
}
INDEX_FAMILIES = {"FTSE": "FTSE", "MSCI": "MSCI", "S&P": "S&P", "BLOOMBERG": "Bloomberg"}
DEVELOPED = ["FTSE_ALL_WORLD", "MSCI_ACWI", "S&P_500", "BLOOMBERG_GLOBAL_AGGREGATE"]
EMERGING = ["FTSE_ALL_WORLD", "MSCI_ACWI", "FTSE_EMERGING"]
NOT_EMERGING = ["S&P_500", "BLOOMBERG_GLOBAL_AGGREGATE"]
GEOGRAPHY_GROUPS = {"US": "North America", "UK": "Europe", "Developed ex-US": "Developed Markets"}
MACRO_TYPES = ["Index", "FX", "Commodity", "Bond Proxy"]


def dim_asset(assets: DataFrame, prices: DataFrame) -> DataFrame:
    seen = prices.groupBy("asset_key").agg(
        F.min("full_date").alias("first_seen_date"), F.max("full_date").alias("last_seen_date")
    )
    return assets.join(seen, "asset_key", "left")


def dim_date(prices: DataFrame) -> DataFrame:
    """Every calendar day of the price history; the spine grows with the span, not the rows."""
    traded = prices.select("full_date").distinct().withColumn("traded", F.lit(True))
    # over the distinct days, so that both uses share one exchange
    span = traded.agg(F.min("full_date").alias("a"), F.max("full_date").alias("b"))
    # no prices: min is NULL and explode drops the row
    spine = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("full_date"))
    d = F.col("full_date")
    return spine.join(traded, "full_date", "left").select(
        cal.date_key(d).alias("date_key"),
        d,
        cal.day_name(d).alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_number"),
        cal.month_name(d).alias("month_name"),
        F.quarter(d).alias("quarter_number"),
        F.year(d).alias("year_number"),
        (d == F.last_day(d)).alias("month_end_flag"),
        (d == cal.quarter_end(d)).alias("quarter_end_flag"),
        (d == cal.year_end(d)).alias("year_end_flag"),
        F.coalesce("traded", F.lit(False)).alias("trading_day_flag"),
    )


def calendar_range(bounds: DataFrame, as_of: dt.date | Column) -> DataFrame:
    """Extended calendar over ``bounds`` (one row: start, end); ``as_of`` marks today."""
    d = F.col("date_key")
    today = as_of if isinstance(as_of, Column) else F.lit(as_of)
    sunday_based = F.dayofweek(d) - 1
    spine = bounds.select(F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("date_key"))
    return spine.select(
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        cal.month_name(d).alias("month_name"),
        F.date_format(d, "MMM").alias("month_name_short"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.weekofyear(d).alias("week_of_year"),
        cal.iso_week_label(d).alias("iso_year_week"),
        F.trunc(d, "week").alias("week_start_date"),
        sunday_based.alias("day_of_week"),
        cal.day_name(d).alias("day_name"),
        F.date_format(d, "EEE").alias("day_name_short"),
        sunday_based.isin(0, 6).cast("int").alias("is_weekend"),
        (d == today).cast("int").alias("is_today"),
        F.trunc(d, "month").alias("month_start_date"),
        F.trunc(d, "quarter").alias("quarter_start_date"),
        F.trunc(d, "year").alias("year_start_date"),
    )


def _band(value: Column, bands: list[tuple[Column, str]], last: str) -> Column:
    return F.when(value.isNotNull(), first_match(bands, last))


def dim_asset_classification(assets: DataFrame, measured: DataFrame) -> DataFrame:
    """Role and risk buckets from each asset's latest measured day.

    ``measured`` holds the risk and trend columns of ``series.risk_and_trend``. The latest row is
    an aggregate (``max_by``), combined map-side, so no asset's history is sorted for it.
    """
    latest = measured.groupBy("asset_key").agg(
        F.max_by("volatility_30d", "full_date").alias("vol"),
        F.max_by("drawdown_52w", "full_date").alias("dd"),
        F.max_by("trend_label", "full_date").alias("trend_category"),
    )
    kind, vol, dd = F.col("asset_type"), F.col("vol"), F.col("dd")
    subtype = F.lower(F.coalesce("asset_subtype", F.lit("")))
    role = first_match(
        [
            (kind.isin(MACRO_TYPES), "Macro Indicator"),
            ((kind == "ETF") & subtype.contains("bond"), "Defensive"),
            (kind == "ETF", "Core"),
            (kind == "Stock", "Growth"),
        ],
        "Satellite",
    )
    core = first_match([(subtype.contains("global"), "Core")], "Satellite")
    return assets.join(latest, "asset_key", "left").select(
        "asset_key",
        role.alias("role"),
        _band(vol, [(vol < 0.10, "Low"), (vol < 0.20, "Medium")], "High").alias("risk_band"),
        _band(vol, [(vol < 0.10, "Low Vol"), (vol < 0.20, "Mid Vol")], "High Vol").alias("volatility_bucket"),
        _band(dd, [(dd > -0.10, "Shallow"), (dd > -0.20, "Moderate")], "Deep").alias("drawdown_bucket"),
        "trend_category",
        F.when(kind == "ETF", core).alias("core_satellite_flag"),
        F.lit(None).cast("string").alias("notes"),
    )


def dim_etf_profile(metadata: DataFrame) -> DataFrame:
    return metadata.select(
        "asset_key", "ticker", *[c for c in metadata.columns if c not in ("asset_key", "ticker", "asset_name")]
    )


def dim_provider(profile: DataFrame) -> DataFrame:
    names = profile.select("provider_name").filter("provider_name is not null").distinct()
    return names.select(
        F.md5(F.lower("provider_name")).alias("provider_key"),
        "provider_name",
        F.col("provider_name").alias("provider_group"),
        F.lit(None).cast("string").alias("provider_country"),
    )


def dim_index(profile: DataFrame) -> DataFrame:
    code = F.col("index_code")
    # '_' in these patterns is the LIKE wildcard, so FTSEX counts as FTSE
    family = first_match(
        [(code.like(f"{prefix}_%"), name) for prefix, name in INDEX_FAMILIES.items()],
        F.split_part(code, F.lit("_"), F.lit(1)),
    )
    emerging_name = code.like("%EMERGING%")
    world = code.like("%ALL_WORLD%") | code.contains("ACWI") | code.contains("GLOBAL")
    return (
        profile.filter(code.isNotNull())
        .groupBy("index_code")
        .agg(F.min("asset_class").alias("asset_class"))
        .select(
            F.md5(code).alias("index_key"),
            F.coalesce(lookup("index_code", INDEX_NAMES), F.replace(code, F.lit("_"), F.lit(" "))).alias(
                "index_name"
            ),
            family.alias("index_family"),
            first_match(
                [(code == "S&P_500", "US"), (emerging_name, "Emerging Markets"), (world, "Global")], "Other"
            ).alias("broad_region_type"),
            first_match([(code.isin(DEVELOPED), True), (emerging_name, False)]).alias("developed_flag"),
            first_match(
                [(code.isin(EMERGING), True), (code.isin(NOT_EMERGING), False), (emerging_name, True)]
            ).alias("emerging_flag"),
            "asset_class",
            code,
        )
    )


def dim_equivalence_group(groups: DataFrame) -> DataFrame:
    return groups.select(
        F.md5("equivalence_group_code").alias("equivalence_group_key"),
        "equivalence_group_code",
        "equivalence_group_name",
        "group_type",
        "description",
        "canonical_exposure",
    )


def dim_etf(profile: DataFrame, assets: DataFrame) -> DataFrame:
    asset = assets.select("asset_key", F.col("ticker").alias("asset_ticker"), "asset_name")
    kept = ["asset_class", "category", "distribution_type", "replication_method", "currency",
            "domicile", "hedged_flag", "ucits_flag", "ter", "inception_date", "is_active"]
    return profile.join(asset, "asset_key").select(
        F.col("asset_key").alias("etf_key"),
        "etf_code",
        F.col("asset_ticker").alias("ticker"),
        "isin",
        F.coalesce("fund_name", "asset_name").alias("fund_name"),
        F.md5(F.lower("provider_name")).alias("provider_key"),
        F.md5("index_code").alias("index_key"),
        F.md5("equivalence_group_code").alias("equivalence_group_key"),
        *kept,
    )


def dim_geography(geography: DataFrame) -> DataFrame:
    name = F.col("geography_name")
    group = F.coalesce(
        lookup("geography_name", GEOGRAPHY_GROUPS),
        F.when(F.lower(name).contains("emerging"), "Emerging Markets"),
        F.lit("Other"),
    )
    return (
        geography.select(name)
        .distinct()
        .select(F.md5(F.lower(name)).alias("geography_key"), name, group.alias("geography_group"))
    )


def dim_sector(sector: DataFrame) -> DataFrame:
    name = F.col("sector_name")
    return sector.select(name).distinct().select(F.md5(F.lower(name)).alias("sector_key"), name)


def _bridge(exposure: DataFrame, profile: DataFrame, name: str, key: str) -> DataFrame:
    """Exposures of funds with a profile; the dimension's key is a hash of the name, so it needs no join."""
    return (
        exposure.filter(F.col(name).isNotNull())
        .select("asset_key", F.md5(F.lower(name)).alias(key), "exposure_weight")
        .join(profile.select("asset_key"), "asset_key")
        .select(F.col("asset_key").alias("etf_key"), key, "exposure_weight")
    )


def bridge_etf_geography(geography: DataFrame, profile: DataFrame) -> DataFrame:
    return _bridge(geography, profile, "geography_name", "geography_key")


def bridge_etf_sector(sector: DataFrame, profile: DataFrame) -> DataFrame:
    return _bridge(sector, profile, "sector_name", "sector_key")
