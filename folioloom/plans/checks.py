"""The declared tests of the models."""

from __future__ import annotations

from folioloom.operators.quality import Check

WARN = "warn"


def _nulls(model: str, *columns: str) -> list[Check]:
    return [Check(model, "not_null", c) for c in columns]


def _uniques(model: str, *columns: str) -> list[Check]:
    return [Check(model, "unique", c) for c in columns]


def _between(model: str, column: str, minimum, maximum=None, strictly=False, nullable=True, severity="error"):
    options = {"minimum": minimum, "maximum": maximum, "strictly": strictly}
    if nullable:
        options["row_condition"] = f"{column} is not null"
    return Check(model, "between", column, severity, options)


def _compound(model: str, *columns: str) -> Check:
    return Check(model, "compound_unique", "_".join(columns), options={"columns": list(columns)})


def _rows(model: str, label: str, expression: str, row_condition: str) -> Check:
    return Check(
        model, "row_expression", label, options={"expression": expression, "row_condition": row_condition}
    )


def _accepted(model: str, column: str, *values: str) -> Check:
    return Check(model, "accepted_values", column, options={"values": list(values)})


def _exposure(model: str, category: str) -> list[Check]:
    return [
        _compound(model, "asset_key", category),
        Check(model, "weights_balance", "exposure_weight", WARN, {"group": "asset_key"}),
        *_nulls(model, "asset_key", category, "exposure_weight"),
        _between(model, "exposure_weight", 0, 100, nullable=False),
    ]


def declared_checks(as_of: str = "current_date") -> list[Check]:
    """All 87 tests; ``as_of`` is the SQL expression used for today."""
    prices, funds = "stg_asset_prices", "stg_etf_metadata"
    quoted = ["open_price", "high_price", "low_price", "adj_close_price"]
    bracket = "high_price is not null and low_price is not null"
    return [
        *_nulls("stg_asset_master", "asset_key", "ticker", "asset_type", "is_active"),
        *_uniques("stg_asset_master", "asset_key", "ticker"),
        _accepted("stg_asset_master", "asset_type", "ETF", "Stock", "Index", "FX", "Commodity", "Bond Proxy"),
        _compound(prices, "asset_key", "full_date"),
        _rows(prices, "range", "high_price >= low_price", bracket),
        _rows(prices, "open_in_range", "high_price >= open_price and low_price <= open_price",
              f"open_price is not null and {bracket}"),
        _rows(prices, "close_in_range", "high_price >= close_price and low_price <= close_price",
              f"close_price is not null and {bracket}"),
        *_nulls(prices, "date_key", "asset_key", "full_date", "close_price", "price_for_returns"),
        Check(prices, "recent", "full_date", WARN, {"max_age_days": 7}),
        *[_between(prices, c, 0, strictly=True) for c in quoted],
        _between(prices, "close_price", 0, strictly=True, nullable=False),
        _between(prices, "price_for_returns", 0, strictly=True, nullable=False),
        _between(prices, "volume", 0),
        _rows(funds, "inception_date", f"inception_date <= {as_of}", "inception_date is not null"),
        *_nulls(funds, "asset_key", "ticker", "equivalence_group_code"),
        *_uniques(funds, "asset_key"),
        Check(funds, "relationships", "equivalence_group_code",
              options={"to": "stg_equivalence_group", "field": "equivalence_group_code"}),
        _between(funds, "ter", 0, 5, severity=WARN),
        Check(funds, "not_null", "is_active", WARN),
        *_exposure("stg_etf_geography", "geography_name"),
        *_exposure("stg_etf_sector", "sector_name"),
        *_nulls("stg_equivalence_group", "equivalence_group_code"),
        *_uniques("stg_equivalence_group", "equivalence_group_code"),
        _compound("stg_equivalence_group_relationships", "source_group_code", "target_group_code"),
        *_nulls("stg_equivalence_group_relationships", "source_group_code", "target_group_code"),
        *_nulls("dim_asset", "asset_key", "ticker"),
        *_uniques("dim_asset", "asset_key", "ticker"),
        *_nulls("dim_date", "date_key", "full_date"),
        *_uniques("dim_date", "date_key", "full_date"),
        *_nulls("dim_asset_classification", "asset_key"),
        *_uniques("dim_asset_classification", "asset_key"),
        *_nulls("dim_etf_profile", "asset_key", "equivalence_group_code"),
        *_uniques("dim_etf_profile", "asset_key"),
        *_nulls("int_asset_returns", "asset_key", "full_date"),
        *_nulls("dim_equivalence_group", "equivalence_group_key"),
        *_uniques("dim_equivalence_group", "equivalence_group_key"),
        *_nulls("dim_etf", "etf_key", "ticker"),
        *_uniques("dim_etf", "etf_key", "ticker"),
        _compound("fact_asset_price_daily", "date_key", "asset_key"),
        *_nulls("fact_asset_price_daily", "date_key", "asset_key"),
        _compound("fact_etf_daily", "date_key", "etf_key"),
        _between("mart_asset_trend", "trend_score", 0, 2, nullable=False),
        _accepted("mart_asset_trend", "trend_label", "Uptrend", "Downtrend", "Mixed"),
        _accepted("mart_asset_moves", "move_direction", "Up", "Down", "Flat"),
        _accepted("mart_market_regime", "regime_label", "Risk On", "Defensive", "Inflationary", "Mixed"),
        _between("mart_etf_overlap", "sector_overlap_score", 0, 100),
        _between("mart_etf_overlap", "geography_overlap_score", 0, 100),
        _between("mart_etf_overlap", "blended_overlap_score", 0, 100, nullable=False),
        _between("mart_fee_benchmarks", "ter_percentile", 0, 1),
        *_nulls("daily_prices", "full_date", "ticker"),
        *_nulls("demo_seed", "seed_id", "seed_name"),
        *_uniques("demo_seed", "seed_id"),
    ]
