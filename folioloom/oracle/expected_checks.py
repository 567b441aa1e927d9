"""The 87 tests the suite must hold, spelled out apart from the engine's own declarations.

Fixed values: model, name of the test, severity, and the condition (or grouping) of its failing rows.
"""

EXPECTED = [
    ("stg_asset_master", "not_null_stg_asset_master_asset_key", "error", "asset_key is null"),
    ("stg_asset_master", "not_null_stg_asset_master_ticker", "error", "ticker is null"),
    ("stg_asset_master", "not_null_stg_asset_master_asset_type", "error", "asset_type is null"),
    ("stg_asset_master", "not_null_stg_asset_master_is_active", "error", "is_active is null"),
    ("stg_asset_master", "unique_stg_asset_master_asset_key", "error", "asset_key is not null group by asset_key having count(*) > 1"),
    ("stg_asset_master", "unique_stg_asset_master_ticker", "error", "ticker is not null group by ticker having count(*) > 1"),
    ("stg_asset_master", "accepted_values_stg_asset_master_asset_type", "error", "asset_type not in ('ETF', 'Stock', 'Index', 'FX', 'Commodity', 'Bond Proxy')"),
    ("stg_asset_prices", "compound_unique_stg_asset_prices_asset_key_full_date", "error", "true group by asset_key, full_date having count(*) > 1"),
    ("stg_asset_prices", "row_expression_stg_asset_prices_range", "error", "high_price is not null and low_price is not null and not (high_price >= low_price)"),
    ("stg_asset_prices", "row_expression_stg_asset_prices_open_in_range", "error", "open_price is not null and high_price is not null and low_price is not null and not (high_price >= open_price and low_price <= open_price)"),
    ("stg_asset_prices", "row_expression_stg_asset_prices_close_in_range", "error", "close_price is not null and high_price is not null and low_price is not null and not (high_price >= close_price and low_price <= close_price)"),
    ("stg_asset_prices", "not_null_stg_asset_prices_date_key", "error", "date_key is null"),
    ("stg_asset_prices", "not_null_stg_asset_prices_asset_key", "error", "asset_key is null"),
    ("stg_asset_prices", "not_null_stg_asset_prices_full_date", "error", "full_date is null"),
    ("stg_asset_prices", "not_null_stg_asset_prices_close_price", "error", "close_price is null"),
    ("stg_asset_prices", "not_null_stg_asset_prices_price_for_returns", "error", "price_for_returns is null"),
    ("stg_asset_prices", "recent_stg_asset_prices_full_date", "warn", "true having max(full_date) < {as_of} - 7"),
    ("stg_asset_prices", "between_stg_asset_prices_open_price", "error", "open_price <= 0"),
    ("stg_asset_prices", "between_stg_asset_prices_high_price", "error", "high_price <= 0"),
    ("stg_asset_prices", "between_stg_asset_prices_low_price", "error", "low_price <= 0"),
    ("stg_asset_prices", "between_stg_asset_prices_adj_close_price", "error", "adj_close_price <= 0"),
    ("stg_asset_prices", "between_stg_asset_prices_close_price", "error", "close_price <= 0"),
    ("stg_asset_prices", "between_stg_asset_prices_price_for_returns", "error", "price_for_returns <= 0"),
    ("stg_asset_prices", "between_stg_asset_prices_volume", "error", "volume < 0"),
    ("stg_etf_metadata", "row_expression_stg_etf_metadata_inception_date", "error", "inception_date is not null and not (inception_date <= {as_of})"),
    ("stg_etf_metadata", "not_null_stg_etf_metadata_asset_key", "error", "asset_key is null"),
    ("stg_etf_metadata", "not_null_stg_etf_metadata_ticker", "error", "ticker is null"),
    ("stg_etf_metadata", "not_null_stg_etf_metadata_equivalence_group_code", "error", "equivalence_group_code is null"),
    ("stg_etf_metadata", "unique_stg_etf_metadata_asset_key", "error", "asset_key is not null group by asset_key having count(*) > 1"),
    ("stg_etf_metadata", "relationships_stg_etf_metadata_equivalence_group_code", "error", "equivalence_group_code not in (select equivalence_group_code from stg_equivalence_group)"),
    ("stg_etf_metadata", "between_stg_etf_metadata_ter", "warn", "ter < 0 or ter > 5"),
    ("stg_etf_metadata", "not_null_stg_etf_metadata_is_active", "warn", "is_active is null"),
    ("stg_etf_geography", "compound_unique_stg_etf_geography_asset_key_geography_name", "error", "true group by asset_key, geography_name having count(*) > 1"),
    ("stg_etf_geography", "weights_balance_stg_etf_geography_exposure_weight", "warn", "true group by asset_key having abs(sum(exposure_weight) - 1) > 0.01 and abs(sum(exposure_weight) - 100) > 1"),
    ("stg_etf_geography", "not_null_stg_etf_geography_asset_key", "error", "asset_key is null"),
    ("stg_etf_geography", "not_null_stg_etf_geography_geography_name", "error", "geography_name is null"),
    ("stg_etf_geography", "not_null_stg_etf_geography_exposure_weight", "error", "exposure_weight is null"),
    ("stg_etf_geography", "between_stg_etf_geography_exposure_weight", "error", "exposure_weight < 0 or exposure_weight > 100"),
    ("stg_etf_sector", "compound_unique_stg_etf_sector_asset_key_sector_name", "error", "true group by asset_key, sector_name having count(*) > 1"),
    ("stg_etf_sector", "weights_balance_stg_etf_sector_exposure_weight", "warn", "true group by asset_key having abs(sum(exposure_weight) - 1) > 0.01 and abs(sum(exposure_weight) - 100) > 1"),
    ("stg_etf_sector", "not_null_stg_etf_sector_asset_key", "error", "asset_key is null"),
    ("stg_etf_sector", "not_null_stg_etf_sector_sector_name", "error", "sector_name is null"),
    ("stg_etf_sector", "not_null_stg_etf_sector_exposure_weight", "error", "exposure_weight is null"),
    ("stg_etf_sector", "between_stg_etf_sector_exposure_weight", "error", "exposure_weight < 0 or exposure_weight > 100"),
    ("stg_equivalence_group", "not_null_stg_equivalence_group_equivalence_group_code", "error", "equivalence_group_code is null"),
    ("stg_equivalence_group", "unique_stg_equivalence_group_equivalence_group_code", "error", "equivalence_group_code is not null group by equivalence_group_code having count(*) > 1"),
    ("stg_equivalence_group_relationships", "compound_unique_stg_equivalence_group_relationships_source_group_code_target_group_code", "error", "true group by source_group_code, target_group_code having count(*) > 1"),
    ("stg_equivalence_group_relationships", "not_null_stg_equivalence_group_relationships_source_group_code", "error", "source_group_code is null"),
    ("stg_equivalence_group_relationships", "not_null_stg_equivalence_group_relationships_target_group_code", "error", "target_group_code is null"),
    ("dim_asset", "not_null_dim_asset_asset_key", "error", "asset_key is null"),
    ("dim_asset", "not_null_dim_asset_ticker", "error", "ticker is null"),
    ("dim_asset", "unique_dim_asset_asset_key", "error", "asset_key is not null group by asset_key having count(*) > 1"),
    ("dim_asset", "unique_dim_asset_ticker", "error", "ticker is not null group by ticker having count(*) > 1"),
    ("dim_date", "not_null_dim_date_date_key", "error", "date_key is null"),
    ("dim_date", "not_null_dim_date_full_date", "error", "full_date is null"),
    ("dim_date", "unique_dim_date_date_key", "error", "date_key is not null group by date_key having count(*) > 1"),
    ("dim_date", "unique_dim_date_full_date", "error", "full_date is not null group by full_date having count(*) > 1"),
    ("dim_asset_classification", "not_null_dim_asset_classification_asset_key", "error", "asset_key is null"),
    ("dim_asset_classification", "unique_dim_asset_classification_asset_key", "error", "asset_key is not null group by asset_key having count(*) > 1"),
    ("dim_etf_profile", "not_null_dim_etf_profile_asset_key", "error", "asset_key is null"),
    ("dim_etf_profile", "not_null_dim_etf_profile_equivalence_group_code", "error", "equivalence_group_code is null"),
    ("dim_etf_profile", "unique_dim_etf_profile_asset_key", "error", "asset_key is not null group by asset_key having count(*) > 1"),
    ("int_asset_returns", "not_null_int_asset_returns_asset_key", "error", "asset_key is null"),
    ("int_asset_returns", "not_null_int_asset_returns_full_date", "error", "full_date is null"),
    ("dim_equivalence_group", "not_null_dim_equivalence_group_equivalence_group_key", "error", "equivalence_group_key is null"),
    ("dim_equivalence_group", "unique_dim_equivalence_group_equivalence_group_key", "error", "equivalence_group_key is not null group by equivalence_group_key having count(*) > 1"),
    ("dim_etf", "not_null_dim_etf_etf_key", "error", "etf_key is null"),
    ("dim_etf", "not_null_dim_etf_ticker", "error", "ticker is null"),
    ("dim_etf", "unique_dim_etf_etf_key", "error", "etf_key is not null group by etf_key having count(*) > 1"),
    ("dim_etf", "unique_dim_etf_ticker", "error", "ticker is not null group by ticker having count(*) > 1"),
    ("fact_asset_price_daily", "compound_unique_fact_asset_price_daily_date_key_asset_key", "error", "true group by date_key, asset_key having count(*) > 1"),
    ("fact_asset_price_daily", "not_null_fact_asset_price_daily_date_key", "error", "date_key is null"),
    ("fact_asset_price_daily", "not_null_fact_asset_price_daily_asset_key", "error", "asset_key is null"),
    ("fact_etf_daily", "compound_unique_fact_etf_daily_date_key_etf_key", "error", "true group by date_key, etf_key having count(*) > 1"),
    ("mart_asset_trend", "between_mart_asset_trend_trend_score", "error", "trend_score < 0 or trend_score > 2"),
    ("mart_asset_trend", "accepted_values_mart_asset_trend_trend_label", "error", "trend_label not in ('Uptrend', 'Downtrend', 'Mixed')"),
    ("mart_asset_moves", "accepted_values_mart_asset_moves_move_direction", "error", "move_direction not in ('Up', 'Down', 'Flat')"),
    ("mart_market_regime", "accepted_values_mart_market_regime_regime_label", "error", "regime_label not in ('Risk On', 'Defensive', 'Inflationary', 'Mixed')"),
    ("mart_etf_overlap", "between_mart_etf_overlap_sector_overlap_score", "error", "sector_overlap_score < 0 or sector_overlap_score > 100"),
    ("mart_etf_overlap", "between_mart_etf_overlap_geography_overlap_score", "error", "geography_overlap_score < 0 or geography_overlap_score > 100"),
    ("mart_etf_overlap", "between_mart_etf_overlap_blended_overlap_score", "error", "blended_overlap_score < 0 or blended_overlap_score > 100"),
    ("mart_fee_benchmarks", "between_mart_fee_benchmarks_ter_percentile", "error", "ter_percentile < 0 or ter_percentile > 1"),
    ("daily_prices", "not_null_daily_prices_full_date", "error", "full_date is null"),
    ("daily_prices", "not_null_daily_prices_ticker", "error", "ticker is null"),
    ("demo_seed", "not_null_demo_seed_seed_id", "error", "seed_id is null"),
    ("demo_seed", "not_null_demo_seed_seed_name", "error", "seed_name is null"),
    ("demo_seed", "unique_demo_seed_seed_id", "error", "seed_id is not null group by seed_id having count(*) > 1"),
]
