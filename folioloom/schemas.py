"""Declared schemas of the raw tables; sources never infer them."""

from __future__ import annotations



ASSET_MASTER_COLUMNS = [
    "ticker", "asset_name", "asset_type", "asset_subtype", "region",
    "country", "currency", "provider_name", "exchange", "is_active",
]

PRICE_COLUMNS = ["ticker", "date", "open", "high", "low", "close", "adj_close", "volume"]

# landed sheet -> raw table
SHEETS = {
    "etf": "etf_metadata",
    "geography": "etf_geography",
    "sector": "etf_sector",
    "equivalence_groups": "equivalence_groups",
    "equivalence_group_relationships": "equivalence_group_relationships",
}

RAW_TABLES = ["asset_master", "asset_prices", *SHEETS.values()]

# DDL strings: usable before a session exists.
SHEET_TYPES = {
    "etf_metadata": {"ter": "double", "inception_date": "date"},
    "etf_geography": {"exposure_weight": "double"},
    "etf_sector": {"exposure_weight": "double"},
    "equivalence_groups": {},
    "equivalence_group_relationships": {"priority_rank": "int"},
}
SHEET_COLUMNS = {
    "etf_metadata": [
        "etf", "ticker", "isin", "fund_name", "provider", "index", "equivalence_group_code",
        "relationship_to_group", "asset_class", "category", "distribution_type",
        "replication_method", "currency", "domicile", "hedged_flag", "ucits_flag", "ter",
        "inception_date", "is_active", "notes",
    ],
    "etf_geography": ["etf", "geography", "exposure_weight"],
    "etf_sector": ["etf", "sector", "exposure_weight"],
    "equivalence_groups": [
        "equivalence_group_code", "equivalence_group_name", "group_type",
        "canonical_exposure", "description",
    ],
    "equivalence_group_relationships": [
        "source_group_code", "target_group_code", "relationship_type", "priority_rank", "notes",
    ],
}
SEED = "seed_id int, seed_name string, asset_group string, is_active boolean"
