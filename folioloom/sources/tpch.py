"""Raw contract tables derived from order-line tables.

A brand plays the part of an asset and a ship date that of a trading day, so ``lineitem``
grows with the data while everything downstream sees at most one bar per brand and day.
Line detail is reduced by a map-side partial aggregation on (brand, day) before any row
is exchanged: a brand holding a third of all lines costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Declared, so that a read touches no file before it runs.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
}

# Fixed values of the mapping (see FIXTURES.md part A).
REGION_NAMES = {
    "AMERICA": "US",
    "EUROPE": "UK",
    "ASIA": "Emerging Asia",
    "AFRICA": "Emerging Africa",
    "MIDDLE EAST": "Developed ex-US",
}
INDEX_CODES = {
    1: "FTSE_ALL_WORLD", 2: "S&P_500", 3: "MSCI_ACWI", 4: "FTSE_EMERGING",
    5: "BLOOMBERG_GLOBAL_AGGREGATE", 6: "FTSEX", 8: "STOXX_600", 9: "S&P_500", 10: "MSCI_ACWI",
}
REGIME_TICKERS = {
    "equity_index": "BRAND#16",
    "bond": "BRAND#1",
    "gold": "BRAND#22",
    "oil": "BRAND#23",
    "fx": "FX19=X",
}

BRAND_NO = "cast(split_part(p_brand, '#', 2) as int)"
FUNDS = "n between 1 and 10"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _ticker(n: str) -> str:
    return f"if({n} between 19 and 21, concat('FX', {n}, '=X'), upper(p_brand))"


def _pick(*options: str) -> str:
    """Option at position n modulo the number of options."""
    listed = ", ".join(f"'{o}'" for o in options)
    return f"element_at(array({listed}), n % {len(options)} + 1)"


def _map(pairs: dict, key: str) -> str:
    """SQL map lookup; NULL when absent."""
    listed = ", ".join(f"{k if isinstance(k, int) else repr(k)}, {v!r}" for k, v in pairs.items())
    return f"map({listed})[{key}]"


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_brand").distinct().selectExpr("p_brand", f"{BRAND_NO} as n")


def asset_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brands(spark, sf_dir).selectExpr(
        f"{_ticker('n')} as ticker",
        "if(n % 2 = 0, concat('  Asset ', p_brand, ' '), concat('Asset ', p_brand)) as asset_name",
        "case when n between 1 and 10 or n = 25 then 'etf' when n between 11 and 15 then 'Stock' "
        "when n between 16 and 18 then ' INDEX' when n between 19 and 21 then 'fx' "
        "when n between 22 and 23 then 'commodity' else 'bond proxy' end as asset_type",
        f"{_pick('Global Equity ETF', 'Global Bond ETF', 'Regional')} as asset_subtype",
        f"{_pick('Global', 'Europe ', 'Asia')} as region",
        f"{_pick('IE', '', 'US', 'GB')} as country",
        f"{_pick('USD', 'GBP')} as currency",
        "'vendor' as provider_name",
        f"{_pick('LSE', 'NYSE', ' ')} as exchange",
        "if(n = 3, null, n <> 25) as is_active",
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(part, lines["l_partkey"] == part["p_partkey"])


def asset_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The line order is exact: line keys repeat now and then in generated data, and the further columns
    # decide then. No narrower key holds all six, so the aggregate sorts within each scan task.
    lines = _lines(spark, sf_dir).selectExpr(
        "p_brand",
        "cast(l_shipdate as date) as date",
        "l_extendedprice / l_quantity as px",
        "l_discount as off",
        "l_quantity",
        "struct(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) as line_no",
    )
    bars = lines.groupBy("p_brand", "date").agg(
        *_exprs(
            "min_by(px, line_no) as open",
            "max(px) filter (where off >= 0.03D) as high",
            "min(px) filter (where off >= 0.03D) as low",
            "max_by(px, line_no) as close",
            "max_by(off, line_no) as last_off",
            "sum(l_quantity) as volume",
        )
    )
    return bars.selectExpr(
        f"{_ticker(BRAND_NO)} as ticker",
        "date",
        "open",
        "high",
        "low",
        "close",
        "if(last_off < 0.1D, close * (1 - last_off), null) as adj_close",
        "volume",
    )


def _exprs(*sql: str):
    from pyspark.sql.functions import expr

    return [expr(s) for s in sql]


def etf_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        brands(spark, sf_dir)
        .filter(FUNDS)
        .selectExpr(
            "concat('E', n) as etf",
            "lower(p_brand) as ticker",
            "concat('IE', lpad(n, 10, '0')) as isin",
            "if(n = 6, '  ', concat('Fund ', n)) as fund_name",
            f"{_pick(' vanguard', 'ISHARES', 'Amundi ', 'Other Co')} as provider",
            f"{_map(INDEX_CODES, 'n')} as index",
            "if(n <> 10, concat('GRP_', n % 3), null) as equivalence_group_code",
            f"{_pick('Primary', ' Peer')} as relationship_to_group",
            f"{_pick('Bond', 'Equity')} as asset_class",
            f"{_pick('Core', 'Theme', '')} as category",
            f"{_pick('Dist', 'Acc')} as distribution_type",
            "'Physical' as replication_method",
            f"{_pick('USD', 'GBP')} as currency",
            "'IE' as domicile",
            f"{_pick('Yes', 'No', 'n/a')} as hedged_flag",
            "case when n <= 7 then 'Yes' when n = 8 then 'no' end as ucits_flag",
            "if(n <> 9, cast((n * 7) % 50 as double) / 100, null) as ter",
            "make_date(n + 1990, n, n) as inception_date",
            "case when n = 4 then 'no' when n <> 5 then 'YES' end as is_active",
            f"{_pick('', 'checked')} as notes",
        )
    )


def _weights(lines: DataFrame, name: str) -> DataFrame:
    """Revenue share in percent per fund and category; sums are exact decimals."""
    revenue = (
        lines.selectExpr(f"{BRAND_NO} as n", name, "cast(l_extendedprice as decimal(18,2)) as v")
        .filter(FUNDS)
        .groupBy("n", name)
        .agg(*_exprs("sum(v) as part"))
    )
    # one row per fund and category is left for the window
    return revenue.selectExpr(
        "concat('E', n) as etf",
        name,
        "round(cast(part as double) / cast(sum(part) over (partition by n) as double) * 100, 6) "
        "as exposure_weight",
    )


def etf_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    supplier = table(spark, sf_dir, "supplier")
    origin = (
        supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"])
        .join(region, nation["n_regionkey"] == region["r_regionkey"])
        .selectExpr("s_suppkey", f"{_map(REGION_NAMES, 'r_name')} as geography")
    )
    lines = _lines(spark, sf_dir)
    return _weights(lines.join(origin, lines["l_suppkey"] == origin["s_suppkey"]), "geography")


def etf_sector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weights(_lines(spark, sf_dir).withColumnRenamed("p_type", "sector"), "sector")


def equivalence_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .selectExpr(f"{BRAND_NO} % 3 as g")
        .distinct()
        .selectExpr(
            "concat(' Grp_', g, ' ') as equivalence_group_code",
            "concat('Group ', g) as equivalence_group_name",
            "'Exposure' as group_type",
            "concat('Exposure ', g) as canonical_exposure",
            "if(g = 2, 'third group', ' ') as description",
        )
    )


def equivalence_group_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "concat('GRP_', n_nationkey % 3) as source_group_code",
        "if(n_regionkey = 4, ' ', concat('grp_', n_regionkey)) as target_group_code",
        "' Similar' as relationship_type",
        "cast(n_nationkey as string) as priority_rank",
        "if(n_nationkey % 2 = 0, n_name, null) as notes",
    )


RAW = {
    "asset_master": asset_master,
    "asset_prices": asset_prices,
    "etf_metadata": etf_metadata,
    "etf_geography": etf_geography,
    "etf_sector": etf_sector,
    "equivalence_groups": equivalence_groups,
    "equivalence_group_relationships": equivalence_group_relationships,
}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text table with the relative path a landed file would have."""
    return table(spark, sf_dir, "documents").selectExpr(
        "concat('docs_text/', lang, '/', source, '-e', doc_id, '.txt') as relative_path", "text as content"
    )
