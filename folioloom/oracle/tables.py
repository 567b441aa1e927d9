"""Named SQL tables the twins are made of; ``with_tables`` prepends the ones a statement uses."""

from __future__ import annotations

import re

TABLES: dict[str, str] = {}

# --- raw contract from the driver tables ------------------------------------------------------

TABLES["t_brands"] = """
    select distinct p_brand, cast(split_part(p_brand, '#', 2) as int) as n,
        case when cast(split_part(p_brand, '#', 2) as int) between 19 and 21
            then 'FX' || split_part(p_brand, '#', 2) || '=X' else upper(p_brand) end as ticker
    from part"""

TABLES["raw_asset_master"] = """
    select ticker,
        case when n % 2 = 0 then '  Asset ' || p_brand || ' ' else 'Asset ' || p_brand end as asset_name,
        case when n <= 10 or n = 25 then 'etf' when n <= 15 then 'Stock' when n <= 18 then ' INDEX'
            when n <= 21 then 'fx' when n <= 23 then 'commodity' else 'bond proxy' end as asset_type,
        (['Global Equity ETF', 'Global Bond ETF', 'Regional'])[n % 3 + 1] as asset_subtype,
        (['Global', 'Europe ', 'Asia'])[n % 3 + 1] as region,
        (['IE', '', 'US', 'GB'])[n % 4 + 1] as country,
        (['USD', 'GBP'])[n % 2 + 1] as currency,
        'vendor' as provider_name,
        (['LSE', 'NYSE', ' '])[n % 3 + 1] as exchange,
        case when n = 3 then null else n <> 25 end as is_active
    from t_brands"""

TABLES["t_lines"] = """
    select l.*, p.p_type, b.n, b.ticker, l_extendedprice / l_quantity as px, cast(l_shipdate as date) as d
    from lineitem l join part p on l.l_partkey = p.p_partkey join t_brands b using (p_brand)"""

TABLES["raw_asset_prices"] = """
    select ticker, d as "date",
        first(px order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) as open,
        max(px) filter (where l_discount >= 0.03) as high,
        min(px) filter (where l_discount >= 0.03) as low,
        last(px order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) as close,
        last(case when l_discount < 0.1 then px * (1 - l_discount) end
            order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) as adj_close,
        sum(l_quantity) as volume
    from t_lines group by all"""

TABLES["raw_etf_metadata"] = """
    select 'E' || n as etf, lower(p_brand) as ticker, 'IE' || lpad(cast(n as varchar), 10, '0') as isin,
        case when n = 6 then '  ' else 'Fund ' || n end as fund_name,
        ([' vanguard', 'ISHARES', 'Amundi ', 'Other Co'])[n % 4 + 1] as provider,
        (['FTSE_ALL_WORLD', 'S&P_500', 'MSCI_ACWI', 'FTSE_EMERGING', 'BLOOMBERG_GLOBAL_AGGREGATE',
          'FTSEX', null, 'STOXX_600', 'S&P_500', 'MSCI_ACWI'])[n] as "index",
        case when n <> 10 then 'GRP_' || (n % 3) end as equivalence_group_code,
        (['Primary', ' Peer'])[n % 2 + 1] as relationship_to_group,
        (['Bond', 'Equity'])[n % 2 + 1] as asset_class,
        (['Core', 'Theme', ''])[n % 3 + 1] as category,
        (['Dist', 'Acc'])[n % 2 + 1] as distribution_type,
        'Physical' as replication_method,
        (['USD', 'GBP'])[n % 2 + 1] as currency,
        'IE' as domicile,
        (['Yes', 'No', 'n/a'])[n % 3 + 1] as hedged_flag,
        case when n <= 7 then 'Yes' when n = 8 then 'no' end as ucits_flag,
        case when n <> 9 then cast((n * 7) % 50 as double) / 100 end as ter,
        make_date(n + 1990, n, n) as inception_date,
        case when n = 4 then 'no' when n <> 5 then 'YES' end as is_active,
        (['', 'checked'])[n % 2 + 1] as notes
    from t_brands where n between 1 and 10"""

TABLES["raw_etf_geography"] = """
    with s as (
        select n, r_name, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as v
        from t_lines join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
            join region on n_regionkey = r_regionkey
        where n <= 10 group by all),
    t as (select n, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as v
        from t_lines join supplier on l_suppkey = s_suppkey where n <= 10 group by all)
    select 'E' || s.n as etf,
        case r_name when 'AMERICA' then 'US' when 'EUROPE' then 'UK' when 'ASIA' then 'Emerging Asia'
            when 'AFRICA' then 'Emerging Africa' when 'MIDDLE EAST' then 'Developed ex-US' end as geography,
        round(s.v / t.v * 100, 6) as exposure_weight
    from s join t on s.n = t.n"""

TABLES["raw_etf_sector"] = """
    with s as (select n, p_type, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as v
        from t_lines where n <= 10 group by all),
    t as (select n, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as v
        from t_lines where n <= 10 group by all)
    select 'E' || s.n as etf, p_type as sector, round(s.v / t.v * 100, 6) as exposure_weight
    from s join t on s.n = t.n"""

TABLES["raw_equivalence_groups"] = """
    select distinct ' Grp_' || (n % 3) || ' ' as equivalence_group_code,
        'Group ' || (n % 3) as equivalence_group_name, 'Exposure' as group_type,
        'Exposure ' || (n % 3) as canonical_exposure,
        case when n % 3 = 2 then 'third group' else ' ' end as description
    from t_brands"""

TABLES["raw_equivalence_group_relationships"] = """
    select 'GRP_' || (n_nationkey % 3) as source_group_code,
        case when n_regionkey = 4 then ' ' else 'grp_' || n_regionkey end as target_group_code,
        ' Similar' as relationship_type, cast(n_nationkey as varchar) as priority_rank,
        case when n_nationkey % 2 = 0 then n_name end as notes
    from nation"""

# --- staging ------------------------------------------------------------------------------------

TABLES["stg_asset_master"] = """
    select md5(upper(trim(ticker))) as asset_key, upper(trim(ticker)) as ticker,
        nullif(trim(asset_name), '') as asset_name,
        case when lower(trim(asset_type)) in ('etf', 'fx') then upper(trim(asset_type))
            when lower(trim(asset_type)) = 'bond proxy' then 'Bond Proxy'
            else upper(left(trim(asset_type), 1)) || lower(substr(trim(asset_type), 2)) end as asset_type,
        nullif(trim(asset_subtype), '') as asset_subtype, nullif(trim(region), '') as region,
        nullif(trim(country), '') as country, nullif(trim(currency), '') as currency,
        nullif(trim(provider_name), '') as provider_name, nullif(trim(exchange), '') as exchange,
        true as is_active
    from raw_asset_master where is_active is distinct from false"""

TABLES["stg_asset_prices"] = """
    with v as (
        select "date" as full_date, ticker, if(open > 0, open, null) as o, if(high > 0, high, null) as h,
            if(low > 0, low, null) as l, if(close > 0, close, null) as c,
            if(adj_close > 0, adj_close, null) as a, volume
        from raw_asset_prices where close > 0)
    select cast(strftime(full_date, '%Y%m%d') as int) as date_key, full_date, asset_key, ticker,
        asset_name, asset_type, asset_subtype, region, country, currency, exchange,
        o as open_price, greatest(o, h, l, c) as high_price, least(o, h, l, c) as low_price,
        c as close_price, a as adj_close_price, coalesce(a, c) as price_for_returns, volume
    from v join stg_asset_master using (ticker)"""

_YES_NO = "case lower({0}) when 'yes' then true when 'no' then false end as {0}"

TABLES["stg_etf_metadata"] = f"""
    select asset_key, upper(etf) as etf_code, m.ticker, asset_name, isin,
        nullif(trim(fund_name), '') as fund_name,
        case lower(trim(provider)) when 'ishares' then 'iShares' when 'vanguard' then 'Vanguard'
            else trim(provider) end as provider_name,
        "index" as index_code, replace("index", '_', ' ') as index_name,
        lower(equivalence_group_code) as equivalence_group_code,
        lower(trim(relationship_to_group)) as relationship_to_group,
        asset_class, nullif(category, '') as category, distribution_type, replication_method,
        r.currency, domicile, {_YES_NO.format('hedged_flag')}, {_YES_NO.format('ucits_flag')},
        ter, inception_date,
        case lower(r.is_active) when 'yes' then true when 'no' then false end as is_active,
        nullif(r.notes, '') as notes
    from raw_etf_metadata r join stg_asset_master m on upper(r.ticker) = m.ticker"""

TABLES["stg_etf"] = "select * exclude (asset_key, asset_name, index_name) from stg_etf_metadata"
TABLES["stg_etf_geography"] = """
    select asset_key, etf_code, ticker, geography as geography_name, exposure_weight
    from raw_etf_geography join stg_etf_metadata on upper(etf) = etf_code"""
TABLES["stg_etf_sector"] = """
    select asset_key, etf_code, ticker, sector as sector_name, exposure_weight
    from raw_etf_sector join stg_etf_metadata on upper(etf) = etf_code"""
TABLES["stg_geography"] = "select etf_code, geography_name, exposure_weight from stg_etf_geography"
TABLES["stg_sector"] = "select etf_code, sector_name, exposure_weight from stg_etf_sector"
TABLES["stg_equivalence_group"] = """
    select lower(trim(equivalence_group_code)) as equivalence_group_code, equivalence_group_name,
        lower(group_type) as group_type, canonical_exposure, nullif(trim(description), '') as description
    from raw_equivalence_groups"""
TABLES["stg_equivalence_group_relationships"] = """
    select lower(source_group_code) as source_group_code, lower(target_group_code) as target_group_code,
        lower(trim(relationship_type)) as relationship_type, cast(priority_rank as int) as priority_rank, notes
    from raw_equivalence_group_relationships where trim(target_group_code) <> ''"""
TABLES["stg_yfinance"] = """
    select ticker, full_date as trading_date, open_price, high_price, low_price, close_price,
        adj_close_price, volume from stg_asset_prices"""

# --- series -------------------------------------------------------------------------------------

TABLES["t_returns"] = """
    select *, price_for_returns / nullif(lag(price_for_returns, 1) over w, 0) - 1 as return_1d,
        price_for_returns / nullif(lag(price_for_returns, 5) over w, 0) - 1 as return_1w,
        price_for_returns / nullif(lag(price_for_returns, 21) over w, 0) - 1 as return_1m,
        price_for_returns / nullif(lag(price_for_returns, 63) over w, 0) - 1 as return_3m,
        price_for_returns / nullif(lag(price_for_returns, 126) over w, 0) - 1 as return_6m,
        price_for_returns / nullif(lag(price_for_returns, 252) over w, 0) - 1 as return_1y
    from stg_asset_prices window w as (partition by asset_key order by full_date)"""

TABLES["t_series"] = """
    select *,
        stddev_samp(return_1d) over w30 * sqrt(252) as volatility_30d,
        stddev_samp(return_1d) over w90 * sqrt(252) as volatility_90d,
        avg(return_1d) over w252 / nullif(stddev_samp(return_1d) over w252, 0) * sqrt(252) as sharpe_proxy_1y,
        max(price_for_returns) over w252 as rolling_peak_252d,
        price_for_returns / max(price_for_returns) over w252 - 1 as drawdown_52w,
        price_for_returns / max(price_for_returns) over wall - 1 as drawdown_since_inception,
        avg(price_for_returns) over w20 as sma_20,
        avg(price_for_returns) over w50 as sma_50,
        avg(price_for_returns) over w200 as sma_200
    from t_returns window
        w20 as (partition by asset_key order by full_date rows 19 preceding),
        w30 as (partition by asset_key order by full_date rows 29 preceding),
        w50 as (partition by asset_key order by full_date rows 49 preceding),
        w90 as (partition by asset_key order by full_date rows 89 preceding),
        w200 as (partition by asset_key order by full_date rows 199 preceding),
        w252 as (partition by asset_key order by full_date rows 251 preceding),
        wall as (partition by asset_key order by full_date rows unbounded preceding)"""

TABLES["t_measured"] = """
    select *, price_for_returns > sma_50 as above_sma_50_flag, price_for_returns > sma_200 as above_sma_200_flag,
        cast(price_for_returns > sma_50 as int) + cast(price_for_returns > sma_200 as int) as trend_score,
        case when price_for_returns > greatest(sma_50, sma_200) then 'Uptrend'
            when price_for_returns < least(sma_50, sma_200) then 'Downtrend' else 'Mixed' end as trend_label
    from t_series"""

_RETURNS = "return_1d, return_1w, return_1m, return_3m, return_6m, return_1y"
TABLES["int_asset_returns"] = f"""
    select asset_key, ticker, date_key, full_date, close_price, adj_close_price, price_for_returns,
        return_1d as daily_return, {_RETURNS} from t_returns"""
TABLES["int_asset_volatility"] = """
    select asset_key, ticker, date_key, full_date, volatility_30d, volatility_90d, sharpe_proxy_1y from t_series"""
TABLES["int_asset_drawdown"] = """
    select asset_key, ticker, date_key, full_date, price_for_returns, rolling_peak_252d, drawdown_52w,
        drawdown_since_inception from t_series"""
TABLES["int_asset_trend_inputs"] = """
    select asset_key, ticker, date_key, full_date, price_for_returns, sma_20, sma_50, sma_200,
        above_sma_50_flag, above_sma_200_flag, trend_score, trend_label from t_measured"""
TABLES["int_asset_risk_enriched"] = f"""
    select asset_key, ticker, date_key, full_date, close_price, adj_close_price, price_for_returns,
        return_1d as daily_return, {_RETURNS}, volatility_30d, volatility_90d, sharpe_proxy_1y,
        drawdown_52w, drawdown_since_inception from t_series"""
TABLES["int_asset_pair_returns"] = """
    select a.full_date, a.date_key, a.asset_key, a.ticker, b.asset_key as compare_asset_key,
        b.ticker as compare_ticker, a.return_1d as daily_return, b.return_1d as compare_daily_return
    from t_returns a join t_returns b on a.full_date = b.full_date and a.asset_key < b.asset_key
    where a.return_1d is not null and b.return_1d is not null"""


def _correlation(span: int) -> str:
    return f"""
    with newest as (select * from int_asset_pair_returns
        qualify row_number() over (partition by asset_key, compare_asset_key order by full_date desc) <= {span})
    select asset_key, ticker, compare_asset_key, compare_ticker, max(full_date) as as_of_date,
        count(*) as observation_count,
        covar_samp(daily_return, compare_daily_return)
            / nullif(stddev_samp(daily_return) * stddev_samp(compare_daily_return), 0) as correlation_{span}d
    from newest group by all"""


TABLES["int_asset_correlation_30d"] = _correlation(30)
TABLES["int_asset_correlation_90d"] = _correlation(90)

# --- dimensions -----------------------------------------------------------------------------------

TABLES["dim_asset"] = """
    select m.*, s.a as first_seen_date, s.b as last_seen_date from stg_asset_master m
    left join (select asset_key as k, min(full_date) as a, max(full_date) as b
        from stg_asset_prices group by all) s on s.k = m.asset_key"""

TABLES["dim_date"] = """
    with days as (select cast(unnest(generate_series(min(full_date), max(full_date), interval 1 day)) as date) as d
        from stg_asset_prices)
    select cast(strftime(d, '%Y%m%d') as int) as date_key, d as full_date, dayname(d) as day_name,
        cast(day(d) as int) as day_of_month, cast(week(d) as int) as week_of_year,
        cast(month(d) as int) as month_number, monthname(d) as month_name,
        cast(quarter(d) as int) as quarter_number, cast(year(d) as int) as year_number,
        day(d + 1) = 1 as month_end_flag, day(d + 1) = 1 and month(d) % 3 = 0 as quarter_end_flag,
        strftime(d, '%m%d') = '1231' as year_end_flag,
        d in (select full_date from stg_asset_prices) as trading_day_flag
    from days"""

TABLES["dim_asset_classification"] = """
    with latest as (select asset_key as k, arg_max(volatility_30d, full_date) as vol0,
            arg_max(drawdown_52w, full_date) as dd0, arg_max(trend_label, full_date) as trend_category,
            last(volatility_30d order by full_date) as vol, last(drawdown_52w order by full_date) as dd
        from t_measured group by all)
    select asset_key,
        case when asset_type = 'Stock' then 'Growth' when asset_type <> 'ETF' then 'Macro Indicator'
            when asset_subtype ilike '%bond%' then 'Defensive' else 'Core' end as role,
        case when vol >= 0.2 then 'High' when vol >= 0.1 then 'Medium' when vol < 0.1 then 'Low' end as risk_band,
        case when vol >= 0.2 then 'High Vol' when vol >= 0.1 then 'Mid Vol' when vol < 0.1 then 'Low Vol' end
            as volatility_bucket,
        case when dd <= -0.2 then 'Deep' when dd <= -0.1 then 'Moderate' when dd > -0.1 then 'Shallow' end
            as drawdown_bucket,
        trend_category,
        case when asset_type = 'ETF' then if(asset_subtype ilike '%global%', 'Core', 'Satellite') end
            as core_satellite_flag,
        cast(null as varchar) as notes
    from stg_asset_master left join latest on k = asset_key"""

TABLES["dim_etf_profile"] = "select * exclude (asset_name) from stg_etf_metadata"
TABLES["dim_provider"] = """
    select distinct md5(lower(provider_name)) as provider_key, provider_name, provider_name as provider_group,
        cast(null as varchar) as provider_country from dim_etf_profile where provider_name is not null"""
TABLES["dim_index"] = """
    select md5(index_code) as index_key,
        case index_code when 'FTSE_ALL_WORLD' then 'FTSE All-World' when 'FTSE_EMERGING' then 'FTSE Emerging'
            when 'BLOOMBERG_GLOBAL_AGGREGATE' then 'Bloomberg Global Aggregate'
            else replace(index_code, '_', ' ') end as index_name,
        case when starts_with(index_code, 'FTSE') then 'FTSE' when starts_with(index_code, 'BLOOMBERG') then 'Bloomberg'
            else split_part(index_code, '_', 1) end as index_family,
        case when index_code = 'S&P_500' then 'US' when contains(index_code, 'EMERGING') then 'Emerging Markets'
            when regexp_matches(index_code, 'ALL_WORLD|ACWI|GLOBAL') then 'Global' else 'Other' end
            as broad_region_type,
        case when index_code in ('FTSE_ALL_WORLD', 'MSCI_ACWI', 'S&P_500', 'BLOOMBERG_GLOBAL_AGGREGATE') then true
            when contains(index_code, 'EMERGING') then false end as developed_flag,
        case when index_code in ('FTSE_ALL_WORLD', 'MSCI_ACWI', 'FTSE_EMERGING') then true
            when index_code in ('S&P_500', 'BLOOMBERG_GLOBAL_AGGREGATE') then false end as emerging_flag,
        min(asset_class) as asset_class, index_code
    from dim_etf_profile where index_code is not null group by index_code"""
TABLES["dim_equivalence_group"] = """
    select md5(equivalence_group_code) as equivalence_group_key, * from stg_equivalence_group"""
TABLES["dim_etf"] = """
    select p.asset_key as etf_key, etf_code, p.ticker, isin, coalesce(fund_name, asset_name) as fund_name,
        md5(lower(p.provider_name)) as provider_key, md5(index_code) as index_key,
        md5(equivalence_group_code) as equivalence_group_key, asset_class, category, distribution_type,
        replication_method, p.currency, domicile, hedged_flag, ucits_flag, ter, inception_date, p.is_active
    from dim_etf_profile p join stg_asset_master m on m.asset_key = p.asset_key"""
TABLES["dim_geography"] = """
    select distinct md5(lower(geography_name)) as geography_key, geography_name,
        case geography_name when 'US' then 'North America' when 'UK' then 'Europe'
            when 'Developed ex-US' then 'Developed Markets'
            else if(geography_name ilike '%emerging%', 'Emerging Markets', 'Other') end as geography_group
    from stg_etf_geography"""
TABLES["dim_sector"] = "select distinct md5(lower(sector_name)) as sector_key, sector_name from stg_etf_sector"
TABLES["bridge_etf_geography"] = """
    select asset_key as etf_key, md5(lower(geography_name)) as geography_key, exposure_weight
    from stg_etf_geography"""
TABLES["bridge_etf_sector"] = """
    select asset_key as etf_key, md5(lower(sector_name)) as sector_key, exposure_weight from stg_etf_sector"""

# --- marts ------------------------------------------------------------------------------------------

TABLES["fact_asset_price_daily"] = """
    select date_key, asset_key, full_date, open_price, high_price, low_price, close_price, adj_close_price,
        volume from stg_asset_prices"""
TABLES["fact_etf_daily"] = f"""
    select date_key, asset_key as etf_key, close_price, {_RETURNS}, volatility_30d, drawdown_52w,
        sharpe_proxy_1y as sharpe_proxy from t_series where asset_key in (select asset_key from dim_etf_profile)"""
TABLES["mart_asset_returns"] = f"""
    select date_key, full_date, asset_key, ticker, asset_name, asset_type, asset_subtype, region, country,
        currency, close_price, adj_close_price, price_for_returns, {_RETURNS}, return_1d as daily_return
    from t_returns"""
TABLES["mart_asset_risk"] = """
    select date_key, full_date, asset_key, ticker, asset_name, asset_type, asset_subtype, region, currency,
        volatility_30d, volatility_90d, drawdown_52w, drawdown_since_inception, sharpe_proxy_1y from t_series"""
TABLES["mart_asset_trend"] = """
    select date_key, full_date, asset_key, ticker, asset_name, asset_type, asset_subtype, region,
        price_for_returns, sma_20, sma_50, sma_200, above_sma_50_flag, above_sma_200_flag, trend_score,
        trend_label from t_measured"""
TABLES["mart_asset_moves"] = """
    select full_date, date_key, asset_key, ticker, asset_name, asset_type, region, return_1d,
        abs(return_1d) as abs_return_1d,
        row_number() over (partition by full_date order by abs(return_1d) desc, ticker) as move_rank,
        (['Down', 'Flat', 'Up'])[cast(sign(return_1d) as int) + 2] as move_direction
    from t_returns where return_1d is not null"""
TABLES["mart_fx_intelligence"] = """
    select full_date, date_key, asset_key, ticker, asset_name, replace(ticker, '=X', '') as fx_pair_code,
        return_1d, return_1w, return_1m, volatility_30d, drawdown_52w, trend_label, above_sma_50_flag,
        above_sma_200_flag from t_measured where asset_type = 'FX'"""
TABLES["mart_market_regime"] = """
    with s as (select full_date,
            max(return_1m) filter (where ticker = 'BRAND#16') as sp500_return_1m,
            max(return_1m) filter (where ticker = 'BRAND#1') as global_bond_return_1m,
            max(return_1m) filter (where ticker = 'BRAND#22') as gold_return_1m,
            max(return_1m) filter (where ticker = 'BRAND#23') as oil_return_1m,
            max(return_1m) filter (where ticker = 'FX19=X') as gbpusd_return_1m,
            bool_or(above_sma_200_flag) filter (where ticker = 'BRAND#16') as sp500_above_sma_200_flag,
            avg(return_1d) filter (where asset_type in ('ETF', 'Stock', 'Index')) as growth_asset_avg_return_1d
        from t_measured group by all)
    select cast(strftime(full_date, '%Y%m%d') as int) as date_key, *,
        case when sp500_return_1m > 0 and sp500_above_sma_200_flag and ifnull(global_bond_return_1m, 0) >= 0
                then 'Risk On'
            when sp500_return_1m < 0 and global_bond_return_1m > 0 then 'Defensive'
            when oil_return_1m > 0 and gold_return_1m > 0 and global_bond_return_1m < 0 then 'Inflationary'
            else 'Mixed' end as regime_label
    from s"""


def _overlap(table: str, name: str) -> str:
    return f"""(select a.asset_key, b.asset_key as compare_asset_key,
        sum(case when a.exposure_weight <= b.exposure_weight then a.exposure_weight
            when a.exposure_weight > b.exposure_weight then b.exposure_weight end) as score
    from {table} a join {table} b on a.{name} = b.{name} and a.asset_key < b.asset_key group by all)"""


TABLES["mart_etf_overlap"] = f"""
    select asset_key, a.ticker, a.asset_name, compare_asset_key, b.ticker as compare_ticker,
        b.asset_name as compare_asset_name, s.score as sector_overlap_score, g.score as geography_overlap_score,
        case when s.score is null or g.score is null then coalesce(s.score, g.score, 0)
            else (s.score + g.score) / 2 end as blended_overlap_score
    from {_overlap('stg_etf_sector', 'sector_name')} s
    full join {_overlap('stg_etf_geography', 'geography_name')} g using (asset_key, compare_asset_key)
    join stg_asset_master a using (asset_key)
    join stg_asset_master b on b.asset_key = compare_asset_key"""
TABLES["mart_etf_equivalence"] = """
    select a.asset_key, a.ticker, a.asset_name, b.asset_key as compare_asset_key, b.ticker as compare_ticker,
        b.asset_name as compare_asset_name, equivalence_group_code, g.equivalence_group_name, a.ter,
        b.ter as compare_ter, a.ter - b.ter as ter_spread,
        case when a.ter < b.ter then a.ticker when b.ter < a.ter then b.ticker end as lower_fee_ticker
    from stg_etf_metadata a join stg_etf_metadata b using (equivalence_group_code)
    left join stg_equivalence_group g using (equivalence_group_code)
    where a.asset_key < b.asset_key"""
TABLES["mart_fee_benchmarks"] = """
    select asset_key, ticker, asset_name, f.equivalence_group_code, g.equivalence_group_name, ter,
        avg(ter) over grp as group_avg_ter, min(ter) over grp as group_min_ter, max(ter) over grp as group_max_ter,
        percent_rank() over (partition by f.equivalence_group_code order by ter nulls last) as ter_percentile
    from stg_etf_metadata f left join stg_equivalence_group g using (equivalence_group_code)
    window grp as (partition by f.equivalence_group_code)"""
TABLES["export_market_correlations"] = """
    select a.as_of_date, x.ticker, x.asset_name, x.asset_type, y.ticker as compare_ticker,
        y.asset_name as compare_asset_name, y.asset_type as compare_asset_type,
        a.observation_count as observation_count_30d, correlation_30d,
        b.observation_count as observation_count_90d, correlation_90d
    from int_asset_correlation_30d a
    left join int_asset_correlation_90d b using (asset_key, compare_asset_key)
    join stg_asset_master x using (asset_key) join stg_asset_master y on y.asset_key = compare_asset_key"""
for _export, _mart in {
    "export_market_returns": "mart_asset_returns",
    "export_market_risk": "mart_asset_risk",
    "export_market_trends": "mart_asset_trend",
    "export_fx_intelligence": "mart_fx_intelligence",
    "export_market_regime": "mart_market_regime",
    "export_etf_overlap": "mart_etf_overlap",
    "export_etf_equivalence": "mart_etf_equivalence",
    "export_fee_benchmarks": "mart_fee_benchmarks",
}.items():
    TABLES[_export] = f"select * from {_mart}"
TABLES["t_fund_star"] = """
    select e.*, f.fund_name as profile_fund_name, p.provider_name, i.index_name, i.index_family,
        i.broad_region_type, i.developed_flag, i.emerging_flag, g.equivalence_group_code,
        g.equivalence_group_name, g.group_type, g.canonical_exposure
    from dim_etf e left join dim_etf_profile f on f.asset_key = e.etf_key
    left join dim_provider p on p.provider_key = e.provider_key
    left join dim_index i on i.index_key = e.index_key
    left join dim_equivalence_group g on g.equivalence_group_key = e.equivalence_group_key"""
TABLES["daily_prices"] = f"""
    select full_date, s.ticker, profile_fund_name as fund_name, provider_name, index_name, equivalence_group_name,
        close_price, {_RETURNS}, volatility_30d, drawdown_52w, sharpe_proxy_1y as sharpe_proxy
    from t_series s join t_fund_star f on f.etf_key = s.asset_key"""

# --- scope and documents ---------------------------------------------------------------------------------

TABLES["t_ucits"] = "select * from t_fund_star where ucits_flag and is_active is distinct from false"
TABLES["t_documents"] = """
    select *, upper(split_part(title, '.', 1)) as ticker, 'files/' || relative_path as file_url
    from (select 'docs_text/' || lang || '/' || source || '-e' || doc_id || '.txt' as relative_path,
            source || '-e' || doc_id || '.txt' as title, text as content from documents)"""

MODEL_LAYERS = {
    "stg": [n for n in TABLES if n.startswith("stg_")],
    "dimensions": ["dim_asset", "dim_date", "dim_asset_classification", "dim_etf_profile"],
    "int": [n for n in TABLES if n.startswith("int_")],
    "marts": [
        n for n in TABLES
        if n.startswith(("mart_", "fact_", "bridge_"))
        or n in ("dim_provider", "dim_index", "dim_equivalence_group", "dim_etf", "dim_geography", "dim_sector")
    ],
    "exports": [n for n in TABLES if n.startswith("export_")],
    "reports": ["daily_prices"],
}

_WORDS = re.compile(r"[a-z_0-9]+")


def _needs(sql: str) -> list[str]:
    return [w for w in dict.fromkeys(_WORDS.findall(sql)) if w in TABLES]


def with_tables(sql: str) -> str:
    """``sql`` led by the definitions of every named table it uses, in order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for other in _needs(TABLES[name]):
                if other != name:
                    visit(other)
            ordered.append(name)

    for name in _needs(sql):
        visit(name)
    if not ordered:
        return sql
    defined = ",\n".join(f"{n} as materialized ({TABLES[n]})" for n in ordered)
    own = sql.strip()
    return f"with {defined},\n{own[5:]}" if own.startswith("with ") else f"with {defined}\n{own}"
