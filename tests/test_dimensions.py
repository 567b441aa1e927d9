import datetime as dt

from folioloom.operators import dimensions as dim
from folioloom.operators import series


def test_calendar_flags(spark):
    prices = spark.createDataFrame([(dt.date(2021, 1, 3),), (dt.date(2021, 12, 31),)], "full_date date")
    rows = {r.full_date: r for r in dim.dim_date(prices).collect()}
    assert len(rows) == 363
    sunday, quarter, year = (rows[dt.date(2021, *d)] for d in ((1, 3), (3, 31), (12, 31)))
    assert (sunday.week_of_year, sunday.day_name, sunday.month_name) == (53, "Sunday", "January")
    assert (quarter.month_end_flag, quarter.quarter_end_flag, quarter.year_end_flag) == (True, True, False)
    assert (year.month_end_flag, year.quarter_end_flag, year.year_end_flag) == (True, True, True)
    assert year.trading_day_flag and not quarter.trading_day_flag
    assert rows[dt.date(2021, 4, 30)].quarter_end_flag is False


def test_calendar_of_no_prices_is_empty(spark):
    assert dim.dim_date(spark.createDataFrame([], "full_date date")).collect() == []


def test_extended_calendar(spark):
    bounds = spark.createDataFrame([(dt.date(2020, 12, 27), dt.date(2021, 1, 4))], "start date, end date")
    rows = {r.date_key: r for r in dim.calendar_range(bounds, dt.date(2021, 1, 2)).collect()}
    assert len(rows) == 9
    r = rows[dt.date(2021, 1, 3)]
    assert (r.iso_year_week, r.day_of_week, r.is_weekend, r.is_today) == ("2020-W53", 0, 1, 0)
    assert r.week_start_date == dt.date(2020, 12, 28) and r.quarter_start_date == dt.date(2021, 1, 1)
    assert rows[dt.date(2021, 1, 2)].is_today == 1 and rows[dt.date(2021, 1, 4)].day_name_short == "Mon"


def test_asset_dimension_keeps_assets_without_prices(spark, series_of):
    assets = spark.createDataFrame([("kA", "A"), ("kZ", "Z")], "asset_key string, ticker string")
    got = {r.ticker: r for r in dim.dim_asset(assets, series_of({"A": [1, None, 2]})).collect()}
    assert got["A"].last_seen_date == dt.date(2020, 1, 3) and got["Z"].first_seen_date is None


def test_classification(spark, series_of):
    assets = spark.createDataFrame(
        [("kA", "ETF", "Global Bond ETF"), ("kB", "ETF", None), ("kC", "Stock", None), ("kD", "FX", None), ("kE", "?", "x")],
        "asset_key string, asset_type string, asset_subtype string",
    )
    measured = series.risk_and_trend(series_of({"A": [100, 100, 100], "B": [100, 200, 80]}))
    got = {r.asset_key: r for r in dim.dim_asset_classification(assets, measured).collect()}
    assert [got[f"k{k}"].role for k in "ABCDE"] == ["Defensive", "Core", "Growth", "Macro Indicator", "Satellite"]
    assert [got[f"k{k}"].core_satellite_flag for k in "ABC"] == ["Core", "Satellite", None]
    a, b, c = got["kA"], got["kB"], got["kC"]
    assert (a.risk_band, a.volatility_bucket, a.drawdown_bucket, a.trend_category) == (
        "Low", "Low Vol", "Shallow", "Mixed"
    )
    assert (b.risk_band, b.volatility_bucket, b.drawdown_bucket, b.trend_category) == (
        "High", "High Vol", "Deep", "Downtrend"
    )
    assert (c.risk_band, c.drawdown_bucket, c.trend_category) == (None, None, None)


def test_index_rules(spark):
    codes = ["FTSEX", "STOXX_600", "S&P_500", "FTSE_EMERGING", "MSCI_ACWI", "NEW_EMERGING_X", None]
    profile = spark.createDataFrame([(c, "Equity") for c in codes], "index_code string, asset_class string")
    got = {r.index_code: r for r in dim.dim_index(profile).collect()}
    assert None not in got
    assert got["FTSEX"].index_family == "FTSE" and got["STOXX_600"].index_family == "STOXX"
    assert (got["S&P_500"].index_name, got["S&P_500"].broad_region_type) == ("S&P 500", "US")
    assert got["STOXX_600"].developed_flag is None and got["STOXX_600"].index_name == "STOXX 600"
    e = got["NEW_EMERGING_X"]
    assert (e.broad_region_type, e.developed_flag, e.emerging_flag) == ("Emerging Markets", False, True)
    assert (got["MSCI_ACWI"].broad_region_type, got["MSCI_ACWI"].emerging_flag) == ("Global", True)


def test_geography_groups(spark):
    names = ["US", "UK", "Developed ex-US", "emerging asia", "Japan", "US"]
    got = {
        r.geography_name: r.geography_group
        for r in dim.dim_geography(spark.createDataFrame([(n,) for n in names], "geography_name string")).collect()
    }
    assert got == {
        "US": "North America", "UK": "Europe", "Developed ex-US": "Developed Markets",
        "emerging asia": "Emerging Markets", "Japan": "Other",
    }
