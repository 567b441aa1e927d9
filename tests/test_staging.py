import datetime as dt
import hashlib

from folioloom.operators import staging

MASTER = (
    "ticker string, asset_name string, asset_type string, asset_subtype string, region string, "
    "country string, currency string, provider_name string, exchange string, is_active boolean"
)
PRICES = (
    "ticker string, date date, open double, high double, low double, close double, adj_close double, "
    "volume double"
)
DAY = dt.date(2021, 1, 4)


def master(spark, *rows):
    full = [(t, f" {t} ", kind, " ", "Global", None, "USD", "p", "X", active) for t, kind, active in rows]
    return staging.stg_asset_master(spark.createDataFrame(full, MASTER))


def test_master_cleans_and_keeps_only_active(spark):
    out = master(
        spark, (" aapl ", "STOCK", True), ("B", " bond Proxy", None), ("C", "etf", False), ("  ", "fx", True),
        ("D", "Crypto ", True), ("E", None, True),
    ).collect()
    got = {r.ticker: r for r in out}
    assert set(got) == {"AAPL", "B", "D", "E"}
    assert [got[t].asset_type for t in "BDE"] == ["Bond Proxy", "Crypto", None]
    assert got["AAPL"].asset_name == "aapl" and got["AAPL"].asset_subtype is None
    assert all(r.is_active for r in out)
    assert got["AAPL"].asset_key == hashlib.md5(b"AAPL").hexdigest()


def prices(spark, rows, tickers=(("AAPL", "Stock", True),)):
    return staging.stg_asset_prices(spark.createDataFrame(rows, PRICES), master(spark, *tickers)).collect()


def test_range_is_widened_to_open_and_close(spark):
    (row,) = prices(spark, [("aapl", DAY, 10.0, 9.0, 11.0, 12.0, None, 5.0)])
    assert (row.high_price, row.low_price) == (12.0, 9.0)
    assert row.price_for_returns == 12.0 and row.date_key == 20210104


def test_non_positive_prices(spark):
    rows = prices(
        spark,
        [
            ("AAPL", DAY, 1.0, 1.0, 1.0, -37.6, 1.0, 1.0),
            ("AAPL", DAY + dt.timedelta(1), 0.0, None, None, 5.0, -1.0, 1.0),
            ("AAPL", None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0),
        ],
    )
    (row,) = rows
    assert row.open_price is None and row.adj_close_price is None
    assert (row.high_price, row.low_price, row.price_for_returns) == (5.0, 5.0, 5.0)


def test_raw_ticker_is_not_trimmed_for_the_join(spark):
    assert prices(spark, [(" AAPL", DAY, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)]) == []


def test_metadata_flags_provider_and_index(spark):
    cols = [
        "etf", "ticker", "isin", "fund_name", "provider", "index", "equivalence_group_code",
        "relationship_to_group", "asset_class", "category", "distribution_type", "replication_method",
        "currency", "domicile", "hedged_flag", "ucits_flag", "is_active", "notes",
    ]
    schema = ", ".join(f"`{c}` string" for c in cols) + ", ter double, inception_date date"
    base = dict.fromkeys(cols)
    rows = [
        {**base, "etf": " e1 ", "ticker": "aapl", "provider": " ISHARES", "index": "S&P_500",
         "hedged_flag": "Yes ", "ucits_flag": "maybe", "is_active": "NO", "equivalence_group_code": " GRP "},
        {**base, "etf": " ", "ticker": "AAPL"},
        {**base, "etf": "E2", "ticker": "AAPL "},
    ]
    raw = spark.createDataFrame([tuple(r[c] for c in cols) + (0.1, DAY) for r in rows], schema)
    (row,) = staging.stg_etf_metadata(raw, master(spark, ("AAPL", "etf", True))).collect()
    assert (row.etf_code, row.provider_name, row.index_name) == ("E1", "iShares", "S&P 500")
    assert (row.hedged_flag, row.ucits_flag, row.is_active) == (True, None, False)
    assert row.equivalence_group_code == "grp"
    assert "index_name" not in staging.stg_etf(
        staging.stg_etf_metadata(raw, master(spark, ("AAPL", "etf", True)))
    ).columns


def test_exposure_drops_blank_names_and_unknown_funds(spark):
    meta = spark.createDataFrame([("k", "E1", "AAPL")], "asset_key string, etf_code string, ticker string")
    raw = spark.createDataFrame(
        [("e1", " US ", 60.0), ("E1", " ", 1.0), ("E9", "UK", 1.0)],
        "etf string, geography string, exposure_weight double",
    )
    (row,) = staging.stg_etf_geography(raw, meta).collect()
    assert tuple(row) == ("k", "E1", "AAPL", "US", 60.0)
