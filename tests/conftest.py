import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from folioloom.session import builder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        builder("tests", "local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def series_of(spark):
    """Cleaned price rows from {ticker: [price or None, ...]}, one day apart from 2020-01-01."""

    def make(prices: dict, types: dict | None = None):
        rows = []
        for ticker, values in prices.items():
            for i, p in enumerate(values):
                if p is None:
                    continue
                day = dt.date(2020, 1, 1) + dt.timedelta(days=i)
                kind = (types or {}).get(ticker, "Stock")
                rows.append((f"k{ticker}", ticker, int(day.strftime("%Y%m%d")), day, float(p), kind))
        df = spark.createDataFrame(
            rows,
            "asset_key string, ticker string, date_key int, full_date date, price_for_returns double, "
            "asset_type string",
        )
        return df.selectExpr(
            "*",
            "price_for_returns as close_price",
            "price_for_returns as adj_close_price",
            "ticker as asset_name",
            "cast(null as string) as asset_subtype",
            "'Global' as region",
            "'US' as country",
            "'USD' as currency",
        )

    return make
