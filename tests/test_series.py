import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from folioloom.operators import series


def by_day(df):
    return df.orderBy("ticker", "full_date").collect()


def test_returns_skip_gaps_and_start_null(series_of):
    rows = by_day(series.with_returns(series_of({"A": [100, None, 110, 99]})))
    assert [r.return_1d for r in rows] == [None, pytest.approx(0.1), pytest.approx(-0.1)]


def test_week_is_five_rows_whatever_the_calendar(series_of):
    prices = [1, None, None, 2, None, 3, 4, None, 5, 6]
    rows = by_day(series.with_returns(series_of({"A": prices})))
    assert rows[5].return_1w == pytest.approx(6 / 1 - 1)
    assert rows[4].return_1w is None


def test_first_row_and_constant_series(series_of):
    out = series.risk_and_trend(series_of({"A": [0.1] * 6}))
    rows = by_day(out)
    first, last = rows[0], rows[-1]
    assert first.volatility_30d is None and first.sma_200 == first.price_for_returns
    assert (first.above_sma_50_flag, first.trend_score, first.trend_label) == (False, 0, "Mixed")
    assert last.volatility_30d == 0 and last.sharpe_proxy_1y is None


def test_drawdown(series_of):
    rows = by_day(series.with_drawdown(series_of({"A": [100, 120, 90]})))
    assert [r.drawdown_52w for r in rows] == [0, 0, pytest.approx(-0.25)]
    assert [r.drawdown_since_inception for r in rows] == [0, 0, pytest.approx(-0.25)]


def test_rolling_peak_forgets_after_a_year_and_inception_does_not(series_of):
    rows = by_day(series.with_drawdown(series_of({"A": [500] + [100] * 252})))
    assert rows[251].drawdown_52w == pytest.approx(-0.8)
    assert rows[252].drawdown_52w == 0
    assert rows[252].drawdown_since_inception == pytest.approx(-0.8)


def test_measures_against_brute_force(series_of):
    rng = random.Random(7)
    prices = [round(50 + 20 * rng.random(), 4) for _ in range(300)]
    rows = by_day(series.risk_and_trend(series_of({"A": prices})))
    returns = [None] + [b / a - 1 for a, b in zip(prices, prices[1:], strict=False)]
    for i in (1, 28, 31, 120, 260, 299):
        last30 = [x for x in returns[max(0, i - 29) : i + 1] if x is not None]
        year = [x for x in returns[max(0, i - 251) : i + 1] if x is not None]
        r = rows[i]
        if len(last30) > 1:
            assert r.volatility_30d == pytest.approx(statistics.stdev(last30) * math.sqrt(252))
            sharpe = statistics.mean(year) / statistics.stdev(year) * math.sqrt(252)
            assert r.sharpe_proxy_1y == pytest.approx(sharpe)
        assert r.sma_200 == pytest.approx(statistics.mean(prices[max(0, i - 199) : i + 1]))
        assert r.rolling_peak_252d == max(prices[max(0, i - 251) : i + 1])
        if i >= 252:
            assert r.return_1y == pytest.approx(prices[i] / prices[i - 252] - 1)


@pytest.mark.parametrize("slice_rows", [252, 300, 5000])
def test_slices_give_the_same_rows(series_of, slice_rows):
    rng = random.Random(3)
    a = [None if rng.random() < 0.3 else 10 + rng.random() for _ in range(1500)]
    prices = series_of({"A": a, "B": [5 + rng.random() for _ in range(504)], "C": [1.0]})
    whole = series.risk_and_trend(prices)
    sliced = series.risk_and_trend(series.slice_series(prices, slice_rows))
    assert sorted(whole.columns) == sorted(sliced.columns)
    names = whole.columns
    left = sorted(map(str, whole.select(names).collect()))
    right = sorted(map(str, sliced.select(names).collect()))
    assert left == right


def test_a_slice_holds_at_least_a_year(series_of):
    with pytest.raises(ValueError):
        series.slice_series(series_of({"A": [1, 2]}), 100)


def test_one_exchange_for_all_measures(series_of):
    plan = series.risk_and_trend(series_of({"A": [1, 2]}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_partition_count_does_not_change_results(spark, series_of):
    rng = random.Random(1)
    prices = series_of({t: [10 + rng.random() for _ in range(80)] for t in "ABCDEFG"})
    columns = ["ticker", "full_date", F.round("volatility_30d", 10), F.round("sma_50", 8), "trend_label"]
    one = sorted(map(str, series.risk_and_trend(prices.coalesce(1)).select(*columns).collect()))
    many = sorted(map(str, series.risk_and_trend(prices.repartition(13)).select(*columns).collect()))
    assert one == many


def test_figures_of_the_last_day_need_only_the_latest_rows(series_of):
    rng = random.Random(8)
    prices = series_of({"A": [10 + rng.random() for _ in range(400)], "B": [3, 4, 5]})
    columns = ["volatility_30d", "drawdown_52w", "sma_200", "trend_label"]

    def last(df):
        return {
            r.asset_key: tuple(r.v)
            for r in df.groupBy("asset_key").agg(F.max_by(F.struct(*columns), "full_date").alias("v")).collect()
        }

    cut = series.latest_rows(prices)
    assert cut.count() == 252 + 3
    assert last(series.risk_and_trend(cut)) == last(series.risk_and_trend(prices))
