import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from folioloom.operators import marts, series
from folioloom.operators.ranking import position_in_group


def test_moves_rank_by_size_then_ticker(series_of):
    prices = {"B": [100, 90], "A": [100, 110], "C": [7, 7], "D": [5, 5], "E": [None, 3]}
    rows = marts.mart_asset_moves(series_of(prices)).orderBy("move_rank").collect()
    # 0.1 and -0.1 differ in the last digit as doubles; both orders of A and B share the size bucket
    assert {r.ticker for r in rows[:2]} == {"A", "B"}
    assert [r.ticker for r in rows[2:]] == ["C", "D"]
    assert {r.ticker: r.move_direction for r in rows} == {"A": "Up", "B": "Down", "C": "Flat", "D": "Flat"}


def test_moves_against_a_plain_sort(series_of):
    rng = random.Random(5)
    prices = {
        f"T{i:03d}": [100, rng.choice([100, 100.4, 101, 130, 400, 90, 99.7, 100 + rng.random()])]
        for i in range(120)
    }
    rows = marts.mart_asset_moves(series_of(prices)).collect()
    want = sorted(rows, key=lambda r: (-r.abs_return_1d, r.ticker))
    assert [r.move_rank for r in want] == list(range(1, 121))


def test_positions_over_ranges_with_a_null_group(spark):
    rows = [(None, 1.0), (None, 2.0), ("g", 5.0), ("g", 7.0), ("g", None)] + [("zero", float(i % 1)) for i in range(50)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, g string, v double")
    ranked = position_in_group(df, "g", [F.col("v").asc_nulls_last(), F.col("id").asc()], "p").collect()
    got = {r.id: r.p for r in ranked}
    assert [got[i] for i in range(5)] == [1, 2, 1, 2, 3] and [got[i] for i in range(5, 55)] == list(range(1, 51))


def test_moves_on_a_day_without_any(series_of):
    rows = marts.mart_asset_moves(series_of({f"B{i:02d}": [100, 100] for i in range(40)})).orderBy("ticker").collect()
    assert [r.move_rank for r in rows] == list(range(1, 41)) and {r.move_direction for r in rows} == {"Flat"}


def test_fees_that_are_all_equal(spark):
    profile = spark.range(60).selectExpr("cast(id as string) as asset_key", "'g' as equivalence_group_code", "0.2D as ter")
    assets = profile.selectExpr("asset_key", "asset_key as ticker", "asset_key as asset_name")
    groups = spark.createDataFrame([("g", "G")], "equivalence_group_code string, equivalence_group_name string")
    got = marts.mart_fee_benchmarks(profile, assets, groups).collect()
    assert len(got) == 60 and {(r.ter_percentile, round(r.group_avg_ter, 9)) for r in got} == {(0.0, 0.2)}


def test_fee_percentiles(spark):
    rows = [("a", "g", 0.1), ("b", "g", 0.2), ("c", "g", None), ("d", None, 0.5), ("e", None, 0.4), ("f", "h", 1.0)]
    profile = spark.createDataFrame(rows, "asset_key string, equivalence_group_code string, ter double")
    assets = spark.createDataFrame(
        [(k, k, k) for k in "abcdef"], "asset_key string, ticker string, asset_name string"
    )
    groups = spark.createDataFrame([("g", "G")], "equivalence_group_code string, equivalence_group_name string")
    got = {r.asset_key: r for r in marts.mart_fee_benchmarks(profile, assets, groups).collect()}
    assert [got[k].ter_percentile for k in "abc"] == [0, 0.5, 1]
    assert [got[k].ter_percentile for k in "def"] == [1, 0, 0]
    assert got["c"].group_avg_ter == pytest.approx(0.15) and got["d"].group_max_ter == 0.5
    assert got["a"].equivalence_group_name == "G" and got["d"].equivalence_group_name is None


@pytest.mark.parametrize(
    ("index", "above", "bond", "gold", "oil", "label"),
    [
        (0.1, True, None, None, None, "Risk On"),
        (0.1, None, 0.1, None, None, "Mixed"),
        (-0.1, True, 0.1, 0.1, 0.1, "Defensive"),
        (None, None, -0.1, 0.1, 0.1, "Inflationary"),
        (0.1, True, -0.1, 0.1, 0.1, "Inflationary"),
        (-0.1, None, None, 0.1, 0.1, "Mixed"),
    ],
)
def test_regime_rules(spark, index, above, bond, gold, oil, label):
    df = spark.createDataFrame(
        [(index, above, bond, gold, oil)], "i double, a boolean, b double, g double, o double"
    )
    got = df.select(marts.regime_label(*[F.col(c) for c in "iabgo"]).alias("r")).first().r
    assert got == label


def test_regime_mart_uses_its_tickers(series_of):
    days = 30
    prices = {"I": [100 + i for i in range(days)], "B": [10] * days, "X": [1 + i % 2 for i in range(days)]}
    tickers = {"equity_index": "I", "bond": "B", "gold": "g", "oil": "o", "fx": "X"}
    rows = marts.mart_market_regime(series_of(prices, {"X": "FX"}), tickers).orderBy("full_date").collect()
    assert len(rows) == days and rows[0].regime_label == "Mixed"
    assert rows[-1].regime_label == "Risk On" and rows[-1].gold_return_1m is None
    assert rows[-1].growth_asset_avg_return_1d == pytest.approx((129 / 128 - 1) / 2)


def test_fx_mart_keeps_only_currency_pairs(series_of):
    out = marts.mart_fx_intelligence(series_of({"GBPUSD=X": [1, 2], "AAPL": [3, 4]}, {"GBPUSD=X": "FX"}))
    assert {r.fx_pair_code for r in out.collect()} == {"GBPUSD"}


def test_fund_facts_are_cut_before_the_windows(spark, series_of):
    prices = series_of({"A": [1, 2], "B": [1, 3]})
    profile = spark.createDataFrame([("kB",)], "asset_key string")
    fund_prices = marts.only_funds(prices, profile)
    out = marts.fact_etf_daily(fund_prices, profile)
    rows = out.orderBy("date_key").collect()
    assert [r.etf_key for r in rows] == ["kB", "kB"] and rows[1].return_1d == 2
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("LeftSemi")


def test_report_keeps_funds_without_provider(spark, series_of):
    etf = spark.createDataFrame(
        [("kA", None, "i", None)],
        "etf_key string, provider_key string, index_key string, equivalence_group_key string",
    )
    profile = spark.createDataFrame([("kA", "Fund A")], "asset_key string, fund_name string")
    provider = spark.createDataFrame([("p", "P")], "provider_key string, provider_name string")
    index = spark.createDataFrame([("i", "Index")], "index_key string, index_name string")
    group = spark.createDataFrame(
        [("g", "G")], "equivalence_group_key string, equivalence_group_name string"
    )
    star = marts.fund_star(etf, profile, provider, index, group)
    rows = marts.daily_prices(series_of({"A": [1, 2], "B": [1, 1]}), star).orderBy("full_date").collect()
    assert [(r.ticker, r.index_name, r.provider_name) for r in rows] == [("A", "Index", None)] * 2
    assert rows[0].full_date == dt.date(2020, 1, 1)


def test_marts_of_slices_equal_marts_of_whole_series(series_of):
    rng = random.Random(6)
    prices = series_of({t: [10 + rng.random() for _ in range(700)] for t in "AB"}, {"B": "FX"})
    sliced = series.slice_series(prices, 260)
    for mart in (marts.mart_asset_returns, marts.mart_asset_risk, marts.mart_fx_intelligence, marts.mart_market_regime):
        assert sorted(map(str, mart(prices).collect())) == sorted(map(str, mart(sliced).collect()))
