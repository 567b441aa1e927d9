import itertools
import random
import statistics

import pytest

from folioloom.operators import pairs, series


def corr(xs, ys):
    sx, sy = statistics.stdev(xs), statistics.stdev(ys)
    mx, my = statistics.mean(xs), statistics.mean(ys)
    cov = sum((x - mx) * (y - my) for x, y in zip(xs, ys, strict=True)) / (len(xs) - 1)
    return cov / (sx * sy)


def returns_of(series_of, prices):
    return series.int_asset_returns(series_of(prices))


@pytest.mark.parametrize("blocks", [1, 2, 5])
def test_every_pair_of_a_day_once(series_of, blocks):
    prices = {t: [1 + i + ord(t) for i in range(3)] for t in "ABCDEFGH"}
    rows = pairs.int_asset_pair_returns(returns_of(series_of, prices), blocks).collect()
    seen = sorted((r.full_date, r.asset_key, r.compare_asset_key) for r in rows)
    days = sorted({r.full_date for r in rows})
    keys = sorted(f"k{t}" for t in prices)
    assert seen == sorted((d, a, b) for d in days for a, b in itertools.combinations(keys, 2))
    assert len(days) == 2


def latest_by_definition(returns):
    by_asset: dict = {}
    for r in returns.filter("daily_return is not null").collect():
        by_asset.setdefault(r.asset_key, {})[r.full_date] = r.daily_return
    for a, b in itertools.combinations(sorted(by_asset), 2):
        shared = sorted(set(by_asset[a]) & set(by_asset[b]), reverse=True)
        yield (a, b), shared, [(by_asset[a][d], by_asset[b][d]) for d in shared]


@pytest.mark.parametrize("blocks", [1, 3])
def test_latest_correlations_against_brute_force(series_of, blocks):
    """Dense, sparse and mixed pairs all use their own latest shared days."""
    rng = random.Random(blocks)
    gaps = {"A": 0.0, "B": 0.05, "C": 0.7, "D": 0.9, "E": 0.0}
    prices = {
        t: [None if rng.random() < g else 10 + rng.random() for _ in range(160)] for t, g in gaps.items()
    }
    prices["F"] = [10 + rng.random() for _ in range(4)] + [None] * 156
    prices["G"] = [None] * 158 + [1.0, 2.0]
    returns = returns_of(series_of, prices)
    got = {
        (r.asset_key, r.compare_asset_key): r
        for r in pairs.latest_correlations(returns, (30, 90), blocks=blocks).collect()
    }
    expected = 0
    for pair, shared, values in latest_by_definition(returns):
        if not shared:
            assert pair not in got
            continue
        expected += 1
        row = got[pair]
        assert row.as_of_date == shared[0]
        for span in (30, 90):
            assert row[f"observation_count_{span}d"] == len(shared[:span])
            if len(shared[:span]) > 2:
                assert row[f"correlation_{span}d"] == pytest.approx(corr(*zip(*values[:span], strict=True)))
    assert len(got) == expected


def test_delisted_assets_emit_few_rows_per_pair(series_of):
    """Nine assets in ten stopped trading at some time; a pair emits its windows and its latest 90 days, no history."""
    rng = random.Random(8)
    n = 1500
    prices = {}
    for i in range(20):
        last = n if i < 2 else rng.randrange(100, n)
        prices[f"T{i:02}"] = [10 + rng.random() if d < last else None for d in range(n)]
    returns = returns_of(series_of, prices)
    _, windows = pairs.return_windows(returns)
    met = {tuple(r)[:2]: r["count"] for r in pairs.shared_windows(windows, 90).groupBy("asset_key", "compare_asset_key").count().collect()}
    days: dict = {}
    for r in pairs.latest_shared_days(windows, 90).collect():
        days.setdefault((r.asset_key, r.compare_asset_key), []).append((r.rn, r.x, r.y))
    expected = {pair: values[:90] for pair, _, values in latest_by_definition(returns) if values}
    assert {p: [v[1:] for v in sorted(d)] for p, d in days.items()} == expected
    assert max(map(len, days.values())) == 90 and max(met.values()) <= 3
    every = pairs.unordered_pairs(windows, "w", ["bits"]).groupBy("asset_key", "compare_asset_key").count()
    assert every.agg({"count": "max"}).first()[0] + 90 <= 2 * 90


def test_every_bit_of_a_window_counts(series_of):
    rng = random.Random(5)
    prices = {t: [10 + rng.random() for _ in range(2 * pairs.WINDOW_DAYS + 1)] for t in "AB"}
    returns = returns_of(series_of, prices)
    calendar, windows = pairs.return_windows(returns)
    assert {r.bits for r in windows.collect()} == {2**pairs.WINDOW_DAYS - 1}
    assert calendar.count() == 2 * pairs.WINDOW_DAYS
    got = [(r.x, r.y) for r in pairs.latest_shared_days(windows, 126).orderBy("rn").collect()]
    assert got == [v for _, _, values in latest_by_definition(returns) for v in values]


def test_constant_series_and_single_day_have_no_correlation(series_of):
    returns = returns_of(series_of, {"A": [1, 2, 4, 8], "B": [5, 6, 9, 7], "C": [None, None, 3, 4]})
    got = {(r.ticker, r.compare_ticker): r for r in pairs.latest_correlations(returns).collect()}
    assert got["A", "B"].correlation_30d is None and got["A", "B"].observation_count_30d == 3
    assert got["B", "C"].correlation_90d is None and got["B", "C"].observation_count_90d == 1


def test_spans_count_shared_days(series_of):
    rng = random.Random(2)
    prices = {t: [1 + rng.random() for _ in range(41)] for t in "AB"}
    (row,) = pairs.latest_correlations(returns_of(series_of, prices)).collect()
    assert (row.observation_count_30d, row.observation_count_90d) == (30, 40)
    model = pairs.correlation_model(pairs.latest_correlations(returns_of(series_of, prices)), 30)
    assert model.columns[-2:] == ["observation_count", "correlation_30d"]


def exposure(spark, name, rows):
    return spark.createDataFrame(rows, f"asset_key string, {name} string, exposure_weight double")


def assets(spark, *keys):
    return spark.createDataFrame(
        [(k, k.upper(), f"name {k}") for k in keys], "asset_key string, ticker string, asset_name string"
    )


def test_overlap_with_one_missing_side(spark):
    sector = exposure(spark, "sector_name", [("a", "x", 60.0), ("a", "y", 40.0), ("b", "x", 30.0), ("b", "z", 70.0)])
    geography = exposure(spark, "geography_name", [("a", "US", 100.0)])
    (row,) = pairs.mart_etf_overlap(sector, geography, assets(spark, "a", "b")).collect()
    assert (row.sector_overlap_score, row.geography_overlap_score, row.blended_overlap_score) == (30, None, 30)
    assert (row.ticker, row.compare_ticker) == ("A", "B")


def test_overlap_null_weight_adds_nothing(spark):
    sector = exposure(
        spark, "sector_name", [("a", "x", None), ("a", "y", 5.0), ("b", "x", 30.0), ("b", "y", 4.0), ("c", "x", 1.0)]
    )
    geography = exposure(spark, "geography_name", [("a", "US", 50.0), ("b", "US", 20.0)])
    got = {
        (r.asset_key, r.compare_asset_key): r
        for r in pairs.mart_etf_overlap(sector, geography, assets(spark, "a", "b", "c")).collect()
    }
    assert got["a", "b"].sector_overlap_score == 4 and got["a", "b"].blended_overlap_score == 12
    assert got["a", "c"].sector_overlap_score is None and got["a", "c"].blended_overlap_score == 0


def test_equivalence_ties_and_missing_fees(spark):
    profile = spark.createDataFrame(
        [("a", "g", 0.1), ("b", "g", 0.1), ("c", "g", None), ("d", "g", 0.3), ("e", None, 0.1), ("f", None, 0.1)],
        "asset_key string, equivalence_group_code string, ter double",
    )
    groups = spark.createDataFrame([("g", "G")], "equivalence_group_code string, equivalence_group_name string")
    rows = pairs.mart_etf_equivalence(profile, assets(spark, *"abcdef"), groups).collect()
    got = {(r.asset_key, r.compare_asset_key): r.lower_fee_ticker for r in rows}
    assert len(got) == 6
    assert got["a", "b"] is None and got["a", "c"] is None and got["b", "d"] == "B"
