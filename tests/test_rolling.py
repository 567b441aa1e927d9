import datetime
import math
import random
import statistics

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import Window as W

from folioloom.operators import rolling, series


@given(st.integers(1, 300), st.lists(st.integers(1, 300), max_size=5))
def test_pieces_tile_the_frame(rows, shorter):
    pieces = rolling.cover(rows, [k for k in shorter if k < rows])
    at = 0
    for length, offset in pieces:
        assert offset == at
        at += length
    assert at == rows


@pytest.mark.parametrize(("levels", "most"), [(series.SPREAD_LEVELS, 20), (series.MEAN_LEVELS, 17), (series.PEAK_LEVELS, 19)])
def test_pieces_are_far_fewer_than_rows(levels, most):
    assert sum(len(rolling.cover(k, levels[:i])) for i, k in enumerate(levels)) <= most


def _frame(spark, values):
    days = [(k, datetime.date(2020, 1, 1) + datetime.timedelta(i), v) for k, vs in values.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(days, "k string, d date, x double"), W.partitionBy("k").orderBy("d")


def _values(kind, n, rng):
    if kind == "gaps":
        return [None if rng.random() < 0.4 else rng.gauss(0, 1) for _ in range(n)]
    if kind == "outlier":
        return [1e9 if i == 40 else rng.gauss(1e-4, 1e-5) for i in range(n)]
    if kind == "far from zero":
        return [1e8 + rng.random() for _ in range(n)]
    return [None] * n


@pytest.mark.parametrize("kind", ["gaps", "outlier", "far from zero", "nothing"])
def test_moments_and_maxima_against_brute_force(spark, kind):
    rng, levels = random.Random(3), [3, 6, 20, 47]
    values = {"a": _values(kind, 120, rng), "b": _values(kind, 5, rng)}
    df, ordered = _frame(spark, values)
    names = {k: (f"mean_{k}", f"sd_{k}") for k in levels}
    out = rolling.with_rolling_moments(
        df, "x", ordered, levels, {k: m for k, (m, _) in names.items()}, {k: s for k, (_, s) in names.items()}
    )
    out = rolling.with_rolling_max(out, "x", ordered, levels, "top")
    assert set(out.columns) == {"k", "d", "x", "top", *(x for pair in names.values() for x in pair)}
    for r in out.collect():
        i = (r.d - datetime.date(2020, 1, 1)).days
        for k, (mean, sd) in names.items():
            seen = [v for v in values[r.k][max(0, i + 1 - k) : i + 1] if v is not None]
            assert r[mean] == (pytest.approx(statistics.mean(seen), rel=1e-12, abs=1e-15) if seen else None)
            assert r[sd] == (pytest.approx(statistics.stdev(seen), rel=1e-7) if len(seen) > 1 else None)
            if k == levels[-1]:
                assert r.top == (max(seen) if seen else None)


@pytest.mark.parametrize("c", [0.1, 1 / 3, 1e-7, 123456.789])
def test_a_constant_series_has_exactly_its_mean_and_no_spread(spark, c):
    df, ordered = _frame(spark, {"a": [c] * 300})
    out = rolling.with_rolling_moments(df, "x", ordered, series.SPREAD_LEVELS, {252: "mean"}, {252: "sd"})
    rows = out.orderBy("d").collect()
    assert {r["mean"] for r in rows} == {c}
    assert rows[0].sd is None and {r.sd for r in rows[1:]} == {0.0} and not math.isnan(rows[-1].sd)


def test_levels_share_one_exchange_and_one_sort(spark, series_of):
    plan = series.risk_and_trend(series_of({"A": [1.0, 2.0]}))._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan
    physical = series.risk_and_trend(series_of({"A": [1.0, 2.0]}))._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange hashpartitioning") <= 1 and physical.count("Sort [") <= 1
    # frames are unbounded behind or a single look-up: none is added up row by row
    assert "specifiedwindowframe(RowFrame, -251" not in physical
