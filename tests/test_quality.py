import datetime as dt

import pytest

from folioloom.operators import quality
from folioloom.operators.quality import Check
from folioloom.plans.checks import declared_checks

AS_OF = dt.date(2024, 1, 10)
SCHEMA = "k string, g string, v double, w double, d date"
ROWS = [
    ("a", "x", 1.0, 60.0, dt.date(2024, 1, 2)),
    ("a", "x", 7.0, 30.0, dt.date(2023, 1, 1)),
    (None, None, None, None, None),
    (None, None, -1.0, 0.5, None),
]


@pytest.fixture(scope="module")
def frames(spark):
    return {
        "rows": spark.createDataFrame(ROWS, SCHEMA),
        "empty": spark.createDataFrame([], SCHEMA),
        "nulls": spark.createDataFrame([(None,) * 5] * 3, SCHEMA),
        "parent": spark.createDataFrame([("b",)], "k string"),
    }


ASSERTIONS = {
    "not_null": (lambda f, t: quality.not_null(f[t], "k"), 2, 3),
    "unique": (lambda f, t: quality.unique(f[t], "k"), 1, 0),
    "accepted": (lambda f, t: quality.accepted_values(f[t], "k", ["z"]), 2, 0),
    "relationships": (lambda f, t: quality.relationships(f[t], "k", f["parent"], "k"), 2, 0),
    "compound": (lambda f, t: quality.compound_unique(f[t], ["k", "g"]), 2, 1),
    "between": (lambda f, t: quality.values_between(f[t], "v", minimum=0, maximum=5), 2, 0),
    "strictly": (lambda f, t: quality.values_between(f[t], "v", minimum=1, strictly=True), 2, 0),
    "condition": (lambda f, t: quality.values_between(f[t], "v", maximum=5, row_condition="k = 'b'"), 0, 0),
    "rows": (lambda f, t: quality.rows_satisfy(f[t], "v < 5"), 1, 0),
    "weights": (lambda f, t: quality.weights_balance(f[t], "k", "w"), 2, 0),
    "recent": (lambda f, t: quality.max_is_recent(f[t], "d", 7, AS_OF), 1, 0),
}


@pytest.mark.parametrize("name", ASSERTIONS)
def test_failing_rows(frames, name):
    check, failing, on_nulls = ASSERTIONS[name]
    assert check(frames, "rows").count() == failing
    assert check(frames, "empty").count() == 0
    assert check(frames, "nulls").count() == on_nulls


def test_passing_tables(spark):
    df = spark.createDataFrame([("a", 0.4), ("a", 0.6), ("b", 100.5)], "k string, w double")
    assert quality.weights_balance(df, "k", "w").count() == 0
    recent = spark.createDataFrame([(dt.date(2024, 1, 3),)], "d date")
    assert quality.max_is_recent(recent, "d", 7, AS_OF).count() == 0


def test_suite_reports_one_row_per_test(frames):
    checks = [
        Check("rows", "not_null", "k"),
        Check("rows", "not_null", "v", "warn"),
        Check("rows", "unique", "g"),
        Check("rows", "compound_unique", "k_g", options={"columns": ["k", "g"]}),
        Check("rows", "relationships", "k", options={"to": "parent", "field": "k"}),
        Check("rows", "recent", "d", "warn", {"max_age_days": 7}),
        Check("parent", "not_null", "k"),
    ]
    got = {r.test: (r.n_failures, r.status) for r in quality.run_suite(checks, frames, AS_OF).collect()}
    assert got == {
        "not_null_rows_k": (2, "fail"),
        "not_null_rows_v": (1, "warn"),
        "unique_rows_g": (1, "fail"),
        "compound_unique_rows_k_g": (2, "fail"),
        "relationships_rows_k": (2, "fail"),
        "recent_rows_d": (1, "warn"),
        "not_null_parent_k": (0, "pass"),
    }


def test_declared_checks():
    declared = declared_checks()
    assert len(declared) == 87 and len({c.name for c in declared}) == 87
    assert sum(c.severity == "warn" for c in declared) == 5
