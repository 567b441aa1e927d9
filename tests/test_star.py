import datetime as dt

import pytest

from folioloom.operators import analyst, star


@pytest.fixture(scope="module")
def tables(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    fund_columns = (
        "isin asset_class category distribution_type replication_method currency domicile fund_name etf_code"
    ).split()
    etfs = frame(
        [("f1", "T1", "p1", None, "g1"), ("f2", "T2", None, "i1", "g1")],
        "etf_key string, ticker string, provider_key string, index_key string, equivalence_group_key string",
    ).selectExpr("*", *[f"cast(null as string) as {c}" for c in fund_columns])
    facts = [(20200101 + d, f, v, v / 100) for f, v in (("f1", 10.0), ("f2", 30.0)) for d in (0, 1)]
    return {
        "etf_facts": frame(facts, "date_key int, etf_key string, close_price double, return_1d double").selectExpr(
            "*", "return_1d as return_1m", "return_1d as volatility_30d", "cast(null as double) as return_1y"
        ),
        "dates": frame([(20200101, 2020), (20200102, 2020)], "date_key int, year_number int"),
        "etfs": etfs,
        "providers": frame([("p1", "P")], "provider_key string, provider_name string"),
        "indexes": frame([("i1", "I")], "index_key string, index_name string"),
        "equivalence_groups": frame([("g1", "G")], "equivalence_group_key string, equivalence_group_name string"),
        "etf_sectors": frame(
            [("f1", "s1", 50.0), ("f1", "s2", 30.0), ("f1", "s3", 20.0), ("f2", "s1", 100.0)],
            "etf_key string, sector_key string, exposure_weight double",
        ),
        "sectors": frame([("s1", "A"), ("s2", "B"), ("s3", "C")], "sector_key string, sector_name string"),
        "etf_geographies": frame(
            [("f1", "g1", 60.0), ("f1", "g2", 40.0), ("f2", "g1", 100.0)],
            "etf_key string, geography_key string, exposure_weight double",
        ),
        "geographies": frame(
            [("g1", "US", "Big"), ("g2", "UK", "Big")],
            "geography_key string, geography_name string, geography_group string",
        ),
    }


def ask(tables, metrics, dims, **kw):
    return {tuple(r)[: len(dims)]: tuple(r)[len(dims) :] for r in star.query(star.FUND_STAR, tables, metrics, dims, **{"period": star.ALL_TIME, **kw}).collect()}


def test_missing_foreign_keys_keep_their_facts(tables):
    assert ask(tables, ["total_etf_records", "avg_close_price"], ["provider_name"]) == {
        ("P",): (2, 10.0),
        (None,): (2, 30.0),
    }


def test_no_dimensions(tables):
    assert ask(tables, ["total_etf_records", "avg_close_price"], []) == {(): (4, 20.0)}


def test_exposures_do_not_multiply_facts(tables):
    by_sector = ask(tables, ["total_etf_records"], ["ticker", "sector_name"])
    assert by_sector == {("T1", "A"): (2,), ("T1", "B"): (2,), ("T1", "C"): (2,), ("T2", "A"): (2,)}
    # both geographies of T1 fall into one group: counted once
    assert ask(tables, ["total_etf_records", "avg_return_1d"], ["geography_group"]) == {
        ("Big",): (4, pytest.approx(0.2))
    }


def test_filter_on_an_exposure_counts_a_fund_once(tables):
    kw = {"where": "sector_name in ('A', 'B')", "where_dimensions": ["sector_name"]}
    assert ask(tables, ["total_etf_records"], ["ticker"], **kw) == {("T1",): (2,), ("T2",): (2,)}


def test_metrics_of_different_sources_meet_on_the_dimensions(tables):
    got = ask(
        tables,
        ["total_etf_records", "avg_sector_exposure_weight", "avg_geography_exposure_weight"],
        ["ticker"],
    )
    assert got == {("T1",): (2, pytest.approx(100 / 3), 50.0), ("T2",): (2, 100.0, 100.0)}


def test_filter_on_a_date(tables):
    kw = {"where": "year_number = 2021", "where_dimensions": ["year_number"]}
    assert ask(tables, ["total_etf_records"], ["ticker"], **kw) == {}


def test_unreachable_and_unknown_names(tables):
    with pytest.raises(ValueError):
        ask(tables, ["avg_sector_exposure_weight"], ["year_number"])
    with pytest.raises(ValueError):
        ask(tables, ["avg_sector_exposure_weight"], ["geography_name"])
    with pytest.raises(ValueError):
        ask(tables, ["nothing"], ["ticker"])


def test_only_named_tables_are_joined(tables):
    plan = star.query(star.FUND_STAR, tables, ["avg_close_price"], ["ticker"])._jdf.queryExecution()
    assert "provider_name" not in plan.optimizedPlan().toString()


def test_inventory_of_the_stars():
    assert (len(star.PRICE_STAR.dimensions), len(star.PRICE_STAR.metrics)) == (39, 7)
    assert (len(star.FUND_STAR.dimensions), len(star.FUND_STAR.metrics)) == (37, 10)
    assert sum(map(len, star.PRICE_STAR.links.values())) == 7
    assert sum(map(len, star.FUND_STAR.links.values())) == 10


# --- scope and questions --------------------------------------------------------------------


def test_scope(spark):
    etf = spark.createDataFrame(
        [("a", True, None), ("b", True, False), ("c", None, True), ("d", False, True)],
        "etf_key string, ucits_flag boolean, is_active boolean",
    )
    rows = spark.createDataFrame([(k, i) for k in "abcd" for i in range(2)], "etf_key string, n int")
    assert {tuple(r) for r in analyst.ucits_scope(rows, etf, "etf_key").collect()} == {("a", 0), ("a", 1)}


def test_latest_year(spark):
    days = [dt.date(2020, 1, 31), dt.date(2020, 2, 1), dt.date(2021, 1, 31)]
    df = spark.createDataFrame([(d,) for d in days], "full_date date")
    assert {r.full_date for r in analyst.latest_year(df).collect()} == {days[1], days[2]}


def test_questions(spark):
    etf = spark.createDataFrame(
        [("a", "A", 0.1, "g"), ("b", "B", 0.2, "g"), ("c", "C", 0.3, None)],
        "etf_key string, ticker string, ter double, equivalence_group_key string",
    )
    days = spark.createDataFrame(
        [("a", 20200101, 0.5, 0.1, -0.1), ("a", 20200102, 0.7, 0.2, -0.2), ("b", 20200101, None, 0.3, 0.0)],
        "etf_key string, date_key int, return_1y double, volatility_30d double, drawdown_52w double",
    )
    got = {tuple(r) for r in analyst.compare_funds(days, etf, ["A", "B"]).collect()}
    assert got == {("A", 20200102, 0.7, 0.2, -0.2, 0.1), ("B", 20200101, None, 0.3, 0.0, 0.2)}

    prices = spark.createDataFrame(
        [("a", dt.date(2019, 1, 1), 9.0, 99.0, 1.0), ("a", dt.date(2020, 5, 1), 5.0, 6.0, 4.0),
         ("a", dt.date(2020, 6, 1), 7.0, 8.0, 5.0)],
        "asset_key string, full_date date, close_price double, high_price double, low_price double",
    )
    (row,) = analyst.price_range(prices, etf, ["A"]).collect()
    assert (row.latest_close, row.high_12m, row.low_12m) == (7.0, 8.0, 4.0)

    group = spark.createDataFrame(
        [("g", "code", "G")],
        "equivalence_group_key string, equivalence_group_code string, equivalence_group_name string",
    )
    peers = {(r.ticker, r.peer_ticker, r.is_self) for r in analyst.peer_group(etf, group, etf.filter("ticker = 'A'")).collect()}
    assert peers == {("A", "A", True), ("A", "B", False)}


def test_latest_twelve_months_by_default(tables, spark):
    old = tables["etf_facts"].limit(1).selectExpr("20181231 as date_key", "etf_key", "999D as close_price", "return_1d",
                                                  "return_1m", "volatility_30d", "return_1y")
    both = {**tables, "etf_facts": tables["etf_facts"].unionByName(old)}
    assert ask(both, ["total_etf_records"], [], period=star.LATEST_YEAR) == {(): (4,)}
    assert ask(both, ["total_etf_records"], []) == {(): (5,)}
    named = star.query(star.FUND_STAR, both, ["total_etf_records"], [], "year_number is null", ["year_number"])
    assert named.first()[0] == 1  # a filter on dates stands for itself


def test_rows_and_values(tables):
    got = star.rows(star.FUND_STAR, tables, ["close_price", "etf_record"], ["ticker"], period=star.ALL_TIME).collect()
    assert sorted(map(tuple, got)) == [("T1", 10.0, 1)] * 2 + [("T2", 30.0, 1)] * 2
    got = star.rows(star.FUND_STAR, tables, ["sector_exposure_weight"], ["sector_name"], "ticker = 'T1'", ["ticker"]).collect()
    assert sorted(map(tuple, got)) == [("A", 50.0), ("B", 30.0), ("C", 20.0)]
    assert {tuple(r) for r in star.query(star.FUND_STAR, tables, [], ["provider_name"]).collect()} == {("P",)}
    pairs = star.query(star.FUND_STAR, tables, [], ["ticker", "sector_name"], "sector_name <> 'C'", ["sector_name"])
    assert {tuple(r) for r in pairs.collect()} == {("T1", "A"), ("T1", "B"), ("T2", "A")}
    with pytest.raises(ValueError, match="one table"):
        star.rows(star.FUND_STAR, tables, ["close_price", "sector_exposure_weight"], ["ticker"])
    with pytest.raises(ValueError, match="not reachable"):
        star.rows(star.FUND_STAR, tables, ["close_price"], ["sector_name"])
