import datetime as dt

from folioloom.plans.catalog import MODELS, Models
from folioloom.sources.store import Store

DAYS = 300


def raw_tables(spark):
    master = (
        "ticker string, asset_name string, asset_type string, asset_subtype string, region string, "
        "country string, currency string, provider_name string, exchange string, is_active boolean"
    )
    assets = [(t, t, kind, None, None, None, None, None, None, None) for t, kind in (("A", "ETF"), ("B", "FX"))]
    prices = spark.range(DAYS).selectExpr(
        "explode(array('A', 'B')) as ticker", "date_add(date'2020-01-01', cast(id as int)) as date",
        "10D + id % 7 as open", "null as high", "null as low", "10D + id % 7 as close", "null as adj_close", "1D as volume",
    )
    text = (
        "etf ticker isin fund_name provider index equivalence_group_code relationship_to_group asset_class "
        "category distribution_type replication_method currency domicile hedged_flag ucits_flag is_active notes"
    ).split()
    fund = {"etf": "E1", "ticker": "A", "index": "FTSE_X", "equivalence_group_code": "g", "ucits_flag": "yes"}
    funds = spark.createDataFrame(
        [tuple(fund.get(c) for c in text) + (0.1, dt.date(2019, 1, 1))],
        ", ".join(f"{c} string" for c in text) + ", ter double, inception_date date",
    )
    exposure = "etf string, {0} string, exposure_weight double"
    groups = "equivalence_group_code equivalence_group_name group_type canonical_exposure description".split()
    return {
        "asset_master": lambda: spark.createDataFrame(assets, master),
        "asset_prices": lambda: prices,
        "etf_metadata": lambda: funds,
        "etf_geography": lambda: spark.createDataFrame([("E1", "US", 100.0)], exposure.format("geography")),
        "etf_sector": lambda: spark.createDataFrame([("E1", "Tech", 100.0)], exposure.format("sector")),
        "equivalence_groups": lambda: spark.createDataFrame(
            [("G", "Group", "x", "y", "z")], ", ".join(f"{c} string" for c in groups)
        ),
        "equivalence_group_relationships": lambda: spark.createDataFrame(
            [("g", "h", "t", 1, None)],
            "source_group_code string, target_group_code string, relationship_type string, priority_rank int, notes string",
        ),
    }


def test_stored_build_slices_long_series_and_equals_the_lazy_one(spark, tmp_path):
    lazy = Models(raw_tables(spark))
    stored = Models(raw_tables(spark), store=Store(spark, str(tmp_path)), slice_rows=260)
    names = ["mart_asset_risk", "mart_asset_moves", "dim_asset_classification", "daily_prices"]
    built = stored.build(names, threads=3)
    assert "trend_label" in stored.series_prices.columns
    for name in names:
        assert (tmp_path / MODELS[name][0] / name).is_dir()
        assert built[name].columns == lazy[name].columns
        assert sorted(map(str, built[name].collect())) == sorted(map(str, lazy[name].collect()))
    assert built["daily_prices"].count() == DAYS
