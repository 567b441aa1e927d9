import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from folioloom.sources import landed
from folioloom.sources.store import Store, load_summary


def test_headers():
    assert landed.plain_names(["Fund Name", "fund-name", "", "2nd %", "__a__", "é", "UNNAMED"]) == [
        "fund_name", "fund_name_2", "unnamed", "_2nd", "a", "unnamed_2", "unnamed_3"
    ]
    assert landed.plain_names(["a", "a", "a_2"]) == ["a", "a_2", "a_2_2"]


def test_drop_empty(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, None, None), (None, None, "y")], "a int, `b c` int, d string")
    out = landed.drop_empty(df)
    assert out.columns == ["a", "d"] and out.count() == 2


def test_flags(spark):
    df = spark.createDataFrame([("Y",), ("0",), (None,), (" TRUE\t",)], "w string")
    assert [r.f for r in df.select(landed.parse_flag("w").alias("f")).collect()] == [True, False, None, True]
    bad = spark.createDataFrame([("maybe",)], "w string").select(landed.parse_flag("w"))
    with pytest.raises(PySparkException, match="maybe"):
        bad.collect()


def test_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c")], "v double, t string")
    assert [r.v for r in landed.nan_to_null(df).collect()] == [1.0, None, None]


def test_derived_types(spark):
    rows = [
        ("1", "1.5", "true", "2020-01-02", "2020-01-02 03:04:05", "x", None),
        ("0", "2", "FALSE", None, "2021-01-02 00:00:00", "1", None),
    ]
    df = spark.createDataFrame(rows, "i string, f string, b string, d string, t string, s string, n string")
    types = landed.derive_types(df)
    assert types == {
        "i": "bigint", "f": "double", "b": "boolean", "d": "date", "t": "timestamp_ntz", "s": "string", "n": "string"
    }
    assert landed.typed(df, types).first().d == dt.date(2020, 1, 2)


HEADER = "Ticker ,asset_name,asset_type,asset_subtype,region,country,currency,provider_name,exchange,IS_ACTIVE,desk"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_asset_master_file(spark, tmp_path):
    lines = [
        HEADER,
        "aapl,Old,Stock,,,,,,,no,d1",
        " AAPL ,New,Stock,,,,,,,,d2",
        ",Blank,Stock,,,,,,,yes,d3",
        "msft,M,Stock,,,,,,,N,d4",
    ]
    write(tmp_path / "m.csv", "\n".join(lines) + "\n")
    out = landed.read_asset_master(spark, str(tmp_path / "m.csv"))
    got = {r.ticker: r for r in out.collect()}
    assert out.columns[-2:] == ["is_active", "desk"] and set(got) == {"AAPL", "MSFT"}
    assert (got["AAPL"].asset_name, got["AAPL"].is_active, got["AAPL"].desk) == ("New", True, "d2")
    assert got["MSFT"].is_active is False
    assert {r.ticker for r in landed.active_tickers(out).collect()} == {"AAPL"}


def test_asset_master_keeps_the_last_row_of_a_large_file(spark, tmp_path):
    rows = [f"T{i % 7},name {i},Stock,,,,,,,yes,d" for i in range(50_000)]
    write(tmp_path / "m.csv", "\n".join([HEADER, *rows]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 200_000)
    try:
        got = {r.ticker: r.asset_name for r in landed.read_asset_master(spark, str(tmp_path / "m.csv")).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {f"T{i % 7}": f"name {i}" for i in range(49_993, 50_000)}


def test_asset_master_without_a_required_column(spark, tmp_path):
    write(tmp_path / "m.csv", "ticker,asset_name\nA,b\n")
    with pytest.raises(ValueError, match="exchange"):
        landed.read_asset_master(spark, str(tmp_path / "m.csv"))


def test_vendor_prices(spark, tmp_path):
    header = "Date,Open,High,Low,Close,Adj Close,Volume\n"
    write(tmp_path / "p/ticker=%5EGSPC/a.csv", header + "2021-01-04 00:00:00,1,2,0.5,1.5,1.4,10\n2021-01-05,NaN,,,2,2,\n")
    write(tmp_path / "p/ticker=OLD/a.csv", header + "2021-01-04,1,1,1,1,1,1\n")
    active = spark.createDataFrame([("^GSPC",), ("NODATA",)], "ticker string")
    rows = landed.read_prices(spark, str(tmp_path / "p"), active).orderBy("date").collect()
    assert [(r.ticker, r.date) for r in rows] == [("^GSPC", dt.date(2021, 1, 4)), ("^GSPC", dt.date(2021, 1, 5))]
    assert (rows[0].adj_close, rows[1].open, rows[1].volume) == (1.4, None, None)
    with pytest.raises(ValueError):
        landed.read_prices(spark, str(tmp_path / "p"), active.filter("ticker = 'NODATA'"))


def test_sheets(spark, tmp_path):
    write(tmp_path / "etf/a.csv", "ETF,Ticker,TER,Inception Date,Notes,Extra\nE1,A,0.1,2020-02-03,,x\n,,,,,\n")
    write(tmp_path / "geography/a.csv", "ETF,Geography,Exposure Weight\nE1,US,60.5\n")
    write(tmp_path / "sector/a.csv", "ETF,Sector,Exposure Weight\nE1,Tech,1\n")
    write(tmp_path / "equivalence_groups/a.csv", "Equivalence Group Code\ng\n")
    with pytest.raises(ValueError, match="equivalence_group_relationships"):
        landed.read_sheets(spark, str(tmp_path))
    write(tmp_path / "equivalence_group_relationships/a.csv", "Source Group Code,Target Group Code,Priority Rank\na,b,3\n")
    tables = landed.read_sheets(spark, str(tmp_path))
    (fund,) = tables["etf_metadata"].collect()
    assert (fund.ter, fund.inception_date, fund.notes, fund.extra) == (0.1, dt.date(2020, 2, 3), None, "x")
    assert tables["etf_geography"].first().exposure_weight == 60.5
    assert tables["equivalence_group_relationships"].first().priority_rank == 3
    assert tables["equivalence_groups"].columns[-1] == "description"


def test_texts(spark, tmp_path):
    write(tmp_path / "docs/e1.txt", "one\ntwo\n")
    write(tmp_path / "docs/sub dir/E2+x.TXT", "three")
    write(tmp_path / "docs/skip.md", "no")
    got = {r.relative_path: r.content for r in landed.read_texts(spark, str(tmp_path / "docs")).collect()}
    assert got == {"docs/e1.txt": "one\ntwo\n", "docs/sub dir/E2+x.TXT": "three"}


def test_seed(spark, tmp_path):
    write(tmp_path / "s.csv", "seed_id,seed_name,asset_group,is_active\n1,Sample Equity,Equity,true\n")
    assert tuple(landed.read_seed(spark, str(tmp_path / "s.csv")).first()) == (1, "Sample Equity", "Equity", True)


@pytest.mark.parametrize("register", [False, True])
def test_store(spark, tmp_path, register):
    store = Store(spark, str(tmp_path / "db"), register=register)
    layer = "raw_catalog" if register else "raw"
    df = spark.createDataFrame([(1,), (2,)], "a int")
    assert not store.exists(layer, "t")
    assert store.replace(layer, "t", df) == 2
    assert store.replace(layer, "t", df.filter("a = 2")) == 1
    with pytest.raises(ValueError):
        store.replace(layer, "t", df.filter("a = 3"))
    assert [r.a for r in store.read(layer, "t").collect()] == [2]
    if register:
        assert spark.table("raw_catalog.t").count() == 1
        spark.sql("drop database raw_catalog cascade")


def test_load_summary(spark):
    rows = [("B", dt.date(2020, 1, 2)), ("A", dt.date(2020, 1, 1)), ("B", dt.date(2020, 1, 1))]
    out = load_summary(spark.createDataFrame(rows, "ticker string, date date")).collect()
    assert [(r.ticker, r.row_count) for r in out] == [("A", 1), ("B", 2)]
    assert out[1].max_date == dt.date(2020, 1, 2)


def test_keep_last_is_combined_before_the_exchange(spark):
    df = spark.range(10).selectExpr("cast(id % 2 as string) as k", "id")
    out = landed.keep_last(df, "k", F.col("id"))
    assert {(r.k, r.id) for r in out.collect()} == {("0", 8), ("1", 9)}
    assert "partial_max_by" in out._jdf.queryExecution().executedPlan().toString()
