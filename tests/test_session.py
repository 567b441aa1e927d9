"""Where intermediates go, and loads that keep the old table."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from folioloom.session import clear_scratch, scratch_dir, scratch_path, write_once
from folioloom.sources import tpch
from folioloom.sources.store import Store


def session(master, configured=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: configured), sparkContext=context)


@pytest.mark.parametrize("master", ["spark://host:1", "yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(session(master))
    assert scratch_dir(session(master, "hdfs://x/shared/")) == "hdfs://x/shared"


def test_one_machine_may_use_its_own():
    assert "folioloom-" in scratch_dir(session("local[4]"))


def test_intermediates_can_be_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("folioloom.session.scratch_dir", lambda s: f"file://{tmp_path}")
    assert write_once(spark.range(3), "x").count() == 3 and scratch_path(spark, "y").startswith(f"file://{tmp_path}/")
    assert any(tmp_path.iterdir())
    clear_scratch(spark)
    assert not any(x for x in tmp_path.iterdir() if x.suffix != ".crc")


def test_replace_runs_once_and_keeps_the_old_table(spark, tmp_path):
    ran = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            ran.add(b.num_rows)
            yield b

    store = Store(spark, f"{tmp_path}/s")
    rows = spark.range(5).mapInArrow(count, "id bigint")
    assert store.replace("raw", "t", rows) == 5 and ran.value == 5
    with pytest.raises(ValueError):
        store.replace("raw", "t", spark.range(0))
    with pytest.raises(Exception, match="(?i)bad row"):
        store.replace("raw", "t", spark.range(3).select(F.raise_error(F.lit("bad row")).cast("bigint").alias("id")))
    assert store.read("raw", "t").count() == 5
    assert store.replace("raw", "t", spark.range(2)) == 2 and store.read("raw", "t").count() == 2


def test_a_load_that_dies_before_the_switch_keeps_the_old_table(spark, tmp_path, monkeypatch):
    store = Store(spark, f"{tmp_path}/s")
    store.replace("raw", "t", spark.range(5))

    def die(*_):
        raise OSError("lost")

    for load in (lambda: store.replace("raw", "t", spark.range(9)), lambda: store.write("raw", "t", spark.range(9))):
        with monkeypatch.context() as m:
            m.setattr(store, "_rename", die)
            with pytest.raises(OSError, match="lost"):
                load()
        assert store.read("raw", "t").count() == 5 and Store(spark, f"{tmp_path}/s").read("raw", "t").count() == 5
    assert store.replace("raw", "t", spark.range(9)) == 9 and store.read("raw", "t").count() == 9


def test_readers_of_the_version_before_can_finish(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    assert not store.exists("raw", "t") and store.versions("raw", "t") == []
    before = store.write("raw", "t", spark.range(3))
    after = store.write("raw", "t", spark.range(4))
    assert (before.count(), after.count(), store.read("raw", "t").count()) == (3, 4, 4)
    store.write("raw", "t", spark.range(5))
    assert store.versions("raw", "t") == ["v-00000002", "v-00000003"]


def test_registered_tables_follow_their_version(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s", register=True)
    try:
        store.replace("layer_of_versions", "t", spark.range(3))
        assert spark.table("layer_of_versions.t").count() == 3
        store.replace("layer_of_versions", "t", spark.range(4))
        assert spark.table("layer_of_versions.t").count() == 4
        store.write("layer_of_versions", "t", spark.range(2).selectExpr("id", "'x' as more"))
        assert spark.table("layer_of_versions.t").columns == ["id", "more"]
    finally:
        spark.sql("drop database if exists layer_of_versions cascade")


def test_line_order_is_exact(spark, tmp_path):
    """Parts that differ by 2**20 on one line, and order keys beyond 1e12."""
    day, big = dt.datetime(1998, 1, 1), 2_000_000_000_000
    line = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp_ntz"
    rows = [(big, 1_048_577, 1, 1, 1.0, 30.0, 0.0, day), (big, 1, 2, 1, 1.0, 20.0, 0.05, day), (big, 1, 1, 1, 1.0, 10.0, 0.05, day)]
    parts = [(1, "Brand#1", "t"), (1_048_577, "Brand#1", "t")]
    spark.createDataFrame(rows, line).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey bigint, p_brand string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    bar = tpch.asset_prices(spark, str(tmp_path)).first()
    assert (bar.open, bar.close, bar.adj_close) == (10.0, 30.0, 30.0)
