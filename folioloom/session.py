"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def builder(app: str = "folioloom", master: str | None = None) -> SparkSession.Builder:
    """Session settings this library relies on; cluster sizing stays with the submitter."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    return b.master(master) if master else b


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting that holds inside a with block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder named by the cluster.

    A machine-local folder serves only where one machine does all the work: elsewhere executors would each
    write to a disk of their own and later reads would miss rows without noticing.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="folioloom-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def session_dir(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    return f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{session_dir(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediates; DataFrames that read them are of no use afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(session_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_once(df: DataFrame, label: str) -> DataFrame:
    """Store ``df`` as Parquet in the shared folder and read it back.

    Used where one intermediate feeds several branches of a plan: the branches then
    scan a pruned columnar file instead of each repeating the joins and windows below,
    and a lost executor re-reads the file rather than replaying the lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
