"""Layered tables as Parquet below one root."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Store:
    """Full-refresh tables below ``root``/<layer>/<name>, optionally registered in the catalog.

    Every load writes a folder of its own and becomes the table by one rename to the next version number, so
    there is no moment without a table, and a load that fails at any point leaves the old one. The version before the
    current one stays until the next load: who has begun to read it can finish. The rename is a single
    step in file systems whose rename is one (HDFS, local disks).
    """

    def __init__(self, spark: SparkSession, root: str, register: bool = False):
        self.spark, self.root, self.register = spark, root.rstrip("/"), register

    def path(self, layer: str, name: str) -> str:
        """Folder of the current version; the table's own folder, which holds no files, before any load."""
        versions = self.versions(layer, name)
        return f"{self.root}/{layer}/{name}" + (f"/{versions[-1]}" if versions else "")

    def versions(self, layer: str, name: str) -> list[str]:
        """Names of the stored versions, oldest first."""
        files, at = self._files(f"{self.root}/{layer}/{name}")
        if not files.exists(at):
            return []
        return sorted(n for n in (x.getPath().getName() for x in files.listStatus(at)) if n.startswith("v-"))

    def write(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        """Replace the table and return it as read back."""
        fresh = self._fresh(layer, name)
        df.write.parquet(fresh)
        self._publish(fresh, layer, name)
        return self.spark.read.schema(df.schema).parquet(self.path(layer, name))

    def replace(self, layer: str, name: str, df: DataFrame) -> int:
        """Load a raw table and return its rows; an empty input is an error and keeps the old table.

        The plan runs once, into a fresh folder, and its rows are counted on the way. The table is
        switched only after the write has succeeded, so a failed load keeps the old one too.
        """
        seen = Observation()
        fresh = self._fresh(layer, name)
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(fresh)
        rows = seen.get["rows"]
        if not rows:
            self._delete(fresh)
            raise ValueError(f"refusing to load empty table {layer}.{name}")
        self._publish(fresh, layer, name)
        return rows

    def _fresh(self, layer: str, name: str) -> str:
        return f"{self.root}/_loading/{layer}-{name}-{uuid.uuid4().hex}"

    def _publish(self, fresh: str, layer: str, name: str) -> None:
        """Make a written folder the table's newest version, then drop those before the last one."""
        old = self.versions(layer, name)
        number = int(old[-1][2:]) + 1 if old else 1
        self._rename(fresh, f"{self.root}/{layer}/{name}/v-{number:08}")
        if self.register:
            self._register(layer, name)
        for version in old[:-1]:
            self._delete(f"{self.root}/{layer}/{name}/{version}")

    def _register(self, layer: str, name: str) -> None:
        """Point the catalog's table to the current version; only a new schema needs a new entry."""
        at, table = self.path(layer, name), f"`{layer}`.`{name}`"
        self.spark.sql(f"create database if not exists `{layer}`")
        known = self.spark.catalog.tableExists(f"{layer}.{name}")
        if known and self.spark.table(table).schema == self.spark.read.parquet(at).schema:
            self.spark.sql(f"alter table {table} set location '{at}'")
            self.spark.catalog.refreshTable(f"{layer}.{name}")
            return
        self.spark.sql(f"drop table if exists {table}")
        self.spark.catalog.createTable(f"{layer}.{name}", at, "parquet")

    def _files(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _delete(self, path: str) -> None:
        files, at = self._files(path)
        files.delete(at, True)

    def _rename(self, source: str, target: str) -> None:
        files, at = self._files(source)
        to = self.spark._jvm.org.apache.hadoop.fs.Path(target)
        files.mkdirs(to.getParent())
        if files.exists(to) or not files.rename(at, to):
            raise OSError(f"could not move {source} to {target}")

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))

    def exists(self, layer: str, name: str) -> bool:
        try:
            self.read(layer, name)
        except AnalysisException:
            return False
        return True


def load_summary(prices: DataFrame) -> DataFrame:
    """Span and rows of each loaded ticker."""
    return (
        prices.groupBy("ticker")
        .agg(
            F.min("date").alias("min_date"),
            F.max("date").alias("max_date"),
            F.count(F.lit(1)).alias("row_count"),
        )
        .orderBy("ticker")
    )
