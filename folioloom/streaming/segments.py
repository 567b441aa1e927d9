"""A document index kept current by a file stream.

Changed documents land as Parquet rows (``DROP``). A refresh is a streaming run over the files that no earlier run has
read: texts become term rows, task by task, without an exchange, and are appended exactly once, under the number of
the run (a partition column). Nothing older is read or rewritten. A document's newest row wins by (modified, place of landing), so drops may
overlap, repeat or arrive late; a removed document leaves one row without terms.

A run's rows are a segment once a stored list names it, a version of its own per change (``Store``). The run after one
that was killed takes the same number and goes on where that one stopped; readers see neither before. When ``fan`` segments share a level they
are merged into one of the next, without rows that are outdated among them, so a row is rewritten about
log(segments) times and an index has few segments however often it is refreshed.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.operators.search import term_index
from folioloom.session import setting, write_once
from folioloom.sources.store import Store

DROP = "relative_path string, modified bigint, removed boolean, content string"
ROWS = "relative_path string, modified bigint, landed string, doc_len int, term string, tf bigint"
RUNS = "runs"
SEGMENTS = "segment string, number int, level int"
VERSION = ["relative_path", "modified", "landed"]


def drop_terms(drops: DataFrame) -> DataFrame:
    """Term rows (``ROWS``) of landed documents, streaming or not; a removed one gets a single row, its term null.

    ``landed`` tells rows apart that share path and time: file and row of the drop.
    """
    at = drops.metadataColumn("_metadata")
    landed = F.concat_ws(":", at["file_name"], F.format_string("%012d", at["row_index"]))
    removed = F.coalesce("removed", F.lit(False))
    doc = F.struct("relative_path", F.coalesce("modified", F.lit(0)).alias("modified"), landed.alias("landed"), removed.alias("gone"))
    text = F.when(~removed, F.col("content")).alias("content")
    terms = term_index(drops.filter("relative_path is not null").select(doc.alias("doc"), text), "doc")
    term = F.when(~F.col("doc.gone"), F.col("term")).alias("term")
    return terms.select(*(f"doc.{c}" for c in VERSION), "doc_len", term, "tf")


def current(rows: DataFrame, keep_removed: bool = False) -> DataFrame:
    """Rows of each document's newest version; removed documents go, or keep their one row.

    Only first rows (one per version) are grouped by path, and what is outdated, as a rule little, is left out of
    the term rows by an anti join whose small side has a known size. Terms are not exchanged while it is small.
    """
    firsts = rows.filter("term is null or term = ''").select(*VERSION, F.col("term").isNull().alias("gone"))
    newest = firsts.groupBy("relative_path").agg(
        F.max(F.struct("modified", "landed", "gone")).alias("top"), F.count(F.lit(1)).alias("versions")
    )
    stale = newest.filter("versions > 1" if keep_removed else "versions > 1 or top.gone")
    older = (F.col("modified") != F.col("top.modified")) | (F.col("landed") != F.col("top.landed"))
    out = firsts.join(stale, "relative_path").filter(older if keep_removed else older | F.col("top.gone"))
    return rows.join(write_once(out.select(*VERSION), "outdated"), VERSION, "left_anti")


class Segment(NamedTuple):
    segment: str
    number: int
    level: int


class SegmentIndex:
    """The index ``name`` of a store. One writer at a time; a second one fails when it seals."""

    def __init__(self, store: Store, name: str = "documents", fan: int = 4):
        self.store, self.spark, self.name, self.fan = store, store.spark, name, fan
        self.root, self.list = f"{store.root}/index/{name}", f"{name}_segments"

    def segments(self) -> list[Segment]:
        """Sealed segments (segment, number, level), a few rows."""
        if not self.store.versions("index", self.list):
            return []
        return [Segment(*r) for r in self.store.read("index", self.list).orderBy("number").collect()]

    def rows(self, segments: list[Segment]) -> DataFrame:
        """All rows of some segments; those of runs are read through the stream's own log of complete files."""
        merged = [f"{self.root}/{s.segment}" for s in segments if s.level]
        runs = [s.number for s in segments if not s.level]
        parts = [self.spark.read.schema(ROWS).parquet(*merged)] if merged else []
        if runs:
            landed = self.spark.read.schema(f"{ROWS}, run int").parquet(f"{self.root}/{RUNS}")
            parts.append(landed.filter(F.col("run").isin(runs)).drop("run"))
        return reduce(DataFrame.unionAll, parts) if parts else self.spark.createDataFrame([], ROWS)

    def terms(self) -> DataFrame:
        """(relative_path, doc_len, term, tf) of the documents as they are now: what the search reads."""
        return current(self.rows(self.segments())).select("relative_path", "doc_len", "term", "tf")

    def refresh(self, landing: str, files_per_batch: int = 1000) -> int:
        """Take in what has landed since the last run; returns the number of landed rows that were read."""
        sealed = self.segments()
        number = max((s.number for s in sealed), default=0) + 1
        drops = self.spark.readStream.schema(DROP).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
        terms = drop_terms(drops).withColumn("run", F.lit(number)).writeStream.format("parquet").partitionBy("run")
        terms = terms.option("checkpointLocation", f"{self.root}/_checkpoint").trigger(availableNow=True)
        # a task has one run, so one open file, and the sink need not sort its term rows by run; it would once the limit is reached
        with setting(self.spark, "spark.sql.maxConcurrentOutputFileWriters", "2"):
            run = terms.start(f"{self.root}/{RUNS}")
            run.awaitTermination()
        read = sum(p["numInputRows"] for p in run.recentProgress)
        files, at = self.store._files(f"{self.root}/{RUNS}/run={number}")
        if files.exists(at):  # not so if nothing has landed, in this run or one killed before
            self._seal([*sealed, Segment(f"{RUNS}/run={number}", number, 0)])
            self.merge()
        return read

    def merge(self) -> None:
        """Merge levels that have ``fan`` segments, lowest first."""
        while True:
            sealed = self.segments()
            levels = sorted({s.level for s in sealed})
            full = next((k for k in levels if sum(s.level == k for s in sealed) >= self.fan), None)
            if full is None:
                return
            chosen = [s for s in sealed if s.level == full]
            rest = [s for s in sealed if s.level != full]
            # a removal must outlive every older row of its document that some other segment may hold
            merged = current(self.rows(chosen), keep_removed=bool(rest))
            number = max(s.number for s in chosen)
            segment = f"m-{number:08}-{full + 1}"
            merged.write.mode("overwrite").parquet(f"{self.root}/{segment}")
            self._seal([*rest, Segment(segment, number, full + 1)])

    def _seal(self, segments: list[Segment]) -> None:
        """Publish a list of segments, then delete those that neither it nor the list before it names."""
        before = {s.segment for s in self.segments()}
        self.store.write("index", self.list, self.spark.createDataFrame(segments, SEGMENTS).coalesce(1))
        named = before | {s.segment for s in segments}
        last = max(s.number for s in segments)
        merged = [n for n in self._names(self.root) if n.startswith("m-")]
        runs = [f"{RUNS}/{n}" for n in self._names(f"{self.root}/{RUNS}") if n.startswith("run=") and int(n[4:]) <= last]
        for name in {*merged, *runs} - named:
            self.store._delete(f"{self.root}/{name}")

    def _names(self, path: str) -> list[str]:
        files, at = self.store._files(path)
        return [x.getPath().getName() for x in files.listStatus(at)]
