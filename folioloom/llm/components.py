"""Connected components of an edge table by alternating large-star and small-star steps.

Each step joins edges to one minimum per node, so a node with very many edges is spread by adaptive
skew handling and its minimum is combined map-side. Every round is stored in the shared folder.
Up to ``MOST`` edges, 4 MB, are no work worth spreading: one task settles them. More are contracted first, each task
making a forest of the edges that it reads.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.session import write_once

MOST = 1 << 18


def smallest_reachable(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest node reachable from each of n by the links i - j."""
    root = np.arange(n)
    while True:
        x, y = root[i], root[j]
        low = np.minimum(x, y)
        if (x == y).all():
            return root
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        while (root[root] != root).any():
            root = root[root]


def forest(edges: DataFrame, most: int) -> DataFrame:
    """(a, b) with the same components inside every task; b is the smallest node that a reaches by a run of its edges."""

    def settled(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        a, b = (np.concatenate([x.column(k).to_numpy() for x in held]) for k in (0, 1))
        node, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = smallest_reachable(at[: len(a)], at[len(a) :], len(node))
        away = np.flatnonzero(root != np.arange(len(node)))
        return pa.RecordBatch.from_arrays([pa.array(node[away]), pa.array(node[root[away]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if n and n + len(batch) > most:
                yield settled(held)
                held, n = [], 0
            held.append(batch)
            n += len(batch)
        if n:
            yield settled(held)

    return edges.mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame, most: int = MOST) -> DataFrame:
    """(id, comp) for every node of edges (a, b); comp is the smallest node reachable."""
    pair = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    now = write_once(edges.select(*pair).filter("a <> b"), "components")
    if now.count() <= most:
        return labels(forest(now.coalesce(1), most))
    now = write_once(forest(now, most).distinct(), "components")
    state = mark(now)
    while True:
        both = now.union(now.selectExpr("b as a", "a as b"))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(low, "a").filter("b > a").selectExpr("b as a", "m as b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = joined.filter("b <> m").selectExpr("b as a", "m as b").union(joined.selectExpr("a", "m as b"))
        now = write_once(small.filter("a <> b").select(*pair).distinct(), "components")
        before, state = state, mark(now)
        if state == before:
            break
    return labels(now)


def labels(stars: DataFrame) -> DataFrame:
    roots = stars.select(F.col("b").alias("id")).distinct()
    return stars.selectExpr("a as id", "b as comp").union(roots.selectExpr("id", "id as comp"))


def mark(edges: DataFrame) -> tuple:
    """Count and checksum of the edges, to see whether a round changed any."""
    h = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h), F.sum(F.col("b").cast("decimal(38,0)"))).first())
