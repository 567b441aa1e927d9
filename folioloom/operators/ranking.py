"""Row numbers inside groups that may be too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioloom.session import write_once


def position_in_group(df: DataFrame, group: str, order: list[Column], out: str) -> DataFrame:
    """1-based position of each row inside ``group`` under a total ``order``, without a task per group.

    All rows are dealt by range of (group, order), sorted within their range and stored, which
    numbers them globally once each range's row count (one short row per partition) is added up. A
    group's first number is a partial minimum; the position is the distance from it. Ranges follow the
    data, so neither a large group nor many equal values gather in one task.
    """
    part, at, first = "_part", "_at", "_first"
    keys = [F.col(group), *order]
    dealt = write_once(df, "unranked").repartitionByRange(*keys).sortWithinPartitions(*keys)
    kept = write_once(dealt.withColumn(at, F.monotonically_increasing_id()), "ranked")
    kept = kept.withColumn(part, F.shiftright(at, 33)).withColumn(at, F.col(at).bitwiseAND(F.lit((1 << 33) - 1)))
    before = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    counts = kept.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select(part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    # one row per partition of the exchange: small by that bound
    numbered = kept.join(F.broadcast(offsets), part).withColumn(at, F.col(at) + F.col("_offset"))
    starts = numbered.groupBy(F.col(group).alias("_group")).agg(F.min(at).alias(first))
    joined = numbered.join(starts, F.col(group).eqNullSafe(F.col("_group")))
    return joined.withColumn(out, F.col(at) - F.col(first) + 1).drop(part, at, "_offset", "_group", first)
