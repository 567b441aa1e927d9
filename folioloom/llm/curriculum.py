"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight and a schedule: a piecewise linear factor over training time 0 to 1 with mean
1. Its demand at time t is target x factor(t), so cumulative demand is the integral of the schedule, a
quadratic in each piece. A document (or its second copy) starts at some number of words of its source;
inverting cumulative demand there gives its training position, and rows are range-sorted by position.

Targets: the sources in code-point order, null last, weigh ``weights``, repeating, and share
``share`` of all words; a target stops at ``most`` times its source, and the excess is shared anew by weight
until none is above. A copy is taken if its middle lies within the target, so a source misses its
target by half a document at most and no document is taken more than ``most`` times. Order within
a source is a hash of the id, so reruns agree.

A source may hold a third of all rows: running sums are taken within (source, hash bucket) and
shifted by the sums of earlier buckets; the number of buckets follows the rows. Null text has
size 0. Documents of size 0 count as taken where their place is, with 0 words. Fully equal rows are
separate documents. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioloom.llm.frames import WORD, numbered
from folioloom.session import write_once

BUCKET_ROWS = 1 << 16


@dataclass(frozen=True)
class Plan:
    """Weights by rank of source, the factor of each weight at evenly spaced times, and the limits."""

    weights: tuple[int, ...] = (5, 2, 1)
    factors: tuple[tuple[float, ...], ...] = ((0.6, 1.0, 1.4), (1.0, 1.0, 1.0), (1.4, 1.0, 0.6))
    share_halves: int = 3  # 150 %
    most: int = 2


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"({WORD})")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """(source, source_size, n, weight, class, target) from rows of (source, size)."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    ranked, _ = numbered(totals, [F.col("source").asc_nulls_last()], "_rank", "mix-sources")
    kind = (F.col("_rank") % len(plan.weights)).cast("int")
    ranked = ranked.withColumns({"class": kind, "weight": F.get(F.array(*map(F.lit, plan.weights)), kind)})
    cap = F.col("source_size") * plan.most
    level = 0.0
    while True:
        # sources above the level so far keep their cap; the rest share what is left by weight
        full = cap.cast("double") < level * F.col("weight")
        halves, weight = ranked.agg(
            F.sum(F.col("source_size") * plan.share_halves) - 2 * F.sum(F.when(full, cap).otherwise(0)),
            F.sum(F.when(~full, F.col("weight")).otherwise(0)),
        ).first()
        after = halves / 2 / weight if weight else level
        if after <= level:
            break
        level = after
    return ranked.drop("_rank").withColumn("target", F.least(cap.cast("double"), level * F.col("weight")))


def time_of(done: Column, target: Column, kind: Column, plan: Plan = Plan()) -> Column:
    """Time at which cumulative demand reaches ``done`` words."""
    share = F.when(target > 0, done / target).otherwise(0.0)
    out = F.lit(None).cast("double")
    for k, factors in enumerate(plan.factors):
        step = 1.0 / (len(factors) - 1)
        mean = sum((a + b) / 2 * step for a, b in pairwise(factors))
        reached, pieces = 0.0, []
        for i, (a, b) in enumerate(pairwise([f / mean for f in factors])):
            # within the piece: reached + a x + (b - a) / (2 step) x^2, solved for x
            need = share - reached
            bend = (b - a) / step
            x = (F.sqrt(F.greatest(F.lit(0.0), a * a + 2 * bend * need)) - a) / bend if bend else need / a
            reached += (a + b) / 2 * step
            pieces.append((reached, i * step + F.least(F.lit(step), F.greatest(F.lit(0.0), x))))
        at = pieces[-1][1]
        for end, x in reversed(pieces[:-1]):
            at = F.when(share < end, x).otherwise(at)
        out = F.when(kind == k, at).otherwise(out)
    return out


def plan_copies(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """``docs`` (doc_id, source, size and any more) with source_size, target, copies, taken and positions.

    ``positions`` holds one training position per copy.
    """
    narrow = write_once(docs.select("doc_id", "source", "size"), "mix-sizes")
    aims = write_once(targets(narrow, plan), "mix-targets")
    rows = aims.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    digits = 1
    while rows > BUCKET_ROWS * 16**digits:
        digits += 1
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    bucket = F.substring(key, 1, digits)
    earlier = W.partitionBy("source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = narrow.groupBy("source", bucket.alias("_bucket")).agg(F.sum("size").alias("_sum"))
    sums = sums.select("source", "_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    same = F.col("source").eqNullSafe(F.col("_source"))
    offsets = sums.join(aims.withColumnRenamed("source", "_source"), same).drop("_source")
    offsets = offsets.select(F.col("source").alias("_source"), F.col("_bucket").alias("_b"), "_before", "source_size",
                             "target", "class")
    drop = {"source_size", "target", "class", "copies", "taken", "positions"}
    mine = docs.select(*[c for c in docs.columns if c.lower() not in drop], key.alias("_key"), bucket.alias("_bucket"))
    within = (
        W.partitionBy("source", "_bucket").orderBy("_key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    )
    mine = mine.withColumn("_at", F.coalesce(F.sum("size").over(within), F.lit(0)))
    both = mine.join(offsets, same & (F.col("_bucket") == F.col("_b")))
    start = F.col("_before") + F.col("_at")
    middle = [start + i * F.col("source_size") + F.col("size") / 2 for i in range(plan.most)]
    took = [(m <= F.col("target")).cast("int") for m in middle]
    copies = sum(took[1:], took[0])
    positions = F.array(
        *[F.when(t == 1, time_of(m, F.col("target"), F.col("class"), plan)) for m, t in zip(middle, took, strict=True)]
    )
    return both.withColumns(
        {
            "copies": copies,
            "taken": (copies * F.col("size")).cast("bigint"),
            "positions": F.filter(positions, lambda x: x.isNotNull()),
        }
    ).drop("_key", "_bucket", "_at", "_source", "_b", "_before", "class")


def mix(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Taken copies of whole documents with ``position`` (replaced if there), range-sorted by it."""
    row = F.struct(*docs.drop("position").columns).alias("_row")
    sized = docs.select(row, "doc_id", "source", size_of(F.col("text")).alias("size"))
    taken = plan_copies(sized, plan).select("_row", F.explode("positions").alias("position"))
    return by_position(taken.select("_row.*", "position"))


def positions(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """(doc_id, source, size, copy, position) of every taken copy, range-sorted by position, without texts."""
    sized = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"))
    taken = plan_copies(sized, plan).select("doc_id", "source", "size", F.posexplode("positions").alias("copy", "position"))
    return by_position(taken)


def schedule(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """(doc_id, size, source_size, target, taken, positions) of every row, range-sorted by first position.

    Rows that the mix does not take come last. Sizes are stored once, so that texts are read once.
    """
    sized = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"))
    planned = plan_copies(write_once(sized, "mix-documents"), plan)
    first = [F.get("positions", F.lit(0)).asc_nulls_last(), F.col("doc_id").asc()]
    out = planned.select("doc_id", "size", "source_size", "target", "taken", "positions")
    return out.repartitionByRange(*first).sortWithinPartitions(*first)


def by_position(rows: DataFrame) -> DataFrame:
    return rows.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


PLANNED = r"""
with d as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')), 0) as bigint) as size,
    md5(coalesce(cast(doc_id as varchar), '')) as key, row_number() over () as row
  from documents),
s as (
  select source, sum(size)::bigint as source_size, (row_number() over (order by source nulls last) - 1) % 3 as class,
    [5, 2, 1][class + 1] as weight
  from d group by source),
c as (
  select *, row_number() over (order by 2 * source_size / weight::double, source nulls last) as k from s),
l as (
  select k, 2 * source_size / weight::double as ratio,
    (sum(source_size) over () * 3 - 2 * coalesce(sum(2 * source_size) over (order by k rows between unbounded preceding and 1 preceding), 0))::double
      / 2 / (sum(weight) over (order by k rows between current row and unbounded following))::double as level
  from c),
t as (
  select source, source_size, class, least((2 * source_size)::double, weight * (select level from l where level <= ratio order by k limit 1)) as target
  from s),
o as (
  select *, coalesce(sum(size) over (partition by source order by key, doc_id, size rows between unbounded preceding and 1 preceding), 0) as done
  from d),
m as (
  select row, doc_id, o.source, size, t.source_size, target, class, unnest([0, 1]) as copy,
    done + copy * t.source_size + size / 2 as middle, middle <= target as takes,
    case when target > 0 then middle / target else 0.0::double end as x
  from o join t on o.source is not distinct from t.source),
p as (
  -- demand x of the schedules 0.6 to 1.4, level, and 1.4 to 0.6, two pieces each, inverted
  select *, case when takes then round(case class
    when 0 then case when x < 0.4 then greatest(0, least(0.5, (sqrt(0.36 + 1.6 * x) - 0.6) / 0.8))
      else 0.5 + greatest(0, least(0.5, (sqrt(greatest(0, 1 + 1.6 * (x - 0.4))) - 1) / 0.8)) end
    when 1 then least(1, x)
    else case when x < 0.6 then greatest(0, least(0.5, (1.4 - sqrt(1.96 - 1.6 * x)) / 0.8))
      else 0.5 + greatest(0, least(0.5, (1 - sqrt(greatest(0, 1 - 1.6 * (x - 0.6)))) / 0.8)) end
    end, 9) end as position
  from m)
"""

SQL = PLANNED + """
select doc_id, size, source_size, target,
  cast(size * count(position) as bigint) as taken,
  max(position) filter (copy = 0) as position_1, max(position) filter (copy = 1) as position_2
from p group by row, doc_id, size, source_size, target
"""

POSITIONS_SQL = PLANNED + "select doc_id, source, size, copy, position from p where takes"
