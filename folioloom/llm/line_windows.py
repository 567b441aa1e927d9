"""Line dedup over overlapping three-line windows.

Every run of three consecutive lines is hashed (128 bits). A window found in more than one place keeps
its first occurrence in the order (document id with nulls last, text hash, line); each later
occurrence covers its three lines, covered lines are merged and removed. Windows are judged on
the input, not on what is left, and windows without any visible character are not counted. A
document of fewer than three lines has no window and stays whole. A null text has no lines. Fully
equal rows are one document: neither removes the other. Other columns pass through.

Windows are reduced to one row per hash before the join (combined map-side), so the joined side is
unique and adaptive execution may split the many rows of a hot window. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINES = 3


def windows(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """(document, first line, two hashes) of every window; document is (no id, id, text hash)."""

    def at(i: Column) -> list[Column]:
        return [F.get("_lines", i + j) for j in range(lines)]

    split = docs.select(
        F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("hash")).alias("_doc"),
        F.split("text", "\n", -1).alias("_lines"),
    ).filter(F.size("_lines") >= lines)
    each = F.transform(
        F.sequence(F.lit(0), F.size("_lines") - lines),
        lambda i: F.struct(
            i.alias("at"),
            F.xxhash64(*at(i)).alias("k1"),
            F.xxhash64(F.lit(7), *reversed(at(i))).alias("k2"),
            F.concat(*at(i)).rlike(r"\S").alias("visible"),
        ),
    )
    rows = split.select("_doc", F.explode(F.filter(each, lambda x: x["visible"])).alias("_w"))
    return rows.select("_doc", F.col("_w.at").alias("_at"), F.col("_w.k1").alias("_k1"), F.col("_w.k2").alias("_k2"))


def dedup(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """``docs`` with later occurrences removed from ``text``, plus ``n_lines`` and ``n_removed``.

    Needs ``doc_id`` and ``text``; columns named like a result are replaced.
    """
    found = windows(docs, lines)
    place = F.struct("_doc", "_at")
    first = found.groupBy("_k1", "_k2").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n"))
    first = first.filter("_n > 1").drop("_n")
    later = found.join(first, ["_k1", "_k2"]).filter(place > F.col("_first"))
    # as many rows at most as the document has lines
    starts = later.groupBy("_doc").agg(F.collect_set("_at").alias("_starts"))
    starts = starts.select(
        F.col("_doc.doc_id").alias("_id"), F.col("_doc.hash").alias("_hash"), F.col("_starts")
    )
    keep = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    # the row travels packed, so that its column names meet no others
    rows = docs.select(F.struct(*keep).alias("_row"), "doc_id", F.xxhash64("text").alias("_h"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_hash"))
    text = F.col("_row.text")
    gone = F.flatten(F.transform("_starts", lambda s: F.sequence(s, s + lines - 1)))
    both = rows.join(starts, same, "left").select(
        "_row",
        F.coalesce(F.split(text, "\n", -1), F.array().cast("array<string>")).alias("_lines"),
        F.array_distinct(F.coalesce(gone, F.array().cast("array<int>"))).alias("_gone"),
    )
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    kept = F.when(F.size("_gone") > 0, F.array_join(F.transform(left, lambda i: F.get("_lines", i)), "\n")).otherwise(text)
    return both.select(
        *[kept.alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in keep],
        F.size("_lines").cast("bigint").alias("n_lines"),
        F.size("_gone").cast("bigint").alias("n_removed"),
    )


SQL = """
with d as (
  select doc_id, text, coalesce(string_split(text, chr(10)), []) as lines, row_number() over (order by doc_id, text) as r
  from documents),
w as (
  select r, i, lines[i:i+2] as k from (select r, lines, unnest(range(1, len(lines) - 1)) as i from d)
  where regexp_matches(array_to_string(lines[i:i+2], ''), '[^ \\t\\n\\x0B\\f\\r]')),
o as (select r, i, row_number() over (partition by k order by r, i) as nth from w),
g as (select distinct r, unnest([i, i + 1, i + 2]) as i from o where nth > 1),
s as (select r, list(i) as gone from g group by r)
select doc_id, cast(len(lines) as bigint) as n_lines, cast(coalesce(len(gone), 0) as bigint) as n_removed,
  sha256(coalesce(array_to_string(
    list_transform(list_filter(range(1, len(lines) + 1), lambda i: gone is null or not list_contains(gone, i)), lambda i: lines[i]),
    chr(10)), '')) as kept_sha256
from d left join s using (r)
"""
