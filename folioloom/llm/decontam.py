"""Benchmark decontamination as a prefix-filtered set join with exact containment.

Windows are 13 consecutive item words (an item of fewer words is one window). Of all words only
five-word shingles meet the benchmark's (a window shorter than five words is one shingle): matching
ones are stored as (document, position, shingle). Their counts over the corpus order each window's
shingles by rarity. Full containment needs a prefix of one: a window is a candidate only where its
rarest shingle occurs, and a window with a shingle that occurs nowhere is dropped. Position
and length bounds fix where it would have to lie, and it is verified there by all its shingles at
their positions. Nothing but matching shingles is ever exchanged, texts never are.

The benchmark's shingles are broadcast only if their counted number is at most ``BROADCAST_ROWS``;
beyond, the same join runs over an exchange. Null texts have no words; null item ids
name the item ''; equal item ids are one item; fully equal rows are one document in
the join and both get its answer. Extra columns pass through. DataFrame functions only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from folioloom.session import write_once

#: What lies between words; splitting there costs a quarter of finding the words one by one.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW, SHINGLE = 13, 5
#: Of rows of (shingle, length), 20 bytes each.
BROADCAST_ROWS = 1 << 20
DOC = ["_id", "_hash", "_bytes"]


def lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words_of(text: Column) -> Column:
    """Lower-cased words; a text that begins or ends between words has an empty part there."""
    return F.array_remove(F.split(lowered(text), BETWEEN), "")


def n_words_of(text: Column) -> Column:
    return F.coalesce(F.size(F.array_remove(F.split(text, BETWEEN), "")), F.lit(0)).cast("bigint")


def shingles(words: str, k: int) -> Column:
    """Hashes of every k consecutive words of an array column."""
    each = F.transform(
        F.sequence(F.lit(0), F.size(words) - k), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)])
    )
    return F.when(F.size(words) >= k, each)


def windows(items: DataFrame, window: int) -> DataFrame:
    """(item, window words) of every window."""
    split = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("_w"))
    split = split.filter(F.size("_w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("_w") - window + 1))
    return split.select("item", F.explode(F.transform(starts, lambda i: F.slice("_w", i, window))).alias("words"))


def by_length(rows: DataFrame, words: str, lengths: list[int], *keep: str) -> DataFrame:
    """Rows of (keep, k, position, shingle); all lengths come out of one pass."""
    found = [
        F.coalesce(
            F.transform(shingles(words, k), lambda h, i: F.struct(F.lit(k).alias("k"), i.alias("pos"), h.alias("sh"))),  # noqa: B023
            F.array().cast("array<struct<k:int,pos:int,sh:bigint>>"),
        )
        for k in lengths
    ]
    return rows.select(*keep, F.inline(F.concat(*found) if len(found) > 1 else found[0]))


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Verified (document, start, len, wid), and (wid, item)."""
    found = write_once(
        windows(items, window)
        .withColumn("wid", F.xxhash64(F.size("words"), "words"))
        .withColumn("k", F.least(F.lit(SHINGLE), F.size("words"))),
        "decontam-windows",
    )
    lengths = sorted(r[0] for r in found.select("k").distinct().collect())  # at most SHINGLE values
    distinct = found.select("wid", "words", "k").dropDuplicates(["wid"])
    parts = [
        by_length(distinct.filter(F.col("k") == k), "words", [k], "wid", F.size("words").alias("len")) for k in lengths
    ]
    empty = found.limit(0).selectExpr("wid", "0 as len", "k", "0 as pos", "wid as sh")
    of_window = empty
    for p in parts:
        of_window = of_window.unionByName(p)
    of_window = write_once(of_window, "decontam-shingles")
    wanted = of_window.select("k", "sh").distinct()
    n = wanted.count()
    keys = docs.filter(F.col("text").isNotNull()).select(
        F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"), F.octet_length("text").alias("_bytes"),
        words_of(F.col("text")).alias("_w"),
    )
    if lengths:
        seen = by_length(keys.withColumn("_n", F.size("_w")), "_w", lengths, *DOC, "_n")
    else:
        seen = keys.limit(0).selectExpr(*DOC, "0 as _n", "0 as k", "0 as pos", "_hash as sh")
    hits = seen.join(F.broadcast(wanted) if n <= BROADCAST_ROWS else wanted, ["k", "sh"], "left_semi")
    hits = write_once(hits.dropDuplicates([*DOC, "k", "pos"]), "decontam-hits")
    # rarity over the whole corpus; a window needs all its shingles
    rarity = hits.groupBy("k", "sh").agg(F.count(F.lit(1)).alias("freq"))
    ranked = of_window.join(rarity, ["k", "sh"], "left")
    prefix = (
        ranked.groupBy("wid", "len", "k")
        .agg(F.min(F.struct("freq", "sh", "pos")).alias("first"), F.count(F.lit(1)).alias("need"), F.count("freq").alias("have"))
        .filter("need = have")
        .selectExpr("wid", "len", "k", "need", "first.sh as sh", "first.pos as offset")
    )
    candidates = hits.join(prefix, ["k", "sh"]).selectExpr(*DOC, "_n", "wid", "len", "k", "need", "pos - offset as start")
    candidates = candidates.filter("start >= 0 and start + len <= _n").drop("_n")
    expected = candidates.join(of_window.select("wid", F.col("pos").alias("_off"), "sh"), "wid")
    expected = expected.withColumn("pos", F.col("start") + F.col("_off"))
    on = expected["_id"].eqNullSafe(hits["_id"])
    for c in ("_hash", "_bytes", "k", "pos", "sh"):
        on &= expected[c] == hits[c]
    proven = expected.join(hits, on, "left_semi").groupBy(*DOC, "wid", "len", "start", "need")
    proven = proven.agg(F.count(F.lit(1)).alias("got")).filter("got = need").select(*DOC, "wid", "len", "start")
    return write_once(proven, "decontam-proven"), found.select("wid", "item").distinct()


def judge(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256 and contaminated.

    A document is contaminated if any word is hit and ``share`` x hit words reach its words.
    """
    proven, named = matches(docs, items, window)
    # covered words: each interval adds what reaches beyond the ones before it
    before = W.partitionBy(*DOC).orderBy("start", "len").rowsBetween(W.unboundedPreceding, -1)
    spans = proven.select(*DOC, "start", "len").distinct()
    reach = F.greatest(F.col("start"), F.coalesce(F.max(F.col("start") + F.col("len")).over(before), F.lit(0)))
    spans = spans.withColumn("_add", F.greatest(F.lit(0), F.col("start") + F.col("len") - reach))
    hit = spans.groupBy(*DOC).agg(F.sum("_add").alias("_hit"))
    in_doc = proven.select(*DOC, "wid").distinct().join(named, "wid").select(*DOC, "item").distinct()
    listed = in_doc.groupBy(*DOC).agg(F.sort_array(F.collect_set("item")).alias("_items"))
    other = ["_id2", "_hash2", "_bytes2"]
    listed = listed.select(*[F.col(c).alias(o) for c, o in zip(DOC, other, strict=True)], "_items")
    result = hit.join(listed, same_document(*DOC, *other)).select(*DOC, "_hit", "_items")
    out = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    # the row travels packed, so that its column names meet no others
    mine = docs.select(
        F.struct(*[c for c in docs.columns if c.lower() not in out]).alias("_row"),
        "doc_id",
        n_words_of(F.col("text")).alias("n_words"),
        F.xxhash64("text").alias("_h"),
        F.octet_length("text").alias("_b"),
    )
    both = mine.join(result, same_document("doc_id", "_h", "_b", *DOC), "left")
    n_hit = F.coalesce("_hit", F.lit(0)).cast("bigint")
    ids = F.coalesce("_items", F.array().cast("array<string>"))
    return both.select(
        "_row.*",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def same_document(a: str, b: str, c: str, x: str, y: str, z: str) -> Column:
    return F.col(a).eqNullSafe(F.col(x)) & (F.col(b) == F.col(y)) & (F.col(c) == F.col(z))


SQL = r"""
with d as (
  select doc_id, row_number() over () as r,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') as w
  from documents),
b as (
  select cast(item_id as varchar) as item,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') as w
  from benchmark),
win as (
  select item, w[i:i+12] as k from (select item, w, unnest(range(1, greatest(2, len(w) - 11))) as i from b where len(w) > 0)),
size as (select distinct len(k) as n from win),
spot as (select r, n, w, unnest(range(1, len(w) - n + 2)) as i from d, size where len(w) >= n),
hit as (select r, i, n, item from spot join win on w[i:i+n-1] = k),
pos as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hit) group by r),
it as (select r, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct r, item from hit) group by r)
select doc_id, cast(coalesce(len(w), 0) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) as contaminated
from d left join pos using (r) left join it using (r)
"""
