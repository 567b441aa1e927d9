"""Substring dedup with one compressed FM-index per shard.

A window is ``window`` consecutive words. Each window belongs to the smallest hash among its word
``gram``-grams, its anchor, and equal windows have equal anchors; runs of windows with one anchor form a
segment. Shards are cut by anchor, so all occurrences of a window meet in one shard and the work is linear in
the text, not documents times shards. Per shard the distinct segments are indexed (wavelet matrix over their
Burrows-Wheeler transform) and streamed against the index by backward search; windows that match to full
length report their suffix interval, and the smallest document in it decides.

Anchors of a single text cannot hold a repeat across texts and are left out; an anchor met more than
``hot`` times (a common phrase) is cut further, into its single windows, dealt by the hash of their
words. Shards hold about ``shard_words`` words whatever the input. Equal texts are handled through the one
with the smallest id: all windows of the others also start there.

Every word covered by a window that also starts in a document with a smaller id is removed; windows are
judged on the input. Null ids count as larger than all others; rows of one id do not remove each other's words.
Null texts have no words. Extra columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.llm import fm_index, words
from folioloom.llm.frames import fresh
from folioloom.session import write_once

LAST = (1 << 63) - 1


@dataclass(frozen=True)
class Settings:
    window: int = 13
    gram: int = 4
    hot: int = 2000
    shard_words: int = 200_000


def anchored(p: words.Piece, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, anchor, first window, windows) of every segment of a piece."""
    h = p.word_hashes()
    g = words.grams(h, s.gram)
    n = len(h) - s.window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return h, none.astype(np.uint64), none, none
    span = s.window - s.gram + 1
    low, width = g, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    anchor = np.minimum(low[:n], low[span - width : span - width + n])
    ok = words.inside(p.word_at, len(h), s.window)
    new = ok.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~ok[:-1]
    # documents that touch: the window before is inside the earlier one only if the words between are, so
    # a run never crosses an edge (positions around it are not inside any document)
    first = np.flatnonzero(new)
    stop = np.flatnonzero(~ok)
    after = np.concatenate([first[1:], [n]])
    if len(stop):
        at = np.searchsorted(stop, first)
        end = np.where(at < len(stop), stop[np.minimum(at, len(stop) - 1)], n)
        after = np.minimum(after, end)
    return h, anchor[first], first, after - first


def by_text(docs: DataFrame) -> DataFrame:
    """(d, th, raw): id with null as the largest, text hash, bytes."""
    return docs.filter(F.col("text").isNotNull()).select(
        id_of(F.col("doc_id")).alias("d"), F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("raw")
    )


def id_of(doc_id: Column) -> Column:
    return F.coalesce(doc_id, F.lit(LAST))


def anchors(rows: DataFrame, s: Settings) -> DataFrame:
    """(h, th): anchors of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            th = batch.column(0).to_numpy()
            for p in words.pieces(batch.column(1)):
                _, anchor, first, _ = anchored(p, s)
                doc = p.first + np.searchsorted(p.word_at, first, side="right") - 1
                cols = [pa.array(anchor.view(np.int64)), pa.array(th[doc])]
                yield pa.RecordBatch.from_arrays(cols, ["h", "th"])

    return rows.select("th", "raw").mapInArrow(run, "h bigint, th bigint")


def segments(rows: DataFrame, s: Settings) -> DataFrame:
    """(d, th, at, key, content) of the segments of (d, th, raw, hs, hots) whose anchor is in hs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, th = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            known, hot = tagged(batch.column(3)), tagged(batch.column(4))
            for p in words.pieces(batch.column(2)):
                h, anchor, first, count = anchored(p, s)
                doc = np.searchsorted(p.word_at, first, side="right") - 1
                tag = words.mix(anchor + (p.first + doc).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                keep = np.flatnonzero(np.isin(tag, known))
                split = np.isin(tag[keep], hot)
                raw = h.tobytes()
                out: list[tuple[int, int, int, bytes]] = []
                for i, single in zip(keep.tolist(), split.tolist(), strict=True):
                    a, n, at = int(first[i]), int(count[i]), int(first[i] - p.word_at[doc[i]])
                    if not single:
                        out.append((int(doc[i]), at, int(anchor[i]), raw[8 * a : 8 * (a + n - 1 + s.window)]))
                    else:
                        for j in range(n):
                            out.append((int(doc[i]), at + j, 0, raw[8 * (a + j) : 8 * (a + j + s.window)]))
                if out:
                    owner = p.first + np.array([x[0] for x in out])
                    key = np.array([x[2] for x in out], np.uint64).view(np.int64)
                    cols = [pa.array(d[owner]), pa.array(th[owner]), pa.array([x[1] for x in out], pa.int32()),
                            pa.array(key), pa.array([x[3] for x in out], pa.binary())]
                    yield pa.RecordBatch.from_arrays(cols, ["d", "th", "at", "key", "content"])

    found = rows.select("d", "th", "raw", "hs", "hots").mapInArrow(
        run, "d bigint, th bigint, at int, key bigint, content binary"
    )
    # windows of a hot anchor are dealt by their own words
    return found.withColumn("sid", F.xxhash64("content")).withColumn("key", F.when(F.col("key") == 0, F.col("sid")).otherwise(F.col("key")))


def tagged(lists: pa.Array) -> np.ndarray:
    """Anchors of a list column, each bound to its row."""
    values = lists.values.to_numpy(zero_copy_only=False)[lists.offsets[0].as_py() : lists.offsets[-1].as_py()].astype(np.int64)
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    return words.mix(values.view(np.uint64) + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def search(group: pa.Table, s: Settings) -> pa.Table:
    """Index the distinct segments of a shard, stream them, and give each window its smallest document."""
    buf, at = words.column(group.column("content"))
    lengths = np.diff(at) // 8
    _, code = np.unique(np.frombuffer(buf[at[0] : at[-1]].tobytes(), np.uint64), return_inverse=True)
    index = fm_index.Index(code + 1, lengths)
    first, low, high = fm_index.matching(index, s.window)
    d, met = group.column("d").to_numpy(), group.column("met").to_numpy()
    least = fm_index.smallest(index, d, first, low, high)
    n_windows = np.maximum(lengths - s.window + 1, 0)
    ends = np.cumsum(n_windows)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(least))
    # of no use: met in one document, and no window of it is in an earlier one
    useful = met > 1
    useful[np.repeat(np.arange(len(d)), n_windows)[least < np.repeat(d, n_windows)]] = True
    columns = [group.column("key").combine_chunks(), group.column("sid").combine_chunks(), lists]
    return pa.Table.from_arrays(columns, ["key", "sid", "least"]).filter(pa.array(useful))


def repeats(docs: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """(th, first_d): the smallest id of each text; (th, starts): repeated windows of that document."""
    rows = by_text(docs)
    firsts = rows.groupBy("th").agg(F.min("d").alias("first_d"))
    found = anchors(rows, s)
    shared = found.groupBy("h").agg(F.min("th").alias("x"), F.max("th").alias("y"), F.count(F.lit(1)).alias("n"))
    shared = write_once(shared.filter("x <> y").select("h", (F.col("n") > s.hot).alias("is_hot")), "substring-anchors")
    mine = found.join(shared, "h").groupBy("th").agg(
        F.collect_set("h").alias("hs"), F.collect_set(F.when(F.col("is_hot"), F.col("h"))).alias("hots")
    )
    wanted = mine.join(firsts, "th")
    texts = rows.join(wanted, "th").filter("d = first_d")
    cut = write_once(segments(texts, s), "substring-segments")
    distinct = cut.groupBy("key", "sid", "content").agg(F.min("d").alias("d"), F.count(F.lit(1)).alias("met"))
    n_words = cut.agg(F.sum(F.octet_length("content") / 8)).first()[0] or 0
    shard = F.pmod(F.xxhash64("key"), F.lit(int(n_words // s.shard_words) + 1))
    least = distinct.groupBy(shard.alias("shard")).applyInArrow(
        lambda group: search(group, s), "key bigint, sid bigint, least array<bigint>"
    )
    least = write_once(least, "substring-least")
    hits = F.transform("least", lambda m, i: F.when(m < F.col("d"), F.col("at") + i))
    starts = cut.select("d", "th", "at", "key", "sid").join(least, ["key", "sid"])
    starts = starts.select("th", F.filter(hits, lambda x: x.isNotNull()).alias("starts")).filter(F.size("starts") > 0)
    return firsts, starts.groupBy("th").agg(F.flatten(F.collect_set("starts")).alias("starts"))


def dedup(docs: DataFrame, s: Settings = Settings(), keep_text: bool = True) -> DataFrame:
    """``docs`` plus n_words, n_removed, kept_sha256 (and ``kept_text`` instead of the text if wanted)."""
    firsts, starts = repeats(docs, s)
    known = firsts.join(starts, "th", "left").select(F.col("th").alias("_th"), "first_d", "starts")
    result = ["n_words", "n_removed", "kept_sha256", "kept_text"]
    keep = [c for c in docs.columns if c != "text" and c.lower() not in result]
    # the row travels packed, so that its column names meet no others
    mine = docs.select(
        F.struct(*keep).alias("_row"), id_of(F.col("doc_id")).alias("_d"),
        F.xxhash64("text").alias("_h"), F.col("text").cast("binary").alias("_raw"),
    )
    copy = F.coalesce(F.col("_d") > F.col("first_d"), F.lit(False))
    both = mine.join(known, (F.col("_h") == F.col("_th")) & F.col("_raw").isNotNull(), "left")
    own = [F.col("_row")[c].alias(c) for c in keep]
    names = fresh(docs, "raw", "copy", "starts")
    extra = [F.col("_raw"), copy, F.when(~copy, F.col("starts"))]
    both = both.select(*own, *[c.alias(n) for c, n in zip(extra, names, strict=True)])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(keep).schema.fields)
    k = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for raw, copied, begun in zip(*(batch.column(k + i) for i in range(3)), strict=True):
                split = (raw.as_py() or b"").split()
                n = len(split)
                gone = np.zeros(n, bool)
                if copied.as_py() and n >= s.window:
                    gone[:] = True
                elif begun.is_valid:
                    gone = words.covered(np.array(begun.as_py(), np.int64), s.window, n)
                left = [w for w, g in zip(split, gone.tolist(), strict=True) if not g] if gone.any() else split
                text = b" ".join(left)
                row = (n, n - len(left), hashlib.sha256(text).hexdigest(), text.decode("utf-8", "replace") if keep_text else None)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            arrays = [pa.array(v, t) for v, t in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:k], *arrays], names=[*keep, *result])

    done = both.mapInArrow(run, f"{fields}, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string")
    return done if keep_text else done.drop("kept_text")


SQL = r"""
with d as (
  select doc_id, row_number() over () as r, coalesce(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+'), []) as w from documents),
spot as materialized (select r, coalesce(doc_id, 9223372036854775807) as d, i, hash(w[i:i+12]) as k, w[i:i+12] as t
  from (select r, doc_id, w, unnest(range(1, len(w) - 11)) as i from d)),
low as (select k, t, min(d) as m from spot group by k, t),
hit as (select r, i from spot join low using (k, t) where low.m < spot.d),
gone as (select r, list(distinct p) as gone from (select r, unnest(range(i, i + 13)) as p from hit) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(gone), 0) as bigint) as n_removed,
  sha256(coalesce(array_to_string(
    list_transform(list_filter(range(1, len(w) + 1), lambda i: gone is null or not list_contains(gone, i)), lambda i: w[i]),
    ' '), '')) as kept_sha256
from d left join gone using (r)
"""
