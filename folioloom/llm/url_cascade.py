"""URL filter: rules by longest match, then a Bloom filter cascade over the corpus's addresses.

The cascade answers "is this key listed" exactly for every key of a known universe, without a join. Level
0 is a Bloom filter of the listed keys; level 1 one of the unlisted keys that level 0 lets through; level 2 one of the
listed keys that level 1 lets through; and so on until nothing is let through wrongly. The first level
that rejects a key decides by its parity. Every level runs over all remaining keys of the universe.

Filters are the only thing that leaves the tables: they are built by a distributed bit-wise or, and sent to
tasks. To bound them, keys are cut by hash into as many shards as keep each shard's filters near
``most_bytes``; each shard is built and asked in turn, with the same answers.

Null urls and urls without ``://`` have empty host and path, fit no rule and are looked up as the
empty address. Repeated rows get one answer each. An empty list allows, an empty table gives no rows.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.llm.words import mix
from folioloom.session import write_once

HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, HOST, 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


@dataclass(frozen=True)
class Rule:
    """``host/path`` with the verdict for the host, its subdomains, and paths that begin so."""

    rule: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        name, _, rest = self.rule.partition("/")
        return ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + rest))


def ruled(host: Column, path: Column, rules: list[Rule], field: str) -> Column:
    """``rule`` or ``verdict`` of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.rule)):
        out = F.when(r.fits(host, path), getattr(r, field)).otherwise(out)
    return out


# --- the cascade ---


def spots(k1: np.ndarray, k2: np.ndarray, depth: int, hashes: int, words: int) -> np.ndarray:
    """Bit positions of keys, one row per hash; each level draws its own."""
    salt = np.arange(1, hashes + 1, dtype=np.uint64) + np.uint64(64 * depth)
    return mix(k1 ^ mix(k2 + salt[:, None] * np.uint64(0x9E3779B97F4A7C15))) % np.uint64(64 * words)


@dataclass(frozen=True)
class Level:
    """One Bloom filter: bits as 64-bit words, hashes per key, and its place in the cascade."""

    words: np.ndarray
    hashes: int
    depth: int

    def has(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        at = spots(k1, k2, self.depth, self.hashes, len(self.words))
        return ((self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)) > 0).all(axis=0)


def listed(levels: list[Level], k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """Membership of keys by the first level that rejects them."""
    out = np.zeros(len(k1), bool)
    left = np.arange(len(k1))
    for i, level in enumerate(levels):
        passed = level.has(k1[left], k2[left])
        out[left[~passed]] = i % 2 == 1
        left = left[passed]
    out[left] = len(levels) % 2 == 1
    return out


def build(keys: DataFrame, share: float, depth: int) -> tuple[Level, int]:
    """Filter of the keys (k1, k2) that lets through about ``share`` of others, and the number of keys."""
    n = keys.count()
    hashes = max(1, round(math.log2(1 / share)))
    words = max(1, math.ceil(n * hashes / math.log(2) / 64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (c.to_numpy().view(np.uint64) for c in batch.columns)
            at = spots(k1, k2, depth, hashes, words).ravel()
            word, bit = (at >> np.uint64(6)).view(np.int64), (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit)], ["word", "bit"])

    out = np.zeros(words, np.int64)
    set_bits = keys.select("k1", "k2").mapInArrow(run, "word bigint, bit bigint")
    got = set_bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # ``words`` rows at most
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return Level(out.view(np.uint64), hashes, depth), n


def asks(levels: list[Level], spark, what: str) -> F.Column:
    """Column: whether level ``-1`` lets (k1, k2) through, or whether the cascade lists it."""
    held = spark.sparkContext.broadcast(levels)

    @F.pandas_udf("boolean")
    def ask(k1: pd.Series, k2: pd.Series) -> pd.Series:
        a, b = k1.to_numpy().astype(np.int64).view(np.uint64), k2.to_numpy().astype(np.int64).view(np.uint64)
        return pd.Series(held.value[-1].has(a, b) if what == "last" else listed(held.value, a, b))

    return ask("k1", "k2")


def cascade(universe: DataFrame, share: float = 1 / 8) -> list[Level]:
    """Levels for a universe of distinct (k1, k2, listed)."""
    spark = universe.sparkSession
    inside, outside = universe.filter("listed").drop("listed"), universe.filter("not listed").drop("listed")
    n_in, n_out = inside.count(), outside.count()
    levels: list[Level] = []
    # the first level may as well let through as many wrong keys as there are right ones
    first = min(share, max(n_in, 1) / max(n_out, 1))
    while True:
        level, n = build(inside, share if levels else first, len(levels))
        if n == 0:
            return levels
        levels.append(level)
        passed = write_once(outside.filter(asks(levels, spark, "last")), "url-passed")
        inside, outside = passed, inside


def keyed(df: DataFrame, key: Column) -> DataFrame:
    return df.withColumns({"k1": F.xxhash64(key), "k2": F.xxhash64(F.lit(7), key)})


def mark(df: DataFrame, key: str, entries: DataFrame, most_bytes: int = 32 << 20, name: str = "listed") -> DataFrame:
    """``df`` with whether its key is among ``entries`` (one column ``key``); nulls count as ''.

    The universe is every key of ``df``; entries outside it cannot be asked for and are left out.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col(key), F.lit(""))
    mine = keyed(df.select(text.alias("_key")), F.col("_key")).select("k1", "k2", F.lit(0).alias("in"), F.lit(1).alias("here"))
    theirs = entries.filter(F.col("key").isNotNull())
    theirs = keyed(theirs, F.col("key")).select("k1", "k2", F.lit(1).alias("in"), F.lit(0).alias("here"))
    universe = mine.union(theirs).groupBy("k1", "k2").agg(F.max("in").alias("in"), F.max("here").alias("here"))
    universe = write_once(
        universe.filter("here = 1").select("k1", "k2", (F.col("in") == 1).alias("listed")), "url-universe"
    )
    n_listed, n = universe.agg(F.sum(F.col("listed").cast("bigint")), F.count(F.lit(1))).first()
    n_listed = n_listed or 0
    per_key = 2 + max(3.0, math.log2(max(n, 1) / max(n_listed, 1))) / math.log(2)  # bits, deeper levels included
    shards = max(1, math.ceil(n_listed * per_key / 8 / most_bytes))
    shard_of = F.pmod(F.col("k1"), F.lit(shards))
    asked = keyed(df.drop("k1", "k2", name), text)
    out = None
    for s in range(shards):
        levels = cascade(universe.filter(shard_of == s) if shards > 1 else universe)
        answer = asks(levels, spark, "listed") if levels else F.lit(False)
        part = (asked.filter(shard_of == s) if shards > 1 else asked).withColumn(name, answer)
        out = part if out is None else out.unionByName(part)
    return out.drop("k1", "k2")


def judge(pages: DataFrame, rules: list[Rule], entries: DataFrame, most_bytes: int = 32 << 20) -> DataFrame:
    """page_id, host, path, rule, verdict; a listed address (host and path) that no rule fits is blocked."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts = parts.withColumn("_address", F.concat("host", "path"))
    marked = mark(parts, "_address", entries, most_bytes, "_listed")
    host, path = F.col("host"), F.col("path")
    return marked.select(
        "page_id", "host", "path",
        ruled(host, path, rules, "rule").alias("rule"),
        F.coalesce(ruled(host, path, rules, "verdict"), F.when(F.col("_listed"), "block").otherwise("allow")).alias("verdict"),
    )


def addresses_of_hosts(pages: DataFrame, terms: list[str]) -> DataFrame:
    """A list for the cascade: every address whose host has one of the terms among its name parts."""
    host = host_of(F.col("url"))
    named = F.arrays_overlap(F.split(host, "[.-]"), F.array(*map(F.lit, terms)))
    return pages.filter(named).select(F.concat(host, path_of(F.col("url"))).alias("key")).distinct()


SQL = r"""
with p as (
  select page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
  from pages),
r as (select unnest(['net', 'example.net', 'example.com', 'org']) as h, unnest(['/', '/en/', '/de/', '/fr/']) as pa,
        unnest(['block', 'allow', 'block', 'allow']) as v),
m as (
  select page_id, host, path, max_by(h || pa, length(h || pa)) as rule, max_by(v, length(h || pa)) as v
  from p left join r on (host = h or ends_with(host, '.' || h)) and starts_with(path, pa)
  group by all)
select page_id, host, path, rule, coalesce(v, case when list_has_any(regexp_split_to_array(host, '[.-]'),
  ['ads', 'adult', 'bets', 'casino', 'pills', 'spam']) then 'block' else 'allow' end) as verdict
from m
"""
