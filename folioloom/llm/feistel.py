"""Sharding by a Feistel permutation of global row numbers.

Row numbers follow a total order of the rows, so they do not depend on how the input is split. A
keyed Feistel network permutes the square of the smallest side that holds all rows, and numbers
outside are walked along their cycle until they fall inside, which makes it a permutation
of exactly 0 .. n-1. Shard and slot are then ``place % shards`` and ``place // shards``: computable for
any row from its number alone, slots without gaps, shards at most one row apart (law ``rows``).

One exchange by range of the order columns; no shard, id or text is a key of an exchange, so copies
and hot sources cannot gather in a task. Null ids come last, repeated rows get a place each, an
empty input gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.llm.frames import bytes_of, crc_of, fresh, numbered
from folioloom.llm.words import mix

ROUNDS = 6


def permute(numbers: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Places of row numbers under the keyed permutation of 0 .. n-1."""
    side = np.uint64(max(1, int(np.ceil(np.sqrt(n)))))
    while int(side) ** 2 < n:
        side += np.uint64(1)
    with np.errstate(over="ignore"):
        keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x // side, x % side
        for key in keys:
            left, right = right, (left + mix(right ^ key) % side) % side
        return left * side + right

    place = once(np.asarray(numbers).astype(np.uint64))
    while (outside := np.flatnonzero(place >= np.uint64(n))).size:
        place[outside] = once(place[outside])
    return place.astype(np.int64)


def permute_near(numbers: np.ndarray, n: int, seed: int, window: int) -> np.ndarray:
    """Places of row numbers when each window of ``window`` numbers is shuffled in itself.

    Windows of one length share a permutation and are turned by amounts of their own. The last may be shorter.
    """
    numbers = np.asarray(numbers).astype(np.int64)
    no, at = numbers // window, numbers % window
    whole = no < n // window
    out = np.empty_like(numbers)
    for rows, length in ((whole, window), (~whole, n % window)):
        if rows.any():
            turn = mix(no[rows].astype(np.uint64) + np.uint64(seed)) % np.uint64(length)
            out[rows] = no[rows] * window + (permute(at[rows], length, seed) + turn.astype(np.int64)) % length
    return out


def places(number: Column, n: int, seed: int, window: int | None = None) -> Column:
    @F.pandas_udf("bigint")
    def place(x: pd.Series) -> pd.Series:
        return pd.Series(permute_near(x.to_numpy(), n, seed, window) if window else permute(x.to_numpy(), n, seed))

    return place(number)


def shard(df: DataFrame, order: list[Column], shards: int = 16, seed: int = 20, window: int | None = None) -> DataFrame:
    """``df`` with ``shard`` and ``slot``; columns of these names are replaced.

    ``order`` must tell rows apart up to full repeats, which may swap places among themselves. With ``window``
    rows are shuffled only among so many neighbours of the order, so slots of every shard follow it.
    """
    (number,) = fresh(df, "number")
    rows, n = numbered(df.drop("shard", "slot"), order, number, "shard-rows")
    (place,) = fresh(rows, "place")
    rows = rows.withColumn(place, places(F.col(number), n, seed, window))
    return rows.withColumns(
        {"shard": (F.col(place) % shards).cast("int"), "slot": F.floor(F.col(place) / shards).cast("bigint")}
    ).drop(number, place)


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 20) -> DataFrame:
    """Whole documents with shard and slot, numbered by id and text."""
    order = [F.col("doc_id").asc_nulls_last(), crc_of(F.col("text")), bytes_of(F.col("text")), F.xxhash64("text")]
    return shard(docs, order, shards, seed)


def shard_stored(docs: DataFrame, shards: int = 16, seed: int = 20, window: int = 1 << 16) -> DataFrame:
    """Rows of a stored table with shard and slot, in the order in which they are stored but for ``window`` neighbours.

    The order is that of the table's files (by part number) and of the rows in them. It is read with the rows, so
    nothing is carried in the table itself. ``docs`` must be a plain read of Parquet files.
    """
    at = docs.metadataColumn("_metadata")
    file, row = fresh(docs, "file", "row")
    placed = docs.select(*docs.columns, at["file_name"].alias(file), at["row_index"].alias(row))
    part = F.regexp_extract(F.col(file), "part-([0-9]+)", 1).try_cast("bigint")
    return shard(placed, [part, F.col(file), F.col(row)], shards, seed, window).drop(file, row)


def write(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order within each file."""
    dealt = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    dealt.write.partitionBy("shard").parquet(path)
