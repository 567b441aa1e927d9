"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioloom.session import scratch_path, write_once

WORD = r"[^\x20\x09-\x0D]+"

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names made from ``names`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def bytes_of(text: Column) -> Column:
    """UTF-8 bytes; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def crc_of(text: Column) -> Column:
    """Unsigned crc32 of the UTF-8 bytes; 0 for null."""
    return F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("bigint")


def numbered(df: DataFrame, order: list[Column], name: str, label: str) -> tuple[DataFrame, int]:
    """``df`` with a gapless row number from 0 in the given order, and the number of rows.

    Rows are dealt by range and sorted inside their partition, and the result is stored with
    (partition, position). Only the partitions' row counts meet in one place, one row each. The
    number is then offset + position, so no task sees more than its range, and a lost executor
    rereads stored rows: bounds are never drawn a second time.
    """
    part, offset = fresh(df, "part", "offset")
    (name,) = fresh(df, name)
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = write_once(dealt.withColumn(part, F.monotonically_increasing_id()), label)
    counts = kept.groupBy(F.shiftright(part, 33).alias(part)).agg(F.count(F.lit(1)).alias(offset))
    before = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(part, F.coalesce(F.sum(offset).over(before), F.lit(0)).alias(offset))
    n = counts.agg(F.coalesce(F.sum(offset), F.lit(0))).first()[0]
    low = F.col(part).bitwiseAND(F.lit((1 << 33) - 1))
    out = kept.select(*df.columns, F.shiftright(part, 33).alias(part), low.alias(name))
    # one short row per partition of the exchange, whatever the data: small by that bound
    out = out.join(F.broadcast(offsets), part).select(*df.columns, (F.col(offset) + F.col(name)).alias(name))
    return out, n


def narrowed(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``df`` without most rows whose ``key`` is not in the only column of ``wanted``, before a join exchanges the others.

    Wanted keys are marked in a map of 2**24 bits, which is broadcast as at most 2**18 rows whatever the data: one
    million keys let about one in 16 other rows through.
    """
    word, bits = fresh(df, "word", "bits")

    def at(column: str) -> tuple[Column, Column]:
        h = F.xxhash64(column)
        return F.shiftrightunsigned(h, 46).cast("int"), F.shiftright(h, 16).bitwiseAND(F.lit(63)).cast("int")

    place, bit = at(wanted.columns[0])
    marks = wanted.select(place.alias(word), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias(bits))
    marks = marks.groupBy(word).agg(F.bit_or(bits).alias(bits))
    place, bit = at(key)
    kept = df.withColumn(word, place).join(F.broadcast(marks), word)
    return kept.filter(F.call_function("getbit", F.col(bits), bit) == 1).select(*df.columns)


class Rounds:
    """Intermediates of an iterative operator: stored like ``write_once``, deleted when two rounds have passed.

    What a round stores may be read by the next one, which begins with ``turn``; nothing is read after that.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.now, self.last = spark, [], []

    def store(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        self.now.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def turn(self) -> None:
        for path in map(self.spark._jvm.org.apache.hadoop.fs.Path, self.last):
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.now, self.last = [], self.now
