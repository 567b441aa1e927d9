"""Readers for landed files: asset master, vendor prices, fund sheets, texts and the seed."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom import schemas
from folioloom.functions.text import parse_flag

VENDOR_NAMES = {
    "Date": "date",
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Adj Close": "adj_close",
    "Volume": "volume",
}
# Candidate types of an undeclared text column, narrowest first.
CANDIDATE_TYPES = ["boolean", "bigint", "double", "date", "timestamp_ntz"]


# --- ingestion transforms -----------------------------------------------------------------


def plain_name(header: str) -> str:
    """Header as an identifier: lower case, runs of other characters as one underscore."""
    name = "_".join(re.findall(r"[0-9a-z]+", header.strip().lower())) or "unnamed"
    return f"_{name}" if name[0].isdigit() else name


def plain_names(headers: list[str]) -> list[str]:
    """Identifiers that stay distinct: a repeat gets the first free number."""
    taken: set[str] = set()
    out = []
    for base in map(plain_name, headers):
        name, n = base, 1
        while name in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name)
        out.append(name)
    return out


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*plain_names(df.columns))


def drop_empty(df: DataFrame) -> DataFrame:
    """Without rows, then columns, that hold only NULL. One aggregate counts every column."""
    rows = df.na.drop("all")
    counts = rows.agg(*[F.count(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(rows.columns)]).first()
    return rows.select(*[F.col(f"`{c}`") for i, c in enumerate(rows.columns) if counts[i]])


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType | T.FloatType)]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def keep_last(df: DataFrame, key: str, seq: Column) -> DataFrame:
    """One row per key: the one with the highest ``seq``. Combined map-side, so a key that
    fills the table costs one row per task, not a sort of the group."""
    last = df.groupBy(key).agg(F.max_by(F.struct(*df.columns), seq).alias("r"))
    return last.select("r.*")


def active_tickers(asset_master: DataFrame) -> DataFrame:
    live = F.coalesce(F.col("is_active").cast("boolean"), F.lit(True))
    return asset_master.filter(live & F.col("ticker").isNotNull()).select("ticker")


def derive_types(df: DataFrame) -> dict[str, str]:
    """Narrowest candidate type that every non-NULL text of a column casts to.

    One aggregate over the table; NULL-only columns stay text.
    """

    def attempt(c: str, t: str) -> Column:
        text = F.trim(F.col(c))
        # casts alone are lenient: '1' is a boolean and a timestamp a date
        shaped = {"boolean": text.rlike("(?i)^(true|false)$"), "date": text.rlike(r"^\d{4}-\d{2}-\d{2}$")}
        cast = text.try_cast(t)
        return F.when(shaped[t], cast) if t in shaped else cast

    aggs = [F.count(F.col(c)).alias(f"n_{c}") for c in df.columns]
    aggs += [F.count(attempt(c, t)).alias(f"{t}_{c}") for c in df.columns for t in CANDIDATE_TYPES]
    row = df.agg(*aggs).first()

    def pick(c: str) -> str:
        n = row[f"n_{c}"]
        fits = (t for t in CANDIDATE_TYPES if n and row[f"{t}_{c}"] == n)
        return next(fits, "string")

    return {c: pick(c) for c in df.columns}


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(c).cast(types.get(c, "string")).alias(c) for c in df.columns])


# --- readers ------------------------------------------------------------------------------


def clean_asset_master(landed: DataFrame, seq: Column) -> DataFrame:
    """Required columns first, extras kept; the last row of a ticker wins, flags default to true."""
    named = landed.toDF(*[c.strip().lower() for c in landed.columns])
    missing = [c for c in schemas.ASSET_MASTER_COLUMNS if c not in named.columns]
    if missing:
        raise ValueError(f"asset master lacks required columns: {', '.join(missing)}")
    extras = [c for c in named.columns if c not in schemas.ASSET_MASTER_COLUMNS and c != "_seq"]
    ticker = F.upper(F.regexp_replace(F.col("ticker").cast("string"), r"^\s+|\s+$", ""))
    rows = (
        named.withColumn("ticker", ticker).filter("ticker is not null and ticker <> ''").withColumn("_seq", seq)
    )
    return (
        keep_last(rows, "ticker", F.col("_seq"))
        .withColumn("is_active", F.coalesce(parse_flag("is_active"), F.lit(True)))
        .select(*schemas.ASSET_MASTER_COLUMNS, *extras)
    )


def read_asset_master(spark: SparkSession, path: str) -> DataFrame:
    landed = spark.read.csv(path, header=True)
    # file order: file, split within it, row within the split
    seq = F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    )
    return clean_asset_master(landed.withColumn("_seq", seq), F.col("_seq"))


def read_prices(spark: SparkSession, path: str, active: DataFrame | None = None, fmt: str = "csv") -> DataFrame:
    """Vendor price files under ``path``/ticker=<symbol>/, for active tickers only.

    The ticker is the partition column, so files of other tickers are pruned at run time.
    Active tickers without files simply have no rows; no row at all is an error.
    """
    columns = ", ".join(
        ["`Date` string", *[f"`{c}` double" for c in VENDOR_NAMES if c != "Date"], "ticker string"]
    )
    reader = spark.read.schema(columns)
    landed = reader.csv(path, header=True) if fmt == "csv" else reader.parquet(path)
    if active is not None:
        landed = landed.join(active.select("ticker"), "ticker", "left_semi")
    prices = (
        landed.withColumnsRenamed(VENDOR_NAMES)
        .withColumn("date", F.to_date(F.substring("date", 1, 10)))
        .select(schemas.PRICE_COLUMNS)
    )
    if prices.isEmpty():
        raise ValueError("no price rows for any active ticker")
    return nan_to_null(prices)


def read_sheets(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The five fund sheets, one folder or file each, as raw tables."""
    landed, missing = {}, []
    for sheet in schemas.SHEETS:
        try:
            landed[sheet] = spark.read.csv(f"{path}/{sheet}", header=True)
        except AnalysisException:
            missing.append(sheet)
    if missing:
        raise ValueError(f"missing required sheets: {', '.join(missing)}")
    return {schemas.SHEETS[s]: clean_sheet(df, schemas.SHEETS[s]) for s, df in landed.items()}


def clean_sheet(landed: DataFrame, table: str) -> DataFrame:
    """Empty rows and columns dropped, headers normalised, declared types applied.

    A declared column that was empty in the sheet comes back as NULLs, so models keep their inputs.
    """
    df = normalise_headers(drop_empty(landed))
    types = schemas.SHEET_TYPES[table]
    declared = [
        (F.col(c) if c in df.columns else F.lit(None)).cast(types.get(c, "string")).alias(c)
        for c in schemas.SHEET_COLUMNS[table]
    ]
    extras = [F.col(c) for c in df.columns if c not in schemas.SHEET_COLUMNS[table]]
    return df.select(*declared, *extras)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per .txt file below ``path`` (any letter case), whole text, with its change time."""
    base = path.rstrip("/").rsplit("/", 1)[-1]
    raw = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    files = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.[tT][xX][tT]")
        .text(path, wholetext=True)
    )
    return files.select(
        F.concat(F.lit(f"{base}/"), F.substring_index(raw, f"/{base}/", -1)).alias("relative_path"),
        F.col("value").alias("content"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SEED).csv(path, header=True)
