"""Pair operators: correlations, overlap and equivalence of assets.

Their results are by definition one row per pair, so the work is quadratic in the assets
that share a day, category or group. What is controlled is where it runs: a group is cut into
blocks and each pair of blocks is its own join key, so the largest day or category spreads over
``blocks ** 2`` tasks, and every pair is met exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioloom.functions.numeric import correlation, strict_least
from folioloom.session import write_once

BLOCKS = 4


def unordered_pairs(df: DataFrame, on: str, value_columns: list[str], blocks: int = BLOCKS) -> DataFrame:
    """Pairs of rows that agree on ``on`` with ``asset_key < compare_asset_key``.

    Only pairs of blocks a <= b are made, so two blocks meet once; pairs across blocks are turned to key
    order afterwards. Rows with a NULL ``on`` pair with nothing.
    """
    names = ["asset_key", *value_columns]
    rows = df.filter(F.col(on).isNotNull()).select(on, *names)
    cut = F.pmod(F.xxhash64("asset_key"), F.lit(blocks)).cast("int")
    up, down = F.sequence(cut, F.lit(blocks - 1)), F.sequence(F.lit(0), cut)
    left = rows.select("*", cut.alias("_a"), F.explode(up).alias("_b"))
    right = rows.select("*", cut.alias("_b"), F.explode(down).alias("_a"))
    right = right.withColumnsRenamed({c: f"compare_{c}" for c in names})
    met = left.join(right, [on, "_a", "_b"])
    turn = F.col("asset_key") > F.col("compare_asset_key")
    met = met.filter((F.col("_a") < F.col("_b")) | (F.col("asset_key") < F.col("compare_asset_key")))
    own = [F.when(turn, F.col(f"compare_{c}")).otherwise(F.col(c)).alias(c) for c in names]
    other = [F.when(turn, F.col(c)).otherwise(F.col(f"compare_{c}")).alias(f"compare_{c}") for c in names]
    return met.select(on, *own, *other)


def int_asset_pair_returns(returns: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    days = returns.filter("daily_return is not null").select(
        "full_date", "date_key", "asset_key", "ticker", "daily_return"
    )
    return unordered_pairs(days, "full_date", ["date_key", "ticker", "daily_return"], blocks).select(
        "full_date",
        "date_key",
        "asset_key",
        "ticker",
        "compare_asset_key",
        "compare_ticker",
        "daily_return",
        "compare_daily_return",
    )


PAIR = ["asset_key", "ticker", "compare_asset_key", "compare_ticker"]


#: Trading days in one window: as many as a long has bits without the sign.
WINDOW_DAYS = 63


def return_windows(returns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calendar, windows): each asset's returns in windows of ``WINDOW_DAYS`` trading days, counted from the newest.

    ``calendar`` numbers the distinct days, newest first, as (full_date, day). A row of ``windows`` is
    (asset_key, ticker, w, bits, values): a set bit for every day of the window with a return, and
    the returns in that order. Relies on one row per asset and day, which the quality suite checks.
    """
    days = write_once(
        returns.filter("daily_return is not null").select("full_date", "asset_key", "ticker", "daily_return"),
        "returns",
    )
    # as many rows as there are trading days, whatever the number of assets
    newest = W.orderBy(F.col("full_date").desc())
    calendar = write_once(days.select("full_date").distinct().withColumn("day", F.row_number().over(newest) - 1), "calendar")
    bit = (F.col("day") % WINDOW_DAYS).cast("int")
    placed = days.join(calendar, "full_date").withColumns({"w": F.floor(F.col("day") / WINDOW_DAYS).cast("int"), "bit": bit})
    values = F.sort_array(F.collect_list(F.struct("bit", "daily_return")))["daily_return"]
    windows = placed.groupBy("asset_key", "ticker", "w").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), values.alias("values")
    )
    return calendar, write_once(windows, "return-windows")


def shared_windows(windows: DataFrame, span: int, blocks: int = BLOCKS) -> DataFrame:
    """(PAIR, w, shared, before): windows that hold any of a pair's ``span`` latest shared days.

    A pair meets once per window, not once per day; ``shared`` has a bit for each day both traded and ``before``
    counts those in newer windows.
    """
    met = unordered_pairs(windows, "w", ["ticker", "bits"], blocks)
    met = met.withColumn("shared", F.col("bits").bitwiseAND(F.col("compare_bits"))).filter("shared <> 0")
    newer = W.partitionBy("asset_key", "compare_asset_key").orderBy("w").rowsBetween(W.unboundedPreceding, -1)
    met = met.withColumn("before", F.coalesce(F.sum(F.bit_count("shared")).over(newer), F.lit(0)).cast("int"))
    return met.filter(F.col("before") < span).select(*PAIR, "w", "shared", "before")


def latest_shared_days(windows: DataFrame, span: int, blocks: int = BLOCKS) -> DataFrame:
    """(PAIR, day, rn, x, y): the ``span`` latest shared days of every pair, rn = 1 the newest; no other day is emitted."""
    kept = shared_windows(windows, span, blocks)
    own = windows.select("asset_key", "w", "bits", "values")
    other = own.withColumnsRenamed({c: f"compare_{c}" for c in ("asset_key", "bits", "values")})
    kept = kept.join(own, ["asset_key", "w"]).join(other, ["compare_asset_key", "w"])
    bits = F.filter(F.sequence(F.lit(0), F.lit(WINDOW_DAYS - 1)), lambda i: F.expr("shared").bitwiseAND(_power(i)) != 0)
    wanted = F.slice(bits, F.lit(1), F.lit(span) - F.col("before"))
    each = kept.select("*", F.posexplode(wanted).alias("nth", "bit"))

    def value(of: str) -> Column:
        # set bits below this one come first in the list
        return F.col(f"{of}values")[F.bit_count(F.col(f"{of}bits").bitwiseAND(_power(F.col("bit")) - 1))]

    return each.select(
        *PAIR, (F.col("w") * WINDOW_DAYS + F.col("bit")).alias("day"), (F.col("before") + F.col("nth") + 1).alias("rn"),
        value("").alias("x"), value("compare_").alias("y"),
    )


def _power(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), i)


def latest_correlations(returns: DataFrame, spans: tuple[int, ...] = (30, 90), blocks: int = BLOCKS) -> DataFrame:
    """Correlation of every pair over its latest shared observations, for several spans at once.

    Joining daily histories would emit pairs times all days. Here a pair emits one row for each window of
    ``WINDOW_DAYS`` days in which both traded and then its latest shared days only, as many as the longest
    span: dense, sparse and delisted assets take the same way.
    """
    calendar, windows = return_windows(returns)
    latest = latest_shared_days(windows, max(spans), blocks)
    aggs: list[Column] = [F.min("day").alias("day")]
    for span in spans:
        inside = F.col("rn") <= span
        aggs += [
            F.count_if(inside).alias(f"observation_count_{span}d"),
            correlation(F.when(inside, F.col("x")), F.when(inside, F.col("y"))).alias(f"correlation_{span}d"),
        ]
    per_pair = latest.groupBy(*PAIR).agg(*aggs).join(calendar.withColumnRenamed("full_date", "as_of_date"), "day")
    return per_pair.select(*PAIR, "as_of_date", *(f"{c}_{s}d" for s in spans for c in ("observation_count", "correlation")))


def correlation_model(correlations: DataFrame, span: int) -> DataFrame:
    """One span of ``latest_correlations`` in the shape of its own model."""
    return correlations.select(
        *PAIR,
        "as_of_date",
        F.col(f"observation_count_{span}d").alias("observation_count"),
        f"correlation_{span}d",
    )


def export_market_correlations(correlations: DataFrame, assets: DataFrame) -> DataFrame:
    """Both spans of each pair with the names and types of its assets."""
    names = assets.select("asset_key", "asset_name", "asset_type")
    compare = names.withColumnsRenamed({c: f"compare_{c}" for c in names.columns})
    return (
        correlations.join(names, "asset_key")
        .join(compare, "compare_asset_key")
        .select(
            "as_of_date",
            "ticker",
            "asset_name",
            "asset_type",
            "compare_ticker",
            "compare_asset_name",
            "compare_asset_type",
            "observation_count_30d",
            "correlation_30d",
            "observation_count_90d",
            "correlation_90d",
        )
    )


def _shared_weight(exposure: DataFrame, name: str, score: str, blocks: int) -> DataFrame:
    pairs = unordered_pairs(exposure.select("asset_key", name, "exposure_weight"), name, ["exposure_weight"], blocks)
    smaller = strict_least(F.col("exposure_weight"), F.col("compare_exposure_weight"))
    return pairs.groupBy("asset_key", "compare_asset_key").agg(F.sum(smaller).alias(score))


def _named(assets: DataFrame) -> tuple[DataFrame, DataFrame]:
    names = assets.select("asset_key", "ticker", "asset_name")
    return names, names.withColumnsRenamed({c: f"compare_{c}" for c in names.columns})


def mart_etf_overlap(
    sector: DataFrame, geography: DataFrame, assets: DataFrame, blocks: int = BLOCKS
) -> DataFrame:
    by_sector = _shared_weight(sector, "sector_name", "sector_overlap_score", blocks)
    by_geography = _shared_weight(geography, "geography_name", "geography_overlap_score", blocks)
    s, g = F.col("sector_overlap_score"), F.col("geography_overlap_score")
    sides = F.when(s.isNotNull() & g.isNotNull(), 2).otherwise(1)
    names, compare = _named(assets)
    return (
        by_sector.join(by_geography, ["asset_key", "compare_asset_key"], "full_outer")
        .join(names, "asset_key")
        .join(compare, "compare_asset_key")
        .select(
            "asset_key",
            "ticker",
            "asset_name",
            "compare_asset_key",
            "compare_ticker",
            "compare_asset_name",
            s,
            g,
            ((F.coalesce(s, F.lit(0.0)) + F.coalesce(g, F.lit(0.0))) / sides).alias("blended_overlap_score"),
        )
    )


def mart_etf_equivalence(
    profile: DataFrame, assets: DataFrame, groups: DataFrame, blocks: int = BLOCKS
) -> DataFrame:
    pairs = unordered_pairs(
        profile.select("asset_key", "equivalence_group_code", "ter"), "equivalence_group_code", ["ter"], blocks
    )
    names, compare = _named(assets)
    ter, other = F.col("ter"), F.col("compare_ter")
    return (
        pairs.join(names, "asset_key")
        .join(compare, "compare_asset_key")
        .join(groups.select("equivalence_group_code", "equivalence_group_name"), "equivalence_group_code", "left")
        .select(
            "asset_key",
            "ticker",
            "asset_name",
            "compare_asset_key",
            "compare_ticker",
            "compare_asset_name",
            "equivalence_group_code",
            "equivalence_group_name",
            ter,
            other,
            (ter - other).alias("ter_spread"),
            F.when(ter < other, F.col("ticker")).when(ter > other, F.col("compare_ticker")).alias("lower_fee_ticker"),
        )
    )
