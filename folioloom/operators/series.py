"""Per-asset time series: returns, volatility, drawdown and trend.

All four read the same partitioning and ordering, so a chain of them needs one exchange
and one sort however many are stacked, and no join to bring them back together. Rolling frames
are put together from shorter ones (``rolling``), not added up anew for every row.

Contract: one row per (asset, day), which the quality suite checks. An asset is then no
longer than its calendar. For longer series, ``slice_series`` cuts every asset into
overlapping slices first; the same functions then run on (asset, slice) partitions. The
stored build does so if it is given a slice length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioloom.functions.numeric import ratio
from folioloom.functions.text import first_match
from folioloom.operators.rolling import with_rolling_max, with_rolling_moments

# Horizons in rows (trading days) and the yearly scaling.
HORIZONS = {"1d": 1, "1w": 5, "1m": 21, "3m": 63, "6m": 126, "1y": 252}
YEAR_ROWS = 252
SMA_ROWS = {"sma_20": 20, "sma_50": 50, "sma_200": 200}

#: Frames from which longer ones are put together (``rolling.cover``).
SPREAD_LEVELS = [6, 30, 90, YEAR_ROWS]
MEAN_LEVELS = [5, 20, 50, 200]
PEAK_LEVELS = [6, 36, YEAR_ROWS]

SLICE = "slice_no"
HALO = "is_halo"
CARRIED_PEAK = "carried_peak"

RETURN_COLUMNS = [
    "asset_key", "ticker", "date_key", "full_date", "close_price", "adj_close_price",
    "price_for_returns", "daily_return", *[f"return_{h}" for h in HORIZONS],
]
VOLATILITY_COLUMNS = ["volatility_30d", "volatility_90d", "sharpe_proxy_1y"]
DRAWDOWN_COLUMNS = ["rolling_peak_252d", "drawdown_52w", "drawdown_since_inception"]
TREND_COLUMNS = [*SMA_ROWS, "above_sma_50_flag", "above_sma_200_flag", "trend_score", "trend_label"]


class _Frames:
    """Windows over one table's series in order, and over their history to date."""

    def __init__(self, df: DataFrame):
        sliced = SLICE in df.columns
        keys = ["asset_key", SLICE] if sliced else ["asset_key"]
        self.ordered = W.partitionBy(*keys).orderBy("full_date")
        self.sliced = sliced

    def to_date(self):
        return self.ordered.rowsBetween(W.unboundedPreceding, W.currentRow)


def by_asset(df: DataFrame) -> DataFrame:
    """Rows of a series brought together, over all configured shuffle partitions.

    Rolling frames cost far more time than bytes. The exchange a window adds by itself is merged
    down by size to a few tasks on small histories; one with a given number is not. Adaptive execution cannot
    split such an exchange either, which is sound as long as an asset is bounded by its calendar;
    longer ones are sliced.
    """
    keys = ["asset_key", SLICE] if SLICE in df.columns else ["asset_key"]
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *keys)


def with_returns(prices: DataFrame) -> DataFrame:
    w, price = _Frames(prices).ordered, F.col("price_for_returns")
    out = prices.withColumns(
        {f"return_{h}": ratio(price, F.lag(price, k).over(w)) - 1 for h, k in HORIZONS.items()}
    )
    return out.withColumn("daily_return", F.col("return_1d"))


def with_volatility(returns: DataFrame) -> DataFrame:
    ordered, scale = _Frames(returns).ordered, F.sqrt(F.lit(float(YEAR_ROWS)))
    spreads = {30: "_spread_30", 90: "_spread_90", YEAR_ROWS: "_spread_1y"}
    rolled = with_rolling_moments(returns, "daily_return", ordered, SPREAD_LEVELS, {YEAR_ROWS: "_mean_1y"}, spreads)
    return rolled.withColumns(
        {
            "volatility_30d": F.col("_spread_30") * scale,
            "volatility_90d": F.col("_spread_90") * scale,
            "sharpe_proxy_1y": ratio(F.col("_mean_1y"), F.col("_spread_1y")) * scale,
        }
    ).drop("_mean_1y", *spreads.values())


def with_drawdown(prices: DataFrame) -> DataFrame:
    frames, price = _Frames(prices), F.col("price_for_returns")
    peak = F.max(price).over(frames.to_date())
    if frames.sliced:
        peak = F.greatest(peak, CARRIED_PEAK)
    out = prices.withColumn("peak_to_date", peak)
    out = with_rolling_max(out, "price_for_returns", frames.ordered, PEAK_LEVELS, "rolling_peak_252d")
    return out.withColumns(
        {
            "drawdown_52w": ratio(price, F.col("rolling_peak_252d")) - 1,
            "drawdown_since_inception": ratio(price, F.col("peak_to_date")) - 1,
        }
    ).drop("peak_to_date")


def with_trend(prices: DataFrame) -> DataFrame:
    price, mid, slow = F.col("price_for_returns"), F.col("sma_50"), F.col("sma_200")
    means = {rows: name for name, rows in SMA_ROWS.items()}
    averaged = with_rolling_moments(prices, "price_for_returns", _Frames(prices).ordered, MEAN_LEVELS, means, {})
    flagged = averaged.withColumns(
        {
            "above_sma_50_flag": F.coalesce(price > mid, F.lit(False)),
            "above_sma_200_flag": F.coalesce(price > slow, F.lit(False)),
        }
    )
    up50, up200 = F.col("above_sma_50_flag"), F.col("above_sma_200_flag")
    return flagged.withColumns(
        {
            "trend_score": up50.cast("int") + up200.cast("int"),
            "trend_label": first_match(
                [(up50 & up200, "Uptrend"), ((price < mid) & (price < slow), "Downtrend")], "Mixed"
            ),
        }
    )


def with_risk(prices: DataFrame) -> DataFrame:
    """Returns, volatility and drawdown in one pass over each series."""
    return with_drawdown(with_volatility(with_returns(prices)))


def measure(prices: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply series steps to price rows, whole or sliced; slices lose their halo at the end.

    Rows that carry every measure already, as the stored build keeps them, come back as they are.
    """
    if {"return_1d", "volatility_30d", "drawdown_52w", "trend_label"} <= set(prices.columns):
        return prices
    out = by_asset(prices)
    for step in steps:
        out = step(out)
    return trim_halo(out) if SLICE in prices.columns else out


def latest_rows(prices: DataFrame, rows: int = YEAR_ROWS) -> DataFrame:
    """The newest rows of each asset: all that a figure as of its last day depends on.

    The limit is applied inside each task before the exchange too.
    """
    newest = W.partitionBy("asset_key").orderBy(F.col("full_date").desc())
    return prices.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= rows).drop("_rn")


# --- models ---------------------------------------------------------------------------


def int_asset_returns(prices: DataFrame) -> DataFrame:
    return measure(prices, with_returns).select(RETURN_COLUMNS)


def int_asset_volatility(prices: DataFrame) -> DataFrame:
    return measure(prices, with_returns, with_volatility).select(
        "asset_key", "ticker", "date_key", "full_date", *VOLATILITY_COLUMNS
    )


def int_asset_drawdown(prices: DataFrame) -> DataFrame:
    return measure(prices, with_drawdown).select(
        "asset_key", "ticker", "date_key", "full_date", "price_for_returns", *DRAWDOWN_COLUMNS
    )


def int_asset_trend_inputs(prices: DataFrame) -> DataFrame:
    return measure(prices, with_trend).select(
        "asset_key", "ticker", "date_key", "full_date", "price_for_returns", *TREND_COLUMNS
    )


def int_asset_risk_enriched(prices: DataFrame) -> DataFrame:
    """Returns with the risk measures beside them.

    The measures are windows over the same rows, so they are added in place; joining three
    separately computed tables on (asset, day) would give the same rows with more exchanges.
    """
    return measure(prices, with_risk).select(
        *RETURN_COLUMNS, *VOLATILITY_COLUMNS, "drawdown_52w", "drawdown_since_inception"
    )


def risk_and_trend(prices: DataFrame) -> DataFrame:
    """Every series measure in one pass."""
    return measure(prices, with_risk, with_trend)


# --- slicing of long series -------------------------------------------------------------


def slice_series(prices: DataFrame, slice_rows: int = 20_000) -> DataFrame:
    """Cut each asset into slices of ``slice_rows`` rows, each led by the rows its windows need.

    Row positions come from per-month counts (small) plus a rank inside the month, so no task
    ever sorts a whole asset. The last 252 rows of a slice are repeated at the head of the next
    as halo, which covers the longest lag and frame; ``trim_halo`` drops them afterwards. The
    running peak of earlier slices is carried as a column. Results equal the unsliced ones.
    """
    if slice_rows < YEAR_ROWS:
        raise ValueError(f"a slice must hold at least {YEAR_ROWS} rows")
    month = F.trunc("full_date", "month")
    monthly = prices.groupBy("asset_key", month.alias("month")).agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("asset_key").orderBy("month").rowsBetween(W.unboundedPreceding, -1)
    offsets = monthly.select(
        "asset_key", "month", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    in_month = W.partitionBy("asset_key", "month").orderBy("full_date")
    placed = (
        prices.withColumn("month", month)
        .join(offsets, ["asset_key", "month"])
        .withColumn("pos", F.col("before") + F.row_number().over(in_month) - 1)
    )
    own = F.floor(F.col("pos") / slice_rows).cast("int")
    leads_next = F.col("pos") % slice_rows >= slice_rows - YEAR_ROWS
    sliced = (
        placed.withColumn("own", own)
        .withColumn(SLICE, F.explode(F.when(leads_next, F.array(own, own + 1)).otherwise(F.array(own))))
        .withColumn(HALO, F.col(SLICE) > F.col("own"))
    )
    peaks = placed.groupBy("asset_key", own.alias(SLICE)).agg(F.max("price_for_returns").alias("top"))
    before = W.partitionBy("asset_key").orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    carried = peaks.select("asset_key", SLICE, F.max("top").over(before).alias(CARRIED_PEAK))
    # a halo past an asset's last row opens a slice with no rows of its own: the inner join drops it
    return sliced.join(carried, ["asset_key", SLICE]).drop("month", "before", "pos", "own")


def trim_halo(sliced: DataFrame) -> DataFrame:
    return sliced.filter(~F.col(HALO)).drop(SLICE, HALO, CARRIED_PEAK)
