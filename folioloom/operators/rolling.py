"""Rolling means, spreads and maxima of the last k rows, built from shorter ones.

A frame such as "the last 252 rows" makes Spark add up all of its rows anew for every row: work is rows times
frame. Here a frame is put together from shorter frames that end further back, found by ``lag``: 252 rows are two frames
of 90, two of 30 and two of 6. A row then costs one look-up per piece, 20 for a span of 252
instead of 252 updates. All levels share one partitioning and order, so nothing is exchanged or sorted again.

Only rows inside a frame enter its result, so there is no cancellation as with differences of running
sums. Means are kept relative to the newest piece and spreads are merged as squared distances from the common mean:
a constant series has exactly that mean and exactly no spread. NULLs are skipped; a frame without values is NULL.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F


def cover(rows: int, shorter: list[int]) -> list[tuple[int, int]]:
    """(length, offset) of pieces that together are the last ``rows`` rows, longest first."""
    pieces, at = [], 0
    for length in sorted({1, *shorter}, reverse=True):
        while at + length <= rows:
            pieces.append((length, at))
            at += length
    return pieces


def _back(name: str, offset: int, ordered: WindowSpec) -> Column:
    return F.lag(name, offset).over(ordered) if offset else F.col(name)


def with_rolling_max(df: DataFrame, value: str, ordered: WindowSpec, levels: list[int], name: str) -> DataFrame:
    """Adds ``name``: the greatest ``value`` of the last ``levels[-1]`` rows."""
    at = {1: value, **{k: f"_max_{k}" for k in levels[:-1]}, levels[-1]: name}
    for i, rows in enumerate(levels):
        pieces = [_back(at[k], offset, ordered) for k, offset in cover(rows, levels[:i])]
        df = df.withColumn(at[rows], F.greatest(*pieces))
    return df.drop(*(at[k] for k in levels[:-1]))


def with_rolling_moments(df: DataFrame, value: str, ordered: WindowSpec, levels: list[int],
                         means: dict[int, str], spreads: dict[int, str]) -> DataFrame:
    """Adds the means and sample standard deviations of the last rows, named by their number of rows.

    Every number named must be one of ``levels``, which ascend.
    """

    def of(rows: int) -> dict[str, str]:
        return {x: f"_{x}_{rows}" for x in (("n", "mean", "m2") if spreads else ("n", "mean"))}

    own = F.col(value).cast("double")
    first = {"n": F.when(own.isNotNull(), 1.0).otherwise(0.0), "mean": own, "m2": F.when(own.isNotNull(), 0.0)}
    df = df.withColumns({column: first[x] for x, column in of(1).items()})
    for i, rows in enumerate(levels):
        pieces = cover(rows, levels[:i])
        df = df.withColumns(
            {f"_{x}_at_{p}": _back(c, offset, ordered) for p, (k, offset) in enumerate(pieces) for x, c in of(k).items()}
        )
        df = _merged(df, len(pieces), of(rows)).drop(*(f"_{x}_at_{p}" for p in range(len(pieces)) for x in of(1)))
    deviation = {k: F.when(F.col(f"_n_{k}") > 1, F.sqrt(F.col(f"_m2_{k}") / (F.col(f"_n_{k}") - 1))) for k in spreads}
    df = df.withColumns(
        {**{name: F.col(f"_mean_{k}") for k, name in means.items()}, **{spreads[k]: c for k, c in deviation.items()}}
    )
    return df.drop(*(c for k in (1, *levels) for c in of(k).values()))


def _merged(df: DataFrame, pieces: int, names: dict[str, str]) -> DataFrame:
    """Count, mean and sum of squared distances of ``pieces`` frames as those of one."""
    n, mean = [[F.col(f"_{x}_at_{p}") for p in range(pieces)] for x in ("n", "mean")]
    total, base = F.col(names["n"]), F.coalesce(*mean)

    def added(terms: list[Column]) -> Column:
        return reduce(add, [F.coalesce(t, F.lit(0.0)) for t in terms])

    shift = added([a * (m - base) for a, m in zip(n, mean, strict=True)])
    df = df.withColumn(names["n"], added(n)).withColumn(names["mean"], F.when(total > 0, base + shift / total))
    if "m2" in names:
        away = [m - F.col(names["mean"]) for m in mean]
        squares = [F.col(f"_m2_at_{p}") + n[p] * away[p] * away[p] for p in range(pieces)]
        df = df.withColumn(names["m2"], F.when(total > 0, added(squares)))
    return df
