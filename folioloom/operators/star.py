"""Metric queries over a star: the caller names metrics and dimensions.

Only the tables behind the named dimensions are joined. Dimension chains (fund to provider,
index, group) are joined at fund grain first, so a key that is missing on a third of the
funds never meets the fact rows. Exposures multiply funds, so facts are first added up per
fund and requested attribute and only those sums are joined to the exposures.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LATEST_YEAR, ALL_TIME = "latest_year", "all_time"

Links = Mapping[str, Mapping[str, tuple[str, str]]]


@dataclass(frozen=True)
class Star:
    """``links[child][parent] = (child key, parent key)``, many rows of a child to one parent.

    ``fans`` are exposure tables that hold several rows per ``hub`` row.
    """

    fact: str
    links: Links
    dimensions: Mapping[str, tuple[str, str]]
    metrics: Mapping[str, tuple[str, str, str | None]]
    hub: str = ""
    fans: tuple[str, ...] = ()
    facts: Mapping[str, tuple[str, str | None]] = field(default_factory=dict)

    def tables_above(self, table: str) -> set[str]:
        out = {table}
        for parent in self.links.get(table, {}):
            out |= self.tables_above(parent)
        return out


_FINISH = {
    "avg": lambda name: F.sum(f"{name}__sum") / F.nullif(F.sum(f"{name}__n"), F.lit(0)),
    "sum": lambda name: F.sum(f"{name}__sum"),
    "count": lambda name: F.sum(f"{name}__n"),
    "max": lambda name: F.max(f"{name}__max"),
    "min": lambda name: F.min(f"{name}__min"),
}


def _parts(name: str, fn: str, column: str | None) -> list[Column]:
    """Partial aggregates of one metric that can be added up again."""
    if fn == "count":
        return [F.count(F.lit(1)).alias(f"{name}__n")]
    if fn in ("max", "min"):
        return [getattr(F, fn)(column).alias(f"{name}__{fn}")]
    parts = [F.sum(column).alias(f"{name}__sum")]
    return parts + ([F.count(column).alias(f"{name}__n")] if fn == "avg" else [])


def _branch(star: Star, tables: Mapping[str, DataFrame], table: str, keep: list[Column], wanted: set[str]) -> DataFrame:
    """``keep`` columns of ``table`` plus the wanted dimensions found on it or above it."""
    own = {d: c for d, (t, c) in star.dimensions.items() if t == table and d in wanted}
    above = {}
    for parent, (fk, pk) in star.links.get(table, {}).items():
        names = {d for d in wanted if star.dimensions[d][0] in star.tables_above(parent)}
        if names:
            above[parent] = (fk, pk, names)
    df = tables[table].select(
        *keep,
        *[F.col(c).alias(d) for d, c in own.items()],
        *[F.col(fk).alias(f"_fk_{parent}") for parent, (fk, _, _) in above.items()],
    )
    for parent, (_, pk, names) in above.items():
        side = _branch(star, tables, parent, [F.col(pk).alias(f"_pk_{parent}")], names)
        df = df.join(side, F.col(f"_fk_{parent}") == F.col(f"_pk_{parent}"), "left")
        df = df.drop(f"_fk_{parent}", f"_pk_{parent}")
    return df


def _metric_group(
    star: Star, tables: Mapping[str, DataFrame], source: str, metrics: list[str], dims: list[str],
    extra: list[str], where: str | None,
) -> DataFrame:
    wanted = set(dims) | set(extra)
    direct = {d for d in wanted if star.dimensions[d][0] in star.tables_above(source)}
    fanned = wanted - direct
    specs = {m: star.metrics[m] for m in metrics}
    values = [F.col(c).alias(f"_v_{m}") for m, (_, _, c) in specs.items() if c]
    fan_of = {d: fan for d in fanned for fan in star.fans if star.dimensions[d][0] in star.tables_above(fan)}
    if source != star.fact and fanned or set(fan_of) != fanned:
        raise ValueError(f"dimensions {sorted(fanned)} are not reachable from {source}")
    hub_link = star.links.get(source, {}).get(star.hub)
    keep = values + ([F.col(hub_link[0]).alias("_hub")] if fanned else [])
    rows = _branch(star, tables, source, keep, direct)
    level = [F.col(d) for d in sorted(direct)] + ([F.col("_hub")] if fanned else [])
    # the filter sits on the rows when it can, else after the exposures are joined
    if where and not set(extra) & fanned:
        rows, where = rows.filter(where), None
    parts = [p for m, (_, fn, c) in specs.items() for p in _parts(m, fn, f"_v_{m}" if c else None)]
    summed = rows.groupBy(*level).agg(*parts)
    for fan in dict.fromkeys(fan_of.values()):
        names = {d for d, f in fan_of.items() if f == fan}
        fk = star.links[fan][star.hub][0]
        side = _branch(star, tables, fan, [F.col(fk).alias("_fan_hub")], names).distinct()
        summed = summed.join(side, F.col("_hub") == F.col("_fan_hub"), "left").drop("_fan_hub")
    if where:
        # a fund that matches by several exposures still counts once
        only_filtered = sorted((set(extra) & fanned) - set(dims))
        summed = summed.filter(where).drop(*only_filtered).distinct()
    return summed.groupBy(*dims).agg(*[_FINISH[fn](m).alias(m) for m, (_, fn, _) in specs.items()])


def query(
    star: Star,
    tables: Mapping[str, DataFrame],
    metrics: list[str],
    dimensions: list[str],
    where: str | None = None,
    where_dimensions: list[str] | None = None,
    period: str = LATEST_YEAR,
) -> DataFrame:
    """Metrics per combination of dimensions; ``where`` is SQL over ``where_dimensions``.

    Facts are those of the latest twelve months there are, unless ``period`` is ``ALL_TIME`` or the filter
    names a date. Without metrics, the distinct combinations of the dimensions (``values``).

    Metrics of different source tables are computed apart and brought together on the
    dimensions, so none is counted once per row of another. A metric whose source cannot reach
    a dimension is an error, as in the star's own rules.
    """
    extra = list(where_dimensions or [])
    unknown = [n for n in metrics if n not in star.metrics] + [
        d for d in [*dimensions, *extra] if d not in star.dimensions
    ]
    if unknown or not (metrics or dimensions):
        raise ValueError(f"unknown or missing names: {unknown}")
    if not metrics:
        return values(star, tables, dimensions, where, extra)
    tables = scoped(star, tables, extra, period)
    by_source: dict[str, list[str]] = {}
    for m in metrics:
        by_source.setdefault(star.metrics[m][0], []).append(m)
    groups = [_metric_group(star, tables, s, ms, dimensions, extra, where) for s, ms in by_source.items()]
    if len(groups) == 1:
        return groups[0].select(*dimensions, *metrics)

    def meet(left: DataFrame, right: DataFrame) -> DataFrame:
        renamed = right.withColumnsRenamed({d: f"_r_{d}" for d in dimensions})
        match = [F.col(d).eqNullSafe(F.col(f"_r_{d}")) for d in dimensions] or F.lit(True)
        joined = left.join(renamed, match, "full_outer")
        merged = {d: F.coalesce(F.col(d), F.col(f"_r_{d}")) for d in dimensions}
        return joined.withColumns(merged).drop(*[f"_r_{d}" for d in dimensions])

    return reduce(meet, groups).select(*dimensions, *metrics)


def scoped(star: Star, tables: Mapping[str, DataFrame], extra: list[str], period: str) -> Mapping[str, DataFrame]:
    """The tables with the fact cut to its latest twelve months, if the question names no dates."""
    if period == ALL_TIME or any(star.dimensions[d][0] == "dates" for d in extra):
        return tables
    fact = tables[star.fact]
    # the bound is a scalar subquery over the fact's own day numbers
    newest = F.to_date(fact.select(F.max("date_key").cast("string").alias("d")).scalar(), "yyyyMMdd")
    bound = F.date_format(F.add_months(newest, -12), "yyyyMMdd").cast("int")
    return _Replaced(tables, star.fact, fact.filter(F.col("date_key") > bound))


class _Replaced(Mapping):
    """Tables with one of them replaced; others stay unbuilt until a question reaches them."""

    def __init__(self, tables: Mapping[str, DataFrame], name: str, df: DataFrame):
        self.tables, self.name, self.df = tables, name, df

    def __getitem__(self, name: str) -> DataFrame:
        return self.df if name == self.name else self.tables[name]

    def __iter__(self):
        return iter(self.tables)

    def __len__(self) -> int:
        return len(self.tables)


def rows(
    star: Star, tables: Mapping[str, DataFrame], facts: list[str], dimensions: list[str], where: str | None = None,
    where_dimensions: list[str] | None = None, period: str = LATEST_YEAR,
) -> DataFrame:
    """One row per fact row, not aggregated: the named facts, all of one table, beside dimensions."""
    extra = [d for d in where_dimensions or [] if d not in dimensions]
    sources = {star.facts[f][0] for f in facts if f in star.facts}
    if len(sources) != 1 or any(f not in star.facts for f in facts):
        raise ValueError(f"facts must be known and of one table: {facts}")
    (source,) = sources
    wanted = {*dimensions, *extra}
    lost = {d for d in wanted if d not in star.dimensions or star.dimensions[d][0] not in star.tables_above(source)}
    if lost:
        raise ValueError(f"dimensions {sorted(lost)} are not reachable from {source}")
    if source == star.fact:
        tables = scoped(star, tables, list(where_dimensions or []), period)
    keep = [(F.col(c) if c else F.lit(1)).alias(f) for f in facts for c in [star.facts[f][1]]]
    out = _branch(star, tables, source, keep, wanted)
    return (out.filter(where) if where else out).select(*dimensions, *facts)


def values(
    star: Star, tables: Mapping[str, DataFrame], dimensions: list[str], where: str | None = None,
    where_dimensions: list[str] | None = None,
) -> DataFrame:
    """Distinct combinations of dimensions, from the table nearest to them that reaches them all."""
    wanted = {*dimensions, *(where_dimensions or [])}
    homes = {star.dimensions[d][0] for d in wanted}
    every = {star.fact, *star.fans, *(t for t, _ in star.dimensions.values())}
    able = [t for t in every if homes <= star.tables_above(t)]
    if not able:
        raise ValueError(f"no table reaches all of {sorted(wanted)}")
    source = min(able, key=lambda t: (len(star.tables_above(t)), t == star.fact, t))
    out = _branch(star, tables, source, [], wanted)
    return (out.filter(where) if where else out).select(*dimensions).distinct()


# --- the two stars ------------------------------------------------------------------------

_FUND_LINKS = {
    "providers": ("provider_key", "provider_key"),
    "indexes": ("index_key", "index_key"),
    "equivalence_groups": ("equivalence_group_key", "equivalence_group_key"),
}
_FUND_DIMENSIONS = {
    "ticker": ("etfs", "ticker"),
    "etf_code": ("etfs", "etf_code"),
    "isin": ("etfs", "isin"),
    "fund_name": ("etfs", "fund_name"),
    "asset_class": ("etfs", "asset_class"),
    "etf_category": ("etfs", "category"),
    "distribution_type": ("etfs", "distribution_type"),
    "replication_method": ("etfs", "replication_method"),
    "fund_currency": ("etfs", "currency"),
    "domicile": ("etfs", "domicile"),
    "hedged_flag": ("etfs", "hedged_flag"),
    "ucits_flag": ("etfs", "ucits_flag"),
    "ter": ("etfs", "ter"),
    "inception_date": ("etfs", "inception_date"),
    "provider_name": ("providers", "provider_name"),
    "index_name": ("indexes", "index_name"),
    "index_family": ("indexes", "index_family"),
    "index_region_type": ("indexes", "broad_region_type"),
    "equivalence_group_code": ("equivalence_groups", "equivalence_group_code"),
    "equivalence_group_name": ("equivalence_groups", "equivalence_group_name"),
    "canonical_exposure": ("equivalence_groups", "canonical_exposure"),
}
_CLASS_DIMENSIONS = {
    c: ("classifications", c)
    for c in (
        "role",
        "risk_band",
        "volatility_bucket",
        "drawdown_bucket",
        "trend_category",
        "core_satellite_flag",
    )
}


def _same_name(table: str, *columns: str) -> dict[str, tuple[str, str]]:
    return {c: (table, c) for c in columns}


PRICE_STAR = Star(
    fact="prices",
    links={
        "prices": {
            "dates": ("date_key", "date_key"),
            "assets": ("asset_key", "asset_key"),
            "etfs": ("asset_key", "etf_key"),
            "classifications": ("asset_key", "asset_key"),
        },
        "etfs": _FUND_LINKS,
    },
    dimensions={
        "price_date": ("dates", "full_date"),
        **_same_name(
            "dates",
            "day_name",
            "week_of_year",
            "month_number",
            "month_name",
            "quarter_number",
            "year_number",
            "trading_day_flag",
        ),
        **_FUND_DIMENSIONS,
        **_same_name("assets", "asset_subtype", "region", "country", "exchange"),
        **_CLASS_DIMENSIONS,
    },
    metrics={
        "average_close_price": ("prices", "avg", "close_price"),
        "average_adjusted_close_price": ("prices", "avg", "adj_close_price"),
        "highest_traded_price": ("prices", "max", "high_price"),
        "lowest_traded_price": ("prices", "min", "low_price"),
        "total_volume": ("prices", "sum", "volume"),
        "average_volume": ("prices", "avg", "volume"),
        "total_price_records": ("prices", "count", None),
    },
    facts={
        **{c: ("prices", c) for c in ("open_price", "high_price", "low_price", "close_price", "volume")},
        "adjusted_close_price": ("prices", "adj_close_price"),
        "price_record": ("prices", None),
    },
)

FUND_STAR = Star(
    fact="etf_facts",
    links={
        "etf_facts": {
            "dates": ("date_key", "date_key"),
            "etfs": ("etf_key", "etf_key"),
            "classifications": ("etf_key", "asset_key"),
        },
        "etfs": _FUND_LINKS,
        "etf_sectors": {"etfs": ("etf_key", "etf_key"), "sectors": ("sector_key", "sector_key")},
        "etf_geographies": {
            "etfs": ("etf_key", "etf_key"),
            "geographies": ("geography_key", "geography_key"),
        },
    },
    dimensions={
        "observation_date": ("dates", "full_date"),
        **_same_name("dates", "month_name", "quarter_number", "year_number"),
        **_FUND_DIMENSIONS,
        **_same_name("indexes", "developed_flag", "emerging_flag"),
        **_same_name("equivalence_groups", "group_type"),
        **_CLASS_DIMENSIONS,
        "sector_name": ("sectors", "sector_name"),
        **_same_name("geographies", "geography_name", "geography_group"),
    },
    metrics={
        "avg_close_price": ("etf_facts", "avg", "close_price"),
        "avg_return_1d": ("etf_facts", "avg", "return_1d"),
        "avg_return_1m": ("etf_facts", "avg", "return_1m"),
        "avg_return_1y": ("etf_facts", "avg", "return_1y"),
        "avg_volatility_30d": ("etf_facts", "avg", "volatility_30d"),
        "avg_drawdown_52w": ("etf_facts", "avg", "drawdown_52w"),
        "avg_sharpe_proxy": ("etf_facts", "avg", "sharpe_proxy"),
        "total_etf_records": ("etf_facts", "count", None),
        "avg_sector_exposure_weight": ("etf_sectors", "avg", "exposure_weight"),
        "avg_geography_exposure_weight": ("etf_geographies", "avg", "exposure_weight"),
    },
    hub="etfs",
    fans=("etf_sectors", "etf_geographies"),
    facts={
        **{
            c: ("etf_facts", c)
            for c in ("close_price", *[f"return_{h}" for h in ("1d", "1w", "1m", "3m", "6m", "1y")],
                      "volatility_30d", "drawdown_52w", "sharpe_proxy")
        },
        "sector_exposure_weight": ("etf_sectors", "exposure_weight"),
        "geography_exposure_weight": ("etf_geographies", "exposure_weight"),
        "etf_record": ("etf_facts", None),
    },
)
