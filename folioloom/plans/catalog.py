"""The model catalogue: how each table is made from the others.

Models are lazy. Without a store they compose into one plan per question, so filters and
column pruning reach the scan. With a store each is written once and its consumers read the
file, which is how the full build runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark.sql import DataFrame

from folioloom.operators import dimensions as dim
from folioloom.operators import marts, pairs, series
from folioloom.operators import staging as stg
from folioloom.session import write_once
from folioloom.sources.store import Store

# Asset and fund tables that many branches of a star question start from.
UNIVERSE = ("stg_asset_master", "stg_etf_metadata")
# Tables that questions over exposures and stars reach more than once; each is an aggregate of all order lines.
EXPOSURES = ("stg_etf_sector", "stg_etf_geography")
PRICES = ("stg_asset_prices",)
# Fixed value: models built at the same time.
BUILD_THREADS = 10

Builder = Callable[["Models"], DataFrame]
MODELS: dict[str, tuple[str, Builder]] = {}


def _model(layer: str, name: str, build: Builder) -> None:
    MODELS[name] = (layer, build)


class Models:
    """Named models over raw tables; ``raw`` maps a raw table name to a function that returns it.

    ``share`` names models of an otherwise lazy plan that are stored: a question over a star reaches
    them through many branches, which then scan one file of known size.
    """

    def __init__(
        self,
        raw: Mapping[str, Callable[[], DataFrame]],
        regime_tickers: Mapping[str, str] = marts.REGIME_TICKERS,
        store: Store | None = None,
        slice_rows: int | None = None,
        share: Iterable[str] = (),
    ):
        self.raw_tables, self.regime_tickers, self.store = raw, regime_tickers, store
        self.share = frozenset(share)
        self.slice_rows = slice_rows
        self._made: dict[str, DataFrame] = {}
        names = [*MODELS, *(f"raw.{r}" for r in raw), "correlations", "series_prices"]
        self._locks = {n: Lock() for n in names}

    def raw(self, name: str) -> DataFrame:
        return self._once(f"raw.{name}", self.raw_tables[name])

    def __getitem__(self, name: str) -> DataFrame:
        return self._once(name, lambda: self._build(name))

    def _once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        # one lock per model: models depend on each other without cycles, so waiting is safe
        with self._locks[name]:
            if name not in self._made:
                self._made[name] = make()
            return self._made[name]

    def _build(self, name: str) -> DataFrame:
        layer, build = MODELS[name]
        df = build(self)
        if self.store is None:
            return write_once(df, name) if name in self.share else df
        return self.store.write(layer, name, df)

    def build(self, names: Iterable[str] | None = None, threads: int = BUILD_THREADS) -> dict[str, DataFrame]:
        """Named models (all by default); with a store, several are written at the same time."""
        wanted = list(names or MODELS)
        with ThreadPoolExecutor(threads) as pool:
            return dict(zip(wanted, pool.map(self.__getitem__, wanted), strict=True))

    @property
    def series_prices(self) -> DataFrame:
        """Price rows for the series models.

        The stored build takes every measure in one pass over the series and keeps the result, from which the
        models are projections; ``slice_rows`` cuts series longer than a task should hold. The lazy
        form leaves plain prices, so that a question computes only the measures it shows.
        """

        def make() -> DataFrame:
            prices = self["stg_asset_prices"]
            if self.slice_rows:
                prices = write_once(series.slice_series(prices, self.slice_rows), "slices")
            return prices if self.store is None else write_once(series.risk_and_trend(prices), "measured")

        return self._once("series_prices", make)

    @property
    def fund_prices(self) -> DataFrame:
        return marts.only_funds(self.series_prices, self["dim_etf_profile"])

    @property
    def fund_star(self) -> DataFrame:
        return marts.fund_star(
            self["dim_etf"],
            self["dim_etf_profile"],
            self["dim_provider"],
            self["dim_index"],
            self["dim_equivalence_group"],
        )

    @property
    def correlations(self) -> DataFrame:
        """Both spans of every pair; computed once and shared by the three models that show it."""

        def make() -> DataFrame:
            both = pairs.latest_correlations(self["int_asset_returns"])
            return both if self.store is None else write_once(both, "correlations")

        return self._once("correlations", make)


for _name, _build in {
    "stg_asset_master": lambda m: stg.stg_asset_master(m.raw("asset_master")),
    "stg_asset_prices": lambda m: stg.stg_asset_prices(m.raw("asset_prices"), m["stg_asset_master"]),
    "stg_etf_metadata": lambda m: stg.stg_etf_metadata(m.raw("etf_metadata"), m["stg_asset_master"]),
    "stg_etf": lambda m: stg.stg_etf(m["stg_etf_metadata"]),
    "stg_etf_geography": lambda m: stg.stg_etf_geography(m.raw("etf_geography"), m["stg_etf_metadata"]),
    "stg_etf_sector": lambda m: stg.stg_etf_sector(m.raw("etf_sector"), m["stg_etf_metadata"]),
    "stg_geography": lambda m: stg.stg_geography(m["stg_etf_geography"]),
    "stg_sector": lambda m: stg.stg_sector(m["stg_etf_sector"]),
    "stg_equivalence_group": lambda m: stg.stg_equivalence_group(m.raw("equivalence_groups")),
    "stg_equivalence_group_relationships": lambda m: stg.stg_equivalence_group_relationships(
        m.raw("equivalence_group_relationships")
    ),
    "stg_yfinance": lambda m: stg.stg_yfinance(m["stg_asset_prices"]),
}.items():
    _model("stg", _name, _build)

for _name, _build in {
    "dim_asset": lambda m: dim.dim_asset(m["stg_asset_master"], m["stg_asset_prices"]),
    "dim_date": lambda m: dim.dim_date(m["stg_asset_prices"]),
    "dim_asset_classification": lambda m: dim.dim_asset_classification(
        m["stg_asset_master"], series.risk_and_trend(series.latest_rows(m["stg_asset_prices"]))
    ),
    "dim_etf_profile": lambda m: dim.dim_etf_profile(m["stg_etf_metadata"]),
}.items():
    _model("dimensions", _name, _build)

for _name, _build in {
    "int_asset_returns": lambda m: series.int_asset_returns(m.series_prices),
    "int_asset_volatility": lambda m: series.int_asset_volatility(m.series_prices),
    "int_asset_drawdown": lambda m: series.int_asset_drawdown(m.series_prices),
    "int_asset_trend_inputs": lambda m: series.int_asset_trend_inputs(m.series_prices),
    "int_asset_pair_returns": lambda m: pairs.int_asset_pair_returns(m["int_asset_returns"]),
    "int_asset_correlation_30d": lambda m: pairs.correlation_model(m.correlations, 30),
    "int_asset_correlation_90d": lambda m: pairs.correlation_model(m.correlations, 90),
    "int_asset_risk_enriched": lambda m: series.int_asset_risk_enriched(m.series_prices),
}.items():
    _model("int", _name, _build)

for _name, _build in {
    "dim_provider": lambda m: dim.dim_provider(m["dim_etf_profile"]),
    "dim_index": lambda m: dim.dim_index(m["dim_etf_profile"]),
    "dim_equivalence_group": lambda m: dim.dim_equivalence_group(m["stg_equivalence_group"]),
    "dim_etf": lambda m: dim.dim_etf(m["dim_etf_profile"], m["stg_asset_master"]),
    "dim_geography": lambda m: dim.dim_geography(m["stg_etf_geography"]),
    "dim_sector": lambda m: dim.dim_sector(m["stg_etf_sector"]),
    "bridge_etf_geography": lambda m: dim.bridge_etf_geography(
        m["stg_etf_geography"], m["dim_etf_profile"]
    ),
    "bridge_etf_sector": lambda m: dim.bridge_etf_sector(
        m["stg_etf_sector"], m["dim_etf_profile"]
    ),
    "fact_asset_price_daily": lambda m: marts.fact_asset_price_daily(m["stg_asset_prices"]),
    "fact_etf_daily": lambda m: marts.fact_etf_daily(m.fund_prices, m["dim_etf_profile"]),
    "mart_asset_returns": lambda m: marts.mart_asset_returns(m.series_prices),
    "mart_asset_risk": lambda m: marts.mart_asset_risk(m.series_prices),
    "mart_asset_trend": lambda m: marts.mart_asset_trend(m.series_prices),
    "mart_asset_moves": lambda m: marts.mart_asset_moves(m.series_prices),
    "mart_fx_intelligence": lambda m: marts.mart_fx_intelligence(m.series_prices),
    "mart_market_regime": lambda m: marts.mart_market_regime(m.series_prices, m.regime_tickers),
    "mart_etf_overlap": lambda m: pairs.mart_etf_overlap(
        m["stg_etf_sector"], m["stg_etf_geography"], m["stg_asset_master"]
    ),
    "mart_etf_equivalence": lambda m: pairs.mart_etf_equivalence(
        m["dim_etf_profile"], m["stg_asset_master"], m["dim_equivalence_group"]
    ),
    "mart_fee_benchmarks": lambda m: marts.mart_fee_benchmarks(
        m["dim_etf_profile"], m["stg_asset_master"], m["dim_equivalence_group"]
    ),
}.items():
    _model("marts", _name, _build)

EXPORTS = {
    "export_market_returns": "mart_asset_returns",
    "export_market_risk": "mart_asset_risk",
    "export_market_trends": "mart_asset_trend",
    "export_fx_intelligence": "mart_fx_intelligence",
    "export_market_regime": "mart_market_regime",
    "export_etf_overlap": "mart_etf_overlap",
    "export_etf_equivalence": "mart_etf_equivalence",
    "export_fee_benchmarks": "mart_fee_benchmarks",
}
for _name, _source in EXPORTS.items():
    _model("exports", _name, lambda m, source=_source: m[source])
_model(
    "exports",
    "export_market_correlations",
    lambda m: pairs.export_market_correlations(m.correlations, m["stg_asset_master"]),
)
_model("reports", "daily_prices", lambda m: marts.daily_prices(m.fund_prices, m.fund_star))
