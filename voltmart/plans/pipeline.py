"""Model registry: each model is ``f(pipeline) -> DataFrame`` that reads raw
tables with ``p.source(name)`` and upstream models with ``p.ref(name)``.

Models are lazy DataFrames; ``ref`` memoises the plan object, so one build of
several marts shares the same upstream plan. ``materialise`` writes a model
to storage and re-reads it, which cuts lineage for models with several
consumers (stg_wholesale_prices has four).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..sinks.tables import materialise
from ..sources import calendar as cal
from ..sources import seeds

MODELS: dict[str, Callable[["Pipeline"], DataFrame]] = {}


def model(name: str):
    def deco(f):
        MODELS[name] = f
        return f
    return deco


class Pipeline:
    """Raw tables in, models out.

    raw: mapping with any of generation_output, wholesale_prices, weather_daily,
    retail_prices: DataFrames shaped like schemas.RAW_*, or zero-argument
    callables returning them (built only if a model reads them). Seeds default to the
    fixed values; dim_date to the fixed calendar range.
    """

    def __init__(self, spark: SparkSession, raw: Mapping[str, DataFrame | Callable[[], DataFrame]],
                 seeds_override: Mapping[str, tuple[DataFrame, int | None]] | None = None,
                 percentile_strategy: str = "distributed", share_form: str = "window"):
        self.spark = spark
        self.raw = dict(raw)
        self._seeds = dict(seeds_override or {})
        self._built: dict[str, DataFrame] = {}
        self._rows: dict[str, int | None] = {}
        self.percentile_strategy = percentile_strategy
        self.share_form = share_form

    # -- inputs
    def source(self, name: str) -> DataFrame:
        """A raw table; a callable entry is built on first use and kept."""
        if name not in self.raw:
            raise KeyError(f"raw table {name!r} not provided")
        if callable(self.raw[name]):
            self.raw[name] = self.raw[name]()
        return self.raw[name]

    def seed(self, name: str) -> tuple[DataFrame, int | None]:
        if name not in self._seeds:
            self._seeds[name] = seeds.seed(self.spark, name)
        return self._seeds[name]

    def calendar(self) -> tuple[DataFrame, int]:
        if "dim_date" not in self._built:
            df, n = cal.dim_date(self.spark)
            self._built["dim_date"], self._rows["dim_date"] = df, n
        return self._built["dim_date"], self._rows["dim_date"]

    # -- models
    def ref(self, name: str) -> DataFrame:
        if name == "dim_date":
            return self.calendar()[0]
        if name not in self._built:
            if name not in MODELS:
                raise KeyError(f"unknown model {name!r}")
            self._built[name] = MODELS[name](self)
        return self._built[name]

    def materialise(self, name: str, path: str, sort_by: Sequence[str] = ()) -> str:
        """Write a model as a new version under `path`, use the written copy downstream, return its path."""
        written = materialise(self.ref(name), path, sort_by)
        self._built[name] = self.spark.read.parquet(written)
        return written
