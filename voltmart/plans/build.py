"""Build every mart as a table (full refresh), like one run of the model DAG.

Models with several consumers are written once and read back, so each later
mart starts from stored rows instead of recomputing (and re-shuffling) the
upstream chain: stg_wholesale_prices feeds four marts, int_generation_mix_daily
three. Marts are written sorted within files by their date so Parquet min/max
statistics prune date filters on read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sinks.tables import materialise
from .pipeline import Pipeline

SHARED = ("stg_wholesale_prices", "int_generation_mix_daily")

MARTS = {
    "dim_date": ["date_day"],
    "mart_generation_mix": ["trading_date", "fuel_category"],
    "mart_price_vs_generation": ["trading_date"],
    "mart_carbon_intensity_daily": ["trading_date"],
    "mart_daily_demand": ["trading_date"],
    "mart_catchment_weather_pricing_daily": ["observation_date", "catchment"],
    "mart_price_risk_daily": ["trading_date"],
}


def build_all(p: Pipeline, out_dir: str, marts: dict[str, list[str]] | None = None) -> dict[str, str]:
    """Write shared models, then each mart, under `out_dir`; returns name -> path of the version written."""
    out_dir = out_dir.rstrip("/")
    paths: dict[str, str] = {}
    for name in SHARED:
        paths[name] = p.materialise(name, f"{out_dir}/_shared/{name}", sort_by=["trading_date"])
    for name, sort_by in (marts or MARTS).items():
        df: DataFrame = p.ref(name)
        paths[name] = materialise(df, f"{out_dir}/{name}", sort_by=sort_by)
    return paths
