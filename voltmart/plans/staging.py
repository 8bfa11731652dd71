"""Staging models: rename, convert units, flag, classify. Filters come first so
Catalyst pushes them into the Parquet scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import flag_above, is_in_flag, kw_to_mwh, map_codes, mw_to_mwh, period_start
from .pipeline import Pipeline, model


@model("stg_generation")
def stg_generation(p: Pipeline) -> DataFrame:
    g = p.source("generation_output")
    kw = F.col("output_kw")
    return g.where(kw.isNotNull() & (kw >= 0)).select(
        "site_code", "poc_code", "nwk_code",
        F.col("gen_code").alias("station_name"),
        "fuel_code", "tech_code", "trading_date", "trading_period", "output_kw",
        kw_to_mwh(kw).alias("output_mwh"),
        is_in_flag("fuel_code", C.RENEWABLE_FUEL_CODES).alias("is_renewable"),
        map_codes("fuel_code", C.FUEL_CATEGORY_RULES, C.FUEL_CATEGORY_DEFAULT).alias("fuel_category"),
        period_start("trading_date", "trading_period").alias("period_start_at"),
    )


@model("stg_wholesale_prices")
def stg_wholesale_prices(p: Pipeline) -> DataFrame:
    w = p.source("wholesale_prices")
    return w.where(F.col("price").isNotNull()).select(
        "trading_date", "trading_period", "node",
        F.col("price").alias("price_nzd_per_mwh"),
        "load_mw",
        mw_to_mwh("load_mw").alias("load_mwh"),
        "generation_mw",
        mw_to_mwh("generation_mw").alias("generation_mwh"),
        flag_above("price", C.SPIKE_LIMIT).alias("is_price_spike"),
        period_start("trading_date", "trading_period").alias("period_start_at"),
    )


@model("stg_weather_daily")
def stg_weather_daily(p: Pipeline) -> DataFrame:
    w = p.source("weather_daily")
    return w.select(
        "location",
        F.col("time").alias("observation_date"),
        F.col("precipitation_sum").alias("precipitation_mm"),
        F.col("rain_sum").alias("rain_mm"),
        F.col("snowfall_sum").alias("snowfall_cm"),
        F.col("temperature_2m_mean").alias("mean_temp_c"),
        F.col("temperature_2m_max").alias("max_temp_c"),
        F.col("temperature_2m_min").alias("min_temp_c"),
        F.year("time").alias("observation_year"),
        F.month("time").alias("observation_month"),
        "inserted_at",
    )


@model("stg_retail_prices")
def stg_retail_prices(p: Pipeline) -> DataFrame:
    return p.source("retail_prices")
