"""Intermediate models: station-day rollup, national mix with shares, weather
enriched with lake metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import label_periods, ratio
from ..operators import completeness_pct, enrich, share_of_total, sum_if
from .pipeline import Pipeline, model


@model("int_generation_daily")
def int_generation_daily(p: Pipeline) -> DataFrame:
    g = p.ref("stg_generation")
    return (g.groupBy("trading_date", "station_name", "fuel_code", "fuel_category", "is_renewable",
                      F.col("nwk_code").alias("network"))
            .agg(F.sum("output_mwh").alias("total_mwh"),
                 F.count(F.lit(1)).alias("trading_periods_with_data"),
                 completeness_pct(C.EXPECTED_PERIODS).alias("data_completeness_pct")))


@model("int_generation_mix_daily")
def int_generation_mix_daily(p: Pipeline) -> DataFrame:
    daily = p.ref("int_generation_daily")
    national = (daily.groupBy("trading_date", "fuel_category", "is_renewable")
                .agg(F.sum("total_mwh").alias("total_mwh")))
    shared = share_of_total(
        national, ["trading_date"], "total_mwh", "national_total_mwh", "pct_of_national",
        form=p.share_form,
        extra_totals={"renewable_mwh": sum_if(F.col("is_renewable"), "total_mwh")})
    return shared.select(
        "trading_date", "fuel_category", "is_renewable", "total_mwh", "national_total_mwh",
        "pct_of_national",
        ratio("renewable_mwh", "national_total_mwh", scale=2, times=100).alias("renewable_pct"),
        label_periods("trading_date", C.COVID_PERIODS).alias("nz_covid_period"),
    )


@model("int_weather_catchment_daily")
def int_weather_catchment_daily(p: Pipeline) -> DataFrame:
    w = p.ref("stg_weather_daily")
    locations, n = p.seed("dim_locations")
    joined = enrich(w, locations, on="location", how="inner", dim_rows=n)
    return joined.select(
        "observation_date", "location", "lake_name", "catchment", "island", "latitude", "longitude",
        "precipitation_mm", "rain_mm", "snowfall_cm", "mean_temp_c", "max_temp_c", "min_temp_c",
        "observation_year", "observation_month",
    )
