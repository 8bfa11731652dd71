"""Mart models (the reporting tables).

Each aggregates before it joins: every join here is on day grain (one row per
date, or per date and catchment/node), so fact-to-fact joins are bounded by
the calendar, and dimensions with known row counts are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import (flag_at_least, label_periods, ratio, round_money, season, volatility_class,
                         year_month)
from ..operators import (count_distinct_if, count_if, days_since_last, enrich, lead_columns, percentiles,
                         rolling_count_if, rolling_sum, unmapped_total, weighted_total)
from .pipeline import Pipeline, model

DATE_DIM_COLUMNS = ["date_day", "year", "month_number", "month_name", "quarter_in_year", "day_of_week",
                    "season", "is_weekend", "month_year_label", "month_year_sort", "week_number",
                    "day_name_short"]


def with_dim_date(p: Pipeline, df: DataFrame, date_col: str, cols: list[str]) -> DataFrame:
    """Left join the calendar (broadcast: its row count is the day count of its range)."""
    dd, n = p.calendar()
    dim = dd.select(*(["date_day"] + [c for c in cols if c != "date_day"]))
    dim = dim.withColumn("__d", F.col("date_day"))
    out = enrich(df, dim, on=F.col(date_col) == F.col("__d"), how="left", dim_rows=n)
    return out.drop("__d")


def price_stats(df: DataFrame) -> list:
    """avg / min / max price rounded to 2 places (exact decimal rounding)."""
    pr = F.col("price_nzd_per_mwh")
    return [round_money(F.avg(pr)).alias("avg_price_nzd_per_mwh"),
            round_money(F.min(pr)).alias("min_price_nzd_per_mwh"),
            round_money(F.max(pr)).alias("max_price_nzd_per_mwh")]


@model("mart_generation_mix")
def mart_generation_mix(p: Pipeline) -> DataFrame:
    mix = p.ref("int_generation_mix_daily")
    joined = with_dim_date(p, mix, "trading_date", DATE_DIM_COLUMNS)
    return joined.select(
        *mix.columns, *DATE_DIM_COLUMNS,
        F.col("season").alias("dim_season"), F.col("year").alias("dim_year"),
        F.col("month_name").alias("dim_month_name"), F.col("quarter_in_year").alias("dim_quarter_in_year"),
        F.col("month_year_label").alias("dim_month_year_label"))


def gen_context(p: Pipeline) -> DataFrame:
    """One row per date: the day-constant columns of the mix (see day context)."""
    return p.ref("generation_day_context").select(
        "trading_date", "renewable_pct", "national_total_mwh", "nz_covid_period")


@model("generation_day_context")
def generation_day_context(p: Pipeline) -> DataFrame:
    """Per day from the (date, category) mix: national total, renewable share,
    emissions with coverage, intensity, and the period label.

    The carbon, price-vs-generation and risk marts all read this one
    aggregate, so each runs the generation chain once. The national total is
    the sum of the day's category totals (the same decimal sum the mix carries),
    renewable_pct is constant within a day, and the label is a function of the
    date, recomputed rather than aggregated as a string.
    """
    mix = p.ref("int_generation_mix_daily")
    factors, n = p.seed("emission_factors")
    joined = enrich(mix, factors, on="fuel_category", how="left", dim_rows=n)
    daily = joined.groupBy("trading_date").agg(
        F.sum("total_mwh").alias("national_total_mwh"),
        F.max("renewable_pct").alias("renewable_pct"),
        weighted_total("total_mwh", "emission_factor_kg_co2_per_mwh").alias("total_emissions_kg_co2"),
        unmapped_total("emission_factor_kg_co2_per_mwh", "total_mwh").alias("unmapped_generation_mwh"))
    return daily.select(
        "trading_date", "national_total_mwh", "renewable_pct", "total_emissions_kg_co2", "unmapped_generation_mwh",
        ratio("total_emissions_kg_co2", "national_total_mwh").alias("carbon_intensity_kg_co2_per_mwh"),
        ratio(F.col("national_total_mwh") - F.col("unmapped_generation_mwh"), "national_total_mwh")
        .alias("mapped_generation_pct"),
        label_periods("trading_date", C.COVID_PERIODS).alias("nz_covid_period"))


@model("price_daily_simple")
def price_daily_simple(p: Pipeline) -> DataFrame:
    s = p.ref("stg_wholesale_prices")
    return s.groupBy("trading_date").agg(*price_stats(s),
                                         count_if(F.col("is_price_spike")).alias("spike_periods_count"))


@model("mart_price_vs_generation")
def mart_price_vs_generation(p: Pipeline) -> DataFrame:
    g = gen_context(p).select(
        "trading_date",
        F.year("trading_date").alias("year"), F.month("trading_date").alias("month"),
        F.quarter("trading_date").alias("quarter"), year_month("trading_date").alias("year_month"),
        "renewable_pct", "national_total_mwh", "nz_covid_period")
    prices = p.ref("price_daily_simple")
    return g.join(prices, on="trading_date", how="left")


@model("mart_carbon_intensity_daily")
def mart_carbon_intensity_daily(p: Pipeline) -> DataFrame:
    # The source reads mart_generation_mix, i.e. the mix left-joined to a
    # unique-key calendar, so its (date, category, mwh) rows are the mix's own
    # rows; renewable_pct is the per-day value of mart_price_vs_generation.
    ctx = p.ref("generation_day_context")
    out = ctx.select(
        "trading_date", F.col("national_total_mwh").alias("total_generation_mwh"), "total_emissions_kg_co2",
        "carbon_intensity_kg_co2_per_mwh", "unmapped_generation_mwh", "mapped_generation_pct", "renewable_pct")
    cols = ["date_day", "year", "month_number", "month_name", "quarter_in_year", "season", "month_year_label"]
    return with_dim_date(p, out, "trading_date", cols).select(*out.columns, *cols)


@model("mart_daily_demand")
def mart_daily_demand(p: Pipeline) -> DataFrame:
    s = p.ref("stg_wholesale_prices")
    # Aggregate by date first, then attach the calendar (same rows as grouping by
    # the calendar columns too, with one key instead of eight).
    daily = s.groupBy("trading_date").agg(
        F.sum("load_mwh").alias("total_demand_mwh"),
        F.avg("load_mwh").alias("avg_trading_period_demand_mwh"),
        F.max("load_mwh").alias("peak_trading_period_demand_mwh"))
    cols = ["date_day", "year", "month_number", "month_name", "quarter_in_year", "season", "month_year_label"]
    return with_dim_date(p, daily, "trading_date", cols).select(*daily.columns, *cols)


@model("weather_by_catchment")
def weather_by_catchment(p: Pipeline) -> DataFrame:
    w = p.ref("int_weather_catchment_daily")
    return w.groupBy("observation_date", "catchment", "island").agg(
        F.sum("precipitation_mm").alias("total_precip_mm"),
        F.avg("precipitation_mm").alias("avg_precip_mm"),
        F.sum("snowfall_cm").alias("total_snowfall_cm"),
        F.avg("mean_temp_c").alias("mean_temp_c"),
        F.min("min_temp_c").alias("min_temp_c"),
        F.count_distinct("location").alias("lake_count"))


@model("prices_by_node_daily")
def prices_by_node_daily(p: Pipeline) -> DataFrame:
    s = p.ref("stg_wholesale_prices")
    bridge, n = p.seed("dim_concatchment_node")
    # Only bridge nodes are ever joined, so drop the rest before aggregating
    # (a broadcast semi join against the bridge seed).
    s = enrich(s, bridge.select(F.col("pricing_node").alias("node")), on="node", how="left_semi", dim_rows=n)
    return s.groupBy("trading_date", "node").agg(
        *price_stats(s),
        F.sum("load_mwh").alias("total_load_mwh"),
        F.sum("generation_mwh").alias("total_generation_mwh"),
        count_if(F.col("is_price_spike")).alias("spike_periods_count"))


@model("mart_catchment_weather_pricing_daily")
def mart_catchment_weather_pricing_daily(p: Pipeline) -> DataFrame:
    w = p.ref("weather_by_catchment")
    bridge, n = p.seed("dim_concatchment_node")
    prices = p.ref("prices_by_node_daily")
    joined = enrich(w, bridge, on="catchment", how="inner", dim_rows=n)
    joined = joined.join(prices, on=(joined["pricing_node"] == prices["node"])
                         & (joined["observation_date"] == prices["trading_date"]), how="left")
    joined = joined.drop("node", "trading_date")
    cal = ["year", "month_name", "day_of_week", "is_weekend", "month_year_label"]
    joined = with_dim_date(p, joined, "observation_date", cal).drop("date_day")
    base = ["observation_date", "catchment", "island", "pricing_node", "total_precip_mm", "avg_precip_mm",
            "total_snowfall_cm", "mean_temp_c", "min_temp_c", "lake_count", "avg_price_nzd_per_mwh",
            "min_price_nzd_per_mwh", "max_price_nzd_per_mwh", "total_load_mwh", "total_generation_mwh",
            "spike_periods_count"] + cal
    part, order = ["catchment"], ["observation_date", "island"]
    windows = {
        "season": season("observation_date", case="lower"),
        "is_wet_day": flag_at_least("avg_precip_mm", C.WET_DAY_MM),
        "is_heavy_rain_day": flag_at_least("avg_precip_mm", C.HEAVY_RAIN_MM),
    }
    for n_rows in C.ROLLING_LENGTHS:
        windows[f"precip_{n_rows}d_rolling_sum"] = rolling_sum("total_precip_mm", part, order, n_rows)
    windows.update(lead_columns("avg_price_nzd_per_mwh", part, order, C.LEAD_OFFSETS, "price_lead_{k}d"))
    return joined.select(*base).withColumns(windows)


@model("price_daily_risk")
def price_daily_risk(p: Pipeline) -> DataFrame:
    """Daily price shape and spike measures, lazily: the plain measures from
    ``price_daily_spikes`` (models without percentiles read that one alone) and the exact
    percentiles as a branch of their own."""
    s = p.ref("stg_wholesale_prices")
    pct = percentiles(s, ["trading_date"], "price_nzd_per_mwh", [0.5, 0.95], ["__median", "__p95"],
                      strategy=p.percentile_strategy)
    return p.ref("price_daily_spikes").join(pct, on="trading_date", how="left").select(
        "trading_date", "avg_price_nzd_per_mwh", "min_price_nzd_per_mwh", "max_price_nzd_per_mwh",
        round_money("__median").alias("median_price_nzd_per_mwh"),
        round_money("__p95").alias("p95_price_nzd_per_mwh"),
        "spike_records_count", "spike_periods_distinct")


@model("price_daily_spikes")
def price_daily_spikes(p: Pipeline) -> DataFrame:
    """Daily price range and spike measures: one aggregate, one exchange."""
    s = p.ref("stg_wholesale_prices")
    spike = F.col("is_price_spike")
    return s.groupBy("trading_date").agg(
        *price_stats(s),
        count_if(spike).alias("spike_records_count"),
        count_distinct_if(spike, "trading_period").alias("spike_periods_distinct"))


@model("mart_price_risk_daily")
def mart_price_risk_daily(p: Pipeline) -> DataFrame:
    pdly = p.ref("price_daily_risk")
    # generation and carbon context are one day-grain relation: a single join
    ctx = p.ref("generation_day_context").select(
        "trading_date", "renewable_pct", "national_total_mwh", "nz_covid_period", "carbon_intensity_kg_co2_per_mwh")
    joined = pdly.join(ctx, on="trading_date", how="left")
    joined = joined.select(
        "trading_date", "avg_price_nzd_per_mwh", "min_price_nzd_per_mwh", "max_price_nzd_per_mwh",
        "median_price_nzd_per_mwh", "p95_price_nzd_per_mwh",
        (F.col("max_price_nzd_per_mwh") - F.col("min_price_nzd_per_mwh")).alias("price_range_nzd_per_mwh"),
        "spike_records_count", "spike_periods_distinct",
        (F.col("spike_periods_distinct") > 0).alias("is_spike_day"),
        volatility_class("p95_price_nzd_per_mwh", "spike_periods_distinct").alias("volatility_class"),
        "renewable_pct", "national_total_mwh", "nz_covid_period", "carbon_intensity_kg_co2_per_mwh")
    return add_risk_windows(joined)


def add_risk_windows(df: DataFrame) -> DataFrame:
    """Rolling spike breadth/depth and days since the last spike over a day-grain series."""
    order = ["trading_date"]
    cols = {}
    for n in C.ROLLING_LENGTHS:
        cols[f"spike_days_last_{n}"] = rolling_count_if(F.col("is_spike_day"), None, order, n, day_grain=True)
    for n in C.ROLLING_LENGTHS:
        cols[f"spike_periods_distinct_last_{n}"] = rolling_sum("spike_periods_distinct", None, order, n,
                                                               day_grain=True)
    cols["days_since_last_spike"] = days_since_last("trading_date", F.col("is_spike_day"), None, day_grain=True)
    return df.withColumns(cols)
