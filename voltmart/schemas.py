"""Declared schemas of the raw tables, seeds and file inputs."""

from __future__ import annotations

from pyspark.sql import types as T

KW = T.DecimalType(18, 6)        # kW / MW / price: unconstrained numeric in the source
PRECIP = T.DecimalType(6, 2)
TEMP = T.DecimalType(5, 2)

RAW_GENERATION = T.StructType([
    T.StructField("site_code", T.StringType()),
    T.StructField("poc_code", T.StringType()),
    T.StructField("nwk_code", T.StringType()),
    T.StructField("gen_code", T.StringType()),
    T.StructField("fuel_code", T.StringType()),
    T.StructField("tech_code", T.StringType()),
    T.StructField("trading_date", T.DateType(), nullable=False),
    T.StructField("trading_period", T.ShortType(), nullable=False),
    T.StructField("output_kw", KW),
])

RAW_PRICES = T.StructType([
    T.StructField("trading_date", T.DateType(), nullable=False),
    T.StructField("trading_period", T.ShortType(), nullable=False),
    T.StructField("node", T.StringType(), nullable=False),
    T.StructField("price", KW),
    T.StructField("load_mw", KW),
    T.StructField("generation_mw", KW),
])

RAW_RETAIL = T.StructType([
    T.StructField("region", T.StringType()),
    T.StructField("network", T.StringType()),
    T.StructField("period_start", T.DateType()),
    T.StructField("period_end", T.DateType()),
    T.StructField("avg_cost_cents_per_kwh", T.DecimalType(18, 6)),
    T.StructField("avg_use_kwh", T.DecimalType(18, 6)),
    T.StructField("raw_filename", T.StringType()),
])

RAW_WEATHER = T.StructType([
    T.StructField("location", T.StringType(), nullable=False),
    T.StructField("time", T.DateType(), nullable=False),
    T.StructField("precipitation_sum", PRECIP),
    T.StructField("rain_sum", PRECIP),
    T.StructField("snowfall_sum", PRECIP),
    T.StructField("temperature_2m_mean", TEMP),
    T.StructField("temperature_2m_max", TEMP),
    T.StructField("temperature_2m_min", TEMP),
    T.StructField("inserted_at", T.TimestampType(), nullable=False),
])

# Weather CSV as exported by the fetch step (no audit column).
WEATHER_CSV = T.StructType([f for f in RAW_WEATHER.fields if f.name != "inserted_at"])

# Weather API document: parallel arrays under `daily`.
WEATHER_JSON = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("daily_units", T.MapType(T.StringType(), T.StringType())),
    T.StructField("daily", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("precipitation_sum", T.ArrayType(T.DoubleType())),
        T.StructField("rain_sum", T.ArrayType(T.DoubleType())),
        T.StructField("snowfall_sum", T.ArrayType(T.DoubleType())),
        T.StructField("temperature_2m_mean", T.ArrayType(T.DoubleType())),
        T.StructField("temperature_2m_max", T.ArrayType(T.DoubleType())),
        T.StructField("temperature_2m_min", T.ArrayType(T.DoubleType())),
    ])),
])

EMISSION_FACTORS = T.StructType([
    T.StructField("fuel_category", T.StringType(), nullable=False),
    T.StructField("emission_factor_kg_co2_per_mwh", T.IntegerType()),
])

CATCHMENT_NODE = T.StructType([
    T.StructField("catchment", T.StringType(), nullable=False),
    T.StructField("pricing_node", T.StringType()),
])

LOCATIONS = T.StructType([
    T.StructField("location", T.StringType(), nullable=False),
    T.StructField("lake_name", T.StringType()),
    T.StructField("catchment", T.StringType()),
    T.StructField("island", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

SEEDS = {
    "emission_factors": EMISSION_FACTORS,
    "dim_concatchment_node": CATCHMENT_NODE,
    "dim_locations": LOCATIONS,
}


def ddl(schema: T.StructType) -> str:
    """Column list for ``CREATE TABLE IF NOT EXISTS ... USING parquet``."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
