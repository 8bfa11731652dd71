"""Shape the driver's test tables like the raw electricity tables.

The test parquet (events, orders, lineitem) carries no electricity data, so
each adapter maps it by fixed rules onto a raw table's columns and types.
Every rule is a native expression over the whole table: nothing is sampled or
capped, and the output grows with the input. Dates from 1995-2001 are moved by
DATE_SHIFT days into the calendar range (2020-2026).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
DATE_SHIFT = 9131
PRICE_NODES = ("BEN2202", "MAN2201", "ROX2201", "ARA2201")
DAY_PRICE_FACTORS = (Decimal("0.5"), Decimal("1.0"), Decimal("2.0"), Decimal("2.0"),
                     Decimal("4.0"), Decimal("8.0"), Decimal("1.0"))
FUEL_CODES = ("Hydro", "Geo", "Wind", "Gas", "Gas&Oil", "Coal", "Diesel", "Wood", "Solar")
LAKES = ("lake_pukaki", "lake_tekapo", "lake_ohau", "lake_hawea", "lake_manapouri",
         "lake_te_anau", "lake_taupo")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values, index) -> F.Column:
    """values[index] (0-based) from a literal array."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + F.lit(1))


def _dec(c, p=18, s=6):
    return c.cast(f"decimal({p},{s})")


def raw_prices_events(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nodal prices over 30 days, 4 nodes, 48 periods, with duplicate keys.

    `event_id` is the arrival order for first-wins loading; `keep` carries more
    source columns through (for tests that derive faults from them).
    """
    e = table(spark, sf_dir, "events")
    v = _dec(F.col("value"))
    return e.select(
        F.to_date("ts").alias("trading_date"),
        (F.hour("ts") * 2 + F.floor(F.minute("ts") / 30) + 1).cast("smallint").alias("trading_period"),
        _pick(PRICE_NODES, F.col("user_id") % 4).alias("node"),
        _dec(v * _pick(DAY_PRICE_FACTORS, F.dayofmonth("ts") % 7)).alias("price"),
        _dec(v * F.lit(Decimal("1.5"))).alias("load_mw"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("decimal(18,6)"))
         .otherwise(_dec(v * F.lit(Decimal("0.7")))).alias("generation_mw"),
        F.col("event_id"),
        *keep,
    )


def raw_prices_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodal prices over 2020-2026 (for joins with generation and leads).

    `o_orderkey` is the arrival order.
    """
    o = table(spark, sf_dir, "orders")
    tp = _dec(F.col("o_totalprice"), 18, 2)
    return o.select(
        F.date_add(F.to_date("o_orderdate"), DATE_SHIFT).alias("trading_date"),
        (F.col("o_orderkey") % 48 + 1).cast("smallint").alias("trading_period"),
        _pick(PRICE_NODES, F.col("o_custkey") % 4).alias("node"),
        _dec(tp * F.lit(Decimal("0.0012"))).alias("price"),
        _dec(tp * F.lit(Decimal("0.001"))).alias("load_mw"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("decimal(18,6)"))
         .otherwise(_dec(tp * F.lit(Decimal("0.0005")))).alias("generation_mw"),
        F.col("o_orderkey"),
    )


def raw_generation_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-hourly generation per unit; nulls, negatives and an unmapped fuel included.

    (l_orderkey, l_linenumber) is the arrival order.
    """
    li = table(spark, sf_dir, "lineitem")
    pk50 = F.col("l_partkey") % 50
    return li.select(
        F.col("l_suppkey").cast("string").alias("site_code"),
        F.concat(F.lit("POC"), F.col("l_suppkey").cast("string")).alias("poc_code"),
        F.concat(F.lit("NW"), (F.col("l_suppkey") % 5).cast("string")).alias("nwk_code"),
        F.concat(F.lit("ST"), F.col("l_suppkey").cast("string")).alias("gen_code"),
        _pick(FUEL_CODES, F.col("l_partkey") % 9).alias("fuel_code"),
        F.lit("T").alias("tech_code"),
        F.date_add(F.to_date("l_shipdate"), DATE_SHIFT).alias("trading_date"),
        ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 48 + 1).cast("smallint").alias("trading_period"),
        F.when(pk50 == 0, F.lit(None).cast("decimal(18,6)"))
         .when(pk50 == 1, F.lit(Decimal("-1.0")).cast("decimal(18,6)"))
         .otherwise(_dec(F.col("l_extendedprice"))).alias("output_kw"),
        F.col("l_orderkey"), F.col("l_linenumber"),
    )


def raw_weather_orders(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Daily weather per lake (sparse on purpose: not every lake every day).

    `orders` may be a row-subset of the orders table (e.g. one fetch batch).
    """
    o = orders if orders is not None else table(spark, sf_dir, "orders")
    o = o.select(
        F.date_add(F.to_date("o_orderdate"), DATE_SHIFT).alias("time"),
        _pick(LAKES, F.col("o_custkey") % 7).alias("location"),
        _dec(F.col("o_totalprice"), 18, 2).alias("tp"),
        F.col("o_orderkey"),
    )
    hundredth = F.lit(Decimal("0.01"))
    temp = F.max(F.col("tp") % 2500) * hundredth
    return o.groupBy("location", "time").agg(
        _dec(F.greatest(F.max(F.col("tp") % 4000) * F.lit(Decimal("0.02")) - F.lit(36), F.lit(0)), 6, 2)
        .alias("precipitation_sum"),
        _dec(F.max(F.col("tp") % 3000) * hundredth, 6, 2).alias("rain_sum"),
        F.when(F.min("o_orderkey") % 11 == 0, F.lit(None).cast("decimal(6,2)"))
         .otherwise(_dec(F.max(F.col("tp") % 900) * hundredth, 6, 2)).alias("snowfall_sum"),
        _dec(temp, 5, 2).alias("temperature_2m_mean"),
        _dec(temp + F.lit(5), 5, 2).alias("temperature_2m_max"),
        _dec(temp - F.lit(5), 5, 2).alias("temperature_2m_min"),
    )
