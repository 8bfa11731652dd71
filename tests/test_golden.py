"""Golden mart runs on tiny hand-made raw tables, expected values computed by hand."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from voltmart import schemas as S
from voltmart.plans import Pipeline

D1, D2, D4 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 4)


def prices(spark):
    rows = [(D1, 1, "A", "100"), (D1, 2, "A", "200"), (D1, 3, "A", "600"), (D1, 4, "A", "700"),
            (D2, 1, "A", "10"), (D2, 2, "A", "20"), (D2, 3, "A", "500"),          # 500 is not a spike
            (D4, 1, "A", "1500"), (D4, 2, "A", "1500"), (D4, 1, "B", "1500"), (D4, 2, "B", "1500")]
    return spark.createDataFrame([(d, tp, n, Decimal(p), Decimal("2"), None) for d, tp, n, p in rows], S.RAW_PRICES)


def generation(spark):
    rows = [("S1", "P1", "N1", "G1", "Hydro", "T", D1, 1, Decimal("1000")),
            ("S2", "P2", "N1", "G2", "Coal", "T", D1, 1, Decimal("1000")),
            ("S3", "P3", "N1", "G3", "Coal", "T", D1, 2, Decimal("-5"))]       # negative: filtered in staging
    return spark.createDataFrame(rows, S.RAW_GENERATION)


@pytest.mark.parametrize("strategy", ["builtin", "distributed"])
def test_price_risk_mart_golden(spark, strategy):
    p = Pipeline(spark, {"wholesale_prices": prices(spark), "generation_output": generation(spark)},
                 percentile_strategy=strategy)
    got = {r["trading_date"]: r for r in p.ref("mart_price_risk_daily").collect()}
    d1, d2, d4 = got[D1], got[D2], got[D4]
    assert set(got) == {D1, D2, D4}
    # day 1: 100 200 600 700
    assert (d1["avg_price_nzd_per_mwh"], d1["min_price_nzd_per_mwh"], d1["max_price_nzd_per_mwh"]) == (
        Decimal("400.00"), Decimal("100.00"), Decimal("700.00"))
    assert d1["median_price_nzd_per_mwh"] == Decimal("400.00")
    assert d1["p95_price_nzd_per_mwh"] == Decimal("685.00")      # 600 + 0.85 * 100
    assert (d1["spike_records_count"], d1["spike_periods_distinct"], d1["is_spike_day"]) == (2, 2, True)
    assert d1["volatility_class"] == "Stressed" and d1["price_range_nzd_per_mwh"] == Decimal("600.00")
    assert d1["renewable_pct"] == Decimal("50.00") and d1["national_total_mwh"] == Decimal("1.000000")
    assert d1["carbon_intensity_kg_co2_per_mwh"] == Decimal("450")
    assert d1["nz_covid_period"] is None
    # day 2: 10 20 500 (500 is not above the limit)
    assert d2["p95_price_nzd_per_mwh"] == Decimal("452.00")      # 20 + 0.9 * 480
    assert (d2["spike_records_count"], d2["spike_periods_distinct"], d2["volatility_class"]) == (0, 0, "Stressed")
    assert d2["renewable_pct"] is None
    # day 4: four records at 1500 over two periods
    assert (d4["spike_records_count"], d4["spike_periods_distinct"], d4["volatility_class"]) == (4, 2, "Extreme")
    # windows count rows; days-since counts calendar days across the gap
    assert [got[d]["spike_days_last_7"] for d in (D1, D2, D4)] == [1, 1, 2]
    assert [got[d]["spike_periods_distinct_last_7"] for d in (D1, D2, D4)] == [2, 2, 4]
    assert [got[d]["days_since_last_spike"] for d in (D1, D2, D4)] == [0, 1, 0]


def test_generation_mix_golden(spark):
    p = Pipeline(spark, {"generation_output": generation(spark)})
    mix = {r["fuel_category"]: r for r in p.ref("mart_generation_mix").collect()}
    assert set(mix) == {"Hydro", "Coal"}
    assert mix["Hydro"]["total_mwh"] == Decimal("0.500000")
    assert mix["Hydro"]["pct_of_national"] == Decimal("50.00") and mix["Coal"]["renewable_pct"] == Decimal("50.00")
    assert mix["Coal"]["is_renewable"] is False and mix["Hydro"]["dim_season"] == "Summer"
    daily = p.ref("int_generation_daily").where(F.col("station_name") == "G1").first()
    assert daily["trading_periods_with_data"] == 1 and daily["data_completeness_pct"] == Decimal("2.1")


def weather(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0)
    rows = [  # waitaki has three lakes, waikato one; day 3 missing for waitaki (rows, not days)
        ("lake_pukaki", D1, "3.00", "1.00"), ("lake_tekapo", D1, "0.00", "2.00"), ("lake_ohau", D1, "0.00", "3.00"),
        ("lake_pukaki", D2, "30.00", "4.00"), ("lake_tekapo", D2, "30.00", "5.00"), ("lake_ohau", D2, "15.00", None),
        ("lake_pukaki", D4, "0.99", "6.00"),
        ("lake_taupo", D1, "1.00", "7.00"),
        ("nowhere", D1, "99.00", "0.00"),                                       # unknown lake: dropped by the join
    ]
    return spark.createDataFrame(
        [(loc, d, Decimal(p), Decimal("0"), None if s is None else Decimal(s), Decimal(s or "0"), Decimal("1"),
          Decimal("-1"), t0) for loc, d, p, s in rows], S.RAW_WEATHER)


def test_catchment_mart_golden(spark):
    p = Pipeline(spark, {"weather_daily": weather(spark), "wholesale_prices": prices(spark)})
    got = {(r["catchment"], r["observation_date"]): r for r in p.ref("mart_catchment_weather_pricing_daily").collect()}
    assert set(got) == {("waitaki", D1), ("waitaki", D2), ("waitaki", D4), ("waikato", D1)}
    w1, w2, w4, k1 = got[("waitaki", D1)], got[("waitaki", D2)], got[("waitaki", D4)], got[("waikato", D1)]
    assert (w1["total_precip_mm"], w1["lake_count"], w1["pricing_node"]) == (Decimal("3.00"), 3, "BEN2202")
    assert w1["avg_precip_mm"] == Decimal("1.000000") and w1["is_wet_day"] is True and w1["is_heavy_rain_day"] is False
    assert w2["avg_precip_mm"] == Decimal("25.000000") and w2["is_heavy_rain_day"] is True
    assert w2["total_snowfall_cm"] == Decimal("9.00")                       # null snowfall skipped
    assert w4["is_wet_day"] is False and w4["season"] == "summer"
    # rolling sums count rows: day 4 follows day 2 directly in the waitaki series
    assert [got[("waitaki", d)]["precip_7d_rolling_sum"] for d in (D1, D2, D4)] == [
        Decimal("3.00"), Decimal("78.00"), Decimal("78.99")]
    # node prices: none of the fixture prices are at BEN2202 / ARA2201, so prices and leads are null
    assert w1["avg_price_nzd_per_mwh"] is None and w1["price_lead_1d"] is None
    assert k1["island"] == "North" and k1["precip_30d_rolling_sum"] == Decimal("1.00")
    assert (k1["year"], k1["month_name"], k1["day_of_week"], k1["is_weekend"]) == (2024, "January", 1, False)


def test_catchment_leads_follow_rows(spark):
    node_prices = spark.createDataFrame(
        [(d, 1, "BEN2202", Decimal(v), None, None) for d, v in ((D1, "10"), (D2, "20"), (D4, "40"))], S.RAW_PRICES)
    p = Pipeline(spark, {"weather_daily": weather(spark), "wholesale_prices": node_prices})
    got = {r["observation_date"]: r for r in p.ref("mart_catchment_weather_pricing_daily")
           .where(F.col("catchment") == "waitaki").collect()}
    assert [got[d]["avg_price_nzd_per_mwh"] for d in (D1, D2, D4)] == [Decimal("10.00"), Decimal("20.00"), Decimal("40.00")]
    assert [got[d]["price_lead_1d"] for d in (D1, D2, D4)] == [Decimal("20.00"), Decimal("40.00"), None]
    assert got[D1]["price_lead_3d"] is None


def test_daily_average_is_rounded_once(spark):
    # mean 123.4449995: rounding at 6 places first would give 123.45; the true value rounds to 123.44
    rows = [(D1, 1, "A", Decimal("123.444999"), None, None), (D1, 2, "A", Decimal("123.445000"), None, None)]
    p = Pipeline(spark, {"wholesale_prices": spark.createDataFrame(rows, S.RAW_PRICES)})
    assert p.ref("price_daily_risk").first()["avg_price_nzd_per_mwh"] == Decimal("123.44")
