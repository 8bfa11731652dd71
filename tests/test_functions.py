import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from voltmart import constants as C
from voltmart.functions import (calendar_columns, flag_above, flag_at_least, is_in_flag, kw_to_mwh,
                                label_periods, map_codes, period_start, ratio, season, to_date_lenient,
                                to_integral, to_number, volatility_class)


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_period_start_dst(spark):
    d = dt.date(2024, 4, 7)
    out = one(spark, [(d, 1), (d, 48), (d, 49), (d, 50)], "d date, tp smallint", period_start("d", "tp"))
    assert out == [dt.datetime(2024, 4, 7, 0, 0), dt.datetime(2024, 4, 7, 23, 30),
                   dt.datetime(2024, 4, 8, 0, 0), dt.datetime(2024, 4, 8, 0, 30)]


def test_kw_to_mwh(spark):
    out = one(spark, [(Decimal("1000"),), (Decimal("1.001"),), (None,)], "kw decimal(18,6)", kw_to_mwh("kw"))
    assert out == [Decimal("0.500000"), Decimal("0.000501"), None]


def test_spike_flag_strict(spark):
    out = one(spark, [(Decimal("500"),), (Decimal("500.01"),), (None,)], "p decimal(18,6)",
              flag_above("p", C.SPIKE_LIMIT))
    assert out == [False, True, False]


def test_wet_flags_inclusive(spark):
    rows = [(Decimal("1.0"),), (Decimal("25.0"),), (None,), (Decimal("0.99"),)]
    wet = one(spark, rows, "a decimal(10,6)", flag_at_least("a", C.WET_DAY_MM))
    heavy = one(spark, rows, "a decimal(10,6)", flag_at_least("a", C.HEAVY_RAIN_MM))
    assert wet == [True, True, False, False]
    assert heavy == [False, True, False, False]


def test_fuel_category_and_renewable(spark):
    rows = [("Hydro",), ("Geo",), ("Gas&Oil",), ("Gas",), ("Wood",), ("Solar",), (None,)]
    cat = one(spark, rows, "f string", map_codes("f", C.FUEL_CATEGORY_RULES, C.FUEL_CATEGORY_DEFAULT))
    ren = one(spark, rows, "f string", is_in_flag("f", C.RENEWABLE_FUEL_CODES))
    assert cat == ["Hydro", "Geothermal", "Gas", "Gas", "Wood / Biomass", "Other", "Other"]
    assert ren == [True, True, False, False, True, False, False]


def test_label_limits(spark):
    days = [dt.date(2020, 3, 25), dt.date(2020, 3, 26), dt.date(2020, 4, 27), dt.date(2020, 4, 28),
            dt.date(2020, 5, 14)]
    out = one(spark, [(d,) for d in days], "d date", label_periods("d"))
    assert out == [None, "Level 4 Lockdown", "Level 4 Lockdown", "Level 3", None]


def test_volatility_limits(spark):
    rows = [(Decimal("300"), 0), (Decimal("300.01"), 0), (Decimal("1000.01"), 0),
            (None, 1), (None, 6), (None, 24), (None, 0)]
    out = one(spark, rows, "p decimal(10,2), n bigint", volatility_class("p", "n"))
    assert out == ["Calm", "Stressed", "Extreme", "Elevated", "Stressed", "Extreme", "Calm"]


def test_calendar_iso_week_and_dow(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1),), (dt.date(2024, 1, 7),)], "d date")
    cols = calendar_columns("d")
    r = df.select(*[c.alias(k) for k, c in cols.items()]).collect()
    assert r[0]["week_number"] == 53 and r[0]["day_of_week"] == 5 and r[0]["is_weekend"] is False
    assert r[0]["month_name"] == "January" and r[0]["month_year_label"] == "Jan 2021"
    assert r[0]["day_name_short"] == "Fri" and r[0]["season"] == "Summer" and r[0]["month_year_sort"] == 202101
    assert r[1]["day_of_week"] == 0 and r[1]["is_weekend"] is True


def test_season_lower(spark):
    out = one(spark, [(dt.date(2024, m, 1),) for m in (1, 4, 7, 10)], "d date", season("d", "lower"))
    assert out == ["summer", "autumn", "winter", "spring"]


def test_ratio_zero_is_null(spark):
    out = one(spark, [(Decimal("1"), Decimal("0")), (Decimal("1"), Decimal("3"))], "a decimal(10,2), b decimal(10,2)",
              ratio("a", "b", 2, 100))
    assert out == [None, Decimal("33.33")]


def test_lenient_numbers_and_dates(spark):
    cells = [("",), ("NA",), ("abc",), ("-1",), ("0",), ("12.5",), ("nan",), ("inf",), (" 7 ",)]
    out = one(spark, cells, "c string", to_number("c"))
    assert out == [None, None, None, Decimal("-1"), Decimal("0"), Decimal("12.5"), None, None, Decimal("7")]
    tp = one(spark, [("3",), ("3.0",), ("3.5",), ("x",)], "c string", to_integral("c"))
    assert tp == [3, 3, None, None]
    dates = one(spark, [("2024-01-15",), ("15/01/2024",), ("2024-01-15 13:45:00",), ("2024/1/15",),
                        ("20240115",), ("2024-01-15T00:30:00",), ("junk",), (None,), ("2024-02-31",), ("",)],
                "c string", to_date_lenient("c"))
    assert dates == [dt.date(2024, 1, 15)] * 6 + [None, None, None, None]


def test_period_start_dst_aware(spark):
    # NZ daylight saving ended 2024-04-07 03:00 local: that day has 50 periods.
    d = dt.date(2024, 4, 7)
    out = one(spark, [(d, 1), (d, 6), (d, 7), (d, 50)], "d date, tp smallint",
              period_start("d", "tp", zone="Pacific/Auckland"))
    # local midnight = 11:00 UTC the day before (NZDT, +13)
    assert out == [dt.datetime(2024, 4, 6, 11, 0), dt.datetime(2024, 4, 6, 13, 30),
                   dt.datetime(2024, 4, 6, 14, 0), dt.datetime(2024, 4, 7, 11, 30)]
