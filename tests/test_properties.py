"""Property checks (random small inputs, and invariants on the test tables)."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from voltmart import constants as C
from voltmart.operators import first_wins, unpivot_periods
from voltmart.plans import queries as Q

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

cell = st.one_of(st.none(), st.just(""), st.just("NA"), st.integers(-5, 500).map(str))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["2024-01-01", "2024-01-02", "bad"]), cell, cell, cell),
                min_size=1, max_size=12))
def test_unpivot_keeps_exactly_the_numeric_cells(spark, rows):
    df = spark.createDataFrame(rows, "trading_date string, tp1 string, tp2 string, tp50 string")
    out = unpivot_periods(df.withColumn("k", F.lit("x")), ["k", "trading_date"])
    expected = sum(1 for d, *cells in rows if d != "bad" for c in cells if c not in (None, "", "NA"))
    assert out.count() == expected


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 3), st.sampled_from(["A", "B", None]), st.integers(0, 99)),
                min_size=1, max_size=20, unique_by=lambda r: r[2]))
def test_first_wins_matches_brute_force(spark, rows):
    df = spark.createDataFrame([(tp, node, Decimal(o), o) for tp, node, o in rows],
                               "tp int, node string, price decimal(18,6), ord int")
    got = sorted((r["tp"], r["node"], r["price"]) for r in first_wins(df.repartition(3), ["tp", "node"], ["ord"])
                 .collect() if r["node"] is not None)
    best = {}
    for tp, node, o in rows:
        if node is not None and ((tp, node) not in best or o < best[(tp, node)]):
            best[(tp, node)] = o
    assert got == sorted((tp, node, Decimal(o)) for (tp, node), o in best.items())
    nulls = first_wins(df, ["tp", "node"], ["ord"]).where(F.col("node").isNull()).count()
    assert nulls == sum(1 for r in rows if r[1] is None)


def test_mix_invariants(spark):
    mix = Q.pipeline(spark, SF_SMALL).ref("int_generation_mix_daily")
    # D14: the fuel category decides is_renewable, so (date, category) is already unique
    assert mix.groupBy("trading_date", "fuel_category").count().where("count > 1").count() == 0
    sums = mix.groupBy("trading_date").agg(F.sum("pct_of_national").alias("s")).where(F.col("s").isNotNull())
    worst = sums.agg(F.max(F.abs(F.col("s") - F.lit(100)))).first()[0]
    assert worst <= Decimal("0.05")


def test_days_since_zero_iff_spike_and_rolling_bounds(spark):
    risk = Q.pipeline(spark, SF_SMALL).ref("mart_price_risk_daily")
    bad = risk.where((F.col("days_since_last_spike") == 0) != F.col("is_spike_day"))
    assert bad.count() == 0
    assert risk.where(F.col("spike_periods_distinct_last_7") < F.col("spike_periods_distinct")).count() == 0
    assert risk.where(F.col("spike_periods_distinct_last_30") < F.col("spike_periods_distinct_last_7")).count() == 0
    first_spike = risk.where("is_spike_day").agg(F.min("trading_date")).first()[0]
    assert risk.where(F.col("trading_date") < F.lit(first_spike)).where(
        F.col("days_since_last_spike").isNotNull()).count() == 0
