import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from voltmart import constants as C
from voltmart.operators import (check_balanced, check_not_null, check_unique, completeness_pct, count_distinct_if,
                                days_since_last, first_wins, insert_ignore, lead_columns, percentiles,
                                pivot_periods, rolling_count_if, rolling_sum, share_of_total, table_after_insert,
                                unpivot_periods, upsert)

KEYS = ["d", "tp", "node"]
PRICE = "d date, tp smallint, node string, price decimal(18,6), ord bigint"


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_first_wins_keeps_earliest_and_null_keys(spark):
    d = dt.date(2024, 1, 1)
    df = spark.createDataFrame([
        (d, 1, "A", Decimal("10"), 2), (d, 1, "A", Decimal("11"), 1), (d, 2, "A", Decimal("12"), 3),
        (d, 1, None, Decimal("13"), 4), (d, 1, None, Decimal("14"), 5)], PRICE)
    out = first_wins(df, KEYS, ["ord"])
    assert "ord" not in out.columns
    assert rows(out, "tp", "node", "price") == sorted([
        (1, "A", Decimal("11.000000")), (2, "A", Decimal("12.000000")),
        (1, None, Decimal("13.000000")), (1, None, Decimal("14.000000"))], key=repr)


def test_insert_ignore_existing_wins_and_is_idempotent(spark):
    d = dt.date(2024, 1, 1)
    existing = spark.createDataFrame([(d, 1, "A", Decimal("1"), 0)], PRICE).drop("ord")
    incoming = spark.createDataFrame([(d, 1, "A", Decimal("9"), 1), (d, 2, "A", Decimal("2"), 2)], PRICE)
    once = table_after_insert(existing, incoming, KEYS, ["ord"])
    twice = table_after_insert(once, incoming, KEYS, ["ord"])
    assert rows(once, "tp", "price") == [(1, Decimal("1.000000")), (2, Decimal("2.000000"))]
    assert rows(twice, "tp", "price") == rows(once, "tp", "price")
    assert insert_ignore(incoming, KEYS, ["ord"], once).count() == 0


def test_insert_ignore_partition_independent(spark):
    df = spark.range(2000).select(
        F.lit(dt.date(2024, 1, 1)).alias("d"), (F.col("id") % 48 + 1).cast("smallint").alias("tp"),
        F.lit("N").alias("node"), F.col("id").cast("decimal(18,6)").alias("price"), F.col("id").alias("ord"))
    a = rows(first_wins(df.repartition(1), KEYS, ["ord"]), "tp", "price")
    b = rows(first_wins(df.repartition(17, "price"), KEYS, ["ord"]), "tp", "price")
    assert a == b and len(a) == 48 and all(p == tp - 1 for tp, p in a)


def test_upsert_last_wins_and_stamps(spark):
    W = "location string, time date, v decimal(6,2)"
    t0 = dt.datetime(2020, 1, 1)
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    first = spark.createDataFrame([("a", d1, Decimal("1")), ("a", d2, Decimal("2"))], W)
    table = upsert(None, first, ["location", "time"], stamp=F.lit(t0))
    second = spark.createDataFrame([("a", d2, Decimal("5")), ("b", d1, Decimal("7"))], W)
    out = upsert(table, second, ["location", "time"], stamp=F.lit(dt.datetime(2021, 1, 1)))
    got = rows(out, "location", "time", "v", "inserted_at")
    assert got == [("a", d1, Decimal("1.00"), t0), ("a", d2, Decimal("5.00"), dt.datetime(2021, 1, 1)),
                   ("b", d1, Decimal("7.00"), dt.datetime(2021, 1, 1))]
    again = upsert(out, second, ["location", "time"], stamp=F.lit(dt.datetime(2021, 1, 1)))
    assert rows(again, "location", "time", "v", "inserted_at") == got


def test_upsert_duplicate_in_batch_last_in_order(spark):
    W = "location string, time date, v decimal(6,2), ord bigint"
    d = dt.date(2024, 1, 1)
    inc = spark.createDataFrame([("a", d, Decimal("1"), 1), ("a", d, Decimal("3"), 3), ("a", d, Decimal("2"), 2)], W)
    out = upsert(None, inc, ["location", "time"], order=["ord"])
    assert rows(out, "v") == [(Decimal("3.00"),)]


def test_unpivot_counts_and_filters(spark):
    ids = list(C.GENERATION_ID_COLUMNS)
    schema = ", ".join(f"{c} string" for c in ids) + ", tp1 string, tp2 string, tp49 string, tp51 string"
    base = ["S", "P", "N", "G", "Hydro", "T"]
    df = spark.createDataFrame([
        (*base, "2024-04-07", "1.5", "", "7", "9"),
        (*base, "junk", "1", "2", "3", "4"),
        (*base, "2024-04-08", "NA", None, "-1", "0")], schema)
    out = unpivot_periods(df, ids)
    got = rows(out, "trading_date", "trading_period", "output_kw")
    assert got == [(dt.date(2024, 4, 7), 1, Decimal("1.500000")), (dt.date(2024, 4, 7), 49, Decimal("7.000000")),
                   (dt.date(2024, 4, 8), 49, Decimal("-1.000000"))]


def test_pivot_then_unpivot_roundtrip(spark):
    df = spark.createDataFrame([("A", 1, Decimal("5")), ("A", 3, Decimal("6")), ("B", 2, Decimal("7"))],
                               "k string, tp int, v decimal(18,6)")
    wide = pivot_periods(df, ["k"], "tp", "v")
    wide = wide.select("k", *[F.col(f"tp{i}").cast("string") for i in range(1, 51)])
    back = unpivot_periods(wide, ["k"], date_col=None)
    assert rows(back, "k", "trading_period", "output_kw") == rows(
        df.select("k", "tp", "v"), "k", "tp", "v")


@pytest.mark.parametrize("strategy", ["builtin", "distributed"])
def test_percentiles_exact(spark, strategy):
    df = spark.createDataFrame([("x", Decimal(v)) for v in ("1", "2", "10")] +
                               [("y", Decimal("-3.5")), ("y", Decimal("-3.5")), ("y", Decimal("8.25"))] +
                               [("z", None)], "g string, v decimal(18,6)")
    out = percentiles(df, ["g"], "v", [0.5, 0.95], ["p50", "p95"], strategy=strategy)
    got = {r["g"]: (r["p50"], r["p95"]) for r in out.collect()}
    assert set(got) == {"x", "y"}
    assert got["x"][0] == pytest.approx(2.0) and got["x"][1] == pytest.approx(9.2)
    assert got["y"][0] == pytest.approx(-3.5) and got["y"][1] == pytest.approx(-3.5 + 0.9 * 11.75)


def test_percentiles_distributed_matches_builtin_on_wide_group(spark):
    df = spark.range(20000).select(F.lit("hot").alias("g"),
                                   ((F.col("id") * 7919) % 10007 - 5000).cast("decimal(18,6)").alias("v"))
    probs = [0.0, 0.13, 0.5, 0.95, 1.0]
    names = [f"p{i}" for i in range(len(probs))]
    a = percentiles(df, ["g"], "v", probs, names, strategy="builtin").collect()[0]
    b = percentiles(df, ["g"], "v", probs, names, strategy="distributed").collect()[0]
    assert [a[n] for n in names] == pytest.approx([b[n] for n in names])


def test_count_distinct_bitmask(spark):
    df = spark.createDataFrame([(1, True), (1, True), (2, False), (50, True), (None, True)], "tp int, s boolean")
    r = df.agg(count_distinct_if(F.col("s"), "tp").alias("n")).collect()[0]
    assert r["n"] == 2
    empty = df.where("false").agg(count_distinct_if(F.col("s"), "tp").alias("n")).collect()[0]
    assert empty["n"] == 0


def test_completeness(spark):
    days = [("a", 48), ("b", 50), ("c", 24)]
    df = spark.createDataFrame([(k,) for k, n in days for _ in range(n)], "k string")
    out = {r["k"]: r["p"] for r in df.groupBy("k").agg(completeness_pct(48).alias("p")).collect()}
    assert out == {"a": Decimal("100.0"), "b": Decimal("104.2"), "c": Decimal("50.0")}


def test_share_of_total_forms_agree_and_zero_total(spark):
    df = spark.createDataFrame([(1, "x", Decimal("1")), (1, "y", Decimal("3")), (2, "x", Decimal("0"))],
                               "d int, c string, v decimal(18,6)")
    a = share_of_total(df, ["d"], "v", "tot", "pct", form="window")
    b = share_of_total(df, ["d"], "v", "tot", "pct", form="join")
    ra, rb = rows(a, "d", "c", "tot", "pct"), rows(b, "d", "c", "tot", "pct")
    assert ra == rb
    assert ra == [(1, "x", Decimal("4.000000"), Decimal("25.00")), (1, "y", Decimal("4.000000"), Decimal("75.00")),
                  (2, "x", Decimal("0.000000"), None)]


def test_windows_rows_leads_days_since(spark):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3, 5, 6)]
    spike = [False, True, False, False, True]
    df = spark.createDataFrame(list(zip(days, spike, [1, 2, 3, 4, 5])), "d date, s boolean, v int")
    out = df.withColumns({
        "r3": rolling_sum("v", None, ["d"], 3, day_grain=True),
        "c7": rolling_count_if(F.col("s"), None, ["d"], 7, day_grain=True),
        "since": days_since_last("d", F.col("s"), None, day_grain=True),
        **lead_columns("v", ["s"], ["d"], [1], "lead{k}"),
    }).orderBy("d").collect()
    assert [r["r3"] for r in out] == [1, 3, 6, 9, 12]
    assert [r["c7"] for r in out] == [0, 1, 1, 1, 2]
    assert [r["since"] for r in out] == [None, 0, 1, 3, 0]


def test_unpartitioned_window_requires_day_grain(spark):
    with pytest.raises(ValueError):
        rolling_sum("v", None, ["d"], 7)


def test_calendar_frame_does_not_stretch(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 10)]
    df = spark.createDataFrame([("c", d, 1) for d in days], "k string, d date, v int")
    out = df.withColumn("s", rolling_sum("v", ["k"], ["d"], 7, calendar=True)).orderBy("d").collect()
    assert [r["s"] for r in out] == [1, 2, 1]


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "k string, v int")
    nn = {r["column_name"]: (r["null_count"], r["passed"]) for r in check_not_null(df, ["k", "v"]).collect()}
    assert nn == {"k": (0, True), "v": (1, False)}
    u = check_unique(df, ["k", "v"]).collect()[0]
    assert (u["duplicate_keys"], u["duplicate_rows"], u["passed"]) == (1, 2, False)
    bal = check_balanced(df, "k").collect()[0]
    assert (bal["min_rows"], bal["max_rows"], bal["passed"]) == (1, 2, False)


def test_hot_key_first_wins_is_combined_map_side(spark):
    # one key holds a third of all rows
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 997) + 2).cast("smallint").alias("tp"),
        F.lit(dt.date(2024, 1, 1)).alias("d"), F.lit("HOT").alias("node"),
        F.col("id").cast("decimal(18,6)").alias("price"), (n - F.col("id")).alias("ord")).repartition(8)
    out = first_wins(df, KEYS, ["ord"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    # a partial aggregate runs before the exchange, so the hot key leaves each task as one row
    assert plan.index("partial_min_by") > plan.index("Exchange hashpartitioning")
    hot = out.where(F.col("tp") == 1).collect()
    assert len(hot) == 1 and hot[0]["price"] == Decimal(n - 3)   # largest id with id % 3 == 0 has the smallest ord


def test_decimal_bounds_check(spark):
    from voltmart import schemas as S
    from voltmart.operators import out_of_range
    df = spark.createDataFrame([(Decimal("12.34"), Decimal("999.99")), (Decimal("10000.5"), Decimal("1000.00")),
                                (None, Decimal("-5"))], "precipitation_sum decimal(18,2), temperature_2m_mean decimal(18,2)")
    got = {r["column_name"]: (r["overflow_count"], r["passed"]) for r in out_of_range(df, S.RAW_WEATHER).collect()}
    assert got == {"precipitation_sum": (1, False), "temperature_2m_mean": (1, False)}


def test_percentiles_distributed_all_radix_levels(spark):
    # unscaled keys up to ~1e17 (> 2**42) and negative: every 21-bit level and the arithmetic shift are used
    df = spark.range(5000).select(
        (F.col("id") % 3).cast("string").alias("g"),
        (((F.col("id") * 104729) % 200003 - 100001) * F.lit(Decimal("999983.123457"))).cast("decimal(18,6)").alias("v"))
    probs = [0.0, 0.01, 0.5, 0.95, 0.999, 1.0]
    names = [f"p{i}" for i in range(len(probs))]
    a = {r["g"]: [r[n] for n in names] for r in percentiles(df, ["g"], "v", probs, names, strategy="builtin").collect()}
    b = {r["g"]: [r[n] for n in names] for r in percentiles(df, ["g"], "v", probs, names, strategy="distributed").collect()}
    assert set(a) == set(b) == {"0", "1", "2"}
    for g in a:
        assert b[g] == pytest.approx(a[g], rel=1e-12)


def test_wide_generation_is_compiled(spark):
    """The JVM compiles no method of more than 8000 bytes of code; a wide table must not make one."""
    rows = [("s", "p1", "n", "g", "Wind", "T", "2024-03-01", 1, Decimal("1.5")), ("s", "p1", "n", "g", "Wind", "T", "2024-03-01", 1, Decimal("2.5")),
            ("s", "p1", "n", "g", "Wind", "T", "2024-03-01", 50, None), ("s", None, "n", "g", None, "T", None, None, Decimal("7")),
            ("s", "p2", "n", "g", "Wind", "T", "2024-03-01", 48, Decimal("-3"))]
    long = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in C.GENERATION_ID_COLUMNS) + ", trading_period smallint, output_kw decimal(18,6)")
    ids = list(C.GENERATION_ID_COLUMNS)
    wide = pivot_periods(long, ids, "trading_period", "output_kw")
    assert wide.columns == ids + [f"tp{i}" for i in range(1, 51)] and wide.schema["tp7"].dataType == long.schema["output_kw"].dataType
    assert sorted((r["poc_code"] or "", r["tp1"], r["tp48"], r["tp50"]) for r in wide.collect()) == [
        ("", None, None, None), ("p1", Decimal("2.500000"), None, None), ("p2", None, Decimal("-3.000000"), None)]
    back = unpivot_periods(wide.select(*ids, *[F.col(f"tp{i}").cast("string") for i in range(1, 51)]), ids)
    assert sorted((r["poc_code"], r["trading_period"], r["output_kw"]) for r in back.collect()) == [
        ("p1", 1, Decimal("2.500000")), ("p2", 48, Decimal("-3.000000"))]
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = spark._jvm.PythonSQLUtils.explainString(back.select("*")._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) <= 8000
