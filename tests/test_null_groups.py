"""Groups of the null key, periods outside the mask, double values, and sinks after a crash."""

import os

import pytest
from pyspark.sql import functions as F

from voltmart.operators import count_distinct_if, percentiles, pivot_periods
from voltmart.sinks import tables


@pytest.mark.parametrize("strategy", ["builtin", "distributed"])
def test_percentiles_keep_the_null_group(spark, strategy):
    rows = [(None, 1), (None, 2), (None, 3), ("a", 6), ("a", 7), ("a", 8), ("a", None)]
    df = spark.createDataFrame(rows, "k string, v long")
    out = percentiles(df, ["k"], "v", [0.5], ["m"], strategy=strategy)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(None, 2.0), ("a", 7.0)], key=str)


def test_percentiles_of_doubles_take_the_same_path(spark):
    """Every kind of double: signed zeros, subnormals, powers of two and their neighbours, huge, infinite, NaN."""
    special = [0.0, -0.0, 5e-324, 2.2250738585072014e-308, 1e-310, 1.0, 2.0, 0.9999999999999999, 1.0000000000000002,
               8.0, 7.999999999999999, 1e300, -1e300, -3.5, 1.7976931348623157e308, float("inf"), float("-inf")]
    rows = [("s", v) for v in special] + [("n", float("nan")), ("n", 1.0), ("n", None), (None, 0.1), (None, 0.30000000000000004)]
    rows += [("w", ((i * 7919) % 1009 - 500) / 7.0) for i in range(1009)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = [i / 16 for i in range(17)]
    names = [f"p{i}" for i in range(17)]
    a, b = ({r["k"]: [str(r[n] + 0.0) for n in names] for r in percentiles(df, ["k"], "v", probs, names, strategy=s).collect()}
            for s in ("builtin", "distributed"))
    assert a == b and set(a) == {"s", "n", "w", None}


def test_percentile_plans_run_no_job_while_built(spark):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    percentiles(spark.range(9).withColumn("k", F.lit(1)), ["k"], "id", [0.5], ["m"])
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == len(before)


def test_periods_outside_the_mask_are_counted(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (1, 99), (1, -3), (1, None), (2, None)], "k int, p int")
    out = df.groupBy("k").agg(count_distinct_if(F.lit(True), "p").alias("n")).orderBy("k").collect()
    assert [tuple(r) for r in out] == [(1, 3), (2, 0)]


def test_pivot_refuses_unknown_periods(spark):
    df = spark.createDataFrame([(1, 99, 2.0)], "k int, p int, v double")
    with pytest.raises(Exception, match="period outside"):
        pivot_periods(df, ["k"], "p", "v").collect()


def test_a_crashed_batch_does_not_block_the_next(spark, tmp):
    base = f"{tmp}/t"
    df = spark.createDataFrame([(1,)], "a int")
    tables.append_batch(df, base)
    os.makedirs(f"{base}/batch=2/_temporary")  # what a lost job leaves
    tables.append_batch(df, base)
    assert tables.read_table(spark, base).count() == 2


def test_a_batch_without_its_success_marker_is_not_read(spark, tmp):
    base = f"{tmp}/t"
    df = spark.createDataFrame([(1,)], "a int")
    tables.append_batch(df, base)
    os.remove(f"{tables.append_batch(df, base)}/_SUCCESS")
    assert tables.read_table(spark, base).count() == 1
    tables.append_batch(df, base)
    assert tables.read_table(spark, base).count() == 2


def test_month_load_reads_only_the_months_it_touches(spark, tmp):
    import datetime as dt
    from voltmart import schemas as S
    from voltmart.plans import Pipeline
    base, keys = f"{tmp}/t", ["trading_date", "trading_period", "node"]
    rows = [(dt.date(2024, m, 1), 1, "BEN2202", None, None, None) for m in (1, 2, 3)]
    feed = spark.createDataFrame(rows, S.RAW_PRICES).withColumn("seq", F.lit(1))
    tables.load_insert_ignore(spark, base, feed, keys, ["seq"], S.RAW_PRICES, month_of="trading_date")
    tables.load_insert_ignore(spark, base, feed, keys, ["seq"], S.RAW_PRICES, month_of="trading_date")
    assert tables.read_table(spark, base).count() == 3
    one = tables.read_table(spark, base, months=[202402])
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "202402" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    staged = Pipeline(spark, {"wholesale_prices": tables.read_table(spark, base)}).ref("stg_wholesale_prices")
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(price)" in plan.split("PushedFilters: [", 1)[1].split("]", 1)[0]


def test_only_a_missing_path_is_an_empty_table(spark, tmp):
    assert tables.read_table(spark, f"{tmp}/none") is None
    with pytest.raises(Exception):
        tables.read_table(spark, "nosuchscheme://x/y")


def test_percentiles_of_large_groups_by_ranges(spark):
    """Groups of far more distinct values than one range holds, beside small ones; a hot value; negative and huge keys."""
    from voltmart.operators import aggregates
    big = aggregates.WHOLE_GROUP * 3
    df = spark.range(big * 2).select(
        F.when(F.col("id") < big, F.lit("hot")).when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(17)).otherwise(F.pmod(F.xxhash64("id"), F.lit(1 << 60)) - F.lit(1 << 59)).alias("v"))
    probs = [0.0, 0.01, 0.25, 0.5, 0.6, 0.95, 1.0]
    names = [f"p{i}" for i in range(len(probs))]
    rows = {}
    for r in df.collect():
        rows.setdefault(r.k, []).append(r.v)
    got = {r["k"]: [r[n] for n in names] for r in percentiles(df, ["k"], "v", probs, names).collect()}
    assert set(got) == set(rows)
    for k, values in rows.items():
        values.sort()
        for p, value in zip(probs, got[k], strict=True):
            x = (len(values) - 1) * p
            lo, hi = int(x), min(int(x) + (x > int(x)), len(values) - 1)
            plain = float(values[lo]) if lo == hi else (hi - x) * float(values[lo]) + (x - lo) * float(values[hi])
            assert value == plain, (k, p)


def test_percentile_plan_stays_small(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    plan = percentiles(df, ["k"], "v", [0.5, 0.95], ["m", "p"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") + plan.count("BroadcastExchange") <= 16 and plan.count("Range (") == 3


def test_presence_bitmaps_stand_for_the_stored_rows(spark, tmp):
    """Loads with bitmaps equal loads without, over null keys, odd periods, a crash before the bitmaps, mixed loads."""
    import datetime as dt
    import random
    import shutil
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("d", T.DateType()), T.StructField("p", T.IntegerType()), T.StructField("node", T.StringType()),
                           T.StructField("v", T.LongType())])
    rng, keys = random.Random(3), ["d", "p", "node"]
    batches = []
    for b in range(4):
        rows = [(dt.date(2024, rng.randint(1, 3), rng.randint(1, 28)) if rng.random() < 0.95 else None,
                 rng.choice([None, -70, -1, 0, 1, 47, 50, 63, 64, 99, 1 << 30]), rng.choice(["a", "b", None]), 1000 * b + i) for i in range(300)]
        batches.append(spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], f"d date, p int, node string, v long, seq int"))
    for month in (None, "d"):
        empty = f"{tmp}/empty-{month}"
        for df in (batches[0].limit(0), batches[0], batches[0].dropna(subset=keys)):  # loads that add no row
            tables.load_insert_ignore(spark, empty, df, keys, ["seq"], schema, month_of=month, presence="p")
        assert len(tables._committed(spark, empty, "batch")) == 3 and tables.read_table(spark, empty).where("p IS NOT NULL").count() > 0
        plain, kept = f"{tmp}/plain-{month}", f"{tmp}/kept-{month}"
        for i, df in enumerate(batches):
            if i == 2:  # as a crash after the batch leaves it
                shutil.move(f"{kept}/presence/batch=2", f"{tmp}/lost-{month}")
            tables.load_insert_ignore(spark, plain, df, keys, ["seq"], schema, month_of=month, conflicts=i == 3)
            tables.load_insert_ignore(spark, kept, df, keys, ["seq"], schema, month_of=month, conflicts=i == 3, presence="p" if i != 1 else None)
            if i == 1:
                tables.read_presence(spark, kept, keys, "p", schema, month)
        a, b = (sorted(map(str, tables.read_table(spark, x).collect())) for x in (plain, kept))
        assert a == b
        a, b = (sorted(map(str, tables.read_conflicts(spark, x, 4).collect())) for x in (plain, kept))
        assert a == b
    words = tables.read_presence(spark, kept, keys, "p", schema, "d", [202401])
    plan = words._jdf.queryExecution().executedPlan().toString()
    assert "/presence/" in str(words.inputFiles()) and not [f for f in words.inputFiles() if "/presence/" not in f]
    assert "202401" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]


def test_presence_column_must_be_a_key(spark, tmp):
    with pytest.raises(ValueError, match="part of the key"):
        tables.load_insert_ignore(spark, tmp, spark.range(1), ["id"], [], spark.range(1).schema, presence="x")


def test_distinct_counts_merge_over_days(spark):
    from voltmart.operators import bitmap_words, count_words, merge_words
    df = spark.range(5000).select((F.col("id") % 30).alias("day"), (F.pmod(F.xxhash64("id"), F.lit(900)) - 400).alias("v"), (F.col("id") % 7 > 1).alias("ok"))
    days = bitmap_words(df.unionByName(df.limit(40).withColumn("v", F.lit(None))), ["day"], "v", F.col("ok"))
    weeks = count_words(merge_words(days, [F.floor(F.col("day") / 7).alias("week")]), ["week"], "n")
    plain = df.where("ok").groupBy(F.floor(F.col("day") / 7).alias("week")).agg(F.count_distinct("v").alias("n"))
    assert sorted(map(tuple, weeks.collect())) == sorted(map(tuple, plain.collect()))


@pytest.mark.parametrize("rows, blocks", [(0, 4), (1, 4), (9, 4), (500, 7), (700, 64)])
def test_windows_in_blocks_equal_those_in_one_task(spark, tmp, rows, blocks):
    import datetime as dt
    import random
    from voltmart.operators import blocked_windows, days_since_last, rolling_sum
    rng = random.Random(rows)
    data = [(dt.date(2020, 1, 1) + dt.timedelta(days=rng.choice([0, i // 3, i * 2])), i, rng.choice([None, *range(9)]), rng.random() < 0.03) for i in range(rows)]
    df = spark.createDataFrame(data, "d date, i int, v int, flag boolean")
    order = ["d", "i"]
    out = blocked_windows(df, order, f"{tmp}/w", sums={"s1": ("v", 1), "s7": ("v", 7), "s30": (F.when(F.col("flag"), 1).otherwise(0), 30)},
                          days_since={"since": ("d", F.col("flag"))}, blocks=blocks)
    plain = df.withColumns({"s1": rolling_sum("v", None, order, 1, day_grain=True), "s7": rolling_sum("v", None, order, 7, day_grain=True),
                            "s30": rolling_sum(F.when(F.col("flag"), 1).otherwise(0), None, order, 30, day_grain=True)})
    from pyspark.sql import Window
    last = F.max(F.when(F.col("flag"), F.col("d"))).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    plain = plain.withColumn("since", F.datediff("d", last))
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.select(*out.columns).collect()))
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()


def test_labels_from_overlapping_ranges(spark):
    import datetime as dt
    import random
    from voltmart.operators import label_by_ranges
    rng = random.Random(8)
    day = lambda n: dt.date(2020, 12, 1) + dt.timedelta(days=n)
    ranges = [(day(a), day(a + rng.choice([-1, 0, 0, 1, 40, 400])), f"r{i}") for i, a in enumerate(rng.randrange(900) for _ in range(300))]
    dates = [None, *[day(n) for n in range(-3, 1400)]]
    out = label_by_ranges(spark.createDataFrame([(d, i) for i, d in enumerate(dates)], "d date, i int"), "d", ranges, "label")
    plain = {i: next((x for a, b, x in ranges if d is not None and a <= d <= b), None) for i, d in enumerate(dates)}
    got = out.collect()
    assert len(got) == len(dates) and {r.i: r.label for r in got} == plain
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
    assert label_by_ranges(out.drop("label"), "d", [], "label").where("label IS NULL").count() == len(dates)


def test_date_layout_is_told_by_each_file(spark, tmp):
    import datetime as dt
    import os as _os
    from voltmart.sources import files as FS
    head = "trading_date,trading_period,node,price\n"
    texts = {"day": "3/4/2024,1,A,1\n13/4/2024,2,A,1\n", "month": "3/4/2024,1,B,1\n4/13/2024,2,B,1\n2024-05-06,3,B,1\n",
             "both": "3/4/2024,1,C,1\n13/4/2024,2,C,1\n4/13/2024,3,C,1\n2024-05-06,4,C,1\n", "none": "3/4/2024,1,D,1\nx,2,D,1\n"}
    _os.makedirs(f"{tmp}/p")
    for name, text in texts.items():
        with open(f"{tmp}/p/{name} file.csv", "w") as f:
            f.write(head + text)
    rows, rejects = FS.read_prices(spark, FS.list_files(spark, f"{tmp}/p", "*.csv"))
    got = sorted((r.node, r.trading_period, r.trading_date) for r in rows.collect())
    assert got == [("A", 1, dt.date(2024, 4, 3)), ("A", 2, dt.date(2024, 4, 13)), ("B", 1, dt.date(2024, 3, 4)), ("B", 2, dt.date(2024, 4, 13)),
                   ("B", 3, dt.date(2024, 5, 6)), ("C", 4, dt.date(2024, 5, 6)), ("D", 1, dt.date(2024, 4, 3))]
    assert sorted(r.reason for r in rejects.collect()) == [FS.DISAGREE] * 3 + ["no valid trading_date"]
    assert not [r for r in rejects.collect() if "__layout" in r.record]
    gen = "Site_Code,POC_Code,Nwk_Code,Gen_Code,Fuel_Code,Tech_Code,Trading_Date,TP1\n"
    _os.makedirs(f"{tmp}/g")
    for name, dates in (("a", ("3/4/2024", "4/13/2024")), ("b", ("3/4/2024", "13/4/2024"))):
        with open(f"{tmp}/g/{name}.csv", "w") as f:
            f.write(gen + "".join(f"S,{name},N,G,Hydro,T,{d},5\n" for d in dates))
    long, rejects = FS.read_generation(spark, FS.list_files(spark, f"{tmp}/g", "*.csv"))
    assert sorted((r.poc_code, r.trading_date) for r in long.collect()) == [
        ("a", dt.date(2024, 3, 4)), ("a", dt.date(2024, 4, 13)), ("b", dt.date(2024, 4, 3)), ("b", dt.date(2024, 4, 13))]
    assert rejects.count() == 0
