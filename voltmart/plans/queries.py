"""Driver queries: each takes (spark, sf_dir) and returns a DataFrame over the
whole test tables, shaped by the adapters into the raw electricity tables.

Outputs go through ``report``: decimals are rounded to 6 places and cast to
double, small integers to int, so results compare cleanly with other engines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions import round_money, to_date_lenient, to_integral, to_number
from ..functions import volatility_class
from ..operators import (bitmap_words, blocked_windows, count_words, label_by_ranges, merge_words, smoke_profile,
                         check_balanced, check_not_null, check_unique, completeness_pct,
                         count_distinct_if, count_distinct_when, count_if, days_since_last, enrich,
                         ensure_columns, first_wins, head_rows, insert_ignore, lead_columns, normalise_headers,
                         ordered, out_of_range, percentiles, pivot_periods, profile_series, register_view, rename_present, rolling_sum,
                         select_present, table_after_insert, union_all, unmapped_total, unpivot_periods,
                         upsert)
from ..schemas import RAW_PRICES, RAW_WEATHER
from ..session import scratch_path
from ..sinks import (append, create_table, load_insert_ignore, load_upsert, materialise, read_conflicts, read_table, write_csv, write_version)
from ..sources.files import (ORDER, list_files, read_generation, read_prices, read_retail, read_weather_csv,
                             read_weather_json, select_files_by_year)
from ..sources.seeds import read_seed, seed
from ..streaming.incremental import start_price_ingest
from ..sources import adapters as A
from ..sources.calendar import spine_between, with_calendar_attributes
from . import marts
from .pipeline import Pipeline

Query = Callable[[SparkSession, str], DataFrame]
# Price files before this day use the first header layout, later ones the second.
LAYOUT_SWITCH = "2023-01-01"
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(f):
        QUERIES[name] = lambda spark, sf_dir: report(f(spark, sf_dir))
        QUERIES[name].__doc__ = f.__doc__
        return f
    return deco


def report(df: DataFrame) -> DataFrame:
    """Presentation types: decimal -> round 6 -> double; tinyint/smallint -> int."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = F.round(c, 6).cast("double")
        elif isinstance(f.dataType, (T.ShortType, T.ByteType)):
            c = c.cast("int")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------- raw tables

def raw_prices(spark, sf_dir) -> DataFrame:
    """Wholesale price table after first-wins loading of the long-range feed."""
    return first_wins(A.raw_prices_orders(spark, sf_dir), C.PRICE_KEY, ["o_orderkey"])


def raw_prices_month(spark, sf_dir) -> DataFrame:
    """Wholesale price table after first-wins loading of the one-month feed."""
    return first_wins(A.raw_prices_events(spark, sf_dir), C.PRICE_KEY, ["event_id"])


def raw_generation(spark, sf_dir) -> DataFrame:
    return first_wins(A.raw_generation_lineitem(spark, sf_dir), C.GENERATION_KEY, ["l_orderkey", "l_linenumber"])


def raw_weather(spark, sf_dir) -> DataFrame:
    # First load into an empty table: keys are already unique per (location, day).
    return A.raw_weather_orders(spark, sf_dir).withColumn("inserted_at", F.current_timestamp())


def pipeline(spark, sf_dir, prices: str = "long", **kw) -> Pipeline:
    raw = {
        "generation_output": lambda: raw_generation(spark, sf_dir),
        "wholesale_prices": (lambda: raw_prices(spark, sf_dir)) if prices == "long"
        else (lambda: raw_prices_month(spark, sf_dir)),
        "weather_daily": lambda: raw_weather(spark, sf_dir),
    }
    return Pipeline(spark, raw, **kw)


# ---------------------------------------------------------------- staging

@query("stg_generation")
def q_stg_generation(spark, sf_dir):
    """Staged generation: unit conversion, renewable flag, category map, period start."""
    return pipeline(spark, sf_dir).ref("stg_generation")


@query("stg_prices")
def q_stg_prices(spark, sf_dir):
    """Staged prices: MWh volumes, strict spike flag, period start."""
    return pipeline(spark, sf_dir).ref("stg_wholesale_prices")


@query("stg_weather")
def q_stg_weather(spark, sf_dir):
    """Staged weather (renamed measures, year/month); the load stamp is left out."""
    return pipeline(spark, sf_dir).ref("stg_weather_daily").drop("inserted_at")


@query("dim_date_span")
def q_dim_date_span(spark, sf_dir):
    """Calendar attributes for every day between the first and last generation day."""
    g = raw_generation(spark, sf_dir)
    spine = spine_between(g, F.min("trading_date"), F.max("trading_date"))
    return with_calendar_attributes(spine, "date_day")


# ---------------------------------------------------------------- generation

@query("generation_daily")
def q_generation_daily(spark, sf_dir):
    return pipeline(spark, sf_dir).ref("int_generation_daily")


@query("generation_completeness")
def q_generation_completeness(spark, sf_dir):
    """Periods reported per connection point and day against the 48 expected."""
    s = pipeline(spark, sf_dir).ref("stg_generation")
    return s.groupBy("poc_code", "trading_date").agg(
        F.count(F.lit(1)).alias("trading_periods_with_data"),
        completeness_pct(C.EXPECTED_PERIODS).alias("data_completeness_pct"))


@query("generation_mix_daily")
def q_generation_mix_daily(spark, sf_dir):
    """National mix with shares, totals joined back (the source's join form)."""
    return pipeline(spark, sf_dir, share_form="join").ref("int_generation_mix_daily")


@query("share_of_total_window")
def q_share_window(spark, sf_dir):
    """Same mix with the totals as a window sum (no self-join)."""
    return pipeline(spark, sf_dir, share_form="window").ref("int_generation_mix_daily")


@query("mart_generation_mix")
def q_mart_generation_mix(spark, sf_dir):
    return pipeline(spark, sf_dir).ref("mart_generation_mix")


@query("mart_price_vs_generation")
def q_mart_price_vs_generation(spark, sf_dir):
    return pipeline(spark, sf_dir).ref("mart_price_vs_generation")


@query("mart_carbon_intensity")
def q_mart_carbon(spark, sf_dir):
    return pipeline(spark, sf_dir).ref("mart_carbon_intensity_daily")


@query("mart_daily_demand")
def q_mart_daily_demand(spark, sf_dir):
    return pipeline(spark, sf_dir).ref("mart_daily_demand")


# ---------------------------------------------------------------- price risk

def _month_prices(spark, sf_dir) -> DataFrame:
    return pipeline(spark, sf_dir, prices="month").ref("stg_wholesale_prices")


@query("price_percentiles")
def q_price_percentiles(spark, sf_dir):
    """Exact median and p95 per day, a group's values counted in one task (days of one month feed)."""
    s = _month_prices(spark, sf_dir)
    p = percentiles(s, ["trading_date"], "price_nzd_per_mwh", [0.5, 0.95], ["m", "p"], strategy="builtin")
    return p.select("trading_date", round_money("m").alias("median_price_nzd_per_mwh"),
                    round_money("p").alias("p95_price_nzd_per_mwh"))


@query("price_percentiles_distributed")
def q_price_percentiles_distributed(spark, sf_dir):
    """Same percentiles by ranks over value ranges (no group in one task)."""
    s = _month_prices(spark, sf_dir)
    p = percentiles(s, ["trading_date"], "price_nzd_per_mwh", [0.5, 0.95], ["m", "p"], strategy="distributed")
    return p.select("trading_date", round_money("m").alias("median_price_nzd_per_mwh"),
                    round_money("p").alias("p95_price_nzd_per_mwh"))


@query("price_stats_by_node")
def q_price_stats_by_node(spark, sf_dir):
    s = _month_prices(spark, sf_dir)
    return s.groupBy("trading_date", "node").agg(
        *marts.price_stats(s), F.count(F.lit(1)).alias("period_count"),
        count_if(F.col("is_price_spike")).alias("spike_periods_count"))


@query("spike_periods_distinct")
def q_spike_distinct(spark, sf_dir):
    """count(distinct case when spike then period end) per day, generic form."""
    s = _month_prices(spark, sf_dir)
    return s.groupBy("trading_date").agg(
        count_distinct_when(F.col("is_price_spike"), "trading_period").alias("spike_periods_distinct"),
        count_if(F.col("is_price_spike")).alias("spike_records_count"))


@query("spike_periods_bitmask")
def q_spike_bitmask(spark, sf_dir):
    """Same measure as a one-pass bitmask (single exchange)."""
    s = _month_prices(spark, sf_dir)
    return s.groupBy("trading_date").agg(
        count_distinct_if(F.col("is_price_spike"), "trading_period").alias("spike_periods_distinct"),
        count_if(F.col("is_price_spike")).alias("spike_records_count"))


@query("volatility_class")
def q_volatility_class(spark, sf_dir):
    """Daily price shape, spike counts, range and the Calm..Extreme class (month feed)."""
    p = pipeline(spark, sf_dir, prices="month")
    d = p.ref("price_daily_risk")
    return d.select("*", (F.col("max_price_nzd_per_mwh") - F.col("min_price_nzd_per_mwh")).alias("price_range_nzd_per_mwh"),
                    (F.col("spike_periods_distinct") > 0).alias("is_spike_day"),
                    volatility_class("p95_price_nzd_per_mwh", "spike_periods_distinct").alias("volatility_class"))


@query("spike_rolling")
def q_spike_rolling(spark, sf_dir):
    """Rolling spike breadth/depth and days since last spike on the month feed."""
    d = pipeline(spark, sf_dir, prices="month").ref("price_daily_spikes")
    d = d.select("trading_date", "spike_periods_distinct",
                 (F.col("spike_periods_distinct") > 0).alias("is_spike_day"))
    return marts.add_risk_windows(d)


@query("days_since_last_spike")
def q_days_since(spark, sf_dir):
    """Days since the last spike day over the long feed (gaps between days counted)."""
    d = pipeline(spark, sf_dir).ref("price_daily_spikes")
    d = d.select("trading_date", (F.col("spike_periods_distinct") > 0).alias("is_spike_day"))
    return d.withColumn("days_since_last_spike", days_since_last("trading_date", F.col("is_spike_day"), None,
                                                                 day_grain=True))


@query("mart_price_risk")
def q_mart_price_risk(spark, sf_dir):
    return pipeline(spark, sf_dir).ref("mart_price_risk_daily")


# ---------------------------------------------------------------- weather

@query("weather_catchment")
def q_weather_catchment(spark, sf_dir):
    return pipeline(spark, sf_dir).ref("int_weather_catchment_daily")


@query("catchment_rollup")
def q_catchment_rollup(spark, sf_dir):
    return pipeline(spark, sf_dir).ref("weather_by_catchment")


@query("precip_rolling")
def q_precip_rolling(spark, sf_dir):
    """7- and 30-row trailing precipitation per catchment (rows, not days)."""
    w = pipeline(spark, sf_dir).ref("weather_by_catchment")
    order = ["observation_date", "island"]
    return w.select("observation_date", "catchment", "island", "total_precip_mm").withColumns({
        f"precip_{n}d_rolling_sum": rolling_sum("total_precip_mm", ["catchment"], order, n)
        for n in C.ROLLING_LENGTHS})


@query("precip_rolling_calendar")
def q_precip_rolling_calendar(spark, sf_dir):
    """Calendar-day variant: sums over the last 7 / 30 days, gaps not stretched."""
    w = pipeline(spark, sf_dir).ref("weather_by_catchment")
    return w.select("observation_date", "catchment", "island", "total_precip_mm").withColumns({
        f"precip_{n}d_calendar_sum": rolling_sum("total_precip_mm", ["catchment"], ["observation_date"], n,
                                                 calendar=True)
        for n in C.ROLLING_LENGTHS})


@query("price_leads")
def q_price_leads(spark, sf_dir):
    """Daily price at each bridge node with the price 1..30 rows later."""
    d = pipeline(spark, sf_dir).ref("prices_by_node_daily")
    return d.select("trading_date", "node", "avg_price_nzd_per_mwh").withColumns(
        lead_columns("avg_price_nzd_per_mwh", ["node"], ["trading_date"], C.LEAD_OFFSETS, "price_lead_{k}d"))


@query("mart_catchment_weather_pricing")
def q_mart_catchment(spark, sf_dir):
    return pipeline(spark, sf_dir).ref("mart_catchment_weather_pricing_daily")


# ---------------------------------------------------------------- ingest operators

@query("unpivot_periods")
def q_unpivot(spark, sf_dir):
    """Generation pivoted to one text column per period, then unpivoted back."""
    g = raw_generation(spark, sf_dir)
    ids = list(C.GENERATION_ID_COLUMNS)
    wide = pivot_periods(g.withColumn("trading_date", F.col("trading_date").cast("string")),
                         ids, "trading_period", "output_kw")
    wide = wide.select(*ids, *[F.col(f"tp{i}").cast("string").alias(f"TP{i}") for i in range(1, C.MAX_PERIOD + 1)])
    return unpivot_periods(normalise_headers(wide), ids)


@query("lenient_parse")
def q_lenient_parse(spark, sf_dir):
    """Price rows as text with junk dates, blank/bad prices and fractional periods."""
    e = A.raw_prices_events(spark, sf_dir, keep=("event_type",))
    et = F.col("event_type")
    text = e.select(
        F.when(et == "error", F.lit("junk")).otherwise(F.col("trading_date").cast("string")).alias("trading_date"),
        F.when(et == "signup", F.concat(F.col("trading_period").cast("string"), F.lit(".5")))
         .otherwise(F.col("trading_period").cast("string")).alias("trading_period"),
        "node",
        F.when(et == "click", F.lit("abc")).when(et == "view", F.lit(" "))
         .otherwise(F.col("price").cast("string")).alias("price"),
        F.col("load_mw").cast("string").alias("load_mw"),
        "event_id")
    parsed = text.select(
        to_date_lenient("trading_date").alias("trading_date"),
        to_integral("trading_period").alias("trading_period"),
        "node", to_number("price").alias("price"), to_number("load_mw").alias("load_mw"), "event_id")
    return parsed.na.drop(subset=list(C.PRICE_REQUIRED))


@query("insert_ignore_prices")
def q_insert_ignore_prices(spark, sf_dir):
    """Month feed inserted first-wins into the table loaded from the long feed."""
    existing = raw_prices(spark, sf_dir)
    incoming = A.raw_prices_events(spark, sf_dir)
    return table_after_insert(existing, incoming, C.PRICE_KEY, ["event_id"])


@query("insert_ignore_null_keys")
def q_insert_ignore_null_keys(spark, sf_dir):
    """Rows with a null node never conflict and are all kept."""
    incoming = (A.raw_prices_events(spark, sf_dir, keep=("event_type",))
                .withColumn("node", F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
                            .otherwise(F.col("node")))
                .drop("event_type"))
    return insert_ignore(incoming, C.PRICE_KEY, ["event_id"])


@query("upsert_weather")
def q_upsert_weather(spark, sf_dir):
    """Weather loaded in two overlapping fetches; the later fetch wins per (lake, day)."""
    first, second = weather_fetches(spark, sf_dir)
    table0 = upsert(None, first, C.WEATHER_KEY)
    table1 = upsert(table0, second, C.WEATHER_KEY)
    return table1.drop("inserted_at")


def weather_fetches(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Two weather fetches that overlap in 1997; the later one reports half a millimetre more."""
    o = A.table(spark, sf_dir, "orders")
    first = A.raw_weather_orders(spark, sf_dir, o.where(F.col("o_orderdate") < F.lit("1998-01-01")))
    second = A.raw_weather_orders(spark, sf_dir, o.where(F.col("o_orderdate") >= F.lit("1997-01-01")))
    return first, second.withColumn("precipitation_sum",
                                    (F.col("precipitation_sum") + F.lit(Decimal("0.5"))).cast("decimal(6,2)"))


@query("union_missing_columns")
def q_union_missing(spark, sf_dir):
    """Two price file layouts (raw headers, one without generation) unioned by name."""
    raw = A.raw_prices_orders(spark, sf_dir)
    no_gen = F.col("generation_mw").isNull()
    layout_a = raw.where(no_gen).select(
        *[F.col(new).alias(old) for old, new in C.PRICE_COLUMN_MAP if new != "generation_mw"],
        F.lit("x").alias("Extra"))
    layout_b = raw.where(~no_gen).select(*[F.col(new).alias(old) for old, new in C.PRICE_COLUMN_MAP])
    parts = []
    for part in (layout_a, layout_b):
        part = rename_present(part, C.PRICE_COLUMN_MAP)
        part = select_present(part, [f.name for f in RAW_PRICES.fields])
        parts.append(ensure_columns(part, RAW_PRICES))
    return union_all(parts).select(*[f.name for f in RAW_PRICES.fields])


@query("csv_roundtrip_ingest")
def q_csv_roundtrip(spark, sf_dir):
    """The long price feed written as raw price CSV files in two header layouts
    (the later one without GenerationMegawatts, columns reordered, an extra
    column in the earlier one), then read back by header and loaded first-wins
    in file and row order. Files are written under the shared checkpoint folder."""
    base = scratch_path(spark, "price-files")
    early, late = price_file_layouts(spark, sf_dir)
    write_price_files(early, f"{base}/a")
    write_price_files(late, f"{base}/b")
    typed, _rejects = read_prices(spark, list_files(spark, base, "*.csv", recursive=True))
    return first_wins(typed, C.PRICE_KEY, [ORDER])


def price_file_layouts(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The long price feed in two raw layouts: before and from the switch day."""
    raw = A.raw_prices_orders(spark, sf_dir)
    names = dict(C.PRICE_COLUMN_MAP)
    inv = {v: k for k, v in names.items()}
    split = F.col("trading_date") < F.lit(LAYOUT_SWITCH)
    early = raw.where(split).select(*[F.col(c).alias(inv[c]) for c in
                                      ("trading_date", "trading_period", "node", "price", "load_mw", "generation_mw")],
                                    F.lit("x").alias("Extra"), "o_orderkey")
    late = raw.where(~split).select(*[F.col(c).alias(inv[c]) for c in
                                      ("node", "price", "trading_date", "load_mw", "trading_period")], "o_orderkey")
    return early, late


def write_price_files(part: DataFrame, folder: str) -> None:
    """Dates never straddle files within a key, and rows keep arrival order in a file."""
    (part.repartitionByRange("TradingDate").sortWithinPartitions("TradingDate", "o_orderkey")
     .drop("o_orderkey").write.mode("append").option("header", True).csv(folder))


@query("incremental_price_ingest")
def q_incremental(spark, sf_dir):
    """The same price files arriving in two lots, each picked up by a run of the
    file stream and merged first-wins into the month-partitioned price table."""
    base = scratch_path(spark, "price-stream")
    for lot in price_file_layouts(spark, sf_dir):
        write_price_files(lot, f"{base}/incoming")
        run = start_price_ingest(spark, f"{base}/incoming", f"{base}/table", f"{base}/checkpoint",
                                 rejects_path=f"{base}/rejects")
        run.awaitTermination()
    return read_table(spark, f"{base}/table", RAW_PRICES)


@query("price_file_rejects")
def q_price_file_rejects(spark, sf_dir):
    """Month feed as files with junk dates, fractional periods, missing nodes and bad prices,
    and files without a price column: records kept back per reason (0: whole files)."""
    e = A.raw_prices_events(spark, sf_dir, keep=("event_type",))
    et = F.col("event_type")
    names = {new: old for old, new in C.PRICE_COLUMN_MAP}
    faulty = e.select(
        F.when(et == "error", F.lit("junk")).otherwise(F.col("trading_date").cast("string")).alias(names["trading_date"]),
        F.when(et == "signup", F.concat(F.col("trading_period").cast("string"), F.lit(".5")))
         .otherwise(F.col("trading_period").cast("string")).alias(names["trading_period"]),
        F.when(F.col("event_id") % 10 == 0, F.lit("NA")).otherwise(F.col("node")).alias(names["node"]),
        F.when(et == "click", F.lit("abc")).otherwise(F.col("price").cast("string")).alias(names["price"]))
    base = scratch_path(spark, "price-rejects")
    write_csv(faulty, f"{base}/a")
    write_csv(faulty.drop(names["price"]), f"{base}/b")
    typed, rejects = read_prices(spark, list_files(spark, base, "*.csv", recursive=True))
    loaded = typed.agg(F.lit("loaded").alias("reason"), F.count(F.lit(1)).alias("records"))
    return loaded.unionByName(rejects.groupBy("reason").agg(F.count("record").alias("records")))


@query("retail_lineage")
def q_retail_lineage(spark, sf_dir):
    """Customer accounts as retail summary files in two layouts (a column that is a number in
    one and text in the other, columns reordered), read by header and appended twice."""
    c = A.table(spark, sf_dir, "customer")
    base = scratch_path(spark, "retail-files")
    odd = F.col("c_custkey") % 2 == 1
    nation = F.col("c_nationkey").cast("string")
    cols = [F.col("c_mktsegment").alias("region"), F.col("c_custkey").alias("account"), F.col("c_acctbal").alias("avg_cost")]
    c.where(odd).select(*cols, nation.alias("plan")).write.mode("append").option("header", True).csv(base)
    c.where(~odd).select(F.concat(F.lit("P"), nation).alias("plan"), *reversed(cols)).write.mode("append").option("header", True).csv(base)
    rows, _rejects = read_retail(spark, base)
    out = scratch_path(spark, "retail-table")
    append(rows, out)
    append(rows, out)
    return (spark.read.parquet(out)
            .select("region", "account", "avg_cost", "plan", F.col("raw_filename").endswith(".csv").alias("has_lineage")))


@query("csv_quoted_records")
def q_csv_quoted(spark, sf_dir):
    """Customers as CSV whose cells hold line feeds, commas and quotes and whose header holds a comma, read by header."""
    c = A.table(spark, sf_dir, "customer")
    base = scratch_path(spark, "quoted-files")
    note = F.concat_ws("\n", F.concat(F.lit('say "'), "c_name", F.lit('",')), "c_mktsegment", F.when(F.col("c_custkey") % 3 == 0, F.lit("")))
    (c.select(F.col("c_custkey").alias("account"), note.alias("note"), F.col("c_acctbal").alias("balance, total"))
     .write.options(header=True, escape='"', ignoreTrailingWhiteSpace=False).csv(base))
    rows, _rejects = read_retail(spark, base)
    return rows.select("account", "note", F.col("`balance, total`").cast("double").alias("balance"))


@query("weather_csv_roundtrip")
def q_weather_csv(spark, sf_dir):
    """Weather exported as CSV and read back with the declared types."""
    base = scratch_path(spark, "weather-csv")
    write_csv(A.raw_weather_orders(spark, sf_dir), base)
    rows, _rejects = read_weather_csv(spark, base)
    return rows.drop(ORDER)


@query("seed_csv_factors")
def q_seed_csv(spark, sf_dir):
    """The emission-factor seed written and read as CSV, joined to the daily mix."""
    seed_df, n = seed(spark, "emission_factors")
    base = scratch_path(spark, "seed-csv")
    write_csv(seed_df, base)
    mix = pipeline(spark, sf_dir).ref("int_generation_mix_daily")
    return enrich(mix, read_seed(spark, base, "emission_factors"), on="fuel_category", how="left", dim_rows=n).select(
        "trading_date", "fuel_category", "total_mwh", "emission_factor_kg_co2_per_mwh")


@query("file_year_filter")
def q_file_years(spark, sf_dir):
    """Monthly file names of the generation feed whose leading year lies in 2021..2024."""
    g = A.raw_generation_lineitem(spark, sf_dir)
    names = g.select(F.concat(F.date_format("trading_date", "yyyyMM"), F.lit("_Generation_MD.csv")).alias("file_name"))
    return select_files_by_year(names, 2021, 2024).groupBy("file_name").agg(F.count(F.lit(1)).alias("rows_in_month"))


@query("range_check")
def q_range_check(spark, sf_dir):
    """Weather measures times 40 against the declared decimals: values they cannot hold."""
    w = A.raw_weather_orders(spark, sf_dir)
    wide = w.select(*[(F.col(m) * F.lit(40)).cast("decimal(18,2)").alias(m) for m in C.WEATHER_MEASURES])
    return out_of_range(wide, RAW_WEATHER)


@query("upsert_stamp")
def q_upsert_stamp(spark, sf_dir):
    """Load stamps after two overlapping fetches: untouched rows keep the first one."""
    first, second = weather_fetches(spark, sf_dir)
    t0 = upsert(None, first, C.WEATHER_KEY, stamp=F.lit("2024-01-01 00:00:00").cast("timestamp"))
    t1 = upsert(t0, second, C.WEATHER_KEY, stamp=F.lit("2024-02-01 00:00:00").cast("timestamp"))
    return t1.select("location", "time", F.date_format("inserted_at", "yyyy-MM-dd").alias("loaded_on"))


@query("insert_ignore_table")
def q_insert_ignore_table(spark, sf_dir):
    """Long feed, then month feed, loaded into a stored month-partitioned table."""
    base = scratch_path(spark, "price-table")
    load_insert_ignore(spark, base, A.raw_prices_orders(spark, sf_dir), C.PRICE_KEY, ["o_orderkey"], RAW_PRICES,
                       month_of="trading_date")
    load_insert_ignore(spark, base, A.raw_prices_events(spark, sf_dir), C.PRICE_KEY, ["event_id"], RAW_PRICES,
                       month_of="trading_date")
    return read_table(spark, base)


@query("insert_ignore_presence")
def q_insert_ignore_presence(spark, sf_dir):
    """Both feeds loaded one after the other, the second twice; stored keys are looked up in bitmaps, no stored row is read."""
    base = scratch_path(spark, "presence-table")
    for rows, order in ((A.raw_prices_orders(spark, sf_dir), "o_orderkey"), (A.raw_prices_events(spark, sf_dir), "event_id"),
                        (A.raw_prices_events(spark, sf_dir), "event_id")):
        load_insert_ignore(spark, base, rows, C.PRICE_KEY, [order], RAW_PRICES, month_of="trading_date", presence="trading_period")
    return read_table(spark, base)


@query("distinct_rollup")
def q_distinct_rollup(spark, sf_dir):
    """Distinct customers per month and year, merged from stored bitmaps of each day."""
    base = scratch_path(spark, "day-bitmaps")
    orders = A.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"), "o_custkey")
    write_version(bitmap_words(orders, ["day"], "o_custkey"), base)
    days = read_table(spark, base)
    grains = [("month", F.year("day") * 100 + F.month("day")), ("year", F.year("day"))]
    return union_all([count_words(merge_words(days, [F.lit(name).alias("grain"), of.alias("span")]), ["grain", "span"], "customers")
                      for name, of in grains])


@query("spike_rolling_records")
def q_spike_rolling_records(spark, sf_dir):
    """Spikes among the last 7 and 30 price records and days since the last one, at record grain, in blocks."""
    s = _month_prices(spark, sf_dir).select("trading_date", "trading_period", "node", "is_price_spike")
    flag = F.when(F.col("is_price_spike"), 1).otherwise(0)
    return blocked_windows(s, ["trading_date", "trading_period", "node"], scratch_path(spark, "blocks"),
                           sums={"spikes_last_7": (flag, 7), "spikes_last_30": (flag, 30)},
                           days_since={"days_since_last_spike": ("trading_date", F.col("is_price_spike"))})


@query("price_range_labels")
def q_price_range_labels(spark, sf_dir):
    """Every price row with its label from a list of 10,000 overlapping date ranges, the first listed winning."""
    first = dt.date(2020, 1, 1)
    starts = [first + dt.timedelta(days=k * 37 % 3000) for k in range(10_000)]
    ranges = [(d, d + dt.timedelta(days=k % 9), f"r{k}") for k, d in enumerate(starts)]
    s = raw_prices(spark, sf_dir).select("trading_date", "trading_period", "node")
    return label_by_ranges(s, "trading_date", ranges, "label")


@query("smoke_profile")
def q_smoke_profile(spark, sf_dir):
    """The weather table as a whole and per location: rows, nulls, distinct values, smallest and largest value of each column."""
    return smoke_profile(raw_weather(spark, sf_dir), "location", ["time", "precipitation_sum", "snowfall_sum"])


@query("date_layouts_per_file")
def q_date_layouts(spark, sf_dir):
    """The long price feed written as day-first files (odd months) and month-first files (even months), read without a parameter."""
    base = scratch_path(spark, "layouts")
    feed = raw_prices(spark, sf_dir)
    odd = F.month("trading_date") % 2 == 1
    for folder, rows, layout in (("day", feed.where(odd), "d/M/yyyy"), ("month", feed.where(~odd), "M/d/yyyy")):
        # a file holds a node's rows of years, so days above 12 that tell its layout
        rows.withColumn("trading_date", F.date_format("trading_date", layout))\
            .repartition("node").write.option("header", True).csv(f"{base}/{folder}")
    typed, _rejects = read_prices(spark, list_files(spark, base, "*.csv", recursive=True))
    return typed.drop(ORDER)


@query("upsert_table")
def q_upsert_table(spark, sf_dir):
    """Two loads of a stored weather table, the second holding every row twice: the later one wins."""
    base = scratch_path(spark, "weather-table")
    first, second = weather_fetches(spark, sf_dir)
    stale = second.withColumn("precipitation_sum", F.lit(Decimal("0")).cast("decimal(6,2)"))
    twice = second.withColumn("__seq", F.lit(2)).unionByName(stale.withColumn("__seq", F.lit(1)))
    load_upsert(spark, base, first, C.WEATHER_KEY, [], RAW_WEATHER, month_of="time")
    load_upsert(spark, base, twice, C.WEATHER_KEY, ["__seq"], RAW_WEATHER, month_of="time")
    return read_table(spark, base).drop("inserted_at")


@query("load_conflicts")
def q_load_conflicts(spark, sf_dir):
    """Rows of the month feed that lost their key on loading it after the long feed: to a stored row, or to an earlier row of the feed."""
    base = scratch_path(spark, "conflict-table")
    for rows, order in ((A.raw_prices_orders(spark, sf_dir), "o_orderkey"), (A.raw_prices_events(spark, sf_dir), "event_id")):
        load_insert_ignore(spark, base, rows, C.PRICE_KEY, [order], RAW_PRICES, month_of="trading_date", conflicts=True)
    return read_conflicts(spark, base, 2).select(*C.PRICE_KEY, "n_lost", "to_stored")


@query("declared_table_roundtrip")
def q_declared_table(spark, sf_dir):
    """A declared table filled, fully refreshed as a new version, and read through a view."""
    base = scratch_path(spark, "declared")
    name = "declared_" + base.rsplit("-", 1)[-1]
    create_table(spark, name, RAW_PRICES, f"{base}/raw")
    raw_prices(spark, sf_dir).select(*[f.name for f in RAW_PRICES.fields]).write.insertInto(name)
    for _ in range(2):
        materialise(spark.table(name), f"{base}/mart", sort_by=["trading_date"])
    return register_view(f"{name}_view", read_table(spark, f"{base}/mart"))


@query("mart_ordered")
def q_mart_ordered(spark, sf_dir):
    """The price-against-generation mart in its final order (nulls last), with the position of
    each row as sorted; one row per day, so the numbering is bounded by the calendar."""
    m = pipeline(spark, sf_dir).ref("mart_price_vs_generation")
    cols = ["avg_price_nzd_per_mwh", "trading_date"]
    placed = ordered(m.select(*cols), cols).withColumn("__at", F.monotonically_increasing_id())
    return placed.select(*cols, F.row_number().over(Window.orderBy("__at")).alias("position"))


@query("demand_head")
def q_demand_head(spark, sf_dir):
    """The first three days of the demand mart (a sample of rows is the feature)."""
    m = pipeline(spark, sf_dir).ref("mart_daily_demand")
    return head_rows(ordered(m.select("trading_date", "total_demand_mwh"), ["trading_date"]), 3)


@query("generation_file_ingest")
def q_generation_files(spark, sf_dir):
    """Generation written as wide per-period CSV files in two header layouts
    (title-case ids then TP1..TP50; lower-case with the periods first and
    reversed), then scanned by header, unpivoted and loaded first-wins."""
    g = raw_generation(spark, sf_dir)
    ids = list(C.GENERATION_ID_COLUMNS)
    wide = pivot_periods(g, ids, "trading_period", "output_kw")
    base = scratch_path(spark, "generation-files")
    split = F.col("trading_date") < F.lit(LAYOUT_SWITCH)
    periods = [f"{C.PERIOD_PREFIX}{i}" for i in range(1, C.MAX_PERIOD + 1)]
    layout_a = wide.where(split).select(*[F.col(c).alias(c.title()) for c in ids],
                                        *[F.col(p).alias(p.upper()) for p in periods])
    layout_b = wide.where(~split).select(*reversed(periods), *reversed(ids))
    for part, name in ((layout_a, "a"), (layout_b, "b")):
        part.write.option("header", True).csv(f"{base}/{name}")
    long, _rejects = read_generation(spark, list_files(spark, base, "*.csv", recursive=True))
    return first_wins(long, C.GENERATION_KEY, [ORDER])


@query("weather_json_explode")
def q_weather_json(spark, sf_dir):
    """Weather written as one API-style document per lake (parallel daily arrays),
    then exploded back to one row per lake and day."""
    w = A.raw_weather_orders(spark, sf_dir)
    base = scratch_path(spark, "weather-json")
    series = w.groupBy("location").agg(F.sort_array(F.collect_list(F.struct(
        F.col("time").cast("string").alias("time"),
        *[F.col(m).cast("double").alias(m) for m in C.WEATHER_MEASURES]))).alias("s"))
    daily = F.struct(*[F.col(f"s.{c}").alias(c) for c in ("time",) + C.WEATHER_MEASURES])
    docs = series.select("location", F.create_map(F.lit("precipitation_sum"), F.lit("mm")).alias("daily_units"),
                         daily.alias("daily"))
    docs.write.partitionBy("location").json(base)
    rows, _rejects = read_weather_json(spark, base)
    return rows.drop(ORDER)


# ---------------------------------------------------------------- quality

@query("unmapped_fuel_check")
def q_unmapped_fuel(spark, sf_dir):
    """Per day: generation without an emission factor, and generation whose fuel
    code fell through the category rules to 'Other'."""
    p = pipeline(spark, sf_dir)
    s = p.ref("stg_generation")
    known = [code for codes, _ in C.FUEL_CATEGORY_RULES for code in codes]
    factors, n = p.seed("emission_factors")
    j = enrich(s, factors, on="fuel_category", how="left", dim_rows=n)
    return j.groupBy("trading_date").agg(
        F.sum("output_mwh").alias("total_generation_mwh"),
        unmapped_total("emission_factor_kg_co2_per_mwh", "output_mwh").alias("unmapped_generation_mwh"),
        F.sum(F.when(~F.coalesce(F.col("fuel_code").isin(known), F.lit(False)), F.col("output_mwh"))
              .otherwise(F.lit(0))).alias("unknown_fuel_code_mwh"))


@query("not_null_check")
def q_not_null(spark, sf_dir):
    return check_not_null(raw_weather(spark, sf_dir), ["location", "time", "snowfall_sum"])


@query("unique_check")
def q_unique(spark, sf_dir):
    """Duplicate (date, period, node) keys in the month feed before loading."""
    return check_unique(A.raw_prices_events(spark, sf_dir), C.PRICE_KEY)


@query("balance_check")
def q_balance(spark, sf_dir):
    return check_balanced(raw_weather(spark, sf_dir), "location")


@query("location_profile")
def q_location_profile(spark, sf_dir):
    return profile_series(raw_weather(spark, sf_dir), "location", "time", "precipitation_sum")
