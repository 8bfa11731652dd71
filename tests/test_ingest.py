import datetime as dt
import json
import os
import re
from decimal import Decimal

from pyspark.sql import functions as F

from voltmart import constants as C
from voltmart import schemas as S
from voltmart.operators import first_wins
from voltmart.sinks import (append, create_table, load_insert_ignore, load_upsert, read_table, register_table,
                            write_csv)
from voltmart.sources import files as FS
from voltmart.sources.seeds import read_seed


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_generation_header_drift_and_first_wins(spark, tmp):
    d = f"{tmp}/gen"
    # file 1: TP columns in order; file 2: columns reordered and differently cased
    write(f"{d}/202401_Generation_MD.csv",
          "Site_Code,POC_Code,Nwk_Code,Gen_Code,Fuel_Code,Tech_Code,Trading_Date,TP1,TP2,TP49\n"
          "S1,P1,N1,G1,Hydro,T,2024-01-15,100,,7\n"
          "S1,P1,N1,G1,Hydro,T,2024-01-15,999,NA,8\n"
          "S2,,N1,G2,Wind,T,2024-01-15,5,abc,\n"
          "S2,,N1,G2,Wind,T,2024-01-15,6,,\n")
    write(f"{d}/202402_Generation_MD.csv",
          "TP2,trading_date,tp1,site_code,poc_code,nwk_code,gen_code,fuel_code,tech_code\n"
          "20,2024-01-15,300,S1,P1,N1,G1,Hydro,T\n"
          "21,junk,1,S3,P3,N1,G3,Coal,T\n")
    write(f"{d}/202403_Generation_MD.csv", "a,b\n1,2\n")
    long, rejects = FS.read_generation(spark, FS.list_files(spark, d, C.GENERATION_FILE_GLOB))
    assert sorted((r["path"].rsplit("/", 1)[-1][:6], r["reason"].split(":")[0], (r["record"] or "")[:9]) for r in rejects.collect()) == [
        ("202401", "not a number", "tp2=abc"), ("202402", "no trading_date", '{"site_co'), ("202403", "missing required columns", "")]
    table = first_wins(long, C.GENERATION_KEY, [FS.ORDER])
    got = rows(table, "poc_code", "trading_period", "output_kw", "fuel_code")
    assert got == sorted([
        ("P1", 1, Decimal("100.000000"), "Hydro"),   # file 1 row 1 beats row 2 and file 2
        ("P1", 2, Decimal("20.000000"), "Hydro"),    # only file 2 has a value
        ("P1", 49, Decimal("7.000000"), "Hydro"),
        (None, 1, Decimal("5.000000"), "Wind"),      # null keys never conflict
        (None, 1, Decimal("6.000000"), "Wind"),
    ], key=repr)


def test_prices_rename_missing_optional_and_rejects(spark, tmp):
    d = f"{tmp}/prices"
    write(f"{d}/20240101_Prices.csv",
          "TradingDate,TradingPeriodNumber,PointOfConnectionCode,DollarsPerMegawattHour,LoadMegawatts,Extra\n"
          "2024-01-01,1,BEN2202,100.5,10,x\n"
          "2024-01-01,1.5,BEN2202,1,1,x\n"
          "2024-01-01,2,BEN2202,,1,x\n")
    write(f"{d}/20240102_Prices.csv",
          "PointOfConnectionCode,TradingDate,DollarsPerMegawattHour,TradingPeriodNumber,GenerationMegawatts,LoadMegawatts\n"
          "BEN2202,2024-01-01,555,1,3,4\n"
          "MAN2201,2024-01-02,600,3,2,1\n")
    write(f"{d}/20240103_Prices.csv", "TradingDate,PointOfConnectionCode\n2024-01-03,X\n")
    typed, rejects = FS.read_prices(spark, FS.list_files(spark, d, "*.csv"))
    assert sorted(r["reason"] for r in rejects.collect()) == [
        "missing required columns: ['trading_period', 'price']", "no valid price", "no valid trading_period"]
    base = f"{tmp}/tables/wholesale_prices"
    load_insert_ignore(spark, base, typed, C.PRICE_KEY, [FS.ORDER], S.RAW_PRICES)
    t = read_table(spark, base)
    assert rows(t, "trading_date", "trading_period", "node", "price", "load_mw", "generation_mw") == [
        (dt.date(2024, 1, 1), 1, "BEN2202", Decimal("100.500000"), Decimal("10.000000"), None),
        (dt.date(2024, 1, 2), 3, "MAN2201", Decimal("600.000000"), Decimal("1.000000"), Decimal("2.000000")),
    ]
    # re-runs add nothing (each writes an empty batch) and the table stays the same
    load_insert_ignore(spark, base, typed, C.PRICE_KEY, [FS.ORDER], S.RAW_PRICES)
    load_insert_ignore(spark, base, typed, C.PRICE_KEY, [FS.ORDER], S.RAW_PRICES)
    assert read_table(spark, base).count() == 2
    assert sorted(os.listdir(base)) == ["batch=1", "batch=2", "batch=3"]
    register_table(spark, "wholesale_prices_current", base)
    assert spark.sql("SELECT count(*) AS n FROM wholesale_prices_current").first()["n"] == 2


def test_weather_json_and_csv_upsert(spark, tmp):
    doc = {"latitude": -44.07, "longitude": 170.14, "daily_units": {"precipitation_sum": "mm"},
           "daily": {"time": ["2024-01-01", "2024-01-02"], "precipitation_sum": [1.2, None],
                     "rain_sum": [1.0, 0.0], "snowfall_sum": [0.0, 0.0], "temperature_2m_mean": [12.3, 13.0],
                     "temperature_2m_max": [15.0, 16.0], "temperature_2m_min": [9.0, 10.0]}}
    write(f"{tmp}/cache/lake_pukaki_2024-01-01_2025-12-31.json", json.dumps(doc, indent=2))
    write(f"{tmp}/cache/lake_taupo_2024-01-01_2025-12-31.json", json.dumps(doc))
    w, rejected = FS.read_weather_json(spark, f"{tmp}/cache")
    assert rejected.count() == 0
    w = w.drop(FS.ORDER)
    assert rows(w, "location", "time", "precipitation_sum")[:2] == [
        ("lake_pukaki", dt.date(2024, 1, 1), Decimal("1.20")), ("lake_pukaki", dt.date(2024, 1, 2), None)]
    write_csv(w, f"{tmp}/weather_csv")
    # a second export with its columns in another order and one measure missing
    write(f"{tmp}/weather_csv/late.csv", "time,temperature_2m_mean,location,precipitation_sum\n2024-01-03,11.5,lake_ohau,2.25\n")
    back, _ = FS.read_weather_csv(spark, f"{tmp}/weather_csv")
    late = back.where(F.col("location") == "lake_ohau").first()
    assert (late["time"], late["precipitation_sum"], late["temperature_2m_mean"], late["rain_sum"]) == (
        dt.date(2024, 1, 3), Decimal("2.25"), Decimal("11.50"), None)
    back = back.where(F.col("location") != "lake_ohau")
    base = f"{tmp}/tables/weather_daily"
    load_upsert(spark, base, back, C.WEATHER_KEY, [FS.ORDER], S.RAW_WEATHER)
    first = read_table(spark, base)
    assert first.count() == 4
    newer = back.withColumn("precipitation_sum", F.lit(Decimal("9.99")).cast("decimal(6,2)"))
    load_upsert(spark, base, newer.where(F.col("location") == "lake_taupo"), C.WEATHER_KEY, [FS.ORDER], S.RAW_WEATHER)
    t = read_table(spark, base)
    got = {(r["location"], r["time"]): r["precipitation_sum"] for r in t.collect()}
    assert got[("lake_taupo", dt.date(2024, 1, 2))] == Decimal("9.99")
    assert got[("lake_pukaki", dt.date(2024, 1, 2))] is None
    stamps = {r["location"]: r["inserted_at"] for r in t.collect()}
    assert stamps["lake_taupo"] >= stamps["lake_pukaki"]


def test_retail_lineage_and_append(spark, tmp):
    write(f"{tmp}/retail/a.csv", "region,network,avg_cost_cents_per_kwh\nAuckland,Vector,30.5\n")
    write(f"{tmp}/retail/b.csv", "network,avg_cost_cents_per_kwh,region,extra\nAurora,28.1,Otago,1\n")
    df, _ = FS.read_retail(spark, f"{tmp}/retail")
    got = sorted((r["raw_filename"], r["region"], r["network"], r["avg_cost_cents_per_kwh"]) for r in df.collect())
    assert got == [("a.csv", "Auckland", "Vector", 30.5), ("b.csv", "Otago", "Aurora", 28.1)]   # by name
    append(df, f"{tmp}/retail_out")
    append(df, f"{tmp}/retail_out")
    assert spark.read.parquet(f"{tmp}/retail_out").count() == 4


def test_seed_csv_leading_blank(spark, tmp):
    path = write(f"{tmp}/seeds/emission_factors.csv",
                 "fuel_category,emission_factor_kg_co2_per_mwh\nCoal,900\nOther, 200\n")
    got = {r[0]: r[1] for r in read_seed(spark, path, "emission_factors").collect()}
    assert got == {"Coal": 900, "Other": 200}
    path = write(f"{tmp}/seeds2/dim_concatchment_node.csv", "pricing_node,catchment\nBEN2202,waitaki\n")
    assert [tuple(r) for r in read_seed(spark, path, "dim_concatchment_node").collect()] == [("waitaki", "BEN2202")]


def test_file_year_filter(spark, tmp):
    for n in ("201801_Generation_MD.csv", "202402_Generation_MD.csv", "README.csv", "20261231_x.csv"):
        write(f"{tmp}/blobs/{n}", "a\n1\n")
    files = FS.list_files(spark, f"{tmp}/blobs", "*.csv")
    got = sorted(r["file_name"] for r in FS.select_files_by_year(files, 2018, 2024).collect())
    assert got == ["201801_Generation_MD.csv", "202402_Generation_MD.csv"]


def test_declared_table_is_idempotent(spark, tmp):
    create_table(spark, "wholesale_prices_decl", S.RAW_PRICES, f"{tmp}/decl")
    create_table(spark, "wholesale_prices_decl", S.RAW_PRICES, f"{tmp}/decl")
    assert [f.name for f in spark.table("wholesale_prices_decl").schema] == [f.name for f in S.RAW_PRICES]
    spark.sql("DROP TABLE wholesale_prices_decl")


def test_header_read_touches_only_first_line(spark, tmp):
    # a big file: the first-line reader must not need the fallback scan
    path = write(f"{tmp}/hdr/big.csv", "X,Y\n" + "1,2\n" * 200000)
    rows = (spark.createDataFrame([(f"file:{path}",)], "path string")
            .mapInPandas(FS.first_line_reader(), "path string, header string, error string").collect())
    assert rows[0]["header"] == "X,Y" and rows[0]["error"] is None
    gone = f"file:{tmp}/hdr/vanished.csv"   # listed, then gone before it was read
    assert FS.file_headers(spark, [f"file:{path}", gone]) == {("X", "Y"): [f"file:{path}"], FS.UNREADABLE: [gone]}


def test_every_record_is_loaded_or_rejected(spark, tmp):
    """NA tokens, short and long records, odd names, broken documents, overflow, columns of unlike types."""
    d = f"{tmp}/p"
    write(f"{d}/a.csv", "TradingDate,TradingPeriodNumber,PointOfConnectionCode,DollarsPerMegawattHour,LoadMegawatts\n"
          "2024-01-01,1,NA,5,1\n2024-01-01,2,BEN2202,5\n2024-01-01,3,BEN2202,5,1,9\n2024-01-01,4,BEN2202,n/a,1\n")
    typed, rejects = FS.read_prices(spark, FS.list_files(spark, d, "*.csv"))
    assert [(r["trading_period"], r["load_mw"]) for r in typed.collect()] == [(2, None)]
    assert sorted(r["reason"] for r in rejects.collect()) == ["malformed record", "no valid node", "no valid price"]

    write(f"{tmp}/r/a.csv", "n,m\n10,1.5\n")
    write(f"{tmp}/r/b.csv", "m,n\n2,x\n3,4,5\n")
    rows_, rejects = FS.read_retail(spark, f"{tmp}/r")
    assert dict(rows_.dtypes) == {"n": "string", "m": "double", "raw_filename": "string"}
    assert sorted((r["n"], r["m"]) for r in rows_.collect()) == [("10", 1.5), ("x", 2.0)]
    assert [r["record"] for r in rejects.collect()] == ["3,4,5"]

    daily = {"time": ["2024-01-01", "x", "2024-01-03"], "precipitation_sum": [1.0, 1.0, 99999.0]}
    write(f"{tmp}/w/lake_taupo_2024-01-01_2024-01-03.json", json.dumps({"daily": daily}))
    write(f"{tmp}/w/odd name.json", json.dumps({"daily": daily}))
    write(f"{tmp}/w/lake_ohau_2024-01-01_2024-01-03.json", "{broken")
    rows_, rejects = FS.read_weather_json(spark, f"{tmp}/w")
    assert [(r["location"], r["time"]) for r in rows_.collect()] == [("lake_taupo", dt.date(2024, 1, 1))]
    assert sorted(r["reason"] for r in rejects.collect()) == [
        "no location in the file name", "no valid time", "not a weather document", "precipitation_sum out of range"]


def test_two_documents_of_one_day_resolve_by_file_order(spark, tmp):
    for name, mm in (("2024-01-01_2024-01-01", 1.0), ("2024-01-01_2024-02-01", 2.0)):
        write(f"{tmp}/w/lake_taupo_{name}.json", json.dumps({"daily": {"time": ["2024-01-01"], "precipitation_sum": [mm]}}))
    w, _ = FS.read_weather_json(spark, f"{tmp}/w")
    load_upsert(spark, f"{tmp}/t", w, C.WEATHER_KEY, [FS.ORDER], S.RAW_WEATHER)
    assert [r["precipitation_sum"] for r in read_table(spark, f"{tmp}/t").collect()] == [Decimal("2.00")]


def test_slash_dates_either_way_round(spark):
    from voltmart.functions import to_date_lenient
    r = spark.sql("SELECT '3/4/2024' AS d").select(to_date_lenient("d"), to_date_lenient("d", day_first=False)).first()
    assert tuple(r) == (dt.date(2024, 4, 3), dt.date(2024, 3, 4))


def test_quoted_line_feeds_and_header_commas(spark, tmp):
    """Values equal to those of a plain CSV reader, whatever the file blocks; a file with an open quote is a reject."""
    import csv
    import io
    import random

    rng = random.Random(7)
    cells = ["x", "line one\nline two", 'say ""hi""', "a,b", "", '5" pipe', "\n\n", "end\n", "plain"]
    d = f"{tmp}/retail"
    want = []
    for number in range(2):
        out = io.StringIO()
        names = ["plan, name", "note", "n"] if number else ["note", "plan, name", "n"]
        w = csv.writer(out, lineterminator="\n")
        w.writerow(names)
        for i in range(300):
            row = {"plan, name": rng.choice(cells), "note": rng.choice(cells), "n": str(i)}
            w.writerow([row[n] for n in names])
            want.append((row["plan, name"] or None, row["note"] or None, i))
        write(f"{d}/f{number}.csv", out.getvalue())
    write(f"{d}/f2.csv", 'n,note\n7,5" pipe\n8,6" pipe\n')  # quotes inside unquoted cells are text
    want += [(None, '5" pipe', 7), (None, '6" pipe', 8)]
    write(f"{d}/f3.csv", 'n,note\n1,"never closed\n2,x\n')
    write(f"{d}/f4.csv", 'n,"open\n1,2\n')
    for size in ("134217728", "256", "64"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got, rejects = FS.read_retail(spark, d)
            assert rows(got, "plan, name", "note", "n") == sorted(want, key=repr)
            assert sorted(r["path"].rsplit("/", 1)[-1] for r in rejects.collect()) == ["f3.csv", "f4.csv"]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_quoted_line_feed_is_one_record(spark, tmp):
    write(f"{tmp}/r/a.csv", 'plan,note,n\n"x","line one\nline two",3\ny,z,4\n')
    write(f"{tmp}/r/b.csv", '"plan, name",n\np,1\n')
    got, rejects = FS.read_retail(spark, f"{tmp}/r")
    assert rows(got, "plan", "note", "plan, name", "n") == sorted([("x", "line one\nline two", None, 3), ("y", "z", None, 4), (None, None, "p", 1)], key=repr)
    assert not rejects.collect()


def weather_rows(spark, days, value):
    from voltmart.schemas import RAW_WEATHER
    measures = [f.name for f in RAW_WEATHER.fields if f.name not in ("location", "time", "inserted_at")]
    data = [("lake", d, *[Decimal(value)] * len(measures)) for d in days]
    return spark.createDataFrame(data, "location string, time date, " + ", ".join(f"{m} decimal(6,2)" for m in measures)).select(
        "location", "time", *[F.col(m).cast(RAW_WEATHER[m].dataType).alias(m) for m in measures])


def test_upsert_writes_only_the_months_it_touches(spark, tmp):
    from voltmart.schemas import RAW_WEATHER
    from voltmart.sinks import month_folders, superseded
    base = f"{tmp}/weather"
    jan, feb, mar = (dt.date(2024, m, 5) for m in (1, 2, 3))
    load = lambda rows: load_upsert(spark, base, rows, C.WEATHER_KEY, [], RAW_WEATHER, month_of="time")
    load(weather_rows(spark, [jan, feb, mar, mar + dt.timedelta(1)], "1"))
    load(weather_rows(spark, [mar, dt.date(2024, 4, 1)], "2"))
    assert {n for n in os.listdir(f"{base}/load=2") if n.startswith("load_month")} == {"load_month=202403", "load_month=202404"}
    assert {m: p[-24:-18] for m, p in month_folders(spark, base).items()} == {202401: "load=1", 202402: "load=1", 202403: "load=2", 202404: "load=2"}
    got = lambda: rows(read_table(spark, base), "time", "precipitation_sum")
    want = sorted([(jan, Decimal("1.00")), (feb, Decimal("1.00")), (mar, Decimal("2.00")), (mar + dt.timedelta(1), Decimal("1.00")),
                   (dt.date(2024, 4, 1), Decimal("2.00"))], key=repr)
    assert got() == want
    assert superseded(spark, base) == [f"{base}/load=1/load_month=202403"]
    # a load that crashed before its marker counts for nothing, whatever it left
    os.makedirs(f"{base}/load=3/load_month=202401")
    with open(f"{base}/load=3/load_month=202401/part-0.parquet", "w") as f:
        f.write("half a file")
    assert got() == want
    load(weather_rows(spark, [jan], "3"))
    assert os.path.isdir(f"{base}/load=4") and (jan, Decimal("3.00")) in got()
    assert {f.rsplit("/", 2)[-2] for f in read_table(spark, base, months=[202404]).inputFiles()} == {"load_month=202404"}


def test_upsert_by_month_needs_the_date_in_the_key(spark, tmp):
    import pytest
    from voltmart.schemas import RAW_WEATHER
    with pytest.raises(ValueError):
        load_upsert(spark, f"{tmp}/w", weather_rows(spark, [dt.date(2024, 1, 1)], "1"), ["location"], [], RAW_WEATHER, month_of="time")


def test_rows_in_are_rows_loaded_and_conflicts(spark, tmp):
    from voltmart.sinks import read_conflicts
    day = dt.date(2024, 1, 1)
    schema = "trading_date date, trading_period smallint, node string, price decimal(18,6), load_mw decimal(18,6), generation_mw decimal(18,6), seq int"
    rows_in = lambda keys: spark.createDataFrame([(day, p, n, Decimal(i), None, None, i) for i, (p, n) in enumerate(keys)], schema)
    base, total = f"{tmp}/prices", 0
    for number, (keys, lost) in enumerate([
            ([(1, "A"), (1, "A"), (2, "A"), (3, None), (3, None)], [(1, "A", 1, False)]),
            ([(1, "A"), (1, "A"), (4, "A"), (4, "A"), (4, "A"), (3, None)], [(1, "A", 2, True), (4, "A", 2, False)])], 1):
        load_insert_ignore(spark, base, rows_in(keys), C.PRICE_KEY, ["seq"], S.RAW_PRICES, month_of="trading_date", conflicts=True)
        ledger = read_conflicts(spark, base, number)
        assert rows(ledger, "trading_period", "node", "n_lost", "to_stored") == lost
        before, total = total, read_table(spark, base).count()
        assert len(keys) == total - before + sum(r["n_lost"] for r in ledger.collect())


def test_wide_files_are_read_by_compiled_code(spark, tmp):
    """Missing cells, junk, both date layouts and records without a date, by scans whose generated methods the JVM compiles."""
    periods = ",".join(f"TP{i}" for i in range(1, 51))
    head = f"Site_Code,POC_Code,Nwk_Code,Gen_Code,Fuel_Code,Tech_Code,Trading_Date,{periods}\n"
    cells = lambda first, last: ",".join([first, *[""] * 48, last])
    write(f"{tmp}/w/202401_Generation_MD.csv", head + f"S1,P1,N1,G1,NA,T,2024-01-15,{cells('1.5', 'NA')}\n" + f"S1,P2,N1,G1,Wind,T,junk,{cells('n/a', '3')}\n")
    write(f"{tmp}/w/202403_Generation_MD.csv", head + f"S1,P1,N1,G1,Wind,T,03/25/2024,{cells('2', 'x')}\n" + f"S1,P1,N1,G1,Wind,T,03/04/2024,{cells('null', '4')}\n")
    long, rejects = FS.read_generation(spark, FS.list_files(spark, f"{tmp}/w", C.GENERATION_FILE_GLOB))
    assert rows(long, "fuel_code", "trading_date", "trading_period", "output_kw") == sorted([
        (None, dt.date(2024, 1, 15), 1, Decimal("1.500000")), ("Wind", dt.date(2024, 3, 25), 1, Decimal("2.000000")),
        ("Wind", dt.date(2024, 3, 4), 50, Decimal("4.000000"))], key=repr)
    found = {(r["reason"], r["record"]) for r in rejects.collect()}
    assert found == {("not a number", "tp50=x"),
                     ("no trading_date", '{"site_code":"S1","poc_code":"P2","nwk_code":"N1","gen_code":"G1","fuel_code":"Wind","tech_code":"T","trading_date":"junk","tp50":"3"}')}
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = spark._jvm.PythonSQLUtils.explainString(long.select("*")._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) <= 8000


def test_layouts_are_looked_for_only_where_a_year_stands_last(spark, tmp, monkeypatch):
    asked = []
    plain = FS.date_layouts
    monkeypatch.setattr(FS, "date_layouts", lambda df, column: asked.append(column) or plain(df, column))
    head = "Site_Code,POC_Code,Nwk_Code,Gen_Code,Fuel_Code,Tech_Code,Trading_Date,TP1\n"
    for name, date, want, scans in (("a", "2024-03-04", dt.date(2024, 3, 4), 0), ("b", '" 3/25/2024 10:00"', dt.date(2024, 3, 25), 1)):
        write(f"{tmp}/{name}/202401_Generation_MD.csv", head + f"S1,P1,N1,G1,Wind,T,{date},12.5\n")
        asked.clear()
        long, _ = FS.read_generation(spark, FS.list_files(spark, f"{tmp}/{name}"))
        assert (rows(long, "trading_date"), len(asked)) == ([(want,)], scans)
