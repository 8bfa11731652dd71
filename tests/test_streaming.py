import datetime as dt
import os
from decimal import Decimal

from voltmart.sinks import read_table
from voltmart.streaming.incremental import start_price_ingest

HEADER = "TradingDate,TradingPeriodNumber,PointOfConnectionCode,DollarsPerMegawattHour,LoadMegawatts,GenerationMegawatts\n"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_incremental_ingest_first_wins_across_runs(spark, tmp):
    src, base, ckpt = f"{tmp}/incoming", f"{tmp}/tables/prices", f"{tmp}/ckpt"
    write(f"{src}/20240101.csv", HEADER + "2024-01-01,1,BEN2202,100,1,1\n2024-01-01,1,BEN2202,200,1,1\n")
    q = start_price_ingest(spark, src, base, ckpt)
    q.awaitTermination(120)
    t = read_table(spark, base)
    assert [(r["trading_period"], r["price"]) for r in t.collect()] == [(1, Decimal("100.000000"))]

    # a later file, columns reordered and one required column missing in a third file: the repeated key is
    # ignored, the new key added by name (not position), the bad file rejected; the first file is not re-read
    write(f"{src}/20240102.csv", "PointOfConnectionCode,DollarsPerMegawattHour,TradingDate,TradingPeriodNumber,LoadMegawatts\n"
          "BEN2202,999,2024-01-01,1,1\nMAN2201,600,2024-01-02,5,2\n")
    write(f"{src}/20240103.csv", "TradingDate,PointOfConnectionCode\n2024-01-03,X\n")
    q = start_price_ingest(spark, src, base, ckpt, rejects_path=f"{tmp}/rejects")
    q.awaitTermination(120)
    got = sorted((r["trading_date"], r["trading_period"], r["price"], r["generation_mw"])
                 for r in read_table(spark, base).collect())
    assert got == [(dt.date(2024, 1, 1), 1, Decimal("100.000000"), Decimal("1.000000")),
                   (dt.date(2024, 1, 2), 5, Decimal("600.000000"), None)]
    rejected = [r["path"].rsplit("/", 1)[-1] for r in spark.read.parquet(f"{tmp}/rejects").collect()]
    assert rejected == ["20240103.csv"]
