from conftest import SF_SMALL

from voltmart.plans import queries as Q
from voltmart.plans.build import MARTS, build_all


def test_build_all_marts_matches_lazy_models(spark, tmp):
    p = Q.pipeline(spark, SF_SMALL)
    paths = build_all(p, f"{tmp}/warehouse")
    assert set(MARTS) <= set(paths)
    lazy = Q.pipeline(spark, SF_SMALL)
    for name in ("mart_price_risk_daily", "mart_catchment_weather_pricing_daily", "mart_daily_demand"):
        stored = spark.read.parquet(paths[name])
        fresh = lazy.ref(name)
        assert stored.columns == fresh.columns
        assert stored.exceptAll(fresh).count() == 0 and fresh.exceptAll(stored).count() == 0, name
    assert spark.read.parquet(paths["dim_date"]).count() == 3287
