import datetime as dt
import json
import math

from pyspark.sql import functions as F

from stratus.functions.constants import HOURLY_VARS
from stratus.plans.warehouse import check_tables, daily_run
from stratus.sources.config import load_cities

CITIES = [{"name": "Lisbon", "country": "Portugal", "region": "Western Europe", "active": True,
           "climate_zone": "Csa", "is_capital": True},
          {"name": "Porto", "country": "Portugal", "region": "Southern Europe", "active": True,
           "climate_zone": "Csb", "is_capital": False}]


def documents(days, first=dt.date(2024, 1, 1)):
    docs = []
    for ci, name in enumerate(["Lisbon", "Porto", "Atlantis"]):       # Atlantis is not configured
        hours = [dt.datetime.combine(first, dt.time()) + dt.timedelta(hours=h) for h in range(24 * days)]
        hourly = {"time": [h.strftime("%Y-%m-%dT%H:%M") for h in hours]}
        for v in HOURLY_VARS:
            if v == "weather_code":
                hourly[v] = [str((i // 5) % 4) for i in range(len(hours))]
            elif v == "is_day":
                hourly[v] = [1 if 6 <= h.hour < 18 else 0 for h in hours]
            else:
                hourly[v] = [round(10 + ci + 5 * math.sin(i / 24 / 58 * 2 * math.pi) + (h.hour % 7) * 0.1, 3)
                             for i, h in enumerate(hours)]
        docs.append({"name": name, "latitude": 38.7 + ci, "longitude": -9.1, "elevation": 5.0 + ci,
                     "timezone": "Europe/Lisbon", "hourly": hourly})
    return docs


def test_daily_run_end_to_end_and_idempotent(spark, tmp_path):
    landed = str(tmp_path / "landed")
    spark.createDataFrame([(json.dumps(d),) for d in documents(70)], "v string").write.text(landed)
    cfg = load_cities(spark, CITIES)
    root = str(tmp_path / "wh")
    kw = dict(today="2024-03-11", start="2024-01-01", end="2024-03-10", model="linear")
    r1 = daily_run(spark, root, landed, cfg, **kw)
    assert r1["stage_rows"] == 3 * 70 * 24
    fact = spark.read.parquet(f"{root}/fact_daily")
    # a place missing from the config still enters the place dimension (NULL attributes)
    assert fact.count() == 3 * 70
    assert spark.read.parquet(f"{root}/mart_daily").count() == 3 * 70
    assert spark.read.parquet(f"{root}/fact_hourly").count() == 3 * 70 * 24
    assert r1["forecast_rows"] == 3 * 7
    assert r1["core_months_repaired"] == 0 and r1["mart_months_repaired"] == 0
    atl = spark.read.parquet(f"{root}/dim_cities").where("city_name = 'Atlantis'").first()
    assert atl.country_id is None and atl.climate_zone is None
    ids1 = {r.city_name: r.id for r in spark.read.parquet(f"{root}/dim_cities").collect()}

    r2 = daily_run(spark, root, landed, cfg, **kw)                  # same run again
    assert r2["forecast_rows"] == 0                                # insert-only history: no duplicates
    assert spark.read.parquet(f"{root}/fact_daily").count() == 3 * 70
    assert spark.read.parquet(f"{root}/stage").count() == 3 * 70 * 24
    assert {r.city_name: r.id for r in spark.read.parquet(f"{root}/dim_cities").collect()} == ids1
    countries = {r.country_name: r.region for r in spark.read.parquet(f"{root}/dim_countries").collect()}
    assert countries == {"Portugal": "Western Europe"}
    log = spark.read.parquet(f"{root}/load_log")
    assert log.where("layer = 'core'").select("city_name").distinct().count() == 3

    # a hole in the daily fact (e.g. a failed run) is found and refilled by the next run
    fact = spark.read.parquet(f"{root}/fact_daily")
    holed = fact.where("NOT (date_id = 20240205 AND city_id = 1)").checkpoint(eager=True)
    holed.write.mode("overwrite").partitionBy("ym").parquet(f"{root}/fact_daily")
    r3 = daily_run(spark, root, landed, cfg, today="2024-03-11", model="linear")   # default window: yesterday
    assert r3["core_months_repaired"] == 1
    assert spark.read.parquet(f"{root}/fact_daily").count() == 3 * 70
    # declared constraints hold on every produced table
    report = {r.check_name: r.violations for r in check_tables(spark, root).collect()}
    assert len(report) == 12 and set(report.values()) == {0}
