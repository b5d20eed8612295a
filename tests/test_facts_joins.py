import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from stratus.operators import facts, joins
from stratus.sources.generators import wind_bands

STAGE_SCHEMA = ("location_name string, measured_at timestamp_ntz, temperature_2m double, "
                "apparent_temperature double, wet_bulb_temperature_2m double, precipitation double, rain double, "
                "snowfall double, sunshine_duration double, shortwave_radiation double, wind_speed_10m double, "
                "wind_gusts_10m double, cloud_cover double, relative_humidity_2m double, pressure_msl double, "
                "weather_code smallint, wind_direction_10m double, wind_direction_100m double")


def row(loc, day, hour, temp=10.0, precip=0.0, snow=0.0, code=1, wind=None):
    ts = dt.datetime(2024, 1, day, hour)
    return (loc, ts, temp, temp, temp, precip, precip, snow, 3600.0, 1.0, 5.0, 7.0, 50.0, 80.0, 1000.0, code,
            wind, wind)


@pytest.fixture()
def cities(spark):
    return spark.createDataFrame([(1, "A"), (2, "B")], "id long, city_name string")


def _by_key(df):
    return {(r.date_id, r.city_id): r for r in df.collect()}


@pytest.mark.parametrize("via", ["mode", "packed"])
def test_daily_rollup_edges(spark, cities, via):
    rows = [
        # day 1, A: code tie 3,3,2,2 → smallest (2); temp_min exactly 0 → not frost; temp_max 30 → hot
        row("A", 1, 0, temp=0.0, code=3), row("A", 1, 1, temp=30.0, code=3),
        row("A", 1, 2, code=2), row("A", 1, 3, code=2),
        # day 2, A: all temperatures NULL → NULL flags; all codes NULL → NULL dominant
        row("A", 2, 0, temp=None, code=None), row("A", 2, 1, temp=None, code=None),
        # day 3, A: precipitation 0.999 → rounds to 1.0 but not rainy; day 4 exactly 1 → rainy
        row("A", 3, 0, precip=0.5), row("A", 3, 1, precip=0.499),
        row("A", 4, 0, precip=0.5), row("A", 4, 1, precip=0.5),
        # unknown location: dropped by the inner join
        row("Z", 1, 0),
        # 25-row fall-back day for B: duplicate hour kept
        *[row("B", 5, h % 24, temp=-1.0, snow=0.1) for h in range(25)],
    ]
    st = spark.createDataFrame(rows, STAGE_SCHEMA)
    out = _by_key(facts.daily_rollup(st, cities, dominant_via=via))
    assert len(out) == 5
    a1 = out[(20240101, 1)]
    assert a1.dominant_weather_code_id == 2 and a1.is_frost_day is False and a1.is_hot_day is True
    a2 = out[(20240102, 1)]
    assert a2.dominant_weather_code_id is None and a2.is_frost_day is None and a2.is_hot_day is None
    a3, a4 = out[(20240103, 1)], out[(20240104, 1)]
    assert a3.precipitation_sum == 1.0 and a3.is_rainy_day is False
    assert a4.precipitation_sum == 1.0 and a4.is_rainy_day is True
    b5 = out[(20240105, 2)]
    assert b5.sunshine_duration_hours == 25.0 and b5.is_frost_day is True and b5.is_snowy_day is True
    assert b5.snowfall_sum == 2.5


def test_daily_rollup_window_prunes(spark, cities):
    st = spark.createDataFrame([row("A", d, 0) for d in (1, 2, 3)], STAGE_SCHEMA)
    out = facts.daily_rollup(st, cities, "2024-01-02", "2024-01-02")
    assert [r.date_id for r in out.collect()] == [20240102]


WIND = [0.0, 11.0, 11.5, 12.0, 33.7, 348.9, 360.0, 360.5, 361.0, -0.5, None, float("nan")]


def test_band_lookup_equals_between_join(spark):
    df = spark.createDataFrame([(i, w) for i, w in enumerate(WIND)], "i int, deg double")
    a = {r.i: r.b for r in joins.band_join(df, "deg", wind_bands(spark), "b").collect()}
    b = {r.i: r.b for r in joins.band_lookup(df, "deg", wind_bands(spark), "b").collect()}
    assert a == b
    assert a[0] == 1 and a[1] == 1 and a[2] is None and a[3] == 2 and a[5] == 16 and a[6] == 16
    assert a[7] is None and a[8] is None and a[9] is None and a[10] is None


def test_band_lookup_is_hash_join(spark):
    df = spark.createDataFrame([(1, 5.0)], "i int, deg double")
    plan = joins.band_lookup(df, "deg", wind_bands(spark), "b")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


def test_compass16_wraps(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, 11.24, 11.25, 348.75, 359.9, 360.0, 370.0]], "d double")
    assert [r[0] for r in df.select(joins.compass16("d")).collect()] == [1, 1, 2, 1, 1, 1, 1]


def test_hourly_fact_keeps_rows_and_keys(spark, cities):
    st = spark.createDataFrame([row("A", 1, 13, wind=11.5), row("A", 1, 14, wind=12.0), row("Z", 1, 0)],
                               STAGE_SCHEMA)
    out = facts.hourly_fact(st, cities, wind_bands(spark)).orderBy("time_id").collect()
    assert [(r.date_id, r.time_id, r.city_id) for r in out] == [(20240101, 1300, 1), (20240101, 1400, 1)]
    assert out[0].wind_dir_10m_id is None and out[1].wind_dir_10m_id == 2


def test_fully_present(spark):
    chunks = spark.createDataFrame([("A", dt.date(2024, 1, 1), dt.date(2024, 1, 3)),
                                    ("A", dt.date(2024, 2, 1), dt.date(2024, 2, 2))],
                                   "k string, start date, end date")
    done = spark.createDataFrame([("A", dt.date(2024, 1, d)) for d in (1, 2, 3)] + [("A", dt.date(2024, 2, 1))],
                                 "kk string, d date")
    out = joins.fully_present(chunks, done, "k", "start", "end", "kk", "d").collect()
    assert [(r.k, r.start) for r in out] == [("A", dt.date(2024, 1, 1))]
