import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratus.operators import forecast as FC

D = dt.date
RUN = "2024-03-01"


def series(spark, n, end_lag=1, metric_values=None, city=1):
    last = D(2024, 3, 1) - dt.timedelta(days=end_lag)
    rows = []
    for i in range(n):
        d = last - dt.timedelta(days=n - 1 - i)
        vals = metric_values(i) if metric_values else {"temp_avg": 10.0 + 0.1 * i}
        rows.append((city, d, vals.get("temp_avg"), vals.get("precipitation_sum")))
    return spark.createDataFrame(rows, "city_id long, date date, temp_avg double, precipitation_sum double")


def long_of(df):
    return FC.melt_metrics(df, ["temp_avg", "precipitation_sum"])


def test_min_points_59_vs_60(spark):
    assert FC.forecast_linear(long_of(series(spark, 59)), RUN).count() == 0
    out = FC.forecast_linear(long_of(series(spark, 60)), RUN).orderBy("horizon_days").collect()
    assert [r.horizon_days for r in out] == list(range(1, 8))
    # exact line: y = 10 + 0.1 i, i = 59 on run - 1, so run + h has i = 60 + h
    assert out[0].yhat == pytest.approx(10.0 + 0.1 * 61)
    assert out[0].yhat_lower == pytest.approx(out[0].yhat)     # zero residuals → zero width


def test_anchor_last_obs_rows_by_lag(spark):
    for lag, expect in ((1, 6), (3, 4), (8, 0)):
        out = FC.forecast_linear(long_of(series(spark, 90, end_lag=lag)), RUN, anchor="last_obs")
        assert out.count() == expect


def test_clamp_and_all_null_metric(spark):
    vals = lambda i: {"temp_avg": None, "precipitation_sum": 5.0 - 0.2 * i}   # noqa: E731 — falls below 0
    long = long_of(series(spark, 70, metric_values=vals))
    wide = FC.pivot_forecast(FC.forecast_linear(long, RUN), RUN).collect()
    assert len(wide) == 7
    assert all(r.temp_avg is None for r in wide)                          # missing metric stays NULL
    assert all(r.precipitation_sum == 0.0 and r.precipitation_sum_lower == 0.0 for r in wide)


def test_constant_series_and_seasonal(spark):
    vals = lambda i: {"temp_avg": 7.0, "precipitation_sum": 2.0 + math.sin(2 * math.pi * i / 365.25)}
    long = long_of(series(spark, 400, metric_values=vals))
    fitted = FC.forecast_seasonal(long, RUN)
    rows = fitted.collect()
    assert {r.status for r in rows} == {"ok"} and len(rows) == 14
    t = [r for r in rows if r.metric == "temp_avg"]
    assert all(abs(r.yhat - 7.0) < 1e-6 for r in t)
    assert FC.forecast_seasonal(long_of(series(spark, 10)), RUN).count() == 0    # too short: no rows
    skips = FC.forecast_skips(long_of(series(spark, 10)))
    assert [r.city_id for r in skips.collect()] == [1]


def test_fit_predict_recovers_trend_and_season():
    ds = np.arange(0, 730, dtype=float)
    y = 5 + 0.01 * ds + 3 * np.sin(2 * np.pi * ds / 365.25)
    yhat, lo, hi = FC.fit_predict(ds, y, np.array([730.0, 731.0]))
    truth = 5 + 0.01 * np.array([730, 731]) + 3 * np.sin(2 * np.pi * np.array([730, 731]) / 365.25)
    assert np.allclose(yhat, truth, atol=0.1)
    assert np.all(lo <= yhat) and np.all(hi >= yhat)


def test_forecast_accuracy(spark):
    fc = spark.createDataFrame([(1, "temp_avg", D(2024, 3, 2), 1, 10.0, 9.0, 11.0)],
                               "city_id long, metric string, target_date date, horizon_days int, yhat double, "
                               "yhat_lower double, yhat_upper double")
    actual = spark.createDataFrame([(1, D(2024, 3, 2), "temp_avg", 12.0)], "city_id long, ds date, metric string, y double")
    r = FC.forecast_accuracy(fc, actual).first()
    assert (r.n, r.mae, r.bias, r.rmse, r.coverage) == (1, 2.0, -2.0, 2.0, 0.0)


def test_stream_ingest_replay_and_late_data(spark, tmp_path):
    from stratus.streaming import ingest_available, land
    ev = spark.createDataFrame([("A", dt.datetime(2024, 1, 1, h), float(h)) for h in range(3)],
                               "location_name string, measured_at timestamp_ntz, v double")
    src, tgt, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    land(ev, src)
    ingest_available(spark, src, ev.schema, tgt, ck, lambda b: b)
    ingest_available(spark, src, ev.schema, tgt, ck, lambda b: b)       # nothing new: no change
    assert spark.read.parquet(tgt).count() == 3
    late = spark.createDataFrame([("A", dt.datetime(2024, 1, 1, 5), 9.0)], ev.schema)
    land(late, src)                                                     # corrected day arrives later
    ingest_available(spark, src, ev.schema, tgt, ck, lambda b: b)
    assert [r.v for r in spark.read.parquet(tgt).collect()] == [9.0]   # the slice is replaced


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    from stratus.plans.catalog import QUERIES
    assert set(QUERIES) <= set(q)
    assert set(QUERIES) <= set(o)


def test_stream_ingest_of_landed_payload_documents(spark, tmp_path):
    import json
    from stratus.sources.payload import explode_payload, payload_schema
    from stratus.streaming import ingest_available
    names = ["temperature_2m", "weather_code"]
    src, tgt, ck = str(tmp_path / "landed"), str(tmp_path / "stage"), str(tmp_path / "ck")

    def land_doc(name, day, temps, sub):
        hourly = {"time": [f"2024-01-{day:02d}T{h:02d}:00" for h in range(len(temps))],
                  "temperature_2m": temps, "weather_code": ["1"] * len(temps)}
        doc = {"name": name, "latitude": 1.0, "longitude": 2.0, "elevation": 3.0, "timezone": "UTC", "hourly": hourly}
        spark.createDataFrame([(json.dumps(doc),)], "v string").write.text(f"{src}/{sub}")

    land_doc("A", 1, [1.0] * 24, "b1")
    land_doc("B", 1, [2.0] * 24, "b2")
    run = lambda: ingest_available(spark, f"{src}/*", payload_schema(names), tgt, ck,
                                   lambda b: explode_payload(b, names=names, now="2024-01-02 00:00:00"))
    run()
    assert spark.read.parquet(tgt).count() == 48
    land_doc("A", 1, [5.0] * 23, "b3")            # corrected reload of A's day: 23 hours
    run()
    t = spark.read.parquet(tgt)
    assert t.count() == 47
    assert {r.location_name: r.m for r in t.groupBy("location_name").agg(F.max("temperature_2m").alias("m")).collect()} \
        == {"A": 5.0, "B": 2.0}


def test_seasonal_code_ships_by_value(spark):
    from pyspark import cloudpickle
    FC._pickle_by_value()
    assert "stratus" in cloudpickle.list_registry_pickle_by_value()
