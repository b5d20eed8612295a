"""Sparse trend changes, simulated bands, rolling origins, as-of join, and landing faults."""

import datetime as dt
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratus.operators import backtest as BT
from stratus.operators import changepoints as CP
from stratus.operators import forecast as FC
from stratus.operators.joins import asof_join
from stratus.sources.payload import explode_payload, invalid_payloads, read_landed
from stratus.streaming.ingest import replace_batch
from test_warehouse import documents

START = dt.date(1999, 1, 1)


def long_of(spark, series):
    rows = [(c, m, START + dt.timedelta(days=int(d)), float(v)) for (c, m), points in series.items() for d, v in points]
    return spark.createDataFrame(rows, "city_id long, metric string, ds date, y double")


def test_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((80, 6))
    y = x @ np.array([2., 0, 0, -1, 0, .05])[:, None] + .1 * rng.standard_normal((80, 1))
    gram, sparse = x.T @ x, np.array([0, 1, 1, 1, 1, 1], bool)
    b = CP.solve_sparse(gram, x.T @ y, sparse, 5.0, 200)
    slope = x.T @ y - gram @ b   # optimal: 0 without a penalty, lasso * sign(b) with one, within lasso at zero
    assert abs(slope[0, 0]) < 1e-8
    for j in range(1, 6):
        assert abs(slope[j, 0] - 5 * np.sign(b[j, 0])) < 1e-6 if b[j, 0] else abs(slope[j, 0]) <= 5 + 1e-6
    assert (b[[1, 2, 4], 0] == 0).all() and b[0, 0] > 1


def test_the_sweeps_suffice():
    days = np.arange(730.0)
    y = np.stack([np.sin(days / 58) + (days > 350) * (days - 350) / 80, days % 13], axis=1)
    one, two = (CP.fit_sparse(days, y, np.arange(730.0, 737), sweeps=n) for n in (CP.SWEEPS, 5000))
    assert np.abs(one["yhat"] - two["yhat"]).max() < .1 * y.std()


def test_few_hinges_stay_active_and_the_trend_change_is_followed(spark):
    days = np.arange(600)
    bent = 10 + .01 * days + np.where(days > 300, .1 * (days - 300), 0)
    flat = np.full(600, 7.0)
    run = START + dt.timedelta(days=600)
    out = CP.forecast_sparse(long_of(spark, {(1, "temp_avg"): zip(days, bent), (1, "temp_max"): zip(days, flat),
                                             (2, "temp_avg"): zip(days[:40], bent[:40])}), run.isoformat()).collect()
    rows = {(r.city_id, r.metric, r.horizon_days): r for r in out}
    assert {r.city_id for r in out} == {1}                      # 40 points are too few
    assert rows[1, "temp_max", 7].n_active == 0 and abs(rows[1, "temp_max", 7].yhat - 7) < 1e-6
    bend = rows[1, "temp_avg", 7]
    assert 0 < bend.n_active < 25 and abs(bend.yhat - (10 + .01 * 606 + .1 * 306)) < 4   # shrunk by the priors


def test_null_patterns_share_a_design_and_infinite_values_fail(spark):
    days = np.arange(200)
    y = 5 + np.sin(days)
    holes = [(d, v) for d, v in zip(days, y) if d % 7]
    out = CP.forecast_sparse(long_of(spark, {
        (1, "temp_avg"): zip(days, y), (1, "temp_min"): holes, (1, "temp_max"): zip(days, np.where(days == 9, np.inf, y))}),
        (START + dt.timedelta(days=200)).isoformat())
    assert {(r.metric, r.status) for r in out.collect()} == {("temp_avg", "ok"), ("temp_min", "ok"), ("temp_max", "failed")}
    alone = CP.forecast_sparse(long_of(spark, {(1, "temp_min"): holes}), (START + dt.timedelta(days=200)).isoformat())
    both = {r.horizon_days: r.yhat for r in out.where("metric = 'temp_min'").collect()}
    assert all(abs(r.yhat - both[r.horizon_days]) < 1e-9 for r in alone.collect())


def test_the_simulated_band_widens_and_reruns_agree(spark):
    rows = [(1, "temp_avg", START + dt.timedelta(days=h), h, 10.0, 1.0, 3, 400.0, 100.0, "ok") for h in range(1, 8)]
    rows += [(1, "precipitation_sum", START, 1, 0.2, 1.0, 0, 0.0, 100.0, "ok"), (2, "temp_avg", START, 1, 1.0, None, 0, 0.0, 1.0, "failed"),
             (3, "temp_avg", START, 7, 0.0, 1.0, 0, 0.0, 100.0, "ok")]
    fitted = spark.createDataFrame(rows, "city_id long, metric string, target_date date, horizon_days short, yhat double, "
                                         "sigma double, n_active int, change_scale double, span double, status string")
    flat = [CP.simulated_band(f, samples=400).collect() for f in (fitted, fitted.repartition(5))]
    assert sorted(flat[0]) == sorted(flat[1]) and len(flat[0]) == 9
    one = {(r.metric, r.horizon_days): r for r in flat[0] if r.city_id == 1}
    width = [one["temp_avg", h].sim_upper - one["temp_avg", h].sim_lower for h in range(1, 8)]
    assert width[6] > 1.5 * width[0]                             # trend changes add up
    still = next(r for r in flat[0] if r.city_id == 3)           # no changes: the noise alone
    assert abs(still.sim_upper - still.sim_lower - 2 * 1.2816) < .5
    assert one["precipitation_sum", 1].sim_lower == 0


def test_backtest_equals_a_fit_per_origin(spark):
    rng = np.random.default_rng(5)
    series = {(c, m): [(d, 3 + .02 * d + rng.normal()) for d in range(260) if rng.random() < .9 or m == "temp_min"]
              for c in (1, 2) for m in ("temp_avg", "temp_min")}
    series[3, "temp_avg"] = [(d, 1.0) for d in range(30)]        # too short for any run
    long = long_of(spark, series)
    first, last = (START + dt.timedelta(days=d) for d in (150, 248))
    fits = {(r.city_id, r.metric, r.origin): r for r in
            BT.rolling_fits(long, BT.weekly_origins(first, last), last, days=100).collect()}
    origins = [first + dt.timedelta(days=7 * k) for k in range(15)]
    assert len(fits) == 4 * 15
    for (c, m), points in series.items():
        for o in origins if c < 3 else []:
            t = (o - START).days
            x, y = np.array([(d - (last - START).days, v) for d, v in points if t - 100 <= d < t]).T
            b, a = np.polyfit(x, y, 1)
            r = fits[c, m, o]
            assert r.n == len(x) and abs(r.b - b) < 1e-8 and abs(r.a - a) < 1e-6
            assert abs(r.sigma - math.sqrt(((y - a - b * x) ** 2).sum() / (len(x) - 2))) < 1e-7
    scores = BT.backtest(long, first, last, days=100).collect()
    assert {r.horizon_days for r in scores} == set(range(1, 8)) and all(r.n_origins == 15 for r in scores if r.metric == "temp_min")


def test_the_backtest_plan_has_no_join_and_no_fit_per_origin(spark):
    long = long_of(spark, {(1, "temp_avg"): [(d, d) for d in range(100)]})
    plan = BT.backtest(long, "1999-03-01", "1999-04-01", days=60)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "regr_" not in plan and plan.count("Window [") == 2


def test_asof_join(spark):
    left = spark.createDataFrame([("a", 5, 1), ("a", 1, 2), ("a", 7, 3), ("b", 5, 4), (None, 3, 5)], "k string, t int, l int")
    right = spark.createDataFrame([("a", 1, 10), ("a", 5, 11), ("a", 6, None), (None, 2, 12)], "k string, at int, r int")
    got = {r.l: (r["at"], r.r) for r in asof_join(left, right, ["k"], "t", "at").collect()}
    assert got == {1: (5, 11), 2: (1, 10), 3: (6, None), 4: (None, None), 5: (2, 12)}
    strict = {r.l: r["at"] for r in asof_join(left, right, ["k"], "t", "at", allow_equal=False).collect()}
    assert strict == {1: 1, 2: None, 3: 6, 4: None, 5: 2}


def test_points_of_one_day_give_no_line_and_infinite_values_fail(spark):
    day = long_of(spark, {(1, "temp_avg"): [(0, v) for v in range(60)], (2, "temp_avg"): [(d, d) for d in range(60)]})
    assert {r.city_id for r in FC.forecast_linear(day, "1999-03-02").collect()} == {2}
    assert FC.forecast_linear(day, "1999-03-02", min_points=1).count() > 0
    odd = long_of(spark, {(1, "temp_avg"): [(d, math.inf if d == 3 else d) for d in range(80)]})
    rows = FC.forecast_seasonal(odd, "1999-03-22").collect()
    assert {r.status for r in rows} == {"failed"} and all(r.yhat is None or math.isnan(r.yhat) for r in rows)


@pytest.mark.parametrize("name", [None, "", "  "])
def test_nameless_documents_are_logged(spark, tmp_path, name):
    good, bad, _ = documents(2)
    bad["name"] = name
    path = tmp_path / "landed"
    path.mkdir()
    (path / "a.json").write_text(json.dumps(good) + "\n" + json.dumps(bad) + "\n")
    docs = read_landed(spark, str(path))
    assert [r.error for r in invalid_payloads(docs).collect()] == ["no place name"]
    assert {r.location_name for r in explode_payload(docs).collect()} == {good["name"]}


def test_replays_of_rows_without_a_place_do_not_double(spark, tmp_table):
    rows = spark.createDataFrame([(n, dt.datetime(2024, 1, 1, h), 1.0) for n in ("x", None) for h in range(3)],
                                 "location_name string, measured_at timestamp_ntz, temperature_2m double")
    for _ in range(2):
        replace_batch(spark, rows, tmp_table)
    assert spark.read.parquet(tmp_table).count() == 6


def test_an_hour_given_twice_gives_two_rows(spark, tmp_path):
    doc = documents(1)[0]
    doc["hourly"]["time"][1] = doc["hourly"]["time"][0]
    (tmp_path / "a.json").write_text(json.dumps(doc) + "\n")
    rows = explode_payload(read_landed(spark, str(tmp_path / "a.json")))
    assert rows.count() == len(doc["hourly"]["time"])
    assert rows.groupBy("measured_at").agg(F.count("*").alias("n")).where("n = 2").count() == 1
