import datetime as dt

from pyspark.sql import functions as F

from stratus.operators import control, dims, joins, writes
from stratus.sources.generators import date_series, explode_days
from stratus.sources.scans import history_from_fact, successes

D = dt.date


def test_explode_days_and_log_days(spark):
    chunks = spark.createDataFrame([("A", D(2024, 1, 30), D(2024, 2, 2), "success", 24, None),
                                    ("B", D(2024, 1, 5), D(2024, 1, 4), "failed", None, "boom")],
                                   "city_name string, start date, end date, status string, rows_per_day int, "
                                   "error_msg string")
    assert explode_days(chunks, "start", "end").count() == 4          # empty range gives no rows
    log = control.log_days(chunks, "stage", now="2024-02-03 08:00:00").collect()
    assert [(r.run_date, r.rows_loaded, r.expected_rows) for r in log][:2] == [(D(2024, 1, 30), 24, 24),
                                                                               (D(2024, 1, 31), 24, 24)]
    s = successes(spark.createDataFrame([(D(2024, 1, 1), "A", "stage", "success"),
                                         (D(2024, 1, 1), "A", "stage", "success"),
                                         (D(2024, 1, 1), "A", "core", "success")],
                                        "run_date date, city_name string, layer string, status string"))
    assert s.count() == 1


def test_write_partitioned_and_history(spark, tmp_path):
    p = str(tmp_path / "f")
    fact = spark.createDataFrame([(20240101 + i, 1, 10.0 + i, 9.0, 11.0, 1.0, 3600.0, 50.0, 1000.0, 3.0, 202401)
                                  for i in range(5)],
                                 "date_id int, city_id long, temp_avg double, temp_min double, temp_max double, "
                                 "precipitation_sum double, sunshine_duration_hours double, "
                                 "avg_relative_humidity double, avg_pressure_msl double, avg_wind_speed_10m double, "
                                 "ym int")
    writes.write_partitioned(fact, p, "ym")
    cal = dims.dim_calendar(spark, "2023-12-01", "2024-02-01")
    cities = spark.createDataFrame([(1, "A")], "id long, city_name string")
    h = history_from_fact(spark.read.parquet(p), cal, cities, "2024-01-03").orderBy("ds").collect()
    assert [r.ds for r in h] == [D(2024, 1, 3), D(2024, 1, 4), D(2024, 1, 5)]
    assert h[0].sunshine_hours == 3600.0 and h[0].city_name == "A"
    j = joins.join_calendar(spark.read.parquet(p), cal)
    assert j.where(F.col("day_of_week") == 1).count() == 1                  # 2024-01-01 is a Monday


def test_gap_view_and_hours(spark):
    log = spark.createDataFrame([(D(2024, 1, 1), "A", "stage", "success")],
                                "run_date date, city_name string, layer string, status string")
    cities = spark.createDataFrame([("A",)], "city_name string")
    control.register_gap_view(spark, log, cities, "2024-01-03", start="2024-01-01")
    got = spark.sql("SELECT layer, count(*) AS n FROM v_date_gaps GROUP BY layer ORDER BY layer").collect()
    assert [(r.layer, r.n) for r in got] == [("core", 2), ("stage", 1)]
    st = spark.createDataFrame([("A", dt.datetime(2024, 1, 1, h)) for h in range(23)]
                               + [("A", dt.datetime(2024, 1, 2, h % 24)) for h in range(25)]
                               + [("A", dt.datetime(2024, 1, 3, h)) for h in range(24)],
                               "location_name string, measured_at timestamp_ntz")
    hp = {r.day: r.n_rows for r in control.hours_per_day(st).collect()}
    assert hp == {D(2024, 1, 1): 23, D(2024, 1, 2): 25}


def test_enrich_and_series(spark):
    df = spark.createDataFrame([("Lisbon",), ("Nowhere",)], "n string")
    cfg = spark.createDataFrame([("Lisbon", "Csa")], "name string, climate_zone string")
    got = {r.n: r.climate_zone for r in joins.enrich_from_config(df, cfg, "n", ["climate_zone"]).collect()}
    assert got == {"Lisbon": "Csa", "Nowhere": None}
    assert date_series(spark, "2024-02-27", "2024-03-01").count() == 4


def test_dst_aware_expected_hours(spark):
    from stratus.functions.dates import expected_hours
    df = spark.createDataFrame([(D(2024, 3, 31), "Europe/Lisbon"), (D(2024, 10, 27), "Europe/Lisbon"),
                                (D(2024, 6, 1), "Europe/Lisbon"), (D(2024, 3, 31), "UTC")], "d date, tz string")
    assert [r[0] for r in df.select(expected_hours("d", "tz")).collect()] == [23, 25, 24, 24]
    st = spark.createDataFrame([("A", dt.datetime(2024, 3, 31, h), "Europe/Lisbon") for h in range(23)]
                               + [("A", dt.datetime(2024, 4, 1, h), "Europe/Lisbon") for h in range(23)],
                               "location_name string, measured_at timestamp_ntz, timezone string")
    got = {r.day: (r.n_rows, r.expected_rows) for r in control.hours_per_day(st, tz="timezone").collect()}
    assert got == {D(2024, 4, 1): (23, 24)}
