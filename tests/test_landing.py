"""The landing path: bad documents are logged, the latest document wins, partitioned writes make few files."""

import datetime as dt
import glob
import json
import math

import pytest
from pyspark.sql import functions as F

from stratus import session
from stratus.operators import control, joins, writes
from stratus.operators import forecast as FC
from stratus.plans.warehouse import daily_run
from stratus.sources.config import load_cities
from stratus.sources.generators import wind_bands
from stratus.sources.payload import coerce_types, invalid_payloads, read_landed
from test_warehouse import CITIES, documents


def write_lines(path, name, lines):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n")


def test_bad_documents_are_logged_and_the_others_go_on(spark, tmp_path):
    good, ragged, odd = documents(3)
    ragged["hourly"]["rain"].pop()
    odd["hourly"]["time"][5] = "some day"
    landed = tmp_path / "landed"
    write_lines(landed, "a.json", [json.dumps(good), json.dumps(ragged), json.dumps(odd), '{"name": "Broken", "hourly": {'])
    errors = {r.error for r in invalid_payloads(read_landed(spark, str(landed))).collect()}
    assert errors == {"arrays of unequal length", "unreadable time", "unreadable document"}
    root = str(tmp_path / "wh")
    report = daily_run(spark, root, str(landed), load_cities(spark, CITIES), today="2024-01-04", start="2024-01-01",
                       end="2024-01-03", model="linear")
    assert report["stage_rows"] == 72 and report["failed_documents"] == 3 and report["forecast_skipped"] == 1
    log = spark.read.parquet(f"{root}/load_log")
    failed = {(r.city_name, r.error_msg) for r in log.where("status = 'failed'").collect()}
    assert ("Porto", "arrays of unequal length") in failed and ("Atlantis", "unreadable time") in failed and len(failed) == 3
    stamps = [r[0] for r in log.select("executed_at").distinct().collect()]
    assert all(abs(s - dt.datetime.now()) < dt.timedelta(hours=1) for s in stamps)


def test_the_latest_document_of_a_day_wins(spark, tmp_path):
    first, second = documents(2)[0], documents(2)[0]
    for d, v in ((first, 10.0), (second, 20.0)):
        d["hourly"]["temperature_2m"] = [v] * 48
        d["hourly"]["time"] = [t + ":00" if v == 20.0 else t for t in d["hourly"]["time"]]  # both time forms
    landed = tmp_path / "landed"
    write_lines(landed, "a.json", [json.dumps(first), json.dumps(second)])
    root = str(tmp_path / "wh")
    report = daily_run(spark, root, str(landed), load_cities(spark, CITIES), today="2024-01-03", start="2024-01-01",
                       end="2024-01-02", model="linear")
    assert report["stage_rows"] == 48
    assert {r.temp_avg for r in spark.read.parquet(f"{root}/fact_daily").select("temp_avg").collect()} == {20.0}


def test_lenient_types(spark):
    df = spark.createDataFrame([("3.0", "true"), ("3", "1"), ("3.5", "0.0"), ("1e9", "FALSE"), ("x", "maybe"), (None, None)],
                               "weather_code string, is_day string")
    got = [tuple(r) for r in coerce_types(df, {"weather_code": "smallint", "is_day": "boolean"}).collect()]
    assert got == [(3, True), (3, True), (None, False), (None, False), (None, None), (None, None)]


def test_partitioned_writes_make_few_files(spark, tmp_path):
    df = spark.range(0, 32_000, 1, 32).select("id", (F.col("id") % 30).cast("int").alias("day"))
    path = str(tmp_path / "t")
    writes.rewrite_partitions(spark, path, df, "day", range(30))
    assert len(glob.glob(f"{path}/day=*/*.parquet")) <= 60 and spark.read.parquet(path).count() == 32_000
    writes.append_table(df, path, "day")
    assert len(glob.glob(f"{path}/day=*/*.parquet")) <= 120


def test_band_lookup_equals_band_join_on_any_number(spark):
    values = [0.0, 11.0, 11.5, 12.0, 359.99, 360.0, -1.0, 1e12, -1e300, math.inf, -math.inf, math.nan, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, d double")
    bands = wind_bands(spark)
    a = {r.i: r.b for r in joins.band_lookup(df, "d", bands, "b").collect()}
    assert a == {r.i: r.b for r in joins.band_join(df, "d", bands, "b").collect()} and a[0] is not None


def test_run_verdict_counts_incremental_successes_only(spark):
    rows = [("a", "incremental", "failed"), ("a", "backfill", "success"), ("b", "incremental", "success"),
            ("b", "backfill", "failed"), ("c", "backfill", "success")]
    got = {r.run: r.ok for r in control.run_ok(spark.createDataFrame(rows, "run string, phase string, status string"),
                                               by=("run",), phase="phase").collect()}
    assert got == {"a": False, "b": True, "c": True}


def test_places_without_any_value_are_skipped_ones(spark):
    hist = spark.createDataFrame([(1, dt.date(2024, 1, 1) + dt.timedelta(i), 1.0) for i in range(70)]
                                 + [(2, dt.date(2024, 1, 1), None)], "city_id long, date date, m double")
    long = FC.melt_metrics(hist, metrics=["m"])
    assert [r.city_id for r in FC.forecast_skips(long, places=hist).collect()] == [2]


def test_no_local_checkpoint_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())
