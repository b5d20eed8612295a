"""Day bitmaps, isolated repair of gap months, corrections across micro-batches."""

import datetime as dt
import json

from pyspark.sql import functions as F

from stratus.operators import daymaps, repair
from stratus.plans import warehouse
from stratus.sources.config import load_cities
from stratus.streaming import corrections, ingest_corrections, land
from test_warehouse import CITIES, documents

DAY = dt.date(2024, 1, 30)


def days(spark, rows):
    return spark.createDataFrame([(p, None if d is None else DAY + dt.timedelta(days=d)) for p, d in rows], "p string, d date")


def test_missing_days_equal_except(spark):
    up = [("a", k) for k in range(40)] + [("b", 0), ("b", 0), (None, 5), ("c", 2), ("a", None)]
    down = [("a", k) for k in range(40) if k % 7] + [("b", 1), ("d", 9)]
    maps = [daymaps.month_maps(days(spark, x), F.col("p"), F.col("d")) for x in (up, down)]
    got = {(r.place, r.missing_date) for r in daymaps.missing_days(daymaps.missing(*maps)).collect()}
    assert got == {(p, DAY + dt.timedelta(days=d)) for p, d in set(up) - set(down) if d is not None}
    halves = daymaps.month_maps(days(spark, up[:20]), F.col("p"), F.col("d")).unionByName(
        daymaps.month_maps(days(spark, up[15:]), F.col("p"), F.col("d")))
    bits = {(r.place, r.ym): r.days for r in maps[0].collect()}
    assert {(r.place, r.ym): r.days for r in daymaps.merge_maps(halves).collect()} == bits
    assert bits["a", 202402] == 2 ** 29 - 1 and bits["a", 202401] == 0b11 << 29       # 29 February, and the 31st


def test_windows_end_yesterday_and_leave_out_months_to_come(spark):
    gaps = spark.createDataFrame([("a", 202312, 1), ("b", 202402, 1), ("c", 202402, 8), ("d", 202403, 1)], "place string, ym int, days int")
    got = [tuple(r) for r in daymaps.gap_windows(gaps, "2024-02-10").orderBy("ym").collect()]
    assert got == [(202312, dt.date(2023, 12, 1), dt.date(2023, 12, 31)), (202402, dt.date(2024, 2, 1), dt.date(2024, 2, 9))]
    assert daymaps.gap_windows(gaps, "2024-02-01").count() == 1


def test_refresh_reads_only_months_that_changed(spark, tmp_path):
    table, maps, read = str(tmp_path / "t"), str(tmp_path / "m"), []

    def write(rows):
        df = days(spark, rows).withColumn("ym", daymaps.month_key(F.col("d")))
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ym").parquet(table)

    def of(months):
        read.append(months)
        return F.col("ym").isin(months)

    def refresh(written=()):
        read.clear()
        found = daymaps.refresh(spark, maps, spark.read.parquet(table), F.col("p"), F.col("d"), F.col("ym"), of, written)
        return {(r.place, r.ym): (r.days, r.n_rows) for r in found.collect()}

    write([("a", 0), ("a", 1), ("a", 10), ("b", 10), ("b", 40)])
    first = refresh()
    assert read == [[202401, 202402, 202403]] and first["a", 202401] == (0b11 << 29, 2)
    assert refresh() == first and read == []                    # nothing changed: no keys are read
    write([("a", 10)])                                          # behind the run's back
    assert refresh() == {k: v for k, v in first.items() if k != ("b", 202402)} and read == [[202402]]
    refresh(written=[202403])
    assert read == [[202403]]
    daymaps.drop_partitions(spark, table, [202401])
    assert ("a", 202401) not in refresh() and read == [[202401]]


def test_a_failed_month_leaves_the_others_done(spark):
    windows = spark.createDataFrame([(m, DAY, DAY) for m in (202401, 202402, 202403)], "ym int, start_date date, end_date date")
    done = []

    def work(w):
        if w["ym"] == 202402:
            raise RuntimeError("no source\nmore lines")
        done.append((w["ym"], spark.range(3).count()))

    report = repair.repair_months(spark, windows, work, "t")
    assert {(r.ym, r.status, r.error_msg) for r in report.collect()} == {
        (202401, "repaired", None), (202402, "failed", "RuntimeError: no source"), (202403, "repaired", None)}
    assert sorted(done) == [(202401, 3), (202403, 3)] and repair.counts(report) == (2, 1)
    assert repair.repair_months(spark, windows.limit(0), work, "t").count() == 0


def test_daily_run_repairs_hourly_holes_and_logs_a_month_that_fails(spark, tmp_path, monkeypatch):
    landed, root = str(tmp_path / "landed"), str(tmp_path / "wh")
    spark.createDataFrame([(json.dumps(d),) for d in documents(40)], "v string").write.text(landed)
    cfg = load_cities(spark, CITIES)
    warehouse.daily_run(spark, root, landed, cfg, today="2024-02-10", start="2024-01-01", end="2024-02-09", model="linear")
    for table, hole, by in (("fact_hourly", "NOT (date_id = 20240105 AND city_id = 1)", "date_id"),
                            ("fact_daily", "NOT (date_id IN (20240110, 20240203) AND city_id = 2)", "ym")):
        df = spark.read.parquet(f"{root}/{table}").where(hole).checkpoint(eager=True)
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(by).parquet(f"{root}/{table}")
    keep = repair.rewrite_month

    def sometimes(spark, path, window, *rest):
        if window["ym"] == 202401 and path.endswith("fact_daily"):
            raise ValueError("January is not to be had")
        return keep(spark, path, window, *rest)

    monkeypatch.setattr(repair, "rewrite_month", sometimes)
    report = warehouse.daily_run(spark, root, landed, cfg, today="2024-02-10", start="2024-02-09", end="2024-02-09", model="linear")
    assert (report["hourly_months_repaired"], report["core_months_repaired"], report["months_failed"]) == (1, 1, 1)
    assert spark.read.parquet(f"{root}/fact_hourly").count() == 3 * 40 * 24
    fact = spark.read.parquet(f"{root}/fact_daily")
    assert fact.count() == 3 * 40 - 1 and fact.where("ym = 202401").count() == 3 * 31 - 1
    log = spark.read.parquet(f"{root}/load_log").where("status = 'failed'").collect()
    assert [(r.city_name, r.run_date, r.error_msg) for r in log] == [("(all)", dt.date(2024, 1, 1), "ValueError: January is not to be had")]
    monkeypatch.undo()
    again = warehouse.daily_run(spark, root, landed, cfg, today="2024-02-10", start="2024-02-09", end="2024-02-09", model="linear")
    assert again["core_months_repaired"] == 1 and again["months_failed"] == 0
    assert spark.read.parquet(f"{root}/fact_daily").count() == 3 * 40


def test_an_older_version_that_lands_late_does_not_win(spark, tmp_path):
    base = str(tmp_path)
    schema = "location_name string, measured_at timestamp_ntz, temperature_2m double, version long"

    def landing(version, places, hours=3):
        rows = [(p, dt.datetime(2024, 1, 1, h), float(version), version) for p in places for h in range(hours)]
        land(spark.createDataFrame(rows, schema).coalesce(1), f"{base}/landing")

    def ingest():
        return ingest_corrections(spark, f"{base}/landing", spark.createDataFrame([], schema).schema, f"{base}/stage", f"{base}/_cp",
                                  lambda b: b, max_files=1)

    landing(1, ["a", "b", None])
    landing(3, ["a"])
    landing(2, ["a", "b"], hours=2)                              # late for a, a correction for b
    assert ingest() >= 3

    def state():
        return sorted((r.location_name or "", r.version, r.n) for r in spark.read.parquet(f"{base}/stage")
                      .groupBy("location_name", "version").agg(F.count("*").alias("n")).collect())

    assert state() == [("", 1, 3), ("a", 3, 3), ("b", 2, 2)]
    landing(2, ["a", None])                                      # another run: the state goes on
    ingest()
    assert state() == [("", 2, 3), ("a", 3, 3), ("b", 2, 2)]
    ingest()                                                     # nothing new
    assert state() == [("", 2, 3), ("a", 3, 3), ("b", 2, 2)]


def test_corrections_call_python_per_bucket_not_per_place(spark, tmp_path):
    """Many places of one month: the groups of the state are buckets, and the newest version still wins by place and day."""
    base = str(tmp_path)
    schema = "location_name string, measured_at timestamp_ntz, temperature_2m double, version long"
    places = [None] + [f"p{k}" for k in range(1500)]
    for version, named in ((1, places), (3, places[::2]), (None, places[:9]), (2, places[::3])):
        rows = [(p, dt.datetime(2024, 1, day, 5), 0.5, version) for p in named for day in ((1, 31) if version == 1 else (31,))]
        land(spark.createDataFrame(rows, schema).coalesce(1), f"{base}/landing")
    ingest_corrections(spark, f"{base}/landing", spark.createDataFrame([], schema).schema, f"{base}/stage", f"{base}/_cp", lambda b: b, max_files=1)
    got = {(r.location_name, r.measured_at.day): r.version for r in spark.read.parquet(f"{base}/stage").collect()}
    assert got == {(p, 1): 1 for p in places} | {(p, 31): 3 if i % 2 == 0 else 2 if i % 3 == 0 else 1 for i, p in enumerate(places)}
    assert spark.read.format("statestore").load(f"{base}/_cp").count() <= corrections.BUCKETS < len(places)
