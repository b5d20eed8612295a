"""The daily run: every layer of the warehouse written to Parquet tables under one root.

Order follows the original's asset order, with gap repair after the mart:

1. stage      landed payloads of the run window → (place, day) slices replaced; load log appended
2. dims       countries and places merged SCD1 (stable ids), weather codes insert-if-absent
3. facts      hourly (day partitions) and daily (month partitions) facts of the window replaced by
              date-key range; ``core`` log rows
4. mart       daily mart of the window replaced
5. repair     months in which the stage has a day of a place that a fact lacks are recomputed, one isolated
              job a month, then the same between daily fact and mart; days are stored bitmaps
6. forecast   seven-day forecast appended insert-only, keyed by run date (places already
              forecast for the run are not refitted)

Every step is a Spark job over whole tables; nothing but partition lists, a few
month keys and row counts reaches the driver. Each table rewrite checkpoints its
plan to the shared ``spark.checkpoint.dir`` first, so reruns are idempotent and a lost
executor never sees a half-written input.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.functions import constants as K
from stratus.functions.dates import date_from_id, date_id, day_ids_between, months_between, run_window
from stratus.operators import aggregates, daymaps, dims, facts, forecast, mart, repair, writes
from stratus.sources.generators import wind_bands, wmo_codes
from stratus.sources.payload import explode_payload, invalid_payloads, read_landed
from stratus.sources.scans import history_from_fact, in_window, scan_window
from stratus.streaming.ingest import latest_documents, replace_batch

COUNTRY_ATTRS = ["iso_code_2", "iso_code_3", "continent", "region"]
CITY_ATTRS = ["latitude", "longitude", "elevation_m", "timezone", "is_capital", "climate_zone", "country_id"]


def _ym(c) -> F.Column:
    return (F.year(c) * 100 + F.month(c)).cast("int")


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if writes._exists(spark, path) else None


def merge_dimension(spark: SparkSession, path: str, source: DataFrame, key: str, attrs, now) -> DataFrame:
    """SCD1-merge ``source`` into the dimension table at ``path`` with stable integer ids."""
    nowc = F.lit(now).cast("timestamp_ntz")
    cur = _read(spark, path)
    if cur is None:
        schema = T.StructType([T.StructField("id", T.IntegerType()), *source.select(key, *attrs).schema.fields,
                               T.StructField("loaded_at", T.TimestampNTZType()),
                               T.StructField("updated_at", T.TimestampNTZType())])
        cur = spark.createDataFrame([], schema)
    merged = writes.scd1_merge(cur.drop("id"), source, key, attrs, nowc)
    ids = cur.select(key, "id").unionByName(writes.assign_ids(cur, source.select(key), key, "id"))
    out = merged.join(ids, key, "left").select("id", key, *attrs, "loaded_at", "updated_at")
    out = out.checkpoint(eager=True)
    out.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _log_rows(keys: DataFrame, layer: str, now, status: str = "success") -> DataFrame:
    """Load-log rows (one per place and day) from (city_name, run_date, rows_loaded[, error_msg])."""
    error = F.col("error_msg") if "error_msg" in keys.columns else F.lit(None)
    return keys.select("run_date", "city_name", F.lit(layer).alias("layer"), F.lit(status).alias("status"),
                       F.col("rows_loaded").cast("int"), F.lit(K.EXPECTED_ROWS_PER_DAY).alias("expected_rows"),
                       F.lit(now).cast("timestamp_ntz").alias("executed_at"),
                       error.cast("string").alias("error_msg"))


def daily_run(spark: SparkSession, root: str, landed, cities_cfg: DataFrame, today, start=None, end=None,
              now=None, model: str = "seasonal", history_days: int = K.HISTORY_DAYS) -> dict:
    """Run every layer for the window [start, end] (default: yesterday) and return row counts."""
    root = root.rstrip("/")
    start, end = run_window(today, start, end)
    months = months_between(start, end)
    now = now or dt.datetime.now().isoformat(sep=" ", timespec="microseconds")
    P = {n: f"{root}/{n}" for n in ("stage", "load_log", "dim_countries", "dim_cities", "dim_weather_code",
                                    "fact_hourly", "fact_daily", "mart_daily", "forecast")}
    report = {"start": start, "end": end, "seconds": {}}
    clock = [time.perf_counter()]

    def lap(step: str) -> None:
        now_t = time.perf_counter()
        report["seconds"][step] = round(now_t - clock[0], 2)
        clock[0] = now_t

    # 1. stage -------------------------------------------------------------------------------
    docs = read_landed(spark, landed) if isinstance(landed, str) else landed
    rows = in_window(explode_payload(docs, now=now), "measured_at", start, end)
    if "_landed" in rows.columns:               # of several documents for a place and day the last one counts
        rows = latest_documents(rows.withColumn("_day", F.to_date("measured_at")), ["location_name", "_day"]).drop("_day")
    rows = rows.checkpoint(eager=True)          # parse the landed JSON once; reused by every step below
    report["stage_rows"] = replace_batch(spark, rows, P["stage"])
    # a document that can't be read is logged with its reason; the others go on
    bad = invalid_payloads(docs).select(
        F.coalesce("name", F.lit("unknown")).alias("city_name"), F.lit(start).cast("date").alias("run_date"),
        F.lit(None).cast("int").alias("rows_loaded"), F.col("error").alias("error_msg")).checkpoint(eager=True)
    report["failed_documents"] = bad.count()
    if report["failed_documents"]:
        writes.append_table(_log_rows(bad, "stage", now, "failed"), P["load_log"], "layer")
    stage = spark.read.parquet(P["stage"])
    counts = (rows.groupBy(F.col("location_name").alias("city_name"), F.to_date("measured_at").alias("run_date"))
                  .agg(F.count(F.lit(1)).alias("rows_loaded")))
    writes.append_table(_log_rows(counts, "stage", now), P["load_log"], "layer")

    lap("stage")

    # 2. dimensions ---------------------------------------------------------------------------
    countries = merge_dimension(spark, P["dim_countries"], dims.dim_countries(cities_cfg), "country_name",
                                COUNTRY_ATTRS, now)
    # only this run's rows are scanned; known places keep their stored geo (no stage rescan)
    place_src = dims.dim_cities(rows, cities_cfg, countries, tie="measured_at", existing=_read(spark, P["dim_cities"]))
    cities = merge_dimension(spark, P["dim_cities"], place_src, "city_name", CITY_ATTRS, now)
    codes = _read(spark, P["dim_weather_code"])
    codes = wmo_codes(spark) if codes is None else codes
    codes = dims.dim_weather_code(codes, rows).checkpoint(eager=True)     # new codes can only come from new rows
    codes.write.mode("overwrite").parquet(P["dim_weather_code"])
    codes = spark.read.parquet(P["dim_weather_code"])

    lap("dimensions")

    # 3. facts --------------------------------------------------------------------------------
    win = scan_window(stage, "measured_at", start, end, part_col="day", part_kind="date")  # partition pruning
    # the hourly fact is partitioned by day, so replacing a day rewrites only that day
    hourly = facts.hourly_fact(win, cities, wind_bands(spark), now=now)
    writes.replace_range_table(spark, P["fact_hourly"], hourly, "date_id", start, end, "date_id",
                               day_ids_between(start, end), kind="date_id")

    def daily_of(df):
        return facts.daily_rollup(df, cities, now=now).withColumn("ym", F.floor(F.col("date_id") / 100).cast("int"))

    writes.replace_range_table(spark, P["fact_daily"], daily_of(win), "date_id", start, end, "ym", months,
                               kind="date_id")
    fact = spark.read.parquet(P["fact_daily"])
    fact_win = fact.where(F.col("ym").isin(months))                      # partition pruning
    core = (fact_win.where(F.col("date_id").between(date_id(F.lit(start).cast("date")), date_id(F.lit(end).cast("date"))))
                .join(cities.select(F.col("id").alias("city_id"), "city_name"), "city_id")
                .select("city_name", date_from_id(F.col("date_id")).alias("run_date"), F.lit(None).alias("rows_loaded")))
    writes.append_table(_log_rows(core, "core", now), P["load_log"], "layer")

    lap("facts")

    # 4. mart ---------------------------------------------------------------------------------
    cal = dims.dim_calendar(spark)

    def mart_of(f, s=None, e=None):
        return mart.daily_mart(f, cal, codes, s, e).withColumn("ym", _ym(F.col("date")))

    writes.replace_range_table(spark, P["mart_daily"], mart_of(fact_win, start, end), "date", start, end, "ym", months)

    lap("mart")

    # 5. gap repair: stage → facts, then fact → mart (K12: after the mart) --------------------
    # the layers' days are bitmaps that are kept beside the tables; only what changed is read
    def maps(table: str, place, day, month, by_month) -> DataFrame:
        return daymaps.refresh(spark, f"{root}/layer_days/{table}", spark.read.parquet(P[table]), F.col(place), day, month, by_month, months)

    def of_month(column):
        return lambda chosen: column.isin(chosen)

    def log_failures(found: DataFrame) -> int:
        failed = found.where("status = 'failed'").select(
            F.lit("(all)").alias("city_name"), F.col("start_date").alias("run_date"), F.lit(None).alias("rows_loaded"), "error_msg")
        n = repair.counts(found)
        if n[1]:
            writes.append_table(_log_rows(failed, "core", now, "failed"), P["load_log"], "layer")
            report["months_failed"] += n[1]
        return n[0]

    report["months_failed"] = 0
    names = cities.select(F.col("id").cast("string").alias("_id"), F.col("city_name").alias("_name"))
    in_stage = maps("stage", "location_name", F.col("day"), _ym(F.col("day")), of_month(_ym(F.col("day"))))
    # known places under their ids, as in the facts; others are not in the dimension yet
    in_stage = in_stage.join(names, in_stage["place"] == names["_name"]).select(F.col("_id").alias("place"), "ym", "days", "n_rows")
    id_day, id_month = date_from_id(F.col("date_id")), F.floor(F.col("date_id") / 100).cast("int")

    in_hourly = maps("fact_hourly", "city_id", id_day, id_month, of_month(id_month))

    def hourly_month(w: dict) -> None:
        first, last = w["start_date"].isoformat(), w["end_date"].isoformat()
        fresh = facts.hourly_fact(scan_window(stage, "measured_at", first, last, part_col="day", part_kind="date"), cities,
                                  wind_bands(spark), now=now)
        writes.replace_range_table(spark, P["fact_hourly"], fresh, "date_id", first, last, "date_id",
                                   day_ids_between(first, last), kind="date_id")

    report["hourly_months_repaired"] = log_failures(repair.repair_months(
        spark, daymaps.gap_windows(daymaps.missing(in_stage, in_hourly), today), hourly_month, "fact_hourly", pool=1))

    in_daily = maps("fact_daily", "city_id", id_day, F.col("ym"), of_month(F.col("ym")))
    fact = spark.read.parquet(P["fact_daily"])
    report["core_months_repaired"] = log_failures(repair.repair_months(
        spark, daymaps.gap_windows(daymaps.missing(in_stage, in_daily), today),
        lambda w: repair.rewrite_month(spark, P["fact_daily"], w, fact.where(F.col("ym") == w["ym"]),
                                       stage.where(_ym(F.col("day")) == w["ym"]), daily_of, lambda: date_from_id(F.col("date_id")), "day"),
        "fact_daily"))

    in_daily = maps("fact_daily", "city_id", id_day, F.col("ym"), of_month(F.col("ym")))
    in_mart = maps("mart_daily", "city_id", F.col("date"), F.col("ym"), of_month(F.col("ym")))
    fact, mart_t = spark.read.parquet(P["fact_daily"]), spark.read.parquet(P["mart_daily"])
    report["mart_months_repaired"] = log_failures(repair.repair_months(
        spark, daymaps.gap_windows(daymaps.missing(in_daily, in_mart), today),
        lambda w: repair.rewrite_month(spark, P["mart_daily"], w, mart_t.where(F.col("ym") == w["ym"]),
                                       fact.where(F.col("ym") == w["ym"]).withColumn("_day", id_day),
                                       lambda df: mart_of(df.drop("_day")), lambda: F.col("date"), "_day"),
        "mart_daily"))

    lap("repair")

    # 6. forecast -----------------------------------------------------------------------------
    fact = spark.read.parquet(P["fact_daily"])
    cutoff = (dt.date.fromisoformat(str(today)[:10]) - dt.timedelta(days=history_days)).isoformat()
    cut_ym = int(cutoff[:4]) * 100 + int(cutoff[5:7])
    hist = history_from_fact(fact.where(F.col("ym") >= cut_ym), cal, cities, cutoff)   # partition pruning
    hist = hist.where(F.col("ds") < F.lit(str(today)[:10]).cast("date"))   # a run in the past sees its past only
    long = forecast.melt_metrics(hist, date_col="ds")
    report["forecast_series"] = aggregates.series_index(hist).count()
    report["forecast_skipped"] = forecast.forecast_skips(long, places=hist).count()
    done = _read(spark, P["forecast"])
    if done is not None:   # insert-only: places already forecast for this run are not refitted
        done = done.where(F.col("forecast_run_date") == F.lit(str(today)[:10]).cast("date")).select("city_id")
        long = long.join(done.distinct(), "city_id", "left_anti")
    if model == "seasonal":
        fitted = forecast.forecast_seasonal(long, today)
        fitted = fitted.where(F.col("status") == "ok")
    else:
        fitted = forecast.forecast_linear(long, today)
    wide = forecast.pivot_forecast(fitted, today).withColumn("loaded_at", F.lit(now).cast("timestamp_ntz"))
    report["forecast_rows"] = writes.append_absent_table(
        spark, P["forecast"], wide, ["forecast_run_date", "target_date", "city_id"], "forecast_run_date")
    lap("forecast")
    return report


def check_tables(spark: SparkSession, root: str) -> DataFrame:
    """Declared constraints of the produced tables as one report (check_name, violations).

    Keys: fact_daily (date_id, city_id), mart_daily (date, city_id), forecast
    (forecast_run_date, target_date, city_id), dimension names; foreign keys from facts
    and mart to the place dimension; CHECK enumerations of the load log.
    """
    from stratus.operators import checks
    root = root.rstrip("/")
    t = {n: spark.read.parquet(f"{root}/{n}") for n in
         ("fact_daily", "mart_daily", "forecast", "dim_cities", "dim_countries", "load_log")}
    return checks.constraint_report([
        ("fact_daily_unique", checks.check_unique(t["fact_daily"], ["date_id", "city_id"])),
        ("mart_daily_pk", checks.check_unique(t["mart_daily"], ["date", "city_id"])),
        ("forecast_pk", checks.check_unique(t["forecast"], ["forecast_run_date", "target_date", "city_id"])),
        ("dim_cities_name_unique", checks.check_unique(t["dim_cities"], ["city_name"])),
        ("dim_cities_id_unique", checks.check_unique(t["dim_cities"], ["id"])),
        ("dim_countries_name_unique", checks.check_unique(t["dim_countries"], ["country_name"])),
        ("fact_daily_fk_city", checks.check_fk(t["fact_daily"], ["city_id"], t["dim_cities"], ["id"])),
        ("mart_daily_fk_city", checks.check_fk(t["mart_daily"], ["city_id"], t["dim_cities"], ["id"])),
        ("dim_cities_fk_country", checks.check_fk(t["dim_cities"], ["country_id"], t["dim_countries"], ["id"])),
    ], checks.row_report(t["load_log"], {
        "load_log_layer_in": checks.outside("layer", K.LAYERS), "load_log_status_in": checks.outside("status", K.STATUSES),
        "load_log_not_null": checks.null_in(["run_date", "city_name", "layer", "status"])}))


def main(argv=None) -> None:
    """Command line: ``python -m stratus.plans.warehouse --root R --landed L --cities C.yml [--today D]``."""
    import argparse
    import json

    from stratus.session import checkpoint_dir, get_spark
    from stratus.sources.config import load_cities

    ap = argparse.ArgumentParser(description="Run every warehouse layer for one window.")
    ap.add_argument("--root", required=True, help="folder of the warehouse tables")
    ap.add_argument("--landed", required=True, help="folder (or glob) of landed JSON documents")
    ap.add_argument("--cities", required=True, help="YAML place list with a 'cities' key")
    ap.add_argument("--today", default=dt.date.today().isoformat())
    ap.add_argument("--start")
    ap.add_argument("--end")
    ap.add_argument("--model", choices=["seasonal", "linear"], default="seasonal")
    a = ap.parse_args(argv)
    spark = get_spark()
    checkpoint_dir(spark)          # the cluster's spark.checkpoint.dir; a scratch folder only if unset
    report = daily_run(spark, a.root, a.landed, load_cities(spark, a.cities), a.today, a.start, a.end,
                       model=a.model)
    print(json.dumps(report))


if __name__ == "__main__":
    main()
