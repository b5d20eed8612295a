"""Registered queries: each operator of the warehouse bound to the driver's tables.

Every entry is ``(spark, sf_dir) -> DataFrame`` and reads whole tables; the matching
SQL oracle lives in ``stratus.plans.oracle`` under the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratus.operators import facts
from stratus.plans import standins as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

WINDOW = ("2024-01-10", "2024-01-20")
TODAY = "2024-01-31"
SLICE_REGION, SLICE_ZONE = "AUTOMOBILE", "Temperate"


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _stage(spark, sf):
    return S.events_as_stage(S.table(spark, sf, "events"))


def _cities(spark, sf):
    return S.cities_dim(S.table(spark, sf, "customer"))


@query("daily_rollup")
def q_daily_rollup(spark, sf):
    return facts.daily_rollup(_stage(spark, sf), _cities(spark, sf))


@query("daily_rollup_window")
def q_daily_rollup_window(spark, sf):
    return facts.daily_rollup(_stage(spark, sf), _cities(spark, sf), *WINDOW)


# ---------------------------------------------------------------------------
# shared derived inputs
# ---------------------------------------------------------------------------
from pyspark.sql import functions as F  # noqa: E402

from stratus.operators import checks, control, dims, joins, mart, writes  # noqa: E402
from stratus.sources import generators as G  # noqa: E402

SPLIT_DAY = "2024-01-16"           # first day of the second load window
RUN1_NOW = "2024-01-15 08:00:00"   # time stamp of the first load
RUN2_NOW = "2024-01-31 08:00:00"   # time stamp of the second load


def _cfg(spark, sf):
    return S.cities_config(S.table(spark, sf, "customer"), S.table(spark, sf, "nation"),
                           S.table(spark, sf, "region"))


def _countries(spark, sf, cfg=None):
    """Country dimension with the nation key as id."""
    n = S.table(spark, sf, "nation").select(F.col("n_name").alias("country_name"),
                                             F.col("n_nationkey").alias("id"))
    return dims.dim_countries(cfg if cfg is not None else _cfg(spark, sf)).join(n, "country_name", "inner")


def _log(spark, sf):
    return S.load_log_from_events(S.table(spark, sf, "events"))


# ---------------------------------------------------------------------------
# facts, compass, dimensions
# ---------------------------------------------------------------------------
@query("hourly_fact")
def q_hourly_fact(spark, sf):
    return facts.hourly_fact(_stage(spark, sf), _cities(spark, sf), G.wind_bands(spark))


@query("wind_band_join")
def q_wind_band_join(spark, sf):
    st = _stage(spark, sf).select("event_id", "wind_direction_10m")
    return joins.band_join(st, "wind_direction_10m", G.wind_bands(spark), "wind_dir_id")


@query("wind_band_lookup")
def q_wind_band_lookup(spark, sf):
    st = _stage(spark, sf).select("event_id", "wind_direction_10m")
    return joins.band_lookup(st, "wind_direction_10m", G.wind_bands(spark), "wind_dir_id") \
                .select("event_id", "wind_direction_10m", F.col("wind_dir_id").cast("smallint").alias("wind_dir_id"))


@query("compass16")
def q_compass16(spark, sf):
    st = _stage(spark, sf).select("event_id", "wind_direction_10m")
    return st.select("event_id", "wind_direction_10m", joins.compass16("wind_direction_10m").alias("compass_id"))


@query("dim_calendar")
def q_dim_calendar(spark, sf):
    return dims.calendar_span(S.table(spark, sf, "orders"), "o_orderdate")


@query("time_of_day")
def q_time_of_day(spark, sf):
    return dims.time_attributes(S.table(spark, sf, "events"), "ts", keep=["event_id"])


@query("dim_weather_code")
def q_dim_weather_code(spark, sf):
    return dims.dim_weather_code(G.wmo_codes(spark), _stage(spark, sf))


@query("dim_country_first")
def q_dim_country_first(spark, sf):
    return dims.dim_countries(_cfg(spark, sf))


@query("dim_city_latest")
def q_dim_city_latest(spark, sf):
    cfg = _cfg(spark, sf)
    return dims.dim_cities(_stage(spark, sf), cfg, _countries(spark, sf, cfg), tie="event_id")


CITY_ATTRS = ["latitude", "longitude", "elevation_m", "timezone", "is_capital", "climate_zone", "country_id"]


def _city_load(spark, sf, lo, hi, now, cfg, countries):
    st = _stage(spark, sf)
    st = st.where(F.col("measured_at") >= F.lit(lo).cast("timestamp_ntz")) if lo else st
    st = st.where(F.col("measured_at") < F.lit(hi).cast("timestamp_ntz")) if hi else st
    d = dims.dim_cities(st, cfg, countries, tie="event_id")
    return d.withColumn("loaded_at", F.lit(now).cast("timestamp_ntz")) \
            .withColumn("updated_at", F.lit(now).cast("timestamp_ntz"))


@query("scd1_merge")
def q_scd1_merge(spark, sf):
    cfg = _cfg(spark, sf)
    countries = _countries(spark, sf, cfg)
    target = _city_load(spark, sf, None, SPLIT_DAY, RUN1_NOW, cfg, countries)
    source = _city_load(spark, sf, SPLIT_DAY, None, RUN2_NOW, cfg, countries).drop("loaded_at", "updated_at")
    return writes.scd1_merge(target, source, "city_name", CITY_ATTRS,
                             F.lit(RUN2_NOW).cast("timestamp_ntz"))


@query("insert_absent")
def q_insert_absent(spark, sf):
    o = S.table(spark, sf, "orders")
    target = o.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    new = o.where(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")) \
           .withColumn("o_orderstatus", F.lit("X"))
    return writes.insert_absent(target, new, ["o_orderkey"])


@query("replace_range")
def q_replace_range(spark, sf):
    ev = S.table(spark, sf, "events")
    partial = facts.daily_rollup(S.events_as_stage(ev.where(F.col("event_type") != "error")), _cities(spark, sf))
    fresh = facts.daily_rollup(S.events_as_stage(ev), _cities(spark, sf), *WINDOW)
    return writes.replaced(partial, fresh, "date_id", *WINDOW, kind="date_id")


ASSIGN_SPLIT = "2024-01-02"        # names first seen from this day on get new ids


@query("assign_ids")
def q_assign_ids(spark, sf):
    from pyspark.sql import Window
    st = _stage(spark, sf)
    split = F.lit(ASSIGN_SPLIT).cast("timestamp_ntz")
    old = st.where(F.col("measured_at") < split).select(F.col("location_name").alias("city_name")).distinct()
    target = old.select("city_name", F.row_number().over(Window.orderBy("city_name")).alias("id"))
    names = st.where(F.col("measured_at") >= split).select(F.col("location_name").alias("city_name"))
    return writes.assign_ids(target, names, "city_name", "id")


# ---------------------------------------------------------------------------
# mart
# ---------------------------------------------------------------------------
def _fact(spark, sf):
    return facts.daily_rollup(_stage(spark, sf), _cities(spark, sf))


def _mart(spark, sf):
    # codes outside the list have no description; the mart's left join gives NULL for them
    return mart.daily_mart(_fact(spark, sf), dims.dim_calendar(spark), G.wmo_codes(spark))


@query("daily_mart")
def q_daily_mart(spark, sf):
    return _mart(spark, sf)


@query("daily_mart_wide")
def q_daily_mart_wide(spark, sf):
    cfg = _cfg(spark, sf)
    countries = _countries(spark, sf, cfg)
    cities = dims.dim_cities(_stage(spark, sf), cfg, countries, tie="event_id")
    cities = cities.join(_cities(spark, sf), "city_name", "inner")
    return mart.daily_mart_wide(_mart(spark, sf), cities, countries)


# ---------------------------------------------------------------------------
# control plane
# ---------------------------------------------------------------------------
def _gaps(spark, sf):
    return control.date_gaps(_log(spark, sf), _cities(spark, sf), start="2024-01-01", today=TODAY)


@query("date_gaps")
def q_date_gaps(spark, sf):
    return _gaps(spark, sf)


@query("missing_days")
def q_missing_days(spark, sf):
    return control.missing_days_per_city(_gaps(spark, sf), "stage")


@query("top_gaps")
def q_top_gaps(spark, sf):
    return _gaps(spark, sf).orderBy("missing_date", "city_name", "layer").limit(20)


@query("coverage")
def q_coverage(spark, sf):
    from stratus.operators.aggregates import coverage
    return coverage(S.table(spark, sf, "orders"), "o_orderdate", "o_custkey", out="cities")


@query("pending_chunks")
def q_pending_chunks(spark, sf):
    return control.pending_chunks(_log(spark, sf), _cfg(spark, sf), 2023, "2024-01-30")


def _orders_daily(df):
    from stratus.functions.numeric import sum2
    return (df.groupBy("o_custkey", F.to_date("o_orderdate").alias("order_date"))
              .agg(F.count(F.lit(1)).alias("n_orders"), sum2("o_totalprice").alias("total_price")))


def _orders_partial(o):
    return o.where((F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
                   | (F.col("o_orderstatus") == "F"))


ORDERS_TODAY = "2001-08-01"


@query("gap_months")
def q_gap_months(spark, sf):
    o = S.table(spark, sf, "orders")
    up = o.select("o_custkey", F.to_date("o_orderdate").alias("d"))
    down = _orders_daily(_orders_partial(o)).select("o_custkey", F.col("order_date").alias("d"))
    return control.gap_months(up, down, ["o_custkey"], "d", ORDERS_TODAY)


@query("fill_gaps")
def q_fill_gaps(spark, sf):
    o = S.table(spark, sf, "orders")
    down = _orders_daily(_orders_partial(o))
    up_keys = o.select("o_custkey", F.to_date("o_orderdate").alias("d"))
    gaps = control.gap_months(up_keys, down.select("o_custkey", F.col("order_date").alias("d")),
                              ["o_custkey"], "d", ORDERS_TODAY)
    return control.fill_gaps(o, down, _orders_daily, gaps, "order_date", up_day="o_orderdate")


@query("load_status")
def q_load_status(spark, sf):
    return control.load_status(_log(spark, sf))


@query("incomplete_days")
def q_incomplete_days(spark, sf):
    return control.incomplete_days(_log(spark, sf))


@query("run_summary")
def q_run_summary(spark, sf):
    phase = F.when(F.col("layer") == "core", "incremental").otherwise("backfill")
    return control.run_ok(_log(spark, sf).withColumn("phase", phase), by=("run_date", "city_name"), phase="phase")


@query("constraint_checks")
def q_constraint_checks(spark, sf):
    li, o = S.table(spark, sf, "lineitem"), S.table(spark, sf, "orders")
    c, n = S.table(spark, sf, "customer"), S.table(spark, sf, "nation")
    return checks.constraint_report([
        ("lineitem_pk", checks.check_unique(li, ["l_orderkey", "l_linenumber"])),
        ("orders_pk", checks.check_unique(o, ["o_orderkey"])),
        ("lineitem_fk_orders", checks.check_fk(li, ["l_orderkey"], o, ["o_orderkey"])),
        ("orders_fk_customer", checks.check_fk(o, ["o_custkey"], c, ["c_custkey"])),
        ("customer_fk_nation", checks.check_fk(c, ["c_nationkey"], n, ["n_nationkey"])),
    ], checks.row_report(li, {"lineitem_not_null": checks.null_in(["l_orderkey", "l_linenumber", "l_shipdate"]),
                              "lineitem_returnflag_in": checks.outside("l_returnflag", ["R", "A", "N"])}),
        checks.row_report(o, {"orders_status_in": checks.outside("o_orderstatus", ["F"])}))


# ---------------------------------------------------------------------------
# forecast (orders as a 1995–2001 daily history per nation)
# ---------------------------------------------------------------------------
from stratus.functions.dates import date_from_id  # noqa: E402
from stratus.operators import forecast as FC  # noqa: E402
from stratus.operators import measures as M  # noqa: E402

RUN_DATE = "2001-08-02"      # day after the last order
HOLDOUT_RUN = "2001-07-26"   # a run a week earlier, scored against the held-out week


def _nation_mart(spark, sf):
    o = S.table(spark, sf, "orders")
    c = S.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    st = S.orders_as_stage(o.join(c, o["o_custkey"] == c["c_custkey"], "inner"), place="nation")
    places = S.table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("id"),
                                                 S.place_name(F.col("n_nationkey")).alias("city_name"))
    fact = facts.daily_rollup(st, places)
    return mart.to_mart_names(fact).withColumn("date", date_from_id("date_id"))


def _linear(spark, sf, run, until=None):
    long = FC.melt_metrics(FC.history(_nation_mart(spark, sf), run, until=until))
    return FC.forecast_linear(long, run)


@query("forecast_linear")
def q_forecast_linear(spark, sf):
    return FC.pivot_forecast(_linear(spark, sf, RUN_DATE), RUN_DATE)


@query("forecast_seasonal")
def q_forecast_seasonal(spark, sf):
    long = FC.melt_metrics(FC.history(_nation_mart(spark, sf), RUN_DATE))
    fitted = FC.forecast_seasonal(long, RUN_DATE)
    return FC.pivot_forecast(fitted.where(F.col("status") == "ok"), RUN_DATE)


@query("forecast_skips")
def q_forecast_skips(spark, sf):
    """Nations (numbered below zero) have long histories, customers short ones or none at all."""
    nations = _nation_mart(spark, sf).withColumn("city_id", -1 - F.col("city_id"))
    long = FC.melt_metrics(FC.history(nations, RUN_DATE)).unionByName(
        FC.melt_metrics(FC.history(_orders_mart(spark, sf), RUN_DATE)))
    places = S.table(spark, sf, "nation").select((-1 - F.col("n_nationkey").cast("long")).alias("city_id")).unionByName(
        _cities(spark, sf).select(F.col("id").cast("long").alias("city_id")))
    return FC.forecast_skips(long, places=places)


@query("forecast_accuracy")
def q_forecast_accuracy(spark, sf):
    fc = _linear(spark, sf, HOLDOUT_RUN, until=HOLDOUT_RUN)
    actual = FC.melt_metrics(_nation_mart(spark, sf).where(F.col("date") >= F.lit(HOLDOUT_RUN).cast("date")))
    return FC.forecast_accuracy(fc, actual)


@query("forecast_accuracy_seasonal")
def q_forecast_accuracy_seasonal(spark, sf):
    hist = FC.melt_metrics(FC.history(_nation_mart(spark, sf), HOLDOUT_RUN, until=HOLDOUT_RUN))
    fc = FC.forecast_seasonal(hist, HOLDOUT_RUN).where(F.col("status") == "ok")
    actual = FC.melt_metrics(_nation_mart(spark, sf).where(F.col("date") >= F.lit(HOLDOUT_RUN).cast("date")))
    return FC.forecast_accuracy(fc, actual)


@query("latest_run")
def q_latest_run(spark, sf):
    runs = FC.pivot_forecast(_linear(spark, sf, HOLDOUT_RUN, until=HOLDOUT_RUN), HOLDOUT_RUN) \
             .unionByName(FC.pivot_forecast(_linear(spark, sf, RUN_DATE), RUN_DATE))
    latest = runs.where(F.col("forecast_run_date") == runs.agg(F.max("forecast_run_date")).scalar())
    return latest.orderBy("target_date", "city_id").limit(30)


# ---------------------------------------------------------------------------
# dashboard measures (orders as a daily history per customer)
# ---------------------------------------------------------------------------
def _orders_mart(spark, sf):
    o = S.table(spark, sf, "orders")
    st = S.orders_as_stage(o)
    fact = facts.daily_rollup(st, _cities(spark, sf))
    return mart.daily_mart(fact, dims.dim_calendar(spark), G.wmo_codes(spark))


def _orders_wide(spark, sf):
    cfg = _cfg(spark, sf)
    places = cfg.select(F.col("pos").alias("id"), F.col("name").alias("city_name"), "is_capital",
                        "climate_zone", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
                        F.col("country").alias("_country"))
    countries = _countries(spark, sf, cfg)
    places = joins.lookup_id(places, countries, "_country", "country_name", "id", "country_id").drop("_country")
    return mart.daily_mart_wide(_orders_mart(spark, sf), places, countries)


@query("kpi")
def q_kpi(spark, sf):
    m = _orders_mart(spark, sf)
    return M.kpis(m.withColumn("year", F.year("date")), by=["year"])


@query("kpi_yoy")
def q_kpi_yoy(spark, sf):
    return M.kpis_yoy(_orders_mart(spark, sf))


@query("period_compare")
def q_period_compare(spark, sf):
    return M.period_compare(_orders_mart(spark, sf), "avg_temperature", "quarter")


@query("period_compare_by_city")
def q_period_compare_by_city(spark, sf):
    return M.period_compare(_orders_mart(spark, sf), "total_precipitation", "year", by=["city_id"])


@query("extreme_ranking")
def q_extreme_ranking(spark, sf):
    return M.extreme_ranking(_orders_wide(spark, sf), "hot")


@query("climate_scatter")
def q_climate_scatter(spark, sf):
    return M.climate_scatter(_orders_wide(spark, sf))


@query("map_values")
def q_map_values(spark, sf):
    w = M.slice_by(M.capitals_only(_orders_wide(spark, sf)), start="1998-01-01", end="1998-12-31")
    return M.map_values(w, "total_precipitation")


# ---------------------------------------------------------------------------
# landed payloads, API responses, file-stream ingest
# ---------------------------------------------------------------------------
from stratus.functions.text import is_daily_limit  # noqa: E402
from stratus.sources import payload as P  # noqa: E402

PAYLOAD_VARS = ["temperature_2m", "relative_humidity_2m", "precipitation", "wind_direction_10m",
                "weather_code", "is_day"]
def _field(n):
    return lambda x: x[n]


def landed_documents(stage: DataFrame) -> DataFrame:
    """Stage rows → JSON documents of parallel arrays, one per place and week."""
    rows = stage.select(
        "location_name", "latitude", "longitude", "elevation_m", "timezone", "event_id",
        F.date_trunc("week", "measured_at").alias("_week"),
        F.struct(F.date_format("measured_at", "yyyy-MM-dd'T'HH:mm").alias("time"),
                 *[F.col(v) for v in PAYLOAD_VARS if v not in ("weather_code", "is_day")],
                 F.col("weather_code").cast("string").alias("weather_code"),
                 F.col("is_day").cast("int").cast("string").alias("is_day")).alias("h"))
    docs = rows.groupBy("location_name", "_week").agg(
        F.min("event_id").alias("first_event"),
        F.min_by(F.struct("latitude", "longitude", "elevation_m", "timezone"), F.col("event_id")).alias("g"),
        F.collect_list(F.col("h")).alias("hs"))   # order is free: every array is cut from the same list
    hourly = F.struct(*[F.transform("hs", _field(n)).alias(n) for n in ["time", *PAYLOAD_VARS]])
    doc = F.struct(F.col("location_name").alias("name"), F.lit(None).cast("string").alias("country"),
                   F.col("g.latitude").alias("latitude"), F.col("g.longitude").alias("longitude"),
                   F.col("g.elevation_m").alias("elevation"), F.col("g.timezone").alias("timezone"),
                   hourly.alias("hourly"))
    return docs.select("first_event", F.to_json(doc).alias("doc"))


@query("payload_explode")
def q_payload_explode(spark, sf):
    docs = landed_documents(_stage(spark, sf))
    parsed = docs.select(F.from_json("doc", P.payload_schema(PAYLOAD_VARS)).alias("p")).select("p.*")
    return P.explode_payload(parsed, names=PAYLOAD_VARS).drop("loaded_at")


@query("payload_failed")
def q_payload_failed(spark, sf):
    """Of every five documents one is made ragged, one corrupt, one has an odd time text, one no place name."""
    kind = F.col("first_event") % 5
    doc = (F.when(kind == 1, F.regexp_replace("doc", r'"precipitation":\[', '"precipitation":[0.5,'))
            .when(kind == 2, F.expr("left(doc, length(doc) - 2)"))
            .when(kind == 3, F.regexp_replace("doc", r'"time":\["', '"time":["on '))
            .when(kind == 4, F.regexp_replace("doc", r'"name":"[^"]*",', "")).otherwise(F.col("doc")))
    schema = P.payload_schema(PAYLOAD_VARS).add("_corrupt", "string")
    parsed = landed_documents(_stage(spark, sf)).select(
        F.from_json(doc, schema, {"columnNameOfCorruptRecord": "_corrupt"}).alias("p")).select("p.*")
    bad = P.invalid_payloads(parsed, names=PAYLOAD_VARS)
    name = F.when(F.col("error") == "unreadable document", "unknown").otherwise(F.coalesce("name", F.lit("unknown")))
    return bad.groupBy(name.alias("city_name"), "error").agg(F.count("*").alias("n_documents"))


@query("slice_latest_wins")
def q_slice_latest_wins(spark, sf):
    """Places of even number land every document twice, the second time 10 degrees warmer."""
    from stratus.streaming.ingest import latest_documents
    stage = _stage(spark, sf)
    day = F.to_date("measured_at").alias("day")

    def landed(rows, at):
        return rows.select(*STREAM_COLS, day, F.struct(F.lit(at).alias("at"), F.lit("f").alias("file")).alias("_landed"))

    again = stage.where(F.substring("location_name", -1, 1).cast("int") % 2 == 0) \
                 .withColumn("temperature_2m", F.col("temperature_2m") + 10)
    rows = landed(stage, 1).unionByName(landed(again, 2))
    return latest_documents(rows, ["location_name", "day"]).drop("day")


@query("daily_limit_filter")
def q_daily_limit_filter(spark, sf):
    r = S.responses_from_events(S.table(spark, sf, "events"))
    return r.where(is_daily_limit(F.col("status"), F.col("body")))


STREAM_COLS = ["location_name", "measured_at", "temperature_2m", "precipitation", "weather_code", "event_id"]


@query("stream_ingest")
def q_stream_ingest(spark, sf):
    from stratus.session import scratch_path
    from stratus.streaming import ingest_available, land
    base = scratch_path(spark, "stream-ingest")
    ev = S.table(spark, sf, "events")
    land(ev.withColumn("day", F.to_date("ts")), f"{base}/landing", by="day")
    ingest_available(spark, f"{base}/landing", ev.schema.add("day", "date"), f"{base}/stage",
                     f"{base}/_checkpoint", lambda b: S.events_as_stage(b).select(*STREAM_COLS))
    return spark.read.parquet(f"{base}/stage").select(*STREAM_COLS)


@query("hours_per_day")
def q_hours_per_day(spark, sf):
    return control.hours_per_day(_stage(spark, sf))


@query("gap_view_sql")
def q_gap_view_sql(spark, sf):
    control.register_gap_view(spark, _log(spark, sf), _cities(spark, sf), TODAY, start="2024-01-01")
    return spark.sql("SELECT missing_date, count(*) AS n_gaps, count(DISTINCT city_name) AS n_places "
                     "FROM v_date_gaps WHERE layer = 'core' GROUP BY missing_date")


@query("forecast_linear_last_obs")
def q_forecast_linear_last_obs(spark, sf):
    """The original's anchoring: days after each series' last observation, kept if 1..7 ahead of the run."""
    long = FC.melt_metrics(FC.history(_nation_mart(spark, sf), RUN_DATE))
    return FC.pivot_forecast(FC.forecast_linear(long, RUN_DATE, anchor="last_obs"), RUN_DATE)


# ---------------------------------------------------------------------------
# windows, histories and reruns
# ---------------------------------------------------------------------------
@query("mart_window")
def q_mart_window(spark, sf):
    return mart.daily_mart(_fact(spark, sf), dims.dim_calendar(spark), G.wmo_codes(spark), *WINDOW)


@query("active_places")
def q_active_places(spark, sf):
    from stratus.sources.config import active_cities
    return active_cities(_cfg(spark, sf)).select("name", "country", "pos")


@query("kpi_period")
def q_kpi_period(spark, sf):
    return M.kpis_of_period(_orders_mart(spark, sf), "2000-03-01", "2000-08-31")


@query("months_fully_loaded")
def q_months_fully_loaded(spark, sf):
    """Months of the orders' span in which every day has an order, per status."""
    o = S.table(spark, sf, "orders").select(F.col("o_orderstatus").alias("key"), F.to_date("o_orderdate").alias("day"))
    span = o.groupBy("key").agg(F.min(F.year("day")).alias("y0"), F.max("day").alias("d1"))
    months = span.select("key", F.explode(F.sequence(F.make_date("y0", F.lit(1), F.lit(1)), "d1",
                                                     F.expr("INTERVAL 1 MONTH"))).alias("start"))
    chunks = months.withColumn("end", F.last_day("start"))
    return joins.fully_present(chunks, o, "key", "start", "end", "key", "day")


@query("forecast_history")
def q_forecast_history(spark, sf):
    """Days and rain of every place's forecast history, read from the daily fact."""
    from stratus.sources.scans import history_from_fact
    fact = facts.daily_rollup(S.orders_as_stage(S.table(spark, sf, "orders")), _cities(spark, sf))
    hist = history_from_fact(fact, dims.dim_calendar(spark), _cities(spark, sf), "2000-01-01")
    return hist.groupBy("city_id", "city_name").agg(F.count("*").alias("n_days"), F.min("ds").alias("first_day"),
                                                    F.max("ds").alias("last_day"),
                                                    F.max("precipitation_sum").alias("most_rain"))


@query("forecast_rerun")
def q_forecast_rerun(spark, sf):
    """The forecast table after the same run was appended twice: insert-only, so once."""
    from stratus.session import scratch_path
    path = scratch_path(spark, "forecast-rerun")
    wide = FC.pivot_forecast(_linear(spark, sf, RUN_DATE), RUN_DATE).checkpoint()
    for _ in range(2):
        writes.append_absent_table(spark, path, wide, ["forecast_run_date", "target_date", "city_id"], "forecast_run_date")
    return spark.read.parquet(path).select(*wide.columns)


# ---------------------------------------------------------------------------
# sparse trend changes, simulated bands, rolling origins
# ---------------------------------------------------------------------------
from stratus.functions.numeric import round2  # noqa: E402
from stratus.operators import backtest as BT  # noqa: E402
from stratus.operators import changepoints as CP  # noqa: E402

FIRST_ORIGIN = "2000-07-20"   # 54 weekly runs up to HOLDOUT_RUN


@query("forecast_sparse_trend")
def q_forecast_sparse_trend(spark, sf):
    long = FC.melt_metrics(FC.history(_nation_mart(spark, sf), RUN_DATE))
    return CP.forecast_sparse(long, RUN_DATE).select("city_id", "metric", "target_date", "horizon_days",
                                                     round2(F.col("yhat"), 2).alias("yhat"), "n_active", "status")


def _bands(spark, sf, run):
    hist = FC.melt_metrics(FC.history(_nation_mart(spark, sf), run, until=run), list(CP.K.METRICS_WITH_INTERVAL))
    return CP.simulated_band(CP.forecast_sparse(hist, run))


@query("forecast_simulated_band")
def q_forecast_simulated_band(spark, sf):
    bands = _bands(spark, sf, RUN_DATE)
    return bands.select("city_id", "metric", "target_date", "horizon_days",
                        *(round2(F.col(c), 2).alias(c) for c in ("yhat", "sim_lower", "sim_upper", "yhat_lower", "yhat_upper")))


@query("forecast_band_coverage")
def q_forecast_band_coverage(spark, sf):
    """The simulated band beside the constant one, against the held-out week."""
    actual = FC.melt_metrics(_nation_mart(spark, sf).where(F.col("date") >= F.lit(HOLDOUT_RUN).cast("date")))
    return CP.band_coverage(_bands(spark, sf, HOLDOUT_RUN), actual)


@query("forecast_backtest")
def q_forecast_backtest(spark, sf):
    long = FC.melt_metrics(_nation_mart(spark, sf))
    return BT.backtest(long, FIRST_ORIGIN, HOLDOUT_RUN)


# ---------------------------------------------------------------------------
# day bitmaps, isolated repair, corrections in a stream
# ---------------------------------------------------------------------------
from stratus.operators import daymaps, repair  # noqa: E402


def _order_maps(o):
    return daymaps.month_maps(o, F.col("o_custkey"), F.to_date("o_orderdate"))


@query("layer_gap_bitmaps")
def q_layer_gap_bitmaps(spark, sf):
    """Days that core lacks of the stage, and the mart of core; the stage's bitmaps come in two slices."""
    o = S.table(spark, sf, "orders")
    early = F.col("o_orderdate") < F.lit("1998-01-15").cast("timestamp_ntz")
    stage = daymaps.merge_maps(_order_maps(o.where(early)).unionByName(_order_maps(o.where(~early))))
    core = _order_maps(_orders_partial(o))
    in_mart = _order_maps(_orders_partial(o).where(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz")))
    steps = [daymaps.missing_days(daymaps.missing(up, down)).select(F.lit(step).alias("step"), "place", "missing_date")
             for step, up, down in (("core", stage, core), ("mart", core, in_mart))]
    return steps[0].unionByName(steps[1])


@query("repair_report")
def q_repair_report(spark, sf):
    """Every gap month repaired in a job of its own, but for May 2000, whose recomputation fails."""
    from stratus.session import scratch_path
    path = scratch_path(spark, "repair")
    o = S.table(spark, sf, "orders")
    ym = daymaps.month_key(F.col("order_date"))
    down = _orders_daily(_orders_partial(o)).withColumn("ym", ym)
    writes.rebalanced(down, "ym").write.partitionBy("ym").parquet(path)
    down = spark.read.parquet(path)
    o = o.withColumn("_day", F.to_date("o_orderdate"))
    gaps = daymaps.missing(_order_maps(o), daymaps.month_maps(down, F.col("o_custkey"), F.col("order_date")))

    def work(w: dict) -> None:
        if w["ym"] == 200005:
            raise ValueError("source not available")
        repair.rewrite_month(spark, path, w, down.where(F.col("ym") == w["ym"]), o.where(daymaps.month_key(F.col("_day")) == w["ym"]),
                             _orders_daily, lambda: F.col("order_date"), "_day")

    found = repair.repair_months(spark, daymaps.gap_windows(gaps, ORDERS_TODAY), work, "orders")
    after = spark.read.parquet(path).groupBy("ym").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n_orders").alias("n_orders"))
    return found.join(after, "ym", "left").select("ym", "start_date", "end_date", "status", "error_msg", "n_rows", "n_orders")


@query("stream_corrections")
def q_stream_corrections(spark, sf):
    """Three landings in three micro-batches: all days, a correction (version 3) of even places, then a late older one (2).

    The older version must not overwrite the correction, but it does correct places of number 3, 9, 15, ...
    """
    from stratus.session import scratch_path
    from stratus.streaming import ingest_corrections, land
    base = scratch_path(spark, "stream-corrections")
    ev = S.table(spark, sf, "events")
    even, third = F.col("user_id") % 2 == 0, F.col("user_id") % 3 == 0
    files = ev.rdd.getNumPartitions()   # of a landing, which are one micro-batch
    for version, rows in ((1, ev), (3, ev.where(even)), (2, ev.where(even | third))):
        land(rows.withColumn("version", F.lit(version)).repartition(files), f"{base}/landing")

    def transform(b):
        shifted = b.withColumn("value", F.col("value") + 10 * (F.col("version") - 1))
        return S.events_as_stage(shifted, "version").select(*STREAM_COLS, "version")

    ingest_corrections(spark, f"{base}/landing", ev.schema.add("version", "long"), f"{base}/stage", f"{base}/_checkpoint",
                       transform, max_files=files)
    return spark.read.parquet(f"{base}/stage").select(*STREAM_COLS, "version")


# ---------------------------------------------------------------------------
# general range join, checked writes
# ---------------------------------------------------------------------------
from stratus.operators import quarantine  # noqa: E402


@query("range_join_binned")
def q_range_join_binned(spark, sf):
    """Orders whose price lies in a supplier's price band; bands overlap and are 1 to 40,000 wide."""
    k = F.col("s_suppkey") % 5
    bands = S.table(spark, sf, "supplier").select("s_suppkey", (F.col("s_acctbal") * 20).alias("low"),
                                                  (F.col("s_acctbal") * 20 + F.pow(F.lit(10.0), k) * 4 + 1).alias("high"))
    found = joins.binned_range_join(S.table(spark, sf, "orders"), bands, "o_totalprice", "low", "high", totals={
        "n_orders": (F.count(F.lit(1)), F.sum), "total": (F.sum("o_totalprice"), F.sum), "first_order": (F.min("o_orderkey"), F.min)})
    return found.groupBy("s_suppkey").agg(F.sum("n_orders").alias("n_orders"), round2(F.sum("total"), 2).alias("total"),
                                          F.min("first_order").alias("first_order"))


@query("checked_write")
def q_checked_write(spark, sf):
    """Line items written once: sound and quarantined rows, and how many rows break each check."""
    from stratus.session import scratch_path
    done = quarantine.checked_write(S.table(spark, sf, "lineitem"), scratch_path(spark, "checked"), {
        "quantity_range": F.col("l_quantity") > 45, "discount_range": F.col("l_discount") > F.lit(0.08),
        "flag_not_null": F.col("l_returnflag").isNull(), "flag_in": checks.outside("l_returnflag", ["R", "A"])})
    names = F.explode(F.array(*(F.struct(F.lit(n).alias("what"), F.lit(v).alias("n")) for n, v in done.counts.items()))).alias("c")
    observed = spark.range(1).select(names).select("c.what", F.col("c.n").cast("long").alias("n_rows"), F.lit(None).cast("double").alias("quantity"))
    held = [t.agg(F.count(F.lit(1)).alias("n_rows"), round2(F.sum("l_quantity"), 2).alias("quantity"))
            .select(F.lit(w).alias("what"), "n_rows", "quantity")
            for w, t in (("sound rows", done.good), ("quarantined rows", done.quarantined))]
    return observed.unionByName(held[0]).unionByName(held[1])


# ---------------------------------------------------------------------------
# dashboards from monthly states, slicers, bounded and bucketed tables, open payloads
# ---------------------------------------------------------------------------
from stratus.operators import bounded, partials  # noqa: E402
from stratus.sources import variants  # noqa: E402


def _order_states(spark, sf):
    """States of the orders' mart, refreshed after each of two loads; the second one changes months the first one wrote."""
    from stratus.session import scratch_path
    table, states = scratch_path(spark, "mart"), scratch_path(spark, "mart-states")
    rows = _orders_mart(spark, sf).withColumn("ym", daymaps.month_key(F.col("date")))
    early = F.col("date") < F.lit("1998-05-20").cast("date")
    for load in (rows.where(early), rows.where(~early)):
        writes.append_table(load, table, "ym")
        found, _ = partials.refresh(spark, states, spark.read.schema(rows.schema).parquet(table))
    return found


@query("kpi_from_partials")
def q_kpi_from_partials(spark, sf):
    return M.year_over_year(partials.yearly_kpis(_order_states(spark, sf), M.KPI_NAMES))


@query("map_from_partials")
def q_map_from_partials(spark, sf):
    capitals = M.capitals_only(_cfg(spark, sf)).select(F.col("pos").alias("id"), F.col("name").alias("city_name"),
                                                       F.col("lat").alias("latitude"), F.col("lon").alias("longitude"))
    return partials.map_values(partials.of_months(_order_states(spark, sf), 199801, 199812), capitals, "total_precipitation")


@query("ranking_sliced")
def q_ranking_sliced(spark, sf):
    """Frost ranking of a region's places in one climate group, 1996 to 1999."""
    return M.extreme_ranking(M.slice_by(_orders_wide(spark, sf), "1996-01-01", "1999-12-31", region=SLICE_REGION, zone=SLICE_ZONE), "frost")


@query("partition_report")
def q_partition_report(spark, sf):
    """Orders in bounded year partitions; per year and nation from a join of bucketed tables."""
    from stratus.session import scratch_path
    o = S.table(spark, sf, "orders").select(F.col("o_custkey").alias("place"), F.to_date("o_orderdate").alias("day"), "o_totalprice")
    fact = bounded.write_years(o, scratch_path(spark, "orders-by-year"), "day", 1995, 2001)
    held = bounded.bucketed(spark, fact, "place", 8, "orders_fact")
    places = bounded.bucketed(spark, S.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_nationkey"), "id", 8, "places")
    return (held.join(places, held["place"] == places["id"]).groupBy("year", "c_nationkey")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min("day").alias("first_day"), F.max("day").alias("last_day"),
                 round2(F.sum("o_totalprice")).alias("total")))


@query("payload_variant")
def q_payload_variant(spark, sf):
    """Two variables nobody declared, read from variant documents of a place and day; every seventh place's are cut off."""
    ev = S.table(spark, sf, "events")
    hours = ev.select(S.place_name(F.col("user_id")).alias("name"), F.col("user_id"), F.to_date("ts").alias("_day"),
                      F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"), (F.col("value") / 10 - 10).alias("temperature_2m"),
                               (F.col("value") / 50).alias("uv_index"), F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("sky_note")).alias("h"))
    docs = hours.groupBy("name", "user_id", "_day").agg(F.collect_list("h").alias("hs"))
    hourly = F.struct(*(F.transform("hs", _field(n)).alias(n) for n in ("time", "temperature_2m", "uv_index", "sky_note")))
    doc = F.to_json(F.struct("name", hourly.alias("hourly")))
    cut = docs.select("user_id", doc.alias("_doc")).select(
        F.when(F.col("user_id") % 7 == 3, F.expr("left(_doc, length(_doc) - 2)")).otherwise(F.col("_doc")).alias("doc"))
    rows = variants.read_variables(variants.land_variant(cut), {"uv_index": "double", "sky_note": "string"})
    return rows.groupBy("location_name", F.to_date("measured_at").alias("day")).agg(
        F.count(F.lit(1)).alias("n_hours"), F.count("uv_index").alias("n_uv"), F.max("uv_index").alias("max_uv"),
        F.min("uv_index").alias("min_uv"), F.count("sky_note").alias("n_notes"), F.max("sky_note").alias("last_note"))
