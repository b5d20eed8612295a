"""Hourly and daily fact builders.

Daily plan: window scan (pushed to Parquet) → partial aggregate per (day, place) →
shuffle on (day, place) → final aggregate → join the place dimension. Aggregating
before the join is equivalent because place names are unique in the dimension
(rows of unknown places are dropped either way), and it joins 24× fewer rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions import constants as K
from stratus.functions.dates import date_id, time_id
from stratus.functions.numeric import round2
from stratus.operators.aggregates import dominant, measure_exprs
from stratus.operators.joins import band_lookup
from stratus.sources.scans import in_window

# (output column, aggregate kind, stage column) — the daily fact's measures.
DAILY_MEASURES = [
    ("temp_avg", "avg2", "temperature_2m"),
    ("temp_min", "min", "temperature_2m"),
    ("temp_max", "max", "temperature_2m"),
    ("apparent_temp_avg", "avg2", "apparent_temperature"),
    ("apparent_temp_min", "min", "apparent_temperature"),
    ("apparent_temp_max", "max", "apparent_temperature"),
    ("wet_bulb_temp_avg", "avg2", "wet_bulb_temperature_2m"),
    ("precipitation_sum", "sum2", "precipitation"),
    ("rain_sum", "sum2", "rain"),
    ("snowfall_sum", "sum2", "snowfall"),
    ("sunshine_duration_hours", "hours", "sunshine_duration"),
    ("shortwave_radiation_avg", "avg2", "shortwave_radiation"),
    ("avg_wind_speed_10m", "avg2", "wind_speed_10m"),
    ("max_wind_speed_10m", "max", "wind_speed_10m"),
    ("max_wind_gusts", "max", "wind_gusts_10m"),
    ("avg_cloud_cover", "avg2", "cloud_cover"),
    ("avg_relative_humidity", "avg2", "relative_humidity_2m"),
    ("avg_pressure_msl", "avg2", "pressure_msl"),
]

DAILY_FLAGS = ["is_frost_day", "is_hot_day", "is_rainy_day", "is_snowy_day"]


def day_flags(tmin: Column, tmax: Column, rain: Column, snow: Column) -> list[Column]:
    """Three-valued threshold flags on *unrounded* aggregates (all-NULL day → NULL)."""
    return [
        (tmin < K.FROST_BELOW).alias("is_frost_day"),
        (tmax >= K.HOT_FROM).alias("is_hot_day"),
        (rain >= K.RAINY_FROM).alias("is_rainy_day"),
        (snow > K.SNOWY_ABOVE).alias("is_snowy_day"),
    ]


_CODE_MAX = 32767        # codes are SMALLINT: 32767 - code lies in [0, 65535]
_CODE_SPAN = 1 << 17


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b)


def daily_rollup(stage: DataFrame, cities: DataFrame, start=None, end=None, *,
                 ts: str = "measured_at", loc: str = "location_name", code: str = "weather_code",
                 city_name: str = "city_name", city_id: str = "id",
                 measures=DAILY_MEASURES, flags: bool = True, now=None, dominant_via: str = "mode") -> DataFrame:
    """Stage hours → one row per (date_id, city_id): dominant code, measures, flags.

    ``start``/``end`` bound the window (inclusive dates) and are pushed to the scan.
    ``now`` (optional) stamps ``loaded_at``; leave it out for comparable output.

    ``dominant_via='mode'`` (default): one aggregate per (day, place); ``mode`` keeps a
    small count map per group and combines map-side. ``'packed'``: two fixed-width hash
    aggregates — (day, place, code) then (day, place) — with the dominant code as the
    maximum of (count, -code) packed into one long. Measured on 10M stage rows with
    ~40 distinct codes per (day, place) the single ``mode`` aggregate was faster
    (15 s vs 23 s), because the first level barely reduces; ``packed`` pays off when a
    day has many rows but few codes (24 hours, a handful of weather codes).
    Either way a hot place is combined map-side, never gathered into one task.
    """
    src = stage if start is None else in_window(stage, ts, start, end)
    if dominant_via == "mode":
        return _rollup_mode(src, cities, ts, loc, code, city_name, city_id, measures, flags, now)
    need: dict[tuple[str, str], str] = {}      # (buffer fn, column) -> level-1 alias

    def buf(fn: str, col: str) -> str:
        return need.setdefault((fn, col), f"_{fn}_{len(need)}")

    plan = []
    for out, kind, col in measures:
        if kind in ("avg2", "avg"):
            plan.append((out, kind, buf("sum", col), buf("cnt", col)))
        elif kind in ("sum2", "sum", "hours"):
            plan.append((out, kind, buf("sum", col), None))
        elif kind in ("min", "max"):
            plan.append((out, kind, buf(kind, col), None))
        elif kind == "count":
            plan.append((out, kind, buf("cnt", col), None))
    if flags:
        fl = [buf("min", "temperature_2m"), buf("max", "temperature_2m"),
              buf("sum", "precipitation"), buf("sum", "snowfall")]
    l1fn = {"sum": F.sum, "cnt": F.count, "min": F.min, "max": F.max}
    level1 = (src.groupBy(F.to_date(F.col(ts)).alias("_day"), F.col(loc).alias("_loc"), F.col(code).alias("_code"))
                 .agg(F.count(F.lit(1)).alias("_n"), *[l1fn[fn](F.col(c)).alias(a) for (fn, c), a in need.items()]))
    l2fn = {"sum": F.sum, "cnt": F.sum, "min": F.min, "max": F.max}
    # dominant code = max over one packed long (count, 32767 - code): most frequent, then
    # smallest; a primitive buffer keeps level 2 a codegen'd HashAggregate
    code_c = F.col("_code").cast("long")
    packed = F.when(code_c.isNotNull(), F.col("_n") * F.lit(_CODE_SPAN) + (F.lit(_CODE_MAX) - code_c))
    aggs = [F.max(packed).alias("_dom")]
    aggs += [l2fn[fn](F.col(a)).alias(a) for (fn, _c), a in need.items()]
    daily = level1.groupBy("_day", "_loc").agg(*aggs)
    outs = []
    for out, kind, a, b in plan:
        if kind == "avg2":
            outs.append(round2(_safe_div(F.col(a), F.col(b))).alias(out))
        elif kind == "avg":
            outs.append(_safe_div(F.col(a), F.col(b)).alias(out))
        elif kind == "sum2":
            outs.append(round2(F.col(a)).alias(out))
        elif kind == "hours":
            outs.append(round2(F.col(a) / F.lit(3600.0)).alias(out))
        else:
            outs.append(F.col(a).alias(out))
    dim = cities.select(F.col(city_name).alias("_loc"), F.col(city_id).alias("city_id"))
    j = daily.join(dim, "_loc", "inner")
    dom = (F.lit(_CODE_MAX) - F.col("_dom") % F.lit(_CODE_SPAN)).cast("smallint")
    cols = [date_id(F.col("_day")).alias("date_id"), F.col("city_id"), dom.alias("dominant_weather_code_id"), *outs]
    if flags:
        cols += day_flags(*[F.col(a) for a in fl])
    if now is not None:
        cols.append(F.lit(now).cast("timestamp_ntz").alias("loaded_at"))
    return j.select(*cols)


def _rollup_mode(src, cities, ts, loc, code, city_name, city_id, measures, flags, now) -> DataFrame:
    aggs = [dominant(code).cast("smallint").alias("dominant_weather_code_id"), *measure_exprs(measures)]
    if flags:
        aggs += [F.min("temperature_2m").alias("_tmin"), F.max("temperature_2m").alias("_tmax"),
                 F.sum("precipitation").alias("_rain"), F.sum("snowfall").alias("_snow")]
    daily = src.groupBy(F.to_date(F.col(ts)).alias("_day"), F.col(loc).alias("_loc")).agg(*aggs)
    dim = cities.select(F.col(city_name).alias("_loc"), F.col(city_id).alias("city_id"))
    j = daily.join(dim, "_loc", "inner")
    cols = [date_id(F.col("_day")).alias("date_id"), F.col("city_id"), F.col("dominant_weather_code_id"),
            *[F.col(m[0]) for m in measures]]
    if flags:
        cols += day_flags(F.col("_tmin"), F.col("_tmax"), F.col("_rain"), F.col("_snow"))
    if now is not None:
        cols.append(F.lit(now).cast("timestamp_ntz").alias("loaded_at"))
    return j.select(*cols)


HOURLY_EXCLUDE = ("weather_code", "wind_direction_10m", "wind_direction_100m")


def hourly_fact(stage: DataFrame, cities: DataFrame, bands: DataFrame, start=None, end=None, *,
                ts: str = "measured_at", loc: str = "location_name",
                city_name: str = "city_name", city_id: str = "id", now=None) -> DataFrame:
    """Stage hours → hourly fact with date/time/place/code/compass keys.

    Measures are the stage's hourly variables (those present) minus the code and the
    two wind directions, which become compass band ids via :func:`band_lookup`.
    """
    src = stage if start is None else in_window(stage, ts, start, end)
    dim = cities.select(F.col(city_name).alias("_loc"), F.col(city_id).alias("city_id"))
    j = src.join(dim, src[loc] == dim["_loc"], "inner")
    if "wind_direction_10m" in stage.columns:
        j = band_lookup(j, "wind_direction_10m", bands, "wind_dir_10m_id")
    if "wind_direction_100m" in stage.columns:
        j = band_lookup(j, "wind_direction_100m", bands, "wind_dir_100m_id")
    measures = [v for v in K.HOURLY_VARS if v in stage.columns and v not in HOURLY_EXCLUDE]
    cols = [date_id(F.col(ts)).alias("date_id"), time_id(F.col(ts)).alias("time_id"), F.col("city_id"),
            F.col("weather_code").cast("smallint").alias("weather_code_id")]
    for c in ("wind_dir_10m_id", "wind_dir_100m_id"):
        if c in j.columns:
            cols.append(F.col(c).cast("smallint").alias(c))
    cols += [F.col(m) for m in measures]
    if now is not None:
        cols.append(F.lit(now).cast("timestamp_ntz").alias("loaded_at"))
    return j.select(*cols)
