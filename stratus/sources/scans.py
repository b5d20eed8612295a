"""Windowed scans with predicates that reach the Parquet reader."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.functions.dates import as_date_lit, date_id


def in_window(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Rows whose ``CAST(ts AS DATE)`` lies in [start, end].

    Written as a half-open timestamp range so the predicate is a plain column
    comparison the Parquet reader can use for row-group skipping.
    """
    c = F.col(ts)
    lo = as_date_lit(start)
    hi = F.date_add(as_date_lit(end), 1)
    dtype = dict(df.dtypes).get(ts, "")
    if dtype == "date":
        return df.where(c.between(lo, as_date_lit(end)))
    cast_to = "timestamp_ntz" if dtype == "timestamp_ntz" else "timestamp"
    return df.where((c >= lo.cast(cast_to)) & (c < hi.cast(cast_to)))


def scan_window(df: DataFrame, ts: str, start, end, part_col: str | None = None,
                part_kind: str = "ym") -> DataFrame:
    """``in_window`` plus an implied predicate on a partition column for static pruning.

    ``part_kind='ym'`` means an integer YYYYMM partition, ``'date_id'`` a YYYYMMDD key,
    ``'date'`` a DATE partition (e.g. ``day``).
    """
    out = in_window(df, ts, start, end)
    if part_col:
        lo, hi = as_date_lit(start), as_date_lit(end)
        if part_kind == "date":
            out = out.where(F.col(part_col).between(lo, hi))
        elif part_kind == "ym":
            out = out.where(F.col(part_col).between(F.year(lo) * 100 + F.month(lo),
                                                    F.year(hi) * 100 + F.month(hi)))
        else:
            out = out.where(F.col(part_col).between(date_id(lo), date_id(hi)))
    return out


def successes(log: DataFrame, layer: str = "stage") -> DataFrame:
    """Distinct successful (city_name, run_date) pairs of one layer."""
    return (log.where((F.col("layer") == layer) & (F.col("status") == "success"))
               .select("city_name", "run_date").distinct())


def history_from_fact(daily: DataFrame, calendar: DataFrame, cities: DataFrame, cutoff) -> DataFrame:
    """Forecast history: daily fact ⋈ calendar ⋈ place dimension, ``date >= cutoff``,
    with the forecast's column names (city_id, city_name, ds, 8 metrics)."""
    cal = calendar.select(F.col("id").alias("_cid"), F.col("date").alias("ds"))
    cal = cal.where(F.col("ds") >= as_date_lit(cutoff))
    c = cities.select(F.col("id").alias("_pid"), "city_name")
    f = daily.where(F.col("date_id") >= date_id(as_date_lit(cutoff)))   # implied predicate: prunes the fact
    j = f.join(F.broadcast(cal), f["date_id"] == cal["_cid"], "inner").join(c, f["city_id"] == c["_pid"], "inner")
    return j.select(F.col("city_id"), "city_name", "ds", "temp_avg", "temp_min", "temp_max", "precipitation_sum",
                    F.col("sunshine_duration_hours").alias("sunshine_hours"),
                    F.col("avg_relative_humidity").alias("humidity_avg"),
                    F.col("avg_pressure_msl").alias("pressure_avg"),
                    F.col("avg_wind_speed_10m").alias("wind_speed_avg"))
