"""Daily mart (narrow, 18 columns) and its denormalised wide form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.functions.dates import as_date_lit, date_id

# daily fact column → mart column
MART_RENAMES = {
    "sunshine_duration_hours": "sunshine_hours",
    "avg_wind_speed_10m": "wind_speed_avg",
    "max_wind_gusts": "wind_gusts_max",
    "avg_relative_humidity": "humidity_avg",
    "avg_pressure_msl": "pressure_avg",
}

MART_MEASURES = ["temp_avg", "temp_min", "temp_max", "apparent_temp_avg", "precipitation_sum",
                 "snowfall_sum", "sunshine_hours", "wind_speed_avg", "wind_gusts_max",
                 "humidity_avg", "pressure_avg"]
MART_FLAGS = ["is_frost_day", "is_hot_day", "is_rainy_day", "is_snowy_day"]


def to_mart_names(daily: DataFrame) -> DataFrame:
    return daily.withColumnsRenamed({k: v for k, v in MART_RENAMES.items() if k in daily.columns})


def daily_mart(fact: DataFrame, calendar: DataFrame, codes: DataFrame, start=None, end=None) -> DataFrame:
    """fact ⋈ calendar (date) ⟕ weather codes (description) → 18-column mart.

    The calendar is a bounded table (one row per day of its span) and is broadcast;
    the implied ``date_id BETWEEN`` is added so a partitioned fact is pruned.
    The code table is a dimension of at most a few hundred codes and is broadcast too.
    """
    f = to_mart_names(fact)
    cal = calendar.select(F.col("id").alias("_cid"), F.col("date"))
    if start is not None:
        f = f.where(F.col("date_id").between(date_id(as_date_lit(start)), date_id(as_date_lit(end))))
        cal = cal.where(F.col("date").between(as_date_lit(start), as_date_lit(end)))
    j = f.join(F.broadcast(cal), f["date_id"] == cal["_cid"], "inner")
    wc = F.broadcast(codes.select(F.col("id").alias("_wid"), F.col("description").alias("weather_description")))
    j = j.join(wc, j["dominant_weather_code_id"] == wc["_wid"], "left")
    return j.select("date", "city_id", "weather_description", *MART_MEASURES, *MART_FLAGS)


def daily_mart_wide(mart: DataFrame, cities: DataFrame, countries: DataFrame) -> DataFrame:
    """Mart plus place/country attributes used by the dashboards.

    ``cities`` needs (id, city_name, is_capital, climate_zone, country_id, latitude, longitude);
    ``countries`` needs (id, country_name, region).
    """
    c = cities.select(F.col("id").alias("_city"), "city_name", "is_capital", "climate_zone",
                      "country_id", "latitude", "longitude")
    n = countries.select(F.col("id").alias("_cty"), "country_name", "region")
    j = mart.join(c, mart["city_id"] == c["_city"], "left")
    j = j.join(n, j["country_id"] == n["_cty"], "left")
    return j.drop("_city", "_cty", "country_id")
