"""Dimension builders: calendar, time of day, weather codes, countries, places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.functions import dates as D
from stratus.operators.joins import lookup_id
from stratus.operators.windows import first_per_key, latest_per_key
from stratus.sources.generators import date_series, day_sequence, minute_series


def calendar_columns(d: Column) -> list[Column]:
    """The 12 calendar attributes of a date column."""
    return [
        D.date_id(d).alias("id"),
        d.alias("date"),
        F.year(d).cast("smallint").alias("year"),
        F.quarter(d).cast("smallint").alias("quarter"),
        F.month(d).cast("smallint").alias("month"),
        D.month_name(d).alias("month_name"),
        D.iso_week(d).alias("week_of_year"),
        F.dayofmonth(d).cast("smallint").alias("day"),
        D.iso_dow(d).alias("day_of_week"),
        D.day_name(d).alias("day_name"),
        D.is_weekend(d).alias("is_weekend"),
        D.is_leap_year(d).alias("is_leap_year"),
    ]


def dim_calendar(spark: SparkSession, start="1950-01-01", end="2050-12-31") -> DataFrame:
    """One row per day in [start, end] (36,890 rows for the default span)."""
    ds = date_series(spark, start, end, "d")
    return ds.select(*calendar_columns(F.col("d")))


def calendar_span(df: DataFrame, col: str) -> DataFrame:
    """Calendar rows covering [min(col), max(col)] of a table — bounds computed by Spark."""
    span = df.agg(F.min(F.to_date(F.col(col))).alias("_a"), F.max(F.to_date(F.col(col))).alias("_b"))
    days = span.select(F.explode(day_sequence(F.col("_a"), F.col("_b"))).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


def time_columns(ts: Column) -> list[Column]:
    """Time-of-day attributes of a timestamp (id = HHMM)."""
    return [
        D.time_id(ts).alias("id"),
        F.date_format(ts, "HH:mm:ss").alias("time_value"),
        F.hour(ts).cast("smallint").alias("hour_24h"),
        D.hour12(ts).alias("hour_12h"),
        F.minute(ts).cast("smallint").alias("minute"),
        D.am_pm(ts).alias("am_pm"),
        D.time_24h(ts).alias("time_24h"),
        D.time_12h(ts).alias("time_12h"),
        D.part_of_day(ts).alias("part_of_day"),
    ]


def dim_time(spark: SparkSession) -> DataFrame:
    """1,440 rows, one per minute of the day."""
    return minute_series(spark, "ts").select(*time_columns(F.col("ts")))


def time_attributes(df: DataFrame, ts: str, keep=()) -> DataFrame:
    """Attach the time-of-day attributes to every row of a table."""
    return df.select(*keep, *time_columns(F.col(ts)))


def dim_weather_code(seed: DataFrame, stage: DataFrame, code: str = "weather_code") -> DataFrame:
    """Seeded codes plus every non-NULL stage code not yet known (attributes NULL).

    Insert-if-absent: the seed's descriptions win over discovered codes.
    """
    found = stage.where(F.col(code).isNotNull()).select(F.col(code).cast("smallint").alias("id")).distinct()
    # the code table is keyed by a SMALLINT, so it can never exceed 65,536 rows: broadcast
    new = found.join(F.broadcast(seed.select("id")), "id", "left_anti")
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in seed.schema.fields if f.name != "id"]
    return seed.unionByName(new.select("id", *extra))


COUNTRY_ATTRS = ["country_iso2", "country_iso3", "continent", "region"]


def dim_countries(cities_cfg: DataFrame) -> DataFrame:
    """One row per country: attributes of the *first* config record of that country.

    Inactive places count too. (country_name, iso_code_2, iso_code_3, continent, region).
    """
    first = first_per_key(cities_cfg, "country", "pos", COUNTRY_ATTRS)
    return first.select(F.col("country").alias("country_name"),
                        F.col("country_iso2").alias("iso_code_2"),
                        F.col("country_iso3").alias("iso_code_3"),
                        "continent", "region")


GEO = ["latitude", "longitude", "elevation_m", "timezone"]


def dim_cities(stage: DataFrame, cities_cfg: DataFrame, countries: DataFrame, *,
               loc: str = "location_name", loaded: str = "loaded_at", tie: str | None = None,
               country_id: str = "id", existing: DataFrame | None = None) -> DataFrame:
    """Place dimension: latest stage geo per place, enriched from config by name.

    Places missing from the config keep NULL capital/climate/country. With ``existing``
    (the current dimension) only the new stage rows need to be passed: places not in
    them keep their stored geo and are re-enriched from the current config, so a run
    never rescans the whole stage history.
    """
    latest = latest_per_key(stage, loc, loaded, GEO, tie=tie)
    if existing is not None:
        kept = (existing.select(F.col("city_name").alias(loc), *GEO)
                        .join(latest.select(loc), loc, "left_anti"))
        latest = latest.unionByName(kept)
    cfg = cities_cfg.select(F.col("name").alias("_name"), "is_capital", "climate_zone",
                            F.col("country").alias("_country"))
    j = latest.join(cfg, latest[loc] == cfg["_name"], "left").drop("_name")
    j = lookup_id(j, countries, "_country", "country_name", country_id, "country_id").drop("_country")
    return j.select(F.col(loc).alias("city_name"), *GEO, "is_capital", "climate_zone", "country_id")
