"""Bindings of the warehouse's inputs to the driver's tables.

The driver's tables are not weather data, so each warehouse input is *derived* from
them by a fixed column mapping (every row kept, nothing sampled):

- ``events``   → hourly stage: place = user, hour = ``ts``, code = ``props.k``, and the
  measures are affine maps of ``value``/``k``; also the load log and API responses.
- ``orders``   → a long daily history: place = customer or nation, day = order date.
- ``customer`` ⋈ ``nation`` ⋈ ``region`` → the place config and country dimension.

The SQL oracle repeats the same mapping (see ``stratus.plans.oracle``), so both sides
compute from identical inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES — stand-in mappings (our decision, mirrored in the SQL oracle).
# ---------------------------------------------------------------------------
SEGMENT_CLIMATE = {
    "AUTOMOBILE": "Cfb",
    "BUILDING": "Dfb",
    "FURNITURE": "Csa",
    "HOUSEHOLD": "Bsk",
    "MACHINERY": "ET",
}
RESPONSE_BODIES = {
    "error": '{"reason": "Daily API request limit exceeded"}',
    "signup": '{"error": true}',
    "purchase": "Daily quota exceeded",
    "click": '{"reason": "Minutely API request limit exceeded"}',
    "view": "daily limit reached",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def place_name(user_col: Column) -> Column:
    """Place name of a user/customer key: ``Customer#000000042``."""
    return F.concat(F.lit("Customer#"), F.lpad(user_col.cast("string"), 9, "0"))


def _k() -> Column:
    return F.get_json_object(F.col("props"), "$.k").cast("int")


def events_as_stage(events: DataFrame, *extra: str) -> DataFrame:
    """``events`` → stage rows (location, hour, 17 measures, code, is_day, loaded_at) and the columns ``extra``."""
    v = F.col("value")
    k = _k()
    et = F.col("event_type")
    return events.select(
        place_name(F.col("user_id")).alias("location_name"),
        F.lit(None).cast("string").alias("country"),
        ((k - 50) * 1.5).cast("double").alias("latitude"),
        (v - 180).alias("longitude"),
        (k * 10.0).cast("double").alias("elevation_m"),
        F.lit("UTC").alias("timezone"),
        F.col("ts").alias("measured_at"),
        (v / 10 - 10).alias("temperature_2m"),
        k.cast("double").alias("relative_humidity_2m"),
        (v / 10 - 12).alias("apparent_temperature"),
        F.when(et == "error", v / 100).otherwise(F.lit(0.0)).alias("precipitation"),
        F.when(et == "error", v / 200).otherwise(F.lit(0.0)).alias("rain"),
        F.when(et == "signup", v / 1000).otherwise(F.lit(0.0)).alias("snowfall"),
        (v / 10 + 1000).alias("pressure_msl"),
        k.cast("double").alias("cloud_cover"),
        (v / 5).alias("wind_speed_10m"),
        v.alias("wind_direction_10m"),
        (v * 0.75).alias("wind_direction_100m"),
        (v / 4).alias("wind_gusts_10m"),
        v.alias("shortwave_radiation"),
        (v * 10).alias("sunshine_duration"),
        k.cast("smallint").alias("weather_code"),
        (v / 10 - 13).alias("wet_bulb_temperature_2m"),
        F.hour("ts").between(6, 17).alias("is_day"),
        F.col("ts").alias("loaded_at"),
        F.col("event_id"),
        *extra,
    )


def cities_config(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Place config records from customers (list position = customer key)."""
    seg = F.create_map(*[x for kv in SEGMENT_CLIMATE.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    n = nation.select("n_nationkey", "n_name", "n_regionkey")
    r = region.select("r_regionkey", "r_name")
    c = customer.join(n, customer["c_nationkey"] == n["n_nationkey"], "left") \
                .join(r, F.col("n_regionkey") == r["r_regionkey"], "left")
    return c.select(
        F.col("c_name").alias("name"),
        (F.col("c_acctbal") / 100).alias("lat"),
        (F.col("c_acctbal") / 50).alias("lon"),
        F.lit("UTC").alias("tz"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country_iso2"),
        F.concat(F.lit("NAT"), F.col("c_nationkey").cast("string")).alias("country_iso3"),
        F.col("r_name").alias("continent"),
        F.col("c_mktsegment").alias("region"),
        (F.col("c_acctbal") > 5000).alias("is_capital"),
        seg[F.col("c_mktsegment")].alias("climate_zone"),
        (F.col("c_acctbal") > 0).alias("active"),
        F.col("c_custkey").alias("pos"),
    )


def cities_dim(customer: DataFrame) -> DataFrame:
    """A minimal place dimension (id, city_name) keyed by customer."""
    return customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("city_name"))


def load_log_from_events(events: DataFrame) -> DataFrame:
    """One load-log attempt per event: layer/status/rows derived from the event."""
    et = F.col("event_type")
    k = _k()
    failed = et == "error"
    return events.select(
        F.to_date("ts").alias("run_date"),
        place_name(F.col("user_id")).alias("city_name"),
        F.when(et.isin("view", "click"), F.lit("core")).otherwise(F.lit("stage")).alias("layer"),
        F.when(failed, F.lit("failed")).otherwise(F.lit("success")).alias("status"),
        F.when(failed, F.lit(None).cast("int")).otherwise(F.lit(20) + k % 6).alias("rows_loaded"),
        F.lit(24).alias("expected_rows"),
        F.col("ts").alias("executed_at"),
        F.when(failed, F.concat(F.lit("HTTP error "), k.cast("string"))).alias("error_msg"),
        F.col("event_id").alias("id"),
    )


def responses_from_events(events: DataFrame) -> DataFrame:
    """Landed API responses (id, status, body): status 400+k, body chosen by event type."""
    body = F.create_map(*[x for kv in RESPONSE_BODIES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return events.select(F.col("event_id").alias("id"), (F.lit(400) + _k()).alias("status"),
                         body[F.col("event_type")].alias("body"))


def orders_as_stage(orders: DataFrame, place: str = "customer") -> DataFrame:
    """``orders`` → daily stage rows for a 1995–2001 history.

    ``place='customer'`` keys places by customer, ``'nation'`` needs ``c_nationkey``
    already joined in.
    """
    p = F.col("o_custkey") if place == "customer" else F.col("c_nationkey").cast("long")
    price = F.col("o_totalprice")
    st = F.col("o_orderstatus")
    return orders.select(
        place_name(p).alias("location_name"),
        F.col("o_orderdate").alias("measured_at"),
        (price / 10000 - 15).alias("temperature_2m"),
        (price / 10000 - 17).alias("apparent_temperature"),
        (price / 10000 - 18).alias("wet_bulb_temperature_2m"),
        F.when(st == "F", price / 50000).otherwise(F.lit(0.0)).alias("precipitation"),
        F.when(st == "F", price / 100000).otherwise(F.lit(0.0)).alias("rain"),
        F.when(st == "P", price / 200000).otherwise(F.lit(0.0)).alias("snowfall"),
        (price / 10).alias("sunshine_duration"),
        (price / 1000).alias("shortwave_radiation"),
        (price / 20000).alias("wind_speed_10m"),
        (price / 15000).alias("wind_gusts_10m"),
        (price / 5000).alias("cloud_cover"),
        (price / 5000).alias("relative_humidity_2m"),
        (price / 1000 + 900).alias("pressure_msl"),
        F.when(st == "F", F.lit(61)).when(st == "P", F.lit(71)).otherwise(F.lit(0)).cast("smallint")
         .alias("weather_code"),
    )
