"""Mergeable monthly states of the daily mart, from which the dashboards are read.

A state row holds, per place and month, sums and counts of the averaged measures, extremes, counts of flags and
the days themselves as bits of an int. Sums, counts, extremes and bits merge by sum, min, max and ``bit_or``,
so every measure over whole months, of any set of places, comes from the states without a day row.

``refresh`` keeps the states of a mart partitioned by month beside it. As with the day maps, a month is worked out
again if its row count (answered from Parquet footers) differs from the one its states were made from, or if the run
says that it wrote it. The mart has at most one row per place and day, so the states are up to 31 times smaller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.functions.numeric import round2
from stratus.operators.daymaps import drop_partitions, month_key
from stratus.operators.writes import _exists, rebalanced

SUMMED = ["temp_avg", "precipitation_sum", "pressure_avg", "sunshine_hours", "humidity_avg"]
FLAGS = ["is_frost_day", "is_hot_day", "is_rainy_day", "is_snowy_day"]
EXTREMES = {"temp_max": F.max, "temp_min": F.min, "wind_gusts_max": F.max}


def month_states(mart: DataFrame, date_col: str = "date") -> DataFrame:
    """One row per place and month: ``n_rows, days``, ``s_``/``n_`` of measures and flags, extremes."""
    day = F.col(date_col)
    sums = [f(F.col(c)).alias(p + c) for c in SUMMED for p, f in (("s_", F.sum), ("n_", F.count))]
    flags = [x for c in FLAGS for x in (F.count_if(F.col(c)).alias("s_" + c), F.count(c).alias("n_" + c))]
    return (mart.where(day.isNotNull()).groupBy("city_id", month_key(day).alias("ym"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.bit_or(F.expr(f"shiftleft(1, dayofmonth({date_col}) - 1)")).alias("days"),
                 *sums, *flags, *(f(c).alias(c) for c, f in EXTREMES.items())))


def merged(states: DataFrame, *by: str | Column) -> DataFrame:
    """States of coarser groups; ``by`` names or makes the group columns. ``days`` is left out, as it belongs to one month."""
    added = [c for c in states.columns if c.startswith(("s_", "n_"))]
    return states.groupBy(*by).agg(*(F.sum(c).alias(c) for c in added), *(f(c).alias(c) for c, f in EXTREMES.items()))


# measure name → its value from a merged state
VALUES = {
    "avg_temperature": lambda: round2(_mean("temp_avg")),
    "total_precipitation": lambda: round2(F.col("s_precipitation_sum")),
    "avg_pressure": lambda: round2(_mean("pressure_avg")),
    "sunshine_hours": lambda: round2(F.col("s_sunshine_hours")),
    "rainy_days": lambda: F.col("s_is_rainy_day"),
    "avg_humidity": lambda: round2(_mean("humidity_avg")),
    "max_temperature": lambda: round2(F.col("temp_max")),
    "min_temperature": lambda: round2(F.col("temp_min")),
    "max_gusts": lambda: round2(F.col("wind_gusts_max")),
}


def _mean(c: str) -> Column:
    return F.try_divide(F.col("s_" + c), F.col("n_" + c))


def value(name: str) -> Column:
    """A measure of a merged state (KeyError for unknown names)."""
    return VALUES[name]()


def of_months(states: DataFrame, start: int, end: int) -> DataFrame:
    """States of the months ``start`` to ``end`` (``YYYYMM``, both included)."""
    return states.where(F.col("ym").between(start, end))


def yearly_kpis(states: DataFrame, names: list[str]) -> DataFrame:
    """``year`` and the named measures over all places."""
    by_year = merged(states, F.floor(F.col("ym") / 100).cast("int").alias("year"))
    return by_year.select("year", *(value(n).alias(n) for n in names))


def map_values(states: DataFrame, places: DataFrame, name: str) -> DataFrame:
    """Per place of ``places`` (``id, city_name, latitude, longitude``): the chosen measure; states merge before the join."""
    per_place = merged(states, "city_id").select("city_id", value(name).alias("value"))
    return (per_place.join(places, per_place["city_id"] == places["id"])
            .select("city_name", "latitude", "longitude", "value"))


def days_with_data(states: DataFrame) -> DataFrame:
    """``ym, n_days``: days on which any place has a row, exactly."""
    return states.groupBy("ym").agg(F.bit_count(F.bit_or("days")).cast("int").alias("n_days"))


def refresh(spark: SparkSession, path: str, mart: DataFrame, written: list[int] = (), month_col: str = "ym") -> tuple[DataFrame, list[int]]:
    """Brings the states below ``path`` up to date with a mart partitioned by ``month_col``; gives them and the months read."""
    held = mart.groupBy(F.col(month_col).alias("ym")).agg(F.count(F.lit(1)).alias("n"))
    schema = month_states(mart.drop(month_col)).schema
    stored = spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)
    known = stored.groupBy("ym").agg(F.sum("n_rows").alias("known"))
    both = held.join(known, "ym", "full").where(~F.col("n").eqNullSafe(F.col("known")))
    again = sorted({r["ym"] for r in both.select("ym").collect()} | set(written))  # month keys only
    if again:
        states = month_states(mart.where(F.col(month_col).isin(again)).drop(month_col))
        rebalanced(states, "ym").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ym").parquet(path)
        left = {r["ym"] for r in held.where(F.col("ym").isin(again)).select("ym").collect()}
        drop_partitions(spark, path, [m for m in again if m not in left])
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else stored, again
