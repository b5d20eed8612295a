"""Literal relations and series generators.

Series are produced with ``explode(sequence(...))`` next to the rows that need them,
so nothing is built on the driver and the output is partitioned like its input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.functions.constants import WIND_BANDS, WMO_CODES
from stratus.functions.dates import as_date_lit

WIND_BAND_SCHEMA = T.StructType([
    T.StructField("id", T.ShortType(), False),
    T.StructField("degree_from", T.ShortType(), False),
    T.StructField("degree_to", T.ShortType(), False),
    T.StructField("compass_short", T.StringType(), False),
    T.StructField("compass_full", T.StringType(), False),
])

WMO_SCHEMA = T.StructType([
    T.StructField("id", T.ShortType(), False),
    T.StructField("description", T.StringType(), True),
    T.StructField("severity", T.StringType(), True),
    T.StructField("precipitation_type", T.StringType(), True),
])


def wind_bands(spark: SparkSession) -> DataFrame:
    """The 16 compass bands (fixed size → safe to broadcast)."""
    return spark.createDataFrame(WIND_BANDS, WIND_BAND_SCHEMA)


def wmo_codes(spark: SparkSession) -> DataFrame:
    """The 28 seeded WMO codes."""
    return spark.createDataFrame(WMO_CODES, WMO_SCHEMA)


def day_sequence(start, end) -> Column:
    """Array of dates start..end inclusive (empty when start > end)."""
    s, e = as_date_lit(start), as_date_lit(end)
    return F.when(s <= e, F.sequence(s, e, F.expr("INTERVAL 1 DAY"))).otherwise(F.array().cast("array<date>"))


def month_sequence(start, end) -> Column:
    """Array of month starts covering start..end (empty when start > end)."""
    s, e = F.trunc(as_date_lit(start), "month"), F.trunc(as_date_lit(end), "month")
    return F.when(s <= e, F.sequence(s, e, F.expr("INTERVAL 1 MONTH"))).otherwise(F.array().cast("array<date>"))


def date_series(spark: SparkSession, start, end, name: str = "date") -> DataFrame:
    """One row per day in [start, end]. Bounds may be literals or columns of a 1-row frame."""
    n_days = None
    if not isinstance(start, Column) and not isinstance(end, Column):
        import datetime as dt
        s = dt.date.fromisoformat(str(start)[:10])
        e = dt.date.fromisoformat(str(end)[:10])
        n_days = (e - s).days + 1
    if n_days is not None:
        # distributed: one id per day, spread over the default parallelism
        return spark.range(0, max(n_days, 0)).select(
            F.date_add(as_date_lit(start), F.col("id").cast("int")).alias(name))
    return spark.range(1).select(F.explode(day_sequence(start, end)).alias(name))


def minute_series(spark: SparkSession, name: str = "ts") -> DataFrame:
    """1,440 timestamps of one day, one per minute (2000-01-01 00:00 … 23:59)."""
    return spark.range(0, 1440).select(
        (F.to_timestamp_ntz(F.lit("2000-01-01 00:00:00")) + F.make_dt_interval(
            F.lit(0), F.lit(0), F.col("id").cast("int"), F.lit(0))).alias(name))


def month_chunks(year_from: int, day_to) -> Column:
    """Array<struct<start,end>> of month chunks from Jan 1 of ``year_from`` to ``day_to``.

    Each chunk ends at the month's last day or ``day_to``, whichever is first.
    """
    first = F.make_date(F.lit(year_from), F.lit(1), F.lit(1))
    cap = as_date_lit(day_to)
    return F.transform(month_sequence(first, cap),
                       lambda m: F.struct(m.alias("start"), F.least(F.last_day(m), cap).alias("end")))


def explode_days(df: DataFrame, start: str, end: str, out: str = "day") -> DataFrame:
    """One row per calendar day of each row's [start, end] range."""
    return df.withColumn(out, F.explode(day_sequence(F.col(start), F.col(end))))
