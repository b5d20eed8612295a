"""Which days a layer holds, as a bitmap per place and month.

A month has at most 31 days, so its days are the bits of one int: built with ``bit_or`` (combined map-side),
compared with ``up & ~down`` inside generated code, and counted with ``bit_count``. (Spark's 4 kB
bitmaps of ``bitmap_construct_agg`` have no bitwise functions to compare two of them.)

``refresh`` keeps the maps of a table beside it, one folder per month. It compares the row count of every
month, which Parquet answers from its footers, with the count the maps were made from, and reads the keys of
the months that differ or were written in this run only. So gaps between layers cost as much as what
changed, and months that were changed behind the run's back are noticed too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.functions.dates import as_date_lit
from stratus.operators.writes import _exists

MAP_SCHEMA = "place string, days int, n_rows long, ym int"


def month_key(day: Column) -> Column:
    return (F.year(day) * 100 + F.month(day)).cast("int")


def month_maps(rows: DataFrame, place: Column, day: Column) -> DataFrame:
    """``place, ym, days, n_rows``: bit ``k - 1`` of ``days`` is set if the place has a row on day ``k``."""
    keyed = rows.select(place.cast("string").alias("place"), day.cast("date").alias("_d"))
    return (keyed.where("_d IS NOT NULL").groupBy("place", month_key(F.col("_d")).alias("ym"))
            .agg(F.bit_or(F.expr("shiftleft(1, dayofmonth(_d) - 1)")).alias("days"), F.count(F.lit(1)).alias("n_rows")))


def merge_maps(maps: DataFrame) -> DataFrame:
    """Maps of parts of a layer as one."""
    return maps.groupBy("place", "ym").agg(F.bit_or("days").alias("days"), F.sum("n_rows").alias("n_rows"))


def missing(up: DataFrame, down: DataFrame) -> DataFrame:
    """``place, ym, days``: the days that ``up`` has and ``down`` lacks, as bits."""
    u, d = up.select("place", "ym", "days"), down.select(F.col("place").alias("_p"), F.col("ym").alias("_m"), F.col("days").alias("_d"))
    lacks = F.col("days").bitwiseAND(F.bitwise_not(F.coalesce("_d", F.lit(0))))
    return (u.join(d, F.col("place").eqNullSafe(F.col("_p")) & (F.col("ym") == F.col("_m")), "left")
            .select("place", "ym", lacks.alias("days")).where("days <> 0"))


def month_start() -> Column:
    return F.make_date(F.floor(F.col("ym") / 100).cast("int"), F.col("ym") % 100, F.lit(1))


def missing_days(gaps: DataFrame) -> DataFrame:
    """``place, missing_date``: one row per bit."""
    bits = F.filter(F.sequence(F.lit(0), F.lit(30)), lambda k: F.getbit("days", k) == 1)
    return gaps.select("place", F.explode(bits).alias("_k"), "ym").select("place", F.date_add(month_start(), F.col("_k")).alias("missing_date"))


def gap_windows(gaps: DataFrame, today) -> DataFrame:
    """``ym, start_date, end_date`` of the months with a gap, ended at the day before ``today``; months not begun are left out."""
    return (gaps.select("ym").distinct().withColumn("start_date", month_start())
            .withColumn("end_date", F.least(F.last_day("start_date"), F.date_sub(as_date_lit(today), 1)))
            .where("start_date <= end_date"))


def refresh(spark: SparkSession, path: str, table: DataFrame, place: Column, day: Column, part_month: Column,
            part_filter, written: list[int] = ()) -> DataFrame:
    """Brings the stored maps of ``table`` up to date and gives them.

    ``part_month``: the month key from partition columns alone; ``part_filter(months)``: the predicate on partition
    columns that reads these months. Months in ``written`` are read again whatever their counts.
    """
    held = (table.groupBy(part_month.alias("ym")).agg(F.count(F.lit(1)).alias("n")).where("ym IS NOT NULL"))
    stored = spark.read.schema(MAP_SCHEMA).parquet(path) if _exists(spark, path) else spark.createDataFrame([], MAP_SCHEMA)
    known = stored.groupBy("ym").agg(F.sum("n_rows").alias("known"))
    both = held.join(known, "ym", "full").select("ym", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("known", F.lit(0)).alias("known"))
    again = sorted({r["ym"] for r in both.where("n <> known").collect()} | set(written))  # month keys only
    if again:
        fresh = month_maps(table.where(part_filter(again)), place, day).where(F.col("ym").isin(again))
        (fresh.select("place", "days", "n_rows", "ym").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("ym").parquet(path))
        filled = {r["ym"] for r in fresh.select("ym").distinct().collect()}
        drop_partitions(spark, path, [m for m in again if m not in filled])
    return spark.read.schema(MAP_SCHEMA).parquet(path) if _exists(spark, path) else stored


def drop_partitions(spark: SparkSession, path: str, months: list[int]) -> None:
    """Removes the folders of months that the table no longer holds."""
    for m in months:
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/ym={m}")
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
