"""Facts in bounded year partitions, and tables bucketed for joins without a shuffle.

A bounded table takes years from a fixed range only: a row outside it ends the write with an error, as an insert
into a table without a partition for it would. The check stands in the plan that writes, so there is no second
scan, and the job commits nothing if a task raises.

Bucketed tables hold rows dealt by a hash of the join key into a fixed number of files per task. Two tables
with as many buckets on the key join bucket by bucket, without an exchange, however often they are joined.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.operators.writes import rebalanced
from stratus.session import scratch_path


def bounded_year(day: Column, first: int, last: int) -> Column:
    """The year of a day; an error outside ``first`` to ``last`` and for no day."""
    year = F.year(day)
    told = F.concat(F.lit("no partition for day "), F.coalesce(day.cast("string"), F.lit("NULL")))
    return F.when(year.between(first, last), year).otherwise(F.raise_error(told).cast("int"))


def write_years(df: DataFrame, path: str, day_col: str, first: int, last: int, mode: str = "append") -> DataFrame:
    """``df`` written by ``year`` below ``path`` and read back; raises on a day outside the range.

    Mode ``overwrite`` replaces the years that ``df`` holds and leaves the others.
    """
    placed = df.withColumn("year", bounded_year(F.col(day_col), first, last))
    (rebalanced(placed, "year").write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path))
    return df.sparkSession.read.schema(df.drop("year").schema.add("year", "integer")).parquet(path)


def bucketed(spark: SparkSession, df: DataFrame, key: str, buckets: int, name: str, path: str | None = None) -> DataFrame:
    """``df`` as a table bucketed and sorted by ``key``.

    Rows are dealt by the key first, so that every bucket is one file. A key that holds a third of all rows is one
    bucket; fact tables with such keys are joined to a broadcast dimension or left to AQE instead.
    """
    table = f"{name}_{uuid4().hex[:12]}"
    (df.repartition(buckets, key).write.option("path", path or scratch_path(spark, table))
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return spark.table(table)
