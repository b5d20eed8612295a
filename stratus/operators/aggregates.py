"""Grouped aggregates: dominant value, rounded measures, distinct counts, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions.numeric import avg2, sum2, sum_hours


def dominant(c: str | Column) -> Column:
    """Most frequent non-NULL value of the group; ties go to the smallest value.

    ``mode`` keeps one small count map per group and merges partial maps after the
    shuffle, so a group with a third of all rows is still combined map-side.
    """
    return F.mode(F.col(c) if isinstance(c, str) else c, True)


_KINDS = {
    "avg2": avg2,
    "sum2": sum2,
    "hours": sum_hours,
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
    "avg": lambda c: F.avg(c),
    "sum": lambda c: F.sum(c),
    "count": lambda c: F.count(c),
}


def measure_exprs(spec) -> list[Column]:
    """[(out_name, kind, source_col)] → aggregate expressions (kinds: avg2 sum2 hours min max avg sum count)."""
    return [_KINDS[kind](F.col(src)).alias(out) for out, kind, src in spec]


def coverage(df: DataFrame, date_col: str, key: str, out: str = "cities",
             approx: bool = False) -> DataFrame:
    """Distinct places per month (``approx=True`` uses HyperLogLog++ for dashboards)."""
    month = F.trunc(F.to_date(F.col(date_col)), "month").alias("month")
    agg = F.approx_count_distinct(key) if approx else F.count_distinct(F.col(key))
    return df.groupBy(month).agg(agg.alias(out))


def series_index(hist: DataFrame, keys=("city_id", "city_name")) -> DataFrame:
    """Distinct series keys of a history, sorted."""
    return hist.select(*keys).distinct().orderBy(*keys)


__all__ = ["dominant", "measure_exprs", "coverage", "series_index"]
