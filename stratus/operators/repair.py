"""Repair of gap months, one isolated Spark job each.

Every month is recomputed in a job group of its own by a small pool of driver threads. A month that fails
is reported with its error and the others finish; its rows stay as they were, and the
next run finds the gap again.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.operators import control

REPORT = "ym int, start_date date, end_date date, status string, error_msg string"


def repair_months(spark: SparkSession, windows: DataFrame, work: Callable[[dict], None], name: str, pool: int = 4) -> DataFrame:
    """Runs ``work(window)`` for every row ``ym, start_date, end_date``; one report row each, ``repaired`` or ``failed``."""
    months = [r.asDict() for r in windows.orderBy("ym").collect()]  # one row per gap month

    def one(window: dict) -> tuple:
        group = f"{name} {window['ym']}"
        spark.sparkContext.setJobGroup(group, f"repair of {group}", interruptOnCancel=True)
        try:
            work(window)
            done = ("repaired", None)
        except Exception as e:  # noqa: BLE001 - a failed month is reported, the others go on
            done = ("failed", f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"[:300])
        return (window["ym"], window["start_date"], window["end_date"], *done)

    with ThreadPoolExecutor(max_workers=pool) as threads:
        found = list(threads.map(inheritable_thread_target(spark)(one), months))
    return spark.createDataFrame(found, REPORT)


def rewrite_month(spark: SparkSession, path: str, window: dict, downstream: DataFrame, upstream: DataFrame,
                  recompute: Callable[[DataFrame], DataFrame], day, up_day: str, part_col: str = "ym") -> None:
    """Recomputes a month's gap window and replaces the month's folder of ``path``.

    ``downstream`` and ``upstream`` are the month's rows; ``day()`` gives the day of downstream rows. The new state is
    checkpointed before the folder, which it reads, is overwritten. Only this month's folder is touched, so months can run side by side.
    """
    cols = [c for c in downstream.columns if c != part_col]
    gap = spark.createDataFrame([(window["start_date"], window["end_date"])], "start_date date, end_date date")
    state = control.fill_gaps(upstream, downstream.select(*cols).withColumn("_d", day()),
                              lambda df: recompute(df).select(*cols).withColumn("_d", day()), gap, "_d", up_day=up_day).select(*cols)
    state.checkpoint(eager=True).write.mode("overwrite").parquet(f"{path}/{part_col}={window['ym']}")


def counts(report: DataFrame) -> tuple[int, int]:
    """Months repaired and failed."""
    row = report.agg(F.count_if(F.col("status") == "repaired"), F.count_if(F.col("status") == "failed")).first()
    return row[0], row[1]
