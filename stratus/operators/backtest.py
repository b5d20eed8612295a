"""Rolling-origin backtest of the linear forecast from prefix sums of regression moments.

A run at an origin sees the ``days`` days before it. Instead of a fit per origin, every series is
passed once in order of days with running sums of ``1, x, y, x*x, x*y, y*y``; a run's moments are the
sums at its last day less those before its first day. Both are read off by marks that are
sorted in among the observations, so history and origins are never joined. An as-of join
then gives every observed day the latest run before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.functions import constants as K
from stratus.functions.dates import as_date_lit
from stratus.functions.numeric import clamp_nonneg, round2
from stratus.operators.joins import asof_join

_MOMENTS = ("n", "sx", "sy", "sxx", "sxy", "syy")


def weekly_origins(first, last) -> Column:
    """Run dates from ``first`` to ``last``, a week apart, as an array."""
    return F.sequence(as_date_lit(first), as_date_lit(last), F.expr("INTERVAL 7 DAYS"))


def rolling_fits(long: DataFrame, origins: Column, epoch, days: int = K.HISTORY_DAYS, key: str = "city_id",
                 min_points: int = K.MIN_HISTORY_POINTS) -> DataFrame:
    """``key, metric, origin, n, a, b, sigma`` of the least-squares line of every series at every origin.

    ``long`` holds ``key, metric, ds, y``. ``x`` counts days from ``epoch``; a day near the origins keeps
    the sums small. Origins with fewer than ``min_points`` points, or all on one day, give no row.
    """
    x, y = F.datediff("ds", as_date_lit(epoch)).cast("double"), F.col("y")
    terms = {"n": F.lit(1.0), "sx": x, "sy": y, "sxx": x * x, "sxy": x * y, "syy": y * y}
    seen = long.select(key, "metric", F.col("ds").alias("_t"), F.lit(0).alias("side"), F.lit(None).cast("date").alias("origin"),
                       *(t.alias(m) for m, t in terms.items()))
    runs = long.select(key, "metric").distinct().withColumn("origin", F.explode(origins))
    marks = runs.withColumn("_m", F.explode(F.array(
        F.struct(F.date_sub("origin", 1).alias("_t"), F.lit(1).alias("side")),
        F.struct(F.date_sub("origin", days + 1).alias("_t"), F.lit(-1).alias("side"))))).select(
            key, "metric", "_m._t", "_m.side", "origin", *(F.lit(0.0).alias(m) for m in _MOMENTS))
    so_far = (Window.partitionBy(key, "metric").orderBy("_t", F.col("side") != 0)
              .rowsBetween(Window.unboundedPreceding, 0))
    sums = seen.unionByName(marks).select(key, "metric", "side", "origin", *(F.sum(m).over(so_far).alias(m) for m in _MOMENTS))
    m = (sums.where("side <> 0").groupBy(key, "metric", "origin")
         .agg(*(F.sum(F.col(c) * F.col("side")).alias(c) for c in _MOMENTS)).where(F.col("n") >= min_points))
    n = F.col("n")
    m = m.select(key, "metric", "origin", n.cast("long").alias("n"), "sx", "sy",
                 (F.col("sxx") - F.try_divide(F.col("sx") * F.col("sx"), n)).alias("sxx"),
                 (F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), n)).alias("sxy"),
                 (F.col("syy") - F.try_divide(F.col("sy") * F.col("sy"), n)).alias("syy")).where("sxx > 0.5")
    b = F.try_divide(F.col("sxy"), F.col("sxx"))
    rss = F.greatest(F.col("syy") - b * F.col("sxy"), F.lit(0.0))
    return m.select(key, "metric", "origin", "n", F.try_divide(F.col("sy") - b * F.col("sx"), n).alias("a"), b.alias("b"),
                    F.sqrt(F.try_divide(rss, n - 2)).alias("sigma"))


def backtest(long: DataFrame, first, last, days: int = K.HISTORY_DAYS, horizon: int = K.HORIZON_DAYS, key: str = "city_id",
             z: float = K.INTERVAL_Z80) -> DataFrame:
    """``metric, horizon_days, n, n_origins, mae, bias, rmse, coverage`` over weekly runs from ``first`` to ``last``."""
    fits = rolling_fits(long, weekly_origins(first, last), last, days, key).drop("n")
    targets = long.where((F.col("ds") > as_date_lit(first)) & (F.col("ds") <= F.date_add(as_date_lit(last), horizon)))
    scored = asof_join(targets.select(key, "metric", "ds", "y"), fits, [key, "metric"], "ds", "origin", allow_equal=False)
    ahead = F.datediff("ds", "origin")
    line = F.col("a") + F.col("b") * F.datediff("ds", as_date_lit(last)).cast("double")
    metric = F.col("metric")
    yhat = F.when(metric.isin(*K.NON_NEGATIVE_METRICS), clamp_nonneg(line)).otherwise(line)
    error = yhat - F.col("y")

    def side(sign: int) -> Column:
        end = line + F.lit(sign * z) * F.col("sigma")
        return F.when(metric == "precipitation_sum", clamp_nonneg(end)).otherwise(end)

    inside = F.when(metric.isin(*K.METRICS_WITH_INTERVAL), F.col("y").between(side(-1), side(1)).cast("double"))
    return (scored.where(ahead.between(1, horizon)).groupBy("metric", ahead.cast("smallint").alias("horizon_days"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("origin").alias("n_origins"),
                 round2(F.avg(F.abs(error)), 4).alias("mae"), round2(F.avg(error), 4).alias("bias"),
                 round2(F.sqrt(F.avg(error * error)), 4).alias("rmse"), round2(F.avg(inside), 4).alias("coverage")))
