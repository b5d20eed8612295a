"""Seven-day forecast for every (place, metric) series, as grouped Spark jobs.

History (wide, one row per place and day) is melted to long form and every series is
fitted independently:

- ``forecast_linear``: least-squares trend from SQL regression aggregates
  (``regr_slope``/``regr_intercept``), fully JVM-side, partial-aggregated per series.
- ``forecast_seasonal``: piecewise-linear trend (hinges over the first 80 % of history)
  plus a yearly Fourier series, ridge-solved with NumPy inside ``applyInPandas``; one
  series per call and at most ``HISTORY_DAYS`` points per series, so no group is unbounded.

Both give an 80 % interval ŷ ± z·σ̂ (σ̂ = residual standard deviation) for the
interval metrics, clamp non-negative metrics at 0, keep horizons 1..H of the run date
and pivot back to one row per (place, target date). A series with fewer than
``MIN_HISTORY_POINTS`` non-NULL values yields nothing; a place is skipped only when all
its series are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.functions import constants as K
from stratus.functions.dates import as_date_lit
from stratus.functions.numeric import clamp_nonneg, round2


def history(mart: DataFrame, run_date, days: int = K.HISTORY_DAYS, date_col: str = "date",
            until=None) -> DataFrame:
    """Rows of the last ``days`` days before ``run_date`` (``date >= run_date - days``).

    ``until`` (exclusive) holds back a tail, e.g. to score forecasts against it later.
    """
    out = mart.where(F.col(date_col) >= F.date_sub(as_date_lit(run_date), days))
    if until is not None:
        out = out.where(F.col(date_col) < as_date_lit(until))
    return out


def melt_metrics(hist: DataFrame, metrics=K.FORECAST_METRICS, key: str = "city_id",
                 date_col: str = "date") -> DataFrame:
    """Wide → long (key, ds, metric, y), NULL values dropped."""
    long = hist.unpivot([key, F.col(date_col).alias("ds")], list(metrics), "metric", "y")
    return long.where(F.col("y").isNotNull() & ~F.isnan(F.col("y")))


def within_horizon(df: DataFrame, col: str = "horizon_days", h: int = K.HORIZON_DAYS) -> DataFrame:
    return df.where(F.col(col).between(1, h))


def _interval(metric: Column, yhat: Column, sigma: Column, z: float) -> tuple[Column, Column]:
    has = metric.isin(*K.METRICS_WITH_INTERVAL)
    lo = F.when(has, yhat - F.lit(z) * sigma)
    hi = F.when(has, yhat + F.lit(z) * sigma)
    return lo, hi


def _clamp(metric: Column, c: Column) -> Column:
    return F.when(metric.isin(*K.NON_NEGATIVE_METRICS), clamp_nonneg(c)).otherwise(c)


def forecast_linear(long: DataFrame, run_date, horizon: int = K.HORIZON_DAYS, key: str = "city_id",
                    min_points: int = K.MIN_HISTORY_POINTS, anchor: str = "run_date",
                    z: float = K.INTERVAL_Z80) -> DataFrame:
    """Linear-trend forecast per series → long rows (key, metric, target_date, horizon_days, yhat, lo, hi).

    ``anchor='run_date'`` predicts run_date+1 … run_date+H (the documented 7 rows);
    ``anchor='last_obs'`` predicts the H days after each series' last observation and
    keeps those within 1..H of the run date (the original's behaviour).
    """
    run = as_date_lit(run_date)
    x = F.datediff(F.col("ds"), run).cast("double")
    fit = (long.groupBy(key, "metric")
               .agg(F.count(F.lit(1)).alias("n"),
                    F.regr_slope(F.col("y"), x).alias("b"),
                    F.regr_intercept(F.col("y"), x).alias("a"),
                    F.regr_sxx(F.col("y"), x).alias("sxx"),
                    F.regr_syy(F.col("y"), x).alias("syy"),
                    F.regr_sxy(F.col("y"), x).alias("sxy"),
                    F.max("ds").alias("last_obs"))
               .where((F.col("n") >= min_points) & (F.col("sxx") > 0)))   # all points on one day have no trend
    rss = F.greatest(F.col("syy") - F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx")), F.lit(0.0))
    sigma = F.sqrt(F.try_divide(rss, F.col("n") - 2))
    first = F.date_add(run, 1) if anchor == "run_date" else F.date_add(F.col("last_obs"), 1)
    days = F.sequence(first, F.date_add(first, horizon - 1))
    out = fit.select(key, "metric", "a", "b", sigma.alias("sigma"), F.explode(days).alias("target_date"))
    out = out.withColumn("horizon_days", F.datediff("target_date", run).cast("smallint"))
    out = within_horizon(out, "horizon_days", horizon)
    yhat = F.col("a") + F.col("b") * F.datediff("target_date", run).cast("double")
    lo, hi = _interval(F.col("metric"), yhat, F.col("sigma"), z)
    m = F.col("metric")
    lo = F.when(m == "precipitation_sum", clamp_nonneg(lo)).otherwise(lo)
    hi = F.when(m == "precipitation_sum", clamp_nonneg(hi)).otherwise(hi)
    return out.select(key, "metric", "target_date", "horizon_days",
                      _clamp(m, yhat).alias("yhat"), lo.alias("yhat_lower"), hi.alias("yhat_upper"))


FORECAST_WIDE_COLS = ["forecast_run_date", "target_date", "city_id", "horizon_days", *K.FORECAST_METRICS,
                      "temp_avg_lower", "temp_avg_upper", "precipitation_sum_lower", "precipitation_sum_upper"]


def pivot_forecast(long: DataFrame, run_date, key: str = "city_id", metrics=K.FORECAST_METRICS,
                   digits: int | None = 2) -> DataFrame:
    """Long predictions → one row per (place, target date); a missing metric stays NULL.

    Conditional aggregation over the fixed metric list (a ``pivot`` with explicit values,
    so no extra pass to discover them); values rounded half-up to ``digits``.
    """
    rnd = (lambda c: round2(c, digits)) if digits is not None else (lambda c: c)
    m = F.col("metric")
    aggs = [rnd(F.max(F.when(m == x, F.col("yhat")))).alias(x) for x in metrics]
    for x in K.METRICS_WITH_INTERVAL:
        aggs.append(rnd(F.max(F.when(m == x, F.col("yhat_lower")))).alias(f"{x}_lower"))
        aggs.append(rnd(F.max(F.when(m == x, F.col("yhat_upper")))).alias(f"{x}_upper"))
    wide = long.groupBy(key, "target_date", "horizon_days").agg(*aggs)
    return wide.select(as_date_lit(run_date).alias("forecast_run_date"), "target_date",
                       F.col(key).alias("city_id"), "horizon_days", *metrics,
                       *[f"{x}_{b}" for x in K.METRICS_WITH_INTERVAL for b in ("lower", "upper")])


def forecast_skips(long: DataFrame, key: str = "city_id", min_points: int = K.MIN_HISTORY_POINTS,
                   places: DataFrame | None = None, fitted: DataFrame | None = None) -> DataFrame:
    """Places whose every metric series is unfittable (too short, all NULL, or failed to fit).

    ``places`` holds all places with history (``key``); ``long`` alone lacks those whose
    values are all NULL, as those rows are not in it.
    """
    n = long.groupBy(key, "metric").agg(F.count(F.lit(1)).alias("n"))
    ok = n.where(F.col("n") >= min_points).select(key, "metric")
    if fitted is not None:
        ok = ok.join(fitted.where(F.col("status") == "ok").select(key, "metric").distinct(), [key, "metric"], "left_semi")
    places = (long if places is None else places).select(key).distinct()
    return places.join(ok.select(key).distinct(), key, "left_anti").withColumn("fitted_metrics", F.lit(0))


# ---------------------------------------------------------------------------
# seasonal model (grouped NumPy)
# ---------------------------------------------------------------------------
SEASONAL_SCHEMA = T.StructType([
    T.StructField("city_id", T.LongType()),
    T.StructField("metric", T.StringType()),
    T.StructField("target_date", T.DateType()),
    T.StructField("yhat", T.DoubleType()),
    T.StructField("yhat_lower", T.DoubleType()),
    T.StructField("yhat_upper", T.DoubleType()),
    T.StructField("status", T.StringType()),
])


def design(t: np.ndarray, hinges: np.ndarray, days: np.ndarray, order: int, period: float) -> np.ndarray:
    """[1, t, max(0, t - c_j)…, sin/cos(2πk·day/period)…] for the given scaled time ``t``."""
    cols = [np.ones_like(t), t]
    cols += [np.maximum(0.0, t - c) for c in hinges]
    for k in range(1, order + 1):
        w = 2.0 * np.pi * k * days / period
        cols += [np.sin(w), np.cos(w)]
    return np.column_stack(cols)


def fit_predict(ds: np.ndarray, y: np.ndarray, horizon_days: np.ndarray, *, n_hinges: int = 25,
                hinge_range: float = 0.8, order: int = 10, period: float = 365.25,
                ridge: float = 1.0, z: float = K.INTERVAL_Z80):
    """Fit one series (``ds`` = day numbers, ``y`` values) and predict ``horizon_days``.

    Time is scaled to [0, 1] over the history as in the public model description
    (Taylor & Letham, 2018); the hinge/Fourier coefficients are ridge-penalised (the
    paper's Laplace/normal priors), intercept and base slope are not. Returns
    (yhat, lo, hi) arrays; σ̂ is the in-sample residual standard deviation.
    """
    t0, t1 = float(ds.min()), float(ds.max())
    span = max(t1 - t0, 1.0)
    t = (ds - t0) / span
    k = min(n_hinges, max(len(ds) - 1, 0))
    hinges = np.linspace(0.0, hinge_range, k + 2)[1:-1] if k > 0 else np.array([])
    X = design(t, hinges, ds.astype(float), order, period)
    mu, sd = float(np.mean(y)), float(np.std(y)) or 1.0
    ys = (y - mu) / sd
    pen = np.full(X.shape[1], ridge)
    pen[:2] = 1e-8
    A = X.T @ X + np.diag(pen)
    beta = np.linalg.solve(A, X.T @ ys)
    resid = ys - X @ beta
    dof = max(len(y) - 2, 1)
    sigma = float(np.sqrt(np.sum(resid ** 2) / dof)) * sd
    tf = (horizon_days - t0) / span
    Xf = design(tf, hinges, horizon_days.astype(float), order, period)
    yhat = Xf @ beta * sd + mu
    return yhat, yhat - z * sigma, yhat + z * sigma


def _seasonal_group(run_day: int, horizon: int, min_points: int, anchor: str):
    cols = [f.name for f in SEASONAL_SCHEMA.fields]

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        # plain NumPy on the group's columns: per-group pandas work would cost more than the fit
        key, metric = pdf["city_id"].iat[0], pdf["metric"].iat[0]
        y = pdf["y"].to_numpy(dtype=float)
        ds = np.asarray(pdf["ds"].to_numpy(), dtype="datetime64[D]").astype(np.int64).astype(float)
        ok = ~np.isnan(y)
        y, ds = y[ok], ds[ok]
        if len(y) < min_points:
            return pd.DataFrame(columns=cols)   # object columns: Arrow casts them to any type
        order = np.argsort(ds, kind="stable")
        y, ds = y[order], ds[order]
        first = run_day + 1 if anchor == "run_date" else int(ds[-1]) + 1
        fut = np.arange(first, first + horizon, dtype=float)
        fut = fut[(fut - run_day >= 1) & (fut - run_day <= horizon)]
        try:
            yhat, lo, hi = fit_predict(ds, y, fut)
            status = "ok"
            if not all(np.isfinite(v).all() for v in (yhat, lo, hi)):
                raise FloatingPointError("a prediction is not finite")
        except Exception:  # noqa: BLE001 — a failing fit is reported, the run goes on
            fut = fut[:1]
            yhat = lo = hi = np.full(len(fut), np.nan)
            status = "failed"
        n = len(fut)
        return pd.DataFrame({
            "city_id": np.full(n, key), "metric": [metric] * n,
            "target_date": fut.astype(np.int64).astype("datetime64[D]").astype(object),
            "yhat": yhat, "yhat_lower": lo, "yhat_upper": hi, "status": [status] * n})

    return fn


def _pickle_by_value() -> None:
    """Ship this package's code inside the task closures, so Python workers do not need
    ``stratus`` installed (executors of a cluster, or a driver started elsewhere)."""
    from pyspark import cloudpickle
    import stratus
    try:
        cloudpickle.register_pickle_by_value(stratus)
    except ValueError:  # already registered
        pass


def forecast_seasonal(long: DataFrame, run_date, horizon: int = K.HORIZON_DAYS, key: str = "city_id",
                      min_points: int = K.MIN_HISTORY_POINTS, anchor: str = "run_date") -> DataFrame:
    """Trend + yearly-seasonality forecast per series (grouped NumPy, Arrow batches).

    Returns long rows like :func:`forecast_linear` plus a ``status`` column
    (``failed`` rows carry NULL predictions and are dropped by the pivot).
    """
    import datetime as dt
    run_day = (dt.date.fromisoformat(str(run_date)[:10]) - dt.date(1970, 1, 1)).days
    src = long.select(F.col(key).cast("long").alias("city_id"), "metric", "ds", "y")
    _pickle_by_value()
    fitted = src.groupBy("city_id", "metric").applyInPandas(
        _seasonal_group(run_day, horizon, min_points, anchor), SEASONAL_SCHEMA)
    run = as_date_lit(run_date)
    m = F.col("metric")
    return fitted.select(
        F.col("city_id").alias(key), "metric", "target_date",
        F.datediff("target_date", run).cast("smallint").alias("horizon_days"),
        _clamp(m, F.col("yhat")).alias("yhat"),
        F.when(m.isin(*K.METRICS_WITH_INTERVAL), _clamp(m, F.col("yhat_lower"))).alias("yhat_lower"),
        F.when(m.isin(*K.METRICS_WITH_INTERVAL), _clamp(m, F.col("yhat_upper"))).alias("yhat_upper"),
        "status")


def forecast_accuracy(fc_long: DataFrame, actual_long: DataFrame, key: str = "city_id") -> DataFrame:
    """Forecast vs what happened, per (metric, horizon): n, MAE, bias, RMSE, interval coverage."""
    a = actual_long.select(key, "metric", F.col("ds").alias("target_date"), F.col("y").alias("actual"))
    j = fc_long.join(a, [key, "metric", "target_date"], "inner")
    err = F.col("yhat") - F.col("actual")
    inside = F.when(F.col("yhat_lower").isNotNull(),
                    F.col("actual").between(F.col("yhat_lower"), F.col("yhat_upper")).cast("double"))
    return (j.groupBy("metric", "horizon_days")
             .agg(F.count(F.lit(1)).alias("n"),
                  round2(F.avg(F.abs(err)), 4).alias("mae"),
                  round2(F.avg(err), 4).alias("bias"),
                  round2(F.sqrt(F.avg(err * err)), 4).alias("rmse"),
                  round2(F.avg(inside), 4).alias("coverage")))
