"""Sparse trend changes and simulated intervals.

``forecast_sparse``: the seasonal model with the published Laplace prior on its trend changes. The
hinges carry an L1 penalty and are fitted by coordinate descent on the normal equations, so most of
them are exactly zero; the yearly terms carry a ridge penalty, constant and slope none, and these are solved
for exactly: they are eliminated from the normal equations before the descent. A place
is one group: its metrics that were observed on the same days share the design and its Gram matrix.

``simulated_band``: the band of the published model. Future trend changes are drawn at the rate and
scale of the fitted ones, with noise at the residual scale, and the band is the quantiles
per day, so it widens with the horizon. Draws are hashed uniforms, so reruns agree.
"""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions import constants as K
from stratus.functions.dates import as_date_lit
from stratus.functions.numeric import round2
from stratus.operators.forecast import _clamp, _pickle_by_value, design

#: Penalties, sweeps, hinges over the first part of history, and yearly terms.
LASSO, RIDGE, SWEEPS, HINGES, HINGE_RANGE, ORDER, PERIOD = 1.0, 1.0, 60, 25, 0.8, 10, 365.25
#: Draws of a series and day.
SAMPLES = 200

_FIT = ("city_id long, metric string, target_date date, yhat double, sigma double, n_active int, change_scale double, "
        "span double, status string")


def coordinate_descent(gram: np.ndarray, moments: np.ndarray, lasso: float, sweeps: int) -> np.ndarray:
    """Minimises ``b' gram b / 2 - moments' b + lasso |b|`` for every column of ``moments``, in fixed sweeps from zero."""
    b = np.zeros_like(moments)
    for _ in range(sweeps):
        for j in range(len(gram)):
            r = moments[j] - gram[j] @ b + gram[j, j] * b[j]
            b[j] = np.sign(r) * np.maximum(np.abs(r) - lasso, 0.0) / gram[j, j]
    return b


def solve_sparse(gram: np.ndarray, moments: np.ndarray, sparse: np.ndarray, lasso: float, sweeps: int) -> np.ndarray:
    """As above with the penalty on the columns ``sparse`` only; the others are eliminated exactly."""
    rest = ~sparse
    through = np.linalg.solve(gram[np.ix_(rest, rest)], np.hstack([gram[np.ix_(rest, sparse)], moments[rest]]))
    n = sparse.sum()
    down = gram[np.ix_(sparse, rest)]
    b = np.zeros_like(moments)
    b[sparse] = coordinate_descent(gram[np.ix_(sparse, sparse)] - down @ through[:, :n], moments[sparse] - down @ through[:, n:],
                                   lasso, sweeps)
    b[rest] = through[:, n:] - through[:, :n] @ b[sparse]
    return b


def fit_sparse(days: np.ndarray, y: np.ndarray, future: np.ndarray, lasso: float = LASSO, ridge: float = RIDGE,
               sweeps: int = SWEEPS) -> dict[str, np.ndarray]:
    """Fits the columns of ``y`` (days x series) and predicts the ``future`` days."""
    span = max(float(days.max() - days.min()), 1.0)
    hinges = np.arange(1, HINGES + 1) * (HINGE_RANGE / (HINGES + 1))
    x, ahead = (design((d - days.min()) / span, hinges, d, ORDER, PERIOD) for d in (days, future))
    mu, sd = y.mean(axis=0), y.std(axis=0)
    sd[sd == 0] = 1.0
    scaled = (y - mu) / sd
    is_hinge = np.zeros(x.shape[1], bool)
    is_hinge[2:2 + HINGES] = True
    yearly = np.where(is_hinge, 0.0, ridge)
    yearly[:2] = 1e-8
    b = solve_sparse(x.T @ x + np.diag(yearly), x.T @ scaled, is_hinge, lasso, sweeps)
    rss = ((scaled - x @ b) ** 2).sum(axis=0)
    return {"yhat": ahead @ b * sd + mu, "sigma": np.sqrt(rss / max(len(days) - 2, 1)) * sd,
            "n_active": (b[is_hinge] != 0).sum(axis=0), "change_scale": np.abs(b[is_hinge]).mean(axis=0) * sd,
            "span": np.full(y.shape[1], span)}


def _place(run_day: int, horizon: int, min_points: int):
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(day=np.asarray(pdf["ds"].to_numpy(), "datetime64[D]").astype(np.int64).astype(float))
        wide = pdf.pivot_table(index="day", columns="metric", values="y", aggfunc="mean").sort_index()
        future, out = np.arange(run_day + 1, run_day + 1 + horizon, dtype=float), []
        dates = future.astype(np.int64).astype("datetime64[D]").astype(object)
        observed = wide.notna()
        for pattern in observed.T.drop_duplicates().to_numpy():
            metrics = [m for m in wide if (observed[m].to_numpy() == pattern).all()]
            if pattern.sum() < min_points:
                continue
            found = fit_sparse(wide.index.to_numpy()[pattern], wide[metrics].to_numpy()[pattern], future)
            for k, m in enumerate(metrics):
                fine = all(np.isfinite(found[c][..., k]).all() for c in ("yhat", "sigma", "change_scale"))
                out.append(pd.DataFrame({
                    "city_id": pdf["city_id"].iat[0], "metric": m, "target_date": dates,
                    "yhat": found["yhat"][:, k] if fine else np.nan, "sigma": found["sigma"][k] if fine else np.nan,
                    "n_active": int(found["n_active"][k]), "change_scale": found["change_scale"][k] if fine else np.nan,
                    "span": found["span"][k], "status": "ok" if fine else "failed"}))
        return pd.concat(out) if out else pd.DataFrame(columns=[c.split()[0] for c in _FIT.split(", ")])

    return fit


def forecast_sparse(long: DataFrame, run_date, horizon: int = K.HORIZON_DAYS, key: str = "city_id",
                    min_points: int = K.MIN_HISTORY_POINTS) -> DataFrame:
    """``key, metric, target_date, horizon_days, yhat, sigma, n_active, change_scale, span, status``.

    ``n_active``: trend changes that are not zero; ``change_scale``: their mean size over all hinges, per
    ``span`` days. ``long`` holds at most the history window of a place in one group. Several values of one day
    count as their mean. A series with an infinite value has status ``failed`` and NULLs.
    """
    run_day = (dt.date.fromisoformat(str(run_date)[:10]) - dt.date(1970, 1, 1)).days
    _pickle_by_value()
    fitted = (long.select(F.col(key).cast("long").alias("city_id"), "metric", "ds", "y")
              .groupBy("city_id").applyInPandas(_place(run_day, horizon, min_points), _FIT))
    return fitted.select(F.col("city_id").alias(key), "metric", "target_date",
                         F.datediff("target_date", as_date_lit(run_date)).cast("smallint").alias("horizon_days"),
                         _clamp(F.col("metric"), F.col("yhat")).alias("yhat"), "sigma", "n_active", "change_scale", "span", "status")


def _uniforms(*of: Column) -> list[Column]:
    """Four numbers in (0, 1) fixed by what they are drawn for: 32 bits of an MD5 each."""
    digest = F.md5(F.concat_ws(":", *(c.cast("string") for c in of)))
    return [(F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("double") + 0.5) / F.lit(float(2 ** 32)) for k in range(4)]


def simulated_band(fitted: DataFrame, key: str = "city_id", samples: int = SAMPLES, low: float = 0.1, high: float = 0.9,
                   z: float = K.INTERVAL_Z80) -> DataFrame:
    """The fitted rows of metrics with an interval, with ``sim_lower, sim_upper`` beside the constant band ``yhat_lower, yhat_upper``.

    A draw adds, for each day up to the target day, with the chance ``hinges / (hinge range * span)`` a
    Laplace slope change that acts from that day on, and normal noise on the target day.
    """
    h, metric = F.col("horizon_days"), F.col("metric")
    rows = fitted.where((F.col("status") == "ok") & metric.isin(*K.METRICS_WITH_INTERVAL))
    drawn = rows.withColumn("_s", F.explode(F.sequence(F.lit(1), F.lit(samples))))

    def change(day: Column) -> Column:
        when, size, _, _ = _uniforms(F.col(key), metric, F.col("_s"), day)
        half = size - 0.5
        laplace = -F.col("change_scale") * F.signum(half) * F.log(1 - 2 * F.abs(half))
        return F.when(when < F.lit(HINGES / HINGE_RANGE) / F.col("span"), laplace).otherwise(F.lit(0.0))

    trend = F.aggregate(F.sequence(F.lit(1), h.cast("int")), F.lit(0.0),
                        lambda total, day: total + change(day) * (h - day + 1) / F.col("span"))
    _, _, one, two = _uniforms(F.col(key), metric, F.col("_s"), h)
    noise = F.col("sigma") * F.sqrt(-2 * F.log(one)) * F.cos(2 * F.pi() * two)
    ends = (drawn.withColumn("_y", F.col("yhat") + trend + noise)
            .groupBy(key, "metric", "target_date", "horizon_days", "yhat", "sigma")
            .agg(F.percentile("_y", F.array(F.lit(low), F.lit(high))).alias("_q")))
    band = F.lit(z) * F.col("sigma")
    return ends.select(key, "metric", "target_date", "horizon_days", "yhat",
                       _clamp(metric, F.col("_q")[0]).alias("sim_lower"), _clamp(metric, F.col("_q")[1]).alias("sim_upper"),
                       _clamp(metric, F.col("yhat") - band).alias("yhat_lower"), _clamp(metric, F.col("yhat") + band).alias("yhat_upper"))


def band_coverage(bands: DataFrame, actual_long: DataFrame, key: str = "city_id") -> DataFrame:
    """Per metric and horizon: how often history fell into the simulated and the constant band, and their mean widths."""
    a = actual_long.select(key, "metric", F.col("ds").alias("target_date"), "y")
    joined = bands.join(a, [key, "metric", "target_date"])
    return joined.groupBy("metric", "horizon_days").agg(
        F.count(F.lit(1)).alias("n"),
        *(round2(F.avg(F.col("y").between(F.col(f"{p}_lower"), F.col(f"{p}_upper")).cast("double")), 4).alias(f"{p}_coverage") for p in ("sim", "yhat")),
        *(round2(F.avg(F.col(f"{p}_upper") - F.col(f"{p}_lower")), 4).alias(f"{p}_width") for p in ("sim", "yhat")))
