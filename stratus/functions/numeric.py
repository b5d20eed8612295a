"""Rounding, clamps and NULL/NaN hygiene."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2(c: ColumnOrName, scale: int = 2) -> Column:
    """ROUND(x::NUMERIC, 2)::FLOAT — half away from zero on the decimal value.

    Going through DECIMAL(38,12) makes the result independent of binary float noise
    (plain ``round`` on a double can land either side of a .5 tie).
    """
    return F.round(_c(c).try_cast("decimal(38,12)"), scale).cast("double")


def avg2(c: ColumnOrName) -> Column:
    return round2(F.avg(_c(c)))


def sum2(c: ColumnOrName) -> Column:
    return round2(F.sum(_c(c)))


def sum_hours(c: ColumnOrName) -> Column:
    """SUM(seconds) / 3600 rounded to 2 places."""
    return round2(F.sum(_c(c)) / F.lit(3600.0))


def clamp_nonneg(c: ColumnOrName) -> Column:
    """max(0, x), NULL stays NULL (``greatest`` alone would turn NULL into 0)."""
    c = _c(c)
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(F.lit(0.0), c))
