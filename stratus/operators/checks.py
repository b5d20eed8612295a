"""Declared constraints as data checks (each returns the violating rows or keys)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, keys) -> DataFrame:
    """Key tuples occurring more than once (PK/UNIQUE), with their count."""
    keys = list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def null_in(cols) -> Column:
    """Whether a row breaks NOT NULL on any of the columns."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def outside(col: str, allowed) -> Column:
    """Whether a row breaks CHECK (col IN (...)): NULL passes, as in SQL."""
    return F.col(col).isNotNull() & ~F.col(col).isin(list(allowed))


def check_not_null(df: DataFrame, cols) -> DataFrame:
    return df.where(null_in(cols))


def check_fk(df: DataFrame, cols, parent: DataFrame, parent_cols) -> DataFrame:
    """Rows whose non-NULL foreign key has no parent row."""
    cols, parent_cols = list(cols), list(parent_cols)
    p = parent.select(*[F.col(a).alias(b) for a, b in zip(parent_cols, cols)])
    nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return df.where(nn).join(p, cols, "left_anti")


def check_in(df: DataFrame, col: str, allowed) -> DataFrame:
    return df.where(outside(col, allowed))


def row_report(df: DataFrame, broken: dict[str, Column]) -> DataFrame:
    """All row checks of a table in one pass: ``check_name, violations`` from the rows' conditions."""
    counts = df.agg(*(F.count_if(c).alias(n) for n, c in broken.items()))
    return counts.unpivot([], list(broken), "check_name", "violations")


def constraint_report(checks, *reports: DataFrame) -> DataFrame:
    """[(check_name, violations_df)] → one row per check with its violation count, and the rows of ``reports``."""
    parts = [*reports] + [
        v.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(n).alias("check_name"), "violations")
        for n, v in checks]
    return reduce(lambda a, b: a.unionByName(b), parts)
