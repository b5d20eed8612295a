"""Latest/first row per key, previous-period values and ranking.

"One row per key" selections are written as aggregates (``max_by``/``min_by`` over a
struct ordering key) rather than ``row_number`` windows: an aggregate is combined
map-side, so a key holding a third of all rows never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _struct(cols) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def latest_per_key(df: DataFrame, key, order: str, cols, tie: str | None = None,
                   nulls_first: bool = True) -> DataFrame:
    """DISTINCT ON (key) … ORDER BY key, order DESC [NULLS FIRST], tie DESC.

    PostgreSQL's DESC puts NULL order values first, so a row with NULL ``order`` wins
    over any dated row; ``tie`` (descending) breaks exact ties deterministically.
    """
    keys = [key] if isinstance(key, str) else list(key)
    o = F.col(order)
    parts = [o.isNull().alias("_n")] if nulls_first else [o.isNotNull().alias("_n")]
    parts.append(o.alias("_o"))
    if tie:
        parts.append(F.col(tie).alias("_t"))
    best = F.max_by(_struct(cols), F.struct(*parts)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("_best")[c].alias(c) for c in cols])


def first_per_key(df: DataFrame, key, pos: str, cols) -> DataFrame:
    """First record per key in list order (smallest ``pos``)."""
    keys = [key] if isinstance(key, str) else list(key)
    best = F.min_by(_struct(cols), F.col(pos)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("_best")[c].alias(c) for c in cols])


def with_previous(df: DataFrame, measures, partition, period: str, lag: int = 1,
                  prefix: str = "prev_") -> DataFrame:
    """Add ``prev_<m>`` = value ``lag`` periods earlier in the same partition.

    Expects one row per (partition, period) on a gap-free period spine (otherwise the
    previous *row* is not the previous *period*); :func:`stratus.operators.measures.period_compare`
    builds that spine.
    """
    parts = [partition] if isinstance(partition, str) else list(partition or [])
    w = Window.partitionBy(*parts).orderBy(F.col(period))
    out = df
    for m in measures:
        out = out.withColumn(f"{prefix}{m}", F.lag(F.col(m), lag).over(w))
    return out


def rank_by(df: DataFrame, measure: str, part=None, out: str = "rank", ascending: bool = False) -> DataFrame:
    """SQL ``rank()`` by a measure (ties share a rank, NULLs come last), optionally within partitions.

    Rows are counted per distinct value first and only the counts are summed in order, so a
    task sees the distinct values of a partition (at most 10,001 for a percentage of two
    places), never its rows.
    """
    parts = [part] if isinstance(part, str) else list(part or [])
    o = F.col("_v").asc_nulls_last() if ascending else F.col("_v").desc_nulls_last()
    before = Window.partitionBy(*(f"_p{i}" for i in range(len(parts)))).orderBy(o).rowsBetween(Window.unboundedPreceding, -1)
    counts = (df.groupBy(*(F.col(p).alias(f"_p{i}") for i, p in enumerate(parts)), F.col(measure).alias("_v"))
                .agg(F.count(F.lit(1)).alias("_n")))
    ranks = counts.withColumn("_rank", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1).cast("int")).drop("_n")
    same = df[measure].eqNullSafe(ranks["_v"])
    for i, p in enumerate(parts):
        same = same & df[p].eqNullSafe(ranks[f"_p{i}"])
    return df.join(ranks, same).withColumn(out, F.col("_rank")).drop("_rank", "_v", *(f"_p{i}" for i in range(len(parts))))
