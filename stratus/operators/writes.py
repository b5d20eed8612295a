"""Write semantics of the warehouse on plain Parquet directories.

- range replacement (DELETE window + INSERT) → survivors ∪ new rows, written with dynamic
  partition overwrite; partitions that end up empty are removed explicitly
- SCD1 merge on a unique name, insert-if-absent, stable surrogate keys
- append-only logs and forecast history

Pure variants (``replaced``, ``scd1_merge``, ``insert_absent``, ``assign_ids``) return the
new table state as a DataFrame; the ``*_table`` variants persist it. Before a table is
overwritten from a plan that reads it, the plan is checkpointed into the shared
``spark.checkpoint.dir`` so the overwrite never races its own input and a lost
executor recomputes from the checkpoint, not from a half-written table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratus.functions.dates import as_date_lit, date_id
from stratus.session import checkpoint_dir


def _in_range(col: str, start, end, kind: str = "date") -> Column:
    """Row predicate for the window; ``kind='date_id'`` means an integer YYYYMMDD key."""
    c = F.col(col)
    if kind == "date_id":
        return c.between(date_id(as_date_lit(start)), date_id(as_date_lit(end)))
    return F.to_date(c).between(as_date_lit(start), as_date_lit(end))


def replaced(existing: DataFrame, new: DataFrame, date_col: str, start, end,
             key_col: str | None = None, key=None, kind: str = "date") -> DataFrame:
    """Table state after ``DELETE … WHERE date BETWEEN start AND end [AND key = k]`` + INSERT new."""
    gone = _in_range(date_col, start, end, kind)
    if key_col is not None:
        gone = gone & (F.col(key_col) == F.lit(key))
    survivors = existing.where(~F.coalesce(gone, F.lit(False)))
    return survivors.unionByName(new)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p)


def rebalanced(df: DataFrame, part_col: str) -> DataFrame:
    """``df`` dealt out by partition value before a partitioned write.

    Without it every task writes a file into every partition. AQE splits large partition
    values over several tasks and joins small ones, by the advisory size.
    """
    return df.hint("rebalance", F.col(part_col)).sortWithinPartitions(part_col)


def replace_range_table(spark: SparkSession, path: str, new: DataFrame, date_col: str, start, end,
                        part_col: str, part_values, key_col: str | None = None, key=None,
                        kind: str = "date") -> DataFrame:
    """Idempotent range replacement on a Parquet table partitioned by ``part_col``.

    ``part_values`` lists the partitions the window touches (derived from the window,
    e.g. the months between start and end — never from the data). Only those
    partitions are read, rewritten or, if nothing survives, deleted.
    """
    part_values = list(part_values)
    if _exists(spark, path):
        cur = spark.read.parquet(path).where(F.col(part_col).isin(part_values))
        state = replaced(cur, new, date_col, start, end, key_col, key, kind)
    else:
        state = new
    return rewrite_partitions(spark, path, state, part_col, part_values)


def rewrite_partitions(spark: SparkSession, path: str, state: DataFrame, part_col: str, part_values) -> DataFrame:
    """Make ``state`` the full content of partitions ``part_values`` of a Parquet table.

    The plan is checkpointed first (it may read the very partitions it replaces), then
    written with dynamic partition overwrite; listed partitions left without rows are
    deleted, so a window that became empty does not keep stale rows.
    """
    checkpoint_dir(spark)
    state = state.checkpoint(eager=True)  # reliable: written to the shared checkpoint folder
    present = {r[0] for r in state.select(part_col).distinct().collect()}  # ≤ len(part_values) rows
    rebalanced(state, part_col).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(part_col).parquet(path)
    stale = {f"{part_col}={v}" for v in part_values if v not in present}
    if stale:   # one directory listing, then delete only partitions that exist
        jvm = spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(path)
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        for st in fs.listStatus(root):
            if st.isDirectory() and st.getPath().getName() in stale:
                fs.delete(st.getPath(), True)
    return spark.read.parquet(path)


def scd1_merge(target: DataFrame, source: DataFrame, key: str, attrs, now) -> DataFrame:
    """Upsert on a unique key: source rows insert or overwrite every attribute.

    NULL source attributes do overwrite; target rows absent from the source are kept
    unchanged; ``loaded_at`` keeps the first load time, ``updated_at`` moves to ``now``
    for every key present in the source (changed or not).
    """
    t = target.select(F.col(key).alias("_k"), *[F.col(a).alias(f"_t_{a}") for a in attrs],
                      F.col("loaded_at").alias("_t_loaded"), F.col("updated_at").alias("_t_updated"))
    s = source.select(F.col(key).alias("_k"), *[F.col(a).alias(f"_s_{a}") for a in attrs],
                      F.lit(True).alias("_in_src"))
    j = t.join(s, "_k", "full_outer")
    hit = F.coalesce(F.col("_in_src"), F.lit(False))
    nowc = F.lit(now)
    cols = [F.col("_k").alias(key)]
    cols += [F.when(hit, F.col(f"_s_{a}")).otherwise(F.col(f"_t_{a}")).alias(a) for a in attrs]
    cols += [F.coalesce(F.col("_t_loaded"), nowc.cast(target.schema["loaded_at"].dataType)).alias("loaded_at"),
             F.when(hit, nowc.cast(target.schema["updated_at"].dataType)).otherwise(F.col("_t_updated"))
              .alias("updated_at")]
    return j.select(*cols)


def insert_absent(target: DataFrame, new: DataFrame, keys, order: str | None = None) -> DataFrame:
    """ON CONFLICT DO NOTHING: append new rows whose key is not yet in the target.

    Within ``new``, the first row per key by ``order`` wins (any row if ``order`` is None).
    """
    keys = list(keys)
    if order is None:
        cand = new.dropDuplicates(keys)
    else:
        others = [c for c in new.columns if c not in keys]
        best = F.min_by(F.struct(*[F.col(c) for c in others]), F.col(order)).alias("_b")
        cand = new.groupBy(*keys).agg(best).select(*keys, *[F.col("_b")[c].alias(c) for c in others])
        cand = cand.select(*new.columns)
    return target.unionByName(cand.join(target.select(*keys).distinct(), keys, "left_anti"))


def assign_ids(target: DataFrame, names: DataFrame, name: str, id_col: str = "id") -> DataFrame:
    """Stable surrogate keys: existing names keep their id, new names get max(id)+1… by name.

    Returns (name, id) for the new names only. The names are cut into ranges and numbered within
    them; the ranges' sizes, one row each, give the offsets. So no task sees all names. The
    ranges come from a sample, therefore the placed names are checkpointed.
    """
    checkpoint_dir(target.sparkSession)
    new = names.select(name).distinct().join(target.select(name), name, "left_anti")
    placed = new.repartitionByRange(F.col(name)).withColumn("_range", F.spark_partition_id()).checkpoint(eager=True)
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)   # one row per range
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    base = target.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar()  # scalar subquery
    place = F.row_number().over(Window.partitionBy("_range").orderBy(F.col(name)))
    return (placed.join(F.broadcast(starts), "_range")
                  .select(name, (base + F.col("_start") + place).cast(target.schema[id_col].dataType).alias(id_col)))


def append_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Append-only write (load log, forecast history)."""
    if partition_by:
        rebalanced(df, partition_by).write.mode("append").partitionBy(partition_by).parquet(path)
    else:
        df.write.mode("append").parquet(path)


def append_absent_table(spark: SparkSession, path: str, new: DataFrame, keys, partition_by: str) -> int:
    """Insert-only history keyed by ``keys`` (forecast runs): rows already present are skipped.

    Existing keys are read only from the partitions the new rows fall in, so a same-day
    rerun appends nothing. Returns the number of rows appended.
    """
    keys = list(keys)
    fresh = new.dropDuplicates(keys)
    if _exists(spark, path):
        parts = fresh.select(partition_by).distinct()
        cur = spark.read.parquet(path).join(parts, partition_by, "left_semi").select(*keys)
        fresh = fresh.join(cur, keys, "left_anti")
    fresh = fresh.checkpoint(eager=True)
    n = fresh.count()
    if n:
        append_table(fresh, path, partition_by)
    return n


def write_partitioned(df: DataFrame, path: str, by: str, mode: str = "append") -> None:
    """Physically partitioned write (e.g. by YYYYMM); Spark creates partitions on demand."""
    rebalanced(df, by).write.mode(mode).partitionBy(by).parquet(path)
