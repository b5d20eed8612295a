"""Joins of facts to dimensions.

Join strategy policy:

- Fixed-size literal dimensions (16 compass bands, their ≤361 integer degrees, WMO codes)
  are broadcast explicitly: their size is bounded by construction.
- Data-derived dimensions (places, countries, calendars over a data span) carry no hint.
  Catalyst broadcasts them only when their estimated size is under
  ``spark.sql.autoBroadcastJoinThreshold``; AQE re-checks with runtime sizes and otherwise
  keeps a shuffled sort-merge join (with skew splitting). Beyond the threshold the plan
  therefore degrades to a partitioned join instead of failing.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.session import checkpoint_dir


def band_join(df: DataFrame, deg: str, bands: DataFrame, out: str,
              lo: str = "degree_from", hi: str = "degree_to", id_col: str = "id") -> DataFrame:
    """Left range join ``deg BETWEEN lo AND hi`` (the original formulation).

    Planned as a BroadcastNestedLoopJoin against the tiny band table; rows with NULL
    or unmatched degrees keep a NULL id. Prefer :func:`band_lookup` on large inputs.
    """
    b = F.broadcast(bands.select(F.col(id_col).alias(out), F.col(lo).alias("_lo"), F.col(hi).alias("_hi")))
    return (df.join(b, F.col(deg).between(F.col("_lo"), F.col("_hi")), "left")
              .drop("_lo", "_hi"))


def degree_index(bands: DataFrame, lo: str = "degree_from", hi: str = "degree_to",
                 id_col: str = "id") -> DataFrame:
    """(degree, id, degree_to) for every integer degree a band covers (≤ 361 rows for compass bands)."""
    return bands.select(F.explode(F.sequence(F.col(lo).cast("int"), F.col(hi).cast("int"))).alias("_deg"),
                        F.col(id_col).alias("_id"), F.col(hi).cast("int").alias("_to"))


def band_lookup(df: DataFrame, deg: str, bands: DataFrame, out: str,
                lo: str = "degree_from", hi: str = "degree_to", id_col: str = "id") -> DataFrame:
    """Same result as :func:`band_join`, as a broadcast *hash* join on ``floor(deg)``.

    With integer, disjoint bands, ``deg`` lies in [lo, hi] iff ``floor(deg)`` is a
    covered degree of the band and ``ceil(deg) <= hi``. So 11.5 (between N's 11 and
    NNE's 12) matches nothing, exactly like the BETWEEN join.
    """
    idx = F.broadcast(degree_index(bands, lo, hi, id_col))
    d = F.col(deg)
    near = d.cast("double").between(-1e9, 1e9)  # no band lies beyond; NaN and infinities don't either
    tmp = (df.withColumn("_fdeg", F.when(near, F.floor(d)).cast("int"))
             .withColumn("_cdeg", F.when(near, F.ceil(d)).cast("int")))
    j = tmp.join(idx, tmp["_fdeg"] == idx["_deg"], "left")
    return (j.withColumn(out, F.when(F.col("_cdeg") <= F.col("_to"), F.col("_id")))
             .drop("_fdeg", "_cdeg", "_deg", "_id", "_to"))


def compass16(deg: str):
    """Arithmetic 16-point compass id (1 = N … 16 = NNW), wrapping at 360°.

    Sector i covers [(i-1)·22.5 − 11.25, (i-1)·22.5 + 11.25). This is the geometric
    compass, not the inclusive integer bands of the dimension table.
    """
    d = F.col(deg)
    return (F.pmod(F.floor((d + F.lit(11.25)) / F.lit(22.5)), F.lit(16)) + 1).cast("smallint")


def lookup_id(df: DataFrame, dim: DataFrame, name_col: str, dim_name: str, dim_id: str,
              out: str) -> DataFrame:
    """Scalar-subquery style id lookup by unique name (NULL when absent)."""
    d = dim.select(F.col(dim_name).alias("_n"), F.col(dim_id).alias(out))
    return df.join(d, df[name_col] == d["_n"], "left").drop("_n")


def fully_present(chunks: DataFrame, done: DataFrame, key: str, start: str, end: str,
                  done_key: str, done_day: str) -> DataFrame:
    """Month chunks whose every day in [start, end] is present in ``done``.

    Each done day is matched to the one chunk of its (key, month) by an equi join, so
    the work is linear in the done days (no day spine, no pairs within a key); present
    days are counted and compared with the chunk length.
    """
    d = (done.select(F.col(done_key).alias("_k"), F.col(done_day).alias("_d")).distinct()
             .withColumn("_m", F.trunc(F.col("_d"), "month")))
    c = chunks.withColumn("_m", F.trunc(F.col(start), "month"))
    hit = (c.join(d, (c[key] == d["_k"]) & (c["_m"] == d["_m"]) & d["_d"].between(c[start], c[end]), "inner")
             .groupBy(c[key], c[start], c[end]).agg(F.count(F.lit(1)).alias("_have")))
    return (c.join(hit, [key, start, end], "left")
             .where(F.coalesce(F.col("_have"), F.lit(0)) == F.datediff(F.col(end), F.col(start)) + 1)
             .drop("_m", "_have"))


def join_calendar(fact: DataFrame, calendar: DataFrame, key: str = "date_id") -> DataFrame:
    """Fact → calendar on the integer date key (inner). The calendar has one row per day
    of a bounded span (36,890 for 1950–2050), so it is broadcast."""
    cal = calendar.withColumnRenamed("id", "_cal_id")
    return fact.join(F.broadcast(cal), fact[key] == cal["_cal_id"], "inner").drop("_cal_id")


def enrich_from_config(df: DataFrame, cfg: DataFrame, name_col: str, cols, cfg_name: str = "name") -> DataFrame:
    """Left join of config attributes by place name (a place absent from the config gets NULLs)."""
    c = cfg.select(F.col(cfg_name).alias("_cfg_name"), *cols)
    return df.join(c, df[name_col] == c["_cfg_name"], "left").drop("_cfg_name")


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str,
              allow_equal: bool = True) -> DataFrame:
    """Every row of ``left`` with the columns of the latest row of ``right`` of its key, at or before its time.

    Both sides go through one shuffle on the key and one ordered pass that carries the last right row along;
    no pairs are formed. ``allow_equal=False`` asks for strictly earlier rows. Rows without an earlier one get
    NULLs. Names must differ but for the key.
    """
    own = [c for c in right.columns if c not in by]
    rest = [c for c in left.columns if c not in by]
    rights = right.select(*by, F.col(right_time).alias("_t"), F.lit(0 if allow_equal else 2).alias("_o"),
                          F.struct(*own).alias("_r"), F.lit(None).cast(left.select(F.struct(*rest)).schema[0].dataType).alias("_l"))
    lefts = left.select(*by, F.col(left_time).alias("_t"), F.lit(1).alias("_o"),
                        F.lit(None).cast(rights.schema["_r"].dataType).alias("_r"), F.struct(*rest).alias("_l"))
    so_far = Window.partitionBy(*by).orderBy("_t", "_o").rowsBetween(Window.unboundedPreceding, 0)
    return (rights.unionByName(lefts).withColumn("_r", F.last("_r", ignorenulls=True).over(so_far))
            .where(F.col("_l").isNotNull()).select(*by, "_l.*", "_r.*"))


#: Bins of a level are so many times as wide as those of the level below.
LEVEL_STEP = 4


def binned_range_join(points: DataFrame, intervals: DataFrame, point: str, low: str, high: str, width: float | None = None,
                      by: list[str] | None = None, how: str = "inner", include_high: bool = True,
                      totals: dict[str, tuple[Column, Callable[[str], Column]]] | None = None) -> DataFrame:
    """Points joined with the intervals ``[low, high]`` that hold them; intervals may overlap and differ in width.

    The axis is cut into bins, finer and coarser ones: an interval stands on the level whose bins are about as wide as
    itself, so in two bins or three at most, and a point looks up its bin on every level in use. So the join is a hash
    or sort-merge join on (level, bin), and only the bounds are compared then. ``width`` is that of the finest bins
    (default: the median width of the intervals, one small job). ``by``: further equal columns.

    Defined results: NULL and NaN points and intervals with a NULL or NaN end, or ``low > high``, match nothing; infinite
    intervals stand in one bin of their own level. Names of the two sides must differ but for ``by``.

    ``totals`` joins every interval with totals of its points instead of the points: by name, an aggregate of points and
    the aggregate that merges such partial ones (``{"n": (F.count("id"), F.sum)}``). Then the work grows with points and
    intervals, not with their pairs, see :func:`_range_totals`; ``width`` has no meaning.
    """
    by = list(by or [])
    if totals is not None:
        if how != "inner":
            raise ValueError("totals are of the inner join")
        return _range_totals(points, intervals, point, low, high, by, include_high, totals)
    lo, hi, x = (F.col(c).cast("double") for c in (low, high, point))
    inf = F.lit(float("inf"))
    sound = intervals.where(~F.isnan(lo) & ~F.isnan(hi) & (lo <= hi))
    if width is None:
        width = sound.where((hi - lo < inf) & (hi > lo)).agg(F.percentile_approx(hi - lo, 0.5)).first()[0]
    width = float(width or 1.0)
    wide = (F.abs(lo) == inf) | (F.abs(hi) == inf)
    level = F.when(wide, -1).otherwise(
        F.greatest(F.lit(0), F.ceil(F.log(float(LEVEL_STEP), F.greatest((hi - lo) / width, F.lit(1.0))))).cast("int"))

    def bin_of(c: Column, lev: Column) -> Column:
        return F.when(lev < 0, F.lit(0.0)).otherwise(F.floor(c / (F.lit(width) * F.pow(F.lit(float(LEVEL_STEP)), lev))).cast("double"))

    placed = sound.withColumn("_level", level)
    levels = [r[0] for r in placed.select("_level").distinct().collect()]   # a few: one for each fourfold width
    first, last = bin_of(lo, F.col("_level")), bin_of(hi, F.col("_level"))
    # few bins by construction; counted from the first one, as doubles beyond a long have no bin number
    placed = placed.withColumn("_bin", F.explode(F.transform(F.sequence(F.lit(0), (last - first).cast("int")), lambda k: first + k)))
    asked = points if how == "left" else points.where(x.isNotNull() & ~F.isnan(x))
    numbered = asked.withColumn("_level", F.explode_outer(F.array(*(F.lit(v) for v in levels)).cast("array<int>"))).withColumn("_bin", bin_of(x, F.col("_level")))
    within = (x >= lo) & ((x <= hi) if include_high else (x < hi))
    if how == "inner":
        return numbered.join(placed, [*by, "_level", "_bin"]).where(within).drop("_level", "_bin")
    if how != "left":
        raise ValueError("how is inner or left")
    keyed = asked.withColumn("_row", F.monotonically_increasing_id()).checkpoint(eager=True)   # row numbers must not change
    found = binned_range_join(keyed, intervals, point, low, high, width, by, "inner", include_high)
    return keyed.join(found.drop(*[c for c in points.columns]), "_row", "left").drop("_row")


#: So many cells of one level make a cell of the next one.
CELL_STEP = 8


def _range_totals(points: DataFrame, intervals: DataFrame, point: str, low: str, high: str, by: list[str], include_high: bool,
                  totals: dict[str, tuple[Column, Callable[[str], Column]]]) -> DataFrame:
    """Every interval that holds points, with totals over them, without their pairs.

    Distinct points are numbered in order; bins are cells of 1, 8, 64, ... consecutive numbers, so none holds more than its
    share however the points crowd. An interval is a run of numbers, cut into the fewest cells: at most 14 on each
    level. So points and intervals meet in some n log n rows, and a frequent value is one row.
    """
    checkpoint_dir(points.sparkSession)
    lo, hi, x = (F.col(c).cast("double") + 0.0 for c in (low, high, point))    # one zero only
    keys = [f"_by{i}" for i in range(len(by))]
    keyed = [F.col(c).alias(k) for c, k in zip(by, keys)]
    known = [F.col(c).isNotNull() for c in by]

    def every(conditions: list[Column]) -> Column:
        return reduce(lambda a, b: a & b, conditions)

    values = (points.where(every([x.isNotNull(), ~F.isnan(x), *known])).groupBy(*keyed, x.alias("_v"))
              .agg(*(whole.alias(f"_p{i}") for i, (whole, _) in enumerate(totals.values()))).checkpoint(eager=True))
    sound = (intervals.where(every([~F.isnan(lo), ~F.isnan(hi), lo <= hi, *known]))
             .withColumns({"_id": F.monotonically_increasing_id(), "_lo": lo, "_hi": hi}).checkpoint(eager=True))   # ids must not change
    partial = [f"_p{i}" for i in range(len(totals))]

    # what an end comes after: of equal values the low end stands before the point, an included high end behind it
    at_high = 2 if include_high else 0
    ends = sound.select(*keyed, F.explode(F.array(F.struct(F.col("_lo").alias("_v"), F.lit(0).alias("_o")),
                                                  F.struct(F.col("_hi").alias("_v"), F.lit(at_high).alias("_o")))).alias("_e"))
    line = (values.withColumn("_o", F.lit(1)).unionByName(ends.select(*keys, "_e.*").distinct(), allowMissingColumns=True)
            .repartitionByRange(*(F.col(c) for c in (*keys, "_v", "_o")))
            .withColumn("_range", F.spark_partition_id()).checkpoint(eager=True))   # ranges come from a sample
    is_point = F.when(F.col("_o") == 1, 1).otherwise(0)
    sizes = line.groupBy("_range").agg(F.sum(is_point).alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)   # one row per range
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    so_far = Window.partitionBy("_range").orderBy(*keys, "_v", "_o").rowsBetween(Window.unboundedPreceding, 0)
    # the number of points before; a point has its own number
    line = (line.join(F.broadcast(starts), "_range")
            .withColumn("_at", (F.col("_start") + F.sum(is_point).over(so_far) - is_point).cast("long"))
            .drop("_range", "_start").checkpoint(eager=True))

    n = line.where("_o = 1").count()
    steps, size = [1], n
    while size > CELL_STEP:
        steps.append(steps[-1] * CELL_STEP)
        size = -(-size // CELL_STEP)
    cell = F.explode(F.array(*(F.struct(F.lit(j).alias("_level"), F.floor(F.col("_at") / F.lit(s)).alias("_cell"))
                               for j, s in enumerate(steps))))
    cells = (line.where("_o = 1").select(*partial, cell.alias("_c")).groupBy("_c._level", "_c._cell")
             .agg(*(merge(p).alias(p) for p, (_, merge) in zip(partial, totals.values()))))

    def end(value: str, order: int, out: str) -> DataFrame:
        return line.where(F.col("_o") == order).select(*keys, F.col("_v").alias(value), F.col("_at").alias(out))

    runs = (sound.select("_id", *keyed, "_lo", "_hi").join(end("_lo", 0, "_a"), [*keys, "_lo"])
            .join(end("_hi", at_high, "_b"), [*keys, "_hi"]).where("_a < _b"))
    cover = runs.select("_id", F.explode(_cells_of(steps)).alias("_c")).select("_id", "_c.*")
    found = (cover.join(cells, ["_level", "_cell"]).groupBy("_id")
             .agg(*(merge(p).alias(name) for p, (name, (_, merge)) in zip(partial, totals.items()))))
    return sound.drop("_lo", "_hi").join(found, "_id").drop("_id")


def _cells_of(steps: list[int]) -> Column:
    """The fewest cells of the given sizes that make up the run of numbers from ``_a`` to before ``_b``."""
    none = F.array().cast("array<struct<_level:int,_cell:bigint>>")

    def cells(level: int, first: Column, after: Column) -> Column:
        return F.when(first < after, F.transform(F.sequence(first, after - 1), lambda c: F.struct(F.lit(level).alias("_level"), c.alias("_cell")))).otherwise(none)

    def up(c: str, size: int) -> Column:
        return F.ceil(F.col(c) / F.lit(size)).cast("long")

    def down(c: str, size: int) -> Column:
        return F.floor(F.col(c) / F.lit(size)).cast("long")

    parts = []
    for level, size in enumerate(steps):
        first, after = up("_a", size), down("_b", size)
        if level + 1 < len(steps):
            left = F.least(up("_a", size * CELL_STEP) * CELL_STEP, after)
            right = F.greatest(down("_b", size * CELL_STEP) * CELL_STEP, left)
            parts += [cells(level, first, left), cells(level, right, after)]
        else:
            parts.append(cells(level, first, after))
    return F.concat(*parts)
