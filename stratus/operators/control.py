"""Control plane: load log, date gaps, pending chunks, layer gaps and their repair.

Gaps are found as *islands*: successful days are collected per (place, layer) as a
sorted set and the holes between consecutive days become ranges. Only the missing days are ever
materialised — there is no dates × places spine — so the work grows with the log and
the gaps, not with places × calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions import constants as K
from stratus.functions.dates import as_date_lit
from stratus.operators.setops import layer_diff
from stratus.sources.generators import day_sequence, month_sequence

LOG_COLUMNS = ["run_date", "city_name", "layer", "status", "rows_loaded", "expected_rows",
               "executed_at", "error_msg"]


def log_days(chunks: DataFrame, layer: str = "stage", now=None, expected: int = K.EXPECTED_ROWS_PER_DAY) -> DataFrame:
    """One log row per day of each chunk (city_name, start, end, status, rows_per_day, error_msg).

    ``rows_loaded`` is the chunk's real per-day count for successes and NULL for failures.
    """
    ex = F.lit(now).cast("timestamp_ntz") if now is not None else F.current_timestamp().cast("timestamp_ntz")
    return chunks.select(
        F.explode(day_sequence(F.col("start"), F.col("end"))).alias("run_date"),
        "city_name", F.lit(layer).alias("layer"), "status",
        F.when(F.col("status") == "success", F.col("rows_per_day").cast("int")).alias("rows_loaded"),
        F.lit(expected).alias("expected_rows"), ex.alias("executed_at"),
        F.col("error_msg").cast("string").alias("error_msg"))


def load_status(log: DataFrame) -> DataFrame:
    """Day-level status per (run_date, city_name, layer): any success counts.

    ``last_error`` is the text of the latest attempt that reported an error (ties → highest id).
    """
    order = F.struct(F.col("executed_at"), F.col("id")) if "id" in log.columns else F.col("executed_at")
    return (log.groupBy("run_date", "city_name", "layer")
               .agg(F.when(F.bool_or(F.col("status") == "success"), F.lit("success"))
                     .otherwise(F.lit("failed")).alias("status"),
                    F.count(F.lit(1)).alias("attempts"),
                    F.max_by(F.col("error_msg"), F.when(F.col("error_msg").isNotNull(), order))
                     .alias("last_error")))


def gap_ranges(done: DataFrame, universe: DataFrame, keys, day: str, start, end) -> DataFrame:
    """Missing-day ranges (gap_start, gap_end) per key of ``universe`` within [start, end].

    Successful days are collected per key as a sorted set (one shuffle with map-side
    de-duplication; a set holds at most one entry per calendar day of the window, so it
    is bounded by the window, not by the number of log rows). The holes between
    consecutive days — with sentinels start-1 and end+1 — are the gap ranges; a key
    without any success gets the whole window.
    """
    s, e = as_date_lit(start), as_date_lit(end)
    keys = list(keys)
    # de-duplicate (key, day) with a plain hash aggregate first (retries repeat days),
    # then gather the unique days of each key
    uniq = done.where(F.col(day).between(s, e)).select(*keys, F.col(day)).distinct()
    days = uniq.groupBy(*keys).agg(F.array_sort(F.collect_list(F.col(day))).alias("_days"))
    j = universe.select(*keys).distinct().join(days, keys, "left")
    ext = F.concat(F.array(F.date_sub(s, 1)), F.coalesce(F.col("_days"), F.array().cast("array<date>")),
                   F.array(F.date_add(e, 1)))
    holes = F.transform(F.sequence(F.lit(1), F.size(ext) - 1),
                        lambda i: F.struct(F.date_add(F.element_at(ext, i), 1).alias("gap_start"),
                                           F.date_sub(F.element_at(ext, i + 1), 1).alias("gap_end")))
    holes = F.filter(holes, lambda r: r["gap_start"] <= r["gap_end"])
    return (j.where(s <= e).select(*keys, F.explode(holes).alias("_g"))
             .select(*keys, F.col("_g.gap_start").alias("gap_start"), F.col("_g.gap_end").alias("gap_end")))


def date_gaps(log: DataFrame, cities: DataFrame, start=K.HISTORY_START, end=None, today=None,
              layers=K.LAYERS, city_col: str = "city_name") -> DataFrame:
    """(missing_date, city_name, layer) with no successful load, for days start..end.

    ``end`` defaults to the day before ``today``. Places come from ``cities`` (a place
    never in the dimension is invisible, as in the original view).
    """
    if end is None:
        end = F.date_sub(as_date_lit(today), 1)
    universe = cities.select(F.col(city_col).alias("city_name")).distinct() \
                     .select("city_name", F.explode(F.array(*[F.lit(x) for x in layers])).alias("layer"))
    done = log.where(F.col("status") == "success").select("city_name", "layer", "run_date")
    rng = gap_ranges(done, universe, ["city_name", "layer"], "run_date", start, end)
    return rng.select(F.explode(day_sequence(F.col("gap_start"), F.col("gap_end"))).alias("missing_date"),
                      "city_name", "layer")


def missing_days_per_city(gaps: DataFrame, layer: str = "stage") -> DataFrame:
    return (gaps.where(F.col("layer") == layer).groupBy("city_name")
                .agg(F.count(F.lit(1)).alias("missing_days")))


def pending_chunks(log: DataFrame, cities_cfg: DataFrame, year_from: int, yesterday_date,
                   layer: str = "stage") -> DataFrame:
    """(city_name, chunk_start, chunk_end): month chunks of active places with any day unloaded.

    Chunks run from Jan 1 of ``year_from`` to ``yesterday_date``; the last is capped there.
    """
    start = F.make_date(F.lit(year_from), F.lit(1), F.lit(1))
    end = as_date_lit(yesterday_date)
    universe = cities_cfg.where(F.coalesce(F.col("active"), F.lit(False))) \
                         .select(F.col("name").alias("city_name")).distinct()
    done = log.where((F.col("status") == "success") & (F.col("layer") == layer)) \
              .select("city_name", "run_date")
    rng = gap_ranges(done, universe, ["city_name"], "run_date", start, end)
    months = rng.select("city_name", F.explode(month_sequence(F.col("gap_start"), F.col("gap_end"))).alias("m"))
    return (months.distinct()
                  .select("city_name", F.col("m").alias("chunk_start"),
                          F.least(F.last_day("m"), end).alias("chunk_end")))


def month_window(d: Column, today) -> list[Column]:
    """(start_date, end_date) of d's month, end capped at the day before ``today``."""
    return [F.trunc(d, "month").alias("start_date"),
            F.least(F.last_day(d), F.date_sub(as_date_lit(today), 1)).alias("end_date")]


def gap_months(upstream: DataFrame, downstream: DataFrame, keys, day: str, today) -> DataFrame:
    """Months holding a key tuple (…, day) present upstream but missing downstream."""
    diff = layer_diff(upstream, downstream, [*keys, day])
    return diff.select(*month_window(F.col(day), today)).distinct()


def fill_gaps(upstream: DataFrame, downstream: DataFrame, recompute, gaps: DataFrame, day: str,
              up_day: str | None = None) -> DataFrame:
    """Downstream with every gap month [start_date, end_date] replaced by a recomputation.

    One set-based job (no loop over months): downstream rows inside a gap window are
    dropped, upstream rows inside one are recomputed with ``recompute(df)`` and appended.
    A window whose start is after its end (a month that is only "today") changes nothing.
    ``gaps`` holds a few rows per month and is broadcast for the range match.
    """
    up_day = up_day or day
    g = F.broadcast(gaps.where(F.col("start_date") <= F.col("end_date"))
                        .select(F.col("start_date").alias("_gs"), F.col("end_date").alias("_ge"),
                                F.col("start_date").alias("_gm")))
    up = upstream.withColumn("_um", F.trunc(F.to_date(F.col(up_day)), "month"))
    fresh = recompute(up.join(g, (up["_um"] == g["_gm"]) & F.to_date(F.col(up_day)).between(g["_gs"], g["_ge"]),
                              "left_semi").drop("_um"))
    dn = downstream.withColumn("_dm", F.trunc(F.to_date(F.col(day)), "month"))
    keep = dn.join(g, (dn["_dm"] == g["_gm"]) & F.to_date(F.col(day)).between(g["_gs"], g["_ge"]),
                   "left_anti").drop("_dm")
    return keep.unionByName(fresh)


def incomplete_days(log: DataFrame) -> DataFrame:
    """Successful loads whose row count differs from the expected count."""
    return (log.where((F.col("status") == "success") & (F.col("rows_loaded") != F.col("expected_rows")))
               .select("run_date", "city_name", "layer", "rows_loaded", "expected_rows"))


def hours_per_day(stage: DataFrame, loc: str = "location_name", ts: str = "measured_at",
                  expected: int = K.EXPECTED_ROWS_PER_DAY, tz: str | None = None) -> DataFrame:
    """Stage rows per (place, day) that differ from the expected count.

    The expectation is ``expected`` (24), or with ``tz`` (a time-zone column) the real
    number of hours of that local day, so daylight-saving days expect 23 or 25.
    """
    keys = [F.col(loc).alias("city_name"), F.to_date(F.col(ts)).alias("day")]
    if tz is None:
        return (stage.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
                     .where(F.col("n_rows") != expected)
                     .withColumn("expected_rows", F.lit(expected)))
    from stratus.functions.dates import expected_hours
    per = stage.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.col(tz)).alias("_tz"))
    return (per.withColumn("expected_rows", expected_hours(F.col("day"), F.col("_tz")))
               .where(F.col("n_rows") != F.col("expected_rows")).drop("_tz"))


def run_ok(attempts: DataFrame, by=("run_date",), phase: str | None = None) -> DataFrame:
    """Run verdict: fail only if there were hard failures and the incremental phase loaded nothing.

    ``phase`` names the column of the attempts' phase; failures of any phase count, successes
    only of the phase ``incremental``. Without it every success counts.
    """
    counts = F.lit(True) if phase is None else F.col(phase) == "incremental"
    return (attempts.groupBy(*by)
                    .agg(F.count_if((F.col("status") == "success") & counts).alias("n_success"),
                         F.count_if(F.col("status") == "failed").alias("n_failed"))
                    .withColumn("ok", ~((F.col("n_failed") > 0) & (F.col("n_success") == 0))))


def register_gap_view(spark, log: DataFrame, cities: DataFrame, today, start=K.HISTORY_START,
                      name: str = "v_date_gaps") -> DataFrame:
    """The stored gap view: a temp view over :func:`date_gaps` queryable with SQL."""
    gaps = date_gaps(log, cities, start=start, today=today)
    gaps.createOrReplaceTempView(name)
    return gaps
