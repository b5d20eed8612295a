"""Dashboard measures over the daily mart (formulas are ours; the original defines them in prose).

All measures are aggregates over the mart, grouped by a period or by a place level.
Period comparisons build a gap-free period spine with ``explode(sequence)`` before
``lag`` so "previous" always means the previous calendar period, not the previous row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.functions.constants import CLIMATE_GROUPS
from stratus.functions.dates import as_date_lit
from stratus.functions.numeric import round2
from stratus.operators.windows import rank_by
from stratus.session import checkpoint_dir

# measure name → aggregate over mart columns (the dashboard's metric switcher)
MEASURES = {
    "avg_temperature": lambda: F.avg("temp_avg"),
    "total_precipitation": lambda: F.sum("precipitation_sum"),
    "avg_pressure": lambda: F.avg("pressure_avg"),
    "sunshine_hours": lambda: F.sum("sunshine_hours"),
    "rainy_days": lambda: F.count_if(F.col("is_rainy_day")),
    "avg_humidity": lambda: F.avg("humidity_avg"),
    "max_temperature": lambda: F.max("temp_max"),
    "min_temperature": lambda: F.min("temp_min"),
    "max_gusts": lambda: F.max("wind_gusts_max"),
}
KPI_NAMES = ["avg_temperature", "total_precipitation", "avg_pressure", "sunshine_hours", "rainy_days"]


def measure(name: str) -> Column:
    """Aggregate expression of a named measure (raises KeyError for unknown names)."""
    return MEASURES[name]()


def _rounded(name: str) -> Column:
    c = measure(name)
    return c.cast("bigint") if name == "rainy_days" else round2(c)


def slice_by(df: DataFrame, start=None, end=None, date_col: str = "date", region=None, country=None,
             city=None, zone=None) -> DataFrame:
    """Optional dashboard slicers (period, region, country, city, climate group)."""
    out = df
    if start is not None:
        out = out.where(F.col(date_col) >= as_date_lit(start))
    if end is not None:
        out = out.where(F.col(date_col) <= as_date_lit(end))
    for col, v in (("region", region), ("country_name", country), ("city_name", city)):
        if v is not None:
            out = out.where(F.col(col) == F.lit(v))
    if zone is not None:
        out = out.where(climate_group(F.col("climate_zone")) == F.lit(zone))
    return out


def capitals_only(df: DataFrame, col: str = "is_capital") -> DataFrame:
    return df.where(F.coalesce(F.col(col), F.lit(False)))


def climate_group(code: Column) -> Column:
    """Köppen code → one of six groups (case-insensitive; unknown → NULL)."""
    m = F.create_map(*[x for kv in CLIMATE_GROUPS.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return m[F.upper(F.trim(code))]


def kpis(mart: DataFrame, by=None, start=None, end=None) -> DataFrame:
    """The five headline KPIs over a period, optionally grouped (e.g. by year)."""
    src = slice_by(mart, start, end)
    cols = [_rounded(n).alias(n) for n in KPI_NAMES]
    return src.groupBy(*(by or [])).agg(*cols)


def kpis_yoy(mart: DataFrame, date_col: str = "date") -> DataFrame:
    """KPIs per year with the previous year's values and the deltas (NULL for the first year)."""
    return year_over_year(kpis(mart.withColumn("year", F.year(date_col)), by=["year"]))


def year_over_year(yearly: DataFrame) -> DataFrame:
    """``year`` and the KPIs, years between filled in, with the previous year's values and the deltas."""
    span = yearly.agg(F.min("year").alias("_a"), F.max("year").alias("_b"))
    spine = span.select(F.explode(F.sequence("_a", "_b")).alias("year"))
    full = spine.join(yearly, "year", "left")
    w = Window.orderBy("year")  # one row per year: a tiny, bounded window
    out = full
    for n in KPI_NAMES:
        out = out.withColumn(f"prev_{n}", F.lag(n).over(w))
        delta = F.col(n) - F.col(f"prev_{n}")
        out = out.withColumn(f"delta_{n}", delta if n == "rainy_days" else round2(delta))
    return out


def kpis_of_period(mart: DataFrame, start, end, date_col: str = "date") -> DataFrame:
    """KPIs of a period, of the same period a year before, and the deltas: one row.

    Part years are compared with the same part of the year before.
    """
    day, a, b = F.col(date_col), as_date_lit(start), as_date_lit(end)
    now, before = day.between(a, b), day.between(F.add_months(a, -12), F.add_months(b, -12))
    halves = kpis(mart.where(now | before).withColumn("_now", now), by=["_now"])   # at most two rows
    out = halves.agg(*(F.max(F.when(flag, F.col(n))).alias(p + n) for p, flag in (
        ("", F.col("_now")), ("prev_", ~F.col("_now"))) for n in KPI_NAMES))
    deltas = {f"delta_{n}": F.col(n) - F.col(f"prev_{n}") for n in KPI_NAMES}
    return out.withColumns({k: d if k == "delta_rainy_days" else round2(d) for k, d in deltas.items()})


def period_compare(mart: DataFrame, name: str, unit: str = "month", date_col: str = "date",
                   by=None) -> DataFrame:
    """Measure per period (month/quarter/year) with the previous period's value and delta."""
    by = list(by or [])
    p = F.trunc(F.col(date_col), unit).alias("period")
    per = mart.groupBy(*by, p).agg(_rounded(name).alias("value"))
    step = {"month": "INTERVAL 1 MONTH", "quarter": "INTERVAL 3 MONTHS", "year": "INTERVAL 1 YEAR"}[unit]
    span = per.groupBy(*by).agg(F.min("period").alias("_a"), F.max("period").alias("_b"))
    spine = span.select(*by, F.explode(F.sequence("_a", "_b", F.expr(step))).alias("period"))
    full = spine.join(per, [*by, "period"], "left")
    w = Window.partitionBy(*by).orderBy("period")
    prev = F.lag("value").over(w)
    return full.select(*by, "period", "value", prev.alias("prev_value"),
                       (F.col("value") - prev).alias("_d")) \
               .withColumn("delta", F.col("_d") if name == "rainy_days" else round2(F.col("_d"))).drop("_d")


FLAGS = {"hot": "is_hot_day", "frost": "is_frost_day", "rainy": "is_rainy_day", "snowy": "is_snowy_day"}


def extreme_ranking(wide: DataFrame, flag: str = "hot") -> DataFrame:
    """Region → country → city roll-up of extreme-day shares and extremes, ranked per level.

    Flag shares are 100·avg(flag as double) over days with a known flag (NULL flags
    leave numerator and denominator). ``level`` is 0 city, 1 country, 2 region, 3 all.
    """
    flags = ["is_hot_day", "is_frost_day", "is_rainy_day"]
    keys = ["region", "country_name", "city_name"]
    # days are summed per place first; the roll-up expands places, not days
    places = wide.groupBy(*keys).agg(
        *(F.sum(F.col(c).cast("double")).alias(f"_s_{c}") for c in flags), *(F.count(c).alias(f"_n_{c}") for c in flags),
        F.max("temp_max").alias("max_temp"), F.min("temp_min").alias("min_temp"), F.max("wind_gusts_max").alias("max_gusts"))

    def pct(c: str) -> Column:
        return round2(F.lit(100.0) * F.try_divide(F.sum(f"_s_{c}"), F.sum(f"_n_{c}")))

    agg = (places.rollup(*keys)
                 .agg(F.grouping_id().alias("_gid"),
                      pct("is_hot_day").alias("hot_pct"), pct("is_frost_day").alias("frost_pct"),
                      pct("is_rainy_day").alias("rainy_pct"),
                      F.max("max_temp").alias("max_temp"), F.min("min_temp").alias("min_temp"),
                      F.max("max_gusts").alias("max_gusts")))
    level = (F.when(F.col("_gid") == 0, 0).when(F.col("_gid") == 1, 1)
              .when(F.col("_gid") == 3, 2).otherwise(3)).alias("level")
    agg = agg.select(level, "region", "country_name", "city_name", "hot_pct", "frost_pct", "rainy_pct",
                     "max_temp", "min_temp", "max_gusts")
    checkpoint_dir(agg.sparkSession)
    agg = agg.checkpoint(eager=True)   # a row per place: the ranking reads it twice
    return rank_by(agg, f"{flag}_pct", part="level", out="rank")


def climate_scatter(wide: DataFrame) -> DataFrame:
    """Per place: average temperature, total precipitation, average humidity, climate group."""
    return (wide.groupBy("city_name", "climate_zone")
                .agg(round2(F.avg("temp_avg")).alias("avg_temperature"),
                     round2(F.sum("precipitation_sum")).alias("total_precipitation"),
                     round2(F.avg("humidity_avg")).alias("avg_humidity"))
                .withColumn("climate_group", climate_group(F.col("climate_zone"))))


def map_values(wide: DataFrame, name: str) -> DataFrame:
    """Per place with coordinates: the chosen measure (map layer)."""
    return (wide.groupBy("city_name", "latitude", "longitude")
                .agg(_rounded(name).alias("value")))
