"""Dashboards from monthly states, bounded year partitions, bucketed joins, open payloads."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stratus.operators import bounded, measures, partials
from stratus.operators.mart import MART_FLAGS, MART_MEASURES
from stratus.sources import variants


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def mart(spark, n=400, seed=3):
    rng = random.Random(seed)
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=k) for k in range(0, 800, 3)]
    number = lambda: None if rng.random() < 0.2 else round(rng.uniform(-20, 40), 2)
    rows = [(d, c, *(number() for _ in MART_MEASURES), *(rng.choice([True, False, None]) for _ in MART_FLAGS))
            for d, c in {(rng.choice(days), rng.randrange(5)) for _ in range(n)}]
    kinds = [f"{m} double" for m in MART_MEASURES] + [f"{f} boolean" for f in MART_FLAGS]
    return spark.createDataFrame(rows, "date date, city_id long, " + ", ".join(kinds)).withColumn("ym", partials.month_key(F.col("date")))


def test_measures_from_states_equal_the_direct_ones(spark):
    rows = mart(spark)
    states = partials.month_states(rows.drop("ym"))
    direct = rows.groupBy("city_id").agg(*(measures.measure(n).alias(n) for n in partials.VALUES))
    got = partials.merged(states, "city_id").select("city_id", *(partials.value(n).alias(n) for n in partials.VALUES))
    want = {r.city_id: r for r in direct.collect()}
    for r in got.collect():
        assert all(abs(r[n] - want[r.city_id][n]) < 0.00501 for n in partials.VALUES)
    yearly = partials.yearly_kpis(states, measures.KPI_NAMES)
    whole = measures.kpis(rows.withColumn("year", F.year("date")), by=["year"])
    assert [r.rainy_days for r in yearly.orderBy("year").collect()] == [r.rainy_days for r in whole.orderBy("year").collect()]
    days = {r.ym: r.n_days for r in partials.days_with_data(states).collect()}
    assert days == {r.ym: r.n for r in rows.groupBy("ym").agg(F.countDistinct("date").alias("n")).collect()}


def even(states):
    """In one order of columns, sums without the last bits that depend on the order of adding."""
    return states.select(*(F.round(c, 6).alias(c) if c.startswith("s_") else c for c in sorted(states.columns)))


def test_only_changed_months_are_worked_out_again(spark, tmp_path):
    table, states = str(tmp_path / "mart"), str(tmp_path / "states")
    rows = mart(spark).cache()
    rows.where("ym < 202106").write.partitionBy("ym").parquet(table)
    read = lambda: spark.read.schema(rows.schema).parquet(table)
    _, first = partials.refresh(spark, states, read())
    assert len(first) == rows.where("ym < 202106").select("ym").distinct().count()
    assert partials.refresh(spark, states, read())[1] == []
    rows.where("ym = 202106 OR ym = 202002").limit(10 ** 6).write.mode("append").partitionBy("ym").parquet(table)
    got, again = partials.refresh(spark, states, read())
    assert again == [202002, 202106]
    want = even(partials.month_states(read().drop("ym")))
    assert even(got).exceptAll(want).count() == 0 and want.exceptAll(even(got)).count() == 0
    got, again = partials.refresh(spark, states, read(), written=[202003])  # same count, perhaps other values
    assert again == [202003] and even(got).exceptAll(want).count() == 0
    place = spark.createDataFrame([(1, "a", 0.0, 0.0)], "id long, city_name string, latitude double, longitude double")
    p = plan(partials.map_values(got, place, "max_gusts"))
    assert table not in p and p.count("FileScan parquet") == 1  # no day row is read
    gone = read().where("ym <> 202002")
    assert partials.refresh(spark, states, gone)[1] == [202002] and partials.refresh(spark, states, gone)[1] == []
    empty, months = partials.refresh(spark, str(tmp_path / "none"), rows.limit(0))
    assert months == [] and empty.count() == 0


@pytest.mark.parametrize("day", [dt.date(1994, 12, 31), dt.date(2002, 1, 1), None])
def test_a_day_outside_the_partitions_ends_the_write(spark, tmp_path, day):
    path = str(tmp_path / "fact")
    good = spark.createDataFrame([(dt.date(1995, 1, 1), 1), (dt.date(2001, 12, 31), 2)], "day date, v int")
    bounded.write_years(good, path, "day", 1995, 2001)
    bad = spark.createDataFrame([(dt.date(1996, 1, 1), 3), (day, 4)], "day date, v int")
    with pytest.raises(Exception, match="no partition for day"):
        bounded.write_years(bad, path, "day", 1995, 2001)
    kept = spark.read.parquet(path)
    assert sorted(tuple(r) for r in kept.select("v", "year").collect()) == [(1, 1995), (2, 2001)]  # nothing of the bad write
    again = bounded.write_years(good.where("v = 1").withColumn("v", F.lit(9)), path, "day", 1995, 2001, mode="overwrite")
    assert sorted(r.v for r in again.collect()) == [2, 9]


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    facts = spark.range(2000).select((F.col("id") % 90).alias("place"), "id")
    a = bounded.bucketed(spark, facts, "place", 4, "bf", str(tmp_path / "a"))
    b = bounded.bucketed(spark, spark.range(100).withColumnRenamed("id", "pid"), "pid", 4, "bp", str(tmp_path / "b"))
    joined = a.hint("merge").join(b, a["place"] == b["pid"])
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined) and joined.count() == 2000


def test_undeclared_variables_are_kept_and_read_by_path(spark):
    docs = ['{"name":"a","hourly":{"time":["2024-01-01T00:00","2024-01-01T01:00"],"temperature_2m":[1,2],"dust":[1.5,"much"],"note":["x",null]}}',
            '{"name":"b","hourly":{"time":["2024-01-01T00:00"],"temperature_2m":[1],"dust":[]}}',
            '{"name":"c","hourly":{"temperature_2m":[1]}}', '{"hourly":{"time":[]}}', '{"name":"d","hourly":', None, "",
            '{"name":"e","hourly":{"time":[],"dust":[]}}']
    landed = variants.land_variant(spark.createDataFrame([(d,) for d in docs], "doc string"))
    assert [r.error for r in landed.select("error").collect()] == [None, None, "no hourly data", "no place name", "unreadable document",
                                                                  "unreadable document", "unreadable document", None]
    found = {r.variable: r.n_documents for r in variants.open_variables(landed, ["temperature_2m"]).collect()}
    assert found == {"dust": 3, "note": 1}
    rows = variants.read_variables(landed, {"dust": "double", "note": "string", "absent": "int"}).collect()
    assert sorted((r.location_name, r.measured_at.hour, r.dust, r.note, r.absent) for r in rows) == [
        ("a", 0, 1.5, "x", None), ("a", 1, None, None, None), ("b", 0, None, None, None)]
    with pytest.raises(ValueError):
        variants.read_variables(landed, {"a') OR ('": "int"})
