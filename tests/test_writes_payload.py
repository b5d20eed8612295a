import datetime as dt
import json

from pyspark.sql import functions as F

from stratus.operators import checks, writes
from stratus.sources.payload import explode_payload, invalid_payloads, payload_schema

D = dt.date
T = dt.datetime
FACT = "d date, city string, v double, ym int"


def test_replace_range_table_idempotent_and_drops_empty(spark, tmp_table):
    base = spark.createDataFrame([(D(2024, 1, 30), "A", 1.0, 202401), (D(2024, 2, 1), "A", 2.0, 202402),
                                  (D(2024, 2, 2), "B", 3.0, 202402), (D(2024, 3, 1), "A", 4.0, 202403)], FACT)
    base.write.partitionBy("ym").parquet(tmp_table)
    new = spark.createDataFrame([(D(2024, 2, 1), "A", 20.0, 202402)], FACT)
    for _ in range(2):   # replace twice = once
        out = writes.replace_range_table(spark, tmp_table, new, "d", "2024-02-01", "2024-02-29", "ym", [202402])
        assert sorted((r.d, r.city, r.v) for r in out.collect()) == [
            (D(2024, 1, 30), "A", 1.0), (D(2024, 2, 1), "A", 20.0), (D(2024, 3, 1), "A", 4.0)]
    # a window that becomes empty removes its partition instead of leaving stale rows
    empty = spark.createDataFrame([], FACT)
    out = writes.replace_range_table(spark, tmp_table, empty, "d", "2024-03-01", "2024-03-31", "ym", [202403])
    assert sorted(r.d for r in out.collect()) == [D(2024, 1, 30), D(2024, 2, 1)]


def test_replaced_slice_by_key(spark):
    cur = spark.createDataFrame([(D(2024, 1, 1), "A", 1.0, 1), (D(2024, 1, 1), "B", 2.0, 1)], FACT)
    new = spark.createDataFrame([(D(2024, 1, 1), "A", 9.0, 1)], FACT)
    got = sorted((r.city, r.v) for r in writes.replaced(cur, new, "d", "2024-01-01", "2024-01-01",
                                                        key_col="city", key="A").collect())
    assert got == [("A", 9.0), ("B", 2.0)]


def test_scd1_merge(spark):
    t0, t1 = T(2024, 1, 1), T(2024, 2, 1)
    target = spark.createDataFrame([("A", 1.0, "x", t0, t0), ("B", 2.0, "y", t0, t0), ("C", 3.0, "z", t0, t0)],
                                   "name string, a double, b string, loaded_at timestamp_ntz, updated_at timestamp_ntz")
    source = spark.createDataFrame([("A", 1.5, "x"), ("B", None, "y"), ("C", 3.0, "z"), ("N", 9.0, "n")],
                                   "name string, a double, b string")
    src_once = writes.scd1_merge(target, source, "name", ["a", "b"], F.lit(t1))
    got = {r.name: tuple(r)[1:] for r in src_once.collect()}
    assert got["A"] == (1.5, "x", t0, t1)          # changed attribute
    assert got["B"] == (None, "y", t0, t1)         # NULL overwrites
    assert got["C"] == (3.0, "z", t0, t1)          # unchanged, updated_at still moves
    assert got["N"] == (9.0, "n", t1, t1)          # new key
    twice = writes.scd1_merge(src_once, source, "name", ["a", "b"], F.lit(t1))
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, src_once.collect()))


def test_insert_absent_and_assign_ids(spark):
    target = spark.createDataFrame([(1, "seed")], "id int, d string")
    new = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "id int, d string")
    once = writes.insert_absent(target, new, ["id"], order="d")
    assert sorted(map(tuple, once.collect())) == [(1, "seed"), (2, "a")]
    assert sorted(map(tuple, writes.insert_absent(once, new, ["id"], order="d").collect())) == \
        sorted(map(tuple, once.collect()))
    dim = spark.createDataFrame([(3, "Oslo"), (7, "Lima")], "id int, name string")
    names = spark.createDataFrame([("Quito",), ("Oslo",), ("Bern",), ("Quito",)], "name string")
    assert sorted(map(tuple, writes.assign_ids(dim, names, "name").collect())) == [("Bern", 8), ("Quito", 9)]


def test_append_absent_same_day_rerun(spark, tmp_table):
    fc = spark.createDataFrame([(D(2024, 1, 1), D(2024, 1, 2), 1, 5.0), (D(2024, 1, 1), D(2024, 1, 3), 1, 6.0)],
                               "forecast_run_date date, target_date date, city_id int, v double")
    keys = ["forecast_run_date", "target_date", "city_id"]
    assert writes.append_absent_table(spark, tmp_table, fc, keys, "forecast_run_date") == 2
    assert writes.append_absent_table(spark, tmp_table, fc, keys, "forecast_run_date") == 0
    assert spark.read.parquet(tmp_table).count() == 2


def test_constraint_checks(spark):
    df = spark.createDataFrame([(1, "R"), (1, "R"), (2, None), (None, "Q")], "k int, f string")
    parent = spark.createDataFrame([(1,)], "k int")
    assert checks.check_unique(df, ["k"]).count() == 1
    assert checks.check_not_null(df, ["k", "f"]).count() == 2
    assert checks.check_fk(df, ["k"], parent, ["k"]).count() == 1
    assert checks.check_in(df, "f", ["R", "A", "N"]).count() == 1   # NULL passes


def test_explode_payload_edges(spark):
    names = ["temperature_2m", "weather_code", "is_day"]
    docs = [
        {"name": "A", "country": "X", "latitude": 1.0, "longitude": 2.0, "elevation": 3.0, "timezone": "UTC",
         "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.5, None],
                    "weather_code": ["3", "x"], "is_day": [1, None]}},
        {"name": "B", "hourly": {"time": ["2024-01-01T00:00"], "temperature_2m": [1.0, 2.0],
                                 "weather_code": ["1"], "is_day": [0]}},          # unequal arrays
        {"name": "C", "hourly": None},                                                # empty
        {"name": "D", "hourly": {"time": ["2024-01-02T00:00"], "temperature_2m": [4.0]}},  # code, is_day absent
    ]
    raw = spark.createDataFrame([(json.dumps(d),) for d in docs], "doc string")
    parsed = raw.select(F.from_json("doc", payload_schema(names)).alias("p")).select("p.*")
    rows = explode_payload(parsed, names=names).orderBy("measured_at").collect()
    assert [(r.location_name, r.measured_at, r.temperature_2m, r.weather_code, r.is_day) for r in rows] == [
        ("A", T(2024, 1, 1, 0), 1.5, 3, True), ("A", T(2024, 1, 1, 1), None, None, None),
        ("D", T(2024, 1, 2, 0), 4.0, None, None)]
    assert sorted(r.name for r in invalid_payloads(parsed, names=names).collect()) == ["B", "C"]
