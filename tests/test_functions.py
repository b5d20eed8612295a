import datetime as dt

from pyspark.sql import functions as F

from stratus.functions import dates as D
from stratus.functions.numeric import clamp_nonneg, round2
from stratus.functions.text import contains_any, is_daily_limit


def test_calendar_golden_spots(spark):
    df = spark.createDataFrame([(dt.date(2000, 2, 29),), (dt.date(2027, 1, 1),), (dt.date(1900, 3, 1),),
                                (dt.date(2024, 1, 6),)], "d date")
    r = df.select(D.date_id("d").alias("id"), D.is_leap_year("d").alias("leap"), D.iso_week("d").alias("w"),
                  D.iso_dow("d").alias("dow"), D.is_weekend("d").alias("we"), D.month_name("d").alias("mn"),
                  D.day_name("d").alias("dn")).collect()
    assert r[0].id == 20000229 and r[0].leap is True
    assert r[1].w == 53 and r[1].dow == 5 and r[1].mn == "January" and r[1].dn == "Friday"
    assert r[2].leap is False            # century rule
    assert r[3].we is True and r[3].dow == 6


def test_clock_golden_spots(spark):
    ts = [dt.datetime(2000, 1, 1, h, m) for h, m in [(0, 5), (12, 5), (9, 5), (18, 0), (23, 59)]]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    r = df.select(D.time_12h("ts").alias("t12"), D.part_of_day("ts").alias("p"), D.time_id("ts").alias("id"),
                  D.hour12("ts").alias("h12"), D.time_24h("ts").alias("t24")).collect()
    assert [x.t12 for x in r] == ["12:05AM", "12:05PM", "9:05AM", "6:00PM", "11:59PM"]
    assert [x.p for x in r] == ["Night", "Afternoon", "Morning", "Evening", "Evening"]
    assert [x.id for x in r] == [5, 1205, 905, 1800, 2359]
    assert r[0].h12 == 12 and r[0].t24 == "00:05"


def test_round2_half_away_from_zero(spark):
    df = spark.createDataFrame([(0.285,), (-0.285,), (1.005,), (None,), (2.675,)], "x double")
    r = [x[0] for x in df.select(round2("x")).collect()]
    assert r == [0.29, -0.29, 1.01, None, 2.68]


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (None,), (2.5,)], "x double")
    assert [x[0] for x in df.select(clamp_nonneg("x")).collect()] == [0.0, None, 2.5]


def test_month_helpers(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 10),)], "d date")
    r = df.select(D.month_start("d"), D.month_end("d"), D.month_end("d", "2024-02-20"), D.next_month("d")).first()
    assert tuple(r) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29), dt.date(2024, 2, 20), dt.date(2024, 3, 1))


def test_daily_limit_classifier(spark):
    rows = [(1, 429, '{"reason":"Daily API request limit exceeded"}'), (2, 429, '{"error": true}'),
            (3, 400, "Daily quota exceeded"), (4, 500, "daily limit"), (5, 429, '{"reason":"Minutely limit"}'),
            (6, 200, "daily limit"), (7, 499, None)]
    df = spark.createDataFrame(rows, "id long, status int, body string")
    got = {r.id: r.f for r in df.select("id", is_daily_limit("status", "body").alias("f")).collect()}
    assert got == {1: True, 2: False, 3: True, 4: False, 5: False, 6: False, 7: False}


def test_contains_any(spark):
    df = spark.createDataFrame([("Rate LIMIT",), ("ok",), (None,)], "t string")
    assert [r[0] for r in df.select(contains_any("t", ["limit", "exceeded"])).collect()] == [True, False, None]
