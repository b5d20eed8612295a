import datetime as dt
import itertools

from pyspark.sql import functions as F

from stratus.operators import control, dims
from stratus.operators.windows import first_per_key, latest_per_key, rank_by, with_previous
from stratus.sources.config import active_cities, load_cities
from stratus.sources.generators import month_chunks, wmo_codes

D = dt.date


def test_dim_calendar_and_time_sizes(spark):
    assert dims.dim_calendar(spark).count() == 36890
    t = dims.dim_time(spark)
    assert t.count() == 1440
    r = {x.id: x for x in t.where(F.col("id").isin(5, 1205, 905)).collect()}
    assert r[5].time_12h == "12:05AM" and r[5].part_of_day == "Night" and r[5].time_value == "00:05:00"
    assert r[905].time_12h == "9:05AM" and r[1205].am_pm == "PM"


def test_latest_per_key_null_first_then_tie(spark):
    df = spark.createDataFrame([
        ("A", dt.datetime(2024, 1, 2), 1, 10.0), ("A", None, 2, 20.0), ("A", dt.datetime(2024, 1, 3), 3, 30.0),
        ("B", dt.datetime(2024, 1, 1), 4, 40.0), ("B", dt.datetime(2024, 1, 1), 5, 50.0)],
        "k string, t timestamp_ntz, id int, v double")
    got = {r.k: r.v for r in latest_per_key(df, "k", "t", ["v"], tie="id").collect()}
    assert got == {"A": 20.0, "B": 50.0}


def test_first_per_key(spark):
    df = spark.createDataFrame([("PT", 5, "South"), ("PT", 2, "West"), ("HR", 9, "Central")],
                               "c string, pos int, region string")
    assert {r.c: r.region for r in first_per_key(df, "c", "pos", ["region"]).collect()} == \
        {"PT": "West", "HR": "Central"}


CFG = [
    {"name": "Lisbon", "country": "Portugal", "region": "Western Europe", "active": True, "climate_zone": "Csa",
     "is_capital": True, "country_iso2": "PT"},
    {"name": "Oslo", "country": "Norway", "region": "Northern Europe", "country_iso2": "NO"},   # active missing
    {"name": "Porto", "country": "Portugal", "region": "Southern Europe", "active": False},
]


def test_config_countries_and_cities(spark):
    cfg = load_cities(spark, CFG)
    assert [r.name for r in active_cities(cfg).collect()] == ["Lisbon"]
    countries = dims.dim_countries(cfg)
    got = {r.country_name: r.region for r in countries.collect()}
    assert got == {"Portugal": "Western Europe", "Norway": "Northern Europe"}   # first record wins
    ids = countries.withColumn("id", F.when(F.col("country_name") == "Portugal", 1).otherwise(2))
    stage = spark.createDataFrame([
        ("Lisbon", 38.7, -9.1, 10.0, "Europe/Lisbon", dt.datetime(2024, 1, 1)),
        ("Lisbon", 38.8, -9.2, 11.0, "Europe/Lisbon", None),
        ("Nowhere", 1.0, 2.0, 3.0, "UTC", dt.datetime(2024, 1, 1))],
        "location_name string, latitude double, longitude double, elevation_m double, timezone string, "
        "loaded_at timestamp_ntz")
    c = {r.city_name: r for r in dims.dim_cities(stage, cfg, ids).collect()}
    assert c["Lisbon"].latitude == 38.8 and c["Lisbon"].country_id == 1 and c["Lisbon"].is_capital is True
    assert c["Nowhere"].country_id is None and c["Nowhere"].climate_zone is None


def test_dim_weather_code_discovers(spark):
    stage = spark.createDataFrame([(0,), (42,), (None,), (42,)], "weather_code smallint")
    d = dims.dim_weather_code(wmo_codes(spark), stage)
    assert d.count() == 29
    assert d.where("id = 42").first().description is None
    assert d.where("id = 0").first().description == "Clear sky"


def brute_gaps(log_rows, cities, start, end, layers=("stage", "core")):
    ok = {(r[1], r[2], r[0]) for r in log_rows if r[3] == "success"}
    out = set()
    d = start
    while d <= end:
        for c, l in itertools.product(cities, layers):
            if (c, l, d) not in ok:
                out.add((d, c, l))
        d += dt.timedelta(days=1)
    return out


LOG_SCHEMA = "run_date date, city_name string, layer string, status string"


def test_date_gaps_matches_brute_force(spark):
    rows = [(D(2024, 1, d), c, l, s) for d, c, l, s in [
        (1, "A", "stage", "success"), (3, "A", "stage", "failed"), (3, "A", "stage", "success"),
        (4, "A", "stage", "success"), (2, "A", "core", "success"), (5, "A", "core", "failed"),
        (1, "B", "stage", "failed"), (6, "B", "stage", "success"), (9, "B", "stage", "success")]]
    log = spark.createDataFrame(rows, LOG_SCHEMA)
    cities = spark.createDataFrame([("A",), ("B",), ("C",)], "city_name string")
    got = {tuple(r) for r in control.date_gaps(log, cities, "2024-01-01", today="2024-01-08").collect()}
    assert got == brute_gaps(rows, ["A", "B", "C"], D(2024, 1, 1), D(2024, 1, 7))


def test_pending_chunks_matches_brute_force(spark):
    rows = [(D(2024, 1, d), "A", "stage", "success") for d in range(1, 32)] + \
           [(D(2024, 2, d), "A", "stage", "success") for d in range(1, 29)] + \
           [(D(2024, 1, d), "B", "stage", "success") for d in range(1, 31)]
    log = spark.createDataFrame(rows, LOG_SCHEMA)
    cfg = load_cities(spark, [{"name": "A", "active": True}, {"name": "B", "active": True},
                              {"name": "C", "active": None}])
    got = {tuple(r) for r in control.pending_chunks(log, cfg, 2024, "2024-03-05").collect()}
    assert got == {("A", D(2024, 2, 1), D(2024, 2, 29)), ("A", D(2024, 3, 1), D(2024, 3, 5)),
                   ("B", D(2024, 1, 1), D(2024, 1, 31)), ("B", D(2024, 2, 1), D(2024, 2, 29)),
                   ("B", D(2024, 3, 1), D(2024, 3, 5))}
    chunks = spark.range(1).select(F.explode(month_chunks(2023, "2023-03-10")).alias("c")).select("c.*").collect()
    assert [tuple(c) for c in chunks] == [(D(2023, 1, 1), D(2023, 1, 31)), (D(2023, 2, 1), D(2023, 2, 28)),
                                          (D(2023, 3, 1), D(2023, 3, 10))]


def test_gap_months_and_fill(spark):
    up = spark.createDataFrame([("A", D(2024, 1, 5), 1.0), ("A", D(2024, 2, 3), 2.0), ("B", D(2024, 2, 9), 3.0),
                                ("A", D(2024, 3, 1), 4.0)], "city string, d date, v double")
    down = spark.createDataFrame([("A", D(2024, 1, 5), 1.0, 1)], "city string, d date, total double, n long")
    gaps = control.gap_months(up, down, ["city"], "d", "2024-03-01")
    got = {tuple(r) for r in gaps.collect()}
    # March is a gap dated "today": reported, but its window ends yesterday (start > end)
    assert got == {(D(2024, 2, 1), D(2024, 2, 29)), (D(2024, 3, 1), D(2024, 2, 29))}

    def recompute(df):
        return df.groupBy("city", "d").agg(F.sum("v").alias("total"), F.count(F.lit(1)).alias("n"))
    repaired = control.fill_gaps(up, down, recompute, gaps, "d")
    assert {(r.city, r.d) for r in repaired.collect()} == {("A", D(2024, 1, 5)), ("A", D(2024, 2, 3)),
                                                           ("B", D(2024, 2, 9))}
    # after repair only the "today" month is still a gap
    again = control.gap_months(up, repaired, ["city"], "d", "2024-03-01").collect()
    assert [tuple(r) for r in again] == [(D(2024, 3, 1), D(2024, 2, 29))]


def test_load_status_and_run_ok(spark):
    log = spark.createDataFrame([
        (D(2024, 1, 1), "A", "stage", "failed", dt.datetime(2024, 1, 2, 1), 1, "boom"),
        (D(2024, 1, 1), "A", "stage", "success", dt.datetime(2024, 1, 2, 2), 2, None),
        (D(2024, 1, 2), "A", "stage", "failed", dt.datetime(2024, 1, 3, 1), 3, "x"),
        (D(2024, 1, 2), "A", "stage", "failed", dt.datetime(2024, 1, 3, 2), 4, "y")],
        "run_date date, city_name string, layer string, status string, executed_at timestamp_ntz, id int, "
        "error_msg string")
    st = {r.run_date: (r.status, r.attempts, r.last_error) for r in control.load_status(log).collect()}
    assert st == {D(2024, 1, 1): ("success", 2, "boom"), D(2024, 1, 2): ("failed", 2, "y")}
    ok = {r.run_date: r.ok for r in control.run_ok(log).collect()}
    assert ok == {D(2024, 1, 1): True, D(2024, 1, 2): False}


def test_windows_previous_and_rank(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 7.0), ("b", 1, 7.0)], "k string, p int, v double")
    prev = {(r.k, r.p): r.prev_v for r in with_previous(df, ["v"], "k", "p").collect()}
    assert prev == {("a", 1): None, ("a", 2): 5.0, ("b", 1): None}
    ranks = sorted(r.rank for r in rank_by(df, "v").collect())
    assert ranks == [1, 1, 3]


def test_dim_cities_incremental_keeps_known_places(spark):
    cfg = load_cities(spark, [{"name": "Lisbon", "country": "Portugal", "climate_zone": "Csb"},
                              {"name": "Oslo", "country": "Norway", "climate_zone": "Dfb"}])
    countries = dims.dim_countries(cfg).withColumn("id", F.lit(1))
    existing = spark.createDataFrame([(1, "Lisbon", 38.7, -9.1, 5.0, "Europe/Lisbon")],
                                     "id int, city_name string, latitude double, longitude double, "
                                     "elevation_m double, timezone string")
    new_rows = spark.createDataFrame([("Oslo", 59.9, 10.7, 20.0, "Europe/Oslo", dt.datetime(2024, 1, 2))],
                                     "location_name string, latitude double, longitude double, elevation_m double, "
                                     "timezone string, loaded_at timestamp_ntz")
    got = {r.city_name: (r.latitude, r.climate_zone)
           for r in dims.dim_cities(new_rows, cfg, countries, existing=existing).collect()}
    # Lisbon is not in the new rows: stored geo kept, config (changed to Csb) re-applied
    assert got == {"Lisbon": (38.7, "Csb"), "Oslo": (59.9, "Dfb")}


def test_load_cities_from_yaml(spark, tmp_path):
    p = tmp_path / "cities.yml"
    p.write_text('cities:\n'
                 '  - name: Oslo\n    country: Norway\n    country_iso2: "NO"\n    lat: 59.9\n    lon: 10.7\n'
                 '    is_capital: true\n    climate_zone: Dfb\n'
                 '  - name: Lisbon\n    country: Portugal\n    country_iso2: PT\n    active: true\n')
    cfg = load_cities(spark, str(p)).orderBy("pos").collect()
    assert [(r.name, r.country_iso2, r.active, r.pos) for r in cfg] == [("Oslo", "NO", None, 0),
                                                                         ("Lisbon", "PT", True, 1)]
    assert [r.name for r in active_cities(load_cities(spark, str(p))).collect()] == ["Lisbon"]
