import datetime as dt

from pyspark.sql import functions as F

from stratus.operators import measures as M

D = dt.date
SCHEMA = ("date date, city_id long, city_name string, country_name string, region string, is_capital boolean, "
          "climate_zone string, latitude double, longitude double, temp_avg double, temp_min double, "
          "temp_max double, precipitation_sum double, pressure_avg double, sunshine_hours double, "
          "humidity_avg double, wind_gusts_max double, is_hot_day boolean, is_frost_day boolean, "
          "is_rainy_day boolean, is_snowy_day boolean")


def rows():
    out = []
    for y, city, cn, rg, cap, zone, t in [(2020, "A", "X", "R1", True, "Cfb", 31.0), (2020, "B", "X", "R1", False, "bsk", -2.0),
                                          (2022, "C", "Y", "R2", True, "ET", 10.0)]:
        for m in (1, 7):
            out.append((D(y, m, 1), ord(city), city, cn, rg, cap, zone, 1.0, 2.0, t, t - 5, t + 1, 2.0, 1000.0,
                        5.0, 50.0, 20.0, t + 1 >= 30, t - 5 < 0, True, None))
    return out


def test_kpis_and_yoy_spine(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    k = {r.year: r for r in M.kpis(df.withColumn("year", F.year("date")), by=["year"]).collect()}
    assert k[2020].total_precipitation == 8.0 and k[2020].rainy_days == 4
    yoy = {r.year: r for r in M.kpis_yoy(df).collect()}
    assert sorted(yoy) == [2020, 2021, 2022]                 # gap year present
    assert yoy[2021].avg_temperature is None and yoy[2022].prev_avg_temperature is None
    assert yoy[2020].prev_rainy_days is None


def test_period_compare_month_spine(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    pc = M.period_compare(df, "total_precipitation", "year").orderBy("period").collect()
    assert [r.period.year for r in pc] == [2020, 2021, 2022]
    assert pc[1].value is None and pc[2].prev_value is None


def test_extreme_ranking_levels(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    r = M.extreme_ranking(df, "hot").collect()
    levels = sorted(x.level for x in r)
    assert levels == [0, 0, 0, 1, 1, 2, 2, 3]
    top_city = [x for x in r if x.level == 0 and x.rank == 1][0]
    assert top_city.city_name == "A" and top_city.hot_pct == 100.0


def test_climate_group_and_slicers(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    groups = {r.city_name: r.climate_group for r in M.climate_scatter(df).collect()}
    assert groups == {"A": "Temperate", "B": "Arid", "C": "Polar"}
    caps = M.map_values(M.capitals_only(df), "avg_temperature").collect()
    assert sorted(r.city_name for r in caps) == ["A", "C"]
    sl = M.slice_by(df, start="2022-01-01", region="R2", zone="Polar")
    assert sl.count() == 2
