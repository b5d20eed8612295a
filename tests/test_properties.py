"""Randomised comparisons against brute-force Python (hypothesis, few large examples)."""

import datetime as dt
import decimal
import itertools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratus.functions.constants import WIND_BANDS
from stratus.functions.numeric import round2
from stratus.operators import control, joins
from stratus.operators.windows import latest_per_key
from stratus.sources.generators import wind_bands

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
D0 = dt.date(2024, 1, 1)


def band_of(x):
    if x is None:
        return None
    for i, lo, hi, _, _ in WIND_BANDS:
        if lo <= x <= hi:
            return i
    return None


degrees = st.one_of(st.none(), st.floats(-5, 370, allow_nan=False), st.integers(-2, 362).map(float),
                    st.integers(0, 3600).map(lambda i: i / 10))


@SETTINGS
@given(st.lists(degrees, min_size=1, max_size=300))
def test_band_lookup_matches_python(spark, xs):
    df = spark.createDataFrame(list(enumerate(xs)), "i int, d double")
    got = {r.i: r.b for r in joins.band_lookup(df, "d", wind_bands(spark), "b").collect()}
    assert got == {i: band_of(x) for i, x in enumerate(xs)}


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["stage", "core"]), st.integers(-3, 40),
                          st.sampled_from(["success", "failed"])), max_size=150))
def test_date_gaps_match_brute_force(spark, log):
    rows = [(D0 + dt.timedelta(days=d), f"P{p}", layer, s) for p, layer, d, s in log]
    cities = [f"P{i}" for i in range(4)]
    ldf = spark.createDataFrame(rows, "run_date date, city_name string, layer string, status string")
    cdf = spark.createDataFrame([(c,) for c in cities], "city_name string")
    got = {tuple(r) for r in control.date_gaps(ldf, cdf, "2024-01-01", today="2024-02-01").collect()}
    ok = {(r[1], r[2], r[0]) for r in rows if r[3] == "success"}
    want = {(D0 + dt.timedelta(days=i), c, l) for i in range(31) for c, l in itertools.product(cities, ["stage", "core"])
            if (c, l, D0 + dt.timedelta(days=i)) not in ok}
    assert got == want


@SETTINGS
@given(st.lists(st.decimals(min_value=-10000, max_value=10000, places=5, allow_nan=False), min_size=1, max_size=200))
def test_round2_is_half_up_on_decimals(spark, xs):
    vals = [float(x) for x in xs]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = {r.i: r.r for r in df.select("i", round2("v").alias("r")).collect()}
    for i, v in enumerate(vals):
        q = decimal.Decimal(v).quantize(decimal.Decimal("1e-12"), decimal.ROUND_HALF_UP)
        assert got[i] == float(q.quantize(decimal.Decimal("0.01"), decimal.ROUND_HALF_UP))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 10 ** 6)),
                min_size=1, max_size=60, unique_by=lambda t: t[2]))
def test_latest_per_key_nulls_first(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int, tie int")
    got = {r.k: r.tie for r in latest_per_key(df.withColumn("v", F.col("tie")), "k", "t", ["v"], tie="tie")
           .select("k", F.col("v").alias("tie")).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        grp = [r for r in rows if r[0] == k]
        # ORDER BY t DESC NULLS FIRST, tie DESC
        grp.sort(key=lambda r: (r[1] is not None, -(r[1] or 0), -r[2]))
        want[k] = grp[0][2]
    assert got == want


def test_daily_rollup_hot_place_matches_brute_force(spark):
    """One place holds 70 % of the rows; both roll-up plans equal a plain-Python computation."""
    import collections
    import random

    from stratus.operators import facts
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        place = "HOT" if rnd.random() < 0.7 else f"P{rnd.randrange(20)}"
        ts = dt.datetime(2024, 1, 1 + rnd.randrange(3), rnd.randrange(24))
        rows.append((place, ts, round(rnd.uniform(-10, 35), 2), round(rnd.uniform(0, 2), 3), rnd.randrange(5)))
    df = spark.createDataFrame(rows, "location_name string, measured_at timestamp_ntz, temperature_2m double, "
                                     "precipitation double, weather_code smallint")
    for c in ("apparent_temperature", "wet_bulb_temperature_2m", "rain", "snowfall", "sunshine_duration",
              "shortwave_radiation", "wind_speed_10m", "wind_gusts_10m", "cloud_cover", "relative_humidity_2m",
              "pressure_msl"):
        df = df.withColumn(c, F.lit(1.0))
    places = ["HOT"] + [f"P{i}" for i in range(20)]
    cities = spark.createDataFrame(list(enumerate(places)), "id long, city_name string")
    groups = collections.defaultdict(list)
    for p, ts, t, pr, code in rows:
        groups[(int(ts.strftime("%Y%m%d")), places.index(p))].append((t, pr, code))

    def half_up(x):
        q = decimal.Decimal(x).quantize(decimal.Decimal("1e-12"), decimal.ROUND_HALF_UP)
        return float(q.quantize(decimal.Decimal("0.01"), decimal.ROUND_HALF_UP))

    want = {}
    for k, g in groups.items():
        counts = collections.Counter(c for _, _, c in g)
        top = max(counts.values())
        want[k] = (min(c for c, n in counts.items() if n == top), half_up(sum(t for t, _, _ in g) / len(g)),
                   min(t for t, _, _ in g), max(t for t, _, _ in g), half_up(sum(p for _, p, _ in g)))
    for via in ("mode", "packed"):
        out = facts.daily_rollup(df, cities, dominant_via=via).collect()
        got = {(r.date_id, r.city_id): (r.dominant_weather_code_id, r.temp_avg, r.temp_min, r.temp_max,
                                        r.precipitation_sum) for r in out}
        assert got.keys() == want.keys()
        for k in want:
            assert got[k][0] == want[k][0] and got[k][2:4] == want[k][2:4]
            assert abs(got[k][1] - want[k][1]) <= 0.01 and abs(got[k][4] - want[k][4]) <= 0.01
