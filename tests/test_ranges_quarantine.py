"""The general range join against brute force, and checks in the pass that writes."""

import math
import random

import pytest
from pyspark.sql import functions as F

from stratus.operators import joins, quarantine
from stratus.operators.joins import binned_range_join

INF = float("inf")


def tables(spark, seed, by=False):
    rng = random.Random(seed)
    ends = []
    for k in range(60):
        low = float(rng.choice([rng.uniform(-50, 50), rng.randrange(-5, 5), 0.0]))
        ends.append((k, low, low + rng.choice([0, 0.01, 1, 3.5, 40, 1000, 1e6]), k % 2))
    ends += [(100, -INF, 0.0, 0), (101, 3.0, INF, 1), (102, -INF, INF, 0), (103, 5.0, 4.0, 0), (104, None, 1.0, 0), (105, math.nan, 1.0, 1)]
    xs = [(i, rng.choice([rng.uniform(-60, 60), rng.randrange(-6, 6), 0.0])) for i in range(300)]
    xs += [(900, None), (901, math.nan), (902, INF), (903, -INF), (904, 1e300), (905, -0.0)]
    points = spark.createDataFrame([(i, None if x is None else float(x), i % 2) for i, x in xs], "i long, x double, g int")
    return points, spark.createDataFrame(ends, "k long, low double, high double, g int"), xs, ends


@pytest.mark.parametrize("width, include", [(None, True), (0.5, False), (1e4, True)])
def test_range_join_equals_brute_force(spark, width, include):
    points, intervals, xs, ends = tables(spark, 3)
    got = {(r.i, r.k) for r in binned_range_join(points.drop("g"), intervals.drop("g"), "x", "low", "high", width, include_high=include).collect()}
    want = {(i, k) for i, x in xs for k, low, high, _ in ends
            if x is not None and low is not None and not math.isnan(x) and low <= x and (x <= high if include else x < high)}
    assert got == want and len(want) > 500


def test_range_join_by_key_keeps_every_point_on_the_left(spark):
    points, intervals, xs, ends = tables(spark, 8)
    rows = binned_range_join(points, intervals, "x", "low", "high", by=["g"], how="left").collect()
    pairs = {(r.i, r.k) for r in rows}
    assert {i for i, _ in xs} == {i for i, _ in pairs}
    want = {(i, k) for i, x in xs for k, low, high, g in ends
            if x is not None and low is not None and g == i % 2 and low <= x <= high}
    assert {p for p in pairs if p[1] is not None} == want
    assert len(rows) == len(pairs)


def test_range_join_plan_has_no_nested_loop(spark):
    points, intervals, _, _ = tables(spark, 1)
    plan = binned_range_join(points, intervals.drop("g"), "x", "low", "high", 1.0)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert binned_range_join(points, intervals.drop("g").limit(0), "x", "low", "high").count() == 0


@pytest.mark.parametrize("by, include", [(False, True), (True, True), (False, False)])
def test_range_totals_equal_brute_force(spark, by, include):
    points, intervals, xs, ends = tables(spark, 11)
    points = points.unionByName(points)                                  # frequent values
    on = ["g"] if by else []
    if not by:
        points, intervals = points.drop("g"), intervals.drop("g")
    rows = binned_range_join(points, intervals, "x", "low", "high", by=on, include_high=include, totals={
        "n": (F.count("i"), F.sum), "total": (F.sum("i"), F.sum), "first": (F.min("i"), F.min), "last": (F.max("i"), F.max)}).collect()
    want = {}
    for k, low, high, g in ends:
        held = [i for i, x in xs if x is not None and low is not None and not math.isnan(x) and low <= x
                and (x <= high if include else x < high) and (not by or g == i % 2)]
        if held:
            want[k] = (2 * len(held), 2 * sum(held), min(held), max(held))
    assert {r.k: (r.n, r.total, r["first"], r["last"]) for r in rows} == want and len(rows) == len(want) > 30
    assert binned_range_join(points.limit(0), intervals, "x", "low", "high", by=on, totals={"n": (F.count("i"), F.sum)}).count() == 0
    with pytest.raises(ValueError):
        binned_range_join(points, intervals, "x", "low", "high", how="left", totals={})


def test_range_totals_form_no_pairs(spark):
    """An interval meets some cells for each power of 8, whatever it holds; together they are its run."""
    rng = random.Random(2)
    runs = [(0, 5000), (1, 4999), (7, 8), (511, 513), (8, 64)] + [tuple(sorted(rng.sample(range(5001), 2))) for _ in range(200)]
    steps = [8 ** j for j in range(5)]
    cells = spark.createDataFrame(runs, "_a long, _b long").select("_a", "_b", joins._cells_of(steps).alias("c")).collect()
    for r in cells:
        assert sorted(i for c in r.c for i in range(c["_cell"] * steps[c["_level"]], (c["_cell"] + 1) * steps[c["_level"]])) == list(range(r["_a"], r["_b"]))
        assert len(r.c) <= 14 * len(steps)


def test_checked_write_splits_and_counts_in_one_pass(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (50, "a"), (None, None), (60, "z"), (2, "b")], "n int, s string")
    path = str(tmp_path / "t")
    done = quarantine.checked_write(df, path, {"n_small": F.col("n") > 40, "s_known": ~F.col("s").isin("a", "b"), "s_there": F.col("s").isNull()})
    assert done.counts == {"rows": 5, "quarantined": 3, "n_small": 2, "s_known": 1, "s_there": 1}
    assert sorted(r.n for r in done.good.collect()) == [1, 2] and done.good.columns == ["n", "s"]
    assert {(r.n, tuple(r["_broken"])) for r in done.quarantined.collect()} == {
        (50, ("n_small",)), (60, ("n_small", "s_known")), (None, ("s_there",))}
    clean = quarantine.checked_write(df.limit(0), path, {"n_small": F.col("n") > 40})
    assert clean.good.count() == 0 and clean.quarantined.count() == 0
