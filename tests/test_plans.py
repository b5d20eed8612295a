"""Physical-plan checks: pushdown, pruning, join strategy and shuffle counts."""

from pyspark.sql import functions as F

from stratus.operators import facts
from stratus.plans import standins as S
from stratus.sources.scans import in_window

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_filter_reaches_parquet_scan(spark):
    ev = S.table(spark, SF, "events")
    p = plan(in_window(ev, "ts", "2024-01-10", "2024-01-20").select("user_id", "value"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-10T00:00), LessThan(ts,2024-01-21T00:00)]" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in p


def test_daily_rollup_one_shuffle_and_partial_aggregation(spark):
    st = S.events_as_stage(S.table(spark, SF, "events"))
    p = plan(facts.daily_rollup(st, S.cities_dim(S.table(spark, SF, "customer")), "2024-01-10", "2024-01-20"))
    assert p.count("Exchange hashpartitioning") == 1          # only the (day, place) shuffle
    assert "partial_mode" in p and "partial_avg" in p         # map-side combine


def test_daily_rollup_packed_hash_aggregates_only(spark):
    st = S.events_as_stage(S.table(spark, SF, "events"))
    p = plan(facts.daily_rollup(st, S.cities_dim(S.table(spark, SF, "customer")), "2024-01-10", "2024-01-20",
                                dominant_via="packed"))
    assert p.count("Exchange hashpartitioning") == 2          # (day, place, code), then (day, place)
    assert "ObjectHashAggregate" not in p and "SortAggregate" not in p   # fixed-width buffers, codegen
    assert "partial_sum" in p and "partial_max" in p          # map-side combine on both levels
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in p


def test_gap_ranges_single_aggregate_no_window(spark):
    from stratus.operators import control
    log = S.load_log_from_events(S.table(spark, SF, "events"))
    cities = S.events_as_stage(S.table(spark, SF, "events")).select(F.col("location_name").alias("city_name"))
    p = plan(control.date_gaps(log, cities, "2024-01-01", today="2024-01-31"))
    assert "Window" not in p and "CartesianProduct" not in p and "NestedLoop" not in p


def test_scan_window_prunes_partitions(spark, tmp_path):
    import datetime as dt
    from stratus.sources.scans import scan_window
    rows = [(dt.datetime(2024, 1, d, 5), dt.date(2024, 1, d), float(d)) for d in range(1, 11)]
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "ts timestamp_ntz, day date, v double").write.partitionBy("day").parquet(path)
    df = scan_window(spark.read.parquet(path), "ts", "2024-01-03", "2024-01-04", part_col="day", part_kind="date")
    assert "PartitionFilters: [isnotnull(day" in plan(df) and df.count() == 2
