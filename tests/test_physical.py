"""Plans: what is pushed down, broadcast and shuffled, and what never appears."""

import pytest

import __spark_entry__ as entry
from zonetide.catalog import QUERIES
from zonetide.catalog.registry import JOBS
from zonetide.functions import columns as C
from zonetide.operators import filters as P
from zonetide.operators import joins as J
from zonetide.operators import rollups as A
from zonetide.operators import windows as W
from zonetide.plans import features as M
from zonetide.sources import roles
from zonetide.sources.readers import driver_table


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, sf_dir, key):
    plan = plan_of(QUERIES[key](spark, sf_dir))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_time_filter_and_columns_reach_the_scan(spark, sf_dir):
    t = P.trailing(roles.trips_e(spark, sf_dir), "pickup_datetime", "2024-01-31 00:00:00", "7 days")
    plan = plan_of(A.hourly_demand(t))
    assert "GreaterThanOrEqual(ts,2024-01-24" in plan.replace("T00:00:00Z", "")
    assert "ReadSchema: struct<ts:timestamp,user_id:bigint>" in plan


def test_day_filter_is_a_range_on_the_raw_column(spark, sf_dir):
    plan = plan_of(P.on_day(driver_table(spark, sf_dir, "orders"), "o_orderdate", "1998-06-15"))
    assert "GreaterThanOrEqual(o_orderdate,1998-06-15" in plan and "LessThan(o_orderdate,1998-06-16" in plan


def test_all_window_features_share_one_sort(spark, sf_dir):
    demand = A.hourly_demand(roles.trips_e(spark, sf_dir))
    plan = plan_of(W.add_rolling(W.add_lags(demand), M.ROLLING))
    assert plan.count("Sort [location_id") == 1
    assert plan.count("Exchange hashpartitioning") == 2  # the rollup, then its zones


def test_fare_features_do_not_shuffle_trips_for_lookups(spark, sf_dir):
    df = M.fare_features(
        roles.trips_e(spark, sf_dir), roles.weather_h(spark, sf_dir), roles.zones_c(spark, sf_dir),
        "2024-01-31 00:00:00", "30 days", max_zones=500,
    )
    assert "SortMergeJoin" not in plan_of(df)


def test_lookup_beyond_the_bound_is_not_broadcast_whole(spark, sf_dir):
    trips = roles.trips_e(spark, sf_dir).withColumnRenamed("pickup_location_id", "location_id")
    zones = roles.zones_c(spark, sf_dir).select("location_id", "zone")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(J.lookup_join(trips, zones, ["location_id"], limit=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan


def test_recent_rows_are_taken_without_a_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan_of(entry.queries()["top_recent"](spark, sf_dir))


def test_hour_of_keeps_expressions_native(spark, sf_dir):
    df = roles.trips_e(spark, sf_dir).select(C.hour_of("pickup_datetime"))
    assert "*(1) Project" in plan_of(df)


@pytest.mark.parametrize("key", sorted(set(QUERIES) - JOBS))
def test_building_a_query_runs_no_job(spark, sf_dir, key):
    context = spark.sparkContext
    group = f"build-{key}"
    context.setJobGroup(group, "while a query is built")
    try:
        QUERIES[key](spark, sf_dir)
        assert list(context.statusTracker().getJobIdsForGroup(group)) == []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
