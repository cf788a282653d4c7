"""Joins: split hot keys, deduplicated weather, neighbourhoods, reconciliation."""

import datetime as dt
import math
import random

import pytest
from oracle import rows_of
from pyspark.sql import functions as F

from zonetide.operators import joins as J
from zonetide.operators import quality as D
from zonetide.operators import rollups as A
from zonetide.plans import features as M
from zonetide.sources import roles


def rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


@pytest.fixture()
def skewed(spark):
    """A third of the rows on key 1, a tenth on a key the dimension lacks, a tenth on null, the rest spread."""
    n = F.col("id") % 30
    key = F.when(n < 10, 1).when(n < 13, -5).when(n < 16, None).otherwise(F.col("id") % 400)
    return spark.range(6000).select(F.col("id").alias("row"), key.cast("bigint").alias("k"))


@pytest.fixture()
def dim(spark):
    return spark.range(0, 400, 2).union(spark.range(1, 2)).select(
        F.col("id").alias("k"), (F.col("id") * 10).alias("v"), F.when(F.col("id") != 4, "x").alias("w")
    )


@pytest.mark.parametrize("how", ["left", "inner"])
def test_splittable_join_equals_a_plain_join(spark, skewed, dim, how):
    side = dim.groupBy("k").agg(F.max("v").alias("v"), F.max("w").alias("w"))
    plain, split = skewed.join(side, ["k"], how), J.splittable_join(skewed, side, ["k"], how)
    assert split.columns == plain.columns
    assert rows(split) == rows(plain)


def test_a_hot_key_of_the_fact_is_split(spark, skewed):
    """Statistics of the fact joined back to it: the adaptive planner cuts the hot key's partition."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    wide = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 400).alias("k"), F.rand(1).alias("x"))
    stats = wide.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        joined = J.join_own_stats(wide, stats, ["k"])
        got = joined.groupBy("k").agg(F.count(F.lit(1)).alias("m"), F.max("n").alias("n")).filter("m <> n").count()
        joined.collect()
        assert got == 0 and "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in small:
            spark.conf.unset(key)


def test_lookup_join_switches_by_checked_size(spark, skewed, dim):
    assert J.fits(dim, 1000) and not J.fits(dim, 1000, limit=10) and not J.fits(dim, 10**9) and not J.fits(dim, None)
    plain = rows(skewed.join(dim, ["k"], "left"))
    for options in ({"rows": 400}, {"rows": 10**9}, {}, {"own": True}):
        assert rows(J.lookup_join(skewed, dim, ["k"], **options)) == plain


def test_fare_features_are_the_same_beyond_the_broadcast_bound(spark, sf_dir):
    args = (
        roles.trips_e(spark, sf_dir), roles.weather_h(spark, sf_dir), roles.zones_c(spark, sf_dir),
        "2024-01-31 00:00:00", "30 days",
    )
    small = rows(M.fare_features(*args, max_zones=500))
    assert rows(M.fare_features(*args)) == small


def test_repeated_weather_loads_do_not_multiply_trips(spark, sf_dir):
    t, w = roles.trips_e(spark, sf_dir), roles.weather_raw(spark, sf_dir)
    joined = J.join_weather_hour(t.withColumn("h", F.date_trunc("hour", "pickup_datetime")), w, "h")
    assert joined.count() == t.count() < w.count() * 100
    total = A.trip_weather(t, w, "2024-01-31 00:00:00", "30 days").agg(F.sum("total_trips")).first()[0]
    assert total == t.count()


def test_latest_load_then_latest_time_wins(spark):
    at = dt.datetime
    w = spark.createDataFrame(
        [
            (at(2024, 1, 1, 5, 50), at(2024, 1, 2), 1.0),
            (at(2024, 1, 1, 5, 10), at(2024, 1, 3), 2.0),
            (at(2024, 1, 1, 5, 20), at(2024, 1, 3), 3.0),
            (at(2024, 1, 1, 6, 0), at(2024, 1, 2), 4.0),
        ],
        "timestamp timestamp, load_date timestamp, temperature_celsius double",
    )
    got = {r.hour_timestamp.hour: r.temperature_celsius for r in J.dedupe_hourly(w).collect()}
    assert got == {5: 3.0, 6: 4.0}


def test_weather_of_the_first_partial_hour_is_kept(spark):
    w = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 10, 5), 7.0)], "timestamp timestamp, temperature_celsius double"
    )
    kept, bound = J.hourly_weather(w, ["temperature_celsius"], "2024-01-02 10:30:00", "1 day")
    assert kept.count() == 1 and bound >= 25


def test_nearby_demand_against_brute_force(spark):
    """A dense cluster, zones sharing one place, and points on both sides of the radius."""
    places = [(i, 40 + (i % 23) * 0.0013, -74 + (i * 7 % 31) * 0.0017) for i in range(300)]
    places += [(1000 + i, 40.0, -74.0) for i in range(40)] + [(2000, 45.0, -70.0)]
    demand = [(z, dt.datetime(2024, 1, 1, z % 3), z % 5 + 1) for z, _, _ in places]
    demand += [(9999, dt.datetime(2024, 1, 1, 0), 3)]
    zones = spark.createDataFrame(places, "location_id bigint, latitude double, longitude double")
    d = spark.createDataFrame(demand, "location_id bigint, hour_timestamp timestamp, demand_count bigint")
    got = {(r.location_id, r.hour_timestamp): r.nearby_zones_demand for r in J.nearby_demand(d, zones, 1.5).collect()}
    at = {z: (a, b) for z, a, b in places}
    for z, h, n in demand:
        want = 0
        if z in at:
            want = sum(
                m
                for y, g, m in demand
                if g == h and y != z and y in at and math.dist(at[z], at[y]) * 111 <= 1.5
            )
        assert got[(z, h)] == want
    assert len(got) == len(demand)


def test_two_clusters_a_radius_apart_cost_cells_and_not_pairs(spark):
    """Places of one cluster lie on the rim of the other's circles: comparing places would cost the square."""
    radius = 1.5 / 111
    rnd = random.Random(8)

    def cost(n):
        spots = [(40 + rnd.random() * radius / 3, -74 + side * radius + rnd.random() * radius / 3) for side in (0, 1) for _ in range(n)]
        places = spark.createDataFrame(spots, "lat double, lon double")
        around = J.neighbourhood(places, radius)
        got = around.groupBy("level").count().collect()
        return sum(r["count"] for r in got)

    small, large = cost(250), cost(1_000)
    assert large < 2.2 * 4 * small  # pairs would be 16 times as many
    assert large < 0.15 * 2 * 1_000 * 1_000


def test_reconciliation_of_equal_tables_moves_no_row(spark):
    a = spark.range(20_000).select("id", (F.col("id") * 2).cast("double").alias("v"), F.lit("x").alias("w")).repartition(4)
    assert rows_of(*flat(D.field_diff(a, a.repartition(3), "id", ["v", "w"]))) == rows_of(
        ["field", "n_rows"], [("v", 0), ("w", 0), ("(missing in copy)", 0), ("(missing in source)", 0)]
    )
    left, right = D.suspects(a, a.repartition(3), "id", ["v", "w"])
    assert left.count() == right.count() == 0
    other = a.withColumn("v", F.when(F.col("id") == 77, -1.0).otherwise(F.col("v"))).filter("id <> 99")
    left, right = D.suspects(a, other, "id", ["v", "w"])
    found = {r.id for r in left.select("id").collect()}
    assert {77, 99} <= found and len(found) < 20
    assert rows_of(*flat(D.field_diff(a, other, "id", ["v", "w"]))) == rows_of(
        ["field", "n_rows"], [("v", 1), ("w", 0), ("(missing in copy)", 1), ("(missing in source)", 0)]
    )
    assert D.same_rows(a, a.repartition(2)) and not D.same_rows(a, other) and not D.same_rows(a, a.unionAll(a.filter("id = 5")))
    plan = D.field_diff(a, other, "id", ["v", "w"])
    plan.collect()
    # What is shuffled by key comes out of the join with the broadcast buckets.
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Join FullOuter" in text and "Join LeftSemi" in text


def flat(df):
    return df.columns, [tuple(r) for r in df.collect()]


def test_reconciliation_finds_rows_missing_on_either_side(spark):
    a = spark.createDataFrame([(1, 1.0, "x"), (2, 2.0, None), (3, 3.0, "z")], "id int, v double, w string")
    b = spark.createDataFrame([(1, 1.0, "x"), (2, 2.5, None), (4, 4.0, "q")], "id int, v double, w string")
    got = {r.id: (r.status, r.v_differs, r.w_differs) for r in J.diff_by_key(a, b, "id", ["v", "w"]).collect()}
    assert got == {
        1: ("same", False, False),
        2: ("differs", True, False),
        3: ("missing_in_copy", False, False),
        4: ("missing_in_source", False, False),
    }
