"""Ranks, tiles, lags and frames against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from zonetide.operators import windows as W


@pytest.mark.parametrize("shape", ["spread", "ties", "one value", "few"])
def test_global_rank_and_tiles(spark, shape):
    rng = random.Random(5)
    n = 7 if shape == "few" else 3000
    values = {
        "spread": lambda: rng.random() * 100,
        "ties": lambda: rng.choice([1.0, 1.0, 1.0, 1.5, rng.random() * 3]),
        "one value": lambda: 2.0,
        "few": lambda: rng.random(),
    }[shape]
    data = [(i * 13 % 10007, values()) for i in range(n)]
    df = spark.createDataFrame(data, "k bigint, v double").repartition(7)
    ranked = W.with_global_rank(df, "v", "k")
    got = {r.k: (r["rank"], r._rows, r.tile) for r in
           ranked.withColumn("tile", W.ntile_of(F.col("rank"), F.col("_rows"), 10)).collect()}
    w = Window.orderBy("v", "k")
    want = {
        r.k: (r.rn, n, r.t)
        for r in df.select("k", F.row_number().over(w).alias("rn"), F.ntile(10).over(w).alias("t")).collect()
    }
    assert got == want


def demand(spark, zones=4, hours=900, gaps=True):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    data = [
        (z, start + dt.timedelta(hours=h), rng.randint(1, 50))
        for z in range(zones)
        for h in range(hours)
        if not gaps or rng.random() < 0.9
    ]
    return spark.createDataFrame(data, "location_id bigint, hour_timestamp timestamp, demand_count bigint")


def test_rolling_columns_equal_plain_frames(spark):
    d = demand(spark)
    specs = {"a7": ("avg", 168), "a30": ("avg", 720), "s7": ("stddev", 168), "s2": ("stddev", 2)}
    w = Window.partitionBy("location_id").orderBy("hour_timestamp")
    plain = d
    for name, (kind, n) in specs.items():
        plain = plain.withColumn(f"p_{name}", getattr(F, kind)("demand_count").over(w.rowsBetween(-n, -1)))
    both = W.add_rolling(plain, specs)
    bad = F.lit(False)
    for name in specs:
        a, b = F.col(name), F.col(f"p_{name}")
        bad = bad | (a.isNull() != b.isNull()) | F.coalesce(F.abs(a - b) > 1e-9, F.lit(False))
    assert both.filter(bad).count() == 0
    assert both.filter("a7 IS NOT NULL").count() == both.count() - 4


def test_grid_offsets_are_hours(spark):
    """With every hour filled, the lag of k rows is the demand k clock hours ago, 0 for an idle hour."""
    d = demand(spark, zones=2, hours=60)
    grid = W.demand_grid(d, "2024-01-01 00:00:00", "2024-01-03 11:00:00")
    assert grid.count() == 2 * 60
    lagged = W.add_lags(grid, (3, 24))
    by_time = {(r.location_id, r.hour_timestamp): r.demand_count for r in d.collect()}
    for r in lagged.collect():
        for k in (3, 24):
            then = r.hour_timestamp - dt.timedelta(hours=k)
            want = None if then < dt.datetime(2024, 1, 1) else by_time.get((r.location_id, then), 0)
            assert r[f"lag_{k}"] == want


def test_grid_keeps_the_total(spark):
    d = demand(spark, zones=3, hours=50)
    grid = W.demand_grid(d, "2024-01-01 00:00:00", "2024-01-03 01:00:00")
    assert grid.agg(F.sum("demand_count")).first()[0] == d.agg(F.sum("demand_count")).first()[0]


def test_a_grid_is_expanded_last(spark):
    start = dt.datetime(2024, 1, 1)
    at = lambda h: start + dt.timedelta(hours=h)
    data = [(1, at(0), 3), (1, at(0), 4), (1, at(2), 5), (2, at(9), 6), (None, at(1), 7), (3, None, 8), (4, at(0.5), 9)]
    grid = W.demand_grid(spark.createDataFrame(data, "location_id int, hour_timestamp timestamp, demand_count bigint"), at(0), at(2))
    got = sorted((r.location_id or 0, (r.hour_timestamp - start).total_seconds() / 3600, r.demand_count) for r in grid.collect())
    zeros = {(z, h): 0 for z in range(5) for h in range(3)}
    want = {**zeros, (1, 0): 7, (1, 2): 5, (0, 1): 7, (4, 0.5): 9}
    assert got == sorted((z, h, n) for (z, h), n in want.items())
    # The added hours pass no aggregate and no shuffle.
    plan = grid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate") and "Union" not in plan
