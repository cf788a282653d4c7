"""Stored merges, rollups by day, deep pages and landing: what is read, what is rewritten, and what stays."""

import datetime as dt
import re

import pytest
from oracle import rows_of
from pyspark.sql import functions as F

from zonetide.functions import bitmaps
from zonetide.operators import changes as X
from zonetide.operators import ordering as T
from zonetide.operators import rollups as A
from zonetide.plans import jobs
from zonetide.sources import schemas
from zonetide.tables import rollup

DAY = dt.datetime(2024, 1, 1)


def rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def times(folder):
    return {str(p): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


# --- updates of a stored table --------------------------------------------------------------------------------------


def source_trips(spark, n=60):
    """`n` trips, ten a day."""
    made = spark.range(n).select(
        "id", F.lit(1).alias("vendor_id"), (F.lit(DAY) + F.make_dt_interval((F.col("id") / 10).cast("int"))).alias("pickup_datetime"),
        *[F.lit(float(k)).alias(c) for k, c in enumerate(("trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "total_amount"))],
    )
    return made.withColumns(
        {"dropoff_datetime": F.col("pickup_datetime"), "updated_at": F.col("pickup_datetime"), "pickup_date": F.to_date("pickup_datetime")}
    )


def update_rows(spark, rows_):
    return spark.createDataFrame(rows_, "id bigint, tip_amount double, updated_at timestamp")


def test_an_update_rewrites_the_days_of_its_trips(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path))
    lake.append("source_trips", source_trips(spark))
    before = times(tmp_path / "source_trips")
    at = dt.datetime(2024, 2, 1)
    first = update_rows(spark, [(3, 9.0, at), (3, 8.0, at), (41, 7.0, at), (999, 1.0, at)])
    assert jobs.merge_updates(lake, first, 1) == 2
    after = times(tmp_path / "source_trips")
    untouched = {p: t for p, t in before.items() if not re.search("pickup_date=2024-01-0[15]/", p)}
    assert len({p.split("/")[-2] for p in untouched}) == 4 and untouched.items() <= after.items()
    got = {r.id: r for r in lake.read("source_trips").collect()}
    assert len(got) == 60 and (got[3].tip_amount, got[3].total_amount, got[3].updated_at) == (9.0, 1 + 2 + 3 + 9 + 5.0, at)
    assert got[41].tip_amount == 7.0 and got[4].tip_amount == 4.0 and got[4].updated_at == DAY

    # The same number again does nothing; an older update changes nothing; no known trip, no day.
    once = times(tmp_path / "source_trips")
    assert jobs.merge_updates(lake, update_rows(spark, [(5, 1.0, at)]), 1) == 0
    assert times(tmp_path / "source_trips") == once
    assert jobs.merge_updates(lake, update_rows(spark, [(3, 1.0, at - dt.timedelta(days=1))]), 2) == 1
    assert {r.id: r.tip_amount for r in lake.read("source_trips").collect()}[3] == 9.0
    assert jobs.merge_updates(lake, update_rows(spark, [(999, 1.0, at)]), 3) == 0


def test_a_batch_that_ended_before_its_log_is_run_again(spark, tmp_path, monkeypatch):
    lake = jobs.Lake(spark, str(tmp_path))
    lake.append("source_trips", source_trips(spark, 20))
    batch = update_rows(spark, [(3, 9.0, dt.datetime(2024, 2, 1))])
    append = jobs.Lake.append

    def broken(self, table, rows_):
        if table == "merged_batches":
            raise RuntimeError("lost")
        append(self, table, rows_)

    monkeypatch.setattr(jobs.Lake, "append", broken)
    with pytest.raises(RuntimeError, match="lost"):
        jobs.merge_updates(lake, batch, 1)
    once = rows(lake.read("source_trips"))
    monkeypatch.setattr(jobs.Lake, "append", append)
    assert jobs.merge_updates(lake, batch, 1) == 1
    assert rows(lake.read("source_trips")) == once


def test_stored_and_direct_updates_agree(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path))
    lake.append("source_trips", source_trips(spark))
    batch = update_rows(spark, [(k, k / 2, dt.datetime(2024, 2, 1) + dt.timedelta(hours=k)) for k in range(0, 60, 7)])
    jobs.merge_updates(lake, batch, 1)
    base = source_trips(spark)
    found = lake.read("source_trips").select(*base.columns)
    assert rows(found) == rows(X.apply_updates(base, batch))


# --- rollups by day -------------------------------------------------------------------------------------------------


def facts(spark):
    return spark.range(3_000).select(
        (F.lit(DAY) + F.make_dt_interval((F.col("id") % 6).cast("int"), (F.col("id") % 24).cast("int"))).alias("at"),
        F.when(F.col("id") % 50 != 0, F.col("id") % 3).cast("int").alias("vendor"),
        F.when(F.col("id") % 7 != 0, (F.col("id") * 37 % 90_000) - 40_000).cast("int").alias("zone"),
        F.when(F.col("id") % 5 != 0, (F.col("id") % 11).cast("double")).alias("fare"),
    )


def test_a_rollup_of_days_equals_the_direct_one(spark, tmp_path):
    f = facts(spark)
    stored = rollup.Rollup(spark, str(tmp_path), "at", ("vendor",), sums=("fare",), means=("fare",), distinct=("zone",))
    days = [DAY.date() + dt.timedelta(days=k) for k in range(6)]
    late = (F.to_date("at") == F.lit(days[3])) & (F.hour("at") == 15)
    stored.refresh(f.filter(~late), days)

    def direct(df):
        return df.groupBy("vendor").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("fare").alias("total_fare"), F.avg("fare").alias("avg_fare"),
            F.count_distinct("zone").alias("distinct_zone"),
        )

    assert rows(stored.read()) == rows(direct(f.filter(~late)))
    # One late day: its parts are made again, those of the others are not touched.
    before = times(tmp_path)
    stored.refresh(f, [days[3]])
    assert rows(stored.read()) == rows(direct(f))
    changed = {p for p, t in times(tmp_path).items() if before.get(p) != t}
    assert changed and all(f"part_day={days[3]}" in p for p in changed)
    part = f.filter(F.to_date("at").between(F.lit(days[1]), F.lit(days[2])))
    assert rows(stored.read(days[1], days[2])) == rows(direct(part))
    # A day without rows any more has no parts any more.
    stored.refresh(f.filter(F.to_date("at") != F.lit(days[5])), [days[0], days[5]])
    assert rows(stored.read()) == rows(direct(f.filter(F.to_date("at") != F.lit(days[5]))))


def test_a_late_load_refreshes_its_own_days(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path))

    def trips(days, load, fare):
        names = {c.split()[0]: c.split()[1] for c in schemas.CURATED_TRIPS.split(", ")}
        made = spark.createDataFrame([(d,) for d in days], "pickup_datetime timestamp")
        other = {c: F.lit(1).cast(k) for c, k in names.items() if c != "pickup_datetime"}
        out = made.withColumns({**other, "fare_amount": F.lit(fare), "load_date": F.lit(load)})
        return out.withColumns({"year": F.year("pickup_datetime"), "month": F.month("pickup_datetime")})

    first, later = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)
    lake.append("trips", trips([DAY, DAY + dt.timedelta(days=1), dt.datetime(2023, 12, 31)], first, 2.0))
    assert len(jobs.refresh_vendor_rollup(lake, DAY)) == 3
    lake.append("trips", trips([dt.datetime(2023, 12, 31, 5)], later, 5.0))
    before = times(tmp_path / "vendor_rollup")
    assert jobs.refresh_vendor_rollup(lake, first) == [dt.date(2023, 12, 31)]
    assert all("2023-12-31" in p for p, t in times(tmp_path / "vendor_rollup").items() if before.get(p) != t)
    row = jobs.vendor_rollup(lake).read().first()
    assert (row.n_rows, row.total_fare_amount) == (4, 11.0)
    assert jobs.refresh_vendor_rollup(lake, later) == []


def test_bitmaps_count_exactly(spark):
    df = spark.range(200_000).select((F.col("id") % 2).alias("k"), ((F.col("id") * 7919) % 70_001 - 35_000).alias("v"))
    df = df.withColumn("v", F.when(F.col("v") != 5, F.col("v")))
    got = {r.k: r.n for r in bitmaps.count_bits(bitmaps.distinct_bits(df, ["k"], "v"), ["k"], "n").collect()}
    assert got == {r.k: r.n for r in df.groupBy("k").agg(F.count_distinct("v").alias("n")).collect()}


def test_fare_stats_without_a_copy_of_the_trips(spark):
    f = spark.range(5_000).select(
        *[F.when(F.col("id") % m != 0, (F.col("id") * 31 % 977).cast("double") / m).alias(c) for m, c in ((7, "fare_amount"), (11, "trip_distance"), (13, "trip_duration_minutes"))],
        F.when(F.col("id") % 17 != 0, F.col("id") * 13 % 70_000).alias("pickup_zone_id"), (F.col("id") % 90 - 40).alias("dropoff_zone_id"),
    )
    want = f.agg(
        F.count(F.lit(1)).alias("total_trips"), F.avg("fare_amount").alias("avg_fare"), F.stddev("fare_amount").alias("stddev_fare"),
        F.avg("trip_distance").alias("avg_distance"), F.avg("trip_duration_minutes").alias("avg_duration"),
        F.count_distinct("pickup_zone_id").alias("unique_pickup_zones"), F.count_distinct("dropoff_zone_id").alias("unique_dropoff_zones"),
    )
    got = A.fare_stats(f)
    assert rows(got) == rows(want)
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    empty = A.fare_stats(f.limit(0)).first()
    assert (empty.total_trips, empty.avg_fare, empty.stddev_fare, empty.unique_pickup_zones) == (0, None, None, 0)
    assert A.fare_stats(f.filter("fare_amount > 0").limit(1)).first().stddev_fare is None


# --- pages ----------------------------------------------------------------------------------------------------------


def test_a_deep_page_reads_the_buckets_that_hold_it(spark, tmp_path):
    listing = spark.range(10_000).select((F.col("id") % 40).alias("hour"), "id")
    order = ["-hour", "id"]
    T.build_pages(listing, order, str(tmp_path), rows_per_bucket=500)
    whole = [tuple(r) for r in listing.orderBy(F.desc("hour"), "id").collect()]
    for page, size in ((1, 30), (7, 100), (100, 100), (101, 100), (3, 4_000), (334, 30)):
        got = T.read_page(spark, str(tmp_path), order, page, size)
        assert [(r.hour, r.id) for r in got.collect()] == whole[(page - 1) * size : page * size], (page, size)
    deep = T.read_page(spark, str(tmp_path), order, 90, 100)
    assert rows(deep) == rows(T.paginate(listing, order, 90, 100))
    assert len(deep.inputFiles()) > 2  # the folder's files; of which the filter leaves
    found = re.search(r"PartitionFilters: \[bucket#\d+ IN \(([\d,]+)\)|PartitionFilters: \[isnotnull\(bucket#\d+\), \(bucket#\d+ = (\d+)\)", deep._jdf.queryExecution().executedPlan().toString())
    assert found and len([x for x in (found[1] or found[2]).split(",") if x]) <= 2
    assert T.read_page(spark, str(tmp_path), order, 500, 100).count() == 0
    T.build_pages(listing.limit(0), order, f"{tmp_path}/none")
    assert T.read_page(spark, f"{tmp_path}/none", order, 1, 10).count() == 0
    with pytest.raises(ValueError, match="start at 1"):
        T.read_page(spark, str(tmp_path), order, 0, 10)


@pytest.mark.parametrize("large, buckets", [(100_000, 12), (400, 25)])
def test_a_long_listing_has_larger_buckets(spark, tmp_path, monkeypatch, large, buckets):
    monkeypatch.setattr(T, "SMALL_BUCKETS", 12, raising=False)
    monkeypatch.setattr(T, "ROWS_PER_BUCKET", large)
    listing = spark.range(10_000).select((F.col("id") % 40).alias("hour"), "id")
    order = ["-hour", "id"]
    T.build_pages(listing, order, str(tmp_path), rows_per_bucket=50)
    assert spark.read.parquet(f"{tmp_path}/directory").count() == buckets
    for page, size in ((1, 30), (90, 100), (2, 1_700)):
        assert rows(T.read_page(spark, str(tmp_path), order, page, size)) == rows(T.paginate(listing, order, page, size))


# --- landing --------------------------------------------------------------------------------------------------------


def raw_file(spark, path, hour):
    day = dt.datetime(2024, 1, 5, hour)
    row = (1, day, day, 1, 2.0, 1, "N", 10, 20, 1, 10.0, *[0.0] * 5, 12.0, 0.0, 0.0)
    spark.createDataFrame([row] * 3, schemas.RAW_TRIPS).coalesce(1).write.mode("append").parquet(path)


def test_only_new_files_are_opened(spark, tmp_path, monkeypatch):
    lake, src = jobs.Lake(spark, f"{tmp_path}/lake"), f"{tmp_path}/raw"
    for hour in range(5):
        raw_file(spark, src, hour)
    at = dt.datetime(2024, 1, 30)
    jobs.land_trips(lake, src, at)
    assert lake.read("trips").count() == 5 and lake.read("landed_files").count() == 5
    raw_file(spark, src, 9)
    opened = []
    staged = jobs.Lake.staged

    def watched(self, rows_):
        opened.extend(rows_.inputFiles())
        return staged(self, rows_)

    monkeypatch.setattr(jobs.Lake, "staged", watched)
    jobs.land_trips(lake, src, at)
    assert len(opened) == 1 and lake.read("trips").count() == 6
    jobs.land_trips(lake, src, at)
    assert len(opened) == 1
    # Nothing of the steps between is left.
    assert not list((tmp_path / "lake/_staging").glob("*"))


def test_bad_rows_of_a_large_file_are_not_dealt_out_by_file(spark, tmp_path, monkeypatch):
    lake, src = jobs.Lake(spark, f"{tmp_path}/lake"), f"{tmp_path}/raw"
    plans, append = [], jobs.Lake.append

    def watched(self, table, rows_):
        if table == "bad_trips":
            plans.append(rows_._jdf.queryExecution().executedPlan().toString())
        append(self, table, rows_)

    monkeypatch.setattr(jobs.Lake, "append", watched)
    for year in (1990, 1991):
        raw_file(spark, src, 3)
        spark.read.parquet(src).limit(1).withColumn("tpep_pickup_datetime", F.lit(dt.datetime(year, 1, 1))).write.mode("append").parquet(src)
        jobs.land_trips(lake, src, dt.datetime(2024, 1, 30))
    assert lake.read("bad_trips").count() == 2
    # Nothing but the name's join has a key, and that one is broadcast.
    assert len(plans) == 2 and all("BroadcastHashJoin [file" in p for p in plans)
    assert not any("SortMergeJoin [file" in p and "LeftAnti" in p.split("SortMergeJoin [file")[1].splitlines()[0] for p in plans)
