"""Sinks: idempotent replacement, evolving schemas, partitions, exports, marks, landing of files."""

import datetime as dt
import json
import os

import pytest
from oracle import rows_of
from pyspark.sql import functions as F

from zonetide.functions import columns as C
from zonetide.operators import curate as U
from zonetide.operators import rollups as A
from zonetide.sources import readers, roles, schemas
from zonetide.tables import store as K


def rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


@pytest.fixture()
def curated(spark, sf_dir):
    return U.curate_trips(roles.raw_o(spark, sf_dir), "2024-02-01 00:00:00")


@pytest.mark.parametrize("name", sorted(schemas.OUTPUT_TABLES))
def test_ensure_table_creates_once(spark, name):
    schema, parts = schemas.OUTPUT_TABLES[name]
    for _ in range(2):
        K.ensure_table(spark, f"t_{name}", schema, parts)
    assert sorted(f"{n} {t}" for n, t in spark.table(f"t_{name}").dtypes) == sorted(schema.split(", "))
    ddl = spark.sql(f"SHOW CREATE TABLE t_{name}").first()[0].lower()
    assert "zstd" in ddl and all(p in ddl for p in parts)
    spark.sql(f"DROP TABLE t_{name}")


def test_replace_days_twice_is_once(spark, curated, tmp_path):
    import datetime as dt

    path = f"{tmp_path}/t"
    t = curated.select("pickup_datetime", "fare_amount", F.to_date("pickup_datetime").alias("day"))
    K.write_table(t, path, "errorifexists", ["day"])
    first, last = dt.date(1998, 3, 1), dt.date(1998, 4, 30)
    new = t.filter(F.col("day").between(F.lit(first), F.lit(last)) & (F.dayofmonth("day") != 7))
    new = new.withColumn("fare_amount", F.col("fare_amount") + 1)
    want = rows(t.filter(~F.col("day").between(F.lit(first), F.lit(last))).unionByName(new))
    for _ in range(2):
        K.replace_days(new, path, "day", first, last)
        assert rows(spark.read.schema("pickup_datetime timestamp, fare_amount double, day date").parquet(path)) == want


def test_new_rows_outside_the_replaced_range_are_an_error(spark):
    old = spark.createDataFrame([(1, 1.0), (None, 2.0), (9, 3.0)], "k int, v double")
    new = spark.createDataFrame([(9, 4.0)], "k int, v double")
    assert rows(K.replaced(old, new, F.col("k") > 5)) == rows(
        spark.createDataFrame([(1, 1.0), (None, 2.0), (9, 4.0)], "k int, v double")
    )
    for bad in (1, None):
        with pytest.raises(Exception, match="outside"):
            K.replaced(old, spark.createDataFrame([(bad, 5.0)], "k int, v double"), F.col("k") > 5).collect()


def test_replace_partitions_touches_only_its_own(spark, curated, tmp_path):
    path = f"{tmp_path}/t"
    K.write_table(curated, path, partition_by=["year", "month"])
    part = curated.filter("year = 1998 AND month = 3").withColumn("fare_amount", F.lit(1.0))
    for _ in range(2):
        K.replace_partitions(part, path, ["year", "month"])
    got = spark.read.parquet(path)
    assert got.count() == curated.count()
    assert got.filter("fare_amount = 1").count() == part.count() > 0


def test_partition_columns_prune_the_scan(spark, curated, tmp_path):
    K.write_table(curated, f"{tmp_path}/t", partition_by=["year", "month"])
    start, end = dt.datetime(1997, 11, 5), dt.datetime(1998, 2, 3)
    got = readers.read_trips_between(spark, f"{tmp_path}/t", start, end)
    assert rows(got.select("pickup_datetime")) == rows(
        curated.filter(F.col("pickup_datetime").between(F.lit(start), F.lit(end))).select("pickup_datetime")
    )
    scan = got._jdf.queryExecution().executedPlan().toString()
    filters = scan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "year" in filters and "month" in filters


def test_append_grows_the_schema(spark, tmp_path):
    path = f"{tmp_path}/t"
    K.append_evolving(spark.createDataFrame([(1, "a")], "id int, w string"), path)
    K.append_evolving(spark.createDataFrame([(2, 2.5)], "id int, v double"), path)
    got = K.read_evolving(spark, path)
    assert {r.id: (r.w, r.v) for r in got.collect()} == {1: ("a", None), 2: (None, 2.5)}


def test_ctas_and_refresh_replace_the_table(spark, curated):
    K.ctas(A.daily_summary(curated), "daily_summary", ["year", "month"])
    days = spark.table("daily_summary").count()
    assert days == curated.select(F.to_date("pickup_datetime")).distinct().count()
    assert "last_updated" in spark.table("daily_summary").columns
    K.ctas(A.daily_summary(curated, "1998-06-15"), "daily_summary", ["year", "month"])
    assert spark.table("daily_summary").count() <= 1
    got = K.refresh(spark, "monthly", A.monthly_load_stats(curated, "2024-02-01"))
    assert got.agg(F.sum("trip_count")).first()[0] == curated.count()
    assert K.refresh(spark, "monthly", A.monthly_load_stats(curated, "2024-02-02")).count() == 0
    spark.sql("DROP TABLE daily_summary")
    spark.sql("DROP TABLE monthly")


def test_full_refresh_leaves_only_the_new_rows(spark, tmp_path):
    for n in (5, 3):
        K.full_refresh(spark.range(n), f"{tmp_path}/z")
    assert spark.read.parquet(f"{tmp_path}/z").count() == 3


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_export(spark, sf_dir, tmp_path, fmt):
    trips = roles.trips_e(spark, sf_dir)
    K.export_trips(trips, "2024-01-05 00:00:00", "2024-01-06 00:00:00", fmt, f"{tmp_path}/x")
    back = spark.read.option("header", True).format(fmt).load(f"{tmp_path}/x")
    want = trips.filter("pickup_datetime BETWEEN '2024-01-05' AND '2024-01-06'")
    assert back.count() == want.count() > 0 and set(back.columns) == set(trips.columns)
    with pytest.raises(ValueError):
        K.export_trips(trips, "2024-01-05", "2024-01-06", "xml", f"{tmp_path}/y")


def test_high_water_mark_round(spark, sf_dir):
    trips = roles.trips_e(spark, sf_dir)
    control = spark.createDataFrame([], schemas.CONTROL)
    first = readers.incremental(trips, control, "trips", "pickup_datetime", "2024-01-31 00:00:00", "10 days")
    assert first.count() == trips.filter("pickup_datetime > '2024-01-21'").count()
    control = K.advance_hwm(control, "trips", "2024-01-25 00:00:00", "2024-01-31 00:00:00")
    control = K.advance_hwm(control, "weather", "2024-01-26 00:00:00", "2024-01-31 00:00:00")
    control = K.advance_hwm(control, "trips", "2024-01-28 00:00:00", "2024-02-01 00:00:00")
    marks = {r.table_name: r.last_processed_date.day for r in control.collect()}
    assert marks == {"trips": 28, "weather": 26}
    second = readers.incremental(trips, control, "trips", "pickup_datetime", "2024-01-31 00:00:00")
    assert second.count() == trips.filter("pickup_datetime > '2024-01-28'").count() > 0


def test_landing_the_same_rows_twice_adds_nothing(spark, sf_dir):
    t = roles.trips_e(spark, sf_dir)
    stored = K.not_stored(t.union(t), None, "pickup_datetime")
    assert stored.count() == t.count()
    assert K.not_stored(t, stored, "pickup_datetime").count() == 0


def test_json_arrays_with_mixed_numbers(spark, tmp_path):
    records = [
        {"timestamp": "2025-08-03T00:25:22.490942", "temperature_celsius": 34.57, "humidity_percent": 70, "uv_index": 0,
         "weather_condition": "clear", "is_weekend": True},
        {"timestamp": "2025-08-02T23:25:22", "temperature_celsius": 17, "humidity_percent": 70.3, "uv_index": 1.5,
         "weather_condition": "fog", "is_weekend": False},
        {"timestamp": "later", "temperature_celsius": 1, "humidity_percent": 1},
    ]
    os.makedirs(f"{tmp_path}/w")
    for i, part in enumerate((records[:2], records[2:])):
        with open(f"{tmp_path}/w/{i}.json", "w") as f:
            json.dump(part, f, indent=2)
    raw = readers.read_json_array(spark, f"{tmp_path}/w", schemas.RAW_WEATHER)
    got = U.curate_weather(raw, "2025-08-04 00:00:00")
    assert raw.count() == 3 and got.count() == 2
    first = got.orderBy("timestamp").first()
    assert (first.humidity_percent, first.year, first.month, first.day) == (70.3, 2025, 8, 2)


def test_zone_file(spark, tmp_path):
    zone = {"location_id": 132, "borough": "Queens", "zone": "North Airport", "lat": 40.6, "lon": -73.7,
            "zone_type": "airport", "is_tourist_area": False, "is_business_district": False,
            "created_at": "2025-08-03T09:25:21.645661"}
    with open(f"{tmp_path}/z.json", "w") as f:
        json.dump([zone, {**zone, "location_id": 1, "created_at": "?"}], f)
    got = U.curate_zones(readers.read_json_array(spark, f"{tmp_path}/z.json", schemas.RAW_ZONES), "2025-08-04")
    assert {n: t for n, t in got.dtypes} == dict(c.rsplit(" ", 1) for c in schemas.ZONES.split(", "))
    assert {r.location_id: r.created_at is None for r in got.collect()} == {132: False, 1: True}


def test_time_partition_columns(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4),)], "t timestamp")
    day, name = K.with_time_partition(df, "t", "day")
    assert (name, day.first()[name]) == ("t_day", dt.date(2024, 1, 2))
    hour, name = K.with_time_partition(df, "t", "hour")
    assert (name, hour.first()[name]) == ("t_hour", "2024-01-02-03")
    with pytest.raises(ValueError):
        K.with_time_partition(df, "t", "week")


def test_named_parameters_are_bound(spark, sf_dir):
    roles.trips_e(spark, sf_dir).createOrReplaceTempView("bound_trips")
    df = readers.named_query(spark, "SELECT count(*) AS n FROM bound_trips WHERE vendor_id = :v", v="x' OR '1'='1")
    assert df.first().n == 0


def test_tables_are_read_by_name_and_as_streams(spark, tmp_path):
    spark.range(7).write.mode("overwrite").saveAsTable("seven")
    assert readers.table(spark, "seven").count() == 7
    q = readers.read_table_stream(spark, "seven").writeStream.format("memory").queryName("seven_seen").trigger(
        availableNow=True
    ).option("checkpointLocation", f"{tmp_path}/c").start()
    q.awaitTermination(120)
    assert spark.table("seven_seen").count() == 7
    spark.sql("DROP TABLE seven")
