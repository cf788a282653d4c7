"""The jobs end to end on files: land, refresh, report; running a day again changes nothing."""

import datetime as dt

import pytest
from oracle import rows_of
from pyspark.sql import functions as F

from zonetide.operators import curate as U
from zonetide.operators import rollups as A
from zonetide.plans import features as M
from zonetide.plans import jobs
from zonetide.sources import roles, schemas

AS_OF = dt.datetime(2024, 1, 30, 12, 30)
DERIVED = ("daily_summary", "trip_weather_correlation", "zone_performance_metrics", "demand_features_analytics")
FEATURES = ("demand_features_ml", "fare_features")


def rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    src = str(tmp_path_factory.mktemp("src"))
    d = "/root/testdata/sf0.001"
    t = roles.trips_e(spark, d).withColumns(
        {
            "vendor_id": F.col("payment_type"), "rate_code_id": F.lit(1), "store_and_fwd_flag": F.lit("N"),
            "extra": F.lit(0.0), "mta_tax": F.lit(0.5), "tolls_amount": F.lit(0.0),
            "improvement_surcharge": F.lit(0.0), "congestion_surcharge": F.lit(0.0), "airport_fee": F.lit(0.0),
            "pickup_location_id": F.col("pickup_location_id").cast("int"),
            "dropoff_location_id": F.col("dropoff_location_id").cast("int"),
        }
    )
    back = {
        "vendor_id": "VendorID", "pickup_datetime": "tpep_pickup_datetime", "dropoff_datetime": "tpep_dropoff_datetime",
        "rate_code_id": "RatecodeID", "pickup_location_id": "PULocationID", "dropoff_location_id": "DOLocationID",
    }
    raw = t.withColumnsRenamed(back).select(*[c.split(" ")[0] for c in schemas.RAW_TRIPS.split(", ")])
    raw.write.parquet(f"{src}/trips")

    def array_of(df):
        return df.coalesce(1).agg(F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(F.struct("*"))), ","), F.lit("]")))

    weather = roles.weather_raw(spark, d).drop("load_date")
    array_of(weather).write.text(f"{src}/weather")
    zones = roles.zones_c(spark, d).withColumnsRenamed({"latitude": "lat", "longitude": "lon"})
    array_of(zones.withColumn("created_at", F.lit("2025-08-03T09:25:21"))).write.text(f"{src}/zones")

    made = jobs.Lake(spark, str(tmp_path_factory.mktemp("lake")))
    for _ in range(2):
        jobs.land_trips(made, f"{src}/trips", AS_OF)
    jobs.land_weather(made, f"{src}/weather", AS_OF)
    for _ in range(2):
        jobs.land_zones(made, f"{src}/zones", AS_OF)
    return made, src


def refresh_at(lake, as_of):
    jobs.refresh_daily_summary(lake, as_of)
    jobs.refresh_trip_weather(lake, as_of)
    jobs.refresh_zone_performance(lake, as_of)
    jobs.refresh_demand_features(lake, as_of)
    jobs.refresh_demand_features_ml(lake, as_of)
    jobs.refresh_fare_features(lake, as_of)


def refresh(lake):
    refresh_at(lake, AS_OF)


def content(lake):
    return {n: rows(lake.read(n)) for n in (*DERIVED, *FEATURES)}


def test_landing_twice_adds_nothing(spark, lake):
    made, src = lake
    trips = made.read("trips")
    valid = U.clean_trips(spark.read.schema(schemas.RAW_TRIPS).parquet(f"{src}/trips"))
    assert trips.count() == valid.distinct().count() > 0
    mark = made.marks().first()
    assert mark.last_processed_date == trips.agg(F.max("pickup_datetime")).first()[0]
    assert made.read("zones").count() == roles.zones_c(spark, "/root/testdata/sf0.001").count()


def raw_rows(spark, *pickups):
    day = dt.timedelta(minutes=9)
    rows_ = [
        (1, p, p + day, 1, 2.0 + k, 1, "N", 10, 20, 1, 10.0, *[0.0] * 5, 12.0, 0.0, 0.0) for k, p in enumerate(pickups)
    ]
    return spark.createDataFrame(rows_, schemas.RAW_TRIPS).coalesce(1)


def test_every_valid_trip_lands_once(spark, tmp_path, monkeypatch):
    lake, src, at = jobs.Lake(spark, f"{tmp_path}/lake"), f"{tmp_path}/in", dt.datetime
    stored = lambda: sorted(r.pickup_datetime for r in lake.read("trips").collect())

    old, new = at(2019, 3, 1, 8), at(2024, 1, 20, 8)
    raw_rows(spark, old, new, at(2098, 1, 1)).write.mode("append").parquet(src)
    jobs.land_trips(lake, src, AS_OF)
    assert stored() == [old, new]  # older than any interval, and not the impossible one
    assert [r.tpep_pickup_datetime for r in lake.read("bad_trips").collect()] == [at(2098, 1, 1)]
    assert lake.marks().first().last_processed_date == new

    late = at(2023, 12, 31, 23)
    raw_rows(spark, late).write.mode("append").parquet(src)
    raw_rows(spark, old, new, at(2098, 1, 1)).write.mode("append").parquet(src)  # the same trips in another file
    jobs.land_trips(lake, src, AS_OF)
    assert stored() == [old, late, new]

    # A run that ends between the append and the log of files.
    last = at(2024, 1, 29, 1)
    raw_rows(spark, last).write.mode("append").parquet(src)
    append = jobs.Lake.append

    def broken(self, table, rows_):
        if table == "landed_files":
            raise RuntimeError("lost")
        append(self, table, rows_)

    monkeypatch.setattr(jobs.Lake, "append", broken)
    with pytest.raises(RuntimeError, match="lost"):
        jobs.land_trips(lake, src, AS_OF)
    monkeypatch.setattr(jobs.Lake, "append", append)
    for _ in range(2):
        jobs.land_trips(lake, src, AS_OF)
    assert stored() == [old, late, new, last]


def test_refresh_is_idempotent_and_equals_the_direct_query(spark, lake):
    made, _ = lake
    refresh(made)
    once = content(made)
    refresh(made)
    assert content(made) == once
    for name, found in once.items():
        assert found, name

    d = jobs.whole_days(AS_OF, 1)
    trips, weather = made.read("trips"), made.read("hourly_weather")
    direct = A.trip_weather(trips, weather, d.until, d.length)
    assert rows(made.read("trip_weather_correlation").select(*direct.columns)) == rows(direct)
    direct = M.demand_features_ml(trips, weather, made.read("zones"), d.until, None, d.length)
    found = made.read("demand_features_ml").select("location_id", "prediction_hour", "rolling_avg_30d", "demand_168h_ago")
    assert rows(found) == rows(direct.select(*found.columns))


def test_a_backfill_keeps_later_days_and_empties_its_own(spark, lake):
    made, _ = lake
    refresh(made)
    before = content(made)
    for day in (dt.datetime(2024, 1, 10, 3), dt.datetime(2024, 1, 30, 1)):  # an earlier day; an earlier hour
        refresh_at(made, day)
    after = content(made)
    for name, found in before.items():
        missing = [r for r in found if r not in set(after[name])]
        assert not [r for r in missing if "load" not in name and AS_OF.isoformat() not in repr(r)], name
        assert len(after[name]) >= len(found), name
    refresh(made)
    # A day that has no trips any more has no rows any more.
    empty = made.read("trip_weather_correlation").limit(0)
    made.store_days("trip_weather_correlation", empty, jobs.Days(dt.date(2024, 1, 30), dt.date(2024, 1, 30)))
    left = {r.trip_date for r in made.read("trip_weather_correlation").select("trip_date").distinct().collect()}
    assert dt.date(2024, 1, 30) not in left and dt.date(2024, 1, 29) in left
    wrong = made.read("trip_weather_correlation").filter("trip_date = '2024-01-29'")
    with pytest.raises(Exception, match="outside"):
        made.store_days("trip_weather_correlation", wrong, jobs.Days(dt.date(2024, 1, 10), dt.date(2024, 1, 10)))


def test_a_later_day_keeps_the_earlier_ones(spark, lake):
    made, _ = lake
    refresh(made)
    before = made.read("trip_weather_correlation").filter("trip_date = '2024-01-29'").count()
    features = made.read("fare_features").filter("feature_date = '2024-01-23'").count()
    later = dt.datetime(2024, 1, 31, 6, 0)
    jobs.refresh_trip_weather(made, later)
    jobs.refresh_fare_features(made, later)
    assert made.read("trip_weather_correlation").filter("trip_date = '2024-01-29'").count() == before > 0
    assert made.read("fare_features").filter("feature_date = '2024-01-23'").count() == features > 0


def test_reports(spark, lake):
    made, _ = lake
    refresh(made)
    found = {name: df.count() for name, df in jobs.reports(made, AS_OF).items()}
    assert found["demand_stats"] == found["fare_stats"] == 1
    assert all(n > 0 for n in found.values())
