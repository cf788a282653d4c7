"""The batch jobs: land files, refresh the derived tables. Each can be run again for the same day without harm.

Tables are parquet folders under one root. Derived tables are partitioned by day; a refresh computes whole days and replaces
exactly those, so a backfill leaves later days alone. Small logs (marks, landed files) are appended to.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonetide.functions import columns as C
from zonetide.operators import changes as X
from zonetide.operators import curate as U
from zonetide.operators import rollups as A
from zonetide.plans import features as M
from zonetide.sources import readers, schemas
from zonetide.tables import rollup
from zonetide.tables import store as K

DEMAND_PAIRS = {
    "demand_temp_corr": ("target_demand", "temperature_celsius"),
    "demand_seasonal_corr": ("target_demand", "demand_24h_ago"),
    "demand_popularity_corr": ("target_demand", "zone_popularity_score"),
}
#: Days over which route means are taken, whatever days are emitted.
ROUTE_DAYS = 7
#: Pickups before this, or more than a day after the load, are mistakes of the meter.
EARLIEST = datetime(2000, 1, 1)


@dataclass(frozen=True)
class Lake:
    """Where the tables are."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def exists(self, table: str) -> bool:
        return K.exists(self.spark, self.path(table))

    def read(self, table: str) -> DataFrame:
        """A table with its declared columns, in their order; empty if it was never written."""
        schema = schemas.OUTPUT_TABLES[table][0]
        if not self.exists(table):
            return self.spark.createDataFrame([], schema)
        return K.conform(self.spark.read.schema(schema).parquet(self.path(table)), schema)

    def marks(self) -> DataFrame:
        """The newest mark of each table out of the log of marks."""
        return K.upsert_marks(self.spark.createDataFrame([], schemas.CONTROL), self.read("control"))

    def trips(self, since: datetime, until: datetime) -> DataFrame:
        """Trips of a time range; months outside it are not read."""
        return readers.read_trips_between(self.spark, self.path("trips"), since, until, schemas.CURATED_TRIPS)

    @contextmanager
    def staged(self, rows: DataFrame) -> Iterator[DataFrame]:
        """Rows written beside the tables and read back, so that several steps use them and make them once."""
        path = self.path(f"_staged/{uuid.uuid4().hex}")
        rows.write.parquet(path)
        try:
            yield self.spark.read.schema(rows.schema).parquet(path)
        finally:
            K.delete(self.spark, path)

    def append(self, table: str, rows: DataFrame) -> None:
        schema, parts = schemas.OUTPUT_TABLES[table]
        K.write_table(K.conform(rows, schema), self.path(table), "append", parts)

    def store_days(self, table: str, rows: DataFrame, days: Days) -> None:
        """Make the rows the table's content of these days."""
        schema, (day_col,) = schemas.OUTPUT_TABLES[table]
        K.replace_days(K.conform(rows, schema), self.path(table), day_col, days.first, days.last)


@dataclass(frozen=True)
class Days:
    """Whole days, from the midnight before the first to the last moment of the last."""

    first: date
    last: date

    @property
    def since(self) -> datetime:
        return datetime(self.first.year, self.first.month, self.first.day)

    @property
    def until(self) -> datetime:
        return datetime(self.last.year, self.last.month, self.last.day) + timedelta(days=1, microseconds=-1)

    @property
    def length(self) -> str:
        return f"{((self.last - self.first).days + 1) * 86_400_000_000 - 1} microseconds"


def whole_days(as_of: datetime, days: int) -> Days:
    """The day of `as_of` and the `days` days before it.

    Days are computed whole whatever the hour of `as_of`: an earlier run for a day never replaces it by a part of it.
    """
    return Days(as_of.date() - timedelta(days=days), as_of.date())


# --- landing --------------------------------------------------------------------------------------------------------

def _same_file(name: str) -> Column:
    """A file's name in one spelling, however many slashes follow its scheme."""
    return F.regexp_replace(name, "^file:/+", "file:/")


def land_trips(lake: Lake, raw_path: str, as_of: datetime) -> None:
    """Every valid trip of the files not landed yet, once, however old its pickup is.

    What was read is known by file and time of change, never by the trips' own times: the listing is compared with the log of
    landed files, and only files that it lacks are opened, once. Rows with an impossible pickup go to the bad table. Trips
    that are stored already are left out by their content, compared within the months of the new rows only; so a file that
    comes twice, and a run that ended between its append and its log, add nothing.
    """
    spark = lake.spark
    landed = lake.read("landed_files").select(_same_file("file").alias("file"), "modified")
    listed = readers.list_files(spark, raw_path).withColumn("file", _same_file("file"))
    # Few and small rows; taken once, so that files that arrive meanwhile wait for the next run.
    names = [(r.file, r.modified) for r in listed.join(landed, ["file", "modified"], "left_anti").toLocalIterator()]
    if not names:
        return
    chosen = spark.createDataFrame(names, "file string, modified timestamp")
    raw = spark.read.schema(schemas.RAW_TRIPS).parquet(*[n for n, _ in names])
    fresh = raw.select("*", F.col("_metadata.file_path").alias("file")).withColumn("file", _same_file("file"))

    pickup = F.col("tpep_pickup_datetime")
    wrong = (pickup < C.moment(EARLIEST)) | (pickup > C.moment(as_of + timedelta(days=1)))
    stamp = C.moment(as_of)
    with lake.staged(fresh.withColumn("_wrong", F.coalesce(wrong, F.lit(False)))) as read:
        # Files that landed in a run that ended early are read again: their bad rows are known by their file. These are names out
        # of the listing above, so they are broadcast: dealt out by file, a large file would be one task's work.
        bad = read.filter("_wrong").drop("_wrong").withColumn("load_date", stamp)
        known = lake.read("bad_trips").select(_same_file("file").alias("file")).distinct().join(chosen, "file", "left_semi")
        lake.append("bad_trips", bad.join(F.broadcast(known), "file", "left_anti"))

        curated = K.conform(U.curate_trips(read.filter("NOT _wrong"), as_of), schemas.CURATED_TRIPS)
        months = curated.groupBy("year", "month").agg(F.max("pickup_datetime").alias("newest")).collect()
        stored = None
        if months and lake.exists("trips"):
            touched = F.lit(False)
            for m in months:
                touched = touched | ((F.col("year") == m["year"]) & (F.col("month") == m["month"]))
            stored = lake.read("trips").filter(touched)
        lake.append("trips", K.not_stored(curated, stored, "pickup_datetime", but=("load_date",)))
    newest = max((m["newest"] for m in months), default=None)
    if newest is not None:
        lake.append("control", K.mark_row(spark, "trips", newest, as_of))
    lake.append("landed_files", chosen.withColumn("load_date", stamp))


def land_weather(lake: Lake, raw_path: str, as_of: datetime) -> None:
    """Weather files appended as they come; repeated hours are resolved when the table is joined."""
    raw = readers.read_json_array(lake.spark, raw_path, schemas.RAW_WEATHER)
    lake.append("hourly_weather", U.curate_weather(raw, as_of))


def land_zones(lake: Lake, raw_path: str, as_of: datetime) -> None:
    """The zone reference, truncated and reloaded."""
    raw = readers.read_json_array(lake.spark, raw_path, schemas.RAW_ZONES)
    K.full_refresh(K.conform(U.curate_zones(raw, as_of), schemas.ZONES), lake.path("zones"))


# --- source tables and rollups --------------------------------------------------------------------------------------

def merge_updates(lake: Lake, updates: DataFrame, batch: int) -> int:
    """Bring a numbered batch of tip updates into `source_trips`; returns how many days were rewritten.

    Only the days that hold an updated trip are read whole and rewritten. A batch that is logged already does nothing; one that
    ended before its log is run again with the same result, and an update older than the stored row changes nothing.
    """
    done = lake.read("merged_batches").filter(F.col("table_name") == "source_trips").agg(F.max("batch")).first()[0]
    if done is not None and batch <= done:
        return 0
    _, parts = schemas.OUTPUT_TABLES["source_trips"]
    days = K.merge_partitions(
        lake.spark, lake.path("source_trips"), parts, "id", updates,
        lambda base, own: X.apply_updates(base, own, only_newer=True),
    )
    row = lake.spark.range(1).select(F.lit("source_trips").alias("table_name"), F.lit(batch).cast("bigint").alias("batch"))
    lake.append("merged_batches", row)
    return days


def vendor_rollup(lake: Lake) -> rollup.Rollup:
    """Trips, fares and distinct zones per vendor, kept by day."""
    return rollup.Rollup(
        lake.spark, lake.path("vendor_rollup"), "pickup_datetime", ("vendor_id",), sums=("passenger_count", "fare_amount"),
        means=("trip_distance", "fare_amount"), distinct=("pickup_location_id", "payment_type"),
    )


def refresh_vendor_rollup(lake: Lake, since: datetime) -> list[date]:
    """Make again the days that trips loaded after `since` fall into; returns them."""
    days = rollup.late_days(lake.read("trips"), "pickup_datetime", "load_date", since)
    if days:
        first, last = days[0], days[-1]
        midnight = datetime(first.year, first.month, first.day)
        until = datetime(last.year, last.month, last.day) + timedelta(days=1, microseconds=-1)
        vendor_rollup(lake).refresh(lake.trips(midnight, until), days)
    return days


# --- derived tables -------------------------------------------------------------------------------------------------

def refresh_daily_summary(lake: Lake, day: datetime) -> None:
    days = whole_days(day, 0)
    lake.store_days("daily_summary", A.daily_summary(lake.trips(days.since, days.until), days.first), days)


def refresh_trip_weather(lake: Lake, as_of: datetime, days: int = 1) -> None:
    d = whole_days(as_of, days)
    rows = A.trip_weather(lake.trips(d.since, d.until), lake.read("hourly_weather"), d.until, d.length)
    lake.store_days("trip_weather_correlation", U.with_load_date(rows, as_of), d)


def refresh_zone_performance(lake: Lake, as_of: datetime, days: int = 1) -> None:
    d = whole_days(as_of, days)
    rows = A.zone_performance(
        lake.trips(d.since, d.until), lake.read("hourly_weather"), lake.read("zones"), d.until, d.length
    )
    lake.store_days("zone_performance_metrics", U.with_load_date(rows, as_of), d)


def _with_history(lake: Lake, d: Days) -> DataFrame:
    """Trips of the days and of the hours before them that the longest frame reaches back to."""
    return lake.trips(d.since - timedelta(hours=M.FRAME_HOURS), d.until)


def refresh_demand_features(lake: Lake, as_of: datetime, days: int = 1, **options) -> None:
    d = whole_days(as_of, days)
    rows = M.demand_features(
        _with_history(lake, d), lake.read("hourly_weather"), lake.read("zones"), d.until, emit=d.length, **options
    )
    rows = U.with_load_date(rows, as_of).withColumn("prediction_date", F.to_date("prediction_datetime"))
    lake.store_days("demand_features_analytics", rows, d)


def refresh_demand_features_ml(lake: Lake, as_of: datetime, days: int = 1, mode: str = "rows") -> None:
    d = whole_days(as_of, days)
    rows = M.demand_features_ml(
        _with_history(lake, d), lake.read("hourly_weather"), lake.read("zones"), d.until, emit=d.length, mode=mode
    )
    lake.store_days("demand_features_ml", rows.withColumn("created_at", C.moment(as_of)), d)


def refresh_fare_features(lake: Lake, as_of: datetime, days: int = 7) -> None:
    """All days that are computed are replaced, not only the last one. Route means take a week even if fewer days are."""
    d, history = whole_days(as_of, days), whole_days(as_of, max(days, ROUTE_DAYS))
    rows = M.fare_features(
        lake.trips(history.since, d.until), lake.read("hourly_weather"), lake.read("zones"), d.until, history.length,
        emit=d.length,
    )
    lake.store_days("fare_features", rows.withColumn("created_at", C.moment(as_of)), d)


def reports(lake: Lake, as_of: datetime, days: int = 1) -> dict[str, DataFrame]:
    """The reports over the stored tables, by name."""
    d = whole_days(as_of, days)
    demand = lake.read("demand_features_ml").filter(F.col("feature_date") >= F.lit(d.first))
    return {
        "summary_by_condition": A.summary_by_condition(lake.read("trip_weather_correlation"), d.first),
        "top_zones_by_pickups": A.top_zones_by_pickups(lake.read("zone_performance_metrics"), d.first),
        "condition_demand_impact": A.condition_demand_impact(lake.read("demand_features_analytics"), d.since),
        "demand_stats": A.demand_stats(lake.read("demand_features_ml"), d.first),
        "fare_stats": A.fare_stats(lake.read("fare_features"), d.first),
        "demand_correlation": A.feature_correlation(demand, DEMAND_PAIRS, need="demand_24h_ago"),
        "monthly_load": A.monthly_load_stats(lake.read("trips")),
        "daily_weather": A.daily_weather_stats(lake.read("hourly_weather")),
        "zones_by_borough": A.zones_by_borough(lake.read("zones")),
    }
