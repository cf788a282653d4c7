"""Tumbling-window aggregates of change rows. The same functions serve batch and streaming frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonetide.functions import columns as C
from zonetide.operators import changes as X
from zonetide.operators import filters as P
from zonetide.sources import schemas


def watermarked(df: DataFrame, ts: str = "timestamp", delay: str = "10 minutes") -> DataFrame:
    """Rows more than `delay` behind the newest seen time are late and dropped from windows."""
    return df.withWatermark(ts, delay)


def trip_rows(broker: DataFrame, schema: str = schemas.TRIP_PAYLOAD, ops=("c", "u", "r")) -> DataFrame:
    """Broker rows to valid trip rows: parse, keep operations, parse the payload, filter."""
    return P.valid_changes(X.parse_payload(P.keep_ops(X.parse_envelope(broker), ops), schema))


def with_heartbeats(
    rows: DataFrame, beats: DataFrame | None, ts: str, delay: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Rows watermarked by their own times and those of `beats`, a stream of times whose rows go no further.

    A source that has gone quiet moves no watermark, so its last windows would never close: a heartbeat closes them. `keys`
    are the columns of a later join: a heartbeat has some value there, since rows without one are left out before the watermark.
    """
    if beats is None:
        return watermarked(rows, ts, delay)
    moment = F.col("timestamp")
    some = [
        (moment if kind == "timestamp" else F.lit(0)).cast(kind).alias(c) for c, kind in rows.dtypes if c in keys
    ]
    times = beats.select(moment.alias(ts), F.lit(True).alias("_beat"), *some)
    both = rows.withColumn("_beat", F.lit(False)).unionByName(times, allowMissingColumns=True)
    # The test names the time as well, else it would be moved below the watermark and heartbeats would not count.
    return watermarked(both, ts, delay).filter(~F.col("_beat") | F.col(ts).isNull()).drop("_beat")


def trip_window_aggs(rows: DataFrame, duration: str = "5 minutes", ts: str = "timestamp") -> DataFrame:
    """Trips, revenue, means and vendors per window and pickup zone.

    Vendors are counted exactly, on a stream as well: the first step has one row per window, zone and vendor, the
    second counts these.
    """
    totals = {"total_amount": "_revenue", "trip_distance": "_distance", "fare_amount": "_fare"}
    of_vendor = rows.groupBy(F.window(ts, duration).alias("window"), "pickup_location_id", "vendor_id").agg(
        F.count(F.lit(1)).alias("_trips"),
        *[F.sum(c).alias(n) for c, n in totals.items()],
        *[F.count(c).alias(f"{n}_n") for c, n in totals.items()],
    )

    def mean(name: str):
        return F.sum(name) / F.nullif(F.sum(f"{name}_n"), F.lit(0))

    grouped = of_vendor.groupBy(
        F.window(F.window_time("window"), duration).alias("window"), "pickup_location_id"
    ).agg(
        F.sum("_trips").alias("total_trips"),
        F.sum("_revenue").alias("total_revenue"),
        mean("_distance").alias("avg_trip_distance"),
        mean("_fare").alias("avg_fare_amount"),
        F.count("vendor_id").alias("unique_vendors"),
    )
    return unpack_window(grouped)


def unpack_window(grouped: DataFrame) -> DataFrame:
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col("pickup_location_id").alias("pickup_zone_id"),
        "total_trips",
        "total_revenue",
        "avg_trip_distance",
        "avg_fare_amount",
        "unique_vendors",
    )


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("processed_at", F.current_timestamp())


def zone_activity(aggs: DataFrame, dropoffs: DataFrame | None = None) -> DataFrame:
    """Window aggregates to zone activity rows; drop-offs and top destination come from `window_dropoffs` if given."""
    rows = aggs
    count, top = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    if dropoffs is not None:
        rows = aggs.join(
            dropoffs.withColumnRenamed("zone_id", "pickup_zone_id"), ["window_start", "window_end", "pickup_zone_id"],
            "left",
        )
        count, top = F.coalesce("dropoff_count", count), F.col("top_destination_zone")
    return rows.select(
        F.col("pickup_zone_id").alias("zone_id"),
        F.col("window_end").alias("activity_timestamp"),
        F.col("total_trips").alias("pickup_count"),
        count.alias("dropoff_count"),
        F.col("total_revenue").alias("revenue_last_hour"),
        F.col("avg_fare_amount").alias("avg_fare_last_hour"),
        top.alias("top_destination_zone"),
        C.stream_activity_score("total_trips", "total_revenue", "unique_vendors").alias("activity_score"),
    )


def window_dropoffs(rows: DataFrame, duration: str = "5 minutes", ts: str = "timestamp") -> DataFrame:
    """Per window and zone: drop-offs in the zone and the top destination of its pickups (smaller id on a tie).

    Trips are counted per route and window first, so the second step sees one row per route however busy it is.
    """
    # The window itself stays a column, so that on a stream the second step knows the rows' time and closes as the first.
    routes = rows.groupBy(F.window(ts, duration).alias("window"), "pickup_location_id", "dropoff_location_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    # Each route row gives one row to its pickup zone (a destination) and one to its drop-off zone (an arrival).
    sides = routes.select(
        "window",
        F.explode(
            F.array(
                F.struct(
                    F.col("pickup_location_id").alias("zone_id"),
                    F.lit(0).cast("bigint").alias("arrivals"),
                    F.col("dropoff_location_id").alias("destination"),
                    F.col("n").alias("weight"),
                ),
                F.struct(
                    F.col("dropoff_location_id").alias("zone_id"),
                    F.col("n").alias("arrivals"),
                    F.lit(None).cast("bigint").alias("destination"),
                    F.lit(None).cast("bigint").alias("weight"),
                ),
            )
        ).alias("_s"),
    ).select("window", "_s.*")
    best = F.max_by("destination", F.when(F.col("destination").isNotNull(), F.struct("weight", -F.col("destination"))))
    return (
        sides.filter(F.col("zone_id").isNotNull())
        .groupBy(F.window(F.window_time("window"), duration).alias("window"), "zone_id")
        .agg(F.sum("arrivals").alias("dropoff_count"), best.alias("top_destination_zone"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "zone_id",
            "dropoff_count",
            "top_destination_zone",
        )
    )
