"""Forecasts and the results the dashboards ask for."""

from __future__ import annotations

from collections.abc import Sequence

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonetide.functions import columns as C
from zonetide.functions import fixed_values as V
from zonetide.operators import filters as P
from zonetide.operators import joins as J
from zonetide.operators import ordering as T
from zonetide.operators import rollups as A


def _named(df: DataFrame, zones: DataFrame, key: str = "location_id") -> DataFrame:
    named = J.join_zone(df, zones, key, ["zone"])
    return named.withColumn("zone_name", F.coalesce("zone", F.lit(V.UNKNOWN_ZONE))).drop("zone")


def _seeded(low: float, width: float, seed: int | None, neutral: float, *keys: str) -> Column:
    """A value in [low, low + width) decided by the row's key, or the neutral value without a seed."""
    if seed is None:
        return C.num(neutral)
    part = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1_000_000)).cast("double") / 1_000_000
    return C.num(low) + part * C.num(width)


def forecast(
    trips: DataFrame,
    zones: DataFrame,
    as_of,
    hours: int = 24,
    min_n: int = 5,
    days: int | None = 30,
    seed: int | None = None,
    top: int | None = None,
    since=None,
) -> DataFrame:
    """Each active weekly pattern at each of the next hours from `since` on; with `top`, the first so many by demand.

    Without a seed demand does not depend on the hour. Then only patterns that can still be among the first, ties included,
    are repeated for the hours.

    With a seed, demand varies by 0.8-1.2 and confidence lies in 0.7-0.95, decided by the row's key so a run repeats;
    without one, demand is the historical count and confidence the middle of its range.
    """
    patterns = P.min_activity(A.weekly_pattern(trips, as_of, days), "historical_count", min_n)
    P.check_bound("hours_ahead", hours)
    if top is not None and seed is None and since is None:
        least = patterns.orderBy(F.desc("historical_count")).limit(-(-top // hours)).agg(F.min("historical_count"))
        patterns = patterns.filter(F.col("historical_count") >= least.scalar())
    rows = J.expand_hours(_named(patterns, zones), as_of, hours, since=since)
    key = ("location_id", "hour_of_day", "day_of_week", "prediction_hour")
    mix = _seeded(0.0, 1.0, seed, 1.0, F.lit("factor"), *key)
    out = rows.select(
        "location_id",
        "zone_name",
        "prediction_hour",
        "hour_of_day",
        "day_of_week",
        C.rnd(F.col("historical_count") * _seeded(0.8, 0.4, seed, 1.0, F.lit("demand"), *key), 1).alias(
            "predicted_demand"
        ),
        C.rnd(_seeded(0.7, 0.25, seed, 0.825, F.lit("confidence"), *key), 3).alias("confidence_score"),
        F.when(mix < 0.3, C.num(1.2)).when(mix < 0.44, C.num(0.8)).otherwise(C.num(1)).alias("weather_impact_factor"),
        C.rnd("historical_count", 1).alias("historical_avg"),
    )
    if top is None:
        return out
    return T.order_multi(out, T.FORECAST_ORDER).limit(top)


def forecast_seasonal(
    trips: DataFrame, zones: DataFrame, as_of, hours: int = 24, days: int = 28, min_n: int = 0
) -> DataFrame:
    """Each future hour with the mean demand of the same zone, hour of day and weekday.

    The mean is over the times that hour of the week came up in the observed interval: the last `days`, or as much of
    them as there are trips. Both tables of hours have at most 168 rows and are broadcast; a pattern meets only the hours
    it belongs to.
    """
    patterns = P.min_activity(A.weekly_pattern(trips, as_of, days), "historical_count", min_n)
    one = trips.sparkSession.range(1)
    future = J.expand_hours(one, as_of, P.check_bound("hours_ahead", hours)).select(
        "prediction_hour",
        F.hour("prediction_hour").alias("hour_of_day"),
        F.dayofweek("prediction_hour").alias("day_of_week"),
    )
    recent = P.trailing(trips, "pickup_datetime", as_of, f"{days} days")
    first = C.hour_of(recent.agg(F.min("pickup_datetime")).scalar())
    until = C.hour_of(C.moment(as_of) - C.interval("1 microsecond"))
    times = (
        one.select(F.explode(F.sequence(first, until, F.expr("INTERVAL 1 hour"))).alias("_at"))
        .groupBy(F.hour("_at").alias("hour_of_day"), F.dayofweek("_at").alias("day_of_week"))
        .agg(A.n_rows().alias("_times"))
    )
    slots = future.join(F.broadcast(times), ["hour_of_day", "day_of_week"])
    matched = patterns.join(F.broadcast(slots), ["hour_of_day", "day_of_week"])
    return _named(matched, zones).select(
        "location_id",
        "zone_name",
        "prediction_hour",
        C.rnd(F.col("historical_count") / F.col("_times"), 3).alias("predicted_demand"),
        "historical_count",
        C.rnd("avg_fare", 2).alias("avg_fare"),
    )


def weather_impact(trips: DataFrame, weather: DataFrame, start, end) -> DataFrame:
    """Day x condition: trips, mean fare, capped impact score; the condition is the hour's own."""
    t = P.positive(P.in_range(trips, "pickup_datetime", start, end), ["fare_amount"])
    hourly = t.groupBy(C.hour_of("pickup_datetime").alias("hour_timestamp")).agg(
        A.n_rows().alias("_n"), F.sum("fare_amount").alias("_fare")
    )
    seconds = (datetime.fromisoformat(str(end)) - datetime.fromisoformat(str(start))).total_seconds()
    joined = J.join_weather_hour(
        hourly, weather, "hour_timestamp", as_of=C.hour_of(C.moment(end)) + C.interval("3599 seconds"),
        length=f"{int(seconds) + 3600} seconds",
    )
    return (
        joined.groupBy(
            F.to_date("hour_timestamp").alias("trip_date"),
            F.coalesce("weather_condition", F.lit(V.UNKNOWN)).alias("weather_condition"),
        )
        .agg(
            F.sum("_n").alias("total_trips"),
            C.rnd(F.sum("_fare") / F.sum("_n"), 2).alias("avg_fare_amount"),
            C.rnd(F.avg("temperature_celsius"), 2).alias("temperature_celsius"),
            C.rnd(F.avg("humidity_percent"), 2).alias("humidity"),
        )
        .withColumn("weather_impact_score", C.rnd(C.impact_score("weather_condition", "total_trips"), 4))
        .orderBy(F.desc("trip_date"), "weather_condition")
    )


def realtime_activity(trips: DataFrame, zones: DataFrame, as_of, minutes: int = 60) -> DataFrame:
    """Zones of the last minutes by activity score."""
    recent = A.zone_activity_recent(trips, as_of, f"{P.check_bound('minutes_back', minutes)} minutes")
    return activity_report(recent, zones, as_of)


def activity_report(recent: DataFrame, zones: DataFrame, as_of) -> DataFrame:
    """Scores and names for `zone_activity_recent` rows of any interval up to `as_of`."""
    active = P.min_activity(recent, "pickup_count", 0)
    return (
        _named(active, zones, "zone_id")
        .select(
            "zone_id",
            "zone_name",
            C.moment(as_of).alias("activity_timestamp"),
            C.rnd(C.serving_activity_score("pickup_count", "revenue_last_hour"), 4).alias("activity_score"),
            "pickup_count",
            C.rnd("revenue_last_hour", 2).alias("revenue_last_hour"),
            C.rnd("avg_trip_duration", 1).alias("avg_wait_time"),
        )
        .orderBy(F.desc("activity_score"), "zone_id")
    )


def time_series(trips: DataFrame, metric: str, as_of, days: int = 7) -> DataFrame:
    """One metric per hour as (timestamp, value), with its name and unit."""
    if metric not in V.METRICS:
        raise ValueError(f"metric must be one of {sorted(V.METRICS)}")
    column = {"trip_count": "trip_count", "revenue": "total_revenue", "avg_fare": "avg_fare"}[metric]
    series = A.hourly_series(trips, as_of, days)
    return series.select(
        F.lit(metric).alias("metric_name"),
        F.lit(V.METRICS[metric]).alias("unit"),
        F.col("hour").alias("timestamp"),
        F.col(column).cast("double").alias("value"),
    )


def all_series(trips: DataFrame, as_of, days: int = 7, metrics: Sequence[str] = tuple(V.METRICS)) -> DataFrame:
    """Several metrics as `time_series` gives each, from one pass over the trips."""
    columns = {"trip_count": "trip_count", "revenue": "total_revenue", "avg_fare": "avg_fare"}
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric_name"),
                F.lit(V.METRICS[m]).alias("unit"),
                F.col("hour").alias("timestamp"),
                F.col(columns[m]).cast("double").alias("value"),
            )
            for m in metrics
        ]
    )
    return A.hourly_series(trips, as_of, days).select(F.inline(rows))


def future_rows(forecast_rows: DataFrame, as_of) -> DataFrame:
    """Forecast rows at or after a time."""
    return forecast_rows.filter(F.col("prediction_hour") >= C.moment(as_of)).select(
        "location_id", "prediction_hour", "predicted_demand", "weather_impact_factor", "confidence_score"
    )


def last_hour(activity: DataFrame, as_of, length: str = "1 hour") -> DataFrame:
    """Zone activity of the last hour by score."""
    recent = P.trailing(activity, "activity_timestamp", as_of, length)
    return recent.select(
        "zone_id", "activity_timestamp", "activity_score", "revenue_last_hour", "pickup_count"
    ).orderBy(F.desc("activity_score"), "zone_id", "activity_timestamp")
