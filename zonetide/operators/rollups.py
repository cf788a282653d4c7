"""Aggregations. Each is a partial + final hash aggregate; dimensions are joined after the rollup, not before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonetide.functions import bitmaps
from zonetide.functions import columns as C
from zonetide.functions import fixed_values as V
from zonetide.operators import filters as P
from zonetide.operators import joins as J


def n_rows() -> Column:
    return F.count(F.lit(1))


def _mean(c: str | Column, name: str) -> Column:
    return F.avg(c).alias(name)


# --- hourly conditions ----------------------------------------------------------------------------------------------

def trip_weather(trips: DataFrame, weather: DataFrame, as_of, length: str | None = "1 day") -> DataFrame:
    """Trips per hour with the hour's weather.

    There is one weather row per hour, so the trips are rolled up first and the join sees one row per hour: the means
    of the weather columns over the trips of an hour are the hour's own values.
    """
    t = P.trailing(trips, "pickup_datetime", as_of, length)
    hourly = (
        t.groupBy(F.to_date("pickup_datetime").alias("trip_date"), F.hour("pickup_datetime").alias("hour"))
        .agg(
            n_rows().alias("total_trips"),
            _mean("trip_distance", "avg_trip_distance"),
            _mean("fare_amount", "avg_fare_amount"),
            _mean("tip_amount", "avg_tip_amount"),
            _mean(C.minutes_between("pickup_datetime", "dropoff_datetime"), "avg_trip_duration_minutes"),
            F.countDistinct("pickup_location_id").cast("int").alias("pickup_zone_diversity"),
        )
    )
    joined = J.join_weather_parts(hourly, weather, as_of=as_of, length=length)
    return joined.select(
        "trip_date",
        "hour",
        F.coalesce("weather_condition", F.lit(V.UNKNOWN)).alias("weather_condition"),
        "temperature_celsius",
        "humidity_percent",
        "wind_speed_kmh",
        "total_trips",
        "avg_trip_distance",
        "avg_fare_amount",
        "avg_tip_amount",
        "avg_trip_duration_minutes",
        "pickup_zone_diversity",
        F.year("trip_date").alias("year"),
        F.month("trip_date").alias("month"),
        F.dayofmonth("trip_date").alias("day"),
    )


def pickup_metrics(trips: DataFrame, weather: DataFrame, as_of, length: str | None = "1 day") -> DataFrame:
    """Zone x date x hour x condition: pickups, mean fare, tip share and distance."""
    rolled = P.trailing(trips, "pickup_datetime", as_of, length).groupBy(
        F.col("pickup_location_id").alias("location_id"),
        F.to_date("pickup_datetime").alias("trip_date"),
        F.hour("pickup_datetime").alias("hour"),
    ).agg(
        n_rows().alias("total_pickups"),
        _mean("fare_amount", "avg_fare_per_pickup"),
        _mean(C.tip_pct("tip_amount", "fare_amount"), "avg_tip_percentage"),
        _mean("trip_distance", "avg_trip_distance"),
    )
    joined = J.join_weather_parts(rolled, weather, as_of=as_of, length=length)
    return joined.select(
        "location_id",
        "trip_date",
        "hour",
        F.coalesce("weather_condition", F.lit(V.UNKNOWN)).alias("weather_condition"),
        "total_pickups",
        "avg_fare_per_pickup",
        "avg_tip_percentage",
        "avg_trip_distance",
    )


def dropoff_metrics(trips: DataFrame) -> DataFrame:
    """Drop-offs per zone, by the date and hour of the pickup."""
    return trips.groupBy(
        F.col("dropoff_location_id").alias("location_id"),
        F.to_date("pickup_datetime").alias("trip_date"),
        F.hour("pickup_datetime").alias("hour"),
    ).agg(n_rows().alias("total_dropoffs"))


def zone_day_stats(pickups: DataFrame) -> DataFrame:
    """Mean and maximum hourly pickups of a zone-day: an aggregate of an aggregate."""
    return pickups.groupBy("location_id", "trip_date").agg(
        _mean("total_pickups", "avg_hourly_pickups"), F.max("total_pickups").alias("max_hourly_pickups")
    )


def zone_performance(trips, weather, zones, as_of, length: str | None = "1 day") -> DataFrame:
    """Zone-hours with pickups, drop-offs, peak factor and weather score; zones outside the dimension are left out.

    The zone-day mean is a window over the rollup (at most 24 rows per zone-day), which saves a second aggregate and a
    join of the rollup with itself.
    """
    pickups = pickup_metrics(trips, weather, as_of, length)
    both = J.join_pick_drop(pickups, dropoff_metrics(P.trailing(trips, "pickup_datetime", as_of, length)))
    day = Window.partitionBy("location_id", "trip_date")
    with_mean = both.withColumn("_mean", F.avg("total_pickups").over(day))
    named = J.join_zone(
        with_mean,
        zones,
        "location_id",
        ["zone", "borough", "zone_type", "is_tourist_area", "is_business_district"],
        how="inner",
    )
    return named.select(
        "location_id",
        F.col("zone").alias("zone_name"),
        "borough",
        "zone_type",
        "is_tourist_area",
        "is_business_district",
        "trip_date",
        "hour",
        "weather_condition",
        "total_pickups",
        "total_dropoffs",
        "avg_fare_per_pickup",
        "avg_tip_percentage",
        "avg_trip_distance",
        C.peak_factor("total_pickups", "_mean").alias("peak_hour_factor"),
        C.zone_weather_score("weather_condition").alias("weather_impact_score"),
        F.year("trip_date").alias("year"),
        F.month("trip_date").alias("month"),
    )


def hourly_demand(trips: DataFrame) -> DataFrame:
    """Trips per pickup zone and hour."""
    return trips.groupBy(
        F.col("pickup_location_id").alias("location_id"), C.hour_of("pickup_datetime").alias("hour_timestamp")
    ).agg(n_rows().alias("demand_count"))


# --- calendar rollups -----------------------------------------------------------------------------------------------

def daily_summary(trips: DataFrame, day=None) -> DataFrame:
    """Day rollup of curated trips; one day, or every day when none is given."""
    t = trips if day is None else P.on_day(trips, "pickup_datetime", day)
    stamp = [F.max("load_date").alias("last_updated")] if "load_date" in trips.columns else []
    rolled = t.groupBy(F.to_date("pickup_datetime").alias("trip_date")).agg(
        n_rows().alias("total_trips"),
        F.sum("passenger_count").alias("total_passengers"),
        _mean("trip_distance", "avg_trip_distance"),
        _mean("fare_amount", "avg_fare_amount"),
        _mean("tip_amount", "avg_tip_amount"),
        _mean("total_amount", "avg_total_amount"),
        *stamp,
    )
    return rolled.withColumns({"year": F.year("trip_date"), "month": F.month("trip_date")})


def monthly_load_stats(trips: DataFrame, since=None) -> DataFrame:
    """Trips and means per month of the rows loaded since a time, newest month first."""
    t = trips if since is None else trips.filter(F.col("load_date") >= C.moment(since))
    return (
        t.groupBy(F.year("pickup_datetime").alias("year"), F.month("pickup_datetime").alias("month"))
        .agg(n_rows().alias("trip_count"), _mean("trip_distance", "avg_distance"), _mean("total_amount", "avg_amount"))
        .orderBy(F.desc("year"), F.desc("month"))
    )


def daily_weather_stats(weather: DataFrame, since=None) -> DataFrame:
    """Weather means per day and the set of its conditions, newest day first."""
    w = weather if since is None else weather.filter(F.col("load_date") >= C.moment(since))
    return (
        w.groupBy(F.to_date("timestamp").alias("weather_date"))
        .agg(
            _mean("temperature_celsius", "avg_temp_c"),
            _mean("humidity_percent", "avg_humidity"),
            _mean("wind_speed_kmh", "avg_wind_speed"),
            F.array_sort(F.collect_set("weather_condition")).alias("conditions"),
        )
        .orderBy(F.desc("weather_date"))
    )


def zones_by_borough(zones: DataFrame) -> DataFrame:
    return (
        zones.groupBy("borough")
        .agg(
            n_rows().alias("zone_count"),
            F.count_if("is_tourist_area").alias("tourist_zones"),
            F.count_if("is_business_district").alias("business_zones"),
        )
        .orderBy(F.desc("zone_count"), "borough")
    )


def trip_summary(trips: DataFrame) -> DataFrame:
    return (
        trips.groupBy(C.hour_of("pickup_datetime").alias("hour"))
        .agg(
            n_rows().alias("trip_count"),
            _mean("trip_distance", "avg_distance"),
            _mean("fare_amount", "avg_fare"),
            _mean("passenger_count", "avg_passengers"),
        )
        .orderBy("hour")
    )


def hourly_vendor_stats(trips: DataFrame) -> DataFrame:
    return (
        trips.groupBy(C.hour_of("pickup_datetime").alias("hour"), "vendor_id")
        .agg(
            n_rows().alias("trip_count"),
            F.sum("passenger_count").alias("total_passengers"),
            _mean("trip_distance", "avg_distance"),
            F.sum("fare_amount").alias("total_fare"),
            _mean("fare_amount", "avg_fare"),
            F.countDistinct("payment_type").alias("payment_types_used"),
        )
        .orderBy(F.desc("hour"), "vendor_id")
    )


# --- reports over derived tables ------------------------------------------------------------------------------------

def summary_by_condition(hourly: DataFrame, since=None) -> DataFrame:
    """Report over `trip_weather` rows."""
    rows = hourly if since is None else hourly.filter(F.col("trip_date") >= F.lit(since).cast("date"))
    return (
        rows.groupBy("weather_condition")
        .agg(
            n_rows().alias("hours_count"),
            _mean("total_trips", "avg_trips_per_hour"),
            _mean("avg_trip_distance", "avg_distance"),
            _mean("avg_fare_amount", "avg_fare"),
        )
        .orderBy(F.desc("avg_trips_per_hour"), "weather_condition")
    )


def top_zones_by_pickups(performance: DataFrame, since=None, n: int = 10) -> DataFrame:
    rows = performance if since is None else performance.filter(F.col("trip_date") >= F.lit(since).cast("date"))
    return (
        rows.groupBy("zone_name", "borough")
        .agg(
            F.sum("total_pickups").alias("total_pickups"),
            _mean("avg_fare_per_pickup", "avg_fare"),
            _mean("peak_hour_factor", "avg_peak_factor"),
        )
        .orderBy(F.desc("total_pickups"), "zone_name")
        .limit(n)
    )


def condition_demand_impact(features: DataFrame, since=None) -> DataFrame:
    rows = features if since is None else features.filter(F.col("prediction_datetime") >= C.moment(since))
    return (
        rows.groupBy("weather_condition")
        .agg(
            _mean("weather_impact_factor", "avg_impact_factor"),
            F.countDistinct("location_id").alias("zones_affected"),
            _mean("rolling_avg_demand_7d", "avg_weekly_demand"),
        )
        .orderBy(F.desc("avg_impact_factor"), "weather_condition")
    )


def demand_stats(features: DataFrame, since=None) -> DataFrame:
    rows = features if since is None else features.filter(F.col("feature_date") >= F.lit(since).cast("date"))
    return rows.agg(
        n_rows().alias("total_rows"),
        F.countDistinct("location_id").alias("unique_locations"),
        _mean("target_demand", "avg_demand"),
        F.stddev("target_demand").alias("stddev_demand"),
        F.min("prediction_hour").alias("earliest_hour"),
        F.max("prediction_hour").alias("latest_hour"),
    )


def fare_stats(features: DataFrame, since=None) -> DataFrame:
    """One row of figures over all trips.

    Trips are added up per route first. Zones are counted by bitmaps over the routes, so no copy of a trip is made for a count.
    """
    rows = features if since is None else features.filter(F.col("feature_date") >= F.lit(since).cast("date"))
    means = {"fare_amount": "avg_fare", "trip_distance": "avg_distance", "trip_duration_minutes": "avg_duration"}
    sides = {"pickup_zone_id": "unique_pickup_zones", "dropoff_zone_id": "unique_dropoff_zones"}
    figures = ["_rows", "_spread", *[f"{c}_sum" for c in means], *[f"{c}_n" for c in means]]
    routes = rows.groupBy(*sides).agg(
        n_rows().alias("_rows"),
        # Squared distances from the route's own mean, and of that mean from nought: they add up over routes.
        (F.var_pop("fare_amount") * F.count("fare_amount") + F.count("fare_amount") * F.pow(F.avg("fare_amount"), 2)).alias("_spread"),
        *[F.sum(c).alias(f"{c}_sum") for c in means],
        *[F.count(c).alias(f"{c}_n") for c in means],
    )
    # A row for each pair of value ranges, which is one row up to 32,768 zones.
    ranges = routes.groupBy(*[bitmaps.bucket(c).alias(f"{c}_bucket") for c in sides]).agg(
        *[F.sum(c).alias(c) for c in figures], *[bitmaps.bits(c).alias(f"{c}_bits") for c in sides]
    )
    parts = ranges.select(
        F.explode(
            F.array(
                F.struct(*[F.col(c) for c in figures], F.lit(None).cast("string").alias("side"),
                         F.lit(None).cast("bigint").alias("bucket"), F.lit(None).cast("binary").alias("bits")),
                *[
                    F.struct(*[F.lit(None).cast(routes.schema[c].dataType).alias(c) for c in figures], F.lit(c).alias("side"),
                             F.col(f"{c}_bucket").alias("bucket"), F.col(f"{c}_bits").alias("bits"))
                    for c in sides
                ],
            )
        ).alias("p")
    ).select("p.*")
    merged = parts.groupBy("side", "bucket").agg(*[F.sum(c).alias(c) for c in figures], F.bitmap_or_agg("bits").alias("bits"))
    n, total = F.sum("fare_amount_n"), F.sum("fare_amount_sum")
    spread = F.greatest(F.sum("_spread") - total * total / F.nullif(n, F.lit(0)), F.lit(0.0))
    zones = {
        name: F.coalesce(F.sum(F.when((F.col("side") == c) & F.col("bucket").isNotNull(), F.bitmap_count("bits"))), F.lit(0))
        for c, name in sides.items()
    }
    mean = {c: F.sum(f"{c}_sum") / F.nullif(F.sum(f"{c}_n"), F.lit(0)) for c in means}
    return merged.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_trips"),
        mean["fare_amount"].alias("avg_fare"),
        F.when(n > 1, F.sqrt(spread / (n - 1))).alias("stddev_fare"),
        mean["trip_distance"].alias("avg_distance"),
        mean["trip_duration_minutes"].alias("avg_duration"),
        *[c.alias(name) for name, c in zones.items()],
    )


def feature_correlation(features: DataFrame, pairs: dict[str, tuple[str, str]], need: str | None = None) -> DataFrame:
    """Pearson correlation per named pair; `need` is the raw column that must be present."""
    rows = features if need is None else features.filter(F.col(need).isNotNull())
    return rows.agg(*[F.corr(a, b).alias(name) for name, (a, b) in pairs.items()])


def zone_revenue_rank(performance: DataFrame, since=None) -> DataFrame:
    rows = performance if since is None else performance.filter(F.col("trip_date") >= F.lit(since).cast("date"))
    return (
        rows.groupBy("zone_name", "borough")
        .agg(
            F.sum(F.col("total_pickups") * F.col("avg_fare_per_pickup")).alias("total_revenue"),
            _mean("peak_hour_factor", "avg_peak_factor"),
            _mean("weather_impact_score", "weather_sensitivity"),
        )
        .orderBy(F.desc("total_revenue"), "zone_name")
    )


def condition_corr(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("weather_condition").agg(
        _mean("total_trips", "avg_trips"),
        _mean("avg_fare_amount", "avg_fare"),
        F.corr("temperature_celsius", "total_trips").alias("temp_correlation"),
    )


# --- fares ----------------------------------------------------------------------------------------------------------

def route_history(trips: DataFrame) -> DataFrame:
    return trips.groupBy("pickup_location_id", "dropoff_location_id").agg(
        _mean("fare_amount", "avg_fare_same_route_7d"), n_rows().alias("route_frequency")
    )


def zone_hour_surge(trips: DataFrame) -> DataFrame:
    """Zone-hours with mean fare, trips and surge against the zone's mean hourly trips.

    The window runs over the rollup: a zone's partition is bounded by the hours in range, not by its trips.
    """
    hourly = trips.groupBy("pickup_location_id", C.hour_of("pickup_datetime").alias("hour_timestamp")).agg(
        _mean("fare_amount", "avg_fare_pickup_zone_1h"), n_rows().alias("trips_in_hour")
    )
    zone_mean = F.avg("trips_in_hour").over(Window.partitionBy("pickup_location_id"))
    return hourly.withColumn("surge_factor", C.surge_factor("trips_in_hour", zone_mean))


# --- serving --------------------------------------------------------------------------------------------------------

def zone_metrics(trips, zones, start, end, limit: int | None = None) -> DataFrame:
    """Zones in a date range by revenue, with the share of trips in the evening rush."""
    zone_id = C.first_of("pickup_location_id", "dropoff_location_id")
    stats = (
        P.positive(P.in_range(trips, "pickup_datetime", start, end), ["fare_amount"])
        .filter(zone_id.isNotNull())
        .groupBy(zone_id.alias("zone_id"))
        .agg(
            n_rows().alias("total_trips"),
            _mean("fare_amount", "_fare"),
            F.sum("total_amount").alias("_revenue"),
            _mean("trip_distance", "_distance"),
            F.count_if(C.is_evening_rush("pickup_datetime")).alias("_peak"),
        )
    )
    named = J.join_zone(stats, zones, "zone_id", ["zone", "borough"])
    out = named.select(
        "zone_id",
        F.coalesce("zone", F.lit(V.UNKNOWN_ZONE)).alias("zone_name"),
        F.coalesce("borough", F.lit(V.UNKNOWN_NAME)).alias("borough"),
        "total_trips",
        C.rnd("_fare", 2).alias("avg_fare"),
        C.rnd("_revenue", 2).alias("total_revenue"),
        C.rnd("_distance", 2).alias("avg_distance"),
        C.rnd(C.share_pct("_peak", "total_trips"), 2).alias("peak_hour_factor"),
    ).orderBy(F.desc("total_revenue"), "zone_id")
    return out if limit is None else out.limit(P.check_bound("zone_limit", limit))


def hourly_series(trips: DataFrame, as_of, days: int = 7) -> DataFrame:
    t = P.trailing(trips, "pickup_datetime", as_of, f"{P.check_bound('days_back', days)} days")
    return (
        P.positive(t, ["fare_amount"])
        .groupBy(C.hour_of("pickup_datetime").alias("hour"))
        .agg(n_rows().alias("trip_count"), _mean("fare_amount", "avg_fare"), F.sum("total_amount").alias("total_revenue"))
        .orderBy("hour")
    )


def daily_time_category(trips: DataFrame, start, end) -> DataFrame:
    """Trips and mean fare per day and time category."""
    t = P.positive(P.in_range(trips, "pickup_datetime", start, end), ["fare_amount"])
    return (
        t.groupBy(
            F.to_date("pickup_datetime").alias("trip_date"), C.time_category("pickup_datetime").alias("time_category")
        )
        .agg(n_rows().alias("total_trips"), _mean("fare_amount", "avg_fare"))
        .orderBy(F.desc("trip_date"), "time_category")
    )


def weekly_pattern(trips: DataFrame, as_of, days: int | None = 30) -> DataFrame:
    """Zone x hour of day x weekday: trips and mean fare."""
    t = P.trailing(trips, "pickup_datetime", as_of, None if days is None else f"{days} days")
    return (
        P.positive(t, ["fare_amount"])
        .filter(F.col("pickup_location_id").isNotNull())
        .groupBy(
            F.col("pickup_location_id").alias("location_id"),
            F.hour("pickup_datetime").alias("hour_of_day"),
            F.dayofweek("pickup_datetime").alias("day_of_week"),
        )
        .agg(n_rows().alias("historical_count"), _mean("fare_amount", "avg_fare"))
    )


def zone_activity_recent(trips: DataFrame, as_of, length: str = "60 minutes") -> DataFrame:
    t = P.positive(P.trailing(trips, "pickup_datetime", as_of, length), ["fare_amount"])
    return (
        t.filter(F.col("pickup_location_id").isNotNull() & F.col("dropoff_datetime").isNotNull())
        .groupBy(F.col("pickup_location_id").alias("zone_id"))
        .agg(
            n_rows().alias("pickup_count"),
            F.sum("total_amount").alias("revenue_last_hour"),
            _mean(C.minutes_between("pickup_datetime", "dropoff_datetime"), "avg_trip_duration"),
        )
    )


def kpi_day(trips: DataFrame, day) -> DataFrame:
    """One row for a day: trips, revenue, mean fare, active zones; zeros for an empty day."""
    t = P.positive(P.on_day(trips, "pickup_datetime", day), ["fare_amount"])
    return t.agg(
        n_rows().alias("total_trips"),
        F.coalesce(F.sum("total_amount"), C.num(0)).alias("total_revenue"),
        F.coalesce(F.avg("fare_amount"), C.num(0)).alias("avg_fare"),
        F.countDistinct("pickup_location_id").alias("active_zones"),
    )


def peak_hour(trips: DataFrame, day) -> DataFrame:
    """The hour of day with most trips as `H:00`, the earlier one on a tie; `N/A` for an empty day."""
    hours = P.on_day(trips, "pickup_datetime", day).groupBy(F.hour("pickup_datetime").alias("h")).agg(n_rows().alias("n"))
    best = F.max_by("h", F.struct("n", -F.col("h")))
    return hours.agg(F.coalesce(C.hour_label(best), F.lit("N/A")).alias("peak_hour"))


def top_zones_day(trips: DataFrame, zones: DataFrame, day, n: int = 5) -> DataFrame:
    """Zones of a day by revenue; trips of unknown zones share one name."""
    t = P.positive(P.on_day(trips, "pickup_datetime", day), ["fare_amount"])
    by_zone = t.groupBy(F.col("pickup_location_id").alias("location_id")).agg(
        n_rows().alias("_n"), F.sum("total_amount").alias("_revenue")
    )
    named = J.join_zone(by_zone, zones, "location_id", ["zone"])
    return (
        named.groupBy(F.coalesce("zone", F.lit(V.UNKNOWN_NAME)).alias("zone_name"))
        .agg(F.sum("_n").alias("trips"), F.sum("_revenue").alias("revenue"))
        .orderBy(F.desc("revenue"), "zone_name")
        .limit(n)
    )


def dataset_means(df: DataFrame, fare="fare_amount", distance="trip_distance") -> DataFrame:
    return df.agg(n_rows().alias("total_trips"), _mean(fare, "avg_fare"), _mean(distance, "avg_distance"))


def op_distribution(changes: DataFrame, op_col: str = "op") -> DataFrame:
    return changes.groupBy(op_col).agg(n_rows().alias("cnt")).orderBy(F.desc("cnt"), op_col)


def daily_mean(series: DataFrame, ts_col: str = "timestamp", value_col: str = "value", last_days: int = 5) -> DataFrame:
    """Mean of an hourly series per day, the last days only, oldest first."""
    days = series.groupBy(F.to_date(ts_col).alias("day")).agg(_mean(value_col, "mean_value"))
    return days.orderBy(F.desc("day")).limit(last_days).orderBy("day")


def dashboard_stats(trips: DataFrame, zones: DataFrame, day) -> DataFrame:
    """The day's figures, peak hour and top zones as one record; the parts are scalar subqueries."""
    top = top_zones_day(trips, zones, day)
    ranked = F.sort_array(F.collect_list(F.struct("revenue", "zone_name", "trips")), asc=False)
    nested = top.agg(ranked.alias("top_zones")).scalar()
    return kpi_day(trips, day).withColumns(
        {"peak_hour": peak_hour(trips, day).scalar(), "top_zones": nested}
    )
