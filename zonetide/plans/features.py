"""Feature tables for demand and fare models.

Windows run over the history and the emitted interval is cut out afterwards, so lags and long means see the rows before it.
Unless said otherwise the history is the emitted interval and the longest frame before it, from a full hour on. With
`mode="grid"` idle hours are filled first, so offsets are clock hours and every frame is whole. With `mode="rows"` offsets
count hours that have trips: a zone with idle hours gets those of its last rows that lie in the history, and needs a longer
`history` to fill a frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonetide.functions import columns as C
from zonetide.functions import fixed_values as V
from zonetide.operators import filters as P
from zonetide.operators import joins as J
from zonetide.operators import rollups as A
from zonetide.operators import windows as W

ROLLING = {
    "rolling_avg_7d": ("avg", V.WEEK_HOURS),
    "rolling_avg_30d": ("avg", V.MONTH_HOURS),
    "rolling_std_7d": ("stddev", V.WEEK_HOURS),
}


#: The longest frame, and the hour that the first emitted row stands in.
FRAME_HOURS = V.MONTH_HOURS + 1
FRAMES = "frames"


def history_for(history: str | None, emit: str | None) -> str | None:
    """The history to read: as given, or what the frames of the first emitted row reach back to."""
    if history != FRAMES:
        return history
    return None if emit is None else f"{J.hours_in(emit) + FRAME_HOURS} hours"


def demand_history(trips: DataFrame, as_of, history: str | None, mode: str = "rows", grid_start=None) -> DataFrame:
    """Zone-hour demand from a full hour on up to the hour of `as_of`; in grid mode from `grid_start` on, idle hours included.

    That last hour counts whole, whatever the minute of `as_of`: a part of it would be a wrong target, lag and mean.
    """
    recent = trips.filter(F.col("pickup_datetime") < C.hour_of(C.moment(as_of)) + C.interval("1 hour"))
    if history is not None:
        recent = recent.filter(F.col("pickup_datetime") >= C.hour_of(C.moment(as_of) - C.interval(history)))
    demand = A.hourly_demand(recent)
    if mode == "rows":
        return demand
    if mode != "grid":
        raise ValueError(f"unknown mode: {mode}")
    if grid_start is None and history is None:
        raise ValueError("a grid needs a start: give grid_start or history")
    until = C.hour_of(C.moment(as_of))
    start = C.moment(grid_start) if grid_start is not None else C.hour_of(C.moment(as_of) - C.interval(history))
    return W.demand_grid(demand, start, until)


def demand_features(
    trips: DataFrame,
    weather: DataFrame,
    zones: DataFrame,
    as_of,
    history: str | None = FRAMES,
    emit: str | None = "1 day",
    mode: str = "rows",
    holidays: DataFrame | None = None,
    events: DataFrame | None = None,
    nearby_km: float | None = None,
    grid_start=None,
) -> DataFrame:
    """Demand features of a zone-hour for analytics.

    `holidays` (column `day`) and `events` (columns `day`, `event_factor`) are optional calendars with one row per
    day; without them no day is a holiday and the event factor is 1. `nearby_km` turns the zone's own demand into the
    demand of the zones around it.
    """
    history = history_for(history, emit)
    demand = demand_history(trips, as_of, history, mode, grid_start)
    rolled = W.add_rolling(
        W.add_lags(demand, (1, 24, 168)),
        {
            "rolling_avg_demand_7d": ("avg", V.WEEK_HOURS),
            "rolling_avg_demand_30d": ("avg", V.MONTH_HOURS),
        },
    )
    rows = P.trailing(rolled, "hour_timestamp", as_of, emit)
    rows = J.join_weather_hour(
        rows, weather, "hour_timestamp", ("temperature_celsius", "weather_condition"), as_of, history
    )
    rows = J.join_zone(rows, zones, "location_id", ["zone_type", "is_tourist_area", "is_business_district"])
    if nearby_km is None:
        nearby = F.col("demand_count")
    else:
        around = J.nearby_demand(demand, zones, nearby_km).drop("demand_count")
        rows = rows.join(around, ["location_id", "hour_timestamp"], "left")
        nearby = F.col("nearby_zones_demand")
    holiday, factor = F.lit(False), C.num(1)
    rows = rows.withColumn("_day", F.to_date("hour_timestamp"))
    if holidays is not None:
        rows = J.lookup_join(rows, holidays.select(F.col("day").alias("_day"), F.lit(True).alias("_hol")), ["_day"])
        holiday = F.coalesce("_hol", F.lit(False))
    if events is not None:
        factors = events.select(F.col("day").alias("_day"), F.col("event_factor").alias("_f"))
        rows = J.lookup_join(rows, factors, ["_day"])
        factor = F.coalesce("_f", C.num(1))
    parts = C.date_parts("hour_timestamp")
    return rows.select(
        "location_id",
        F.col("hour_timestamp").alias("prediction_datetime"),
        parts["hour"].alias("hour"),
        parts["day_of_week"].alias("day_of_week"),
        C.is_weekend("hour_timestamp").alias("is_weekend"),
        holiday.alias("is_holiday"),
        "temperature_celsius",
        F.coalesce("weather_condition", F.lit(V.UNKNOWN)).alias("weather_condition"),
        F.col("lag_1").alias("historical_demand_1h_ago"),
        F.col("lag_24").alias("historical_demand_24h_ago"),
        F.col("lag_168").alias("historical_demand_168h_ago"),
        "rolling_avg_demand_7d",
        "rolling_avg_demand_30d",
        "zone_type",
        "is_tourist_area",
        "is_business_district",
        nearby.alias("nearby_zones_demand"),
        C.demand_weather_factor("weather_condition", "temperature_celsius").alias("weather_impact_factor"),
        factor.alias("event_factor"),
        parts["year"].alias("year"),
        parts["month"].alias("month"),
    )


def demand_features_ml(
    trips: DataFrame,
    weather: DataFrame,
    zones: DataFrame,
    as_of,
    history: str | None = FRAMES,
    emit: str | None = "1 day",
    mode: str = "rows",
    grid_start=None,
    raw_lags: bool = False,
) -> DataFrame:
    """Demand features of a zone-hour for model training; `raw_lags` adds the day lag before its default.

    Lags, frames and the popularity join all work on the rollup partitioned by zone, so the rollup is shuffled once.
    """
    history = history_for(history, emit)
    demand = demand_history(trips, as_of, history, mode, grid_start)
    lagged = W.add_rolling(W.add_lags(demand), ROLLING)
    popular = W.zone_popularity(demand).select("location_id", "popularity_decile")
    rows = P.trailing(lagged, "hour_timestamp", as_of, emit).join(popular, "location_id", "left")
    w = weather.withColumn("condition_code", C.condition_code("weather_condition", 0))
    rows = J.join_weather_hour(
        rows,
        w,
        "hour_timestamp",
        ("temperature_celsius", "humidity_percent", "wind_speed_kmh", "condition_code"),
        as_of,
        history,
    )
    z = zones.withColumn("zone_type_encoded", C.zone_type_code("zone_type"))
    rows = J.join_zone(rows, z, "location_id", ["zone_type_encoded", "is_tourist_area", "is_business_district"])

    parts = C.date_parts("hour_timestamp")
    weekend = C.is_weekend("hour_timestamp")
    weekend_no = C.flag_double(weekend)
    temperature = F.coalesce("temperature_celsius", C.num(V.DEFAULT_TEMPERATURE))
    code = F.coalesce("condition_code", C.num(V.DEFAULT_CONDITION_CODE))
    tourist = C.flag("is_tourist_area")

    def lag(k: int):
        return F.coalesce(f"lag_{k}", F.lit(0).cast("bigint"))

    extra = [F.col("lag_24").alias("raw_lag_24")] if raw_lags else []
    return rows.select(
        "location_id",
        F.col("hour_timestamp").alias("prediction_hour"),
        F.col("demand_count").alias("target_demand"),
        parts["hour"].alias("hour_of_day"),
        parts["day_of_week"].alias("day_of_week"),
        parts["day"].alias("day_of_month"),
        parts["month"].alias("month"),
        weekend.alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        temperature.alias("temperature_celsius"),
        F.coalesce("humidity_percent", C.num(V.DEFAULT_HUMIDITY)).alias("humidity_percent"),
        F.coalesce("wind_speed_kmh", C.num(V.DEFAULT_WIND)).alias("wind_speed_kmh"),
        code.alias("weather_condition_encoded"),
        lag(1).alias("demand_1h_ago"),
        lag(24).alias("demand_24h_ago"),
        lag(168).alias("demand_168h_ago"),
        F.coalesce("rolling_avg_7d", C.num(0)).alias("rolling_avg_7d"),
        F.coalesce("rolling_avg_30d", C.num(0)).alias("rolling_avg_30d"),
        F.coalesce("rolling_std_7d", C.num(V.DEFAULT_STDDEV)).alias("rolling_std_7d"),
        "zone_type_encoded",
        tourist.alias("is_tourist_area_flag"),
        C.flag("is_business_district").alias("is_business_district_flag"),
        F.coalesce(F.col("popularity_decile").cast("double"), C.num(V.DEFAULT_POPULARITY)).alias(
            "zone_popularity_score"
        ),
        (temperature * parts["hour"]).alias("temp_hour_interaction"),
        (code * weekend_no).alias("weather_weekend_interaction"),
        (tourist * weekend_no).alias("tourist_weekend_interaction"),
        lag(2).alias("demand_lag_2h"),
        lag(3).alias("demand_lag_3h"),
        lag(168).alias("demand_same_hour_last_week"),
        parts["date"].alias("feature_date"),
        *extra,
    )


def fare_features(
    trips: DataFrame,
    weather: DataFrame,
    zones: DataFrame,
    as_of,
    length: str | None = "7 days",
    max_zones: int | None = None,
    emit: str | None = None,
) -> DataFrame:
    """Fare features of a trip between two known zones: of the trips of `emit` before `as_of`, or of all.

    Route and zone-hour means include the trip itself and all fares, valid or not, as the model's contract has it:
    knowingly a leak of the target.

    Both statistics are looked up only for known zones, so their rows are bounded by zones^2 and zones x hours. A caller that
    knows `max_zones` gets broadcasts where these bounds are small, and the trips are not shuffled at all; otherwise the
    lookup is shuffled so that hot routes and zone-hours can be split.
    """
    recent = P.trailing(trips, "pickup_datetime", as_of, length)
    keys = zones.select("location_id")
    keys = F.broadcast(keys) if J.fits(keys, max_zones) else keys
    hours = None if length is None else J.hours_in(length)

    def known(df: DataFrame, column: str) -> DataFrame:
        return df.join(keys.withColumnRenamed("location_id", column), column, "left_semi")

    routes = known(known(A.route_history(recent), "pickup_location_id"), "dropoff_location_id").drop("route_frequency")
    surges = known(A.zone_hour_surge(recent), "pickup_location_id").drop("trips_in_hour")
    bounds = [max_zones and max_zones**2, max_zones and hours and max_zones * hours]

    place = zones.withColumn("code", C.borough_code("borough"))
    t = P.positive(recent, ["fare_amount", "trip_distance"])
    t = t if emit is None else P.trailing(t, "pickup_datetime", as_of, emit)
    t = J.join_both_zones(t, place, ["borough", "zone_type", "latitude", "longitude", "code"], "inner", max_zones)
    t = t.withColumn("hour_timestamp", C.hour_of("pickup_datetime"))
    w = weather.withColumns(
        {
            "condition_code": C.condition_code("weather_condition", V.DEFAULT_CONDITION_CODE),
            "bad": C.bad_weather("weather_condition"),
        }
    )
    weather_columns = ("temperature_celsius", "condition_code", "bad")
    t = J.join_weather_hour(t, w, "hour_timestamp", weather_columns, as_of, length)
    t = J.join_own_stats(t, routes, ["pickup_location_id", "dropoff_location_id"], bounds[0])
    t = J.join_own_stats(t, surges, ["pickup_location_id", "hour_timestamp"], bounds[1])

    minutes = C.minutes_between("pickup_datetime", "dropoff_datetime")
    code = F.coalesce("condition_code", C.num(V.DEFAULT_CONDITION_CODE))
    rush = C.is_rush("pickup_datetime")
    parts = C.date_parts("pickup_datetime")
    return t.select(
        C.trip_label("vendor_id", "pickup_datetime").alias("trip_id"),
        "fare_amount",
        "trip_distance",
        minutes.alias("trip_duration_minutes"),
        "passenger_count",
        F.col("pickup_location_id").alias("pickup_zone_id"),
        F.col("dropoff_location_id").alias("dropoff_zone_id"),
        F.col("pickup_code").alias("pickup_borough_encoded"),
        F.col("dropoff_code").alias("dropoff_borough_encoded"),
        C.planar_distance("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude").alias(
            "zone_distance_km"
        ),
        C.is_airport("pickup_zone_type", "dropoff_zone_type").alias("is_airport_trip"),
        C.is_cross("pickup_borough", "dropoff_borough").alias("is_cross_borough"),
        parts["hour"].alias("pickup_hour"),
        parts["day_of_week"].alias("pickup_day_of_week"),
        rush.alias("is_rush_hour"),
        C.is_weekend("pickup_datetime").alias("is_weekend"),
        code.alias("weather_condition_encoded"),
        F.coalesce("temperature_celsius", C.num(V.DEFAULT_TEMPERATURE)).alias("temperature_celsius"),
        F.coalesce("bad", F.lit(False)).alias("is_bad_weather"),
        F.coalesce("avg_fare_same_route_7d", "fare_amount").alias("avg_fare_same_route_7d"),
        F.coalesce("avg_fare_pickup_zone_1h", "fare_amount").alias("avg_fare_pickup_zone_1h"),
        F.coalesce("surge_factor", C.num(1)).alias("surge_factor"),
        C.distance_per_hour(F.col("trip_distance"), minutes).alias("distance_duration_ratio"),
        (F.col("trip_distance") * code).alias("weather_distance_interaction"),
        (F.col("trip_distance") * C.flag_double(rush)).alias("rush_hour_distance_interaction"),
        parts["date"].alias("feature_date"),
    )
