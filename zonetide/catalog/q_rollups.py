"""Aggregations, sorts and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonetide.catalog.q_core import DATE, DROPOFFS, HOUR, HOUR_NO, PICKUPS, VENDOR_STATS
from zonetide.catalog.registry import ALL_EVENTS, AS_OF, DAY, EVENTS_FROM, EVENTS_TO, register
from zonetide.catalog.role_sql import r
from zonetide.catalog.role_sql import with_roles as q
from zonetide.operators import ordering as T
from zonetide.operators import rollups as A
from zonetide.plans import serving as M
from zonetide.sources import roles

MINUTES = "(floor(epoch(dropoff_datetime)) - floor(epoch(pickup_datetime))) / 60"

TRIP_WEATHER = f"""SELECT {DATE} AS trip_date, {HOUR_NO} AS "hour",
  coalesce(weather_condition, 'unknown') AS weather_condition, avg(temperature_celsius) AS temperature_celsius,
  avg(humidity_percent) AS humidity_percent, avg(wind_speed_kmh) AS wind_speed_kmh, count(*) AS total_trips,
  avg(trip_distance) AS avg_trip_distance, avg(fare_amount) AS avg_fare_amount, avg(tip_amount) AS avg_tip_amount,
  avg({MINUTES}) AS avg_trip_duration_minutes,
  CAST(count(DISTINCT pickup_location_id) AS INTEGER) AS pickup_zone_diversity,
  CAST(year({DATE}) AS INTEGER) AS "year", CAST(month({DATE}) AS INTEGER) AS "month",
  CAST(day({DATE}) AS INTEGER) AS "day"
  FROM trips_e LEFT JOIN weather_h ON {HOUR} = "timestamp" GROUP BY {DATE}, 2, weather_condition"""


def hourly(s, d):
    return A.trip_weather(roles.trips_e(s, d), roles.weather_h(s, d), AS_OF, ALL_EVENTS)


register(
    "trip_weather_correlation",
    hourly,
    q("trips_e weather_h", TRIP_WEATHER),
    "temperature_celsius humidity_percent wind_speed_kmh avg_trip_distance avg_fare_amount avg_tip_amount "
    "avg_trip_duration_minutes",
)
register(
    "pickup_metrics",
    lambda s, d: A.pickup_metrics(roles.trips_e(s, d), roles.weather_h(s, d), AS_OF, ALL_EVENTS),
    q("trips_e weather_h", PICKUPS),
    "avg_fare_per_pickup avg_tip_percentage avg_trip_distance",
)
register("dropoff_metrics", lambda s, d: A.dropoff_metrics(roles.trips_e(s, d)), q("trips_e", DROPOFFS))
register(
    "zone_day_stats",
    lambda s, d: A.zone_day_stats(
        A.pickup_metrics(roles.trips_e(s, d), roles.weather_h(s, d), AS_OF, ALL_EVENTS)
    ),
    q("trips_e weather_h", """SELECT location_id, trip_date, avg(total_pickups) AS avg_hourly_pickups,
      max(total_pickups) AS max_hourly_pickups FROM p GROUP BY 1, 2""", p=PICKUPS),
    "avg_hourly_pickups",
)
PERFORMANCE = """SELECT p.location_id, z.zone AS zone_name, z.borough, z.zone_type, z.is_tourist_area,
  z.is_business_district, p.trip_date, p."hour", p.weather_condition, p.total_pickups,
  coalesce(o.total_dropoffs, 0) AS total_dropoffs, p.avg_fare_per_pickup, p.avg_tip_percentage, p.avg_trip_distance,
  CASE WHEN s.m > 0 THEN p.total_pickups / s.m ELSE 1 END AS peak_hour_factor,
  CAST(CASE WHEN p.weather_condition IN ('rain', 'snow') THEN 1.2 WHEN p.weather_condition = 'fog' THEN 1.1
    ELSE 1.0 END AS DOUBLE) AS weather_impact_score,
  CAST(year(p.trip_date) AS INTEGER) AS "year", CAST(month(p.trip_date) AS INTEGER) AS "month"
  FROM p LEFT JOIN o ON p.location_id = o.location_id AND p.trip_date = o.trip_date AND p."hour" = o."hour"
  LEFT JOIN zones_c z ON p.location_id = z.location_id
  LEFT JOIN (SELECT location_id, trip_date, avg(total_pickups) AS m FROM p GROUP BY 1, 2) s
    ON p.location_id = s.location_id AND p.trip_date = s.trip_date WHERE z.location_id IS NOT NULL"""
_PERF = {"p": PICKUPS, "o": DROPOFFS}


def performance(s, d):
    return A.zone_performance(roles.trips_e(s, d), roles.weather_h(s, d), roles.zones_c(s, d), AS_OF, ALL_EVENTS)


register(
    "zone_performance_metrics",
    performance,
    q("trips_e weather_h zones_c", PERFORMANCE, **_PERF),
    "avg_fare_per_pickup avg_tip_percentage avg_trip_distance peak_hour_factor",
)
DEMAND = f"""SELECT pickup_location_id AS location_id, {HOUR} AS hour_timestamp, count(*) AS demand_count
  FROM trips_e GROUP BY 1, 2"""
register("hourly_demand", lambda s, d: A.hourly_demand(roles.trips_e(s, d)), q("trips_e", DEMAND))

# --- calendar -------------------------------------------------------------------------------------------------------

register(
    "daily_summary",
    lambda s, d: A.daily_summary(roles.trips_o(s, d)),
    q("trips_o", f"""SELECT {DATE} AS trip_date, count(*) AS total_trips,
      CAST(sum(passenger_count) AS BIGINT) AS total_passengers, avg(trip_distance) AS avg_trip_distance,
      avg(fare_amount) AS avg_fare_amount, avg(tip_amount) AS avg_tip_amount, avg(total_amount) AS avg_total_amount,
      CAST(year({DATE}) AS INTEGER) AS "year", CAST(month({DATE}) AS INTEGER) AS "month"
      FROM trips_o GROUP BY {DATE}"""),
    "avg_trip_distance avg_fare_amount avg_tip_amount avg_total_amount",
)
register(
    "monthly_load_stats",
    lambda s, d: A.monthly_load_stats(roles.trips_o(s, d)),
    q("trips_o", """SELECT CAST(year(pickup_datetime) AS INTEGER) AS "year",
      CAST(month(pickup_datetime) AS INTEGER) AS "month", count(*) AS trip_count,
      avg(trip_distance) AS avg_distance, avg(total_amount) AS avg_amount FROM trips_o GROUP BY 1, 2"""),
    "avg_distance avg_amount",
)
register(
    "daily_weather_stats",
    lambda s, d: A.daily_weather_stats(roles.weather_h(s, d)).withColumn(
        "conditions", F.array_join("conditions", ",")
    ),
    q("weather_h", """SELECT CAST("timestamp" AS DATE) AS weather_date, avg(temperature_celsius) AS avg_temp_c,
      avg(humidity_percent) AS avg_humidity, avg(wind_speed_kmh) AS avg_wind_speed,
      string_agg(DISTINCT weather_condition, ',' ORDER BY weather_condition) AS conditions
      FROM weather_h GROUP BY 1"""),
    "avg_temp_c avg_humidity avg_wind_speed",
)
register(
    "zones_by_borough",
    lambda s, d: A.zones_by_borough(roles.zones_c(s, d)),
    q("zones_c", """SELECT borough, count(*) AS zone_count, count(*) FILTER (is_tourist_area) AS tourist_zones,
      count(*) FILTER (is_business_district) AS business_zones FROM zones_c GROUP BY 1"""),
)
register(
    "trip_summary",
    lambda s, d: A.trip_summary(roles.trips_e(s, d)),
    q("trips_e", f"""SELECT {HOUR} AS "hour", count(*) AS trip_count, avg(trip_distance) AS avg_distance,
      avg(fare_amount) AS avg_fare, avg(passenger_count) AS avg_passengers FROM trips_e GROUP BY 1"""),
    "avg_distance avg_fare avg_passengers",
)
register(
    "hourly_vendor_stats",
    lambda s, d: A.hourly_vendor_stats(roles.trips_e(s, d)),
    q("trips_e", VENDOR_STATS),
    "avg_distance total_fare avg_fare",
)

# --- reports --------------------------------------------------------------------------------------------------------

register(
    "summary_by_condition",
    lambda s, d: A.summary_by_condition(hourly(s, d)),
    q("trips_e weather_h", """SELECT weather_condition, count(*) AS hours_count, avg(total_trips) AS avg_trips_per_hour,
      avg(avg_trip_distance) AS avg_distance, avg(avg_fare_amount) AS avg_fare FROM a GROUP BY 1""", a=TRIP_WEATHER),
    "avg_trips_per_hour avg_distance avg_fare",
)
register(
    "top_zones_by_pickups",
    lambda s, d: A.top_zones_by_pickups(performance(s, d)),
    q("trips_e weather_h zones_c", """SELECT zone_name, borough, CAST(sum(total_pickups) AS BIGINT) AS total_pickups,
      avg(avg_fare_per_pickup) AS avg_fare, avg(peak_hour_factor) AS avg_peak_factor FROM perf GROUP BY 1, 2
      ORDER BY 3 DESC, 1 LIMIT 10""", **_PERF, perf=PERFORMANCE),
    "avg_fare avg_peak_factor",
)
register(
    "condition_corr",
    lambda s, d: A.condition_corr(hourly(s, d)),
    q("trips_e weather_h", """SELECT weather_condition, avg(total_trips) AS avg_trips, avg(avg_fare_amount) AS avg_fare,
      corr(temperature_celsius, total_trips) AS temp_correlation FROM a GROUP BY 1""", a=TRIP_WEATHER),
    "avg_trips avg_fare temp_correlation",
)
register(
    "zone_revenue_rank",
    lambda s, d: A.zone_revenue_rank(performance(s, d)),
    q("trips_e weather_h zones_c", """SELECT zone_name, borough, sum(total_pickups * avg_fare_per_pickup) AS total_revenue,
      avg(peak_hour_factor) AS avg_peak_factor, avg(weather_impact_score) AS weather_sensitivity
      FROM perf GROUP BY 1, 2""", **_PERF, perf=PERFORMANCE),
    "total_revenue avg_peak_factor weather_sensitivity",
)

# --- fares ----------------------------------------------------------------------------------------------------------

register(
    "route_history",
    lambda s, d: A.route_history(roles.trips_o(s, d)),
    q("trips_o", """SELECT pickup_location_id, dropoff_location_id, avg(fare_amount) AS avg_fare_same_route_7d,
      count(*) AS route_frequency FROM trips_o GROUP BY 1, 2"""),
    "avg_fare_same_route_7d",
)
SURGE = f"""SELECT pickup_location_id, {HOUR} AS hour_timestamp, avg(fare_amount) AS avg_fare_pickup_zone_1h,
  count(*) AS trips_in_hour,
  CAST(CASE WHEN count(*) > avg(count(*)) OVER (PARTITION BY pickup_location_id) * 1.5 THEN 1.2
    WHEN count(*) < avg(count(*)) OVER (PARTITION BY pickup_location_id) * 0.5 THEN 0.8 ELSE 1.0 END AS DOUBLE)
    AS surge_factor FROM trips_e GROUP BY 1, 2"""
register(
    "zone_hour_surge",
    lambda s, d: A.zone_hour_surge(roles.trips_e(s, d)),
    q("trips_e", SURGE),
    "avg_fare_pickup_zone_1h surge_factor",
)

# --- serving --------------------------------------------------------------------------------------------------------

ZONE_METRICS = f"""SELECT zone_id, coalesce(zone, 'Unknown Zone') AS zone_name, coalesce(borough, 'Unknown') AS borough,
  total_trips, {r("fare", 2)} AS avg_fare, {r("revenue", 2)} AS total_revenue, {r("distance", 2)} AS avg_distance,
  {r("CAST(peak AS DOUBLE) / nullif(total_trips, 0) * 100", 2)} AS peak_hour_factor
  FROM (SELECT coalesce(pickup_location_id, dropoff_location_id) AS zone_id, count(*) AS total_trips,
    avg(fare_amount) AS fare, sum(total_amount) AS revenue, avg(trip_distance) AS distance,
    count(*) FILTER (hour(pickup_datetime) BETWEEN 17 AND 19) AS peak FROM trips_e
    WHERE pickup_datetime BETWEEN TIMESTAMP '{EVENTS_FROM}' AND TIMESTAMP '{EVENTS_TO}' AND fare_amount > 0 GROUP BY 1)
  LEFT JOIN zones_s ON zone_id = location_id WHERE zone_id IS NOT NULL"""


def _zone_metrics(s, d):
    return A.zone_metrics(roles.trips_e(s, d), roles.zones_s(s, d), EVENTS_FROM, EVENTS_TO)


register("zone_metrics", _zone_metrics, q("trips_e zones_s", ZONE_METRICS))
SERIES = f"""SELECT {HOUR} AS "hour", count(*) AS trip_count, avg(fare_amount) AS avg_fare,
  sum(total_amount) AS total_revenue FROM trips_e WHERE fare_amount > 0 GROUP BY 1"""
register(
    "hourly_series",
    lambda s, d: A.hourly_series(roles.trips_e(s, d), AS_OF, 30),
    q("trips_e", SERIES),
    "avg_fare total_revenue",
)
register(
    "daily_time_category",
    lambda s, d: A.daily_time_category(roles.trips_e(s, d), EVENTS_FROM, EVENTS_TO),
    q("trips_e", f"""SELECT {DATE} AS trip_date, CASE WHEN dayofweek(pickup_datetime) IN (0, 6) THEN 'Weekend'
      WHEN hour(pickup_datetime) BETWEEN 7 AND 9 THEN 'Rush Hour'
      WHEN hour(pickup_datetime) BETWEEN 17 AND 19 THEN 'Evening Rush' ELSE 'Regular' END AS time_category,
      count(*) AS total_trips, avg(fare_amount) AS avg_fare FROM trips_e WHERE fare_amount > 0 GROUP BY 1, 2"""),
    "avg_fare",
)
PATTERN = """SELECT pickup_location_id AS location_id, CAST(hour(pickup_datetime) AS INTEGER) AS hour_of_day,
  CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS day_of_week, count(*) AS historical_count,
  avg(fare_amount) AS avg_fare FROM trips_e WHERE fare_amount > 0 AND pickup_location_id IS NOT NULL GROUP BY 1, 2, 3"""
register(
    "weekly_pattern",
    lambda s, d: A.weekly_pattern(roles.trips_e(s, d), AS_OF, 30),
    q("trips_e", PATTERN),
    "avg_fare",
)
ACTIVITY = f"""SELECT pickup_location_id AS zone_id, count(*) AS pickup_count, sum(total_amount) AS revenue_last_hour,
  avg({MINUTES}) AS avg_trip_duration FROM trips_e WHERE fare_amount > 0 AND pickup_location_id IS NOT NULL
  AND dropoff_datetime IS NOT NULL GROUP BY 1"""
register(
    "zone_activity_recent",
    lambda s, d: A.zone_activity_recent(roles.trips_e(s, d), AS_OF, ALL_EVENTS),
    q("trips_e", ACTIVITY),
    "revenue_last_hour avg_trip_duration",
)
_ON_DAY = f"WHERE {DATE} = DATE '{DAY}'"
KPI = f"""SELECT count(*) AS total_trips, coalesce(sum(total_amount), 0) AS total_revenue,
  coalesce(avg(fare_amount), 0) AS avg_fare, count(DISTINCT pickup_location_id) AS active_zones
  FROM trips_e {_ON_DAY} AND fare_amount > 0"""
register(
    "kpi_today", lambda s, d: A.kpi_day(roles.trips_e(s, d), DAY), q("trips_e", KPI), "total_revenue avg_fare"
)
PEAK = f"""SELECT CAST(h AS VARCHAR) || ':00' AS peak_hour FROM (SELECT hour(pickup_datetime) AS h, count(*) AS n
  FROM trips_e {_ON_DAY} GROUP BY 1) ORDER BY n DESC, h LIMIT 1"""
register("peak_hour", lambda s, d: A.peak_hour(roles.trips_e(s, d), DAY), q("trips_e", PEAK))
TOP_DAY = f"""SELECT coalesce(zone, 'Unknown') AS zone_name, count(*) AS trips, sum(total_amount) AS revenue
  FROM trips_e LEFT JOIN zones_s ON pickup_location_id = location_id {_ON_DAY} AND fare_amount > 0 GROUP BY 1
  ORDER BY revenue DESC, zone_name LIMIT 5"""
register(
    "top_zones_today",
    lambda s, d: A.top_zones_day(roles.trips_e(s, d), roles.zones_s(s, d), DAY),
    q("trips_e zones_s", TOP_DAY),
    "revenue",
)
register(
    "dashboard_stats",
    lambda s, d: A.dashboard_stats(roles.trips_e(s, d), roles.zones_s(s, d), DAY).withColumn(
        "top_zones", F.concat_ws(";", F.transform("top_zones", lambda t: F.concat_ws("|", t.zone_name, t.trips)))
    ),
    q("trips_e zones_s", """SELECT kpi.*, (SELECT peak_hour FROM peak) AS peak_hour,
      (SELECT string_agg(zone_name || '|' || trips, ';' ORDER BY revenue DESC, zone_name) FROM top_day) AS top_zones
      FROM kpi""", kpi=KPI, peak=PEAK, top_day=TOP_DAY),
    "total_revenue avg_fare",
)
register(
    "dataset_means",
    lambda s, d: A.dataset_means(roles.trips_o(s, d)),
    q("trips_o", """SELECT count(*) AS total_trips, avg(fare_amount) AS avg_fare, avg(trip_distance) AS avg_distance
      FROM trips_o"""),
    "avg_fare avg_distance",
)
register(
    "daily_mean_series",
    lambda s, d: A.daily_mean(M.time_series(roles.trips_e(s, d), "trip_count", AS_OF, 30), last_days=5),
    q("trips_e", """SELECT CAST("hour" AS DATE) AS "day", avg(trip_count) AS mean_value FROM series GROUP BY 1
      ORDER BY 1 DESC LIMIT 5""", series=SERIES),
    "mean_value",
)

# --- order ----------------------------------------------------------------------------------------------------------

register(
    "top_recent",
    lambda s, d: T.top_recent(roles.trips_e(s, d), "pickup_datetime", 1000, "trip_id").select(
        "trip_id", "pickup_datetime", "fare_amount"
    ),
    q("trips_e", """SELECT trip_id, pickup_datetime, fare_amount FROM trips_e
      ORDER BY pickup_datetime DESC, trip_id DESC LIMIT 1000"""),
)
register(
    "order_multi",
    lambda s, d: T.order_multi(
        A.hourly_demand(roles.trips_e(s, d)), ["-demand_count", "hour_timestamp", "-location_id"]
    ),
    q("trips_e", DEMAND + " ORDER BY demand_count DESC, hour_timestamp, location_id DESC"),
)
register(
    "nlargest",
    lambda s, d: T.nlargest(_zone_metrics(s, d), "total_revenue", 5, "zone_id"),
    q("trips_e zones_s", ZONE_METRICS + " ORDER BY total_revenue DESC, zone_id LIMIT 5"),
)
register(
    "paginate",
    lambda s, d: T.paginate(
        roles.trips_e(s, d).select("trip_id", "pickup_datetime", "fare_amount"), ["-pickup_datetime", "-trip_id"], 3, 50
    ),
    q("trips_e", """SELECT trip_id, pickup_datetime, fare_amount, (SELECT count(*) FROM trips_e) AS total_count,
      3 AS page, 50 AS page_size, CAST(ceil((SELECT count(*) FROM trips_e) / 50) AS BIGINT) AS total_pages
      FROM trips_e ORDER BY pickup_datetime DESC, trip_id DESC LIMIT 50 OFFSET 100"""),
)
register(
    "paginate_after",
    lambda s, d: T.page_after(
        roles.trips_e(s, d).select("trip_id", "pickup_datetime", "fare_amount"), "pickup_datetime", "trip_id",
        ("2024-01-15 00:00:00", 1000), 50,
    ),
    q("trips_e", """SELECT trip_id, pickup_datetime, fare_amount FROM trips_e
      WHERE pickup_datetime < TIMESTAMP '2024-01-15 00:00:00'
      OR (pickup_datetime = TIMESTAMP '2024-01-15 00:00:00' AND trip_id < 1000)
      ORDER BY pickup_datetime DESC, trip_id DESC LIMIT 50"""),
)
register(
    "sorted_rollup",
    lambda s, d: T.sorted_report(
        roles.trips_o(s, d).groupBy("payment_type", "passenger_count").agg(A.n_rows().alias("n")),
        ["-n", "payment_type", "passenger_count"],
    ),
    q("trips_o", """SELECT payment_type, passenger_count, count(*) AS n FROM trips_o GROUP BY 1, 2
      ORDER BY n DESC, 1, 2"""),
)
