"""Declared schemas: nothing is inferred, so readers start without a pass over the files."""

from __future__ import annotations

# Driver tables. Timestamps are declared as TIMESTAMP (the files hold zone-less ones), so predicates on the raw
# column reach the scan without a cast in between.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
        "o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp"
    ),
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
}

RAW_TRIPS = (
    "VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, passenger_count int, "
    "trip_distance double, RatecodeID int, store_and_fwd_flag string, PULocationID int, DOLocationID int, "
    "payment_type int, fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, "
    "improvement_surcharge double, total_amount double, congestion_surcharge double, airport_fee double"
)

CURATED_TRIPS = (
    "vendor_id int, pickup_datetime timestamp, dropoff_datetime timestamp, passenger_count int, trip_distance double, "
    "rate_code_id int, store_and_fwd_flag string, pickup_location_id int, dropoff_location_id int, payment_type int, "
    "fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, "
    "improvement_surcharge double, total_amount double, congestion_surcharge double, airport_fee double, "
    "load_date timestamp, year int, month int, day int"
)

# Files mix 70 and 70.3 in one column, so numbers are declared; times stay text until they are parsed.
RAW_WEATHER = (
    "timestamp string, location string, latitude double, longitude double, temperature_celsius double, "
    "temperature_fahrenheit double, humidity_percent double, pressure_hpa double, wind_speed_kmh double, "
    "weather_condition string, visibility_km double, uv_index double, hour int, day_of_week int, is_weekend boolean"
)

RAW_ZONES = (
    "location_id int, borough string, zone string, lat double, lon double, zone_type string, "
    "is_tourist_area boolean, is_business_district boolean, created_at string"
)

ZONES = (
    "location_id int, borough string, zone string, latitude double, longitude double, zone_type string, "
    "is_tourist_area boolean, is_business_district boolean, created_at timestamp, load_date timestamp"
)

CONTROL = "table_name string, last_processed_date timestamp, last_updated timestamp"

# Output tables: schema and partition columns.
OUTPUT_TABLES = {
    "trip_weather_correlation": (
        "trip_date date, hour int, weather_condition string, temperature_celsius double, humidity_percent double, "
        "wind_speed_kmh double, total_trips bigint, avg_trip_distance double, avg_fare_amount double, "
        "avg_tip_amount double, avg_trip_duration_minutes double, pickup_zone_diversity int, load_date timestamp, "
        "day int, year int, month int",
        ("trip_date",),
    ),
    "zone_performance_metrics": (
        "location_id int, zone_name string, zone_type string, is_tourist_area boolean, is_business_district boolean, "
        "trip_date date, hour int, weather_condition string, total_pickups bigint, total_dropoffs bigint, "
        "avg_fare_per_pickup double, avg_tip_percentage double, avg_trip_distance double, peak_hour_factor double, "
        "weather_impact_score double, load_date timestamp, year int, month int, borough string",
        ("trip_date",),
    ),
    "hourly_weather": (
        "timestamp timestamp, location string, latitude double, longitude double, temperature_celsius double, "
        "temperature_fahrenheit double, humidity_percent double, pressure_hpa double, wind_speed_kmh double, "
        "weather_condition string, visibility_km double, uv_index double, hour int, day_of_week int, "
        "is_weekend boolean, load_date timestamp, year int, month int, day int",
        ("year", "month", "day"),
    ),
    "demand_features_analytics": (
        "location_id int, prediction_datetime timestamp, hour int, day_of_week int, is_weekend boolean, "
        "is_holiday boolean, temperature_celsius double, weather_condition string, historical_demand_1h_ago bigint, "
        "historical_demand_24h_ago bigint, historical_demand_168h_ago bigint, rolling_avg_demand_7d double, "
        "rolling_avg_demand_30d double, zone_type string, is_tourist_area boolean, is_business_district boolean, "
        "nearby_zones_demand bigint, weather_impact_factor double, event_factor double, load_date timestamp, "
        "year int, month int, prediction_date date",
        ("prediction_date",),
    ),
    "demand_features_ml": (
        "location_id int, prediction_hour timestamp, target_demand bigint, hour_of_day int, day_of_week int, "
        "day_of_month int, month int, is_weekend boolean, is_holiday boolean, temperature_celsius double, "
        "humidity_percent double, wind_speed_kmh double, weather_condition_encoded double, demand_1h_ago bigint, "
        "demand_24h_ago bigint, demand_168h_ago bigint, rolling_avg_7d double, rolling_avg_30d double, "
        "rolling_std_7d double, zone_type_encoded double, is_tourist_area_flag int, is_business_district_flag int, "
        "zone_popularity_score double, temp_hour_interaction double, weather_weekend_interaction double, "
        "tourist_weekend_interaction double, demand_lag_2h bigint, demand_lag_3h bigint, "
        "demand_same_hour_last_week bigint, created_at timestamp, feature_date date",
        ("feature_date",),
    ),
    "fare_features": (
        "trip_id string, fare_amount double, trip_distance double, trip_duration_minutes double, passenger_count int, "
        "pickup_zone_id int, dropoff_zone_id int, pickup_borough_encoded double, dropoff_borough_encoded double, "
        "zone_distance_km double, is_airport_trip boolean, is_cross_borough boolean, pickup_hour int, "
        "pickup_day_of_week int, is_rush_hour boolean, is_weekend boolean, weather_condition_encoded double, "
        "temperature_celsius double, is_bad_weather boolean, avg_fare_same_route_7d double, "
        "avg_fare_pickup_zone_1h double, surge_factor double, distance_duration_ratio double, "
        "weather_distance_interaction double, rush_hour_distance_interaction double, created_at timestamp, "
        "feature_date date",
        ("feature_date",),
    ),
    "daily_summary": (
        "trip_date date, total_trips bigint, total_passengers bigint, avg_trip_distance double, "
        "avg_fare_amount double, avg_tip_amount double, avg_total_amount double, last_updated timestamp, year int, "
        "month int",
        ("trip_date",),
    ),
    "trip_window_aggregates": (
        "window_start timestamp, window_end timestamp, pickup_zone_id int, total_trips bigint, total_revenue double, "
        "avg_trip_distance double, avg_fare_amount double, unique_vendors bigint, processed_at timestamp, "
        "window_date date",
        ("window_date",),
    ),
    "window_dropoffs": (
        "window_start timestamp, window_end timestamp, zone_id int, dropoff_count bigint, top_destination_zone int, "
        "processed_at timestamp, window_date date",
        ("window_date",),
    ),
    "zone_activity": (
        "zone_id int, activity_timestamp timestamp, pickup_count bigint, dropoff_count bigint, "
        "revenue_last_hour double, avg_fare_last_hour double, top_destination_zone int, activity_score double, "
        "processed_at timestamp, activity_hour timestamp",
        ("activity_hour",),
    ),
    "change_trips": (
        "id bigint, vendor_id int, pickup_datetime timestamp, dropoff_datetime timestamp, passenger_count int, "
        "trip_distance decimal(8,2), pickup_longitude decimal(18,14), pickup_latitude decimal(18,14), "
        "dropoff_longitude decimal(18,14), dropoff_latitude decimal(18,14), payment_type int, "
        "fare_amount decimal(8,2), extra decimal(8,2), mta_tax decimal(8,2), tip_amount decimal(8,2), "
        "tolls_amount decimal(8,2), total_amount decimal(8,2), created_at timestamp, updated_at timestamp, "
        "__op string, __source_ts_ms bigint, __source_db string, __source_table string, pickup_date date",
        ("pickup_date",),
    ),
    "change_payment_types": (
        "id int, name string, description string, __op string, __source_ts_ms bigint, __source_db string, "
        "__source_table string",
        (),
    ),
    "change_vendors": (
        "id int, name string, description string, __op string, __source_ts_ms bigint, __source_db string, "
        "__source_table string",
        (),
    ),
    "control": (CONTROL, ()),
    "source_trips": (
        "id bigint, vendor_id int, pickup_datetime timestamp, dropoff_datetime timestamp, trip_distance double, "
        "fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, total_amount double, "
        "updated_at timestamp, pickup_date date",
        ("pickup_date",),
    ),
    "merged_batches": ("table_name string, batch bigint", ()),
    "landed_files": ("file string, modified timestamp, load_date timestamp", ()),
    "bad_trips": (f"{RAW_TRIPS}, file string, load_date timestamp", ()),
    "trips": (CURATED_TRIPS, ("year", "month")),
    "zones": (ZONES, ()),
}

# Change stream.
SOURCE = "struct<db:string,table:string,ts_ms:bigint>"
ENVELOPE = f"op string, ts_ms bigint, before string, after string, source {SOURCE}"
TRIP_PAYLOAD = (
    "id bigint, vendor_id int, pickup_datetime string, dropoff_datetime string, pickup_location_id bigint, "
    "dropoff_location_id bigint, trip_distance double, fare_amount double, total_amount double"
)

# Rows of the source tables as the capture sends them: decimals and times as text or numbers, typed afterwards.
MIRROR_PAYLOADS = {
    "trips": (
        "id bigint, vendor_id int, pickup_datetime string, dropoff_datetime string, passenger_count int, "
        "trip_distance string, pickup_longitude string, pickup_latitude string, dropoff_longitude string, "
        "dropoff_latitude string, payment_type int, fare_amount string, extra string, mta_tax string, tip_amount string, "
        "tolls_amount string, total_amount string, created_at string, updated_at string"
    ),
    "payment_types": "id int, name string, description string",
    "vendors": "id int, name string, description string",
}
