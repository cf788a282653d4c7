"""One query per group of column helpers, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonetide.catalog.q_features import MINUTES
from zonetide.catalog.q_rollups import DATE, HOUR, HOUR_NO
from zonetide.catalog.registry import register
from zonetide.catalog.role_sql import r
from zonetide.catalog.role_sql import with_roles as q
from zonetide.functions import columns as C
from zonetide.sources import roles


def trips(build):
    """A query over all event trips: the trip id and the built columns."""
    return lambda s, d: roles.trips_e(s, d).select("trip_id", *[c.alias(n) for n, c in build().items()])


def sql(columns: str, roles_: str = "trips_e", source: str = "trips_e") -> str:
    return q(roles_, f"SELECT trip_id, {columns} FROM {source}")


register(
    "sc_date_parts",
    trips(lambda: {(f"{k}_part" if k != "day_of_week" else k): v for k, v in C.date_parts("pickup_datetime").items()}),
    sql(f"""{DATE} AS date_part, {HOUR_NO} AS hour_part, CAST(year(pickup_datetime) AS INTEGER) AS year_part,
      CAST(month(pickup_datetime) AS INTEGER) AS month_part, CAST(day(pickup_datetime) AS INTEGER) AS day_part,
      CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS day_of_week"""),
)
register(
    "sc_trunc_hour",
    trips(lambda: {"hour_timestamp": C.hour_of("pickup_datetime")}),
    sql(f"{HOUR} AS hour_timestamp"),
)
register(
    "sc_duration",
    lambda s, d: roles.trips_o(s, d)
    .withColumn("minutes", C.minutes_between("pickup_datetime", "dropoff_datetime"))
    .groupBy("pickup_datetime")
    .agg(F.sum("minutes").alias("total"), F.min("minutes").alias("shortest"), F.max("minutes").alias("longest")),
    q("trips_o", f"""SELECT pickup_datetime, sum({MINUTES}) AS total, min({MINUTES}) AS shortest,
      max({MINUTES}) AS longest FROM trips_o GROUP BY 1"""),
    "total shortest longest",
)
register(
    "sc_weekend",
    trips(lambda: {"is_weekend": C.is_weekend("pickup_datetime")}),
    sql("dayofweek(pickup_datetime) IN (0, 6) AS is_weekend"),
)
register(
    "sc_rush",
    trips(lambda: {"is_rush_hour": C.is_rush("pickup_datetime"), "time_category": C.time_category("pickup_datetime")}),
    sql("""(hour(pickup_datetime) BETWEEN 7 AND 9 OR hour(pickup_datetime) BETWEEN 17 AND 19) AS is_rush_hour,
      CASE WHEN dayofweek(pickup_datetime) IN (0, 6) THEN 'Weekend' WHEN hour(pickup_datetime) BETWEEN 7 AND 9
        THEN 'Rush Hour' WHEN hour(pickup_datetime) BETWEEN 17 AND 19 THEN 'Evening Rush' ELSE 'Regular' END
        AS time_category"""),
)
register(
    "sc_interval",
    trips(
        lambda: {
            "later": C.shift("pickup_datetime", "36 hours"),
            "earlier": C.shift("pickup_datetime", "30 days", back=True),
        }
    ),
    sql("pickup_datetime + INTERVAL 36 HOUR AS later, pickup_datetime - INTERVAL 30 DAY AS earlier"),
)
register(
    "sc_tip_pct",
    trips(lambda: {"tip_pct": C.tip_pct("tip_amount", "fare_amount")}),
    sql("CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100 ELSE 0 END AS tip_pct"),
    "tip_pct",
)
register(
    "sc_peak_factor",
    trips(
        lambda: {
            "factor": C.peak_factor("fare_amount", "trip_distance"),
            "share": C.share_pct("passenger_count", F.col("passenger_count") + F.col("payment_type") - 1),
        }
    ),
    sql("""CASE WHEN trip_distance > 0 THEN fare_amount / trip_distance ELSE 1 END AS factor,
      CAST(passenger_count AS DOUBLE) / nullif(passenger_count + payment_type - 1, 0) * 100 AS share"""),
    "factor share",
)


def _weather_factor(s, d):
    w = roles.weather_h(s, d)
    n = F.col("humidity_percent")
    return w.select(
        "timestamp",
        C.zone_weather_score("weather_condition").alias("score"),
        C.demand_weather_factor("weather_condition", "temperature_celsius").alias("factor"),
        C.impact_score("weather_condition", n).alias("impact"),
    )


register(
    "sc_weather_factor",
    _weather_factor,
    q("weather_h", """SELECT "timestamp",
      CAST(CASE WHEN weather_condition IN ('rain', 'snow') THEN 1.2 WHEN weather_condition = 'fog' THEN 1.1 ELSE 1 END
        AS DOUBLE) AS score,
      CAST(CASE WHEN weather_condition IN ('rain', 'snow') THEN 1.3 WHEN weather_condition = 'fog' THEN 1.1
        WHEN temperature_celsius < 0 THEN 1.2 WHEN temperature_celsius > 30 THEN 1.1 ELSE 1 END AS DOUBLE) AS factor,
      CASE weather_condition WHEN 'rain' THEN least(humidity_percent * 1.3, 100)
        WHEN 'snow' THEN least(humidity_percent * 1.5, 100) WHEN 'cloudy' THEN least(humidity_percent * 1.1, 100)
        ELSE humidity_percent END AS impact FROM weather_h"""),
    "impact",
)
_CONDITION = """CAST(CASE weather_condition WHEN 'clear' THEN 1 WHEN 'cloudy' THEN 2 WHEN 'rain' THEN 3
  WHEN 'snow' THEN 4 WHEN 'fog' THEN 5 ELSE {0} END AS DOUBLE)"""
register(
    "sc_condition_code",
    lambda s, d: roles.weather_h(s, d).select(
        "timestamp",
        C.condition_code("weather_condition", 0).alias("demand_code"),
        C.condition_code("weather_condition", 1).alias("fare_code"),
    ),
    q("weather_h", f"""SELECT "timestamp", {_CONDITION.format(0)} AS demand_code, {_CONDITION.format(1)} AS fare_code
      FROM weather_h"""),
)
register(
    "sc_zone_codes",
    lambda s, d: roles.zones_c(s, d).select(
        "location_id", C.zone_type_code("zone_type").alias("type_code"), C.borough_code("borough").alias("boro_code")
    ),
    q("zones_c", """SELECT location_id,
      CAST(CASE zone_type WHEN 'airport' THEN 3 WHEN 'neighborhood' THEN 1 ELSE 2 END AS DOUBLE) AS type_code,
      CAST(CASE borough WHEN 'Manhattan' THEN 1 WHEN 'Brooklyn' THEN 2 WHEN 'Queens' THEN 3 WHEN 'Bronx' THEN 4
        WHEN 'Staten Island' THEN 5 ELSE 0 END AS DOUBLE) AS boro_code FROM zones_c"""),
)
register(
    "sc_flags",
    lambda s, d: roles.weather_h(s, d).select(
        "timestamp",
        C.bad_weather("weather_condition").alias("is_bad"),
        C.flag(F.when(F.col("humidity_percent") > 50, F.col("temperature_celsius") > 10)).alias("mild"),
    ),
    q("weather_h", """SELECT "timestamp", weather_condition IN ('rain', 'snow', 'fog') AS is_bad,
      CASE WHEN humidity_percent > 50 AND temperature_celsius > 10 THEN 1 ELSE 0 END AS mild FROM weather_h"""),
)


def _pairs(s, d):
    z = roles.zones_c(s, d)
    here = z.select("location_id", "latitude", "longitude", "zone_type", "borough")
    there = z.select(
        (F.col("location_id") - 7).alias("location_id"),
        F.col("latitude").alias("lat2"), F.col("longitude").alias("lon2"),
        F.col("zone_type").alias("type2"), F.col("borough").alias("boro2"),
    )
    return here.join(there, "location_id", "left")


_PAIRS = """(SELECT a.location_id, a.latitude, a.longitude, a.zone_type, a.borough, b.latitude AS lat2,
  b.longitude AS lon2, b.zone_type AS type2, b.borough AS boro2
  FROM zones_c a LEFT JOIN zones_c b ON b.location_id - 7 = a.location_id)"""
register(
    "sc_distance",
    lambda s, d: _pairs(s, d).select(
        "location_id",
        C.planar_distance("latitude", "longitude", "lat2", "lon2").alias("km"),
        C.rnd(C.planar_distance("latitude", "longitude", "lat2", "lon2", 69), 2).alias("miles"),
    ),
    q("zones_c", f"""SELECT location_id,
      sqrt(pow(latitude - lat2, 2) + pow(longitude - lon2, 2)) * 111 AS km,
      {r("sqrt(pow(latitude - lat2, 2) + pow(longitude - lon2, 2)) * 69", 2)} AS miles FROM {_PAIRS}"""),
    "km",
)
register(
    "sc_trip_kind",
    lambda s, d: _pairs(s, d).select(
        "location_id",
        C.is_airport("zone_type", "type2").alias("is_airport_trip"),
        C.is_cross("borough", "boro2").alias("is_cross_borough"),
    ),
    q("zones_c", f"""SELECT location_id,
      coalesce(zone_type = 'airport', false) OR coalesce(type2 = 'airport', false) AS is_airport_trip,
      coalesce(borough <> boro2, false) AS is_cross_borough FROM {_PAIRS}"""),
)
register(
    "sc_interactions",
    trips(
        lambda: {
            "temp_hour": F.col("fare_amount") * F.hour("pickup_datetime"),
            "code_weekend": F.col("trip_distance") * C.flag_double(C.is_weekend("pickup_datetime")),
            "distance_rush": F.col("trip_distance") * C.flag_double(C.is_rush("pickup_datetime")),
            "miles_per_hour": C.distance_per_hour(
                F.col("trip_distance"), C.minutes_between("pickup_datetime", "dropoff_datetime")
            ),
        }
    ),
    sql(f"""fare_amount * hour(pickup_datetime) AS temp_hour,
      CASE WHEN dayofweek(pickup_datetime) IN (0, 6) THEN trip_distance ELSE 0 END AS code_weekend,
      CASE WHEN hour(pickup_datetime) BETWEEN 7 AND 9 OR hour(pickup_datetime) BETWEEN 17 AND 19 THEN trip_distance
        ELSE 0 END AS distance_rush,
      CASE WHEN {MINUTES} > 0 THEN trip_distance / ({MINUTES} / 60) ELSE 0 END AS miles_per_hour"""),
    "temp_hour miles_per_hour",
)
register(
    "sc_trip_label",
    trips(lambda: {"label": C.trip_label("vendor_id", "pickup_datetime")}),
    sql("vendor_id || '_' || CAST(CAST(floor(epoch(pickup_datetime)) AS BIGINT) AS VARCHAR) AS label"),
)
register(
    "sc_parse_ts",
    lambda s, d: roles.trips_e(s, d).select(
        "trip_id",
        C.parse_ts(
            F.when(F.col("payment_type") == 2, "n/a").otherwise(
                F.date_format("pickup_datetime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            )
        ).alias("parsed"),
    ),
    sql("CASE WHEN payment_type = 2 THEN NULL ELSE pickup_datetime END AS parsed"),
)
register(
    "sc_round",
    trips(
        lambda: {
            "one": C.rnd(F.col("trip_distance") / 3, 1),
            "two": C.rnd(F.col("fare_amount") / 8, 2),
            "three": C.rnd(F.col("tip_amount") / 7, 3),
        }
    ),
    sql(f"{r('trip_distance / 3', 1)} AS one, {r('fare_amount / 8', 2)} AS two, {r('tip_amount / 7', 3)} AS three"),
)
register(
    "sc_null_math",
    lambda s, d: roles.copy_e(s, d).select(
        "trip_id",
        C.first_of("payment_type", "passenger_count").alias("first_of"),
        F.nullif("passenger_count", F.lit(0)).alias("not_zero"),
        C.capped("fare_amount", 100).alias("capped"),
    ),
    sql("""coalesce(payment_type, passenger_count) AS first_of, nullif(passenger_count, 0) AS not_zero,
      least(fare_amount, 100) AS capped""", "copy_e", "copy_e"),
)
register(
    "sc_activity",
    trips(
        lambda: {
            "stream_score": C.stream_activity_score("passenger_count", "total_amount", "payment_type"),
            "serving_score": C.serving_activity_score("passenger_count", "total_amount"),
        }
    ),
    sql("""passenger_count * 0.4 + total_amount / 100 * 0.4 + payment_type * 0.2 AS stream_score,
      least(passenger_count * 10 + total_amount / 10, 100) AS serving_score"""),
    "stream_score serving_score",
)
register(
    "sc_hour_label",
    trips(lambda: {"label": C.hour_label(F.hour("pickup_datetime"))}),
    sql("CAST(hour(pickup_datetime) AS VARCHAR) || ':00' AS label"),
)
register(
    "sc_fahrenheit",
    lambda s, d: roles.weather_h(s, d).select(
        "timestamp", C.to_fahrenheit(F.col("temperature_celsius") / 3).alias("temperature_fahrenheit")
    ),
    q("weather_h", f"""SELECT "timestamp", {r("temperature_celsius / 3 * 9 / 5 + 32", 2)} AS temperature_fahrenheit
      FROM weather_h"""),
)
_NAMES = """CASE WHEN location_id % 7 = 0 THEN 'North Airport' WHEN location_id % 7 = 1 THEN 'Union Square'
  WHEN location_id % 7 = 2 THEN 'Midtown East' ELSE zone END"""
register(
    "sc_zone_attrs",
    lambda s, d: roles.zones_c(s, d)
    .select("location_id", F.expr(_NAMES).alias("zone"))
    .withColumns(C.zone_attrs("zone")),
    q("zones_c", f"""SELECT location_id, zone, CASE WHEN lower(zone) LIKE '%airport%' THEN 'airport'
      ELSE 'neighborhood' END AS zone_type,
      zone IN ('Times Square', 'Central Park', 'Greenwich Village', 'Union Square') AS is_tourist_area,
      zone IN ('Financial District', 'Midtown East', 'Midtown West') AS is_business_district
      FROM (SELECT location_id, {_NAMES} AS zone FROM zones_c)"""),
)
register(
    "sc_total",
    lambda s, d: roles.copy_e(s, d).select(
        "trip_id", C.total("fare_amount", "tip_amount", "payment_type").alias("total")
    ),
    sql("fare_amount + tip_amount + coalesce(payment_type, 0) AS total", "copy_e", "copy_e"),
    "total",
)
register(
    "sc_topic_route",
    lambda s, d: roles.changes_e(s, d).select("offset", "topic", C.route_topic("topic").alias("target")),
    q("changes", """SELECT "offset", 'shop.public.' || source_table AS topic, 'taxi_cdc.' || source_table AS target
      FROM changes"""),
)
