"""Sources, tables, filters and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonetide.catalog.registry import ALL_EVENTS, AS_OF, DAY, EVENTS_FROM, EVENTS_TO, register
from zonetide.catalog.role_sql import with_roles as q
from zonetide.functions import columns as C
from zonetide.operators import changes as X
from zonetide.operators import curate as U
from zonetide.operators import filters as P
from zonetide.operators import joins as J
from zonetide.operators import ordering as T
from zonetide.operators import quality as D
from zonetide.operators import rollups as A
from zonetide.sources import readers, roles, schemas
from zonetide.tables import store as K

HOUR = """CAST(date_trunc('hour', pickup_datetime) AS TIMESTAMP)"""
DATE = "CAST(pickup_datetime AS DATE)"
HOUR_NO = "CAST(hour(pickup_datetime) AS INTEGER)"

# --- sources --------------------------------------------------------------------------------------------------------

register(
    "src_parquet",
    lambda s, d: readers.read_trips(s, f"{d}/events.parquet", schemas.TABLES["events"]),
    "SELECT event_id, ts, user_id, event_type, value, props FROM events",
)


def _control(s, d):
    """Control table as it would be after loading up to each event type's median day: one mark per table name."""
    e = readers.driver_table(s, d, "events")
    return e.groupBy(F.col("event_type").alias("table_name")).agg(
        F.expr("date_trunc('day', min(ts)) + INTERVAL 15 days").alias("last_processed_date"),
        F.max("ts").alias("last_updated"),
    )


CONTROL = """SELECT event_type AS table_name,
  CAST(date_trunc('day', min(ts)) AS TIMESTAMP) + INTERVAL 15 DAY AS last_processed_date, max(ts) AS last_updated
  FROM events GROUP BY event_type"""

register(
    "incremental_read",
    lambda s, d: readers.incremental(
        roles.trips_e(s, d), _control(s, d), "click", "pickup_datetime", AS_OF
    ).select("trip_id", "pickup_datetime", "fare_amount"),
    q("trips_e", """SELECT trip_id, pickup_datetime, fare_amount FROM trips_e
      WHERE pickup_datetime > (SELECT last_processed_date FROM control WHERE table_name = 'click')""", control=CONTROL),
)

# --- tables ---------------------------------------------------------------------------------------------------------

def _append(s, d):
    old = roles.trips_e(s, d).select("trip_id", "pickup_datetime", "fare_amount")
    new = roles.trips_e(s, d).select(
        (F.col("trip_id") + 1_000_000_000).alias("trip_id"), "fare_amount", "payment_type"
    )
    return K.union_evolving(old, new)


register(
    "append_evolve",
    _append,
    q("trips_e", """SELECT trip_id, pickup_datetime, fare_amount, CAST(NULL AS INTEGER) AS payment_type FROM trips_e
      UNION ALL SELECT trip_id + 1000000000, NULL, fare_amount, payment_type FROM trips_e"""),
)


def _refresh_range(s, d):
    """The second half of the month is replaced by a reload with fares one higher; running it twice changes nothing."""
    old = roles.trips_e(s, d).select("trip_id", "pickup_datetime", "fare_amount")
    cond = F.col("pickup_datetime") >= C.moment("2024-01-16 00:00:00")
    new = old.filter(cond).withColumn("fare_amount", F.col("fare_amount") + 1)
    return K.replaced(K.replaced(old, new, cond), new, cond)


register(
    "refresh_range",
    _refresh_range,
    q("trips_e", """SELECT trip_id, pickup_datetime,
      CASE WHEN pickup_datetime >= TIMESTAMP '2024-01-16 00:00:00' THEN fare_amount + 1 ELSE fare_amount END
        AS fare_amount FROM trips_e"""),
)

register(
    "control_upsert",
    lambda s, d: K.upsert_marks(
        _control(s, d).filter(F.col("table_name") != "view"),
        roles.trips_e(s, d).groupBy(F.col("vendor_id").alias("table_name")).agg(
            F.max("pickup_datetime").alias("last_processed_date"),
            F.expr("max(pickup_datetime) + INTERVAL 1 hour").alias("last_updated"),
        ),
    ),
    """SELECT event_type AS table_name, max(ts) AS last_processed_date, max(ts) + INTERVAL 1 HOUR AS last_updated
       FROM events GROUP BY event_type""",
)


def _base_trips(s, d):
    return roles.trips_e(s, d).select(
        F.col("trip_id").alias("id"), "fare_amount", C.num(0.5).alias("extra"), C.num(0.5).alias("mta_tax"),
        "tip_amount", C.num(0).alias("tolls_amount"), (F.col("total_amount") + 0.5).alias("total_amount"),
        F.col("pickup_datetime").alias("updated_at"),
    )


def _apply_updates(s, d):
    """Every purchase gets a second tip update an hour after a first one."""
    t = roles.trips_e(s, d).filter(F.col("vendor_id") == "purchase")
    updates = t.select(
        F.col("trip_id").alias("id"), F.explode(F.array(F.lit(1), F.lit(2))).alias("no"), "trip_distance",
        "dropoff_datetime",
    ).select(
        "id", (F.col("trip_distance") + F.col("no")).alias("tip_amount"),
        F.expr("dropoff_datetime + make_dt_interval(0, no, 0, 0)").alias("updated_at"),
    )
    return X.apply_updates(_base_trips(s, d), updates)


register(
    "apply_updates",
    _apply_updates,
    q("trips_e", """SELECT trip_id AS id, fare_amount, CAST(0.5 AS DOUBLE) AS extra, CAST(0.5 AS DOUBLE) AS mta_tax,
      CASE WHEN vendor_id = 'purchase' THEN trip_distance + 2 ELSE tip_amount END AS tip_amount,
      CAST(0 AS DOUBLE) AS tolls_amount,
      CASE WHEN vendor_id = 'purchase' THEN fare_amount + 1.0 + trip_distance + 2 ELSE total_amount + 0.5 END
        AS total_amount,
      CASE WHEN vendor_id = 'purchase' THEN dropoff_datetime + INTERVAL 2 HOUR ELSE pickup_datetime END AS updated_at
      FROM trips_e"""),
    "tip_amount total_amount",
)

VENDOR_STATS = f"""SELECT {HOUR} AS "hour", vendor_id, count(*) AS trip_count,
  CAST(sum(passenger_count) AS BIGINT) AS total_passengers, avg(trip_distance) AS avg_distance,
  sum(fare_amount) AS total_fare, avg(fare_amount) AS avg_fare, count(DISTINCT payment_type) AS payment_types_used
  FROM trips_e GROUP BY 1, 2"""


def _matview(s, d):
    """A stored rollup of the first half month brought up to date by recomputing the hours after it."""
    t = roles.trips_e(s, d)
    cut = C.moment("2024-01-16 00:00:00")
    stored = A.hourly_vendor_stats(t.filter(F.col("pickup_datetime") < cut))
    fresh = A.hourly_vendor_stats(t.filter(F.col("pickup_datetime") >= cut))
    return K.replaced(stored, fresh, F.col("hour") >= cut)


register("matview_refresh", _matview, q("trips_e", VENDOR_STATS), "avg_distance total_fare avg_fare")

# --- curation and filters -------------------------------------------------------------------------------------------

VALID = """tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL AND trip_distance > 0
  AND fare_amount > 0 AND total_amount > 0 AND passenger_count BETWEEN 1 AND 6"""

register(
    "curate_trips",
    lambda s, d: U.curate_trips(roles.raw_o(s, d)).drop("load_date"),
    q("raw_o trips_o", """SELECT *, CAST(year(pickup_datetime) AS INTEGER) AS "year",
      CAST(month(pickup_datetime) AS INTEGER) AS "month", CAST(day(pickup_datetime) AS INTEGER) AS "day" FROM trips_o
      WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL AND trip_distance > 0 AND fare_amount > 0
      AND total_amount > 0 AND passenger_count BETWEEN 1 AND 6"""),
    "mta_tax tip_amount total_amount",
)
register(
    "date_parts",
    lambda s, d: U.with_date_parts(roles.trips_e(s, d).select("trip_id", "pickup_datetime"), "pickup_datetime"),
    q("trips_e", """SELECT trip_id, pickup_datetime, CAST(year(pickup_datetime) AS INTEGER) AS "year",
      CAST(month(pickup_datetime) AS INTEGER) AS "month", CAST(day(pickup_datetime) AS INTEGER) AS "day"
      FROM trips_e"""),
)
register(
    "clean_trips",
    lambda s, d: U.clean_trips(roles.raw_o(s, d))
    .groupBy("passenger_count", "payment_type")
    .agg(A.n_rows().alias("n"), F.sum("total_amount").alias("total_amount")),
    q("raw_o", f"""SELECT passenger_count, payment_type, count(*) AS n, sum(total_amount) AS total_amount FROM raw_o
      WHERE {VALID} GROUP BY 1, 2"""),
    "total_amount",
)
register(
    "filter_positive",
    lambda s, d: P.positive(roles.trips_e(s, d), ["fare_amount", "trip_distance"]).select(
        "trip_id", "fare_amount", "trip_distance"
    ),
    q("trips_e", """SELECT trip_id, fare_amount, trip_distance FROM trips_e
      WHERE fare_amount > 0 AND trip_distance > 0"""),
)
register(
    "filter_trailing",
    lambda s, d: P.trailing_each(
        roles.trips_e(s, d).select("trip_id", "pickup_datetime"), "pickup_datetime", AS_OF,
        ("240 minutes", "24 hours", "1 day", "7 days", "30 days"),
    ).select("length", "trip_id", "pickup_datetime"),
    q("trips_e", f"""SELECT len AS "length", trip_id, pickup_datetime FROM trips_e JOIN lens
      ON pickup_datetime >= TIMESTAMP '{AS_OF}' - iv AND pickup_datetime <= TIMESTAMP '{AS_OF}'""",
      lens="""SELECT * FROM (VALUES ('240 minutes', INTERVAL 240 MINUTE), ('24 hours', INTERVAL 24 HOUR),
        ('1 day', INTERVAL 1 DAY), ('7 days', INTERVAL 7 DAY), ('30 days', INTERVAL 30 DAY)) v(len, iv)"""),
)
register(
    "filter_range",
    lambda s, d: P.in_range(
        roles.trips_e(s, d), "pickup_datetime", "2024-01-05 12:00:00", "2024-01-25 12:00:00"
    ).select("trip_id", "pickup_datetime"),
    q("trips_e", """SELECT trip_id, pickup_datetime FROM trips_e
      WHERE pickup_datetime BETWEEN TIMESTAMP '2024-01-05 12:00:00' AND TIMESTAMP '2024-01-25 12:00:00'"""),
)
register(
    "filter_today",
    lambda s, d: P.on_day(roles.trips_e(s, d), "pickup_datetime", DAY).select("trip_id", "pickup_datetime"),
    q("trips_e", f"SELECT trip_id, pickup_datetime FROM trips_e WHERE {DATE} = DATE '{DAY}'"),
)
register(
    "filter_min_activity",
    lambda s, d: P.min_activity(A.hourly_demand(roles.trips_e(s, d)), "demand_count", 1),
    q("trips_e", f"""SELECT pickup_location_id AS location_id, {HOUR} AS hour_timestamp, count(*) AS demand_count
      FROM trips_e GROUP BY 1, 2 HAVING count(*) > 1"""),
)
register(
    "fill_defaults",
    lambda s, d: U.fill_defaults(
        J.join_zone(
            roles.trips_e(s, d).select("trip_id", F.col("dropoff_location_id").alias("location_id"), "fare_amount"),
            roles.zones_s(s, d), "location_id", ["zone", "borough", "latitude"],
        ),
        {"zone": "Unknown Zone", "borough": "unknown", "latitude": 20.0},
    ),
    q("trips_e zones_s", """SELECT trip_id, dropoff_location_id AS location_id, fare_amount,
      coalesce(zone, 'Unknown Zone') AS zone, coalesce(borough, 'unknown') AS borough,
      coalesce(latitude, CAST(20 AS DOUBLE)) AS latitude
      FROM trips_e LEFT JOIN zones_s ON dropoff_location_id = location_id"""),
    "latitude",
)
register(
    "filter_composed",
    lambda s, d: P.apply_filters(
        J.join_weather_hour(
            J.join_zone(roles.trips_e(s, d), roles.zones_c(s, d), "pickup_location_id", ["borough"]).withColumn(
                "hour_timestamp", C.hour_of("pickup_datetime")
            ),
            roles.weather_h(s, d), "hour_timestamp", ["weather_condition"], AS_OF, ALL_EVENTS,
        ),
        dates=(EVENTS_FROM, EVENTS_TO),
        borough=["Manhattan", "Queens"],
        conditions=["rain", "snow", "fog"],
        fares=(10, 50),
    ).select("trip_id", "pickup_location_id", "borough", "weather_condition", "fare_amount"),
    q("trips_e zones_c weather_h", f"""SELECT trip_id, pickup_location_id, borough, weather_condition, fare_amount
      FROM trips_e LEFT JOIN zones_c ON pickup_location_id = location_id LEFT JOIN weather_h ON "timestamp" = {HOUR}
      WHERE pickup_datetime BETWEEN TIMESTAMP '{EVENTS_FROM}' AND TIMESTAMP '{EVENTS_TO}'
      AND borough IN ('Manhattan', 'Queens') AND weather_condition IN ('rain', 'snow', 'fog')
      AND fare_amount BETWEEN 10 AND 50"""),
)


def _raw_zones(s, d):
    z = roles.zones_c(s, d)
    stamp = F.when(F.col("location_id") % 9 == 4, "not a time").otherwise("2025-08-03T09:25:21.645661")
    return z.withColumnsRenamed({"latitude": "lat", "longitude": "lon"}).withColumn("created_at", stamp)


register(
    "rename_zone",
    lambda s, d: U.curate_zones(_raw_zones(s, d)).drop("load_date"),
    q("zones_c", """SELECT location_id, zone, borough, zone_type, latitude, longitude, is_tourist_area,
      is_business_district, CASE WHEN location_id % 9 = 4 THEN NULL ELSE TIMESTAMP '2025-08-03 09:25:21.645661' END
      AS created_at FROM zones_c"""),
    "latitude longitude",
)


def _raw_weather(s, d):
    text = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    w = roles.weather_h(s, d)
    return w.withColumn("timestamp", F.when(F.col("humidity_percent") == 30, "soon").otherwise(text))


register(
    "clean_weather",
    lambda s, d: U.curate_weather(_raw_weather(s, d)).drop("load_date"),
    q("weather_h", """SELECT *, CAST(year("timestamp") AS INTEGER) AS "year",
      CAST(month("timestamp") AS INTEGER) AS "month", CAST(day("timestamp") AS INTEGER) AS "day" FROM weather_h
      WHERE humidity_percent <> 30"""),
)
register(
    "recent_trips_cols",
    lambda s, d: T.recent_trips(roles.trips_e(s, d), AS_OF, 168, 1000),
    q("trips_e", f"""SELECT trip_id, vendor_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance,
      pickup_location_id, dropoff_location_id, fare_amount, tip_amount, total_amount, payment_type FROM trips_e
      WHERE pickup_datetime >= TIMESTAMP '{AS_OF}' - INTERVAL 168 HOUR AND pickup_datetime <= TIMESTAMP '{AS_OF}'
      ORDER BY pickup_datetime DESC, trip_id DESC LIMIT 1000"""),
)

# --- joins ----------------------------------------------------------------------------------------------------------

_W = "weather_condition, temperature_celsius, humidity_percent, wind_speed_kmh"

register(
    "join_hourly_parts",
    lambda s, d: J.join_weather_parts(
        roles.trips_e(s, d).select(
            "trip_id", F.to_date("pickup_datetime").alias("trip_date"), F.hour("pickup_datetime").alias("hour")
        ),
        roles.weather_h(s, d),
        as_of=AS_OF,
        length=ALL_EVENTS,
    ),
    q("trips_e weather_h", f"""SELECT trip_id, {DATE} AS trip_date, {HOUR_NO} AS "hour", {_W} FROM trips_e
      LEFT JOIN weather_h ON {DATE} = CAST("timestamp" AS DATE) AND hour(pickup_datetime) = hour("timestamp")"""),
)
register(
    "join_hourly_trunc",
    lambda s, d: J.join_weather_hour(
        roles.trips_e(s, d).select("trip_id", C.hour_of("pickup_datetime").alias("hour_timestamp")),
        roles.weather_raw(s, d),
        "hour_timestamp",
        as_of=AS_OF,
        length=ALL_EVENTS,
    ),
    q("trips_e weather_raw", f"""SELECT trip_id, {HOUR} AS hour_timestamp, {_W} FROM trips_e LEFT JOIN best
      ON {HOUR} = date_trunc('hour', "timestamp")""",
      best="""SELECT * FROM weather_raw QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', "timestamp")
        ORDER BY load_date DESC, "timestamp" DESC) = 1"""),
)
register(
    "join_zone",
    lambda s, d: J.join_zone(
        roles.trips_o(s, d).select("pickup_location_id", "pickup_datetime", "fare_amount"),
        roles.zones_s(s, d), "pickup_location_id", ["zone", "borough"],
    ).groupBy("borough", "zone").agg(A.n_rows().alias("n"), F.sum("fare_amount").alias("fare_amount")),
    q("trips_o zones_s", """SELECT borough, zone, count(*) AS n, sum(fare_amount) AS fare_amount
      FROM trips_o LEFT JOIN zones_s ON pickup_location_id = location_id GROUP BY 1, 2"""),
    "fare_amount",
)
register(
    "join_zone_twice",
    lambda s, d: J.join_both_zones(
        roles.trips_e(s, d).select("trip_id", "pickup_location_id", "dropoff_location_id"),
        roles.zones_c(s, d), ["zone", "borough"],
    ),
    q("trips_e zones_c", """SELECT trip_id, pickup_location_id, dropoff_location_id, p.zone AS pickup_zone,
      p.borough AS pickup_borough, o.zone AS dropoff_zone, o.borough AS dropoff_borough FROM trips_e
      LEFT JOIN zones_c p ON pickup_location_id = p.location_id
      LEFT JOIN zones_c o ON dropoff_location_id = o.location_id"""),
)
PICKUPS = f"""SELECT pickup_location_id AS location_id, {DATE} AS trip_date, {HOUR_NO} AS "hour",
  coalesce(weather_condition, 'unknown') AS weather_condition, count(*) AS total_pickups,
  avg(fare_amount) AS avg_fare_per_pickup,
  avg(CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100 ELSE 0 END) AS avg_tip_percentage,
  avg(trip_distance) AS avg_trip_distance
  FROM trips_e LEFT JOIN weather_h ON {HOUR} = "timestamp" GROUP BY 1, 2, 3, weather_condition"""
DROPOFFS = f"""SELECT dropoff_location_id AS location_id, {DATE} AS trip_date, {HOUR_NO} AS "hour",
  count(*) AS total_dropoffs FROM trips_e GROUP BY 1, 2, 3"""
register(
    "join_pick_drop",
    lambda s, d: J.join_pick_drop(
        A.pickup_metrics(roles.trips_e(s, d), roles.weather_h(s, d), AS_OF, ALL_EVENTS).select(
            "location_id", "trip_date", "hour", "total_pickups"
        ),
        A.dropoff_metrics(roles.trips_e(s, d)),
    ),
    q("trips_e weather_h", """SELECT p.location_id, p.trip_date, p."hour", total_pickups,
      coalesce(total_dropoffs, 0) AS total_dropoffs FROM p LEFT JOIN o ON p.location_id = o.location_id
      AND p.trip_date = o.trip_date AND p."hour" = o."hour" """, p=PICKUPS, o=DROPOFFS),
)
register(
    "join_own_stats",
    lambda s, d: J.join_own_stats(
        roles.trips_e(s, d).select("trip_id", "pickup_location_id", "dropoff_location_id", "fare_amount"),
        A.route_history(roles.trips_e(s, d)),
        ["pickup_location_id", "dropoff_location_id"],
    ),
    q("trips_e", """SELECT trip_id, pickup_location_id, dropoff_location_id, fare_amount,
      avg(fare_amount) OVER (PARTITION BY pickup_location_id, dropoff_location_id) AS avg_fare_same_route_7d,
      count(*) OVER (PARTITION BY pickup_location_id, dropoff_location_id) AS route_frequency FROM trips_e"""),
    "avg_fare_same_route_7d",
)
register(
    "join_zone_required",
    lambda s, d: J.join_required(
        roles.trips_e(s, d).select("trip_id", F.col("dropoff_location_id").alias("location_id")),
        roles.zones_s(s, d).select("location_id", "zone"), ["location_id"],
    ),
    q("trips_e zones_s", """SELECT trip_id, dropoff_location_id AS location_id, zone FROM trips_e
      LEFT JOIN zones_s ON dropoff_location_id = location_id WHERE location_id IS NOT NULL"""),
)
register(
    "expand_horizon",
    lambda s, d: J.expand_hours(A.zones_by_borough(roles.zones_c(s, d)), AS_OF, 168),
    q("zones_c", f"""SELECT borough, count(*) AS zone_count, count(*) FILTER (is_tourist_area) AS tourist_zones,
      count(*) FILTER (is_business_district) AS business_zones, TIMESTAMP '{AS_OF}' + to_hours(h) AS prediction_hour
      FROM zones_c CROSS JOIN (SELECT unnest(range(1, 169)) AS h) GROUP BY borough, h"""),
)
_DIFF = ["fare_amount", "payment_type", "total_amount"]
register(
    "reconcile_fields",
    lambda s, d: J.diff_by_key(roles.trips_e(s, d), roles.copy_e(s, d), "trip_id", _DIFF),
    q("trips_e copy_e", """SELECT coalesce(a.trip_id, b.trip_id) AS trip_id,
      a.fare_amount AS fare_amount_source, a.payment_type AS payment_type_source,
      a.total_amount AS total_amount_source, b.fare_amount AS fare_amount_copy, b.payment_type AS payment_type_copy,
      b.total_amount AS total_amount_copy,
      coalesce(b.trip_id IS NOT NULL AND a.fare_amount IS DISTINCT FROM b.fare_amount, false) AS fare_amount_differs,
      coalesce(b.trip_id IS NOT NULL AND a.payment_type IS DISTINCT FROM b.payment_type, false)
        AS payment_type_differs,
      coalesce(b.trip_id IS NOT NULL AND a.total_amount IS DISTINCT FROM b.total_amount, false)
        AS total_amount_differs,
      CASE WHEN b.trip_id IS NULL THEN 'missing_in_copy' WHEN a.fare_amount IS DISTINCT FROM b.fare_amount
        OR a.payment_type IS DISTINCT FROM b.payment_type OR a.total_amount IS DISTINCT FROM b.total_amount
        THEN 'differs' ELSE 'same' END AS status
      FROM trips_e a FULL JOIN copy_e b ON a.trip_id = b.trip_id"""),
    "total_amount_source total_amount_copy",
)
register(
    "hourly_weather_dedup",
    lambda s, d: J.dedupe_hourly(roles.weather_raw(s, d)),
    q("weather_raw", """SELECT CAST(date_trunc('hour', "timestamp") AS TIMESTAMP) AS hour_timestamp, * FROM weather_raw
      QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', "timestamp")
        ORDER BY load_date DESC, "timestamp" DESC) = 1"""),
)
register(
    "nearby_demand",
    lambda s, d: J.nearby_demand(A.hourly_demand(roles.trips_e(s, d)), roles.zones_c(s, d), 2.0),
    q("trips_e zones_c", """SELECT d.location_id, d.hour_timestamp, d.demand_count,
      CAST(coalesce(sum(o.demand_count), 0) AS BIGINT) AS nearby_zones_demand
      FROM demand d LEFT JOIN pairs p ON d.location_id = p.a
      LEFT JOIN demand o ON o.location_id = p.b AND o.hour_timestamp = d.hour_timestamp GROUP BY 1, 2, 3""",
      demand=f"""SELECT pickup_location_id AS location_id, {HOUR} AS hour_timestamp, count(*) AS demand_count
        FROM trips_e GROUP BY 1, 2""",
      pairs="""SELECT x.location_id AS a, y.location_id AS b FROM zones_c x, zones_c y
        WHERE x.location_id <> y.location_id
        AND sqrt(pow(x.latitude - y.latitude, 2) + pow(x.longitude - y.longitude, 2)) * 111 <= 2"""),
)

# --- quality --------------------------------------------------------------------------------------------------------

register(
    "dq_not_empty",
    lambda s, d: D.emptiness(
        {
            "trips": roles.trips_e(s, d),
            "weather": roles.weather_h(s, d),
            "nothing": roles.trips_e(s, d).filter(F.col("fare_amount") < 0),
        }
    ),
    q("trips_e weather_h", """SELECT 'trips' AS dataset, count(*) AS n_rows, count(*) > 0 AS passed FROM trips_e
      UNION ALL SELECT 'weather', count(*), count(*) > 0 FROM weather_h UNION ALL SELECT 'nothing', 0, false"""),
)
_REQ = ["trip_id", "pickup_datetime", "payment_type"]
register(
    "dq_required",
    lambda s, d: D.required(roles.copy_e(s, d), _REQ),
    q("copy_e", " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_missing,
        count(*) = count({c}) AS passed FROM copy_e""" for c in _REQ)),
)
_NULLS = ["trip_id", "payment_type", "fare_amount", "pickup_location_id"]
register(
    "dq_null_pct",
    lambda s, d: D.null_pct(roles.copy_e(s, d), _NULLS),
    q("copy_e", " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, (count(*) - count({c})) * CAST(100 AS DOUBLE) / count(*) AS null_pct
        FROM copy_e""" for c in _NULLS)),
    "null_pct",
)
register(
    "dq_row_counts",
    lambda s, d: D.compare_counts(
        {
            "trips": (roles.trips_e(s, d), roles.copy_e(s, d)),
            "zones": (roles.zones_c(s, d), readers.driver_table(s, d, "customer")),
        }
    ),
    q("trips_e copy_e zones_c", """SELECT 'trips' AS table_name, (SELECT count(*) FROM trips_e) AS source_rows,
      (SELECT count(*) FROM copy_e) AS copy_rows,
      (SELECT count(*) FROM trips_e) = (SELECT count(*) FROM copy_e) AS "matches"
      UNION ALL SELECT 'zones', (SELECT count(*) FROM zones_c), (SELECT count(*) FROM customer),
      (SELECT count(*) FROM zones_c) = (SELECT count(*) FROM customer)"""),
)
register(
    "dq_field_diff",
    lambda s, d: D.field_diff(roles.trips_e(s, d), roles.copy_e(s, d), "trip_id", _DIFF),
    q("trips_e copy_e", " UNION ALL ".join(
        [f"""SELECT '{c}' AS field, count(*) AS n_rows FROM trips_e a JOIN copy_e b ON a.trip_id = b.trip_id
        WHERE a.{c} IS DISTINCT FROM b.{c}""" for c in _DIFF]
        + ["SELECT '(missing in copy)', count(*) FROM trips_e WHERE trip_id NOT IN (SELECT trip_id FROM copy_e)",
           "SELECT '(missing in source)', count(*) FROM copy_e WHERE trip_id NOT IN (SELECT trip_id FROM trips_e)"])),
)
register(
    "dq_schema",
    lambda s, d: D.schema_report(
        readers.driver_table(s, d, "events"),
        "event_id bigint, ts timestamp, user_id bigint, event_type string, value int, props int, trip_id bigint",
    ),
    """SELECT 'value' AS column_name, 'int' AS expected, 'double' AS actual,
         count(*) FILTER (value IS NOT NULL AND TRY_CAST(value AS INTEGER) IS NULL) AS n_unfit FROM events
       UNION ALL SELECT 'props', 'int', 'string',
         count(*) FILTER (props IS NOT NULL AND TRY_CAST(props AS INTEGER) IS NULL) FROM events
       UNION ALL SELECT 'trip_id', 'bigint', 'missing', 0""",
)
register(
    "dq_referential",
    lambda s, d: D.orphans(roles.trips_e(s, d), roles.zones_s(s, d), "dropoff_location_id", "location_id"),
    q("trips_e zones_s", """SELECT dropoff_location_id AS missing_key, count(*) AS n_rows FROM trips_e
      WHERE dropoff_location_id NOT IN (SELECT location_id FROM zones_s) GROUP BY 1"""),
)
register(
    "dq_continuity",
    lambda s, d: D.missing_hours(readers.driver_table(s, d, "orders"), "o_orderdate"),
    """SELECT h AS missing_hour FROM (SELECT unnest(generate_series(
         (SELECT CAST(date_trunc('hour', min(o_orderdate)) AS TIMESTAMP) FROM orders),
         (SELECT CAST(date_trunc('hour', max(o_orderdate)) AS TIMESTAMP) FROM orders), INTERVAL 1 HOUR)) AS h)
       WHERE h NOT IN (SELECT CAST(date_trunc('hour', o_orderdate) AS TIMESTAMP) FROM orders)""",
)
register(
    "dq_outliers",
    lambda s, d: D.outliers(
        roles.trips_e(s, d).select("trip_id", "fare_amount", "trip_distance"), ["fare_amount", "trip_distance"], 1.5
    ),
    q("trips_e", """SELECT trip_id, fare_amount, trip_distance, fo AS fare_amount_outlier, dist_out AS trip_distance_outlier
      FROM (SELECT *, fare_amount < fa - 1.5 * fs OR fare_amount > fa + 1.5 * fs AS fo,
        trip_distance < da - 1.5 * ds OR trip_distance > da + 1.5 * ds AS dist_out
        FROM trips_e, (SELECT avg(fare_amount) fa, stddev_samp(fare_amount) fs, avg(trip_distance) da,
          stddev_samp(trip_distance) ds FROM trips_e)) WHERE fo OR dist_out"""),
)
register(
    "dq_freshness",
    lambda s, d: D.freshness(roles.trips_e(s, d), "pickup_datetime", AS_OF),
    q("trips_e", f"""SELECT max(pickup_datetime) AS newest, count(*) AS n_rows,
      (epoch(TIMESTAMP '{AS_OF}') - floor(epoch(max(pickup_datetime)))) / 60 AS age_minutes,
      count(*) / ((floor(epoch(max(pickup_datetime))) - floor(epoch(min(pickup_datetime)))) / 3600) AS rows_per_hour
      FROM trips_e"""),
    "age_minutes rows_per_hour",
)
