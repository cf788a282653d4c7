"""Change records and window aggregates (batch form)."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonetide.catalog.registry import register
from zonetide.catalog.role_sql import with_roles as q
from zonetide.operators import changes as X
from zonetide.operators import filters as P
from zonetide.operators import quality as D
from zonetide.operators import rollups as A
from zonetide.plans import serving as S
from zonetide.sources import roles
from zonetide.streaming import windows as W

_META = """"timestamp", "offset", op, ts_ms, source_db, source_table, ts_ms AS source_ts_ms"""
_ROW = """id, vendor_id, pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id, trip_distance,
  fare_amount, total_amount"""
_NO_ROW = ", ".join(
    f"CASE WHEN op <> 'd' THEN {c.strip()} END AS {c.strip()}" for c in _ROW.replace("\n", " ").split(",")
)


def envelopes(s, d):
    return X.parse_envelope(roles.changes_e(s, d))


def payloads(s, d):
    return X.parse_payload(envelopes(s, d))


def flat(s, d):
    return X.flatten_change(envelopes(s, d))


register(
    "cdc_envelope",
    lambda s, d: envelopes(s, d).select(
        "timestamp", "offset", "op", "ts_ms", "source_db", "source_table", "source_ts_ms",
        F.col("before").isNotNull().alias("has_before"), F.col("after").isNotNull().alias("has_after"),
    ),
    q("changes", f"SELECT {_META}, op = 'd' AS has_before, op <> 'd' AS has_after FROM changes"),
)
register("cdc_payload", payloads, q("changes", f"SELECT {_META}, {_NO_ROW} FROM changes"))
register(
    "cdc_filter",
    lambda s, d: P.keep_ops(X.parse_envelope(roles.changes_e(s, d), fields=("op", "ts_ms"))).select(
        "offset", "op", "ts_ms"
    ),
    q("changes", """SELECT "offset", op, ts_ms FROM changes WHERE op IN ('c', 'u', 'r')"""),
)
register(
    "filter_ops",
    lambda s, d: P.keep_ops(X.parse_envelope(roles.changes_e(s, d), fields=("op",)), ("c", "u")).select("offset", "op"),
    q("changes", """SELECT "offset", op FROM changes WHERE op IN ('c', 'u')"""),
)
register(
    "filter_change_rows",
    lambda s, d: P.valid_changes(payloads(s, d)).select("offset", "pickup_location_id", "fare_amount"),
    q("changes", """SELECT "offset", pickup_location_id, fare_amount FROM changes
      WHERE op <> 'd' AND pickup_location_id IS NOT NULL AND fare_amount > 0"""),
)
register(
    "cdc_flatten",
    flat,
    q("changes", f"""SELECT "timestamp", "offset", {_ROW}, op AS __op, ts_ms AS __source_ts_ms,
      source_db AS __source_db, source_table AS __source_table, op = 'd' AS __deleted FROM changes"""),
)


def _route(s, d):
    """Every record is read and parsed once, whatever the number of targets."""
    rows = X.parse_envelope(roles.changes_e(s, d), keep=("topic", "offset"), fields=("op",))
    routed = X.with_target(rows).filter(F.col("target").isin(*[f"taxi_cdc.{t}" for t in roles.CHANGE_TABLES]))
    return routed.groupBy("target", "op").agg(A.n_rows().alias("cnt"), F.max("offset").alias("last_offset"))


register(
    "cdc_route",
    _route,
    q("changes", """SELECT 'taxi_cdc.' || source_table AS target, op, count(*) AS cnt, max("offset") AS last_offset
      FROM changes GROUP BY 1, 2"""),
)
register(
    "cdc_typed",
    lambda s, d: X.type_change(
        flat(s, d).withColumn("updated_micros", F.col("__source_ts_ms") * 1000),
        money=["fare_amount", "total_amount"], coordinates=["trip_distance"], micros=["updated_micros"],
        texts=["pickup_datetime"],
    ).select("offset", "fare_amount", "total_amount", "trip_distance", "updated_micros", "pickup_datetime"),
    q("changes", """SELECT "offset", CAST(fare_amount AS DECIMAL(8,2)) AS fare_amount,
      CAST(total_amount AS DECIMAL(8,2)) AS total_amount, CAST(trip_distance AS DECIMAL(18,14)) AS trip_distance,
      make_timestamp(ts_ms * 1000) AS updated_micros, CAST(date_trunc('second', "timestamp") AS TIMESTAMP)
        AS pickup_datetime FROM changes"""),
)


def _bad(s, d):
    good, bad = X.split_bad(roles.changes_bad(s, d))
    ok = X.parse_envelope(good).select(F.col("op").alias("op"), "offset")
    aside = bad.select(F.lit("(bad)").alias("op"), "offset")
    return ok.unionByName(aside).groupBy("op").agg(A.n_rows().alias("cnt"), F.sum("offset").alias("offsets"))


register(
    "cdc_bad_records",
    _bad,
    q("changes", """SELECT CASE WHEN bad THEN '(bad)' ELSE op END AS op, count(*) AS cnt,
      CAST(sum("offset") AS BIGINT) AS offsets FROM changes GROUP BY 1"""),
)
_LATEST = "QUALIFY row_number() OVER (PARTITION BY source_table, id ORDER BY ts_ms DESC, \"offset\" DESC) = 1"
register(
    "latest_per_key",
    lambda s, d: X.latest_per_key(flat(s, d), X.ROW_KEY, ("__source_ts_ms", "offset")).select(
        "__source_table", "id", "offset", "__op", "fare_amount"
    ),
    q("changes", f"""SELECT source_table AS __source_table, id, "offset", op AS __op, fare_amount FROM changes {_LATEST}"""),
)
register(
    "cdc_current_state",
    lambda s, d: X.current_state(flat(s, d)).select(
        "__source_table", "id", "vendor_id", "pickup_datetime", "pickup_location_id", "dropoff_location_id", "trip_distance",
        "fare_amount", "total_amount",
    ),
    q("changes", f"""SELECT source_table AS __source_table, id, vendor_id, pickup_datetime, pickup_location_id,
      dropoff_location_id, trip_distance, fare_amount, total_amount FROM (SELECT * FROM changes {_LATEST}) WHERE op <> 'd'"""),
)
register(
    "cdc_op_distribution",
    lambda s, d: A.op_distribution(
        X.parse_envelope(roles.changes_e(s, d), fields=("op",)).withColumnRenamed("op", "__op"), "__op"
    ),
    q("changes", "SELECT op AS __op, count(*) AS cnt FROM changes GROUP BY 1"),
)
register(
    "dq_allowed_ops",
    lambda s, d: D.ops_allowed(X.parse_envelope(roles.changes_e(s, d), fields=("op",)), ("c", "u", "d")),
    q("changes", "SELECT op, count(*) AS cnt, op IN ('c', 'u', 'd') AS allowed FROM changes GROUP BY 1"),
)

# --- windows --------------------------------------------------------------------------------------------------------


def _window_sql(minutes: int) -> str:
    bucket = f"""CAST(time_bucket(INTERVAL {minutes} MINUTE, "timestamp") AS TIMESTAMP)"""
    return f"""SELECT {bucket} AS window_start, {bucket} + INTERVAL {minutes} MINUTE AS window_end,
      pickup_location_id AS pickup_zone_id, count(*) AS total_trips, sum(total_amount) AS total_revenue,
      avg(trip_distance) AS avg_trip_distance, avg(fare_amount) AS avg_fare_amount,
      count(DISTINCT vendor_id) AS unique_vendors FROM changes
      WHERE op <> 'd' AND pickup_location_id IS NOT NULL AND fare_amount > 0 GROUP BY {bucket}, 3"""


def trip_rows(s, d):
    return W.trip_rows(roles.changes_e(s, d))


_AGGS = "total_revenue avg_trip_distance avg_fare_amount"
register("window_5m", lambda s, d: W.trip_window_aggs(trip_rows(s, d)), q("changes", _window_sql(5)), _AGGS)
register("window_1h", lambda s, d: W.trip_window_aggs(trip_rows(s, d), "1 hour"), q("changes", _window_sql(60)), _AGGS)
ACTIVITY = """SELECT pickup_zone_id AS zone_id, window_end AS activity_timestamp, total_trips AS pickup_count,
  CAST(0 AS BIGINT) AS dropoff_count, total_revenue AS revenue_last_hour, avg_fare_amount AS avg_fare_last_hour,
  CAST(NULL AS BIGINT) AS top_destination_zone,
  total_trips * 0.4 + total_revenue / 100 * 0.4 + unique_vendors * 0.2 AS activity_score FROM aggs"""


def activity(s, d):
    return W.zone_activity(W.trip_window_aggs(trip_rows(s, d)))


register(
    "zone_activity",
    activity,
    q("changes", ACTIVITY, aggs=_window_sql(5)),
    "revenue_last_hour avg_fare_last_hour activity_score",
)
register(
    "activity_last_hour",
    lambda s, d: S.last_hour(activity(s, d), "2024-01-31 00:00:00", "30 days"),
    q("changes", """SELECT zone_id, activity_timestamp, activity_score, revenue_last_hour, pickup_count FROM activity
      WHERE activity_timestamp >= TIMESTAMP '2024-01-01 00:00:00'
      AND activity_timestamp <= TIMESTAMP '2024-01-31 00:00:00'""", aggs=_window_sql(5), activity=ACTIVITY),
    "revenue_last_hour activity_score",
)
_BUCKET = """CAST(time_bucket(INTERVAL 60 MINUTE, "timestamp") AS TIMESTAMP)"""
register(
    "window_dropoff",
    lambda s, d: W.window_dropoffs(trip_rows(s, d), "1 hour"),
    q("changes", """SELECT ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, zone_id,
      coalesce(n_in, 0) AS dropoff_count, top AS top_destination_zone FROM
      (SELECT ws, dropoff_location_id AS zone_id, count(*) AS n_in FROM t GROUP BY 1, 2) i
      FULL JOIN (SELECT ws, pickup_location_id AS zone_id, dropoff_location_id AS top FROM
        (SELECT ws, pickup_location_id, dropoff_location_id, count(*) AS n FROM t GROUP BY 1, 2, 3)
        QUALIFY row_number() OVER (PARTITION BY ws, pickup_location_id ORDER BY n DESC, dropoff_location_id) = 1) p
      USING (ws, zone_id)""",
      t=f"""SELECT {_BUCKET} AS ws, pickup_location_id, dropoff_location_id FROM changes
        WHERE op <> 'd' AND fare_amount > 0"""),
)
