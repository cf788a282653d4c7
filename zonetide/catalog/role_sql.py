"""The role views of `sources/roles.py` as SQL, for the oracle engine."""

from __future__ import annotations

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_TIP = "CASE WHEN event_id % 4 = 0 THEN value * CAST(0.2 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"


def _epoch_hour(ts: str) -> str:
    return f"(CAST(epoch({ts}) AS BIGINT) // 3600)"


def _weather(source: str) -> str:
    h = _epoch_hour("ht")
    return f"""SELECT ht AS "timestamp",
  list_extract(['clear','cloudy','rain','snow','fog','haze'], CAST({h} % 6 + 1 AS BIGINT)) AS weather_condition,
  CAST({h} % 47 - 10 AS DOUBLE) AS temperature_celsius,
  CAST({h} * 7 % 61 + 30 AS DOUBLE) AS humidity_percent,
  CAST({h} * 3 % 16 AS DOUBLE) AS wind_speed_kmh
  FROM (SELECT DISTINCT CAST(date_trunc('hour', {source.split()[0]}) AS TIMESTAMP) AS ht FROM {source.split()[1]})"""


def _zones(table: str, key: str, name: str, nation: str, kind: str, tourist: str, business: str) -> str:
    return f"""SELECT {key} AS location_id, {name} AS zone,
  CASE r_name WHEN 'AFRICA' THEN 'Manhattan' WHEN 'AMERICA' THEN 'Brooklyn' WHEN 'ASIA' THEN 'Queens'
    WHEN 'EUROPE' THEN 'Bronx' ELSE 'Staten Island' END AS borough,
  {kind} AS zone_type,
  CAST(40 AS DOUBLE) + ({key} % 97) * CAST(0.01 AS DOUBLE) AS latitude,
  CAST(-74 AS DOUBLE) + ({key} % 89) * CAST(0.01 AS DOUBLE) AS longitude,
  {tourist} AS is_tourist_area, {business} AS is_business_district
  FROM {table} JOIN nation ON {nation} = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


ROLES: dict[str, str] = {
    "trips_e": f"""SELECT event_id AS trip_id, event_type AS vendor_id, ts AS pickup_datetime,
  ts + to_minutes(event_id % 90) AS dropoff_datetime, CAST(event_id % 8 AS INTEGER) AS passenger_count,
  CAST({_K} AS DOUBLE) / 4 AS trip_distance, user_id AS pickup_location_id,
  user_id + {_K} * 3 AS dropoff_location_id, CAST(event_id % 4 + 1 AS INTEGER) AS payment_type,
  value AS fare_amount, {_TIP} AS tip_amount, value + {_TIP} + CAST(0.5 AS DOUBLE) AS total_amount
  FROM events""",
    "raw_o": """SELECT CAST(l_linenumber % 2 + 1 AS INTEGER) AS "VendorID", o_orderdate AS tpep_pickup_datetime,
  l_shipdate AS tpep_dropoff_datetime, l_linenumber AS passenger_count, l_quantity AS trip_distance,
  1 AS "RatecodeID", l_linestatus AS store_and_fwd_flag, CAST(l_suppkey AS INTEGER) AS "PULocationID",
  CAST(o_custkey AS INTEGER) AS "DOLocationID", CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_type,
  l_extendedprice AS fare_amount, CAST(0 AS DOUBLE) AS extra, l_extendedprice * l_tax AS mta_tax,
  l_extendedprice * l_discount AS tip_amount, CAST(0 AS DOUBLE) AS tolls_amount,
  CAST(0 AS DOUBLE) AS improvement_surcharge,
  l_extendedprice + l_extendedprice * l_tax + l_extendedprice * l_discount AS total_amount,
  CAST(0 AS DOUBLE) AS congestion_surcharge, CAST(0 AS DOUBLE) AS airport_fee
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "trips_o": """SELECT "VendorID" AS vendor_id, tpep_pickup_datetime AS pickup_datetime,
  tpep_dropoff_datetime AS dropoff_datetime, passenger_count, trip_distance, "RatecodeID" AS rate_code_id,
  store_and_fwd_flag, "PULocationID" AS pickup_location_id, "DOLocationID" AS dropoff_location_id, payment_type,
  fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount, congestion_surcharge,
  airport_fee FROM raw_o""",
    "zones_c": _zones(
        "customer", "c_custkey", "c_name", "c_nationkey",
        "CASE c_mktsegment WHEN 'MACHINERY' THEN 'airport' WHEN 'FURNITURE' THEN 'neighborhood' "
        "ELSE lower(c_mktsegment) END",
        "c_mktsegment = 'AUTOMOBILE'", "c_mktsegment = 'BUILDING'",
    ),
    "zones_s": _zones(
        "supplier", "s_suppkey", "s_name", "s_nationkey",
        "CASE WHEN s_suppkey % 5 = 0 THEN 'airport' WHEN s_suppkey % 5 = 1 THEN 'neighborhood' ELSE 'district' END",
        "s_suppkey % 5 = 2", "s_suppkey % 5 = 3",
    ),
    "weather_h": _weather("ts events"),
    "weather_o": _weather("o_orderdate orders"),
    "weather_raw": """SELECT "timestamp" + to_minutes(CASE load_no WHEN 3 THEN 0 ELSE load_no * 10 END) AS "timestamp",
  weather_condition, temperature_celsius + load_no AS temperature_celsius, humidity_percent, wind_speed_kmh,
  TIMESTAMP '2024-02-01 00:00:00' + to_days(CAST(load_no // 2 AS INTEGER)) AS load_date
  FROM weather_h CROSS JOIN (SELECT unnest([1, 2, 3]) AS load_no)""",
    # Changes as they look once parsed; `bad` marks the rows cut off in the damaged copy.
    "changes": f"""SELECT ts AS "timestamp", event_id AS "offset",
  CASE event_type WHEN 'signup' THEN 'c' WHEN 'click' THEN 'u' WHEN 'purchase' THEN 'u' WHEN 'error' THEN 'd'
    WHEN 'view' THEN 'r' END AS op,
  CAST(epoch_us(ts) AS BIGINT) // 1000 AS ts_ms, 'shop' AS source_db,
  list_extract(['trips','vendors','payment_types'], CAST({_K} % 3 + 1 AS BIGINT)) AS source_table,
  user_id AS id, CAST({_K} % 3 AS INTEGER) AS vendor_id,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS pickup_datetime,
  strftime(ts + INTERVAL 15 MINUTE, '%Y-%m-%dT%H:%M:%S') AS dropoff_datetime,
  user_id % 20 AS pickup_location_id, {_K} AS dropoff_location_id, CAST({_K} AS DOUBLE) / 4 AS trip_distance,
  value AS fare_amount, value + CAST(0.5 AS DOUBLE) AS total_amount, {_K} % 10 = 3 AS bad
  FROM events""",
    "copy_e": """SELECT * REPLACE (
    CASE WHEN trip_id % 40 = 5 THEN fare_amount + 1 ELSE fare_amount END AS fare_amount,
    CASE WHEN trip_id % 60 <> 11 THEN payment_type END AS payment_type)
  FROM trips_e WHERE trip_id % 50 <> 7""",
}
NEEDS = {"trips_o": ["raw_o"], "weather_raw": ["weather_h"], "copy_e": ["trips_e"]}


def with_roles(roles: str, body: str, **ctes: str) -> str:
    """A query over named roles (blank-separated) and extra common table expressions, in the order given."""
    names: list[str] = []
    for role in roles.split():
        for name in [*NEEDS.get(role, []), role]:
            if name not in names:
                names.append(name)
    parts = [f"{n} AS ({ROLES[n]})" for n in names] + [f"{n} AS ({q})" for n, q in ctes.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def r(expr: str, digits: int) -> str:
    """Rounding half up without float noise, the oracle side of `columns.rnd`."""
    return f"CAST(round(CAST(({expr}) AS DECIMAL(38,9)), {digits}) AS DOUBLE)"
