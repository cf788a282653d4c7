"""Role views: the driver's star schema read as trips, zones, weather and changes.

The only place that knows driver table names. `catalog/role_sql.py` states the same roles for the oracle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonetide.functions.columns import epoch_hour, hour_of, num
from zonetide.sources.readers import driver_table

BOROUGH_OF_REGION = {
    "AFRICA": "Manhattan",
    "AMERICA": "Brooklyn",
    "ASIA": "Queens",
    "EUROPE": "Bronx",
}
ZONE_TYPE_OF_SEGMENT = {"MACHINERY": "airport", "FURNITURE": "neighborhood"}
OP_OF_EVENT = {"signup": "c", "click": "u", "purchase": "u", "error": "d", "view": "r"}
CONDITIONS = ("clear", "cloudy", "rain", "snow", "fog", "haze")
CHANGE_TABLES = ("trips", "vendors", "payment_types")


def _map(c: Column, table: dict[str, str], default) -> Column:
    start = F
    for key, value in table.items():
        start = start.when(c == key, value)
    return start.otherwise(default)


def _pick(c: Column, labels: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (c % len(labels) + 1).cast("int"))


def trips_e(spark: SparkSession, d: str) -> DataFrame:
    """Trips from events: hour grain, one row per event."""
    e = driver_table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    tip = F.when(F.col("event_id") % 4 == 0, F.col("value") * num(0.2)).otherwise(num(0))
    return e.select(
        F.col("event_id").alias("trip_id"),
        F.col("event_type").alias("vendor_id"),
        F.col("ts").alias("pickup_datetime"),
        F.expr("ts + make_dt_interval(0, 0, CAST(event_id % 90 AS INT), 0)").alias("dropoff_datetime"),
        (F.col("event_id") % 8).cast("int").alias("passenger_count"),
        (F.col("k") / 4).alias("trip_distance"),
        F.col("user_id").alias("pickup_location_id"),
        (F.col("user_id") + F.col("k") * 3).alias("dropoff_location_id"),
        (F.col("event_id") % 4 + 1).cast("int").alias("payment_type"),
        F.col("value").alias("fare_amount"),
        tip.alias("tip_amount"),
        (F.col("value") + tip + num(0.5)).alias("total_amount"),
    )


def raw_o(spark: SparkSession, d: str) -> DataFrame:
    """Raw trips (source column names) from lineitem joined with its order: day grain."""
    li = driver_table(spark, d, "lineitem")
    o = driver_table(spark, d, "orders")
    price = F.col("l_extendedprice")
    tax, tip = price * F.col("l_tax"), price * F.col("l_discount")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_linenumber") % 2 + 1).alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.col("l_linenumber").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.lit(1).alias("RatecodeID"),
        F.col("l_linestatus").alias("store_and_fwd_flag"),
        F.col("l_suppkey").cast("int").alias("PULocationID"),
        F.col("o_custkey").cast("int").alias("DOLocationID"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_type"),
        price.alias("fare_amount"),
        num(0).alias("extra"),
        tax.alias("mta_tax"),
        tip.alias("tip_amount"),
        num(0).alias("tolls_amount"),
        num(0).alias("improvement_surcharge"),
        (price + tax + tip).alias("total_amount"),
        num(0).alias("congestion_surcharge"),
        num(0).alias("airport_fee"),
    )


def trips_o(spark: SparkSession, d: str) -> DataFrame:
    """The order trips under curated names."""
    from zonetide.operators.curate import rename_trips

    return rename_trips(raw_o(spark, d))


def _zones(base: DataFrame, spark, d, key, name, nation, zone_type, tourist, business) -> DataFrame:
    n, r = driver_table(spark, d, "nation"), driver_table(spark, d, "region")
    k = F.col(key)
    return (
        base.join(n, F.col(nation) == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            k.alias("location_id"),
            F.col(name).alias("zone"),
            _map(F.col("r_name"), BOROUGH_OF_REGION, "Staten Island").alias("borough"),
            zone_type.alias("zone_type"),
            (num(40) + (k % 97) * num(0.01)).alias("latitude"),
            (num(-74) + (k % 89) * num(0.01)).alias("longitude"),
            tourist.alias("is_tourist_area"),
            business.alias("is_business_district"),
        )
    )


def zones_c(spark: SparkSession, d: str) -> DataFrame:
    """Zones from customers: pickup and drop-off zones of event trips, drop-off zones of order trips."""
    seg = F.col("c_mktsegment")
    kind = _map(seg, ZONE_TYPE_OF_SEGMENT, F.lower(seg))
    c = driver_table(spark, d, "customer")
    return _zones(
        c, spark, d, "c_custkey", "c_name", "c_nationkey", kind, seg == "AUTOMOBILE", seg == "BUILDING"
    )


def zones_s(spark: SparkSession, d: str) -> DataFrame:
    """Zones from suppliers: pickup zones of order trips."""
    k = F.col("s_suppkey") % 5
    kind = F.when(k == 0, "airport").when(k == 1, "neighborhood").otherwise("district")
    s = driver_table(spark, d, "supplier")
    return _zones(s, spark, d, "s_suppkey", "s_name", "s_nationkey", kind, k == 2, k == 3)


def _weather(hours: DataFrame) -> DataFrame:
    h = epoch_hour("timestamp")
    return hours.select(
        "timestamp",
        _pick(h, CONDITIONS).alias("weather_condition"),
        (h % 47 - 10).cast("double").alias("temperature_celsius"),
        (h * 7 % 61 + 30).cast("double").alias("humidity_percent"),
        (h * 3 % 16).cast("double").alias("wind_speed_kmh"),
    )


def weather_h(spark: SparkSession, d: str) -> DataFrame:
    """One weather row per hour that has events."""
    return _weather(driver_table(spark, d, "events").select(hour_of("ts").alias("timestamp")).distinct())


def weather_o(spark: SparkSession, d: str) -> DataFrame:
    """One weather row per order day (hour 0)."""
    return _weather(driver_table(spark, d, "orders").select(hour_of("o_orderdate").alias("timestamp")).distinct())


def weather_raw(spark: SparkSession, d: str) -> DataFrame:
    """Weather as loaded: every hour three times, warmer with each later load, once more ten minutes later."""
    w = weather_h(spark, d).withColumn("load_no", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    return w.select(
        F.expr("timestamp + make_dt_interval(0, 0, CASE load_no WHEN 3 THEN 0 ELSE load_no * 10 END, 0)").alias(
            "timestamp"
        ),
        "weather_condition",
        (F.col("temperature_celsius") + F.col("load_no")).alias("temperature_celsius"),
        "humidity_percent",
        "wind_speed_kmh",
        F.expr("TIMESTAMP '2024-02-01 00:00:00' + make_dt_interval(CAST(load_no DIV 2 AS INT), 0, 0, 0)").alias("load_date"),
    )


def _changes(spark: SparkSession, d: str) -> DataFrame:
    e = driver_table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    op = _map(F.col("event_type"), OP_OF_EVENT, None)
    ts_ms = F.unix_millis("ts")
    payload = F.struct(
        F.col("user_id").alias("id"),
        (F.col("k") % 3).cast("int").alias("vendor_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("pickup_datetime"),
        F.date_format(F.expr("ts + INTERVAL 15 minutes"), "yyyy-MM-dd'T'HH:mm:ss").alias("dropoff_datetime"),
        (F.col("user_id") % 20).alias("pickup_location_id"),
        F.col("k").alias("dropoff_location_id"),
        (F.col("k") / 4).alias("trip_distance"),
        F.col("value").alias("fare_amount"),
        (F.col("value") + num(0.5)).alias("total_amount"),
    )
    deleted = op == "d"
    envelope = F.struct(
        op.alias("op"),
        ts_ms.alias("ts_ms"),
        F.when(deleted, payload).alias("before"),
        F.when(~deleted, payload).alias("after"),
        F.struct(
            F.lit("shop").alias("db"), _pick(F.col("k"), CHANGE_TABLES).alias("table"), ts_ms.alias("ts_ms")
        ).alias("source"),
    )
    return e.select(
        F.concat(F.lit("shop.public."), _pick(F.col("k"), CHANGE_TABLES)).alias("topic"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.to_json(envelope).alias("value"),
        "k",
    )


def changes_e(spark: SparkSession, d: str) -> DataFrame:
    """Broker rows: one envelope per event, keyed by user; deletes carry `before` only."""
    return _changes(spark, d).drop("k")


def changes_bad(spark: SparkSession, d: str) -> DataFrame:
    """Broker rows of which every tenth payload value is cut off in the middle."""
    whole = F.col("value")
    cut = F.when(F.col("k") % 10 == 3, F.substring(whole, 1, 25)).otherwise(whole)
    return _changes(spark, d).withColumn("value", cut).drop("k")


def copy_e(spark: SparkSession, d: str) -> DataFrame:
    """A copy of the event trips with planted faults: missing rows, changed fares, changed payment types."""
    t = trips_e(spark, d)
    k = F.col("trip_id")
    return t.filter(k % 50 != 7).select(
        *[c for c in t.columns if c not in ("fare_amount", "payment_type")],
        F.when(k % 40 == 5, F.col("fare_amount") + 1).otherwise(F.col("fare_amount")).alias("fare_amount"),
        F.when(k % 60 != 11, F.col("payment_type")).alias("payment_type"),
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
