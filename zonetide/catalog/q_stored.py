"""Jobs of several steps over the driver's tables: streams run to their end, stored merges, rollups by day, landing.

Each stores its tables in a new work folder and returns what it stored there.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonetide.catalog import q_changes, q_core
from zonetide.catalog.registry import register
from zonetide.catalog.role_sql import with_roles as q
from zonetide.operators import changes as X
from zonetide.operators import ordering as T
from zonetide.plans import jobs as L
from zonetide.session import work_folder
from zonetide.sources import readers, roles, schemas
from zonetide.streaming import jobs as J
from zonetide.tables import store as K

BROKER = "topic string, offset bigint, timestamp timestamp, value string"
#: Partitions of the streams' state, which a stream keeps from its first start on.
STATE_PARTITIONS = 8
#: The least files of a landed log, and about how many records one holds.
FILES, ROWS_PER_FILE = 4, 100_000
#: Later than every event, so that a heartbeat of it closes all windows.
END = datetime(2024, 3, 1)


def _streams(spark: SparkSession) -> SparkSession:
    """A session beside the caller's, whose settings are the streams' own."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "UTC")
    own.conf.set("spark.sql.shuffle.partitions", str(STATE_PARTITIONS))
    return own


def _finish(*queries) -> None:
    """Wait for streams that stop at the end of what is there; a failure is raised."""
    for query in queries:
        query.awaitTermination()


def _declared(spark: SparkSession, table: str, path: str) -> DataFrame:
    schema = schemas.OUTPUT_TABLES[table][0]
    return K.conform(spark.read.schema(schema).parquet(path), schema)


def _land(records: DataFrame, path: str) -> int:
    """Change records as files that a stream reads; returns how many. A file is one task, so a larger log has more of them."""
    files = max(FILES, -(-records.count() // ROWS_PER_FILE))
    records.repartition(files, "offset").write.parquet(path)
    return files


def _landed(spark: SparkSession, sf_dir: str, name: str) -> tuple[SparkSession, str, int]:
    root = work_folder(spark, name)
    files = _land(roles.changes_e(spark, sf_dir), f"{root}/in")
    return _streams(spark), root, files


def _window_streams(spark: SparkSession, sf_dir: str, name: str, both: bool) -> tuple[SparkSession, str]:
    own, root, _ = _landed(spark, sf_dir, name)
    sides = [("aggs", J.window_stream), ("drop", J.dropoff_stream)][: 2 if both else 1]

    def run() -> None:
        for folder, stream in sides:
            broker = readers.read_file_stream(own, f"{root}/in", BROKER)
            out = stream(broker, beats=J.read_beats(own, f"{root}/beats"))
            _finish(J.start_append(out, f"{root}/{folder}", f"{root}/ck-{folder}", None, ["window_date"]))

    run()
    # The source goes quiet here: what is still open comes out by a heartbeat.
    J.beat(own, f"{root}/beats", END)
    run()
    return own, root


def _stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, root = _window_streams(spark, sf_dir, "stream-windows", both=False)
    return _declared(spark, "trip_window_aggregates", f"{root}/aggs").select(
        "window_start", "window_end", F.col("pickup_zone_id").cast("bigint").alias("pickup_zone_id"), "total_trips",
        "total_revenue", "avg_trip_distance", "avg_fare_amount", "unique_vendors",
    )


register(
    "stream_windows", _stream_windows, q("changes", q_changes._window_sql(5)), q_changes._AGGS, job=True
)


def _stream_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregates and drop-offs as two streams, the drop-offs a run later; a heartbeat closes the windows without any."""
    own, root = _window_streams(spark, sf_dir, "stream-activity", both=True)

    def run() -> None:
        aggs, drops = (
            readers.read_file_stream(own, f"{root}/{folder}", schemas.OUTPUT_TABLES[table][0])
            for table, folder in (("trip_window_aggregates", "aggs"), ("window_dropoffs", "drop"))
        )
        acts = J.activity_stream(aggs, drops, beats=J.read_beats(own, f"{root}/beats-2"))
        _finish(J.start_append(acts, f"{root}/act", f"{root}/ck-act", None, ["activity_hour"]))

    run()
    J.beat(own, f"{root}/beats-2", END)
    run()
    return _declared(spark, "zone_activity", f"{root}/act").select(
        F.col("zone_id").cast("bigint").alias("zone_id"), "activity_timestamp", "pickup_count", "dropoff_count",
        "revenue_last_hour", "avg_fare_last_hour", F.col("top_destination_zone").cast("bigint").alias("top_destination_zone"),
        "activity_score",
    )


_BUCKET = """CAST(time_bucket(INTERVAL 5 MINUTE, "timestamp") AS TIMESTAMP)"""
register(
    "stream_zone_activity",
    _stream_activity,
    q("changes", """SELECT pickup_zone_id AS zone_id, window_end AS activity_timestamp, total_trips AS pickup_count,
      coalesce(n_in, 0) AS dropoff_count, total_revenue AS revenue_last_hour, avg_fare_amount AS avg_fare_last_hour,
      top AS top_destination_zone,
      total_trips * 0.4 + total_revenue / 100 * 0.4 + unique_vendors * 0.2 AS activity_score
      FROM aggs LEFT JOIN arrivals ON arrivals.ws = window_start AND arrivals.z = pickup_zone_id
      LEFT JOIN tops ON tops.ws = window_start AND tops.z = pickup_zone_id""",
      aggs=q_changes._window_sql(5),
      t=f"""SELECT {_BUCKET} AS ws, pickup_location_id, dropoff_location_id FROM changes WHERE op <> 'd' AND fare_amount > 0
        AND pickup_location_id IS NOT NULL""",
      arrivals="SELECT ws, dropoff_location_id AS z, count(*) AS n_in FROM t GROUP BY 1, 2",
      tops="""SELECT ws, pickup_location_id AS z, dropoff_location_id AS top FROM
        (SELECT ws, pickup_location_id, dropoff_location_id, count(*) AS n FROM t GROUP BY 1, 2, 3)
        QUALIFY row_number() OVER (PARTITION BY ws, pickup_location_id ORDER BY n DESC, dropoff_location_id) = 1"""),
    "revenue_last_hour avg_fare_last_hour activity_score",
    job=True,
)


def _stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log in several micro-batches, each merged into the buckets of its keys."""
    own, root, files = _landed(spark, sf_dir, "stream-state")
    broker = readers.read_file_stream(own, f"{root}/in", BROKER, per_batch=-(-files // 2))
    log = X.flatten_change(X.parse_envelope(broker))
    # The files hold all days mixed, so a delete is remembered for the whole log.
    _finish(J.start_state(log, f"{root}/state", f"{root}/ck", forget=timedelta(days=60)))
    return J.current_rows(spark, f"{root}/state").select(
        "__source_table", "id", "vendor_id", "pickup_datetime", "pickup_location_id", "dropoff_location_id", "trip_distance",
        "fare_amount", "total_amount",
    )


register(
    "stream_current_state",
    _stream_state,
    q("changes", f"""SELECT source_table AS __source_table, id, vendor_id, pickup_datetime, pickup_location_id,
      dropoff_location_id, trip_distance, fare_amount, total_amount FROM (SELECT * FROM changes {q_changes._LATEST})
      WHERE op <> 'd'"""),
    job=True,
)


def _stream_mirrors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every mirror's rows and the records put aside, from a log of which every tenth kind is damaged."""
    root = work_folder(spark, "stream-mirrors")
    files = _land(roles.changes_bad(spark, sf_dir), f"{root}/in")
    own = _streams(spark)
    broker = readers.read_file_stream(own, f"{root}/in", BROKER, per_batch=-(-files // 4))
    _finish(J.start_mirrors(broker, f"{root}/mirrors", f"{root}/ck", merge_every=3))
    trips = J.read_mirror(spark, f"{root}/mirrors", "trips").select(
        F.lit("trips").alias("target"), F.col("__op").alias("op"), "id", "vendor_id", "pickup_date",
        F.col("fare_amount").cast("double").alias("fare_amount"), F.col("total_amount").cast("double").alias("total_amount"),
    )
    out = [trips]
    for table in ("vendors", "payment_types"):
        rows = J.read_mirror(spark, f"{root}/mirrors", table)
        out.append(rows.select(F.lit(table).alias("target"), F.col("__op").alias("op"), F.col("id").cast("bigint").alias("id")))
    out.append(J.read_mirror(spark, f"{root}/mirrors", "bad").select(F.lit("bad").alias("target")))
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


register(
    "stream_mirrors",
    _stream_mirrors,
    q("changes", """SELECT CASE WHEN bad THEN 'bad' ELSE source_table END AS target, CASE WHEN NOT bad THEN op END AS op,
      CASE WHEN NOT bad THEN id END AS id, CASE WHEN NOT bad AND source_table = 'trips' THEN vendor_id END AS vendor_id,
      CASE WHEN NOT bad AND source_table = 'trips' THEN CAST("timestamp" AS DATE) END AS pickup_date,
      CASE WHEN NOT bad AND source_table = 'trips' THEN CAST(CAST(fare_amount AS DECIMAL(8,2)) AS DOUBLE) END AS fare_amount,
      CASE WHEN NOT bad AND source_table = 'trips' THEN CAST(CAST(total_amount AS DECIMAL(8,2)) AS DOUBLE) END
        AS total_amount FROM changes"""),
    job=True,
)


# --- stored merges and rollups --------------------------------------------------------------------------------------


def _merge_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tip updates of two days' purchases into the stored table: a batch, a batch of older ones, the first once more."""
    lake = L.Lake(spark, work_folder(spark, "merge-updates"))
    t = roles.trips_e(spark, sf_dir)
    base = q_core._base_trips(spark, sf_dir).join(
        t.select(F.col("trip_id").alias("id"), "pickup_datetime", "dropoff_datetime", "trip_distance"), "id"
    )
    base = base.withColumn("vendor_id", F.lit(None).cast("int")).withColumn("pickup_date", F.to_date("pickup_datetime"))
    lake.append("source_trips", base)
    wanted = t.filter((F.col("vendor_id") == "purchase") & F.to_date("pickup_datetime").isin(date(2024, 1, 9), date(2024, 1, 20)))

    def updates(hours: int) -> DataFrame:
        at = F.expr(f"dropoff_datetime + INTERVAL {hours} HOUR")
        return wanted.select(F.col("trip_id").alias("id"), (F.col("trip_distance") + hours).alias("tip_amount"), at.alias("updated_at"))

    L.merge_updates(lake, updates(2), 1)
    L.merge_updates(lake, updates(1), 2)
    L.merge_updates(lake, updates(3), 1)
    return lake.read("source_trips").select(
        "id", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "total_amount", "updated_at"
    )


_HIT = "vendor_id = 'purchase' AND CAST(pickup_datetime AS DATE) IN (DATE '2024-01-09', DATE '2024-01-20')"
register(
    "merge_updates",
    _merge_updates,
    q("trips_e", f"""SELECT trip_id AS id, fare_amount, CAST(0.5 AS DOUBLE) AS extra, CAST(0.5 AS DOUBLE) AS mta_tax,
      CASE WHEN {_HIT} THEN trip_distance + 2 ELSE tip_amount END AS tip_amount, CAST(0 AS DOUBLE) AS tolls_amount,
      CASE WHEN {_HIT} THEN fare_amount + 1.0 + trip_distance + 2 ELSE total_amount + 0.5 END AS total_amount,
      CASE WHEN {_HIT} THEN dropoff_datetime + INTERVAL 2 HOUR ELSE pickup_datetime END AS updated_at FROM trips_e"""),
    "tip_amount total_amount",
    job=True,
)


def _vendor_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rollup made from the first trips, then brought up to date by the days that later loads fall into."""
    lake = L.Lake(spark, work_folder(spark, "vendor-rollup"))
    first, later = datetime(2024, 2, 1), datetime(2024, 2, 2)
    late = (F.col("trip_id") % 10 == 0) & F.to_date("pickup_datetime").isin(date(2024, 1, 5), date(2024, 1, 21))
    t = roles.trips_e(spark, sf_dir)
    codes = {name: k for k, name in enumerate(("click", "error", "purchase", "signup", "view"), 1)}
    code = F.lit(None).cast("int")
    for name, k in codes.items():
        code = F.when(F.col("vendor_id") == name, k).otherwise(code)
    rows = t.withColumns(
        {
            "vendor_id": code, "load_date": F.when(late, F.lit(later)).otherwise(F.lit(first)), "rate_code_id": F.lit(1),
            "store_and_fwd_flag": F.lit("N"), "year": F.year("pickup_datetime"), "month": F.month("pickup_datetime"),
            "day": F.dayofmonth("pickup_datetime"),
            **{c: F.lit(0.0) for c in ("extra", "mta_tax", "tolls_amount", "improvement_surcharge", "congestion_surcharge", "airport_fee")},
        }
    )
    lake.append("trips", rows.filter(~late))
    L.refresh_vendor_rollup(lake, datetime(1970, 1, 1))
    lake.append("trips", rows.filter(late))
    L.refresh_vendor_rollup(lake, first)
    return L.vendor_rollup(lake).read().withColumnRenamed("n_rows", "trip_count")


register(
    "vendor_rollup",
    _vendor_rollup,
    q("trips_e", """SELECT CASE vendor_id WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4
        WHEN 'view' THEN 5 END AS vendor_id, count(*) AS trip_count,
      CAST(sum(passenger_count) AS BIGINT) AS total_passenger_count, sum(fare_amount) AS total_fare_amount,
      avg(trip_distance) AS avg_trip_distance, avg(fare_amount) AS avg_fare_amount,
      count(DISTINCT pickup_location_id) AS distinct_pickup_location_id, count(DISTINCT payment_type) AS distinct_payment_type
      FROM trips_e GROUP BY 1"""),
    "total_fare_amount avg_trip_distance avg_fare_amount",
    job=True,
)


def _deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page from the middle of a stored listing."""
    path = work_folder(spark, "pages")
    order = ["-pickup_datetime", "-trip_id"]
    listing = roles.trips_e(spark, sf_dir).select("trip_id", "pickup_datetime", "fare_amount")
    T.build_pages(listing, order, path, rows_per_bucket=200)
    return T.read_page(spark, path, order, 9, 55)


register(
    "paginate_deep",
    _deep_page,
    q("trips_e", """SELECT trip_id, pickup_datetime, fare_amount, (SELECT count(*) FROM trips_e) AS total_count,
      9 AS page, 55 AS page_size, CAST(ceil((SELECT count(*) FROM trips_e) / 55) AS BIGINT) AS total_pages
      FROM trips_e ORDER BY pickup_datetime DESC, trip_id DESC LIMIT 55 OFFSET 440"""),
    job=True,
)

_LOADED = datetime(2001, 12, 1)


def _land_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files landed in two runs, some of them with trips that came before; the good trips and the bad ones."""
    root = work_folder(spark, "landing")
    raw = roles.raw_o(spark, sf_dir).withColumn("_half", F.col("PULocationID") % 2)
    lake = L.Lake(spark, f"{root}/lake")
    # As many files as the rows ask for: a fixed number would be as many tasks, however large they get.
    raw.filter("_half = 0").drop("_half").hint("rebalance").write.parquet(f"{root}/raw")
    L.land_trips(lake, f"{root}/raw", _LOADED)
    raw.filter("_half = 1 OR PULocationID % 10 = 0").drop("_half").hint("rebalance").write.mode("append").parquet(f"{root}/raw")
    for _ in range(2):
        L.land_trips(lake, f"{root}/raw", _LOADED)
    good = lake.read("trips").groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_trips"), F.sum("fare_amount").alias("fares"), F.sum("pickup_location_id").alias("zones")
    )
    bad = lake.read("bad_trips").agg(F.count_distinct("tpep_pickup_datetime").alias("n_trips"))
    return good.unionByName(bad, allowMissingColumns=True)


register(
    "land_files",
    _land_files,
    q("raw_o trips_o", f"""SELECT CAST(year(pickup_datetime) AS INTEGER) AS "year", CAST(month(pickup_datetime) AS INTEGER)
        AS "month", count(*) AS n_trips, sum(fare_amount) AS fares, CAST(sum(pickup_location_id) AS BIGINT) AS zones
      FROM (SELECT DISTINCT * FROM trips_o WHERE pickup_datetime >= TIMESTAMP '2000-01-01' AND trip_distance > 0
        AND fare_amount > 0 AND total_amount > 0 AND passenger_count BETWEEN 1 AND 6 AND dropoff_datetime IS NOT NULL
        AND pickup_datetime <= TIMESTAMP '{_LOADED}' + INTERVAL 1 DAY) GROUP BY 1, 2
      UNION ALL SELECT NULL, NULL, count(DISTINCT tpep_pickup_datetime), NULL, NULL FROM raw_o
      WHERE tpep_pickup_datetime < TIMESTAMP '2000-01-01' OR tpep_pickup_datetime > TIMESTAMP '{_LOADED}' + INTERVAL 1 DAY"""),
    "fares",
    job=True,
)

