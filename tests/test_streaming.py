"""Streams over arriving files: closed windows equal the batch result, late rows are dropped, state follows the log."""

import datetime as dt
import json
import random
import time

import pytest
from oracle import rows_of
from pyspark.sql import functions as F

from zonetide.operators import changes as X
from zonetide.sources import readers, roles, schemas
from zonetide.streaming import jobs
from zonetide.streaming import windows as S
from zonetide.tables import keyed, spans
from zonetide.tables import store as K

BROKER = "topic string, offset bigint, timestamp timestamp, value string"
COLUMNS = [
    "window_start", "window_end", "pickup_zone_id", "total_trips", "total_revenue", "avg_trip_distance",
    "avg_fare_amount", "unique_vendors",
]


def rows(df, digits=6):
    doubles = [c for c, t in df.dtypes if t == "double"]
    df = df.withColumns({c: F.round(c, digits) for c in doubles})
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def wait(query):
    query.awaitTermination(240)
    assert query.exception() is None and not query.isActive


def test_closed_windows_equal_the_batch_result(spark, sf_dir, tmp_path):
    broker = roles.changes_e(spark, sf_dir)
    broker.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = readers.read_file_stream(spark, f"{tmp_path}/in", BROKER)
    wait(jobs.start_append(jobs.window_stream(stream), f"{tmp_path}/aggs", f"{tmp_path}/ck1", None, ["window_date"]))

    def declared(name, folder):
        schema = schemas.OUTPUT_TABLES[name][0]
        return K.conform(spark.read.schema(schema).parquet(f"{tmp_path}/{folder}"), schema)

    stored = declared("trip_window_aggregates", "aggs")
    batch = S.trip_window_aggs(S.trip_rows(broker))
    newest = broker.agg(F.max("timestamp")).first()[0]
    closed = batch.filter(F.col("window_end") <= F.lit(newest - dt.timedelta(minutes=10)))
    assert rows(stored.select(*COLUMNS)) == rows(closed.select(*COLUMNS))
    assert 0 < stored.count() <= batch.count()

    again = readers.read_file_stream(spark, f"{tmp_path}/in", BROKER)
    wait(jobs.start_append(jobs.dropoff_stream(again), f"{tmp_path}/drop", f"{tmp_path}/ck3", None, ["window_date"]))
    dropped = declared("window_dropoffs", "drop")
    every = S.window_dropoffs(S.trip_rows(broker))
    closed = every.filter(F.col("window_end") <= F.lit(newest - dt.timedelta(minutes=10)))
    assert rows(dropped.select(*closed.columns)) == rows(closed)
    assert dropped.filter("dropoff_count > 0").count() > 0

    # Second hop: both stored tables read as streams, all of whose windows a heartbeat closes.
    beats = f"{tmp_path}/beats"

    def second():
        sides = [
            readers.read_file_stream(spark, f"{tmp_path}/{folder}", schemas.OUTPUT_TABLES[name][0])
            for name, folder in (("trip_window_aggregates", "aggs"), ("window_dropoffs", "drop"))
        ]
        acts = jobs.activity_stream(*sides, beats=jobs.read_beats(spark, beats))
        wait(jobs.start_append(acts, f"{tmp_path}/act", f"{tmp_path}/ck2", None, ["activity_hour"]))

    second()
    jobs.beat(spark, beats, newest + dt.timedelta(hours=1))
    second()
    activity = declared("zone_activity", "act").drop("processed_at", "activity_hour")
    sides = dropped.drop("processed_at", "window_date")
    assert rows(activity) == rows(S.zone_activity(stored, sides).select(*activity.columns))
    assert activity.filter("top_destination_zone IS NOT NULL").count() > 0


def aggregate_rows(spark, rows_):
    """Stored window aggregates: (window start, zone, trips)."""
    made = [(a, a + dt.timedelta(minutes=5), z, n, 10.0 * n, 1.0, 10.0, 1, a, a.date()) for a, z, n in rows_]
    return spark.createDataFrame(made, schemas.OUTPUT_TABLES["trip_window_aggregates"][0])


def dropoff_rows(spark, rows_):
    """Stored drop-offs: (window start, zone, drop-offs, top destination)."""
    made = [(a, a + dt.timedelta(minutes=5), z, n, top, a, a.date()) for a, z, n, top in rows_]
    return spark.createDataFrame(made, schemas.OUTPUT_TABLES["window_dropoffs"][0])


@pytest.mark.parametrize("first", ["aggs", "drop"])
def test_either_side_may_come_first(spark, tmp_path, first):
    t0 = dt.datetime(2024, 1, 1, 12, 0)
    at = lambda m: t0 + dt.timedelta(minutes=m)
    frames = {
        "aggs": aggregate_rows(spark, [(at(0), 1, 4), (at(0), 2, 3), (at(5), 1, 2), (at(30), 3, 1)]),
        "drop": dropoff_rows(spark, [(at(0), 1, 7, 2), (at(5), 1, 0, 9), (at(5), 8, 5, None), (at(30), 3, 1, 3)]),
    }
    for name in frames:
        frames[name].limit(0).coalesce(1).write.parquet(f"{tmp_path}/{name}")

    def run():
        sides = [
            readers.read_file_stream(spark, f"{tmp_path}/{n}", schemas.OUTPUT_TABLES[t][0])
            for n, t in (("aggs", "trip_window_aggregates"), ("drop", "window_dropoffs"))
        ]
        acts = jobs.activity_stream(*sides, beats=jobs.read_beats(spark, f"{tmp_path}/beats"))
        wait(jobs.start_append(acts, f"{tmp_path}/act", f"{tmp_path}/ck"))
        stored = spark.read.schema(schemas.OUTPUT_TABLES["zone_activity"][0]).parquet(f"{tmp_path}/act")
        return stored.select("zone_id", "activity_timestamp", "pickup_count", "dropoff_count", "top_destination_zone")

    def land_side(name, df):
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")

    second = "drop" if first == "aggs" else "aggs"
    land_side(first, frames[first])
    assert run().count() == 0
    land_side(second, frames[second])
    run()
    # Half an hour after the last window everything has closed; a row of either side for an old window is late.
    jobs.beat(spark, f"{tmp_path}/beats", at(65))
    run()
    land_side("drop", dropoff_rows(spark, [(at(0), 2, 99, 1)]))
    land_side("aggs", aggregate_rows(spark, [(at(0), 8, 99)]))
    got = sorted(tuple(r) for r in run().collect())
    assert got == [(1, at(5), 4, 7, 2), (1, at(10), 2, 0, 9), (2, at(5), 3, 0, None), (3, at(35), 1, 1, 3)]


def test_dropoffs_of_a_streamed_activity_are_a_stream(spark, tmp_path):
    aggregate_rows(spark, []).write.parquet(f"{tmp_path}/aggs")
    aggs = readers.read_file_stream(spark, f"{tmp_path}/aggs", schemas.OUTPUT_TABLES["trip_window_aggregates"][0])
    with pytest.raises(ValueError, match="as a stream"):
        jobs.activity_stream(aggs, dropoff_rows(spark, []))


def test_a_quiet_source_closes_its_last_windows_once(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1, 12, 0)
    at = lambda m: t0 + dt.timedelta(minutes=m)
    src, beats, out = (f"{tmp_path}/{n}" for n in ("in", "beats", "out"))
    land(spark, src, [(1, at(1), envelope("c", at(1), 1)), (2, at(8), envelope("c", at(8), 2, vendor=2))], 1)
    stream = jobs.window_stream(readers.read_file_stream(spark, src, BROKER), beats=jobs.read_beats(spark, beats))
    query = jobs.start_append(stream, out, f"{tmp_path}/ck", every="1 second")
    counted = lambda: {r.window_start.minute: r.total_trips for r in spark.read.schema(schemas.OUTPUT_TABLES["trip_window_aggregates"][0]).parquet(out).collect()}
    try:
        ahead = dt.timedelta(minutes=15)
        assert jobs.close_when_idle(query, spark, beats, 3, ahead, 120)
        query.processAllAvailable()
        query.processAllAvailable()
        deadline = time.monotonic() + 60
        while len(counted()) < 2 and time.monotonic() < deadline:
            time.sleep(0.5)
        assert counted() == {0: 1, 5: 1}
        # Rows of a closed window are late; those after it open a new one.
        land(spark, src, [(3, at(9), envelope("c", at(9), 3)), (4, at(40), envelope("c", at(40), 4))], 2)
        query.processAllAvailable()
        assert jobs.close_when_idle(query, spark, beats, 3, ahead, 120)
        deadline = time.monotonic() + 60
        while len(counted()) < 3 and time.monotonic() < deadline:
            time.sleep(0.5)
        assert counted() == {0: 1, 5: 1, 40: 1}
        assert spark.read.parquet(out).count() == 3
    finally:
        query.stop()


def envelope(op, ts, key, zone=1, fare=10.0, vendor=1):
    row = {"id": key, "vendor_id": vendor, "pickup_location_id": zone, "fare_amount": fare, "total_amount": fare + 1}
    ms = int(ts.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    body = {"op": op, "ts_ms": ms, "before": row if op == "d" else None, "after": None if op == "d" else row,
            "source": {"db": "shop", "table": "trips", "ts_ms": ms}}
    return json.dumps(body)


def land(spark, path, records, number):
    data = [("shop.public.trips", o, ts, value) for o, ts, value in records]
    df = spark.createDataFrame(data, BROKER).coalesce(1)
    df.write.mode("append").parquet(path)


def test_late_rows_are_dropped_and_windows_appear_once(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1, 12, 0)
    at = lambda m: t0 + dt.timedelta(minutes=m)
    src, out, ck = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck"

    def run():
        stream = readers.read_file_stream(spark, src, BROKER)
        wait(jobs.start_append(jobs.window_stream(stream), out, ck))

    land(spark, src, [(1, at(1), envelope("c", at(1), 1)), (2, at(16), envelope("u", at(16), 2)),
                      (3, at(2), envelope("d", at(2), 3)), (4, at(2), "{broken"),
                      (5, at(3), envelope("r", at(3), 4, fare=0.0)), (6, at(4), envelope("r", at(4), 5))], 1)
    run()
    # The watermark is at minute 6: a row of minute 2 is 14 minutes behind and late, one of minute 8 is in time.
    land(spark, src, [(7, at(2), envelope("c", at(2), 6)), (8, at(8), envelope("c", at(8), 7))], 2)
    run()
    land(spark, src, [(9, at(60), envelope("c", at(60), 8))], 3)
    run()
    got = {r.window_start.minute: r.total_trips for r in spark.read.parquet(out).collect()}
    assert got == {0: 2, 5: 1, 15: 1}


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_state_follows_the_log(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    at = lambda m: t0 + dt.timedelta(minutes=m)
    src, out, ck = f"{tmp_path}/in", f"{tmp_path}/state", f"{tmp_path}/ck"

    def run():
        log = X.flatten_change(X.parse_envelope(readers.read_file_stream(spark, src, BROKER)))
        wait(jobs.start_state(log, out, ck, buckets=16, forget=dt.timedelta(minutes=60)))

    def got():
        return {r.id: r.fare_amount for r in jobs.current_rows(spark, out).collect()}

    land(spark, src, [(1, at(1), envelope("r", at(1), 1, fare=1.0)), (2, at(1), envelope("c", at(1), 2, fare=2.0)),
                      (3, at(2), envelope("u", at(2), 1, fare=3.0))], 1)
    run()
    # Same millisecond: the higher offset wins. An older change that arrives late changes nothing.
    land(spark, src, [(4, at(5), envelope("d", at(5), 2)), (6, at(5), envelope("u", at(5), 1, fare=6.0)),
                      (5, at(5), envelope("u", at(5), 1, fare=5.0)), (7, at(3), envelope("u", at(3), 2, fare=9.0))], 2)
    run()
    whole = X.current_state(X.flatten_change(X.parse_envelope(spark.read.schema(BROKER).parquet(src))))
    assert got() == {1: 6.0} == {r.id: r.fare_amount for r in whole.collect()}

    # The delete of 2 is remembered: a change from before it, in a batch of its own, does not bring the row back.
    land(spark, src, [(8, at(4), envelope("u", at(4), 2, fare=8.0))], 3)
    run()
    assert got() == {1: 6.0}
    assert {r.id for r in keyed.read(spark, out).collect()} == {1, 2}


def log_row(spark, rows_):
    made = [("trips", i, op == "d", ts, off, fare) for i, op, ts, off, fare in rows_]
    return spark.createDataFrame(made, "__source_table string, id bigint, __deleted boolean, __source_ts_ms bigint, offset bigint, fare double")


def test_a_batch_rewrites_the_buckets_it_touches(spark, tmp_path):
    table = keyed.KeyedTable(spark, f"{tmp_path}/t", "id", ("__source_ts_ms", "offset"), 16, dt.timedelta(seconds=1))
    table.merge(log_row(spark, [(k, "c", k, k, 1.0) for k in range(200)]), 0)
    before = files(tmp_path / "t")
    assert len({p.split("/")[-3] for p in before}) == 16
    reader = keyed.read(spark, table.path)
    batch = log_row(spark, [(7, "u", 1_000, 900, 2.0), (9, "d", 1_000, 901, 0.0)])
    table.merge(batch, 1)
    changed = {p.split("/")[-3] for p in set(files(tmp_path / "t")) - set(before)}
    assert len(changed) <= 2 and all(files(tmp_path / "t")[p] == t for p, t in before.items())
    # The same batch again gives the same rows; a reader that listed the files before it still reads them.
    first = rows(keyed.read(spark, table.path))
    table.merge(batch, 1)
    assert rows(keyed.read(spark, table.path)) == first
    assert reader.count() == 200 and reader.filter("fare <> 1.0").count() == 0
    now = {r.id: r for r in keyed.read(spark, table.path).collect()}
    assert len(now) == 200 and now[7].fare == 2.0 and now[9]["__deleted"]

    # Long after it the delete is forgotten, once its bucket is written again; older versions are gone by then.
    same_bucket = [r.id for r in spark.range(1000, 3000).selectExpr("id", "pmod(xxhash64(id), 16) b", "pmod(xxhash64(9L), 16) w").filter("b = w").limit(1).collect()]
    table.merge(log_row(spark, [(same_bucket[0], "c", 10_000, 1_000, 1.0)]), 2)
    assert 9 not in {r.id for r in keyed.read(spark, table.path).collect()}
    assert max(len(v) for v in keyed.versions(spark, table.path).values()) <= 2
    table.merge(log_row(spark, []), 3)
    assert keyed.read(spark, table.path).count() == 200


def test_state_of_the_whole_log_equals_the_batch_result(spark, sf_dir, tmp_path):
    broker = roles.changes_e(spark, sf_dir)
    broker.repartition(4).write.parquet(f"{tmp_path}/in")
    stream = readers.read_file_stream(spark, f"{tmp_path}/in", BROKER, per_batch=1)
    # The files hold all days mixed: deletes are remembered for longer than the log.
    log = X.flatten_change(X.parse_envelope(stream))
    wait(jobs.start_state(log, f"{tmp_path}/s", f"{tmp_path}/ck", forget=dt.timedelta(days=60)))
    whole = X.current_state(X.flatten_change(X.parse_envelope(broker)))
    got = jobs.current_rows(spark, f"{tmp_path}/s").select(*whole.columns)
    assert rows(got) == rows(whole) != []


def test_changes_reach_their_mirror_tables(spark, tmp_path):
    def record(table, row, op="c"):
        body = {"op": op, "ts_ms": 5, "before": None, "after": row, "source": {"db": "shop", "table": table, "ts_ms": 5}}
        return json.dumps(body)

    trip = {
        "id": 1, "vendor_id": 2, "pickup_datetime": 1706000000000000, "dropoff_datetime": "2024-01-23T09:10:00",
        "passenger_count": 1, "trip_distance": "1.25", "pickup_longitude": -73.98765432, "pickup_latitude": 40.7,
        "dropoff_longitude": None, "dropoff_latitude": None, "payment_type": 1, "fare_amount": 12.5, "extra": 0,
        "mta_tax": 0.5, "tip_amount": 1, "tolls_amount": 0, "total_amount": "14.00", "created_at": None, "updated_at": None,
    }
    at = dt.datetime(2024, 1, 23)
    values = [
        record("trips", trip), record("trips", {**trip, "id": 2, "total_amount": 1_234_567.0}),
        record("vendors", {"id": 1, "name": "A", "description": "a"}), record("payment_types", {"id": 1, "name": "cash"}),
        record("vendors", "no object"), record("elsewhere", {"id": 9}), "{broken", record("trips", trip, "x"),
    ]
    land(spark, f"{tmp_path}/in", [(k, at, v) for k, v in enumerate(values)], 1)
    for _ in range(2):
        wait(jobs.start_mirrors(readers.read_file_stream(spark, f"{tmp_path}/in", BROKER), f"{tmp_path}/m", f"{tmp_path}/ck"))
    trips = jobs.read_mirror(spark, f"{tmp_path}/m", "trips").collect()
    assert [(r.id, str(r.total_amount), str(r.pickup_datetime), str(r.dropoff_datetime)) for r in trips] == [
        (1, "14.00", "2024-01-23 08:53:20", "2024-01-23 09:10:00")
    ]
    assert [r.name for r in jobs.read_mirror(spark, f"{tmp_path}/m", "vendors").collect()] == ["A"]
    assert [r.name for r in jobs.read_mirror(spark, f"{tmp_path}/m", "payment_types").collect()] == ["cash"]
    bad = [r.value for r in jobs.read_mirror(spark, f"{tmp_path}/m", "bad").collect()]
    assert sorted(bad) == sorted(values[k] for k in (1, 4, 5, 6, 7))


def test_a_record_is_parsed_once_for_all_mirrors(spark, tmp_path):
    broker = spark.createDataFrame([("shop.public.trips", 1, dt.datetime(2024, 1, 1), "{}")], BROKER)
    plan = X.mirrored(broker)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("parsejson") == 1 and "from_json" not in plan and plan.count("generate inline") == 1


def test_mirrors_keep_what_each_table_declares(spark, tmp_path):
    def record(table, row, op="c", before=None):
        return json.dumps({"op": op, "before": before, "after": row, "source": {"db": "s", "table": table, "ts_ms": 7}})

    values = [
        record("vendors", {"id": 3_000_000_000, "name": "too wide"}), record("trips", {"id": 3_000_000_000}),
        record("trips", None, "d", {"id": 4, "fare_amount": 1.005, "pickup_datetime": "no time"}),
        record("trips", None, "d", {"id": 5, "fare_amount": 2}), record("vendors", {"id": 1, "fare_amount": "9"}),
        record("trips", {"id": 6, "pickup_longitude": "-73.98765432101234"}), "", None, "null", "[1]", record("vendors", [1]),
    ]
    df = spark.createDataFrame([("t", k, dt.datetime(2024, 1, 1), v) for k, v in enumerate(values)], BROKER)
    got = X.mirrored(df).collect()
    kept = {(r.target, r.id): r for r in got if r.target != "bad"}
    assert set(kept) == {("trips", 3_000_000_000), ("trips", 5), ("vendors", 1), ("trips", 6)}
    assert kept["trips", 5]["__op"] == "d" and str(kept["trips", 5].fare_amount) == "2.00"
    assert str(kept["trips", 6].pickup_longitude) == "-73.98765432101234" and kept["vendors", 1].fare_amount is None
    assert len(got) == len(values) and sum(r.target == "bad" for r in got) == 7


def test_folders_of_a_log_are_merged_and_each_batch_is_read_once(spark, tmp_path):
    root = f"{tmp_path}/log"
    one = lambda k: spark.createDataFrame([(k, str(k % 2))], "n bigint, kind string").coalesce(1)
    seen = lambda: sorted(r.n for r in spans.read(spark, root, "n bigint, kind string").collect())
    assert seen() == []
    for k in range(4):
        spans.write(one(k), root, k, k, ["kind"])
    spans.write(one(3), root, 3, 3, ["kind"])
    listed = spans.read(spark, root, "n bigint, kind string")
    spans.merge(spark, root, 0, 3, ["kind"])
    assert spans.covering(spans.stored(spark, root)) == [(0, 3)] and seen() == [0, 1, 2, 3]
    assert sorted(r.n for r in listed.collect()) == [0, 1, 2, 3]
    for k in range(4, 8):
        spans.write(one(k), root, k, k, ["kind"])
    spans.merge(spark, root, 4, 7, ["kind"])
    assert seen() == list(range(8))
    # What the first merge replaced is gone by now, what the second replaced is not.
    assert spans.stored(spark, root) == [(0, 3), (4, 4), (4, 7), (5, 5), (6, 6), (7, 7)]
    # A folder without its mark is not there yet; the merge is done again.
    (tmp_path / "log/span=4-7/_SUCCESS").unlink()
    assert seen() == list(range(8))
    spans.merge(spark, root, 4, 7, ["kind"])
    assert seen() == list(range(8)) and spans.covering(spans.stored(spark, root)) == [(0, 3), (4, 7)]


def test_vendors_are_counted_exactly_on_a_stream(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    rnd = random.Random(5)
    made = [
        (k, t0 + dt.timedelta(seconds=7 * k), envelope("c", t0, k, zone=rnd.randrange(3), fare=1.0 + k % 9, vendor=rnd.choice([*range(40), None])))
        for k in range(600)
    ]
    land(spark, f"{tmp_path}/in", made, 1)
    beats = jobs.read_beats(spark, f"{tmp_path}/beats")
    jobs.beat(spark, f"{tmp_path}/beats", t0 + dt.timedelta(days=1))
    stream = jobs.window_stream(readers.read_file_stream(spark, f"{tmp_path}/in", BROKER), beats=beats)
    wait(jobs.start_append(stream, f"{tmp_path}/out", f"{tmp_path}/ck"))
    got = spark.read.schema(schemas.OUTPUT_TABLES["trip_window_aggregates"][0]).parquet(f"{tmp_path}/out").select(*COLUMNS)
    trips = S.trip_rows(spark.read.schema(BROKER).parquet(f"{tmp_path}/in"))
    plain = trips.groupBy(F.window("timestamp", "5 minutes").alias("w"), "pickup_location_id").agg(
        F.count(F.lit(1)), F.sum("total_amount"), F.avg("trip_distance"), F.avg("fare_amount"), F.countDistinct("vendor_id")
    )
    want = plain.select("w.start", "w.end", *plain.columns[1:]).toDF(*COLUMNS)
    assert rows(got) == rows(want) and got.agg(F.max("unique_vendors")).first()[0] > 10


def test_await_all_stops_the_others_on_failure(spark, tmp_path):
    rate = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    good = rate.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/a").start()
    boom = rate.select(F.raise_error(F.lit("boom")).alias("x"))
    bad = boom.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/b").start()
    with pytest.raises(Exception, match="boom"):
        jobs.await_all([good, bad], 60)
    assert not good.isActive


def test_await_all_shares_one_timeout(spark, tmp_path):
    rate = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    queries = [rate.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/{i}").start() for i in (1, 2)]
    try:
        assert jobs.await_all(queries, 2) == [False, False]
    finally:
        for q in queries:
            q.stop()


def test_interval_trigger(spark, tmp_path):
    rate = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    q = jobs.start_append(rate, f"{tmp_path}/o", f"{tmp_path}/c", every="1 second")
    try:
        q.awaitTermination(5)
        assert q.isActive and q.lastProgress is not None
    finally:
        q.stop()


# --- landed logs ----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("key", ["stream_mirrors", "stream_current_state", "stream_zone_activity"])
def test_a_larger_log_lands_in_more_files(spark, monkeypatch, key):
    from oracle import compare, oracle_connection

    from zonetide.catalog import ORACLES, QUERIES, q_stored

    made, land = [], q_stored._land

    def watched(records, path):
        files = land(records, path)
        made.append((files, len(spark.read.parquet(path).inputFiles())))
        return files

    monkeypatch.setattr(q_stored, "_land", watched)
    monkeypatch.setattr(q_stored, "ROWS_PER_FILE", 90)
    assert compare(spark, oracle_connection("0.001"), QUERIES[key], ORACLES[key], "0.001") is None
    assert made == [(12, 12)]
