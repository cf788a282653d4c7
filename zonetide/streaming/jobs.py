"""Starting, stopping and storing streams."""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zonetide.operators import changes as X
from zonetide.sources import readers, schemas
from zonetide.streaming import windows as S
from zonetide.tables import keyed, spans
from zonetide.tables import store as K

#: Tasks that one partition value of a micro-batch is written by.
SPREAD = 8
#: Micro-batches whose mirror folders are merged into one.
MERGE_EVERY = 50


def start_append(
    df: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append a stream to a table folder; `every` is a trigger interval, none means run what is there and stop.

    Rows are clustered by the partition columns so each task writes few files; a spread keeps one large partition value
    from becoming one task.
    """
    if partition_by:
        spread = F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD))
        df = df.repartition(*partition_by, spread)
    writer = df.writeStream.format(fmt).outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def _declared(df: DataFrame, table: str) -> DataFrame:
    """The columns and types that the table is declared with."""
    return K.conform(df, schemas.OUTPUT_TABLES[table][0])


def window_stream(
    broker: DataFrame, duration: str = "5 minutes", delay: str = "10 minutes", beats: DataFrame | None = None
) -> DataFrame:
    """Change stream to window aggregates, with the day as partition column; `beats` as `read_beats` gives them."""
    aggs = S.trip_window_aggs(S.with_heartbeats(S.trip_rows(broker), beats, "timestamp", delay), duration)
    return _declared(
        S.stamped(aggs).withColumn("window_date", F.to_date("window_start")), "trip_window_aggregates"
    )


def dropoff_stream(
    broker: DataFrame, duration: str = "5 minutes", delay: str = "10 minutes", beats: DataFrame | None = None
) -> DataFrame:
    """Change stream to drop-offs and top destinations per window and zone, with the day as partition column."""
    rows = S.with_heartbeats(S.trip_rows(broker), beats, "timestamp", delay)
    found = S.stamped(S.window_dropoffs(rows, duration))
    return _declared(found.withColumn("window_date", F.to_date("window_start")), "window_dropoffs")


def activity_stream(
    aggs: DataFrame,
    dropoffs: DataFrame | None = None,
    delay: str = "10 minutes",
    beats: DataFrame | None = None,
) -> DataFrame:
    """Second hop: stored window aggregates, read as a stream, to zone activity rows.

    `dropoffs` is the table of `dropoff_stream`, read as a stream too: a left outer join on window and zone. Whichever side
    comes first waits in the state for the other. A window without drop-offs comes out once the ends of both sides have
    passed it by `delay`, so the slower side is never missed; `beats` closes the windows of a side gone quiet. State is
    kept for the windows in between only.
    """
    if dropoffs is not None:
        if dropoffs.isStreaming != aggs.isStreaming:
            raise ValueError("drop-offs are read as a stream when the aggregates are: a table would be listed once")
        aggs = S.with_heartbeats(aggs, beats, "window_end", delay, ("window_start", "pickup_zone_id"))
        kept = dropoffs.select("window_start", "window_end", "zone_id", "dropoff_count", "top_destination_zone")
        dropoffs = S.with_heartbeats(kept, beats, "window_end", delay, ("window_start", "zone_id"))
    rows = S.stamped(S.zone_activity(aggs, dropoffs))
    return _declared(
        rows.withColumn("activity_hour", F.date_trunc("hour", "activity_timestamp")), "zone_activity"
    )


# --- heartbeats -----------------------------------------------------------------------------------------------------

BEAT = "timestamp timestamp"


def beat(spark: SparkSession, path: str, at: datetime) -> None:
    """Say that nothing older than `at` is to come any more: windows before it close, rows before it are late."""
    _beat(spark, path, F.lit(at).cast("timestamp"))


def _beat(spark: SparkSession, path: str, at: Column) -> None:
    spark.range(1).select(at.alias("timestamp")).coalesce(1).write.mode("append").parquet(path)


def read_beats(spark: SparkSession, path: str) -> DataFrame:
    """The heartbeats of a folder as a stream. A first one, older than any row, makes the folder where it is missing."""
    if not K.exists(spark, path):
        beat(spark, path, datetime(1970, 1, 1))
    return readers.read_file_stream(spark, path, BEAT)


def close_when_idle(
    query: StreamingQuery, spark: SparkSession, path: str, idle: float, ahead: timedelta, timeout: float
) -> bool:
    """Watch a running query and beat once its source has been quiet for `idle` seconds: `ahead` past the newest time it
    saw, which must exceed a window and its delay. Returns whether it did so within `timeout`.

    To be called again after new rows: a time that the last heartbeat has passed needs no other one.
    """
    beats = spark.read.schema(BEAT).parquet(path)
    passed = beats.agg(F.unix_millis(F.max("timestamp"))).first()[0]
    deadline, newest, quiet_since = time.monotonic() + timeout, passed, time.monotonic()
    while time.monotonic() < deadline and query.isActive:
        times = [(p.get("eventTime") or {}).get("max") for p in query.recentProgress]
        seen = max((_millis(t) for t in times if t is not None), default=passed)
        if seen != newest:
            newest, quiet_since = seen, time.monotonic()
        if newest > passed and time.monotonic() - quiet_since >= idle:
            _beat(spark, path, F.timestamp_millis(F.lit(newest + int(ahead.total_seconds() * 1000))))
            return True
        time.sleep(0.2)
    return False


def _millis(text: str) -> int:
    """A time of a progress report."""
    return round(datetime.fromisoformat(text.replace("Z", "+00:00")).timestamp() * 1000)


# --- mirrors --------------------------------------------------------------------------------------------------------

def start_mirrors(
    broker: DataFrame, root: str, checkpoint: str, every: str | None = None, merge_every: int = MERGE_EVERY
) -> StreamingQuery:
    """Append the changes of every source table to its mirror, and what cannot be read or typed to the target `bad`.

    A record is parsed once, into a variant from which each target takes its fields, and a micro-batch is one write
    partitioned by target. It has a folder of its own number, which a second run of the batch overwrites; at intervals
    the folders since the last merge become one. Values that do not fit put their row aside; the stream goes on.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spans.write(X.mirrored(batch), root, batch_id, batch_id, ("target", "pickup_date"))
        if batch_id % merge_every == merge_every - 1:
            spans.merge(batch.sparkSession, root, batch_id - merge_every + 1, batch_id, ("target", "pickup_date"))

    writer = broker.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def read_mirror(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A mirror table with its declared columns; `bad` gives the records put aside."""
    rows = spans.read(spark, root, X.mirror_schema()).filter(F.col("target") == table)
    return rows.select("value") if table == "bad" else K.conform(rows, schemas.OUTPUT_TABLES[f"change_{table}"][0])


def await_all(queries: Sequence[StreamingQuery], timeout: float) -> list[bool]:
    """Wait for all queries within one common timeout; whether each has ended.

    The queries are watched in turn, so the failure of any is seen while the others still run: it stops them and is
    raised.
    """
    deadline = time.monotonic() + timeout
    try:
        while time.monotonic() < deadline:
            if all([q.awaitTermination(1) for q in queries]):
                break
        return [not q.isActive for q in queries]
    except Exception:
        for q in queries:
            if q.isActive:
                q.stop()
        raise


def start_state(
    log: DataFrame,
    path: str,
    checkpoint: str,
    pk: str | Sequence[str] = X.ROW_KEY,
    every: str | None = None,
    buckets: int = keyed.BUCKETS,
    forget: timedelta = keyed.FORGET,
) -> StreamingQuery:
    """Keep the newest row per key of a flattened change stream in a table of buckets.

    Nothing is held between micro-batches: each merges its rows into the buckets that their keys fall into. A batch that
    is run again writes the same versions of the same buckets.
    """
    table = keyed.KeyedTable(log.sparkSession, path, pk, ("__source_ts_ms", "offset"), buckets, forget)

    def write(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch, batch_id)

    writer = log.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def current_rows(spark: SparkSession, path: str) -> DataFrame:
    """The current table from what `start_state` wrote: the newest row per key without the deleted keys."""
    return keyed.read(spark, path).filter(~F.col("__deleted"))
