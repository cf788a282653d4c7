"""One place for session settings, so batch, stream and test runs agree."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Timestamps are compared and truncated in UTC everywhere.
RUNTIME_CONF = {"spark.sql.session.timeZone": "UTC"}

# Adaptive planning merges partitions but never makes more: on a cluster, start with many, whatever the final number is.
CLUSTER_CONF = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000"}

BUILD_CONF = {
    **RUNTIME_CONF,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Window and parse stages cost much more per byte than scans: keep their tasks small before using fewer of them.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # Stream state lives on disk, so it may outgrow an executor's memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str = "zonetide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings; `conf` overrides them (dots written as `__`)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    local = (master or "").startswith("local")
    settings = {**BUILD_CONF, **({} if local else CLUSTER_CONF), **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for a job's tables, below the one that driver and executors share.

    The session names that one in `spark.checkpoint.dir`. Where it names none, a temporary folder serves a local session; on
    several machines each would write to its own disk, so there the job ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="zonetide-")
    return f"{named.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session built elsewhere."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark
