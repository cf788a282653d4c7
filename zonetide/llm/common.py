"""What the operators share: reading the text column, cutting lineage, batches of texts for tasks that need Python."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts handled at once by a Python task; a longer text makes a batch of its own.
BATCH_BYTES = 1 << 20
BATCH_ROWS = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *others: str) -> DataFrame:
    """`doc_id`, the whole text (null: empty) and the asked columns; whatever else the table has is left behind."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *others)


def spare(docs: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local session that names none gets a temporary one."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if context.getCheckpointDir() is None:
        # On several machines each would write to its own disk, and read back what it has not.
        if not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="zonetide-"))
    return context.getCheckpointDir().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The rows so far, stored where every executor can read them again, with a lineage that starts there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Let Spark clean what no frame refers to any more: it drops a finished step's shuffle files when the driver collects
    its garbage, which a small driver that only plans does too seldom.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """As `cut`, but as a compressed columnar table, so that wide rows take less disk and readers prune columns."""
    spark = df.sparkSession
    path = path or os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark application, so that tasks can import it there."""
    context = spark.sparkContext
    if getattr(context, "_zonetide_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="zonetide-")) / "zonetide.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._zonetide_shipped = True


def map_batches(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema
) -> DataFrame:
    """Rows through a function over Arrow batches, where Spark partitions the work and streams it through.

    Batches of Spark's usual 10,000 rows would be tens of megabytes of text, held on both sides of the pipe.
    """
    ship(df.sparkSession)
    if int(df.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def blocks(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows that hold about BATCH_BYTES of text together, so memory is bounded by the longest text."""
    col = batch.column(batch.schema.get_field_index(column))
    sizes = pc.binary_length(col).to_pylist()
    begin = held = 0
    for i, size in enumerate(sizes):
        if held and held + (size or 0) > BATCH_BYTES:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += size or 0
    if begin < len(sizes):
        yield batch.slice(begin)
