"""Tables that hold the newest row of each key, in buckets by the key's hash.

A merge reads and writes only the buckets that its rows fall into. A bucket's new content is a new version beside the old one,
`bucket=3/version=17`, and a reader takes the newest version of each bucket: a version appears as a whole, and the one before it
stays until the bucket is written again, so a reader never meets a missing file.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonetide.operators import changes as X
from zonetide.tables import store as K

BUCKETS = 64
#: How long a deleted key is remembered, so that an older change that comes late does not bring it back.
FORGET = timedelta(days=7)
#: Versions of a bucket that stay: the newest, and the one that readers may have listed.
GENERATIONS = 2


def versions(spark: SparkSession, path: str) -> dict[int, list[int]]:
    """The versions of each bucket, oldest first."""
    found: dict[int, list[int]] = {}
    for names in K.folders(spark, f"{path}/bucket=*/version=*"):
        bucket, version = (int(part.partition("=")[2]) for part in names.split("/")[-2:])
        found.setdefault(bucket, []).append(version)
    return {bucket: sorted(own) for bucket, own in found.items()}


def _read(spark: SparkSession, path: str, chosen: dict[int, int]) -> DataFrame:
    folders = [f"{path}/bucket={b}/version={v}" for b, v in sorted(chosen.items())]
    return spark.read.option("basePath", path).parquet(*folders).drop("bucket", "version")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of each key, deleted ones that are still remembered included."""
    return _read(spark, path, {bucket: own[-1] for bucket, own in versions(spark, path).items()})


@dataclass(frozen=True)
class KeyedTable:
    """Rows are newest by the `order` columns, of which the first is a time in milliseconds; `__deleted` marks deletes."""

    spark: SparkSession
    path: str
    keys: str | Sequence[str]
    order: Sequence[str]
    buckets: int = BUCKETS
    forget: timedelta = FORGET

    def merge(self, rows: DataFrame, version: int) -> None:
        """Bring rows in as a version of the buckets they fall into; the same version again gives the same buckets.

        A deleted key is dropped when its bucket is written `forget` after its delete, by the rows' own times.
        """
        keys = [self.keys] if isinstance(self.keys, str) else list(self.keys)
        bucket = F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")
        fresh = X.latest_per_key(rows, keys, self.order).persist()
        try:
            times = fresh.groupBy(bucket.alias("bucket")).agg(F.max(self.order[0]).alias("newest")).collect()
            if not times:
                return
            before = versions(self.spark, self.path)
            older = {t["bucket"]: [v for v in before.get(t["bucket"], ()) if v < version] for t in times}
            both = fresh.withColumn("_now", F.lit(True))
            if any(older.values()):
                stored = _read(self.spark, self.path, {b: own[-1] for b, own in older.items() if own})
                both = both.unionByName(stored.withColumn("_now", F.lit(False)), allowMissingColumns=True)
            # A key of this batch is kept whatever its age, so no bucket of the batch is left without a row.
            touched = both.groupBy(*keys).agg(
                F.max_by(F.struct(*[c for c in both.columns if c not in (*keys, "_now")]), F.struct(*self.order)).alias("_row"),
                F.max("_now").alias("_now"),
            )
            edge = max(t["newest"] for t in times) - int(self.forget.total_seconds() * 1000)
            kept = touched.select(*keys, "_row.*", "_now").filter(
                F.col("_now") | ~F.col("__deleted") | (F.col(self.order[0]) >= edge)
            )
            out = kept.drop("_now").withColumns({"bucket": bucket, "version": F.lit(version)})
            K.replace_partitions(out, self.path, ["bucket", "version"])
            for number, own in older.items():
                for gone in own[: -(GENERATIONS - 1)]:
                    K.delete(self.spark, f"{self.path}/bucket={number}/version={gone}")
        finally:
            fresh.unpersist()
