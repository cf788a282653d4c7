"""Append-only tables written batch by batch, whose folders are merged at intervals.

A folder `span=a-b` holds the batches a to b. A merge writes one folder for many and leaves theirs until the next merge: a
reader takes the folders that lie within no other one, so it meets each batch once, and no file that it listed goes away
under it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonetide.tables import store as K


def _path(root: str, first: int, last: int) -> str:
    return f"{root.rstrip('/')}/span={first}-{last}"


def write(df: DataFrame, root: str, first: int, last: int, partition_by: Sequence[str] = ()) -> None:
    """The rows of some batches; a second run replaces the first."""
    K.write_table(df, _path(root, first, last), "overwrite", partition_by)


def stored(spark: SparkSession, root: str) -> list[tuple[int, int]]:
    """The spans whose folders are complete."""
    names = (f.split("/")[-2] for f in K.folders(spark, f"{root}/span=*/_SUCCESS"))
    return sorted(tuple(map(int, n.partition("=")[2].split("-"))) for n in names)


def covering(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans that lie within no other."""
    widest = sorted(set(spans), key=lambda s: (s[0], -s[1]))
    out: list[tuple[int, int]] = []
    for first, last in widest:
        if not out or last > out[-1][1]:
            out.append((first, last))
    return out


def read(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All batches, each once."""
    folders = [_path(root, *s) for s in covering(stored(spark, root))]
    if not folders:
        return spark.createDataFrame([], schema)
    wanted = f"{schema}, span string"
    return spark.read.schema(wanted).option("basePath", root).parquet(*folders).drop("span")


def merge(spark: SparkSession, root: str, first: int, last: int, partition_by: Sequence[str] = ()) -> None:
    """One folder for the batches `first` to `last`; then drop the folders that an earlier merge has replaced.

    A run that ends before its folder is complete leaves everything as it was, and a second run does it again.
    """
    have = stored(spark, root)
    inside = [s for s in covering(have) if first <= s[0] and s[1] <= last]
    if len(inside) > 1:
        whole = spark.read.option("basePath", root).parquet(*[_path(root, *s) for s in inside]).drop("span")
        write(whole, root, first, last, partition_by)
    covered = covering(have)
    for span in have:
        if span not in covered and span[1] < first:
            K.delete(spark, _path(root, *span))
