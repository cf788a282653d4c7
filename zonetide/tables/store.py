"""Sinks and table maintenance on plain parquet tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonetide.functions import columns as C
from zonetide.functions import fixed_values as V
from zonetide.operators import filters as P


def _name(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.replace("`", "").split("."))


def ensure_table(
    spark: SparkSession, name: str, schema: str, partition_by: Sequence[str] = (), compression: str = "zstd"
) -> None:
    """Create a typed, partitioned parquet table if it does not exist."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromDDL(schema).fields
    )
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_name(name)} ({columns}) USING parquet "
        f"OPTIONS (compression '{compression}'){parts}"
    )


def with_time_partition(df: DataFrame, ts_col: str, grain: str) -> tuple[DataFrame, str]:
    """A derived partition column for a day or an hour of a timestamp, and its name."""
    if grain == "day":
        return df.withColumn(f"{ts_col}_day", F.to_date(ts_col)), f"{ts_col}_day"
    if grain == "hour":
        return df.withColumn(f"{ts_col}_hour", F.date_format(ts_col, "yyyy-MM-dd-HH")), f"{ts_col}_hour"
    raise ValueError(f"unknown grain: {grain}")


def _clustered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows brought together by partition value before a write, so tasks do not each write every partition.

    Rebalancing lets the adaptive planner split a partition value that holds much of the data over several tasks.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_table(
    df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = (), compression: str = "zstd"
) -> None:
    """`overwrite` replaces the folder as a whole, whatever the session says of single partitions."""
    out = _clustered(df, partition_by).write.mode(mode).option("compression", compression)
    out = out.option("partitionOverwriteMode", "static")
    (out.partitionBy(*partition_by) if partition_by else out).parquet(path)


def conform(df: DataFrame, schema: str) -> DataFrame:
    """The columns of a declared schema, in its order and with its types; a column the frame lacks is an error."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in T.StructType.fromDDL(schema).fields])


def append_evolving(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append rows that may have columns the table lacks, or lack some it has."""
    write_table(df, path, "append", partition_by)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """The table with the columns of all its files; a column is null in rows written before it existed."""
    return spark.read.option("mergeSchema", True).parquet(path)


def union_evolving(old: DataFrame, new: DataFrame) -> DataFrame:
    """What a table holds after an evolving append."""
    return old.unionByName(new, allowMissingColumns=True)


def _checked(df: DataFrame, test: Column, message: str) -> DataFrame:
    """The rows, of which each that fails a test, or for which it is unknown, ends the job."""
    return df.filter(F.when(test, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def replaced(old: DataFrame, new: DataFrame, condition: Column) -> DataFrame:
    """Table content after the rows under `condition` gave way to new ones; stored rows where it is unknown stay.

    A new row outside the condition is an error: it would stand beside the row it was made to replace.
    """
    kept = old.filter(~F.coalesce(condition, F.lit(False)))
    return kept.unionByName(_checked(new, condition, "a new row is outside the replaced range"))


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace exactly the partitions the new rows fall into; the others are not read or written."""
    (
        _clustered(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at a path, in whatever store it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a pattern fits, in whatever store they lie."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return [status.getPath().toString() for status in found or ()]


def replace_days(df: DataFrame, path: str, day_col: str, first: date, last: date) -> None:
    """Make `df` the content of the days first to last of a table partitioned by day; other days are not touched."""
    replace_day_set(df, path, day_col, [first + timedelta(days=n) for n in range((last - first).days + 1)])


def replace_day_set(df: DataFrame, path: str, day_col: str, days: Sequence[date]) -> None:
    """Make `df` the content of these days of a table partitioned by day; other days are not touched.

    Only the produced day partitions are written, in place, and days of the set that have no rows any more are
    emptied. A row of another day, or of none, ends the job before anything is replaced.
    """
    seen = Observation()
    inside = F.col(day_col).isin(*days)
    rows = _checked(df, inside, f"a row is outside {min(days)} to {max(days)}, or of a day between that is not replaced")
    replace_partitions(rows.observe(seen, F.collect_set(day_col).alias("days")), path, [day_col])
    produced = {str(d) for d in seen.get["days"] or []}
    for day in days:
        if str(day) not in produced:
            delete(df.sparkSession, f"{path.rstrip('/')}/{day_col}={day}")


def merge_partitions(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str],
    key: str,
    changes: DataFrame,
    apply: Callable[[DataFrame, DataFrame], DataFrame],
) -> int:
    """Rewrite the partitions of a stored table that hold a key of `changes`; returns how many there were.

    The keys and partition columns alone tell which partitions those are; only their rows are read whole, given to `apply` with
    the changes, and written in place of what was there. A partition without such a key is neither read nor written.
    """
    stored = spark.read.parquet(path)
    asked = changes.select(key).distinct()
    found = stored.select(key, *partition_by).join(asked, key, "left_semi").select(*partition_by).distinct().collect()
    if not found:
        return 0
    inside = F.lit(False)
    for row in found:
        own = F.lit(True)
        for name in partition_by:
            own = own & F.col(name).eqNullSafe(F.lit(row[name]))
        inside = inside | own
    replace_partitions(apply(stored.filter(inside), changes).select(*stored.columns), path, partition_by)
    return len(found)


def full_refresh(df: DataFrame, path: str) -> None:
    """Replace a reference table as a whole."""
    df.write.mode("overwrite").parquet(path)


def ctas(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Create or replace a catalog table from a query."""
    out = _clustered(df, partition_by).write.mode("overwrite").format("parquet")
    (out.partitionBy(*partition_by) if partition_by else out).saveAsTable(name)


def refresh(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Recompute a stored rollup."""
    ctas(df, name)
    return spark.table(name)


def export_trips(trips: DataFrame, start, end, fmt: str, path: str) -> None:
    """Trips of a date range as JSON lines or CSV with a header, written in parallel."""
    if fmt not in V.EXPORT_FORMATS:
        raise ValueError(f"format must be one of {V.EXPORT_FORMATS}")
    out = P.in_range(trips, "pickup_datetime", start, end).write.mode("overwrite")
    if fmt == "json":
        out.json(path)
    else:
        out.option("header", True).csv(path)


# --- high-water marks -----------------------------------------------------------------------------------------------

def mark_row(spark: SparkSession, name: str, mark, updated) -> DataFrame:
    return spark.range(1).select(
        F.lit(name).alias("table_name"),
        C.moment(mark).alias("last_processed_date"),
        C.moment(updated).alias("last_updated"),
    )


def advance_hwm(control: DataFrame, name: str, mark, updated) -> DataFrame:
    """Control rows after setting the mark of a table: updated if it has one, inserted if not."""
    return upsert_marks(control, mark_row(control.sparkSession, name, mark, updated))


def upsert_marks(control: DataFrame, marks: DataFrame) -> DataFrame:
    """Control rows after a set of marks: the latest update of each table wins, a new mark over a stored one."""
    both = control.withColumn("_new", F.lit(0)).unionByName(marks.withColumn("_new", F.lit(1)))
    order = F.struct("last_updated", "_new")
    return both.groupBy("table_name").agg(
        F.max_by("last_processed_date", order).alias("last_processed_date"),
        F.max("last_updated").alias("last_updated"),
    )


# --- landing --------------------------------------------------------------------------------------------------------

def not_stored(fresh: DataFrame, stored: DataFrame | None, ts_col: str, but: Sequence[str] = ()) -> DataFrame:
    """Fresh rows, each once, that are not stored yet. A row is known by all its columns except `but`.

    Its time and a digest of all columns are the join key, so neither nulls nor the number of columns matter, and no key
    value is shared by many rows.
    """
    columns = [c for c in fresh.columns if c not in but]
    key = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns])
    once = fresh.withColumn("_key", key).dropDuplicates([ts_col, "_key"])
    if stored is None:
        return once.drop("_key")
    known = stored.select(ts_col, key.alias("_key"))
    return once.join(known, [ts_col, "_key"], "left_anti").drop("_key")
