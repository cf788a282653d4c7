"""Sorts, limits and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonetide.functions import fixed_values as V
from zonetide.functions.columns import moment
from zonetide.operators.filters import check_bound, trailing

RECENT_COLUMNS = (
    "trip_id", "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
    "pickup_location_id", "dropoff_location_id", "fare_amount", "tip_amount", "total_amount", "payment_type",
)
FORECAST_ORDER = ["-predicted_demand", "prediction_hour", "location_id", "hour_of_day", "day_of_week"]


def top_recent(df: DataFrame, ts_col: str, n: int, tie: str) -> DataFrame:
    """The newest n rows; each task keeps n, so nothing is sorted as a whole."""
    return df.orderBy(F.desc(ts_col), F.desc(tie)).limit(n)


def recent_trips(trips: DataFrame, as_of, hours: int = 24, limit: int = 100) -> DataFrame:
    recent = trailing(trips, "pickup_datetime", as_of, f"{check_bound('hours_back', hours)} hours")
    return top_recent(recent.select(*RECENT_COLUMNS), "pickup_datetime", check_bound("limit", limit), "trip_id")


def sort_keys(cols: list[str]) -> list[Column]:
    """Column names to sort keys; a leading `-` means descending."""
    return [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in cols]


def order_multi(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.orderBy(*sort_keys(cols))


def sorted_report(df: DataFrame, cols: list[str]) -> DataFrame:
    """A rollup in presentation order."""
    return order_multi(df, cols)


def nlargest(df: DataFrame, col: str, n: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(col), F.asc(tie)).limit(n)


def top_forecast(forecast: DataFrame, zones: int = 20, hours: int = 24) -> DataFrame:
    """The first `zones x min(hours, 24)` rows of a forecast by demand, at most 1000."""
    rows = check_bound("top_zones", zones) * min(check_bound("hours_ahead", hours), V.FORECAST_DAY_HOURS)
    return forecast.orderBy(*sort_keys(FORECAST_ORDER)).limit(min(rows, V.FORECAST_CAP))


def paginate(df: DataFrame, order: list[str], page: int, size: int) -> DataFrame:
    """One page with total_count and total_pages; the count is a scalar subquery, pages are cut by offset."""
    if page < 1 or size < 1:
        raise ValueError("page and size start at 1")
    total = df.agg(F.count(F.lit(1))).scalar()
    rows = df.orderBy(*sort_keys(order)).offset((page - 1) * size).limit(size)
    return rows.withColumns(
        {
            "total_count": total,
            "page": F.lit(page),
            "page_size": F.lit(size),
            "total_pages": F.ceil(total / size).cast("bigint"),
        }
    )


#: Rows of a bucket, and how many smaller ones a listing may have: each is a task and a folder.
ROWS_PER_BUCKET, SMALL_BUCKETS = 100_000, 1_000


def build_pages(df: DataFrame, order: list[str], path: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> None:
    """Store a listing in range buckets of its order, with a directory of how many rows each holds and come before it.

    Any page is then read from the one or two buckets that hold it (`read_page`), however deep it lies. The order's columns must
    be unique together. Buckets are of about `rows_per_bucket` rows; a listing that would have very many gets larger ones instead, of
    `ROWS_PER_BUCKET` rows at most, so that a page reads no more than that however long the listing is.
    """
    spark = df.sparkSession
    n = df.agg(F.count(F.lit(1))).first()[0]
    buckets = min(-(-n // rows_per_bucket), max(SMALL_BUCKETS, -(-n // ROWS_PER_BUCKET)))
    ranged = df.repartitionByRange(max(1, buckets), *sort_keys(order))
    ranged.withColumn("bucket", F.spark_partition_id()).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/rows")
    # The columns, which an empty listing would not tell.
    df.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")
    rows = _listing(spark, path)
    # A row per bucket: the window over them is small whatever the listing.
    counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0))).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/directory"
    )


def _listing(spark: SparkSession, path: str) -> DataFrame:
    schema = spark.read.parquet(f"{path}/columns").schema.add("bucket", "integer")
    return spark.read.schema(schema).parquet(f"{path}/rows")


def read_page(spark: SparkSession, path: str, order: list[str], page: int, size: int) -> DataFrame:
    """One page of a listing stored by `build_pages`, with the columns of `paginate`: only the buckets that hold it are read."""
    if page < 1 or size < 1:
        raise ValueError("page and size start at 1")
    start = (page - 1) * size
    buckets = spark.read.parquet(f"{path}/directory").collect()
    total = sum(b["n"] for b in buckets)
    held = [b for b in buckets if b["before"] < start + size and b["before"] + b["n"] > start]
    rows = _listing(spark, path).filter(F.col("bucket").isin([b["bucket"] for b in held])).drop("bucket")
    skip = start - min((b["before"] for b in held), default=start)
    return rows.orderBy(*sort_keys(order)).offset(skip).limit(size).withColumns(
        {
            "total_count": F.lit(total).cast("bigint"),
            "page": F.lit(page),
            "page_size": F.lit(size),
            "total_pages": F.lit(-(-total // size)).cast("bigint"),
        }
    )


def page_after(df: DataFrame, ts_col: str, tie: str, after: tuple | None, size: int) -> DataFrame:
    """The next page of a newest-first listing after the (time, id) of the last row seen.

    Reads the same amount for every page, where an offset reads everything before it.
    """
    rows = df
    if after is not None:
        ts, key = moment(after[0]), F.lit(after[1])
        rows = df.filter((F.col(ts_col) < ts) | ((F.col(ts_col) == ts) & (F.col(tie) < key)))
    return top_recent(rows, ts_col, size, tie)
