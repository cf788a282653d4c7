"""Sources: files, tables, databases and change streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonetide.functions.columns import interval, moment
from zonetide.sources import schemas


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables, with its declared schema."""
    return spark.read.schema(schemas.TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def read_trips(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Raw or curated trips; without a schema the file footer decides."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def list_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """`file` and `modified` of the files under a path. Only the listing is read: no file is opened."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    )
    return listed.select(F.col("path").alias("file"), F.col("modificationTime").alias("modified"))


def read_trips_between(spark: SparkSession, path: str, start: datetime, end: datetime, schema=None) -> DataFrame:
    """Trips of a table partitioned by (year, month) with pickup in [start, end].

    The year/month predicate is implied by the range; stating it lets the scan skip whole directories.
    """
    month_no = F.col("year") * 12 + F.col("month")
    return read_trips(spark, path, schema).filter(
        F.col("year").between(start.year, end.year)
        & month_no.between(start.year * 12 + start.month, end.year * 12 + end.month)
        & F.col("pickup_datetime").between(moment(start), moment(end))
    )


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file (or folder of files) that each hold one JSON array of records."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_change_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    """Subscribe to a topic; needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", "false")
        .load()
    )


def read_file_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", per_batch: int | None = None):
    """A folder of arriving files as a stream; also how a parquet table is read as one."""
    reader = spark.readStream.schema(schema)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.format(fmt).load(path)


def read_table_stream(spark: SparkSession, name: str) -> DataFrame:
    return spark.readStream.table(name)


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def named_query(spark: SparkSession, query: str, **params) -> DataFrame:
    """A SQL query with bound `:name` parameters; values never become part of the text."""
    return spark.sql(query, args=params)


def read_jdbc(spark, url, dbtable, key=None, lower=None, upper=None, parts=16, **properties) -> DataFrame:
    """A database table; with a numeric key the read is split into `parts` ranges, one task each."""
    if key is None:
        return spark.read.jdbc(url, dbtable, properties=properties)
    return spark.read.jdbc(
        url, dbtable, column=key, lowerBound=lower, upperBound=upper, numPartitions=parts, properties=properties
    )


def incremental(df: DataFrame, control: DataFrame, name: str, ts_col: str, as_of, default="30 days") -> DataFrame:
    """Rows past the stored high-water mark of `name`; without a mark, the trailing default interval.

    The mark is a scalar subquery, so it is known before the scan starts and is pushed into it as a literal.
    """
    mark = control.filter(F.col("table_name") == name).agg(F.max("last_processed_date")).scalar()
    return df.filter(F.col(ts_col) > F.coalesce(mark, moment(as_of) - interval(default)))
