"""Landing: raw trips, weather and zones to their curated form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonetide.functions import columns as C
from zonetide.functions import fixed_values as V
from zonetide.sources import schemas

CURATED_ORDER = tuple(column.split()[0] for column in schemas.CURATED_TRIPS.split(", "))


def rename_trips(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(V.RAW_TRIP_NAMES)


def clean_trips(raw: DataFrame, pickup="tpep_pickup_datetime", dropoff="tpep_dropoff_datetime") -> DataFrame:
    """Valid trips: both times present, positive distance, fare and total, one to six passengers."""
    return raw.filter(
        F.col(pickup).isNotNull()
        & F.col(dropoff).isNotNull()
        & (F.col("trip_distance") > 0)
        & (F.col("fare_amount") > 0)
        & (F.col("total_amount") > 0)
        & F.col("passenger_count").between(1, 6)
    )


def with_date_parts(df: DataFrame, ts_col: str) -> DataFrame:
    parts = C.date_parts(ts_col)
    return df.withColumns({name: parts[name] for name in ("year", "month", "day")})


def with_load_date(df: DataFrame, as_of=None) -> DataFrame:
    return df.withColumn("load_date", F.current_timestamp() if as_of is None else C.moment(as_of))


def curate_trips(raw: DataFrame, as_of=None) -> DataFrame:
    """Raw trips to the 23 curated columns, valid rows only."""
    cleaned = rename_trips(clean_trips(raw))
    return with_date_parts(with_load_date(cleaned, as_of), "pickup_datetime").select(*CURATED_ORDER)


def curate_weather(raw: DataFrame, as_of=None) -> DataFrame:
    """Weather records with a parsed time; rows whose time does not parse are dropped."""
    parsed = raw.withColumn("timestamp", C.parse_ts("timestamp")).filter(F.col("timestamp").isNotNull())
    return with_date_parts(with_load_date(parsed, as_of), "timestamp")


def curate_zones(raw: DataFrame, as_of=None) -> DataFrame:
    renamed = raw.withColumnsRenamed({"lat": "latitude", "lon": "longitude"})
    return with_load_date(renamed.withColumn("created_at", C.parse_ts("created_at")), as_of)


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Defaults for columns a dimension did not fill."""

    def filled(name: str, value) -> Column:
        literal = C.num(value) if isinstance(value, float) else F.lit(value)
        return F.coalesce(F.col(name), literal)

    return df.withColumns({name: filled(name, value) for name, value in defaults.items()})
