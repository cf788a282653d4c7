"""Dimension joins.

A right side is broadcast here only when its rows are bounded by the arguments (hours in an interval, or a caller's own
bound) and so are its bytes. Otherwise the adaptive planner chooses the join by measured bytes, and splits a hot key of the
fact where both sides are plain exchanges; statistics of the fact itself are made one. Nothing is counted while a query is
built.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonetide.functions import columns as C
from zonetide.functions import fixed_values as V

BROADCAST_BYTES = 64 << 20


def hours_in(length: str) -> int:
    """Whole hours touched by an interval: the most rows an hourly series can have in it."""
    n, unit = re.match(r"\s*(\d+)\s+(\w+?)s?\s*$", length).groups()
    seconds = int(n) * {"microsecond": 1e-6, "second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}[unit.lower()]
    return int(seconds // 3600) + 2


def row_bytes(df: DataFrame) -> int:
    """About the most a row takes in a broadcast table: a word a field, and 64 bytes for text and nested values."""
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return 32 + sum(8 if isinstance(f.dataType, fixed) else 72 for f in df.schema.fields)


def fits(dim: DataFrame, rows: int | None, limit: int | None = None) -> bool:
    """Whether a side may be broadcast by a known bound of its rows; never by counting them."""
    limit = BROADCAST_BYTES if limit is None else limit
    return rows is not None and rows * row_bytes(dim) <= limit


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: list[str],
    how: str = "left",
    rows: int | None = None,
    limit: int | None = None,
    own: bool = False,
) -> DataFrame:
    """Fact joined (`left` or `inner`) to a side that has at most one row per key.

    `rows` is a proven upper bound of the side's rows, `limit` the bytes a broadcast may have; `own` says that the side was
    aggregated from the fact by these keys.
    """
    if fits(dim, rows, limit):
        return fact.join(F.broadcast(dim), keys, how)
    return splittable_join(fact, dim, keys, how) if own else fact.join(dim, keys, how)


def splittable_join(fact: DataFrame, dim: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """A join whose hot keys the adaptive planner can split although one side is an aggregate by the same keys.

    It splits a key only between two plain exchanges, and an aggregate that is dealt out by the keys already would get none. A
    further key, always 0 but computed, asks for one: it carries one row per group, and the fact's hot partitions are then
    cut by measured size. If the groups prove small, they are broadcast instead.
    """
    zero = F.pmod(F.xxhash64(*keys), F.lit(1).cast("bigint"))
    joined = fact.withColumn("_zero", zero).join(dim.withColumn("_zero", zero), [*keys, "_zero"], how)
    rest = [c for c in fact.columns if c not in keys]
    return joined.select(*keys, *rest, *[c for c in dim.columns if c not in keys])


# --- weather --------------------------------------------------------------------------------------------------------

def dedupe_hourly(weather: DataFrame, ts_col: str = "timestamp", load_col: str | None = "load_date") -> DataFrame:
    """One weather row per hour: latest load, then latest time.

    Hourly loads repeat earlier hours, so an hour joined raw would multiply its trips. The maximum of a struct is a
    partial aggregate: repeats collapse before the shuffle, however many one hour has.
    """
    first = [load_col, ts_col] if load_col else [ts_col]
    rest = [c for c in weather.columns if c not in first]
    best = weather.withColumn("hour_timestamp", C.hour_of(ts_col)).groupBy("hour_timestamp").agg(
        F.max(F.struct(*first, *rest)).alias("_best")
    )
    return best.select("hour_timestamp", *[F.col(f"_best.{c}").alias(c) for c in weather.columns])


WEATHER_COLUMNS = ("weather_condition", "temperature_celsius", "humidity_percent", "wind_speed_kmh")


def hourly_weather(weather: DataFrame, columns, as_of=None, length: str | None = None) -> tuple[DataFrame, int | None]:
    """Deduplicated weather (`hour_timestamp` and the asked columns) and the most rows it can have.

    With one row per hour, the hours of the interval bound the rows; without an interval nothing is known.
    """
    rows = None
    if as_of is not None and length is not None:
        until = C.moment(as_of)
        since = C.hour_of(until - C.interval(length))
        weather = weather.filter((F.col("timestamp") >= since) & (F.col("timestamp") <= until))
        rows = hours_in(length)
    load_col = "load_date" if "load_date" in weather.columns else None
    return dedupe_hourly(weather, load_col=load_col).select("hour_timestamp", *columns), rows


def join_weather_hour(
    df: DataFrame, weather: DataFrame, hour_col: str, columns=WEATHER_COLUMNS, as_of=None, length: str | None = None
) -> DataFrame:
    """Fact with a truncated hour column, left-joined to the weather of that hour in the trailing interval."""
    w, rows = hourly_weather(weather, columns, as_of, length)
    return lookup_join(df, w.withColumnRenamed("hour_timestamp", hour_col), [hour_col], rows=rows)


def join_weather_parts(
    df: DataFrame, weather: DataFrame, date_col="trip_date", hour_col="hour", as_of=None, length: str | None = None
) -> DataFrame:
    """Fact with date and hour-of-day columns, left-joined to the weather of that hour in the trailing interval."""
    w, rows = hourly_weather(weather, WEATHER_COLUMNS, as_of, length)
    parts = w.select(
        F.to_date("hour_timestamp").alias(date_col), F.hour("hour_timestamp").alias(hour_col), *WEATHER_COLUMNS
    )
    return lookup_join(df, parts, [date_col, hour_col], rows=rows)


# --- zones ----------------------------------------------------------------------------------------------------------

def join_zone(
    df: DataFrame,
    zones: DataFrame,
    key: str,
    columns: list[str],
    how: str = "left",
    prefix: str = "",
    rows: int | None = None,
) -> DataFrame:
    """Fact joined to the zone dimension on `key`; zone columns get `prefix`."""
    side = zones.select(F.col("location_id").alias(key), *[F.col(c).alias(f"{prefix}{c}") for c in columns])
    return lookup_join(df, side, [key], how, rows)


def join_both_zones(
    trips: DataFrame, zones: DataFrame, columns: list[str], how: str = "left", rows: int | None = None
) -> DataFrame:
    """The zone dimension in two roles: pickup and drop-off."""
    once = join_zone(trips, zones, "pickup_location_id", columns, how, "pickup_", rows)
    return join_zone(once, zones, "dropoff_location_id", columns, how, "dropoff_", rows)


def join_required(df: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    """Only rows with a match: the inner form of a left join followed by `is not null`."""
    return lookup_join(df, dim, keys, "inner")


def join_pick_drop(pickups: DataFrame, dropoffs: DataFrame, keys=("location_id", "trip_date", "hour")) -> DataFrame:
    """Pickup rollup with the drop-offs of the same zone-hour; both sides come out of aggregates on these keys."""
    joined = pickups.join(dropoffs, list(keys), "left")
    return joined.withColumn("total_dropoffs", F.coalesce("total_dropoffs", F.lit(0).cast("bigint")))


def join_own_stats(df: DataFrame, stats: DataFrame, keys: list[str], rows: int | None = None) -> DataFrame:
    """Fact with group statistics of itself; `rows` is the most groups there can be, if that is known."""
    return lookup_join(df, stats, keys, rows=rows, own=True)


# --- shapes ---------------------------------------------------------------------------------------------------------

def expand_hours(df: DataFrame, as_of, hours: int, name: str = "prediction_hour", since=None) -> DataFrame:
    """Each row once per future hour 1..hours; with `since`, only hours from then on are made."""
    start = C.moment(as_of)
    first = start + C.interval("1 hour")
    if since is not None:
        ahead = F.ceil((C.moment(since).cast("double") - start.cast("double")) / 3600).cast("int")
        first = start + F.make_dt_interval(F.lit(0), F.greatest(ahead, F.lit(1)), F.lit(0), F.lit(0))
        df = df.filter(first <= start + C.interval(f"{hours} hours"))
    steps = F.sequence(
        first, start + C.interval(f"{hours} hours"), F.expr("INTERVAL 1 hour")
    )
    return df.withColumn(name, F.explode(steps))


def diff_by_key(a: DataFrame, b: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Source and copy side by side per key, with one `<col>_differs` flag per column and a status.

    A full outer join, so rows missing on one side are found as well.
    """
    left = a.select(key, F.lit(True).alias("_a"), *[F.col(c).alias(f"{c}_source") for c in cols])
    right = b.select(key, F.lit(True).alias("_b"), *[F.col(c).alias(f"{c}_copy") for c in cols])
    both = left.join(right, key, "full")
    here = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    flags = {
        f"{c}_differs": here & ~F.col(f"{c}_source").eqNullSafe(F.col(f"{c}_copy")) for c in cols
    }
    out = both.withColumns(flags)
    any_diff: Column = F.lit(False)
    for name in flags:
        any_diff = any_diff | F.col(name)
    status = (
        F.when(F.col("_b").isNull(), "missing_in_copy")
        .when(F.col("_a").isNull(), "missing_in_source")
        .when(any_diff, "differs")
        .otherwise("same")
    )
    return out.withColumn("status", status).drop("_a", "_b")


# --- neighbourhood --------------------------------------------------------------------------------------------------

#: Cells of the coarsest level along a radius, levels, and how many cells of a level lie along one of the level above.
CELLS_PER_RADIUS, LEVELS, FINER = 4, 3, 4
#: A cell on the rim that holds this few places is not refined: its places are compared themselves.
FEW_PLACES = 4
#: The level of single places, whose node is the place itself.
SINGLE = -1
#: Of a cell beside a circle: not judged yet, inside, on the rim, and on the rim but to be looked at more finely.
_NEW, _INSIDE, _RIM, _OPEN = range(4)


def _cells(places: DataFrame, radius: float) -> DataFrame:
    """Places with their cell on every level, as `cells`: level and cell numbers; coarse cells are unions of finer ones."""
    finest = radius / (CELLS_PER_RADIUS * FINER ** (LEVELS - 1))
    at = [F.floor(F.col(c) / F.lit(finest)) for c in ("lat", "lon")]
    levels = [
        F.struct(
            F.lit(level).alias("level"),
            *[F.floor(x / FINER ** (LEVELS - 1 - level)).cast("double").alias(n) for x, n in zip(at, ("kx", "ky"))],
        )
        for level in range(LEVELS)
    ]
    return places.withColumn("cells", F.array(*levels))


def neighbourhood(places: DataFrame, radius: float) -> DataFrame:
    """For each place (`lat`, `lon`) the nodes that together are the places within `radius`: `level`, `kx`, `ky`.

    Whole coarse cells come first. Only cells on the rim of the circle are looked at on the next finer level, as long as they hold
    more than a few places; what is left on the rim is compared place by place. A dense cluster on the rim so costs its cells
    along the rim, not its places.
    """
    slack = 1e-9
    numbered = _cells(places, radius)
    coarse = F.element_at("cells", 1)
    cells = numbered.groupBy(coarse["kx"].alias("kx"), coarse["ky"].alias("ky")).agg(F.count(F.lit(1)).alias("n_places"))

    def judged(pairs: DataFrame, level: int) -> DataFrame:
        """Cells that are still to be judged: outside ones go, the others lie inside the circle or on its rim."""
        size = radius / (CELLS_PER_RADIUS * FINER**level)
        near, far = F.lit(0.0), F.lit(0.0)
        for p, k in (("lat", "kx"), ("lon", "ky")):
            low, high = F.col(k) * size, (F.col(k) + 1) * size
            gap = F.greatest(low - F.col(p), F.col(p) - high, F.lit(0.0))
            reach = F.greatest(F.abs(F.col(p) - low), F.abs(F.col(p) - high))
            near, far = near + gap * gap, far + reach * reach
        fresh = F.col("state") == _NEW
        inside = F.sqrt(far) < radius * (1 - slack)
        return pairs.filter(~fresh | (F.sqrt(near) <= radius * (1 + slack))).withColumn(
            "state", F.when(~fresh, F.col("state")).when(inside, _INSIDE).otherwise(_RIM)
        )

    around = F.sequence(F.lit(-CELLS_PER_RADIUS - 1), F.lit(CELLS_PER_RADIUS + 1))
    probes = numbered.select("lat", "lon", coarse["kx"].alias("cx"), coarse["ky"].alias("cy"))
    probes = probes.withColumn("dx", F.explode(around)).withColumn("dy", F.explode(around)).select(
        "lat", "lon", F.lit(0).alias("level"), (F.col("cx") + F.col("dx")).alias("kx"), (F.col("cy") + F.col("dy")).alias("ky"),
        F.lit(_NEW).alias("state"),
    )
    rows = judged(probes, 0).join(cells, ["kx", "ky"])
    rows = rows.withColumn("state", F.when((F.col("state") == _RIM) & (F.col("n_places") > FEW_PLACES), _OPEN).otherwise(F.col("state")))
    for level in range(1, LEVELS):
        # Finer cells are told by arithmetic alone; empty ones meet no demand and no place.
        own = F.struct("level", "kx", "ky", "state")
        parts = [
            F.struct(
                F.lit(level).alias("level"), (F.col("kx") * FINER + i).alias("kx"), (F.col("ky") * FINER + j).alias("ky"),
                F.lit(_NEW).alias("state"),
            )
            for i in range(FINER)
            for j in range(FINER)
        ]
        cut = rows.select("lat", "lon", F.inline(F.when(F.col("state") == _OPEN, F.array(*parts)).otherwise(F.array(own))))
        rows = judged(cut, level)
        if level < LEVELS - 1:
            fresh_rim = (F.col("state") == _RIM) & (F.col("level") == level)
            rows = rows.withColumn("state", F.when(fresh_rim, _OPEN).otherwise(F.col("state")))
    others = numbered.select(F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), F.inline("cells"))
    same = [rows[c] == others[c] for c in ("level", "kx", "ky")]
    near = rows.join(others, [*same, rows["state"] == _RIM], "left").filter(
        (rows["state"] == _INSIDE)
        | (C.planar_distance("lat", "lon", "lat2", "lon2") <= radius * V.KM_PER_DEGREE)
    )
    single = rows["state"] == _RIM
    return near.select(
        "lat",
        "lon",
        F.when(single, SINGLE).otherwise(rows["level"]).alias("level"),
        F.when(single, F.col("lat2")).otherwise(rows["kx"]).alias("kx"),
        F.when(single, F.col("lon2")).otherwise(rows["ky"]).alias("ky"),
    )


def nearby_demand(demand: DataFrame, zones: DataFrame, km: float, value: str = "demand_count") -> DataFrame:
    """Demand of the other zones within `km` in the same hour, for each zone-hour.

    Zones at one place count as one. A place's `neighbourhood` is made once, whatever the number of hours; demand is added up
    per node and hour, and a place's hour asks the nodes for that hour. Node and hour are the key, so a dense cell is
    spread over its hours, and what is asked for very often within one can be split.
    """
    radius = km / V.KM_PER_DEGREE
    place = zones.select("location_id", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    at = lookup_join(demand.select("location_id", "hour_timestamp", value), place, ["location_id"])
    spots = at.filter(F.col("lat").isNotNull()).groupBy("lat", "lon", "hour_timestamp").agg(F.sum(value).alias("_v"))
    # Of the zones alone: a small table, beside which the demand is not read again.
    around = neighbourhood(place.filter("lat IS NOT NULL AND lon IS NOT NULL").select("lat", "lon").distinct(), radius)
    own = F.array(F.struct(F.lit(SINGLE).alias("level"), F.col("lat").alias("kx"), F.col("lon").alias("ky")))
    nodes = _cells(spots, radius).select("hour_timestamp", "_v", F.inline(F.concat("cells", own)))
    totals = nodes.groupBy("level", "kx", "ky", "hour_timestamp").agg(F.sum("_v").alias("_v"))
    asked = spots.select("lat", "lon", "hour_timestamp").join(around, ["lat", "lon"])
    sums = (
        splittable_join(asked, totals, ["level", "kx", "ky", "hour_timestamp"], "inner")
        .groupBy("lat", "lon", "hour_timestamp")
        .agg(F.sum("_v").alias("_around"))
    )
    others = F.when(F.col("_around").isNull(), F.lit(0)).otherwise(F.col("_around") - F.col(value))
    return (
        at.join(sums, ["lat", "lon", "hour_timestamp"], "left")
        .withColumn("nearby_zones_demand", others.cast("bigint"))
        .select("location_id", "hour_timestamp", value, "nearby_zones_demand")
    )
