"""Window features over the zone-hour rollup, and ranks over data of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonetide.functions import columns as C
from zonetide.functions import fixed_values as V

ZONE, HOUR, DEMAND = "location_id", "hour_timestamp", "demand_count"


def zone_series(hour_col: str = HOUR):
    """The one window spec of a zone's hours; everything below shares its shuffle and sort."""
    return Window.partitionBy(ZONE).orderBy(hour_col)


def add_lags(demand: DataFrame, ks: Sequence[int] = V.LAG_HOURS, value: str = DEMAND, hour_col: str = HOUR):
    """`lag_<k>` columns: the value k rows earlier in the zone."""
    w = zone_series(hour_col)
    return demand.withColumns({f"lag_{k}": F.lag(value, k).over(w) for k in ks})


def add_rolling(demand: DataFrame, specs: dict[str, tuple[str, int]], value: str = DEMAND, hour_col: str = HOUR):
    """Means (`avg`) and sample deviations (`stddev`) of the previous n rows, one column per spec.

    Null values count for nothing. Whole numbers take differences of running totals: the work per row does not depend on
    the frame length, where a sliding frame of 720 rows would be summed again for each row, and the differences are
    exact. For other types they would not be, so those take sliding frames.
    """
    w = zone_series(hour_col)
    whole = isinstance(demand.schema[value].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    made: dict[str, Column] = {}
    if not whole:
        for name, (kind, length) in specs.items():
            made[name] = {"avg": F.avg, "stddev": F.stddev_samp}[kind](value).over(w.rowsBetween(-length, -1))
        return demand.withColumns(made)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = demand.withColumns(
        {
            "_n": F.count(value).over(running),
            "_s": F.sum(value).over(running),
            "_q": F.sum((F.col(value) * F.col(value)).cast("decimal(28,0)")).over(running),
        }
    )

    def framed(name: str, length: int) -> Column:
        return F.coalesce(F.lag(name, 1).over(w), F.lit(0)) - F.coalesce(F.lag(name, length + 1).over(w), F.lit(0))

    for name, (kind, length) in specs.items():
        count = framed("_n", length)
        total = framed("_s", length)
        if kind == "avg":
            made[name] = F.when(count > 0, total.cast("double") / count)
        elif kind == "stddev":
            exact = total.cast("decimal(18,0)")
            spread = count * framed("_q", length) - exact * exact
            variance = spread.cast("double") / (count.cast("double") * (count - 1))
            made[name] = F.when(count > 1, F.sqrt(variance))
        else:
            raise ValueError(f"unknown frame function: {kind}")
    return out.withColumns(made).drop("_n", "_s", "_q")


def vs_group_mean(df: DataFrame, count_col: str, zone_col: str, name: str = "zone_mean") -> DataFrame:
    """A group count next to the mean of its zone's counts."""
    return df.withColumn(name, F.avg(count_col).over(Window.partitionBy(zone_col)))


# --- ranks over everything ------------------------------------------------------------------------------------------

SPLITS = 128
SAMPLE_ROWS = 8192


def with_global_rank(df: DataFrame, value: str, tie: str, name: str = "rank") -> DataFrame:
    """1-based position in the order (value, tie) and the row count, without one task holding all rows.

    Percentiles of a sample only choose where to cut; the rank is exact. The sample is the rows with the smallest
    hashes of the tie column, so it and the cuts are the same each time they are evaluated. A row falls between two
    cuts or on one; rows on a cut share their value, so they are cut again by the tie column, which splits a heavily
    repeated value. The buckets follow the order, so a rank is the rows in earlier buckets plus the position within
    the bucket. The bucket table has at most (2 * SPLITS + 1) * SPLITS rows. The tie column must be unique.
    """
    at = ", ".join(f"{i / SPLITS}D" for i in range(1, SPLITS))

    def percentiles(column: str) -> str:
        # More accuracy than sampled rows: nothing is approximated.
        return f"percentile_approx(`{column}`, array({at}), {4 * SAMPLE_ROWS})"

    sample = df.select(value, tie).orderBy(F.xxhash64(tie), tie).limit(SAMPLE_ROWS)
    cuts = sample.agg(F.expr(f"struct({percentiles(value)} AS v, {percentiles(tie)} AS t)")).scalar()
    cut = df.withColumn("_cuts", cuts)
    v, t = F.col("_cuts.v"), F.col("_cuts.t")
    below = F.size(F.filter(v, lambda x: x < F.col(value)))
    on_cut = F.array_contains(v, F.col(value))
    split = F.when(on_cut, F.size(F.filter(t, lambda x: x < F.col(tie)))).otherwise(0)
    # Repeated cuts make `below` jump, which keeps the order; + 0.5 places a cut's own bucket before the gap after it.
    bucketed = cut.withColumns(
        {"_b": below.cast("double") + F.when(on_cut, 0.5).otherwise(0.0), "_t": split}
    ).drop("_cuts")
    sizes = bucketed.groupBy("_b", "_t").agg(F.count(F.lit(1)).alias("_size"))
    order = Window.partitionBy(F.lit(0)).orderBy("_b", "_t")
    placed = sizes.select(
        "_b",
        "_t",
        (F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_size")).alias(
            "_before"
        ),
        F.sum("_size").over(Window.partitionBy(F.lit(0))).alias("_rows"),
    )
    inside = F.row_number().over(Window.partitionBy("_b", "_t").orderBy(value, tie))
    return (
        bucketed.withColumn("_in", inside)
        .join(F.broadcast(placed), ["_b", "_t"])
        .withColumn(name, F.col("_before") + F.col("_in"))
        .drop("_b", "_t", "_before", "_in")
    )


def ntile_of(rank: Column, rows: Column, n: int) -> Column:
    """The tile of a rank: the first (rows mod n) tiles are one row longer."""
    base, longer = F.floor(rows / n), rows % n
    head = longer * (base + 1)
    in_head = F.floor((rank - 1) / (base + 1)) + 1
    in_tail = F.floor((rank - 1 - head) / F.greatest(base, F.lit(1))) + longer + 1
    return F.when(rank <= head, in_head).otherwise(in_tail).cast("int")


def zone_popularity(demand: DataFrame, n: int = 10) -> DataFrame:
    """Tile of each zone's mean demand, ties by zone id."""
    means = demand.groupBy(ZONE).agg(F.avg(DEMAND).alias("avg_demand"))
    ranked = with_global_rank(means, "avg_demand", ZONE)
    return ranked.select(ZONE, "avg_demand", ntile_of(F.col("rank"), F.col("_rows"), n).alias("popularity_decile"))


# --- dense hours ----------------------------------------------------------------------------------------------------

def demand_grid(demand: DataFrame, start, end) -> DataFrame:
    """Every zone with every hour of [start, end], demand 0 where it had none: row offsets become hour offsets.

    A zone's hours are gathered in one row, at most as many as the range has, and the missing ones are added where that row is
    expanded: only the rows that there are get shuffled, and no task holds more than a zone's hours.
    """
    since, until = C.moment(start), C.moment(end)
    once = demand.groupBy(ZONE, HOUR).agg(F.sum(DEMAND).alias(DEMAND))
    zero = F.lit(0).cast(once.schema[DEMAND].dataType)
    row = F.struct(F.col(HOUR), F.coalesce(DEMAND, zero).alias(DEMAND))
    # Those outside the range are null, which a list leaves out; their zone stays.
    held = once.groupBy(ZONE).agg(F.collect_list(F.when(F.col(HOUR).between(since, until), row)).alias("_held"))
    hours = F.sequence(since, until, F.expr("INTERVAL 1 hour"))
    idle = F.array_except(hours, F.transform("_held", lambda x: x[HOUR]))
    zeros = F.transform(idle, lambda h: F.struct(h.alias(HOUR), zero.alias(DEMAND)))
    return held.select(ZONE, F.inline(F.concat("_held", zeros)))
