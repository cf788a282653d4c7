"""Row filters. All compare the raw column with a literal, so the scan can skip files and row groups."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonetide.functions import fixed_values as V
from zonetide.functions.columns import interval, moment


def check_bound(name: str, value: int) -> int:
    """A serving parameter inside its bounds, or an error."""
    low, high = V.BOUNDS[name]
    if not low <= value <= high:
        raise ValueError(f"{name} must be between {low} and {high}, not {value}")
    return value


def positive(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.filter(reduce(Column.__and__, [F.col(c) > 0 for c in cols]))


def trailing(df: DataFrame, ts_col: str, as_of, length: str | None) -> DataFrame:
    """Rows from `length` before `as_of` up to `as_of`; no length keeps everything up to `as_of`."""
    until = moment(as_of)
    out = df.filter(F.col(ts_col) <= until)
    return out if length is None else out.filter(F.col(ts_col) >= until - interval(length))


def trailing_each(df: DataFrame, ts_col: str, as_of, lengths: Sequence[str]) -> DataFrame:
    """For each length the rows that `trailing` keeps, marked with it in `length`: one scan, cut at the longest."""
    until = moment(as_of)
    inside = F.filter(
        F.array(*[F.struct(F.lit(n).alias("length"), (until - interval(n)).alias("since")) for n in lengths]),
        lambda x: F.col(ts_col) >= x["since"],
    )
    since = F.least(*[until - interval(n) for n in lengths]) if len(lengths) > 1 else until - interval(lengths[0])
    recent = df.filter((F.col(ts_col) <= until) & (F.col(ts_col) >= since))
    return recent.select("*", F.explode(inside).alias("_l")).withColumn("length", F.col("_l.length")).drop("_l")


def in_range(df: DataFrame, ts_col: str, start, end) -> DataFrame:
    """Closed range."""
    return df.filter(F.col(ts_col).between(moment(start), moment(end)))


def on_day(df: DataFrame, ts_col: str, day) -> DataFrame:
    """Rows of one calendar day, as a half-open range on the raw column."""
    start = moment(str(day))
    return df.filter((F.col(ts_col) >= start) & (F.col(ts_col) < start + interval("1 day")))


def keep_ops(changes: DataFrame, ops: Sequence[str] = V.ROW_OPS, op_col: str = "op") -> DataFrame:
    return changes.filter(F.col(op_col).isin(*ops))


def valid_changes(rows: DataFrame) -> DataFrame:
    """Change rows with a pickup zone and a positive fare."""
    return rows.filter(F.col("pickup_location_id").isNotNull() & (F.col("fare_amount") > 0))


def min_activity(df: DataFrame, count_col: str, more_than: int) -> DataFrame:
    return df.filter(F.col(count_col) > more_than)


def apply_filters(
    df: DataFrame,
    dates: tuple | None = None,
    zone_ids: Sequence[int] | None = None,
    borough: str | Sequence[str] | None = None,
    conditions: Sequence[str] | None = None,
    fares: tuple[float | None, float | None] = (None, None),
    ts_col: str = "pickup_datetime",
    zone_col: str = "pickup_location_id",
) -> DataFrame:
    """The optional filter set of the dashboards; an absent part filters nothing."""
    tests: list[Column] = []
    if dates:
        tests.append(F.col(ts_col).between(moment(dates[0]), moment(dates[1])))
    if zone_ids is not None:
        tests.append(F.col(zone_col).isin(*zone_ids))
    if borough is not None:
        names = [borough] if isinstance(borough, str) else list(borough)
        tests.append(F.col("borough").isin(*names))
    if conditions is not None:
        tests.append(F.col("weather_condition").isin(*conditions))
    low, high = fares
    if low is not None:
        tests.append(F.col("fare_amount") >= low)
    if high is not None:
        tests.append(F.col("fare_amount") <= high)
    return df.filter(reduce(Column.__and__, tests)) if tests else df
