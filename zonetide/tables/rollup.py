"""Stored rollups of mergeable parts: a day's parts are made from that day's rows alone, and a read combines the days.

Two tables hold the parts, both partitioned by day: counts and sums per key, and bitmaps of the values to be counted. A late or
corrected day is made again by itself; the other days are neither read nor written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonetide.functions import bitmaps
from zonetide.functions.columns import moment
from zonetide.tables import store as K

DAY = "part_day"


@dataclass(frozen=True)
class Rollup:
    """Means of `means`, sums of `sums` and distinct counts of the whole numbers in `distinct`, per `keys`."""

    spark: SparkSession
    path: str
    ts_col: str
    keys: Sequence[str]
    sums: Sequence[str] = ()
    means: Sequence[str] = ()
    distinct: Sequence[str] = ()

    def _parts(self, rows: DataFrame) -> DataFrame:
        columns = dict.fromkeys([*self.sums, *self.means])
        return rows.groupBy(F.to_date(self.ts_col).alias(DAY), *self.keys).agg(
            F.count(F.lit(1)).alias("n_rows"),
            *[F.sum(c).alias(f"{c}_sum") for c in columns],
            *[F.count(c).alias(f"{c}_n") for c in columns],
        )

    def _bits(self, rows: DataFrame) -> DataFrame:
        """All counted columns from one pass: a row per column and value range."""
        sides = F.explode(
            F.array(*[F.struct(F.lit(c).alias("counted"), F.col(c).cast("bigint").alias("value")) for c in self.distinct])
        )
        long = rows.select(F.to_date(self.ts_col).alias(DAY), *self.keys, sides.alias("_s")).select(DAY, *self.keys, "_s.*")
        return bitmaps.distinct_bits(long, [DAY, *self.keys, "counted"], "value")

    def refresh(self, rows: DataFrame, days: Sequence[date]) -> None:
        """Make the parts of these days again. `rows` is the whole fact; only rows of these days are taken from it."""
        if not days:
            return
        first, last = min(days), max(days)
        inside = (F.col(self.ts_col) >= moment(datetime(first.year, first.month, first.day))) & (
            F.col(self.ts_col) < F.date_add(F.lit(last), 1).cast("timestamp")
        )
        own = rows.filter(inside & F.to_date(self.ts_col).isin(*days))
        K.replace_day_set(self._parts(own), f"{self.path}/parts", DAY, days)
        if self.distinct:
            K.replace_day_set(self._bits(own), f"{self.path}/bits", DAY, days)

    def read(self, since: date | None = None, until: date | None = None) -> DataFrame:
        """The rollup of all stored days, or of a range of them; of the stored parts only these days are read."""

        def stored(name: str) -> DataFrame:
            df = self.spark.read.parquet(f"{self.path}/{name}")
            if since is not None:
                df = df.filter(F.col(DAY) >= F.lit(since))
            return df if until is None else df.filter(F.col(DAY) <= F.lit(until))

        whole = stored("parts").groupBy(*self.keys).agg(
            F.sum("n_rows").alias("n_rows"),
            *[F.sum(f"{c}_sum").alias(f"total_{c}") for c in self.sums],
            *[(F.sum(f"{c}_sum") / F.nullif(F.sum(f"{c}_n"), F.lit(0))).alias(f"avg_{c}") for c in self.means],
        )
        if not self.distinct:
            return whole
        counted = bitmaps.count_bits(stored("bits"), [*self.keys, "counted"], "n")
        wide = counted.groupBy(*[F.col(k).alias(f"_{k}") for k in self.keys]).agg(
            *[F.max(F.when(F.col("counted") == c, F.col("n"))).alias(f"distinct_{c}") for c in self.distinct]
        )
        same = F.lit(True)
        for k in self.keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        joined = whole.join(wide, same, "left").drop(*[f"_{k}" for k in self.keys])
        return joined.fillna(0, [f"distinct_{c}" for c in self.distinct])


def late_days(rows: DataFrame, ts_col: str, load_col: str, since: datetime) -> list[date]:
    """The days that rows loaded after `since` fall into: few, whatever the number of rows."""
    fresh = rows.filter(F.col(load_col) > moment(since)).select(F.to_date(ts_col).alias("day")).distinct()
    return sorted(r["day"] for r in fresh.collect() if r["day"] is not None)
