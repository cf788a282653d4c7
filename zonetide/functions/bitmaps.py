"""Exact distinct counts of whole numbers by bitmaps, which merge: of partial results, days, or either side of a route.

A bitmap holds 32,768 numbers; larger ranges take one per bucket. Counting needs no row per distinct value and no copy of the
rows per counted column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bits(values: str | Column) -> Column:
    """Aggregate: the numbers of one bucket as a bitmap."""
    return F.bitmap_construct_agg(F.bitmap_bit_position(values))


def bucket(values: str | Column) -> Column:
    return F.bitmap_bucket_number(values)


def distinct_bits(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """`keys`, `bucket` and `bits` of the numbers in `col`; nulls are left out."""
    return df.filter(F.col(col).isNotNull()).groupBy(*keys, bucket(col).alias("bucket")).agg(bits(col).alias("bits"))


def count_bits(parts: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """How many different numbers the bitmaps of each key hold together."""
    whole = parts.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return whole.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
