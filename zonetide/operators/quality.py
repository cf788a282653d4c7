"""Data-quality checks. Each returns a frame, so a check is a query like any other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonetide.functions import columns as C
from zonetide.functions import fixed_values as V
from zonetide.operators.joins import diff_by_key
from zonetide.sources.roles import union_all


def not_empty(df: DataFrame) -> bool:
    return not df.isEmpty()


def emptiness(frames: dict[str, DataFrame]) -> DataFrame:
    """Dataset, rows, and whether it has any."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("dataset", F.lit(k)) for k, df in frames.items()]
    return union_all(parts).select("dataset", "n_rows", (F.col("n_rows") > 0).alias("passed"))


def required(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows missing each required field; a column the frame lacks is an error."""
    lacking = [c for c in cols if c not in df.columns]
    if lacking:
        raise ValueError(f"missing columns: {lacking}")
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = counts.unpivot(["n_rows"], list(cols), "column_name", "n_missing")
    return long.select("column_name", "n_rows", "n_missing", (F.col("n_missing") == 0).alias("passed"))


def null_pct(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Share of nulls per column in percent, from one pass."""
    names = list(cols or df.columns)
    shares = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in names])
    return shares.unpivot([], names, "column_name", "null_pct")


def compare_counts(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Row counts of source and copy per table, and whether they match."""
    parts = []
    for name, (a, b) in pairs.items():
        copy_rows = b.agg(F.count(F.lit(1))).scalar()
        parts.append(
            a.agg(F.count(F.lit(1)).alias("source_rows")).select(
                F.lit(name).alias("table_name"), "source_rows", copy_rows.alias("copy_rows")
            )
        )
    return union_all(parts).withColumn("matches", F.col("source_rows") == F.col("copy_rows"))


#: Key buckets of the first digests, and of the second ones within each bucket that differs.
DIGEST_BUCKETS = (1_024, 256)


def _digests(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per bucket a digest of its rows that does not depend on their order; repeated rows count."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in cols]
    rows = df.select(*keys, F.xxhash64(*text).alias("_h"), F.xxhash64(F.lit(1), *reversed(text)).alias("_g"))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.bit_xor("_h").alias("_x"),
        F.sum(F.col("_g").cast("decimal(20,0)")).alias("_s"),
    )


def suspects(a: DataFrame, b: DataFrame, key: str, cols: Sequence[str], buckets=DIGEST_BUCKETS) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides that can differ: those of key buckets whose digests do.

    Digests are partial aggregates, so tables that agree are compared without moving a row. Buckets that differ are
    digested again in finer ones. The lists of buckets are broadcast; their length is bounded by `buckets`.
    """
    names: list[str] = []
    for level, n in enumerate(buckets):
        name = f"_b{level}"
        spread = F.pmod(F.xxhash64(F.lit(level), F.col(key)), F.lit(n)).cast("int")
        a, b = a.withColumn(name, spread), b.withColumn(name, spread)
        names.append(name)
        left, right = _digests(a, names, [key, *cols]), _digests(b, names, [key, *cols])
        figures = ("_n", "_x", "_s")
        other = right.select(*names, *[F.col(c).alias(f"{c}2") for c in figures])
        differ = F.lit(False)
        for c in figures:
            differ = differ | ~F.col(c).eqNullSafe(F.col(f"{c}2"))
        unequal = left.join(other, names, "full").filter(differ).select(*names)
        a, b = (side.join(F.broadcast(unequal), names, "left_semi") for side in (a, b))
    return a.drop(*names), b.drop(*names)


def field_diff(a: DataFrame, b: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Per column: rows present on both sides that differ; plus rows missing on either side.

    Only rows of key buckets whose digests differ are joined.
    """
    wanted = [key, *cols]
    d = diff_by_key(*suspects(a.select(*wanted), b.select(*wanted), key, cols), key, cols)
    sums = d.agg(
        *[F.count_if(F.col(f"{c}_differs")).alias(c) for c in cols],
        F.count_if(F.col("status") == "missing_in_copy").alias("(missing in copy)"),
        F.count_if(F.col("status") == "missing_in_source").alias("(missing in source)"),
    )
    return sums.unpivot([], sums.columns, "field", "n_rows")


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Equal as multisets: digests first, then the rows of what differs, in case only the digests' text does."""
    key = a.columns[0]
    rest = [c for c in a.columns if c != key]
    left, right = suspects(a, b.select(*a.columns), key, rest)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def ops_allowed(changes: DataFrame, ops: Sequence[str] = V.ALL_OPS, op_col: str = "op") -> DataFrame:
    """Each operation with its count and whether it is allowed."""
    counts = changes.groupBy(F.col(op_col).alias("op")).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.withColumn("allowed", F.coalesce(F.col("op").isin(*ops), F.lit(False)))


def schema_diff(actual: DataFrame, expected: str) -> list[tuple[str, str | None, str | None]]:
    """Columns that differ from a declared schema: (name, expected type, actual type). Metadata only."""
    want = {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(expected).fields}
    have = dict(actual.dtypes)
    names = list(want) + [n for n in have if n not in want]
    return [(n, want.get(n), have.get(n)) for n in names if want.get(n) != have.get(n)]


def schema_report(df: DataFrame, expected: str) -> DataFrame:
    """Columns that differ from a declared schema, with the values a cast to the expected type would lose."""
    found = schema_diff(df, expected)
    losses = []
    for i, (name, want, have) in enumerate(found):
        lost = F.col(name).isNotNull() & F.col(name).try_cast(want).isNull() if want and have else F.lit(False)
        losses.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(want or "missing").alias("expected"),
                F.lit(have or "missing").alias("actual"),
                F.count_if(lost).alias("n_unfit"),
            ).alias(f"c{i}")
        )
    if not losses:
        empty = "column_name string, expected string, actual string, n_unfit bigint"
        return df.sparkSession.createDataFrame([], empty)
    return df.agg(F.array(*losses).alias("_all")).select(F.inline("_all"))


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact keys the dimension lacks, with their rows.

    Keys are counted before the anti join, so a hot key is one row when it is shuffled.
    """
    keys = fact.filter(F.col(fact_key).isNotNull()).groupBy(F.col(fact_key).alias("missing_key")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return keys.join(dim.select(F.col(dim_key).alias("missing_key")), "missing_key", "left_anti")


def missing_hours(df: DataFrame, ts_col: str) -> DataFrame:
    """Hours between the first and the last of a series that have no row."""
    have = df.select(C.hour_of(ts_col).alias("missing_hour")).distinct()
    span = df.agg(C.hour_of(F.min(ts_col)).alias("a"), C.hour_of(F.max(ts_col)).alias("b"))
    grid = span.filter(F.col("a").isNotNull()).select(
        F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 hour"))).alias("missing_hour")
    )
    return grid.join(have, "missing_hour", "left_anti")


def outliers(df: DataFrame, cols: Sequence[str], k: float = 3.0) -> DataFrame:
    """Rows more than k sample deviations from the mean in any of the columns, with a flag per column."""
    limits = df.agg(
        F.struct(
            *[
                F.struct((F.avg(c) - k * F.stddev(c)).alias("low"), (F.avg(c) + k * F.stddev(c)).alias("high")).alias(c)
                for c in cols
            ]
        )
    ).scalar()
    flagged = df.withColumn("_limits", limits)
    flags = {}
    for c in cols:
        low, high = F.col(f"_limits.{c}.low"), F.col(f"_limits.{c}.high")
        flags[f"{c}_outlier"] = F.coalesce((F.col(c) < low) | (F.col(c) > high), F.lit(False))
    out = flagged.withColumns(flags).drop("_limits")
    hit = F.lit(False)
    for name in flags:
        hit = hit | F.col(name)
    return out.filter(hit)


def outliers_iqr(df: DataFrame, col: str, k: float = 1.5, accuracy: int = 10_000) -> DataFrame:
    """Rows outside the quartiles by more than k quartile ranges (approximate quartiles)."""
    q = df.agg(F.percentile_approx(col, [0.25, 0.75], accuracy)).scalar()
    marked = df.withColumn("_q", q)
    width = F.col("_q")[1] - F.col("_q")[0]
    out = (F.col(col) < F.col("_q")[0] - k * width) | (F.col(col) > F.col("_q")[1] + k * width)
    return marked.filter(out).drop("_q")


def freshness(df: DataFrame, ts_col: str, as_of) -> DataFrame:
    """Newest row, its age in minutes at `as_of`, and the rows per hour of the covered span."""
    newest, oldest = F.max(ts_col), F.min(ts_col)
    seconds = F.unix_timestamp(C.moment(as_of)) - F.unix_timestamp(newest)
    span = F.greatest(F.unix_timestamp(newest) - F.unix_timestamp(oldest), F.lit(1)) / 3600
    return df.agg(
        newest.alias("newest"),
        (seconds / 60).alias("age_minutes"),
        F.count(F.lit(1)).alias("n_rows"),
        (F.count(F.lit(1)) / span).alias("rows_per_hour"),
    )


def rows_per_interval(df: DataFrame, ts_col: str, length: str = "1 hour") -> DataFrame:
    w = F.window(ts_col, length)
    return df.groupBy(w.alias("_w")).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.col("_w.start").alias("window_start"), "n_rows"
    )
