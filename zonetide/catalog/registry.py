"""Where queries and their oracles meet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from zonetide.catalog.role_sql import r
from zonetide.functions.columns import rnd
from zonetide.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Event tables cover 2024-01-01 to 2024-01-30, so this interval is all of them.
AS_OF = "2024-01-31 00:00:00"
ALL_EVENTS = "30 days"
EVENTS_FROM, EVENTS_TO = "2024-01-01 00:00:00", "2024-01-31 00:00:00"
DAY = "2024-01-15"


#: Queries that run a job of several steps (a stream, a stored merge) and return what it stored.
JOBS: set[str] = set()


def register(
    key: str, run: Query, sql: str | None = None, doubles: str = "", digits: int = 4, job: bool = False
) -> None:
    """A query and its oracle; the named double columns are rounded on both sides before they are compared."""
    if job:
        JOBS.add(key)
    if key in QUERIES:
        raise ValueError(f"registered twice: {key}")
    names = doubles.split()

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = run(prepare(spark), sf_dir)
        return out.withColumns({c: rnd(c, digits) for c in names}) if names else out

    QUERIES[key] = query
    if sql is not None:
        if names:
            swaps = ", ".join(f'{r(f"{chr(34)}{c}{chr(34)}", digits)} AS "{c}"' for c in names)
            sql = f"SELECT * REPLACE ({swaps}) FROM ({sql})"
        ORACLES[key] = sql
