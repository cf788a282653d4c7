"""Connected components of a link table, in rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonetide.llm.common import cut

#: Rounds grow with the logarithm of the longest chain; more than this means a fault, not a large input.
MAX_ROUNDS = 60


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """One half round: every node's neighbours are linked to the smallest of them and itself.

    The large half takes both directions and moves the neighbours above the node, the small half takes the neighbours
    below it and moves them and the node. The minimum is a partial aggregate, and it is stored, so that the join reads two
    plain exchanges and a node with very many links is split like any hot join key.
    """
    if large:
        ways = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        ways = links.select(F.col("v").alias("u"), F.col("u").alias("v"))
    least = cut(ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    near = ways.join(least, "u")
    if large:
        moved = near.filter(F.col("v") > F.col("u")).select(F.col("m").alias("u"), F.col("v"))
    else:
        moved = near.select(F.col("m").alias("u"), F.col("v")).unionByName(
            least.select(F.col("m").alias("u"), F.col("u").alias("v"))
        )
    return moved.filter(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(`node`, `root`) for every node that has a link, roots included; the root is the smallest node of the component.

    `links` has columns `u` and `v` of one orderable type. Each round is stored in the shared folder, so lost executors
    cost a round at most; two sums tell the driver whether it changed anything. No component is ever gathered anywhere.
    """
    ordered = links.filter(F.col("u") != F.col("v")).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    now = cut(ordered.distinct())
    seen = None
    for _ in range(MAX_ROUNDS):
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen:
            break
        seen = mark
        if mark[0] == 0:
            break
        now = cut(_stars(_stars(now, large=True), large=False))
    else:
        raise RuntimeError(f"no fixed point in {MAX_ROUNDS} rounds")
    leaves = now.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return leaves.unionByName(now.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
