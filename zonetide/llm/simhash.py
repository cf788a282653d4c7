"""SimHash near-duplicates: fingerprints, links within a Hamming radius by BK-trees over shards, and components.

Two fingerprints that differ in at most r bits agree in one at least of any r + 1 pieces, and in k at least of r + k. The
pieces they agree in name a shard, so every link lies inside some shard. Each shard's tree is built where the shard is, and
is not broadcast: the trees of all shards together hold the fingerprints of all documents, which has no bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonetide.llm.common import blocks, cut, map_batches, spare, texts
from zonetide.llm.components import components

WORDS, RADIUS, SEED = 4, 4, 42
#: Fingerprints that a shard should hold on average; the pieces are chosen for it.
SHARD = 64
#: Fingerprints in one block of a shard. A larger shard is cut into blocks, and each pair of blocks is a task's unit.
BLOCK = 2048
_HASHES = 1 << 16


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The majority of every bit over all shingles' digests; no words: zero."""
    parts = text.lower().split()  # bytes: A-Z only, and the six ASCII spaces only
    if not parts:
        return 0
    n = max(1, len(parts) - words + 1)
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    begin = np.concatenate([[0], ends[: n - 1]]).tolist()
    stop = (ends[min(words, len(parts)) - 1 :] - 1).tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for k in range(0, n, _HASHES):
        hashes = [digest(joined[b:e], SEED) for b, e in zip(begin[k : k + _HASHES], stop[k : k + _HASHES])]
        raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, *others: str) -> DataFrame:
    """`doc_id`, the asked columns and `fp` (the fingerprint's 64 bits as a signed integer) of every whole text."""
    read = texts(docs, *others)
    schema = read.drop("text").schema.add("fp", "long")
    kept = [c for c in read.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole):
                place = batch.schema.get_field_index("text")
                raw = batch.column(place).cast(pa.binary()).to_pylist()
                found = np.array([fingerprint(t, words) for t in raw], dtype=np.uint64).view(np.int64)
                columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found)], names=[*kept, "fp"])

    return map_batches(read, run, schema)


class Tree:
    """BK-tree: a child hangs below its parent at the key that is their distance."""

    def __init__(self) -> None:
        self.root: list | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = [value, {}]
            return
        node = self.root
        while (d := (node[0] ^ value).bit_count()) and (below := node[1].get(d)):
            node = below
        if d:
            node[1][d] = [value, {}]

    def near(self, value: int, radius: int) -> list[int]:
        """All values within the radius. By the triangle inequality only edges d - radius to d + radius lead to any."""
        found, open_ = [], [self.root] if self.root else []
        while open_:
            node = open_.pop()
            d = (node[0] ^ value).bit_count()
            if d <= radius:
                found.append(node[0])
            below = node[1]
            if len(below) <= 2 * radius + 1:
                open_ += [c for e, c in below.items() if d - radius <= e <= d + radius]
            else:
                open_ += [below[e] for e in range(max(1, d - radius), d + radius + 1) if e in below]
        return found


def _unit_links(left: list[int], right: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join what no earlier link of this unit joined: a forest over the unit's linked values.

    `left` alone is compared with itself; with `right`, each value of `right` is compared with `left`.
    """
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := above.get(x, x)) != x:
            above[x] = x = above.get(up, up)
        return x

    tree, links = Tree(), []
    for side, values in ((0, left), (1, right)):
        for value in values:
            if side or not right:
                for other in tree.near(value, radius):
                    a, b = top(value), top(other)
                    if a != b:
                        above[max(a, b)] = min(a, b)
                        links.append((other, value))
            if not side:
                tree.add(value)
    return links


def pieces_for(n: int, radius: int = RADIUS) -> tuple[int, int]:
    """(pieces, pieces that must agree): the fewest for which n evenly spread fingerprints give shards of SHARD."""
    for agree in range(1, 5):
        pieces = radius + agree
        if n / 2 ** (64 * agree // pieces) <= SHARD:
            break
    return pieces, agree


def _shards(fp: Column, radius: int, n: int) -> Column:
    """The shard names of a fingerprint: for each choice of pieces, its number and the bits in those pieces."""
    pieces, agree = pieces_for(n, radius)
    edges = [64 * k // pieces for k in range(pieces + 1)]
    names = []
    for number, chosen in enumerate(combinations(range(pieces), agree)):
        mask = sum(((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        names.append(F.struct(F.lit(number).alias("choice"), fp.bitwiseAND(F.lit(signed)).alias("bits")))
    return F.array(*names)


def links_within(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links (`u`, `v`) between distinct fingerprints `fp` such that their components are those of all links within the
    radius: each unit gives a forest, never all pairs.

    A shard of more than `block` fingerprints is cut into blocks by a hash, and every pair of blocks is a unit of its own,
    so no task holds more than two blocks at once however hot a shard is, and no pair is left out.
    """
    n = prints.count()
    member = prints.select("fp", F.explode(_shards(F.col("fp"), radius, n)).alias("shard")).select("fp", "shard.*")
    large = (
        member.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > block)
        .select("choice", "bits", F.ceil(F.col("size") / block).cast("int").alias("cuts"))
    )
    marked = member.join(cut(large), ["choice", "bits"], "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("cuts")).cast("int")
    units = marked.withColumn("own", own).select(
        "fp", "choice", "bits", "own", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("other")
    )
    units = units.select(
        "choice", "bits", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "fp"
    )
    key = ["choice", "bits", "a", "b"]
    dealt = units.repartition(*key).sortWithinPartitions(*key, "own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left, right = None, [], []

        def done() -> list[tuple[int, int]]:
            if len(left) + len(right) < 2 or (last[2] != last[3] and not (left and right)):
                return []
            return _unit_links(left, right, radius)

        for batch in batches:
            out = []
            for *unit, own_, fp in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if unit != last:
                    out += done()
                    last, left, right = unit, [], []
                (left if own_ == unit[2] else right).append(fp & 0xFFFFFFFFFFFFFFFF)
            yield _link_batch(out)
        if last is not None:
            yield _link_batch(done())

    return map_batches(dealt, run, "u bigint, v bigint").distinct()


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])


def grouped(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(`fp`, `root`) of every distinct fingerprint: the root is the smallest fingerprint of its component."""
    distinct = cut(prints.select("fp").distinct())
    found = components(links_within(distinct, radius)).withColumnRenamed("node", "fp")
    return distinct.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """`doc_id`, `fingerprint` (16 hex digits) and `component_id` of every whole text, one result row per row.

    The component is the smallest id reachable over links between fingerprints at `radius` or fewer differing bits. Null
    and empty texts, and texts without words, have fingerprint zero and are linked like any other. Null ids stay and count
    for no component; a component of null ids only is null. Repeated rows repeat, an empty table gives an empty one.
    """
    prints = cut(fingerprints(docs, words))
    roots = cut(grouped(prints, radius))
    # Least id per fingerprint first, then per component: small partial sums, whatever the size of a group.
    by_print = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots, "fp")
    by_root = by_print.groupBy("root").agg(F.min("least").alias("component_id"))
    named = cut(roots.join(by_root, "root").select("fp", "component_id"))
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of which each group of near-duplicates keeps one: that with the smallest id.

    Of rows that share the smallest id, or if all ids of a group are null, a digest of id and text decides; rows equal
    in both are one row. Columns, their order and values stay.
    """
    mark = spare(docs, "row_digest")
    marked = docs.withColumn(mark, F.xxhash64("doc_id", "text"))
    prints = cut(
        fingerprints(marked.select("doc_id", "text", F.col(f"`{mark}`").alias("row_digest")), words, "row_digest")
    )
    roots = cut(grouped(prints, radius))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_digest")
    by_print = prints.groupBy("fp").agg(F.min(order).alias("first")).join(roots, "fp")
    firsts = by_print.groupBy("root").agg(F.min("first").alias("first"))
    chosen = cut(firsts.select(F.col("first.row_digest").alias(mark)).distinct())
    # Repeats collapse before the shuffle; the join reads the same partitions.
    return marked.dropDuplicates([mark]).join(chosen, mark, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
