"""Hard-negative mining: integer scores by Strassen's multiplication over tiles of anchors and blocks of candidates.

Anchors and candidates are ordered by label and packed into tiles and blocks of bounded size. Groups of tiles meet slices of
blocks in a co-grouped shuffle, so a task holds one of each whatever the table's size. Two rounds run over the same
blocks: one multiplies what shares a label and keeps each anchor's best positives, one multiplies what differs and keeps, for
each positive, the best scores inside its window. Both keep heaps of a few rows, which merge in any order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonetide.llm.common import map_batches, ship, stored

#: Rows of one tile of anchors and of one block of candidates; tiles of a group and blocks of a slice, which meet in one task.
TILE, BLOCK = 256, 2_048
TILES, BLOCKS = 16, 4
#: Strassen halves all three sides until one is this small.
LEAST = 16
#: No score may pass 2 ** 63: by Cauchy and Schwarz none does if no squared length passes this.
MAX_SQUARE = float(1 << 62)


@dataclass(frozen=True)
class Rules:
    """The first `positives` rows of an anchor's label; for each, the first `negatives` rows of another label whose score
    times 100 lies between `low` and `high` times the positive's score.
    """

    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two int64 matrices by seven products of halves, where odd sides are padded with zeros.

    Sums wrap around at 64 bits, so the result is exact whenever the product itself fits, whatever the halves' sums do.
    """
    n, k, m = a.shape[0], a.shape[1], b.shape[1]
    if min(n, k, m) <= LEAST:
        return a @ b
    if n % 2 or k % 2 or m % 2:
        a = np.pad(a, ((0, n % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, m % 2)))
        return strassen(a, b)[:n, :m]
    h, i, j = n // 2, k // 2, m // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((n, m), dtype=np.int64)
    out[:h, :j] = p1 + p4 - p5 + p7
    out[:h, j:] = p3 + p5
    out[h:, :j] = p2 + p4
    out[h:, j:] = p1 - p2 + p3 + p6
    return out


class Heap:
    """The first `size` of what was pushed: higher scores first, then smaller ids. Heaps merge by pushing one into another."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.scores, self.ids = np.array([], np.int64), np.array([], np.int64)

    def push(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.size:
            # Everything that ties with the last place is kept until ids decide.
            least = np.partition(scores, len(scores) - self.size)[len(scores) - self.size]
            near = scores >= least
            scores, ids = scores[near], ids[near]
        if len(self.scores) == self.size and len(scores):
            near = scores >= self.scores[-1]
            scores, ids = scores[near], ids[near]
        if len(scores):
            scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
            # No score is the least int64, so its negative is exact.
            order = np.lexsort((ids, -scores))[: self.size]
            self.scores, self.ids = scores[order], ids[order]


def valid(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(False))


def quantised(vector: Column, scale: int = 256) -> Column:
    """Each component x as the integer floor(scale * x)."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def _rows(vectors: DataFrame) -> DataFrame:
    """One row of `id`, `label` and integer `vector` per id; one that could overflow a score ends the job."""
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    fits = F.when(square < MAX_SQUARE, F.col("vector")).otherwise(
        F.raise_error(F.lit("a vector is too long for scores of 64 bits")).cast("array<bigint>")
    )
    rows = vectors.filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    once = rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return once.select("id", "row.label", "row.vector").withColumn("vector", fits)


def _packed(rows: DataFrame, size: int, limits: bool) -> DataFrame:
    """Rows in order of label, in matrices of at most `size` rows: `part` and `place` number them, `low` and `high` are the
    labels' bounds. Shorter vectors are filled up with zeros. With `limits`, each row's `found` scores go along.
    """

    def pack(part: int, place: int, batch: list[dict]) -> dict:
        width = max((len(r["vector"]) for r in batch), default=0)
        matrix = np.zeros((len(batch), width), dtype=np.int64)
        for k, r in enumerate(batch):
            matrix[k, : len(r["vector"])] = r["vector"]
        top = int(np.abs(matrix).max(initial=0))
        kind = next(k for k in ("i1", "i2", "i4", "i8") if top <= np.iinfo(k).max)
        labels = [r["label"] for r in batch]
        out = {
            "part": part, "place": place, "low": min(labels), "high": max(labels), "kind": kind, "width": width,
            "ids": [r["id"] for r in batch], "labels": labels, "matrix": matrix.astype(kind).tobytes(),
        }
        return out | ({"found": [r["found"] for r in batch]} if limits else {})

    fields = [
        ("part", pa.int32()), ("place", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("kind", pa.string()),
        ("width", pa.int32()), ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())), ("matrix", pa.binary()),
        *([("found", pa.list_(pa.list_(pa.int64())))] if limits else []),
    ]
    schema = pa.schema(fields)

    def run(batches):
        held, place = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                held.append(row)
                if len(held) == size:
                    yield pa.RecordBatch.from_pylist([pack(held[0]["part"], place, held)], schema=schema)
                    held, place = [], place + 1
        if held:
            yield pa.RecordBatch.from_pylist([pack(held[0]["part"], place, held)], schema=schema)

    dealt = rows.repartitionByRange("label", "id").sortWithinPartitions("label", "id")
    return map_batches(
        dealt.withColumn("part", F.spark_partition_id()),
        run,
        "part int, place int, low bigint, high bigint, kind string, width int, ids array<bigint>, labels array<bigint>, "
        "matrix binary" + (", found array<array<bigint>>" if limits else ""),
    )


def _numbered(packed: DataFrame, per: int) -> tuple[DataFrame, int]:
    """Packed rows with the number of their group of `per`, and how many groups there are.

    The driver gets one small row per partition, never the matrices.
    """
    counts = sorted((r["part"], r["n"]) for r in packed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
    before, total = [], 0
    for part, n in counts:
        before.append((part, total))
        total += n
    starts = packed.sparkSession.createDataFrame(before, "part int, before bigint")
    grouped = packed.join(F.broadcast(starts), "part").withColumn(
        "group", F.floor((F.col("before") + F.col("place")) / per).cast("int")
    )
    return grouped.drop("before", "part", "place"), -(-total // per)


def _matrix(row: dict, width: int) -> np.ndarray:
    own = np.frombuffer(row["matrix"], dtype=row["kind"]).reshape(len(row["ids"]), row["width"]).astype(np.int64)
    return np.pad(own, ((0, 0), (0, width - row["width"]))) if width > row["width"] else own


def _products(tiles: pa.Table, blocks: pa.Table, wanted):
    """Score matrices of the tiles and blocks that `wanted` names by their label bounds, with ids and labels."""
    right = [(r, np.array(r["ids"], np.int64), np.array(r["labels"], np.int64)) for r in blocks.to_pylist()]
    for tile in tiles.to_pylist():
        ids, labels = np.array(tile["ids"], np.int64), np.array(tile["labels"], np.int64)
        for block, other_ids, other_labels in right:
            if wanted(tile, block):
                width = max(tile["width"], block["width"])
                scores = strassen(_matrix(tile, width), np.ascontiguousarray(_matrix(block, width).T))
                yield tile, ids, labels, other_ids, other_labels, scores


_FOUND = "anchor_id bigint, positive_id bigint, positive_score bigint, id bigint, score bigint"


def _found(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[]] * 5
    names = ["anchor_id", "positive_id", "positive_score", "id", "score"]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})


def _positives(rules: Rules):
    def run(_, tiles: pa.Table, blocks: pa.Table) -> pa.Table:
        heaps: dict[int, Heap] = {}
        same = lambda t, b: t["low"] <= b["high"] and b["low"] <= t["high"]
        for _tile, ids, labels, other_ids, other_labels, scores in _products(tiles, blocks, same):
            for k, anchor in enumerate(ids.tolist()):
                own = (other_labels == labels[k]) & (other_ids != anchor)
                heaps.setdefault(anchor, Heap(rules.positives)).push(scores[k][own], other_ids[own])
        return _found(
            [(a, None, None, i, s) for a, h in heaps.items() for i, s in zip(h.ids.tolist(), h.scores.tolist())]
        )

    return run


def _negatives(rules: Rules):
    def run(_, tiles: pa.Table, blocks: pa.Table) -> pa.Table:
        heaps: dict[tuple[int, int, int], Heap] = {}
        differ = lambda t, b: not t["low"] == t["high"] == b["low"] == b["high"]
        for tile, ids, labels, other_ids, other_labels, scores in _products(tiles, blocks, differ):
            for k, (anchor, found) in enumerate(zip(ids.tolist(), tile["found"])):
                pairs = list(zip(found[::2], found[1::2]))
                if not pairs:
                    continue
                # Bounds in whole numbers: 100 * score >= low * positive is score >= the quotient rounded up.
                bounds = [(-(-rules.low * p // 100), rules.high * p // 100) for _, p in pairs]
                row = scores[k]
                near = (row >= min(b[0] for b in bounds)) & (row <= max(b[1] for b in bounds)) & (other_labels != labels[k])
                near_scores, near_ids = row[near], other_ids[near]
                for (positive, score), (low, high) in zip(pairs, bounds):
                    inside = (near_scores >= low) & (near_scores <= high)
                    heap = heaps.setdefault((anchor, positive, score), Heap(rules.negatives))
                    heap.push(near_scores[inside], near_ids[inside])
        return _found(
            [(*key, i, s) for key, h in heaps.items() for i, s in zip(h.ids.tolist(), h.scores.tolist())]
        )

    return run


def _meet(tiles: tuple[DataFrame, int], blocks: tuple[DataFrame, int], run) -> DataFrame:
    """Each group of tiles with each slice of blocks, in a task of its own: the anchors are a stated query set."""
    (left, groups), (right, slices) = tiles, blocks
    left = left.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(max(slices, 1) - 1))))
    right = right.withColumnRenamed("group", "slice").withColumn(
        "group", F.explode(F.sequence(F.lit(0), F.lit(max(groups, 1) - 1)))
    )
    ship(left.sparkSession)
    return left.groupBy("group", "slice").cogroup(right.groupBy("group", "slice")).applyInArrow(run, _FOUND)


def mine(vectors: DataFrame, anchor: Column, rules: Rules = Rules()) -> DataFrame:
    """Hard negatives of the rows that fulfil `anchor`, a condition on `id`: `anchor_id`, `positive_id`, `rank`,
    `negative_id`, `positive_score`, `negative_score`.

    `vectors` has an `id` and a `label` of whole numbers and a `vector` of whole numbers. Rows with a null in any of the three
    take no part; of rows that share an id, the one of the smallest label and vector counts. Vectors of different lengths are
    multiplied as if the shorter had zeros. A vector whose scores could pass 64 bits ends the job. Ties go to the smaller id;
    an anchor without a row of its label, and a positive without a row in its window, give none.
    """
    wide = vectors.select(
        F.col("id").cast("bigint").alias("id"),
        F.col("label").cast("bigint").alias("label"),
        F.col("vector").cast("array<bigint>").alias("vector"),
    )
    rows = stored(_rows(wide), "vectors")
    blocks = _numbered(stored(_packed(rows, BLOCK, limits=False), "blocks"), BLOCKS)
    anchors = rows.filter(anchor)
    plain = _numbered(stored(_packed(anchors, TILE, limits=False), "tiles"), TILES)
    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    found = _meet(plain, blocks, _positives(rules)).withColumn("place", F.row_number().over(first))
    best = found.filter(F.col("place") <= rules.positives).groupBy("anchor_id").agg(
        F.flatten(F.sort_array(F.collect_list(F.array("id", "score")))).alias("found")
    )
    limits = anchors.join(best, F.col("id") == F.col("anchor_id")).drop("anchor_id")
    limited = _numbered(stored(_packed(stored(limits, "positives"), TILE, limits=True), "limits"), TILES)
    hard = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id")
    ranked = _meet(limited, blocks, _negatives(rules)).withColumn("rank", F.row_number().over(hard))
    return ranked.filter(F.col("rank") <= rules.negatives).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """`mine` over `embeddings` (`vec_id`, `embedding`, `label`): anchors are the ids divisible by 100, every seventh label is
    one too high, components count in whole 256ths.

    Rows with a null id or label, a null vector, or a null or non-finite component take no part. Other columns are not read.
    """
    label = F.col("label").cast("bigint")
    return mine(
        embeddings.filter(valid(F.col("embedding"))).select(
            F.col("vec_id").alias("id"),
            F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
            quantised(F.col("embedding")).alias("vector"),
        ),
        F.col("id") % 100 == 0,
    )


ORACLE = """
WITH e AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
           CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
    FROM e a, e c WHERE a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
), p AS (
    SELECT * FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), n AS (
    SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5
"""
