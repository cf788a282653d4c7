"""Hard-negative mining: the multiplication, the heaps, and the rows against a plain version."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonetide.llm import negatives as N

SCHEMA = "vec_id bigint, embedding array<float>, label int, score double, id string, rank int"


@pytest.mark.parametrize("shape", [(1, 1, 1), (17, 33, 19), (64, 64, 64), (100, 7, 300), (33, 64, 129), (0, 5, 4)])
def test_strassen_is_exact(shape):
    n, k, m = shape
    rnd = np.random.default_rng(n)
    a, b = rnd.integers(-(1 << 28), 1 << 28, (n, k)), rnd.integers(-(1 << 28), 1 << 28, (k, m))
    want = a.astype(object) @ b.astype(object) if n else np.zeros((0, m))
    assert (N.strassen(a, b) == want).all()


def test_halves_may_overflow_where_the_product_does_not():
    a = np.full((64, 64), (1 << 62) // 64, dtype=np.int64)
    assert (N.strassen(a, np.eye(64, dtype=np.int64)) == a).all()


def test_heaps_merge_in_any_order():
    rnd = random.Random(3)
    rows = [(rnd.randrange(5), k) for k in range(200)]
    want = sorted(rows, key=lambda r: (-r[0], r[1]))[:5]
    for _ in range(20):
        rnd.shuffle(rows)
        heaps = []
        for at in range(0, 200, 23):
            heap = N.Heap(5)
            heap.push(np.array([r[0] for r in rows[at : at + 23]]), np.array([r[1] for r in rows[at : at + 23]]))
            heaps.append(heap)
        whole = N.Heap(5)
        for heap in heaps:
            whole.push(heap.scores, heap.ids)
        assert list(zip(whole.scores.tolist(), whole.ids.tolist())) == want


def plain(rows):
    """The contract, pair by pair."""
    kept = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = int(math.fmod(label + 1, 10)) if i % 7 == 0 else label
        row = (label, [math.floor(256 * float(np.float32(x))) for x in v])
        kept[i] = min(kept.get(i, row), row)
    out = []
    score = lambda a, b: sum(x * y for x, y in zip(kept[a][1], kept[b][1]))
    for a in kept:
        if a % 100:
            continue
        scored = sorted(((-score(a, i), i) for i in kept if i != a))
        for p, positive in [(-s, i) for s, i in scored if kept[i][0] == kept[a][0]][:5]:
            near = [(-s, i) for s, i in scored if kept[i][0] != kept[a][0] and 80 * p <= -100 * s <= 100 * p]
            out += [(a, positive, k, i, p, s) for k, (s, i) in enumerate(near[:5], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, 0.5, "x", 1) for i, v, y in rows], SCHEMA)


def values(df):
    return sorted(
        (r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"])
        for r in df.collect()
    )


@pytest.mark.parametrize("tile", [2, 256])
def test_rows_equal_the_plain_version(spark, monkeypatch, tile):
    monkeypatch.setattr(N, "TILE", tile)
    monkeypatch.setattr(N, "BLOCK", 3 * tile)
    monkeypatch.setattr(N, "TILES", 2)
    monkeypatch.setattr(N, "BLOCKS", 2)
    rnd = random.Random(tile)
    # Few different components: many ties, scores of zero and below; one vector stands very often.
    rows = [(25 * k, [rnd.choice([-0.5, 0.0, 0.25, 0.5, 0.51]) for _ in range(6)], rnd.randrange(-1, 4)) for k in range(120)]
    rows += [(25 * k + 1, [0.5, 0.25, 0.0, 0.5, 0.5, 0.51], k % 3) for k in range(60)]
    got = values(N.hard_negatives(frame(spark, rows)))
    assert got == plain(rows) and len(got) > 100


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [1.0, 0.4], 2), (3, [1.0], 3), (4, [1.0, 0.4, 9.0], 3), (5, [], 2),
        (6, None, 1), (8, [1.0, None], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 2), (11, [1.0, 0.5], None), (None, [1.0, 0.5], 2),
        (2, [1.0, 0.4], 2), (1, [1.0, 0.5], 1), (1, [0.5, 0.5], 1), (7, [1.0, 0.5], 0), (100, [0.0, 0.0], 5), (-100, [1.0, 0.5], 2),
    ]
    assert values(N.hard_negatives(frame(spark, rows))) == plain(rows) != []
    assert N.hard_negatives(frame(spark, [])).count() == 0
    assert N.hard_negatives(frame(spark, [(100, [1.0], 1)])).count() == 0


def test_a_vector_too_long_ends_the_job(spark):
    with pytest.raises(Exception, match="too long"):
        N.hard_negatives(frame(spark, [(0, [3e38], 1), (1, [1.0], 1)])).count()


def test_other_rules(spark):
    vectors = spark.createDataFrame([(k, k % 2, [k, 1]) for k in range(1, 30)], "id int, label int, vector array<int>")
    got = values(N.mine(vectors, F.col("id") == 4, N.Rules(positives=1, negatives=2, low=0, high=50)))
    # Of 28 * 4 + 1 = 113 the half is 56: 13 * 4 + 1 = 53 and 11 * 4 + 1 = 45 are the first inside.
    assert got == [(4, 28, 1, 13, 113, 53), (4, 28, 2, 11, 113, 45)]
