"""The pipeline's near-duplicates: recall on planted pairs, exact confirmation, hot shards, odd rows."""

import random

import numpy as np
import pytest

from zonetide.llm import near


def words_of(text):
    out = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        out = out.replace(c, " ")
    return [w for w in out.split(" ") if w]


def shingle_set(text, n=5):
    words = words_of(text)
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def groups(rows, least=0.8):
    """The smallest id of each component of the links, by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    above = list(range(len(rows)))

    def top(k):
        while above[k] != k:
            k = above[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] == sets[b] or common >= least * (len(sets[a]) + len(sets[b]) - common):
                above[top(a)] = top(b)
    least_of = {}
    for k, (i, _) in enumerate(rows):
        least_of[top(k)] = min(i, least_of.get(top(k), i))
    return sorted(least_of.values())


def planted(n, seed=11):
    """Pairs of texts, one word in 45 or more replaced, and their similarity."""
    rnd = random.Random(seed)
    vocabulary = [f"w{k:05d}" for k in range(30_000)]
    rows, pairs = [], []
    for k in range(n):
        size = rnd.choice([60, 150, 300, 800])
        one = [rnd.choice(vocabulary) for _ in range(size)]
        two = list(one)
        for _ in range(rnd.randint(1, size // 45)):
            two[rnd.randrange(size)] = rnd.choice(vocabulary)
        x, y = shingle_set(" ".join(one)), shingle_set(" ".join(two))
        rows += [(2 * k, " ".join(one)), (2 * k + 1, " ".join(two))]
        pairs.append((2 * k, 2 * k + 1, len(x & y) / len(x | y)))
    return rows, pairs


def test_recall_of_planted_pairs(spark):
    rows, pairs = planted(300)
    kept = {r.doc_id for r in near.keep_first(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)).collect()}
    assert all(a in kept for a, _, _ in pairs)
    close = [(a, b) for a, b, j in pairs if j >= 0.8]
    assert len(close) > 250 and sum(b not in kept for _, b in close) / len(close) >= 0.97
    edge = [(a, b) for a, b, j in pairs if 0.8 <= j < 0.85]
    assert len(edge) > 60 and sum(b not in kept for _, b in edge) / len(edge) >= 0.95
    assert all(b in kept for _, b, j in pairs if j < 0.8)


@pytest.mark.parametrize("block", [2_048, 5])
def test_groups_equal_the_plain_ones(spark, sf_dir, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK", block)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rnd = random.Random(2)
    base = [f"v{rnd.randrange(5_000)}" for _ in range(200)]
    for k in range(40):  # one large group, whose ends are far apart
        base[rnd.randrange(200)] = f"x{k}"
        rows.append((10_000 + k, " ".join(base)))
    got = sorted(r.doc_id for r in near.keep_first(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == groups(rows)


@pytest.mark.parametrize("block, many", [(2_048, 4), (2_048, 0), (9, 0)])
def test_a_link_beside_an_unlike_nearest_text_is_kept(spark, monkeypatch, block, many):
    """Texts about as like as the least similarity asks: a text's nearest digest is often not like enough, another one is."""
    rnd = random.Random(5)
    rows = []
    for family in range(6):
        base = [f"f{family}w{k}" for k in range(120)]
        for _ in range(12):
            own = list(base)
            for at in rnd.sample(range(120), rnd.randint(1, 3)):
                own[at] = f"x{rnd.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
    monkeypatch.setattr(near, "BLOCK", block)
    monkeypatch.setattr(near, "MANY", many, raising=False)
    monkeypatch.setattr(near, "RADIUS", 50)
    # So short and many pieces that every two texts meet.
    monkeypatch.setattr(near, "pieces_for", lambda n: (2, 64))
    want = groups(rows)
    got = near.keep_first(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    assert len(want) > 6 and sorted(r.doc_id for r in got.collect()) == want


@pytest.mark.parametrize("block, held", [(2_048, 1 << 24), (20, 1 << 24), (2_048, 10_000)])
def test_a_group_of_barely_like_texts_makes_no_rows_by_pair(spark, monkeypatch, block, held):
    """Most pairs are within the radius, few like enough, and few texts are joined: rows grow with texts, links stay whole."""
    rnd = random.Random(8)
    rows = []
    for k in range(150):
        own = [f"w{j}" for j in range(120)]
        for at in rnd.sample(range(120), rnd.choice([1, 2, 2, 2, 3])):
            own[at] = f"x{rnd.randrange(10**6)}"
        rows.append((k, " ".join(own)))
    monkeypatch.setattr(near, "BLOCK", block)
    monkeypatch.setattr(near, "BLOCK_BYTES", held, raising=False)
    monkeypatch.setattr(near, "RADIUS", 50)
    monkeypatch.setattr(near, "pieces_for", lambda n: (2, 16))
    made = []

    def noted(df, run, schema, plain=near.map_batches):
        made.append(plain(df, run, schema))
        return made[-1]

    monkeypatch.setattr(near, "map_batches", noted)
    got = near.keep_first(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    want = groups(rows)
    assert 10 < len(want) < 120 and sorted(r.doc_id for r in got.collect()) == want
    # A shard in blocks gives a text to several units.
    units = 16 * len(rows) * (3 if block == 20 else 1)
    assert len(made) > 3 and max(m.count() for m in made) <= near.MANY * units


def test_pairs_across_blocks_do_not_grow_with_the_blocks(spark, monkeypatch):
    """One shard of 200 near texts in 25 blocks: a text asks its own block and one other, every pair of blocks is named."""
    rnd = random.Random(9)
    monkeypatch.setattr(near, "BLOCK", 8)
    monkeypatch.setattr(near, "MANY", 0)
    made = []

    def noted(df, run, schema, plain=near.map_batches):
        made.append(plain(df, run, schema))
        return made[-1]

    monkeypatch.setattr(near, "map_batches", noted)
    rows = []
    for k in range(200):
        key = sum(1 << b for b in rnd.sample(range(128), 8))
        rows.append((k << 33, bytearray(key.to_bytes(16)), [0]))
    near._candidates(spark.createDataFrame(rows, "tid bigint, key binary, pieces array<int>"))
    found = made[0].collect()
    assert 300 <= sum(r.u is not None for r in found) <= 400
    assert sum(r.u is None for r in found) > 310


def test_joining_links_are_a_forest():
    rnd = random.Random(4)
    texts = []
    for k in range(60):
        own = [f"w{j}" for j in range(90)]
        for at in rnd.sample(range(90), rnd.randint(1, 3)):
            own[at] = f"x{k}y{at}"
        texts.append(" ".join(own))
    sets = [near.shingles(t) for t in texts] + [near.shingles("")]
    keys = [np.packbits(near.fingerprint(s, near.KEY_BITS)).tobytes() for s in sets]
    side = [[k, key, k // 2 if k < 6 else k, s.astype("<u8").tobytes()] for k, (key, s) in enumerate(zip(keys, sets))]

    def merged(links):
        above = {r[2]: r[2] for r in side}

        def top(k):
            while above[k] != k:
                k = above[k]
            return k

        for u, v in links:
            above[top(side[v][2])] = top(side[u][2])
        return sorted(sorted(r[0] for r in side if top(r[2]) == t) for t in {top(r[2]) for r in side})

    def alike(x, y):
        common = len(np.intersect1d(sets[x], sets[y]))
        near_keys = (int.from_bytes(keys[x]) ^ int.from_bytes(keys[y])).bit_count() <= near.RADIUS
        return near_keys and common >= 0.8 * (len(sets[x]) + len(sets[y]) - common)

    every = [(x, y) for x in range(len(side)) for y in range(x) if alike(x, y)]
    one = near._joining(side, [], 0.8)
    assert set(tuple(sorted(p, reverse=True)) for p in one) <= set(every)
    assert merged(one) == merged(every) and len(one) == len({r[2] for r in side}) - len(merged(every))
    across = [(x, y) for x, y in every if (x < 30) != (y < 30)]
    assert merged(near._joining(side[:30], side[30:], 0.8)) == merged(across)


def test_digests_are_of_shingles():
    for text in ("", "a", "A b\tC", "one two three four five", "one two three four five six", "x " * 50, "é Ü ü"):
        assert len(near.shingles(text)) == len(shingle_set(text))
    assert np.array_equal(near.shingles("A b c d e F"), near.shingles("a  b c\nd e f"))


def test_fingerprints_are_majorities():
    digests = near.shingles(" ".join(f"w{k % 37}" for k in range(90)))
    long = near.fingerprint(digests, 320)
    assert len(long) == 320 and np.array_equal(long[:128], near.fingerprint(digests, 128))
    assert 100 < long.sum() < 220 and not near.fingerprint(np.array([], np.uint64), 64).any()


def test_nearest_of_a_tree():
    rnd = random.Random(1)
    seeds = [rnd.getrandbits(128) for _ in range(20)]
    values = [s ^ sum(1 << b for b in rnd.sample(range(128), rnd.randint(0, 30))) for s in seeds for _ in range(8)]
    tree = near.Tree()
    for name, value in enumerate(values):
        distances = [(v ^ value).bit_count() for v in values[:name]]
        found = tree.nearest(value, 32)
        least = min(distances, default=99)
        assert (found is None) if least > 32 else distances[found] == least
        tree.add(value, name)


def test_pieces_grow_with_the_corpus():
    assert near.pieces_for(0) == near.pieces_for(32)
    (b1, p1), (b2, p2) = near.pieces_for(10_000), near.pieces_for(10_000_000)
    assert b1 < b2 and p1 < p2 and 10_000_000 / 2**b2 <= near.SHARD


def test_odd_rows(spark, odd, make):
    out = near.keep_first(odd)
    assert out.columns == odd.columns
    # Texts without a word are one group, whose smallest id stays; equal texts another; the row without an id keeps its own text.
    got = sorted((str(r.doc_id), (r.text or "")[:12]) for r in out.collect())
    assert got == sorted([("1", ""), ("4", "word other t"), ("5", "same text he"), ("7", "repeated row"), ("7", "other text"), ("None", "no id"), ("8", "é😀 é😀 é😀 é😀 ")])
    assert near.keep_first(make([])).count() == 0
    one = near.keep_first(make([(None, "a b c", "s"), (None, "a b c", "s"), (None, "A b  c", "s")])).collect()
    assert len(one) == 1
