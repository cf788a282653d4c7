"""Cross-tokenizer alignment against the libraries and a plain version."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from zonetide.llm import alignment as L


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(public_tokenizers.path(L.A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(L.B))


@pytest.fixture(scope="module")
def encoder():
    return L.Encoder()


def tokens(text, libraries, encoder):
    if not text:
        return [], []
    a, b = libraries[0].encode(" " + text, add_special_tokens=False).ids, libraries[1].encode(text)
    raw = (" " + text).encode()
    same = b"".join(encoder.bytes_a[i] for i in a) == raw == b"".join(encoder.bytes_b[i] for i in b)
    return (a, b) if same else ([], [])


def plain_groups(a, b, encoder):
    ends_a = np.cumsum([len(encoder.bytes_a[i]) for i in a]).tolist()
    ends_b = np.cumsum([len(encoder.bytes_b[i]) for i in b]).tolist()
    groups, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        x, y = i, j
        while i < len(a) and ends_a[i] <= end:
            i += 1
        while j < len(b) and ends_b[j] <= end:
            j += 1
        groups.append((a[x:i], b[y:j]))
    return groups


def plain(rows, libraries, encoder):
    """What the contract says, text by text."""
    found, counts = [], collections.Counter()
    for doc, text in rows:
        a, b = tokens(text, libraries, encoder)
        groups = plain_groups(a, b, encoder)
        linked = collections.Counter((x, y) for xs, ys in groups for x in xs for y in ys)
        counts.update(linked.keys())
        spelt = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        found.append((doc, len(a), len(b), len(groups), linked, hashlib.sha256(spelt.encode()).hexdigest() if a else ""))
    best = collections.Counter()
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    return sorted(
        (
            (
                doc, n_a, n_b, n_groups, sum(linked.values()),
                sum(m for p, m in linked.items() if counts[p] == best[p[0]]),
                sum(m * counts[p] for p, m in linked.items()), digest,
            )
            for doc, n_a, n_b, n_groups, linked, digest in found
        ),
        key=repr,
    )


ODD = [*"ab \n\t é😀\x00\x1c\x85\xa0　.1'", "the ", "<|endoftext|>", "<s>", "▁", "日本", "<0x41>", "  \n "]


def odd_texts(n, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ODD) for _ in range(rnd.randrange(0, 30))) for _ in range(n)]


def test_units_give_the_tokens_of_whole_texts(libraries, encoder):
    many = odd_texts(1_500)
    ids, by_text = encoder.encode(many)
    split = [np.split(x, np.cumsum(n)[:-1]) for x, n in zip(ids, by_text)]
    got = [(x.tolist(), y.tolist()) for x, y in zip(*split)]
    want = [tokens(t, libraries, encoder) for t in many]
    assert got == want
    assert sum(bool(w[0]) for w in want) > 500 and any("▁" in t and not w[0] for t, w in zip(many, want))


def test_forgetting_changes_nothing(monkeypatch, libraries):
    monkeypatch.setattr(L, "REMEMBERED", 50)
    small = L.Encoder()
    for k in range(0, 200, 20):
        many = odd_texts(20, seed=k)
        ids, by_text = small.encode(many)
        assert np.split(ids[1], np.cumsum(by_text[1])[:-1])[3].tolist() == tokens(many[3], libraries, small)[1]


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 64])
def test_pieces_of_a_merge_stitch_to_the_whole(piece):
    rnd = random.Random(piece)
    for _ in range(200):
        sides = [np.array(sorted({rnd.randrange(1, 40) for _ in range(rnd.randrange(0, 30))} | {40})) for _ in "ab"]
        a, b = sides
        left, right, closed = L.overlaps(a, b, piece)
        ends = sorted({*a.tolist(), *b.tolist()})
        want = [(int(np.searchsorted(a, e)), int(np.searchsorted(b, e)), e in a and e in b) for e in ends]
        assert list(zip(left.tolist(), right.tolist(), closed.tolist())) == want


def test_diagonals_divide_the_work_equally():
    a, b = np.arange(0, 1_000, 2), np.arange(0, 3_000, 3)
    i, j = L.diagonals(a, b, 64)
    work = np.diff(i) + np.diff(j)
    assert (work[:-1] == 64).all() and (i[-1], j[-1]) == (len(a), len(b))


@pytest.mark.parametrize("at_once", [3, 10, 1 << 20])
def test_links_of_large_groups(monkeypatch, at_once):
    monkeypatch.setattr(L, "LINKS_AT_ONCE", at_once)
    rnd = np.random.default_rng(at_once)
    ids_a, ids_b = rnd.integers(0, 4, 60), rnd.integers(0, 4, 50)
    last_a, last_b, doc = np.array([4, 5, 30, 59]), np.array([0, 20, 22, 49]), np.array([0, 0, 1, 3])
    key, count = L.links(ids_a, ids_b, last_a, last_b, doc, 10)
    want, x, y = collections.Counter(), 0, 0
    for p, q, d in zip(last_a, last_b, doc):
        want.update((int(d), int(u), int(v)) for u in ids_a[x : p + 1] for v in ids_b[y : q + 1])
        x, y = p + 1, q + 1
    assert {(k >> 40, (k & (1 << 40) - 1) // 10, k % (1 << 40) % 10): c for k, c in zip(key.tolist(), count.tolist())} == want
    assert (np.diff(key) > 0).all()


def columns(r):
    return (r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)


@pytest.mark.parametrize("chunk", [400, L.CHUNK_BYTES])
def test_alignment_equals_the_plain_version(spark, make, libraries, encoder, monkeypatch, chunk):
    monkeypatch.setattr(L, "CHUNK_BYTES", chunk)
    rows = [(k, t, "a") for k, t in enumerate(odd_texts(300, seed=9))] + [(None, "the and the", "a"), (5, "the and the", "b"), (5, "the and the", "b"), (6, None, "b"), (7, "a" * 3_000, None)]
    got = sorted((columns(r) for r in L.align(make(rows)).collect()), key=repr)
    assert got == plain([(d, t) for d, t, _ in rows], libraries, encoder)


def test_query_equals_the_plain_version(spark, sf_dir, libraries, encoder):
    from zonetide.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((columns(r) for r in QUERIES["op11_alignment"](spark, sf_dir).collect()), key=repr)
    assert got == plain([(r.doc_id, r.text) for r in docs], libraries, encoder)


def test_odd_rows(spark, odd, make, libraries, encoder):
    got = sorted((columns(r) for r in L.align(odd).collect()), key=repr)
    assert got == plain([(r.doc_id, r.text) for r in odd.collect()], libraries, encoder)
    empty = L.align(make([]))
    assert empty.count() == 0 and empty.columns[0] == "doc_id"
