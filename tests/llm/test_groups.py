"""Operators over groups of rows, against brute force."""

import hashlib
import random
import re
from itertools import product
from pathlib import Path

import numpy as np
import pytest
import xxhash

from zonetide.llm import components, decontaminate, difference_cover, licences, simhash, suffixes
from zonetide.llm.common import table


def fingerprint(text, words=4):
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    if not found:
        return 0
    many = [" ".join(found[k : k + words]) for k in range(max(1, len(found) - words + 1))]
    digests = [xxhash.xxh64_intdigest(s.encode(), 42) for s in many]
    return sum(1 << b for b in range(64) if 2 * sum(d >> b & 1 for d in digests) > len(digests))


def linked(rows, radius=4):
    """The smallest id reachable for each row."""
    prints = [fingerprint(t or "") for _, t in rows]
    above = list(range(len(rows)))

    def top(k):
        while above[k] != k:
            k = above[k]
        return k

    every = np.array(prints, dtype=np.uint64)
    for k in range(len(rows)):
        for j in np.nonzero(np.bitwise_count(every[:k] ^ every[k]) <= radius)[0]:
            above[top(k)] = top(int(j))
    tops = [top(k) for k in range(len(rows))]
    least = {}
    for (i, _), t in zip(rows, tops):
        least[t] = min([x for x in (least.get(t), i) if x is not None], default=None)
    return [(i, f"{p:016x}", least[t]) for (i, _), p, t in zip(rows, prints, tops)]


@pytest.mark.parametrize("block", [2048, 4])
def test_simhash(spark, sf_dir, make, monkeypatch, block):
    monkeypatch.setattr(simhash.links_within, "__defaults__", (4, block))
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    rows += [(9000, None), (8999, ""), (None, "no id at all"), (9001, "A b"), (9002, "a B"), (9001, "A b")]
    got = simhash.near_duplicates(make([(i, t, "s") for i, t in rows])).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(linked(rows), key=key)


def test_fewer_shards_find_the_same(spark):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(40)]
    prints = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for s in seeds for _ in range(6)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    every = list(prints)
    want = {frozenset((a, b)) for k, a in enumerate(every) for b in every[:k] if (a ^ b).bit_count() <= 4}
    for shard in (64, 1, 0.001):
        simhash.SHARD, kept = shard, simhash.SHARD
        got = {frozenset(x & (1 << 64) - 1 for x in r) for r in simhash.links_within(df).collect()}
        simhash.SHARD = kept
        assert got <= want
        assert _groups(got) == _groups(want)


def _groups(links):
    above = {}

    def top(x):
        while above.get(x, x) != x:
            x = above[x]
        return x

    for a, b in links:
        above.setdefault(a, a), above.setdefault(b, b)
        above[top(a)] = top(b)
    out = {}
    for x in above:
        out.setdefault(top(x), set()).add(x)
    return {frozenset(v) for v in out.values()}


def test_tree_follows_all_edges_needed():
    rng = random.Random(1)
    values = [rng.getrandbits(16) for _ in range(500)]
    tree = simhash.Tree()
    for v in values:
        tree.add(v)
    for q in values[:50]:
        assert set(tree.near(q, 3)) == {v for v in values if (v ^ q).bit_count() <= 3}


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5000, 5000), (7, 3)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {**{k: 0 for k in range(201)}, **{1000 + k: 1000 for k in range(300)}}
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_keep_first(make):
    text = " ".join(f"w{k}" for k in range(80))
    docs = make([(5, text, "a"), (3, text.upper(), "b"), (9, "something else", "c"), (3, text, "d"), (None, None, "e")])
    docs = docs.unionByName(make([(9, "something else", "c")]))
    out = simhash.keep_first(docs)
    assert out.columns == docs.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["3", "9", "None"]


def brute_repeats(rows, length):
    seen, out = set(), []
    for i, raw in sorted(rows):
        covered = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if raw[p : p + length] in seen:
                covered[p : p + length] = b"\1" * length
            seen.add(raw[p : p + length])
        kept = bytes(x for x, c in zip(raw, covered) if not c)
        spans = sum(1 for k in range(len(raw)) if covered[k] and (k == 0 or not covered[k - 1]))
        out.append((i, len(raw), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(3)
    base = ["".join(rng.choice("ab ") for _ in range(300)) for _ in range(5)]
    rows = []
    for i in range(60):
        text = ""
        for _ in range(rng.randint(1, 5)):
            at = rng.randint(0, 200)
            text += rng.choice(base)[at : at + rng.randint(20, 250)] + rng.choice(["", "é", "z" * rng.randint(0, 150)])
        rows.append((i, text))
    rows += [(100, "a" * 9000), (101, "ab" * 500), (102, None), (103, "a" * 99), (104, "a" * 100), (105, "xyz" * 50)]
    return rows


@pytest.mark.parametrize("settings", [{}, {"HOT_UNITS": 1}, {"LONGEST_RUN": 7, "CHUNK": 300}, {"BLOCK_BYTES": 500}])
@pytest.mark.parametrize("length", [100, 30])
def test_suffixes(spark, make, monkeypatch, passages, settings, length):
    for name, value in settings.items():
        monkeypatch.setattr(suffixes, name, value)
    got = suffixes.remove_repeats(make([(i, t, "s") for i, t in passages]), length).collect()
    assert sorted(map(tuple, got)) == brute_repeats([(i, (t or "").encode()) for i, t in passages], length)


def test_suffixes_on_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = sorted(map(tuple, suffixes.remove_repeats(docs).collect()))
    assert got == brute_repeats([(r.doc_id, r.text.encode()) for r in docs.collect()], 100)


def test_suffixes_odd_rows(odd, make):
    out = suffixes.remove_repeats(odd, kept=True)
    assert out.count() == odd.count()
    for r in out.collect():
        assert len(r.kept) == r.n_bytes - r.n_removed
    text = "abcdefghij" * 8 + "klmnopqrst" * 5
    rows = [(7, text, "s"), (7, text, "s"), (None, text, "s"), (None, text + "!", "s"), (9, text, "s")]
    got = sorted((str(r.doc_id), r.n_removed) for r in suffixes.remove_repeats(make(rows)).collect())
    assert got == [("7", 0), ("7", 0), ("9", 130), ("None", 130), ("None", 130)]
    assert suffixes.remove_repeats(make([])).count() == 0


def test_difference_cover_orders_all_suffixes():
    rng = np.random.default_rng(1)
    for _ in range(150):
        n, letters, depth = int(rng.integers(1, 300)), int(rng.integers(1, 5)), int(rng.integers(8, 60))
        text = rng.integers(0, letters, n).astype(np.uint8)
        at, frm, size = rng.integers(0, n, 3)
        size = min(size, n - at, n - frm)
        text[at : at + size] = text[frm : frm + size].copy()
        starts = np.arange(max(0, n - depth + 1))
        rank = difference_cover.suffix_ranks(text.astype(np.int64) + 1, depth)
        order = starts[np.argsort(rank[starts], kind="stable")]
        heads = [bytes(text[p : p + depth]) for p in order]
        assert heads == sorted(heads)
        same = difference_cover.equal_neighbours(text, order, depth)
        assert same.tolist() == [k > 0 and heads[k] == heads[k - 1] for k in range(len(heads))]


QUESTION = "Anna Berg buys 3 apples for 12 dollars each and walks 4 km home while Tom sees Anna eat 3 apples today."


def test_templates(make, spark):
    asked = QUESTION.replace("Anna Berg", "Maria Lund").replace("Anna", "Maria").replace("3", "7").replace("12", "19")
    odd = asked.replace("sees Maria eat 7", "sees Olga eat 8")
    rows = [
        (1, "Some text first. " + QUESTION + " And more.", "s"), (2, "He said: " + asked, "s"), (3, "He said: " + odd, "s"),
        (4, "Nothing of the kind stands in this text, which is long enough to have windows.", "s"), (5, None, "s"),
        (6, "1 2 3 4 5 6 7 8 9", "s"), (None, QUESTION, "s"), (7, "", "s"),
    ]
    items = spark.createDataFrame(
        [(10, QUESTION, "x"), (11, QUESTION, "x"), (12, "too short", "x"), (13, None, "x")], "item_id bigint, text string, kind string"
    )
    docs = make(rows)
    got = {(r.doc_id, r.item_id): r.kind for r in decontaminate.find_contamination(docs, items).collect()}
    assert got == {(1, 10): "same", (2, 10): "reparameterised", (None, 10): "same"}
    clean = decontaminate.keep_clean(docs, items)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [3, 4, 5, 6, 7]
    assert decontaminate.find_contamination(make([]), items).count() == 0
    assert decontaminate.find_contamination(docs, items.limit(0)).count() == 0


def test_every_passage_is_found_in_blocks_too(spark, sf_dir, monkeypatch):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    texts = {r.doc_id: r.text for r in docs.collect()}
    verbatim = {(i, r.item_id) for r in items.collect() for i, t in texts.items() if r.text in t}
    once = {(r.doc_id, r.item_id) for r in decontaminate.find_contamination(docs, items).collect()}
    assert verbatim and verbatim <= once
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 2_000)
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_contamination(docs, items).collect()} == once


def test_licences(spark, make, odd):
    mit, isc = licences.KNOWN[0][1], licences.KNOWN[1][1]
    rows = [
        (1, "Copyright (c) 2020 Somebody\n\n" + mit.upper(), "s"), (2, isc.replace(" ", "\n").replace('"', "“"), "s"),
        (3, "Text.\nReleased under the MIT licence!\nMore text.", "s"), (4, "(c) 2000 me\nAll rights reserved.", "s"),
        (5, mit + " not", "s"), (6, "No licence at all", "s"), (7, "x\nLicensed under CC BY-NC 4.0.\ny", "s"), (8, None, "s"),
    ]
    got = {r.doc_id: (r.licence, r.notices, r.n_notices) for r in licences.scan(make(rows)).collect()}
    assert got == {
        1: ("MIT", "", 0), 2: ("ISC", "", 0), 3: (None, "MIT", 1), 4: (None, "", 0), 5: (None, "", 0), 6: (None, "", 0),
        7: (None, "CC-BY-NC-4.0", 1), 8: (None, "", 0),
    }
    assert licences.scan(odd).count() == odd.count()
    assert licences.scan(make([])).count() == 0


JANET = (
    "Janet has 16 eggs. Janet eats three eggs each morning. Janet sells the rest for 2 dollars each. "
    "How much does Janet make"
)


def test_names_that_begin_sentences(make, spark):
    maria = JANET.replace("Janet", "Maria").replace("16", "20").replace("three", "five").replace("2", "4")
    mixed = JANET.replace("Janet has", "Maria has").replace("Janet eats", "Olga eats").replace("Janet sells", "Tom sells")
    inside = "We know that " + maria.replace(". ", ", while ")
    rows = [(1, JANET, "s"), (2, maria, "s"), (3, "So: " + inside, "s"), (4, mixed, "s"), (5, JANET.lower(), "s")]
    rows += [(6, maria.replace("five", "5"), "s"), (7, "They sold eggs. They ate the rest each morning. How much was it", "s")]
    items = spark.createDataFrame([(10, JANET)], "item_id bigint, text string")
    got = {r.doc_id: (r.n_windows, r.n_held, r.kind) for r in decontaminate.find_contamination(make(rows), items).collect()}
    assert got[1] == (19, 19, "same") and got[2] == (19, 19, "reparameterised") == got[6]
    assert set(got) >= {1, 2, 6} and not set(got) & {4, 7}
    assert sorted(r.doc_id for r in decontaminate.keep_clean(make(rows), items).collect()) == sorted(set(range(1, 8)) - set(got))


def test_every_reading_of_a_window():
    words = "Ann. Bob. Cy dines. Dee said Eve ran. Flo and Gus".split()
    tokens, values, unsure, _ = decontaminate.Templates().read(" ".join(words))
    digests, places = decontaminate.windows(tokens, unsure)
    want = []
    for k in range(len(tokens) - 4):
        ways = [[t, decontaminate.NAME] if u else [t] for t, u in zip(tokens[k : k + 5], unsure[k : k + 5])]
        for way in product(*ways):
            one, _ = decontaminate.windows(np.array(way, dtype=np.uint64), np.zeros(5, dtype=bool))
            want.append((k, int(one[0])))
    assert sorted(zip(places.tolist(), digests.tolist())) == sorted(want) and unsure.sum() == 5


def test_licences_of_several_paragraphs(spark, make):
    mit, isc = licences.KNOWN[0][1], licences.KNOWN[1][1]
    held = "Copyright (c) 2020 Somebody"
    rows = [
        (1, f"MIT License\n\n{held}\n\n{mit}\n", "s"), (2, f"The MIT License (MIT)\n\n{held}\n\n{mit}", "s"),
        (3, f"About this.\n\n{held}\n\n{mit}\n\nThe end.", "s"), (4, f"{isc}\n\nand\n\n{mit}\n\nand\n\n{isc}", "s"),
        (5, "x\n\n" + mit.replace("free of charge", "for money"), "s"), (6, "x\n\n" + mit.rsplit("\n\n", 1)[0], "s"),
        (7, f"ISC License\n\n{isc}", "s"),
    ]
    got = {r.doc_id: (r.licence, r.notices, r.n_notices) for r in licences.scan(make(rows)).collect()}
    assert [got[i][0] for i in range(1, 8)] == ["MIT", "MIT", None, None, None, None, "ISC"]
    assert [got[i][1:] for i in (1, 2, 7)] == [("", 0)] * 3
    assert [got[i][1:] for i in range(3, 7)] == [("MIT", 1), ("ISC,MIT", 2), ("", 0), ("", 0)]


def test_long_licences(spark, make):
    folder = Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0"}
    if not all((folder / n).exists() for n in names):
        pytest.skip("no licence texts on this machine")
    rows = [(k, (folder / n).read_text(), "s") for k, n in enumerate(names)]
    rows += [(k + 10, f"Some words.\n\n{t}\n\nMore words.", "s") for k, t, _ in rows]
    got = {r.doc_id: (r.licence, r.notices) for r in licences.scan(make(rows)).collect()}
    for k, name in enumerate(names.values()):
        assert got[k][0] == name and name in got[k + 10][1].split(",")


def test_short_items_and_scripts_without_spaces(spark, make):
    items = [
        ("cn", "小明有三个苹果，他又买了5个苹果，请问小明现在一共有多少个苹果？"), ("sum", "What is 2 + 2"), ("one", "Yes."),
        ("th", "สวัสดีชาวโลก วันนี้อากาศดีมากและเราจะไปเที่ยวทะเลกับ 4 คน"), ("none", "?!"), ("empty", None),
    ]
    found = spark.createDataFrame(items, "item_id string, text string")
    rows = [
        (1, "前言。小明有三个苹果，他又买了5个苹果，请问小明现在一共有多少个苹果？后记", "s"), (2, "I ask: what is 2 + 2 then", "s"),
        (3, "what is 3 + 2", "s"), (4, "Well.\nYes.\nNo.", "s"), (5, "oh yes indeed", "s"), (6, "other words altogether here", "s"),
        (7, "小明有三个苹果，他又买了9个苹果，请问小明现在一共有多少个苹果？", "s"), (8, None, "s"), (9, "Yes", "s"),
        (10, "aaa สวัสดีชาวโลก วันนี้อากาศดีมากและเราจะไปเที่ยวทะเลกับ 4 คน", "s"), (11, "今天天气很好，我们去公园散步，看到了很多花和树。", "s"),
    ]
    got = sorted((r.doc_id, r.item_id, r.kind) for r in decontaminate.find_contamination(make(rows), found).collect())
    assert got == [
        (1, "cn", "same"), (2, "sum", "same"), (4, "one", "same"), (7, "cn", "reparameterised"), (9, "one", "same"),
        (10, "th", "same"),
    ]
    assert sorted(r.doc_id for r in decontaminate.keep_clean(make(rows), found).collect()) == [3, 5, 6, 8, 11]


def test_only_units_that_can_share_a_string_are_sorted():
    rng = random.Random(6)
    for length in (10, 30, 100):
        for _ in range(20):
            base = ["".join(rng.choice("abc") for _ in range(3 * length)) for _ in range(3)]
            texts_ = [
                "".join(rng.choice(base)[rng.randrange(length) :][: rng.randrange(2 * length)] + rng.choice("xyz") * rng.randrange(5) for _ in range(4)).encode()
                for _ in range(6)
            ]
            units = [(a, s, n, -1 if twice else spot, t[s : s + n + length - 1]) for t in texts_ for a, s, n, twice, spot in zip(*suffixes.units_of(t, length))]
            seen = {}
            for k, unit in enumerate(units):  # distinct contents only, as the operator has them
                seen.setdefault((unit[0], unit[4]), k)
            units = [units[k] for k in seen.values()]
            if not units:
                continue
            anchor, spot = (np.array([u[k] for u in units], dtype=np.int64) for k in (0, 3))
            size = np.array([len(u[4]) for u in units])
            begin = np.cumsum(size) - size
            keep = suffixes.worth_sorting(anchor, spot, np.frombuffer(b"".join(u[4] for u in units), np.uint8), begin, size, length)
            strings = [[u[4][k : k + length] for k in range(u[2])] for u in units]
            for k, own in enumerate(strings):
                others = {x for j, more in enumerate(strings) if j != k and anchor[j] == anchor[k] for x in more}
                if len(set(own)) < len(own) or others & set(own):
                    assert keep[k]


def test_the_greatest_id_stays(make):
    last = (1 << 63) - 1
    text = "".join(chr(97 + k * k % 26) for k in range(60)) + " some text that stands in three documents of the corpus, word for word and line for line."
    rows = [(last, text, "s"), (None, text, "s"), (5, text, "s"), (last - 1, "short", "s")]
    got = sorted((str(r.doc_id), r.n_removed) for r in suffixes.remove_repeats(make(rows)).collect())
    n = len(text.encode())
    assert got == sorted([(str(last), n), ("None", n), ("5", 0), (str(last - 1), 0)])


def test_licence_files_with_titles(make):
    """Licence files as they are usually kept: title, blank line, copyright line, body; wrapped, and in capitals."""
    known = dict(licences.KNOWN[:6])
    titles = {
        "MIT": "MIT License", "ISC": "ISC License", "BSD-2-Clause": "BSD 2-Clause License", "0BSD": "BSD Zero Clause License",
        "BSD-3-Clause": 'BSD 3-Clause "New" or "Revised" License', "Zlib": "zlib License",
    }
    assert set(known) == set(titles)
    rows, want = [], {}
    for k, (name, body) in enumerate(known.items()):
        file = f"{titles[name]}\n\nCopyright (c) 2020, Some One\nAll rights reserved.\n\n{body}\n"
        wrapped = re.sub(r"(.{40,60}) ", r"\1\n", file.split("\n\n", 1)[1])
        rows += [(10 * k, file, "s"), (10 * k + 1, wrapped, "s"), (10 * k + 2, body.upper(), "s"), (10 * k + 3, "Code.\n\n" + body + "\n\nMore.", "s"), (10 * k + 4, body[:-40], "s")]
        want |= {10 * k + j: (name if j < 3 else None, name if j == 3 else "") for j in range(5)}
    got = {r.doc_id: (r.licence, r.notices) for r in licences.scan(make(rows)).collect()}
    assert got == want
