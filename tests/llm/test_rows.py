"""Operators that judge rows one by one, against plain versions of their definitions."""

import hashlib
import random
import re
import struct
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from zonetide.llm import bpe, pii, quality, token_counts, urls
from zonetide.llm.common import table

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            v, d = m.group(), re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in v.split(".")),
                "card": lambda: 13 <= len(d) <= 19 and luhn(d),
                "phone": lambda: 9 <= len(d) <= 15,
            }[kind]()
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


PLANTED = [
    "call 1.2.3.4.5.6.7.8 or 4111 1111 1111 1111, 4111-1111-1111-1112 x@y.z a@b.co_x@y.z é😀 +1 (234) 555-7777 +49",
    "+1" + "(" * 10 + "9" * 9 + " x",
    "1 " * 3000,
    "a@b.c " * 700,
    "999.1.1.1 0255.0.0.1 x" * 100,
    "@@ a@b @c.d 1.2.3 + +1 +12 4111111111111111",
    "x" * 50_000,
]


def test_pii_base_spans(spark, sf_dir, make):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    rows += [(10**6 + k, t) for k, t in enumerate(PLANTED)]
    got = pii.find_pii(make([(i, t, "s") for i, t in rows])).collect()
    want = {i: base_spans(t or "") for i, t in rows}
    assert len(got) == len(rows)
    for r in got:
        spans = want[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest(), r
        assert set(spans) <= set(r.spans.split(",")) | {""}
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in spans) for k in BASE]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("a1.@+-( )9\n", max_size=60), min_size=1, max_size=40))
def test_pii_random(spark, make, many):
    got = pii.find_pii(make([(k, t, "s") for k, t in enumerate(many)])).collect()
    for r in got:
        assert r.base_sha256 == hashlib.sha256(",".join(base_spans(many[r.doc_id])).encode()).hexdigest(), many[r.doc_id]


def test_pii_checksums_and_context(make):
    rows = [
        (1, "DE89 3704 0044 0532 0130 00", "s"),
        (2, "DE89 3704 0044 0532 0130 01", "s"),
        (3, "social security 123-45-6789", "s"),
        (4, "part 123-45-6789", "s"),
        (5, "account GB82WEST12345698765432", "s"),
    ]
    got = {r.doc_id: r for r in pii.find_pii(make(rows)).collect()}
    assert [got[i].n_iban for i in range(1, 6)] == [1, 0, 0, 0, 1]
    assert [got[i].n_ssn for i in range(1, 6)] == [0, 0, 1, 0, 0]
    assert float(got[5].scores) > float(got[1].scores)


def test_redact_keeps_columns(make, odd):
    docs = make([(1, "mail a@b.co now, 4111 1111 1111 1111 or 1.2.3.4", "s"), (2, "clean", "s"), (3, None, "s")])
    out = pii.redact(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text == "mail <EMAIL> now, <CARD> or <IP>" and got[1].n_chars == len(got[1].text)
    assert (got[2].text, got[2].n_chars, got[3].text, got[3].fp) == ("clean", 5, None, "x")
    # Nothing private stands in these rows: every value stays.
    key = lambda r: repr(tuple(r))
    assert sorted(map(key, pii.redact(odd).collect())) == sorted(map(key, odd.collect()))


def test_redact_joins_overlaps_and_long_texts(make):
    """Spans at the edges of runs and pieces of the text, overlapping kinds, characters of several bytes."""
    rng = random.Random(9)
    bits = ["a@b.co ", "1.2.3.4 ", "4111 1111 1111 1111 ", "x@1.2.3.4 ", "é😀 ", "word ", "+49 30 1234567 ", "SSN 123-45-6789 ", "\n"]
    many = ["".join(rng.choice(bits) for _ in range(n)) for n in (0, 1, 7, 63, 64, 65, 200, 700)]
    many += ["w " * 600 + "a@b.co" + " é" * 40_000 + " 1.2.3.4 end", "a@b.co"]
    docs = make([(k, t, "s") for k, t in enumerate(many)])
    spans = {r.doc_id: r.spans for r in pii.find_pii(docs).collect()}
    for r in pii.redact(docs).collect():
        text, found = many[r.doc_id], [x.split(":") for x in spans[r.doc_id].split(",") if x]
        at, out = 0, ""
        for start, stop, kind in sorted((int(s), int(e), f"<{k.upper()}>") for k, s, e in found):
            if start >= at:
                out += text[at:start] + kind
            at = max(at, stop)
        assert r.text == out + text[at:]


def test_spans_cost_in_proportion(spark, make):
    """Twice the addresses in one text take little more than twice the time."""
    took = []
    for n in (4_000, 16_000):
        docs = make([(1, " ".join(f"user{k}@example{k % 7}.com tel 12" for k in range(n)), "s")]).cache()
        assert docs.count() == 1
        best = []
        for _ in range(2):
            start = time.perf_counter()
            pii.redact(docs).write.format("noop").mode("overwrite").save()
            best.append(time.perf_counter() - start)
        took.append(min(best))
    assert took[1] < 10 * took[0] + 2


def figures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    twice = {g for g in grams if grams.count(g) > 1} if len(grams) < 500 else {g for g in set(grams) if grams.count(g) > 1}
    covered = {k + j for k, g in enumerate(grams) if g in twice for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("ab #é\n\t\u3000\x0b", max_size=80), min_size=1, max_size=40))
def test_quality_figures(spark, make, many):
    for r in quality.quality(make([(k, t, "s") for k, t in enumerate(many)])).collect():
        n, chars, symbols, lines, repeated = figures(many[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            n, chars, symbols, lines, repeated,
        )
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert not (r.base_failed and r.kept)


def test_bad_host_condemns_doubtful_documents_only(make):
    words = [f"w{chr(97 + k % 26)}{k}" for k in range(200)]
    clean = lambda k: " ".join(words[(k * 7 + j) % 200] for j in range(60))
    noisy = lambda k: " ".join(w + "#" for w in clean(k).split())
    rows = [(k, clean(k), "good") for k in range(40)] + [(100, noisy(3), "good")]
    rows += [(200 + k, noisy(k), "bad") for k in range(40)] + [(300, clean(5), "bad"), (301, noisy(4), None)]
    docs = make(rows)
    got = {r.doc_id: r for r in quality.quality(docs).collect()}
    assert all(got[k].kept for k in range(40)) and got[100].kept and got[300].kept
    assert not any(got[200 + k].kept for k in range(40))
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def plain_urls(url, rules):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in rules:
        own, slash, tail = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith(slash + tail):
            key = (len(rule), verdict == "block", rule, verdict)
            best = max(best, key) if best else key
    return host, path, best[2] if best else None, best[3] if best else "allow"


RULES = [*urls.RULES, ("block", "b.example.org"), ("allow", "b.example.org/x/y"), ("block", "org/"), ("block", "b.example.org/x/yz/")]


@settings(max_examples=20, deadline=None)
@given(
    st.lists(
        st.builds(
            lambda a, h, p: a + ".".join(h) + p,
            st.sampled_from(["http://", "HTTPS://", "", "x://y://"]),
            st.lists(st.sampled_from(["b", "example", "EXAMPLE", "org", "com", "é", ""]), max_size=4),
            st.sampled_from(["", "/", "/es", "/es/", "/en/1", "/en/12?q#f", "/x/y", "/x/yz/", "/x/yzz#a", "?a/b", "/de/\n/"]),
        ),
        max_size=30,
    )
)
def test_urls_random(spark, many):
    rows = [*enumerate([*many, None])]
    pages = spark.createDataFrame([(i, u, "h", "extra") for i, u in rows], "page_id bigint, url string, html string, rule string")
    got = {r.page_id: tuple(r)[1:] for r in urls.filter_urls(pages, RULES).collect()}
    assert got == {i: plain_urls(u, RULES) for i, u in rows}


def test_too_many_rules_are_refused(monkeypatch):
    monkeypatch.setattr(urls, "MAX_RULES", 3)
    with pytest.raises(ValueError, match="too many"):
        urls.build_trie(urls.RULES)


@pytest.fixture(scope="module")
def library():
    import tiktoken

    return tiktoken.Encoding(
        "own", pat_str=bpe.public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.RANKS), special_tokens={}
    )


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text("ab'st \n\u00a0é日😀1", max_size=80))
def test_bpe_as_the_library_and_back(library, text):
    c = bpe.codec()
    ids = c.encode_batch([text])[0]
    assert ids.tolist() == library.encode_ordinary(text)
    assert c.decode(ids) == text.encode()
    start, end = c.offsets(ids, text)
    for k, i in enumerate(ids.tolist()):
        piece = c.bytes_of[i]
        try:
            assert text[start[k] : end[k]] == piece.decode()
        except UnicodeDecodeError:
            assert piece in text[start[k] : end[k]].encode()


def test_bpe_round_trip(spark, sf_dir, library, odd):
    docs = table(spark, sf_dir, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    for r in bpe.round_trip(docs).collect():
        ids = library.encode_ordinary(rows[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].encode()).hexdigest()
    encoded = bpe.encode(odd)
    decoded = bpe.decode(encoded)
    assert sorted(r.text for r in decoded.collect()) == sorted(r.text or "" for r in odd.collect())


def test_decode_split_characters(spark, library):
    ids = library.encode_ordinary("😀")
    cut = spark.createDataFrame([(1, ids[:-1]), (2, None), (3, [])], "doc_id bigint, ids array<int>")
    got = {r.doc_id: r for r in bpe.decode(cut).collect()}
    assert "�" in got[1].text or len(ids) == 1
    assert (bytes(got[2].decoded), got[3].text) == (b"", "")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts(spark, sf_dir, make, tmp_path, name):
    path = token_counts.public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(own.encode(t))
    else:
        import tokenizers

        own = tokenizers.Tokenizer.from_file(path)
        count = lambda t: len(own.encode(t, add_special_tokens=False).ids)
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    rows += [(10**6, "a <|endoftext|> b<|endoftext|>"), (10**6 + 1, None), (10**6 + 2, rows[0][1]), (None, "x y")]
    docs, cache = make([(i, t, "s") for i, t in rows]), str(tmp_path / "cache")
    want = sorted((i is None, i, len((t or "").encode()), count(t or "")) for i, t in rows)
    for _ in range(2):
        got = token_counts.count_tokens(docs, name, cache).collect()
        assert sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count() == len({t or "" for _, t in rows})


def test_a_part_of_the_cache_is_used(spark, make, tmp_path):
    cache = str(tmp_path / "cache")
    token_counts.count_tokens(make([(1, "one text", "s")]), cache=cache).collect()
    digest = hashlib.sha256(b"one text").digest()
    wrong = spark.createDataFrame(
        [(bytearray(hashlib.sha256(b"other").digest()), 77, token_counts.version(token_counts.TOKENIZER))],
        token_counts.CACHE_SCHEMA,
    )
    wrong.write.mode("append").partitionBy("tokenizer").parquet(cache)
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(make([(1, "one text", "s"), (2, "other", "s")]), cache=cache).collect()}
    assert digest and got[2] == 77 and got[1] < 77


def test_odd_rows_and_empty_tables(odd, make):
    empty = make([])
    for run in (pii.find_pii, quality.quality, bpe.round_trip, token_counts.count_tokens):
        assert run(odd).count() == odd.count()
        assert run(empty).count() == 0


def test_account_numbers_of_every_length_before_any_word(make):
    def number(country, length, k):
        body = "".join("0123456789"[(7 * i + k) % 10] for i in range(length - 4))
        digits = "".join(str(int(c, 36)) for c in f"{body}{country}00")
        return f"{country}{98 - int(digits) % 97:02d}{body}"

    rows, want = [], []
    for length, country in enumerate("NO BE XX DK SI AT CH DE GB ES PT TR FR PL BR KW MT LC RU XY".split(), 15):
        for form in (str, lambda v: " ".join(v[k : k + 4] for k in range(0, len(v), 4))):
            for after in ("", " Please pay", " The bank", " IS", " A", " now", " 12", ", Then", f" {number('DE', 22, 1)}"):
                text = form(number(country, length, len(rows)))
                rows.append((len(rows), f"é {text}{after}", "s"))
                want.append([text] + ([number("DE", 22, 1)] if "DE" in after else []))
    got = {r.doc_id: r.spans for r in pii.find_pii(make(rows)).collect()}
    for (i, text, _), values in zip(rows, want):
        spans = [s.split(":") for s in got[i].split(",") if s.startswith("iban:")]
        assert [text[int(b) : int(e)] for _, b, e in spans] == values, text
    known = [(1, "ES91 2100 0418 4502 0005 1332 Please pay", "s"), (2, "BE68 5390 0754 7034 The bank", "s")]
    assert [r.text for r in pii.redact(make(known)).orderBy("doc_id").collect()] == ["<IBAN> Please pay", "<IBAN> The bank"]


def test_context_reaches_over_earlier_matches(make):
    one, two, three = "123-45-6789", "234-56-7890", "345-67-8901"
    rows = [
        (1, f"SSN {one} and {two}", "s"),
        (2, f"SSN: {one}, {two}, {three}", "s"),
        (3, f"SSN {one}{' ' * 45}{two}", "s"),
        (4, f"parts {one} and {two}", "s"),
        (5, "bank DE89 3704 0044 0532 0130 00 GB82 WEST 1234 5698 7654 32", "s"),
        (6, f"{'x ' * 40}tax id\n{one}\n{two}\n666-12-3456 {three}", "s"),
        (7, "mail " + " ".join(["a@b.c"] * 8) + " " + "m" * 60 + "@b.c z@b.c", "s"),
    ]
    got = {r.doc_id: r for r in pii.find_pii(make(rows)).collect()}
    assert [got[i].n_ssn for i in range(1, 8)] == [2, 3, 1, 0, 0, 3, 0]
    for i, text, _ in rows:
        spans = [s.split(":") for s in got[i].spans.split(",") if s]
        for (kind, begin, _), score in zip(spans, got[i].scores.split(",")):
            k = next(k for k in pii.KINDS if k.name == kind)
            near = re.search(f"(?<![a-z])(?:{k.context})", text[max(0, int(begin) - pii.REACH) : int(begin)].lower())
            assert float(score) == round(min(1.0, k.start + 0.4 * k.checked + 0.3 * bool(near)), 2), (i, begin)
    assert pii.redact(make(rows[:1])).first().text == "SSN <SSN> and <SSN>"
