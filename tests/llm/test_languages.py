"""Language identification: vectors and counts against plain versions, accuracy on rows kept from learning."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonetide.llm import languages as L
from zonetide.llm.queries import QUERIES


def plain_vector(text):
    """The sum over a text's n-grams, one by one."""
    spaced, out = " ", np.zeros(L.WIDTH)
    for c in text.lower():
        if c.isalpha():
            spaced += c
        elif spaced[-1] != " ":
            spaced += " "
    spaced += "" if spaced[-1] == " " else " "
    for k in range(len(spaced) - 2):
        bound = np.ones(L.WIDTH)
        for i, c in enumerate(spaced[k : k + 3]):
            own = L.character_vectors(np.array([0 if c == " " else ord(c)]))[0]
            bound *= np.roll(own, 2 - i)
        out += bound
    return out


TEXTS = ["Hello, world!", "", "  ", "a", "ÀÉ ß", "12 3", "日本語 テキスト", "x\n\ny  z", "İ", "word " * 50]


def test_sums_equal_the_plain_version():
    grams = L.Grams(TEXTS)
    assert np.array_equal(grams.sums(grams.owner, len(TEXTS)), np.stack([plain_vector(t) for t in TEXTS]))


@pytest.mark.parametrize(("at_once", "cells"), [(1, 1), (3, 40), (8_192, 100)])
def test_blocks_change_nothing(monkeypatch, at_once, cells):
    monkeypatch.setattr(L, "GRAMS_AT_ONCE", at_once)
    monkeypatch.setattr(L, "CELLS", cells)
    grams = L.Grams(TEXTS)
    assert np.array_equal(grams.sums(grams.owner, len(TEXTS)), np.stack([plain_vector(t) for t in TEXTS]))


def test_characters_are_nearly_orthogonal():
    own = L.character_vectors(np.arange(300)).astype(int)
    cosine = own @ own.T / L.WIDTH
    assert set(np.unique(own)) == {-1, 1} and np.abs(cosine - np.eye(300)).max() < 0.2


def test_profiles_equal_the_plain_sums(spark, make):
    rnd = random.Random(4)
    rows = [(k, " ".join(rnd.choice(["der", "the", "und", "and"]) for _ in range(5)), "a") for k in range(60)]
    docs = make(rows).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "x").otherwise("y"))
    want = {"x": np.zeros(L.WIDTH), "y": np.zeros(L.WIDTH)}
    for k, t, _ in rows:
        if zlib.crc32(str(k).encode()) % 4 != 2:
            want["xy"[k % 2]] += plain_vector(t)
    got = {r["lang"]: np.array(r["profile"]) for r in L.profiles(docs.repartition(7)).collect()}
    assert set(got) == {"x", "y"} and all(np.array_equal(got[k], want[k]) for k in got)


def test_languages_of_rows_kept_from_learning(spark):
    d = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op13_languages"](spark, d).join(docs, "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    kept = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in kept) / len(kept) > 0.99
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_rows_kept_from_learning_do_not_matter(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    other = docs.withColumn("lang", F.when(L.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang"))).withColumn("source", F.lit("?"))
    assert sorted(L.language_id(docs).collect()) == sorted(L.language_id(other).collect())


def test_odd_rows(spark, odd, make):
    got = L.language_id(odd).collect()
    rows = odd.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).collect()
    want = sorted(
        (repr(r.doc_id), "en" if any(c.isalpha() for c in r.t) else "und", r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        for r in rows
    )
    assert sorted((repr(r.doc_id), r.lang_pred, r.held_out) for r in got) == want
    assert all(r.score == 0 for r in got if r.lang_pred == "und") and all(0 <= r.score <= 1 for r in got)
    assert L.language_id(make([])).count() == 0
    # Nothing learned: no language can be named.
    none = L.language_id(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(none) == len(rows) and {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}


def test_equal_profiles_go_to_the_first_name(spark, make):
    docs = make([(k, "same words here", "a") for k in (1, 3)]).withColumn("lang", F.when(F.col("doc_id") == 1, "b").otherwise("a"))
    assert all(zlib.crc32(str(k).encode()) % 4 != 2 for k in (1, 3))
    assert {r.lang_pred for r in L.language_id(docs).collect()} == {"a"}
