"""Token counts from a cache of content and tokenizer digests; only distinct contents that it lacks are encoded."""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
import tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonetide.llm.common import blocks, cut, map_batches, shared_folder, texts

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
#: Pieces whose counts a worker remembers; when full, it keeps those of the texts at hand.
REMEMBERED = 300_000
PIECES = 4_000

CACHE_SCHEMA = "digest binary, n_tokens bigint, tokenizer string"


def version(name: str) -> str:
    """Digest of the tokenizer's file and of the library's version: another of either counts anew."""
    with open(public_tokenizers.path(name), "rb") as file:
        content = hashlib.sha256(file.read())
    if name.endswith(".json"):
        content.update(tokenizers.__version__.encode())
    else:
        import sentencepiece

        content.update(sentencepiece.__version__.encode())
    return content.hexdigest()


class Counter:
    """Token counts as the tokenizer's own library gives them.

    A byte-level tokenizer treats each match of its pattern by itself, so a match's count is taken once and remembered.
    Texts that hold a special token's string go to the library whole; so do all texts of other tokenizers.
    """

    def __init__(self, name: str) -> None:
        path = public_tokenizers.path(name)
        self.memory: dict[str, int] = {}
        self.by_piece = False
        if name.endswith(".model"):
            import sentencepiece

            pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            self.whole = lambda many: [len(x) for x in pieces.encode(many, num_threads=1)]
            return
        library = tokenizers.Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        self.whole = lambda many: [
            len(x.ids) for x in library.encode_batch_fast(many, add_special_tokens=False)
        ]
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        split = config.get("pre_tokenizer") or {}
        self.by_piece = (
            config.get("normalizer") is None
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
        )
        special = [t["content"] for t in config.get("added_tokens", [])]
        if self.by_piece:
            self.split = regex.compile(public_tokenizers.PATTERN).findall
            self.odd = regex.compile("|".join(map(regex.escape, special)) or r"(?!)").search

    def count(self, many: list[str]) -> list[int]:
        if not self.by_piece:
            return self.whole(many)
        plain = [self.odd(t) is None for t in many]
        split = [self.split(t) if p else None for t, p in zip(many, plain)]
        known = self.memory
        needed = set().union(*[pieces for pieces in split if pieces])
        new = needed.difference(known)
        if len(known) + len(new) > REMEMBERED:
            kept = {p: known[p] for p in needed if p in known}
            known.clear()
            known.update(kept)
        todo = list(new)
        for k in range(0, len(todo), PIECES):
            part = todo[k : k + PIECES]
            known.update(zip(part, self.whole(part)))
        odd = iter(self.whole([t for t, p in zip(many, plain) if not p]))
        return [next(odd) if pieces is None else sum(map(known.__getitem__, pieces)) for pieces in split]


_counters: dict[str, Counter] = {}


def counter(name: str) -> Counter:
    """One counter per worker process."""
    if name not in _counters:
        _counters[name] = Counter(name)
    return _counters[name]


def _cached(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    try:
        cache = spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        cache = spark.createDataFrame([], CACHE_SCHEMA)
    return cache.filter(F.col("tokenizer") == tokenizer).select("digest", "n_tokens")


def count_tokens(
    docs: DataFrame, name: str = TOKENIZER, cache: str | None = None, limit: int = LIMIT
) -> DataFrame:
    """`doc_id`, `n_bytes`, `n_tokens` and `over_limit` of every whole text, one result row per row.

    Contents are normalised as far as counts allow, that is a null text is empty, and digested. Repeats of a content
    collapse before the shuffle, so a content that a third of the rows share is one row of each task. Contents that the
    cache has under this tokenizer's version are not encoded; the others are, once each, and appended. A run that
    ends early leaves the cache valid, and contents appended twice by runs side by side count once.

    Without a `cache` path a new one is made in the shared folder. Null ids stay, repeated rows repeat, an empty table
    gives an empty one, other columns are not read.
    """
    spark = docs.sparkSession
    path = cache or os.path.join(shared_folder(spark), f"token-counts-{uuid.uuid4().hex}")
    tokenizer = version(name)
    read = texts(docs).withColumn("digest", F.unhex(F.sha2("text", 256)))
    known = _cached(spark, path, tokenizer)
    misses = read.select("digest", "text").dropDuplicates(["digest"]).join(known, "digest", "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(name)
        for whole in batches:
            for batch in blocks(whole):
                counts = c.count(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts, pa.int64())], names=["digest", "n_tokens"]
                )

    counted = map_batches(misses, run, "digest binary, n_tokens bigint").withColumn("tokenizer", F.lit(tokenizer))
    counted.write.mode("append").partitionBy("tokenizer").parquet(path)
    # Stored before the join, which then reads it without an aggregate above: the planner may split a hot content.
    counts = cut(_cached(spark, path, tokenizer).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))
    sizes = read.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    return sizes.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
