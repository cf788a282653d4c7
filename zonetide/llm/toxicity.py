"""Toxicity: averaged subword-bag embeddings and a linear softmax, trained jointly in numpy, applied on the executors."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonetide.llm.common import blocks, map_batches, texts

#: Documented bounds of the training sample: rows of each class and characters in all. They bound the driver's memory.
ROWS_PER_CLASS = 4_000
MAX_CHARS = 20_000_000

GRAMS = (3, 5)
BUCKETS = 1 << 17
WIDTH = 8
EPOCHS, BATCH, RATE, DECAY = 10, 256, 0.05, 1e-5
#: Words whose buckets are made at once.
WORDS_AT_ONCE = 20_000
#: A few words among hundreds decide, so the mean is scaled before the softmax.
SCALE = 20.0
#: Words whose score a task remembers; when full, it starts afresh.
REMEMBERED = 200_000
_EDGES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "«»“”„‘’¿¡…–—"


_FACTOR = 0x9E3779B97F4A7C15


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(29))) % np.uint64(BUCKETS)).astype(np.int64)


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of many words' character n-grams, with the words' ends marked, and of the words as wholes; and for each
    bucket the number of its word. Misspellings share most of them.
    """
    marked = [f"<{w}>" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    size = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    begin, owner = np.cumsum(size) - size, np.repeat(np.arange(len(marked)), size)
    powers = np.full(int(size.max(initial=1)), _FACTOR, dtype=np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    whole = codes * powers[np.arange(len(codes)) - begin[owner]]
    found = [_mix(np.add.reduceat(whole, begin)) if len(marked) else np.array([], np.int64)]
    owners = [np.arange(len(marked))]
    for n in range(GRAMS[0], GRAMS[1] + 1):
        m = max(0, len(codes) - n + 1)
        h = np.full(m, n, dtype=np.uint64)
        for k in range(n):
            h = h * np.uint64(_FACTOR) + codes[k : k + m]
        inside = owner[:m] == owner[n - 1 : n - 1 + m]
        found.append(_mix(h[inside]))
        owners.append(owner[:m][inside])
    return np.concatenate(found), np.concatenate(owners)


def words_of(text: str) -> list[str]:
    return [w for raw in text.lower().split() if (w := raw.strip(_EDGES))]


@dataclass
class Model:
    """`value` is each bucket's share of the logit of class 1 over class 0: its embedding through the softmax layer."""

    value: np.ndarray
    bias: float

    def words(self, many: list[str]) -> np.ndarray:
        """The mean of each word's buckets."""
        bucket, owner = grams(many)
        return np.bincount(owner, self.value[bucket], len(many)) / np.maximum(np.bincount(owner, minlength=len(many)), 1)


@dataclass
class _Bags:
    """Documents as rows of word counts, words as rows of buckets, both flattened."""

    word_begin: np.ndarray
    buckets: np.ndarray
    doc_begin: np.ndarray
    words: np.ndarray
    shares: np.ndarray


def _bags(many: list[str]) -> _Bags:
    place: dict[str, int] = {}
    doc_begin, words, shares = [0], [], []
    for text in many:
        own = words_of(text)
        names, counts = np.unique([place.setdefault(w, len(place)) for w in own], return_counts=True) if own else ([], [])
        words.append(np.asarray(names, dtype=np.int32))
        shares.append(np.asarray(counts, dtype=np.float32) / max(len(own), 1))
        doc_begin.append(doc_begin[-1] + len(names))
    flat, size, every = [np.array([], np.int32)], [np.array([], np.int64)], list(place)
    for at in range(0, len(every), WORDS_AT_ONCE):
        part = every[at : at + WORDS_AT_ONCE]
        bucket, owner = grams(part)
        flat.append(bucket[np.argsort(owner, kind="stable")].astype(np.int32))
        size.append(np.bincount(owner, minlength=len(part)))
    begin = np.concatenate([[0], np.cumsum(np.concatenate(size))])
    return _Bags(begin, np.concatenate(flat), np.array(doc_begin), np.concatenate(words), np.concatenate(shares))


def _ranges(begin: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flat places of some rows, and for each place the number of its row among them."""
    size = begin[rows + 1] - begin[rows]
    owner = np.repeat(np.arange(len(rows)), size)
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + begin[rows][owner], owner


def _sums(owner: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(owner, rows[:, j], n) for j in range(rows.shape[1])], axis=1).astype(np.float32)


def train(many: list[str], labels: list[int], weights: list[float], seed: int = 7) -> Model:
    """Embeddings and softmax layer together, by Adam on weighted cross-entropy."""
    if len(set(labels)) < 2:
        # One class, or nothing to learn from: the share of class 1 is all there is, one half of no rows.
        return Model(np.zeros(BUCKETS, np.float32), 0.0 if not labels else (10.0 if labels[0] else -10.0))
    bags, random = _bags(many), np.random.default_rng(seed)
    y, w = np.array(labels, dtype=np.int64), np.array(weights, dtype=np.float32)
    part = {
        "embed": random.normal(0, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32),
        "layer": random.normal(0, 1 / WIDTH, (WIDTH, 2)).astype(np.float32),
        "bias": np.zeros(2, np.float32),
    }
    first = {k: np.zeros_like(v) for k, v in part.items()}
    second = {k: np.zeros_like(v) for k, v in part.items()}
    step = 0
    for epoch in range(EPOCHS):
        order = random.permutation(len(y))
        for at in range(0, len(y), BATCH):
            docs = order[at : at + BATCH]
            place, doc = _ranges(bags.doc_begin, docs)
            used, word = np.unique(bags.words[place], return_inverse=True)
            share = bags.shares[place][:, None]
            inner, owner = _ranges(bags.word_begin, used)
            bucket = bags.buckets[inner]
            size = (bags.word_begin[used + 1] - bags.word_begin[used]).astype(np.float32)[:, None]
            vectors = _sums(owner, part["embed"][bucket], len(used)) / size
            mean = _sums(doc, vectors[word] * share, len(docs))
            logits = SCALE * mean @ part["layer"] + part["bias"]
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(docs)), y[docs]] -= 1
            error = p * w[docs][:, None] / w[docs].sum()
            d_mean = SCALE * error @ part["layer"].T
            d_vector = _sums(word, d_mean[doc] * share, len(used)) / size
            d_embed = _sums(bucket, d_vector[owner], BUCKETS) + DECAY * part["embed"]
            slope = {"embed": d_embed, "layer": SCALE * mean.T @ error, "bias": error.sum(axis=0)}
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for k, g in slope.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                part[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    layer = part["layer"][:, 1] - part["layer"][:, 0]
    return Model((SCALE * part["embed"] @ layer).astype(np.float32), float(part["bias"][1] - part["bias"][0]))


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training; rows without an id always are."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS_PER_CLASS, chars: int = MAX_CHARS) -> Model:
    """The model from labelled rows that are not held out.

    For each class the `rows` ids of least digest are taken, and of those, in turn, as many whole texts as `chars` holds,
    at least one each: only ids and lengths are compared across the corpus, then the chosen texts are fetched. Weights give
    the classes back the shares that they have among all labelled rows, so that a score of one half means even odds.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    )
    read = texts(docs)
    sized = read.select("doc_id", F.char_length("text").alias("size")).groupBy("doc_id").agg(F.max("size").alias("size"))
    joined = known.join(sized, "doc_id").select("doc_id", "toxic", "size", F.xxhash64("doc_id").alias("order"))
    totals = {r.toxic: r.n for r in joined.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen: dict[object, int] = {}
    for label in sorted(totals):
        left = chars // 2
        for r in joined.filter(F.col("toxic") == label).orderBy("order", "doc_id").limit(rows).collect():
            if r.size <= left or label not in chosen.values():
                chosen[r.doc_id] = label
                left -= r.size
    if not chosen:
        return train([], [], [])
    ids = docs.sparkSession.createDataFrame([(i,) for i in chosen], docs.select("doc_id").schema)
    rows_ = read.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).collect()
    rows_.sort(key=lambda r: str(r.doc_id))
    taken = {label: sum(v == label for v in chosen.values()) for label in totals}
    y = [chosen[r.doc_id] for r in rows_]
    return train([r.text for r in rows_], y, [totals[k] / taken[k] for k in y])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id`, `held_out`, `score` and `predicted` of every whole text, one result row per row.

    Null and empty texts, and texts without words, get the score of the bias alone. Rows with a null id count as held out;
    repeated rows repeat, an empty table gives an empty one, other columns are not read. The model is broadcast: its
    size is fixed by the number of buckets, half a megabyte.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known = sent.value, {}
        for whole in batches:
            for batch in blocks(whole):
                logits = []
                for text in batch.column(1).to_pylist():
                    raw = text.lower().split()
                    new = set(raw).difference(known)
                    if len(known) + len(new) > REMEMBERED:
                        known.clear()
                        new = set(raw)
                    bare = {r: w for r in new if (w := r.strip(_EDGES))}
                    known.update(dict.fromkeys(new, math.nan))
                    known.update(zip(bare, m.words(list(bare.values())).tolist()))
                    found = np.fromiter(map(known.__getitem__, raw), dtype=np.float64, count=len(raw))
                    found = found[~np.isnan(found)]
                    logits.append(m.bias + (float(found.mean()) if len(found) else 0.0))
                scores = 1 / (1 + np.exp(-np.clip(np.array(logits), -500, 500)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(2),
                        pa.array(scores, pa.float64()),
                        pa.array((scores >= 0.5).astype(np.int32)),
                    ],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    read = texts(docs).withColumn("held_out", held_out(F.col("doc_id")))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(read, run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all texts by a model of the labelled ones."""
    return score(docs, fit(docs, labels))
