"""Language identification by hyperdimensional profiles.

Every character has a random vector of +1 and -1, made from its code point. An n-gram's vector binds its characters' vectors,
each rotated by its distance from the n-gram's end, by multiplying them; a text's vector is the sum over its n-grams, a language's
prototype the sum over its texts. A text goes to the prototype with the greatest cosine.

The sum over a language is linear in its n-grams' counts, so learning counts n-grams of all learning texts and binds each
different one once per batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonetide.llm.common import blocks, map_batches

WIDTH, GRAM, SEED = 1_024, 3, 0x9E3779B97F4A7C15
#: n-grams that are bound and multiplied at once, and cells of a count matrix, which bound a task's memory.
GRAMS_AT_ONCE, CELLS = 8_192, 1 << 22
UNKNOWN = "und"
_LAST = 0x110000


def _letters() -> np.ndarray:
    """For each code point itself if it is a letter, else 0, which stands for any run of other characters."""
    codes = np.zeros(_LAST, dtype=np.int32)
    found = [c for c in range(_LAST) if chr(c).isalpha()]
    codes[found] = found
    return codes


_table: list[np.ndarray] = []


def letters() -> np.ndarray:
    """The table, made once per worker process."""
    if not _table:
        _table.append(_letters())
    return _table[0]


def character_vectors(codes: np.ndarray) -> np.ndarray:
    """A row of +1 and -1 for each code point, from the bits of a mixed counter, the same on every machine."""
    words = -(-WIDTH // 64)
    at = codes.astype(np.uint64)[:, None] * np.uint64(words) + np.arange(words, dtype=np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        x = at * np.uint64(SEED)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    bits = np.unpackbits(x.astype("<u8").view(np.uint8).reshape(len(codes), -1), axis=1)[:, :WIDTH]
    return (bits.astype(np.int8) << 1) - 1


def bound(grams: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """Vectors of n-grams, given as rows of places in the alphabet: characters' vectors, rotated and multiplied."""
    own = character_vectors(alphabet)
    out = np.ones((len(grams), WIDTH), dtype=np.int8)
    for k in range(grams.shape[1]):
        out *= np.roll(own, grams.shape[1] - 1 - k, axis=1)[grams[:, k]]
    return out


class Grams:
    """The n-grams of many texts: `owner` and `kind` of each occurrence, and the `distinct` kinds over an `alphabet`."""

    def __init__(self, many: list[str]) -> None:
        raw = [t.lower().encode("utf-32-le", "surrogatepass") for t in many]
        size = np.array([len(r) // 4 + 2 for r in raw], dtype=np.int64)
        # Every text begins and ends with a gap; runs of gaps become one.
        gap = b"\0\0\0\0"
        codes = letters()[np.frombuffer(b"".join(part for r in raw for part in (gap, r, gap)), "<u4")]
        owner = np.repeat(np.arange(len(many)), size)
        keep = np.ones(len(codes), dtype=bool)
        keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0) | (owner[1:] != owner[:-1])
        codes, owner = codes[keep], owner[keep]
        self.letters = np.bincount(owner[codes != 0], minlength=len(many)) > 0
        present = np.bincount(codes, minlength=1)
        self.alphabet = np.nonzero(present)[0]
        place = np.zeros(len(present), dtype=np.int64)
        place[self.alphabet] = np.arange(len(self.alphabet))
        place = place[codes]
        n, base = max(0, len(place) - GRAM + 1), max(len(self.alphabet), 1)
        key = np.zeros(n, dtype=np.int64)
        for k in range(GRAM):
            key = key * base + place[k : k + n]
        inside = owner[:n] == owner[GRAM - 1 : GRAM - 1 + n]
        # A text without letters is one gap or two, hence no n-gram of its own.
        key, self.owner = key[inside], owner[:n][inside]
        if base**GRAM <= CELLS:
            there = np.bincount(key, minlength=1)
            kinds = np.nonzero(there)[0]
            number = np.zeros(len(there), dtype=np.int64)
            number[kinds] = np.arange(len(kinds))
            self.kind = number[key]
        else:
            kinds, self.kind = np.unique(key, return_inverse=True)
        self.distinct = np.stack([kinds // base ** (GRAM - 1 - k) % base for k in range(GRAM)], axis=1)

    def sums(self, owner: np.ndarray, n: int) -> np.ndarray:
        """For each of `n` owners the sum of its n-grams' vectors; the sums are whole numbers, exact below 2 ** 24."""
        out = np.zeros((n, WIDTH), dtype=np.float64)
        per = max(1, min(GRAMS_AT_ONCE, CELLS // max(n, 1)))
        order = np.argsort(self.kind, kind="stable") if len(self.distinct) > per else None
        for at in range(0, len(self.distinct), per):
            kinds = self.distinct[at : at + per]
            if order is None:
                kind, own = self.kind, owner
            else:
                first, last = np.searchsorted(self.kind, [at, at + per], sorter=order)
                kind, own = self.kind[order[first:last]] - at, owner[order[first:last]]
            counts = np.bincount(own * len(kinds) + kind, minlength=n * len(kinds)).reshape(n, len(kinds))
            out += counts.astype(np.float32) @ bound(kinds, self.alphabet).astype(np.float32)
        return out


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning; rows without an id always are."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def profiles(docs: DataFrame, lang: str = "lang") -> DataFrame:
    """The prototype of each language, as rows of `lang` and `profile`, from every learning text with that language.

    A task adds up its texts' n-grams and gives one vector per language; Spark adds the tasks'.
    """
    learn = docs.filter(F.col("text").isNotNull() & F.col(lang).isNotNull() & ~held_out(F.col("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for whole in batches:
            for batch in blocks(whole):
                names = batch.column(1).to_pylist()
                number = {n: k for k, n in enumerate(dict.fromkeys(names))}
                grams = Grams(batch.column(0).to_pylist())
                owner = np.array([number[n] for n in names], dtype=np.int64)[grams.owner]
                sums = grams.sums(owner, len(number))
                for name, k in number.items():
                    found[name] = found[name] + sums[k] if name in found else sums[k]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.keys(), pa.string()), pa.array([v.tolist() for v in found.values()], pa.list_(pa.float64()))],
            names=["lang", "part"],
        )

    parts = map_batches(learn.select("text", F.col(lang).cast("string").alias("lang")), run, "lang string, part array<double>")
    cells = parts.select("lang", F.posexplode("part").alias("k", "x")).groupBy("lang", "k").agg(F.sum("x").alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("k", "x")))
    return cells.groupBy("lang").agg(F.transform(ordered, lambda c: c["x"]).alias("profile"))


def identify(docs: DataFrame, learned: DataFrame) -> DataFrame:
    """`doc_id`, `held_out`, `lang_pred` and `score` of every whole text, one result row per row.

    `learned` is what `profiles` returns; languages are a handful of rows, which are collected and broadcast. The score is the
    cosine between text and prototype, 0 where that is negative. A null text and one without a letter are `und` with
    score 0, as is every text if nothing was learned; equal cosines go to the name that comes first. A null id stays and counts
    as held out, repeated rows repeat, an empty table gives an empty one, other columns are not read.
    """
    rows = sorted((r["lang"], r["profile"]) for r in learned.collect())
    names = [r[0] for r in rows]
    matrix = np.array([r[1] for r in rows], dtype=np.float64).reshape(len(rows), WIDTH)
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
    sent = docs.sparkSession.sparkContext.broadcast((names, matrix))
    read = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), held_out(F.col("doc_id")).alias("held_out")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, prototypes = sent.value
        for whole in batches:
            for batch in blocks(whole):
                grams = Grams(batch.column(1).to_pylist())
                best = np.zeros(batch.num_rows, dtype=np.int64)
                score = np.zeros(batch.num_rows)
                if known:
                    own = grams.sums(grams.owner, batch.num_rows)
                    cosine = own @ prototypes.T / np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-12)
                    best = cosine.argmax(axis=1)
                    score = np.clip(cosine[np.arange(len(best)), best], 0.0, 1.0)
                there = grams.letters & bool(known)
                picked = [known[b] if t else UNKNOWN for b, t in zip(best, there)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(2),
                        pa.array(picked, pa.string()),
                        pa.array(np.where(there, score, 0.0), pa.float64()),
                    ],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(read, run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def language_id(docs: DataFrame) -> DataFrame:
    """Predictions for all texts by prototypes of the learning ones."""
    return identify(docs, profiles(docs))
