"""Cross-tokenizer alignment: where the tokens of two tokenizers end together, and which ids stand for the same bytes.

The ends of both tokenizers' tokens are merged by merge path: binary searches on the diagonals of the merge divide it into pieces of
equal work, each of which is merged by itself and emits its overlaps; neighbouring pieces are stitched where two equal ends
fall to both sides of a cut. Overlaps between common ends make a group, whose ids are linked pairwise.

Pairs are counted over the corpus in two moves. A task collects the different pairs of a chunk of texts and asks for them once,
however many of its texts hold them; Spark adds up the chunks' counts, and each chunk gets back the totals of its pairs.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonetide.llm.common import blocks, cut, map_batches, release, stored

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Ends of both sides in one piece of a merge.
PIECE = 4_096
#: Links that are written out at once; a larger group goes by its different ids.
LINKS_AT_ONCE = 1 << 21
#: Characters of units whose tokens a worker remembers, and units encoded at once.
REMEMBERED, UNITS = 6_000_000, 4_000
#: Bytes of text whose pairs are asked for together.
CHUNK_BYTES = 16 << 20
#: A piece of text that ends before a space, after what is no white space. The patterns and pieces of both tokenizers end there too.
_UNIT = re.compile(r"\s*\S+(?:[^\S ]\s*\S+)*(?:[^\S ]\s*\Z)?|\s+")


def _byte_table() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, others in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Tokens of both tokenizers for many texts, as the libraries give them for each whole text.

    Units between the cuts that both respect are encoded once and remembered.
    """

    def __init__(self, a: str = A, b: str = B) -> None:
        path = public_tokenizers.path(a)
        self.a = tokenizers.Tokenizer.from_file(path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b))
        byte_of = _byte_table()
        names = {i: n for n, i in self.a.get_vocab(with_added_tokens=True).items()}
        added = {i: t.content.encode() for i, t in self.a.get_added_tokens_decoder().items()}
        self.bytes_a = [
            added[i] if i in added else bytes(byte_of[c] for c in names.get(i, "")) for i in range(max(names) + 1)
        ]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.size_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        self.space = self.b.piece_to_id("▁")
        with open(path, encoding="utf-8") as file:
            split = json.load(file).get("pre_tokenizer") or {}
        cuts = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        cuts = cuts and self.space != self.b.unk_id() and not any(re.search("[^▁]▁", p) for p in pieces)
        self.split = _UNIT.findall if cuts else lambda text: [text]
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.held = 0
        none = np.array([], np.int64)
        self.flat = [none, none]
        self.count = [none, none]
        self.whole = np.array([], bool)

    def _learn(self, units: list[str]) -> None:
        found: tuple[list, list] = ([], [])
        good = []
        for at in range(0, len(units), UNITS):
            part = units[at : at + UNITS]
            of_a = [x.ids for x in self.a.encode_batch_fast(part, add_special_tokens=False)]
            # The first space is the one that the library puts in front itself.
            of_b = self.b.encode([u[1:] for u in part], num_threads=1)
            of_b = [ids if u != " " else [self.space] for u, ids in zip(part, of_b)]
            raw = [u.encode() for u in part]
            same = np.ones(len(part), dtype=bool)
            for ids, spelled in ((of_a, self.bytes_a), (of_b, self.bytes_b)):
                spelt = [b"".join(map(spelled.__getitem__, x)) for x in ids]
                if spelt != raw:
                    same &= [x == y for x, y in zip(spelt, raw)]
            good.append(same)
            found[0].extend(of_a)
            found[1].extend(of_b)
        self.place.update(zip(units, range(len(self.place), len(self.place) + len(units))))
        self.held += sum(map(len, units))
        for k in (0, 1):
            new = np.array(list(chain.from_iterable(found[k])), dtype=np.int64)
            self.flat[k] = np.concatenate([self.flat[k], new])
            self.count[k] = np.concatenate([self.count[k], np.fromiter(map(len, found[k]), np.int64, len(units))])
        self.whole = np.concatenate([self.whole, *good])

    def encode(self, many: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For both tokenizers the ids of all texts in a row, and their number by text.

        An empty text has none, nor has one whose tokens of either kind do not spell a space and the text.
        """
        split = [self.split(" " + t) if t else [] for t in many]
        needed = set(chain.from_iterable(split))
        new = [u for u in needed if u not in self.place]
        if self.held + sum(map(len, new)) > REMEMBERED:
            self._forget()
            new = list(needed)
        if new:
            self._learn(new)
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(many)), sizes)
        bad = np.bincount(owner[~self.whole[at]], minlength=len(many)) > 0
        at, owner = at[~bad[owner]], owner[~bad[owner]]
        ids, by_text = [], []
        for k in (0, 1):
            begin = np.cumsum(self.count[k]) - self.count[k]
            ids.append(self.flat[k][_ranges(begin[at], self.count[k][at])])
            by_text.append(np.bincount(owner, self.count[k][at], len(many)).astype(np.int64))
        return ids, by_text


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of many ranges, in a row."""
    return np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)


# --- merge path -----------------------------------------------------------------------------------------------------


def diagonals(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two sorted arrays crosses every `piece`-th diagonal: how many of each come before. Of equal
    values that of `a` comes first.
    """
    d = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (low < high).any():
        # Searches that are done look at a valid place and stay where they are.
        middle = np.where(low < high, (low + high) // 2, 0)
        other = np.where(low < high, d - 1 - middle, 0)
        more = (low < high) & (a[middle] <= b[other])
        high = np.where((low < high) & ~more, middle, high)
        low = np.where(more, middle + 1, low)
    return low, d - low


def merge_piece(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The overlaps that a piece's ends close, in order: the token of each side, counted in the piece, and whether both end.

    A token that ends behind the piece is the one after the piece's last.
    """
    of_a = np.searchsorted(b, a, "left")
    common = np.zeros(len(a), dtype=bool)
    inside = of_a < len(b)
    common[inside] = b[of_a[inside]] == a[inside]
    of_b = np.searchsorted(a, b, "left")
    alone = np.ones(len(b), dtype=bool)
    alone[of_a[common]] = False
    left = np.concatenate([np.arange(len(a)), of_b[alone]])
    right = np.concatenate([of_a, np.nonzero(alone)[0]])
    closed = np.concatenate([common, np.zeros(int(alone.sum()), dtype=bool)])
    # Overlaps follow each other along both sides, so the sum of their places orders them.
    order = np.argsort(left + right, kind="stable")
    return left[order], right[order], closed[order]


def overlaps(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All overlapping pairs of tokens of two tokenizers, given by their sorted ends, and whether the two end together.

    Pieces are merged by themselves. Where an end of `a` is the last of a piece and the equal end of `b` the first of the next, the
    two pieces are stitched: the overlap is closed, and the next piece's own is dropped.
    """
    i, j = diagonals(a, b, piece)
    out = []
    for k in range(len(i) - 1):
        left, right, closed = merge_piece(a[i[k] : i[k + 1]], b[j[k] : j[k + 1]])
        left, right = left + i[k], right + j[k]
        if out and i[k] and j[k] < len(b) and a[i[k] - 1] == b[j[k]]:
            out[-1][2][-1] = True
            keep = np.ones(len(left), dtype=bool)
            keep[int(np.argmax(right == j[k]))] = False
            left, right, closed = left[keep], right[keep], closed[keep]
        if len(left):
            out.append([left, right, closed])
    if not out:
        none = np.array([], np.int64)
        return none, none, np.array([], bool)
    return tuple(np.concatenate(x) for x in zip(*out))


# --- links ----------------------------------------------------------------------------------------------------------


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys together, their counts added."""
    if len(keys) == 1:
        return keys[0], counts[0]
    every, place = np.unique(np.concatenate([*keys, np.array([], np.int64)]), return_inverse=True)
    out = np.zeros(len(every), dtype=np.int64)
    np.add.at(out, place, np.concatenate([*counts, np.array([], np.int64)]))
    return every, out


def links(
    ids_a: np.ndarray, ids_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, doc: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each text the linked pairs of ids and how many links each has. Groups are given by their last tokens and their text.

    A key is the text's number times 2 ** 40 plus the pair, a * width + b. Keys are sorted.
    """
    first_a, first_b = np.append(0, last_a[:-1] + 1)[: len(last_a)], np.append(0, last_b[:-1] + 1)[: len(last_b)]
    n, m = last_a - first_a + 1, last_b - first_b + 1
    size = n * m
    keys, counts = [], []
    total = np.cumsum(size)
    at = 0
    while at < len(size):
        done = total[at - 1] if at else 0
        to = int(np.searchsorted(total, done + LINKS_AT_ONCE, "right"))
        if to == at:
            # One large group: its different ids, and how often each stands there.
            x, in_x = np.unique(ids_a[first_a[at] : last_a[at] + 1], return_counts=True)
            y, in_y = np.unique(ids_b[first_b[at] : last_b[at] + 1], return_counts=True)
            per = max(1, LINKS_AT_ONCE // len(y))
            for k in range(0, len(x), per):
                pair = x[k : k + per, None] * width + y[None, :]
                keys.append((pair + (int(doc[at]) << 40)).ravel())
                counts.append((in_x[k : k + per, None] * in_y[None, :]).ravel())
            to = at + 1
        else:
            own = slice(at, to)
            group = np.repeat(np.arange(at, to), size[own])
            inside = np.arange(len(group)) - np.repeat(total[own] - size[own] - done, size[own])
            pair = ids_a[first_a[group] + inside // m[group]] * width + ids_b[first_b[group] + inside % m[group]]
            key, count = np.unique(pair + (doc[group] << 40), return_counts=True)
            keys.append(key)
            counts.append(count)
        at = to
    return _added(keys, counts) if keys else (np.array([], np.int64), np.array([], np.int64))


class _Spelling:
    """The text of a text's groups: `a1,a2|b1;a3|b2,b3`."""

    def __init__(self, size_a: int, size_b: int) -> None:
        self.parts = [
            *(f"{i}," for i in range(size_a)), *(f"{i}|" for i in range(size_a)),
            *(f"{i}," for i in range(size_b)), *(f"{i};" for i in range(size_b)),
        ]
        self.size_a, self.size_b = size_a, size_b

    def codes(self, ids: list[np.ndarray], last: list[np.ndarray]) -> np.ndarray:
        """The parts of all groups in a row: the first side's tokens of a group, then the second's."""
        a, b = ids[0].copy(), ids[1] + 2 * self.size_a
        a[last[0]] += self.size_a
        b[last[1]] += self.size_b
        n = np.diff(np.append(-1, last[0]))
        m = np.diff(np.append(-1, last[1]))
        out = np.empty(len(a) + len(b), dtype=np.int64)
        out[np.arange(len(a)) + np.repeat(np.cumsum(m) - m, n)] = a
        out[np.arange(len(b)) + np.repeat(np.cumsum(n), m)] = b
        return out

    def digest(self, codes: np.ndarray) -> str:
        if not len(codes):
            return ""
        text = "".join(map(self.parts.__getitem__, codes.tolist()))
        return hashlib.sha256(text[:-1].encode()).hexdigest()


_worker: dict[tuple[str, str], tuple[Encoder, _Spelling]] = {}


def _tools(a: str, b: str) -> tuple[Encoder, _Spelling]:
    """One encoder per worker process."""
    if (a, b) not in _worker:
        e = Encoder(a, b)
        _worker[(a, b)] = e, _Spelling(len(e.bytes_a), len(e.bytes_b))
    return _worker[(a, b)]


def aligned(many: list[str], a: str = A, b: str = B) -> tuple[dict[str, list], np.ndarray, np.ndarray]:
    """Figures and digest of each text, and the keys and numbers of its links."""
    encoder, spelling = _tools(a, b)
    ids, by_text = encoder.encode(many)
    # Both sides spell the same bytes, so all texts can be merged as one: a text's last tokens end together.
    ends = [np.cumsum(encoder.size_a[ids[0]]), np.cumsum(encoder.size_b[ids[1]])]
    left, right, closed = overlaps(*ends)
    last = [left[closed], right[closed]]
    text_of = np.repeat(np.arange(len(many)), by_text[0])
    doc = text_of[last[0]]
    key, count = links(ids[0], ids[1], last[0], last[1], doc, len(encoder.bytes_b))
    codes = spelling.codes(ids, last)
    stop = np.cumsum(by_text[0] + by_text[1])
    start = stop - by_text[0] - by_text[1]
    owner = key >> 40
    figures = {
        "n_a": by_text[0].tolist(),
        "n_b": by_text[1].tolist(),
        "n_groups": np.bincount(doc, minlength=len(many)).tolist(),
        "n_links": np.bincount(owner, count, len(many)).astype(np.int64).tolist() if len(key) else [0] * len(many),
        "groups_sha256": [spelling.digest(codes[x:y]) for x, y in zip(start.tolist(), stop.tolist())],
    }
    return figures, key, count


# --- the corpus -----------------------------------------------------------------------------------------------------


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers below 2 ** 32, byte by byte of the same weight, which compresses well."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplanes(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


class _Chunk:
    """Texts whose pairs are asked for together."""

    def __init__(self, number: int) -> None:
        self.number, self.bytes, self.rows = number, 0, []
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, ids: list, figures: dict[str, list], key: np.ndarray, count: np.ndarray, size: int) -> None:
        self.keys.append(key + (len(self.rows) << 40))
        self.counts.append(count)
        self.rows += zip(ids, *figures.values())
        self.bytes += size

    def batches(self, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        """A row of the chunk's pairs and how many texts hold each; then a row per text, whose pairs are places among these."""
        key, count = np.concatenate(self.keys), np.concatenate(self.counts)
        pairs, place, docs = np.unique(key & ((1 << 40) - 1), return_inverse=True, return_counts=True)
        edges = np.searchsorted(key >> 40, np.arange(len(self.rows) + 1))
        none = [None]
        yield self._batch(kind, [none] * 6, [none, none], pairs.tolist(), docs.tolist())
        for at in range(0, len(self.rows), 1_000):
            rows = self.rows[at : at + 1_000]
            places, numbers = [], []
            for k in range(at, at + len(rows)):
                own = slice(edges[k], edges[k + 1])
                places.append(_planes(np.diff(place[own], prepend=0)))
                numbers.append(_planes(count[own]))
            yield self._batch(kind, list(zip(*rows)), [places, numbers], None, None)

    def _batch(self, kind, columns, packed, pairs, docs) -> pa.RecordBatch:
        size = len(columns[0])
        long, text, many = pa.int64(), pa.string(), pa.list_(pa.int64())
        arrays = [
            pa.array([self.number] * size, long), pa.array(columns[0], kind),
            *(pa.array(c, t) for c, t in zip(columns[1:], (long, long, long, long, text))),
            *(pa.array(c, pa.binary()) for c in packed),
            pa.array([pairs] * size, many), pa.array([docs] * size, many),
        ]
        names = [
            "chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "numbers", "pairs", "docs"
        ]
        return pa.RecordBatch.from_arrays(arrays, names=names)


def _chunks(docs: DataFrame, a: str, b: str) -> DataFrame:
    kind = docs.schema["doc_id"].dataType
    read = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, arrow = None, None
        for whole in batches:
            arrow = whole.schema.field(0).type
            for batch in blocks(whole):
                texts = batch.column(1).to_pylist()
                if chunk is None:
                    chunk = _Chunk(batch.column(2)[0].as_py() << 32)
                chunk.add(batch.column(0).to_pylist(), *aligned(texts, a, b), size=batch.column(1).nbytes)
                if chunk.bytes >= CHUNK_BYTES:
                    yield from chunk.batches(arrow)
                    chunk = _Chunk(chunk.number + 1)
        if chunk is not None and chunk.rows:
            yield from chunk.batches(arrow)

    return map_batches(
        read,
        run,
        f"chunk bigint, doc_id {kind.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
        "groups_sha256 string, places binary, numbers binary, pairs array<bigint>, docs array<bigint>",
    )


def pair_counts(asked: DataFrame, width: int) -> DataFrame:
    """`pair`, its `total` over the chunks, and whether that is the highest of its first id (`best`)."""
    totals = cut(asked.groupBy("pair").agg(F.sum("n").alias("total")))
    first = totals.withColumn("a", F.floor(F.col("pair") / width))
    highest = first.groupBy("a").agg(F.max("total").alias("highest"))
    return first.join(highest, "a").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))


def align(docs: DataFrame, a: str = A, b: str = B) -> DataFrame:
    """Per text `doc_id`, `n_a`, `n_b`, `n_groups`, `n_links`, `n_best`, `count_sum` and `groups_sha256`.

    `a` is a byte-level tokenizer that gets a space and the text, `b` a sentencepiece model that puts the space itself; strings of
    special tokens are plain text. A null or empty text, and one whose tokens of either kind do not spell a space and the text,
    has no tokens: zeros and an empty digest. Rows are documents: repeated ones count each. A null id stays, an
    empty table gives an empty one, other columns are not read.
    """
    width = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b)).get_piece_size()
    chunks = stored(_chunks(docs, a, b), "aligned")
    release(docs.sparkSession)
    asked = chunks.filter("pairs IS NOT NULL").select(
        F.col("chunk").alias("asker"), F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("docs").alias("n")))
    )
    counts = stored(pair_counts(asked.select("pair", "n"), width), "pair-counts")
    release(docs.sparkSession)
    answers = asked.select("asker", "pair").join(counts, "pair").select("asker", "pair", "total", "best")
    texts = chunks.filter("pairs IS NULL").drop("pairs", "docs")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(_, rows: pa.Table, answer: pa.Table) -> pa.Table:
        order = np.argsort(answer.column("pair").to_numpy())
        total = answer.column("total").to_numpy()[order]
        best = answer.column("best").to_numpy(zero_copy_only=False)[order]
        n_best, count_sum = [], []
        for places, numbers in zip(rows.column("places").to_pylist(), rows.column("numbers").to_pylist()):
            place, number = np.cumsum(_unplanes(places)), _unplanes(numbers)
            n_best.append(int(number[best[place]].sum()))
            count_sum.append(int((number * total[place]).sum()))
        figures = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        kept = {c: rows.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        return pa.table({**kept, **figures, "groups_sha256": rows.column("groups_sha256")})

    return (
        texts.groupBy("chunk")
        .cogroup(answers.groupBy("asker"))
        .applyInArrow(
            run,
            f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
            "groups_sha256 string",
        )
    )
