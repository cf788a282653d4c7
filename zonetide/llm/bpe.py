"""Byte-level BPE encoding with character offsets, and decoding, with the tokenizers library over Arrow batches."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, decoders, models, pre_tokenizers

from zonetide.llm.common import blocks, map_batches, texts

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Pieces whose ids a worker remembers; when full, it keeps those of the texts at hand.
REMEMBERED = 200_000
#: Pieces given to the library at once.
PIECES = 4_000


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte: printable ones for themselves, the others from 256 on, in order."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(shown))
    return table


def read_ranks(name: str) -> dict[bytes, int]:
    with open(public_tokenizers.path(name), "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """A rank file as a tokenizer of the library: every way to join two tokens to a third is a merge, by its rank."""

    def __init__(self, name: str = RANKS) -> None:
        ranks = read_ranks(name)
        shown = byte_characters()
        spell = {token: "".join(shown[b] for b in token) for token in ranks}
        merges = []
        for token, _ in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                ways = [(token[:k], token[k:]) for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks]
                merges += [(spell[a], spell[b]) for a, b in sorted(ways, key=lambda w: (ranks[w[0]], ranks[w[1]]))]
        model = models.BPE({spell[t]: r for t, r in ranks.items()}, merges, ignore_merges=True, fuse_unk=False)
        self.tokenizer = Tokenizer(model)
        # Each text handed over is one match of the pattern already.
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.tokenizer.decoder = decoders.ByteLevel()
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        unshown = {c: b for b, c in shown.items()}
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, text in spell.items():
            self.bytes_of[ranks[token]] = bytes(unshown[c] for c in text)
        self.memory: dict[str, tuple[int, ...]] = {}

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces not met before. What is forgotten is what these texts do not use, so common pieces stay."""
        known = self.memory
        new = pieces.difference(known)
        if len(known) + len(new) > REMEMBERED:
            kept = {p: known[p] for p in pieces if p in known}
            known.clear()
            known.update(kept)
        todo = list(new)
        for k in range(0, len(todo), PIECES):
            part = todo[k : k + PIECES]
            for piece, found in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                known[piece] = tuple(found.ids)

    def encode_batch(self, many: list[str]) -> list[np.ndarray]:
        """Ids of each text, unsigned and little-endian."""
        split = [self.split(text) for text in many]
        self.learn(set().union(*split))
        get = self.memory.__getitem__
        out = []
        for pieces in split:
            ids: list[int] = []
            for ids_of in map(get, pieces):
                ids += ids_of
            out.append(np.array(ids, dtype="<u4"))
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes the ids stand for: each id's characters taken back through the byte table."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def offsets(self, ids: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Start and end character of each token. A token that holds a part of a character covers all of it."""
        size = np.fromiter((len(self.bytes_of[i]) for i in ids.tolist()), dtype=np.int64, count=len(ids))
        end = np.cumsum(size)
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        # Characters begun up to and including each byte.
        begun = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        start = end - size
        return begun[start + 1] - 1 if len(ids) else start, begun[end]


_codecs: dict[str, Codec] = {}


def codec(name: str = RANKS) -> Codec:
    """One codec per worker process."""
    if name not in _codecs:
        _codecs[name] = Codec(name)
    return _codecs[name]


def encode(docs: DataFrame, ranks: str = RANKS, offsets: bool = True) -> DataFrame:
    """`doc_id`, `n_bytes`, `ids` and, if asked, `starts` and `ends` (characters) of every whole text, row by row.

    Each match of the pattern is encoded by itself, without special tokens; pieces met before in the task are not encoded
    again. A null text is empty and has no ids. Null ids stay, repeated rows repeat, other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks)
        for whole in batches:
            for batch in blocks(whole):
                many = batch.column(1).to_pylist()
                ids = c.encode_batch(many)
                columns = [batch.column(0), pc.binary_length(batch.column(1)).cast(pa.int64()), _lists(ids)]
                names = ["doc_id", "n_bytes", "ids"]
                if offsets:
                    places = [c.offsets(i, t) for i, t in zip(ids, many)]
                    columns += [_lists([p[0] for p in places]), _lists([p[1] for p in places])]
                    names += ["starts", "ends"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    extra = ", starts array<int>, ends array<int>" if offsets else ""
    return map_batches(texts(docs), run, f"doc_id {kind}, n_bytes bigint, ids array<int>{extra}")


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    values = np.concatenate(arrays) if arrays else np.array([], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.astype(np.int32), pa.int32()))


def decode(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """`doc_id`, the ids' bytes as `decoded` and as `text`.

    Ids may start or end inside a character: bytes that make no character become U+FFFD in `text`, and stay in
    `decoded`. A null list counts as empty; an id the vocabulary lacks is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks)
        for batch in batches:
            raw = [c.decode(np.array(x or [], dtype=np.int64)) for x in batch.column(1).to_pylist()]
            text = [b.decode("utf-8", "replace") for b in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(raw, pa.binary()), pa.array(text, pa.string())],
                names=["doc_id", "decoded", "text"],
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return map_batches(encoded.select("doc_id", "ids"), run, f"doc_id {kind}, decoded binary, text string")


def round_trip(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """Count and digests of every whole text's ids and of the bytes they decode to, in one pass, row by row.

    A null text is empty: no ids, the digests of nothing. Null ids stay, repeated rows repeat.
    """
    return _both_ways(docs, ranks, ids=False)


def encode_and_check(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """As `round_trip`, with the ids themselves."""
    return _both_ways(docs, ranks, ids=True)


def _both_ways(docs: DataFrame, ranks: str, ids: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks)
        for whole in batches:
            for batch in blocks(whole):
                found = c.encode_batch(batch.column(1).to_pylist())
                columns = [
                    batch.column(0),
                    pa.array([len(i) for i in found], pa.int64()),
                    pa.array([hashlib.sha256(i.tobytes()).hexdigest() for i in found], pa.string()),
                    pa.array([hashlib.sha256(c.decode(i)).hexdigest() for i in found], pa.string()),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    columns, names = [*columns, _lists(found)], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_batches(texts(docs), run, schema + (", ids array<int>" if ids else ""))
