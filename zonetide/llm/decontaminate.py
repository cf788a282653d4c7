"""Benchmark decontamination by templates: numbers, names and units become typed placeholders, windows are hash-joined,
and the values in the slots must fit together, so a question asked again with other values is found.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonetide.llm.common import blocks, map_batches, texts

WORDS = 5
#: Share of an item's windows that a document must hold, and of its slots that must fit.
LEAST, CONSISTENT = 0.8, 0.85
#: Items in one broadcast block, in characters: about 40 bytes of index a character, 80 MB at most.
BLOCK_CHARS = 2_000_000
#: Words whose template a task remembers; when full, it starts afresh.
REMEMBERED = 150_000

#: Units that follow a number, as words or joined to it.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t lb lbs oz ml l liter liters litre litres "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years mph kmh "
    "percent dollar dollars cent cents euro euros pound pounds degree degrees".split()
)
#: Numbers as words; tens and ones may be joined by a hyphen.
_ONES = "one two three four five six seven eight nine".split()
_TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
NUMBER_WORDS = frozenset(
    ["zero", *_ONES, *_TENS, *(f"{t}-{o}" for t in _TENS for o in _ONES)]
    + "ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
    + "dozen hundred thousand million billion".split()
)
_NUMBER = re.compile(r"[$€£]?[+-]?\d[\d.,:/]*(%|[A-Za-z]{1,7})?")
_NAME = re.compile(r"[^\W\d_][\w'’-]*")
_EDGES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "«»“”„‘’¿¡…–—"
_BEFORE, _AFTER = _EDGES.translate(str.maketrans("", "", "$+-")), _EDGES.replace("%", "")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text)


NUMBER, NAME, UNIT = (np.uint64(_digest(f"\0{kind}")) for kind in ("number", "name", "unit"))
SLOTS = frozenset(map(int, (NUMBER, NAME, UNIT)))
#: Stands for the end of a line.
BREAK = "\0"
#: Characters of scripts that put no spaces between words: each counts as a word. Thai to Khmer, Han, kana, and what goes with them.
_UNSPACED = re.compile("[\u0e01-\u0e4e\u0e81-\u0eff\u1000-\u109f\u1780-\u17d3\u2e80-\u2fdf\u3005-\u3007\u3041-\u30ff\u31f0-\u31ff"
                       "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")  # fmt: skip
#: Items of fewer words than this count only where they are a sentence or a line of their own.
ALONE = 3


def _template(raw: str) -> tuple[int, int, int, bool, bool]:
    """Of a word: its token as the first of a sentence, its token elsewhere, the digest of its value, whether a sentence
    ends with it, and whether it counts at all.
    """
    if raw.isalpha() and raw.islower() and raw not in UNITS and raw not in NUMBER_WORDS:
        value = _digest(raw)
        return value, value, value, False, True
    word = raw.lstrip(_BEFORE).rstrip(_AFTER)
    ends = raw == BREAK or raw.rstrip("\"')”»")[-1:] in (".", "!", "?", ":")
    if not word or raw == BREAK:
        return 0, 0, 0, ends, False
    low = word.lower()
    value = _digest(low)
    if low in NUMBER_WORDS or not word.isalpha() and _NUMBER.fullmatch(word):
        return NUMBER, NUMBER, value, ends, True
    if low in UNITS:
        return UNIT, UNIT, value, ends, True
    if word[0].isupper() and (word.isalpha() or _NAME.fullmatch(word)):
        return value, NAME, value, ends, True
    return value, value, value, ends, True


class Templates:
    """Texts to tokens and slot values, as arrays. Each distinct word is looked at once."""

    def __init__(self) -> None:
        self.place: dict[str, int] = {}
        self._room(REMEMBERED)

    def _room(self, n: int) -> None:
        self.place.clear()
        self.first, self.elsewhere, self.value = (np.zeros(n, dtype=np.uint64) for _ in range(3))
        self.ends, self.counts = (np.zeros(n, dtype=bool) for _ in range(2))

    def _learn(self, words: list[str]) -> np.ndarray:
        new = set(words).difference(self.place)
        if len(self.place) + len(new) > len(self.first):
            new = set(words)
            self._room(max(REMEMBERED, len(new)))
        if new:
            k = len(self.place)
            self.place.update(zip(new, range(k, k + len(new))))
            found = zip(*map(_template, new))
            for table, column in zip((self.first, self.elsewhere, self.value, self.ends, self.counts), found):
                table[k : k + len(new)] = column
        return np.fromiter(map(self.place.__getitem__, words), dtype=np.int64, count=len(words))

    def read(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, values, which words may also be a name (a capital that begins a sentence does not tell), and which begin
        a sentence. A unit only counts as one after a number, and a line begins a sentence.
        """
        if not text.isascii():
            text = _UNSPACED.sub(r" \g<0> ", text)
        at = self._learn(text.replace("\n", f" {BREAK} ").split())
        at = at[self.ends[at] | self.counts[at]]
        begins = np.concatenate([[True], self.ends[at[:-1]]]) if len(at) else np.array([], dtype=bool)
        tokens = np.where(begins, self.first[at], self.elsewhere[at])
        counts = self.counts[at]
        unsure = (begins & (self.elsewhere[at] == NAME))[counts]
        tokens, values = tokens[counts], self.value[at][counts]
        after = np.concatenate([[0], tokens[:-1]]).astype(np.uint64) if len(tokens) else tokens
        return np.where((tokens == UNIT) & (after != NUMBER), values, tokens), values, unsure, begins[counts]


def windows(tokens: np.ndarray, unsure: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """A digest of every window and its place, first as the tokens are, then in each further reading of its unsure words
    as names.
    """
    n = len(tokens) - words + 1
    if n < 1:
        return np.array([], dtype=np.uint64), np.array([], dtype=np.int64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(words):
        out = out * _FACTOR + tokens[k : k + n]
    digests, places = [out], [np.arange(n)]
    at = np.nonzero(unsure)[0]
    if len(at):
        power = np.array([pow(int(_FACTOR), words - 1 - j, 1 << 64) for j in range(words)], dtype=np.uint64)
        change = NAME - tokens[at]
        # The digest is linear in the tokens. One word read as a name first, then a later one of the same window besides.
        inside = np.arange(words)
        place = (at[:, None] - inside).ravel()
        which, inside = np.repeat(np.arange(len(at)), words), np.tile(inside, len(at))
        fits = (place >= 0) & (place < n)
        place, which, inside = place[fits], which[fits], inside[fits]
        read = out[place] + change[which] * power[inside]
        while len(place):
            digests.append(read)
            places.append(place)
            more = []
            if not (at[1:] - at[:-1] < words).any():
                break
            for ahead in range(1, words):
                later = np.minimum(which + ahead, len(at) - 1)
                fits = (which + ahead < len(at)) & (at[later] < place + words)
                if not fits.any():
                    break
                p, w = place[fits], later[fits]
                more.append((p, w, read[fits] + change[w] * power[at[w] - p]))
            place, which, read = (np.concatenate(x) for x in zip(*more)) if more else ([], [], [])
    out = np.concatenate(digests)
    return out ^ (out >> np.uint64(29)), np.concatenate(places)


@dataclass
class Item:
    item_id: object
    tokens: np.ndarray
    values: np.ndarray
    unsure: np.ndarray
    #: Digest of each distinct window and the places where the item has it.
    places: dict[int, list[int]]
    #: Digest of each reading of a window and the windows that may be read so.
    readings: dict[int, list[int]]


class Index:
    """Items of one block: sorted window digests for the search, and each window's items."""

    def __init__(self, items: list[tuple[object, str]], words: int) -> None:
        read, self.words = Templates(), words
        self.items: list[Item] = []
        self.of: dict[int, list[int]] = defaultdict(list)
        #: Of items too short for a window, by their number of words: the digest of their values, and what has it.
        self.short: dict[int, dict[int, list[tuple[object, list[int]]]]] = defaultdict(lambda: defaultdict(list))
        for item_id, text in items:
            tokens, values, unsure, _ = read.read(text)
            if 0 < len(tokens) < words:
                whole = int(windows(values, np.zeros(len(values), dtype=bool), len(values))[0][0])
                self.short[len(values)][whole].append((item_id, values.tolist()))
            places: dict[int, list[int]] = defaultdict(list)
            readings: dict[int, set[int]] = defaultdict(set)
            digests, at = (x.tolist() for x in windows(tokens, unsure, words))
            for place, digest in enumerate(digests[: max(0, len(tokens) - words + 1)]):
                places[digest].append(place)
            for place, digest in zip(at, digests):
                readings[digest].add(digests[place])
            if places:
                for digest in readings:
                    self.of[digest].append(len(self.items))
                some = {digest: sorted(own) for digest, own in readings.items()}
                self.items.append(Item(item_id, tokens, values, unsure, dict(places), some))
        self.sorted = np.sort(np.fromiter(self.of, dtype=np.uint64, count=len(self.of)))
        # A bit for each value of the low 20 bits lets most of a text's windows pass by without a search.
        self.low = np.zeros(1 << 20, dtype=bool)
        self.low[(self.sorted & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def hits(self, digests: np.ndarray) -> np.ndarray:
        """Places of the windows that some item has."""
        if not len(self.sorted) or not len(digests):
            return np.array([], dtype=np.int64)
        maybe = np.nonzero(self.low[(digests & np.uint64((1 << 20) - 1)).astype(np.int64)])[0]
        found = np.minimum(np.searchsorted(self.sorted, digests[maybe]), len(self.sorted) - 1)
        return maybe[self.sorted[found] == digests[maybe]]

    def find(self, text: str, templates: Templates) -> list[tuple[object, int, int, float, str]]:
        """(item, windows, windows held, slot consistency, kind) of the items that the text holds."""
        tokens, values, unsure, begins = templates.read(text)
        short = self._verbatim(values, begins)
        digests, places = windows(tokens, unsure, self.words)
        hits = self.hits(digests)
        if not len(hits):
            return short
        where: dict[int, dict[int, dict[int, None]]] = defaultdict(dict)
        for at, digest in sorted(zip(places[hits].tolist(), digests[hits].tolist())):
            for number in self.of[digest]:
                for own in self.items[number].readings[digest]:
                    where[number].setdefault(own, {})[at] = None
        out = []
        for number, held in where.items():
            item = self.items[number]
            if len(held) < LEAST * len(item.places):
                continue
            consistency, same = _slots(item, held, tokens, values, self.words)
            if max(consistency, same) >= CONSISTENT:
                kind = "same" if same >= CONSISTENT else "reparameterised"
                out.append((item.item_id, len(item.places), len(held), consistency, kind))
        return short + out

    def _verbatim(self, values: np.ndarray, begins: np.ndarray) -> list[tuple[object, int, int, float, str]]:
        """Items of fewer words than a window that the text has word for word, values included."""
        out = []
        for n, own in self.short.items():
            digests = windows(values, np.zeros(len(values), dtype=bool), n)[0]
            known = np.fromiter(own, dtype=np.uint64, count=len(own))
            seen = set()
            for at in np.nonzero(np.isin(digests, known))[0].tolist():
                alone = begins[at] and (at + n == len(values) or begins[at + n])
                for item_id, words in own[int(digests[at])]:
                    if (n >= ALONE or alone) and item_id not in seen and values[at : at + n].tolist() == words:
                        seen.add(item_id)
                        out.append((item_id, 1, 1, 1.0, "same"))
        return out


def _slots(item: Item, held: dict[int, dict[int, None]], tokens, values, words: int) -> tuple[float, float]:
    """Two shares: of the slots whose value the item has more than once, those that map as most occurrences of the value
    do; and of all slots, those that hold the item's own value.

    Where a window stands more than once, the occurrence counts that lies on the shift most windows share. A capitalised
    word that begins a sentence is a slot where its value does not stay the same throughout.
    """
    shifts = Counter(at - k for digest, ats in held.items() for k in item.places[digest] for at in ats)
    slot_of: dict[int, int] = {}
    for digest, ats in held.items():
        for k in item.places[digest]:
            best = max(ats, key=lambda at: (shifts[at - k], -at))
            for j in range(words):
                if int(item.tokens[k + j]) in SLOTS or item.unsure[k + j]:
                    slot_of.setdefault(k + j, int(values[best + j]))
    changed = {int(item.values[place]) for place, value in slot_of.items() if int(item.values[place]) != value}
    slot_of = {p: v for p, v in slot_of.items() if not item.unsure[p] or int(item.values[p]) in changed}
    if not slot_of:
        return 1.0, 1.0
    maps: dict[tuple[int, int], Counter] = defaultdict(Counter)
    for place, value in slot_of.items():
        token = int(NAME if item.unsure[place] else item.tokens[place])
        maps[token, int(item.values[place])][value] += 1
    repeated = [c for c in maps.values() if sum(c.values()) > 1]
    total = sum(sum(c.values()) for c in repeated)
    agreeing = sum(max(c.values()) for c in repeated)
    own = sum(int(item.values[place]) == value for place, value in slot_of.items())
    return round(agreeing / total, 6) if total else 1.0, own / len(slot_of)


def _blocks_of(spark: SparkSession, items: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """The benchmark in blocks that may be broadcast: their size is measured first, and more items make more blocks."""
    one = (
        items.select(F.col("item_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
        .groupBy("text").agg(F.min("item_id").alias("item_id"))
    )
    chars, longest = one.agg(F.sum(F.char_length("text")), F.max(F.char_length("text"))).first()
    count = -(-(chars or 0) // BLOCK_CHARS)
    for k in range(count):
        part = F.pmod(F.xxhash64("text"), F.lit(count)) == k
        yield [(r.item_id, r.text) for r in one.filter(part).toLocalIterator()]


def find_contamination(docs: DataFrame, items: DataFrame, words: int = WORDS) -> DataFrame:
    """One row per document and benchmark item that it holds: `doc_id`, `item_id`, `n_windows` (distinct windows of the
    item's template), `n_held` (those the document has), `consistency` and `kind` (`same`, or `reparameterised` when
    slots hold other values).

    A document holds an item when it has at least 80 % of its five-word template windows and the slots fit: at least 85 %
    hold the item's own values, or, of those whose value the item repeats, map it to one value each time. A capitalised word
    that begins a sentence is read both as a name and as itself, on either side. Items with equal texts count once, under their smallest id. In scripts
    without spaces every character is a word. Items with fewer than five words are found where they stand word for word, those of one or
    two as a sentence or line of their own; items without a word never; null texts are empty. Null ids stay, repeated
    documents repeat, an empty table on either side gives an empty result, other columns are not read.

    The benchmark is a stated query set: it is taken in blocks of a measured size, each broadcast and joined to all
    documents by window digest inside the tasks, so documents are never shuffled.
    """
    spark = docs.sparkSession
    read = texts(docs)
    kinds = {"doc_id": docs.schema["doc_id"].dataType, "item_id": items.schema["item_id"].dataType}
    schema = ", ".join(f"{c} {t.simpleString()}" for c, t in kinds.items())
    schema += ", n_windows bigint, n_held bigint, consistency double, kind string"
    out = spark.createDataFrame([], schema)
    for block in _blocks_of(spark, items):
        out = out.unionByName(map_batches(read, _search(spark.sparkContext.broadcast(block), words, kinds), schema))
    return out


def _search(block, words: int, kinds: dict):
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = {c: to_arrow_type(t) for c, t in kinds.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, templates = Index(block.value, words), Templates()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = [
                (doc_id, *found) for doc_id, text in zip(ids, batch.column(1)) for found in index.find(text.as_py(), templates)
            ]
            columns = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], arrow["doc_id"]),
                    pa.array(columns[1], arrow["item_id"]),
                    pa.array(columns[2], pa.int64()),
                    pa.array(columns[3], pa.int64()),
                    pa.array(columns[4], pa.float64()),
                    pa.array(columns[5], pa.string()),
                ],
                names=["doc_id", "item_id", "n_windows", "n_held", "consistency", "kind"],
            )

    return run


def keep_clean(docs: DataFrame, items: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows whose text holds no benchmark item, with their own columns; each block of items is one more pass."""
    spark, out = docs.sparkSession, docs
    place = docs.columns.index("text")

    def keep(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index, templates = Index(block.value, words), Templates()
            for batch in batches:
                clean = [not index.find(t.as_py() or "", templates) for t in batch.column(place)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return run

    for items_ in _blocks_of(spark, items):
        out = map_batches(out, keep(spark.sparkContext.broadcast(items_)), docs.schema)
    return out
