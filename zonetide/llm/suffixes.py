"""Suffix-array dedup: bytes covered by a string of 100 bytes that also starts earlier are removed.

The suffixes of a corpus are dealt out so that equal strings meet, and each part is sorted by the difference-cover
algorithm. A string's anchor is the smallest digest of the 24-byte substrings in it, so equal strings have equal anchors. The
starts that share an anchor in a row, about 39, make a unit: the bytes from the first start to the end of the last string.

1. Anchors that stand once in the corpus hold no repeat; their units go.
2. Units of equal content: all but the earliest are repeats as a whole, in a shuffle of digests.
3. Of what is left, only anchors with several different units, or twice in one, need their bytes. Those are fetched, dealt out by anchor, and
   the blocks' suffixes ranked: sampled triples sorted, recursion on their names, the rest merged, neighbours in the order
   compared over 100 bytes. Within equal strings the earliest start stays.

No step keeps a group of unbounded size in a task: an anchor with more than HOT_UNITS different units is not sorted but has its
strings digested and grouped by Spark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonetide.llm.common import blocks, cut, map_batches, release, stored
from zonetide.llm.difference_cover import equal_neighbours, suffix_ranks

LENGTH, GRAM = 100, 24
#: Different units of one anchor that are sorted in one block. At usual sizes 1.2 MB; units of long runs count by their bytes.
HOT_UNITS = 8_000
HOT_BYTES = 1_200_000
#: A block is sorted when its bytes reach this; with the last anchor's it stays below what can be ranked at once.
BLOCK_BYTES = 1 << 19
#: Longer runs of one anchor are cut, so that a unit is small whatever the text.
LONGEST_RUN = 4_096
#: Starts looked at together, so that memory does not follow the longest text.
CHUNK = 1 << 20
#: The greatest number of 64 bits, where rows without an id stand.
LAST = (1 << 63) - 1
_BASE = 0x9E3779B97F4A7C15
_ALL = (1 << 64) - 1


def _gram_digests(raw: np.ndarray, size: int) -> np.ndarray:
    """A digest of every substring of `size` bytes, built from those of powers of two."""
    have, width, power = raw.astype(np.uint64) + np.uint64(1), 1, _BASE
    out = done = None
    while True:
        if size & width:
            if out is None:
                out, done = have, width
            else:
                n = min(len(out) - width, len(have))
                out = have[:n] * np.uint64(pow(_BASE, done, 1 << 64)) + out[width : width + n]
                done += width
        if 2 * width > size:
            break
        have = have[:-width] * np.uint64(power) + have[width:]
        power, width = power * power & _ALL, 2 * width
    out = out ^ (out >> np.uint64(31))
    out = out * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        values, n = np.minimum(values[:-n], values[n:]), 2 * n
    rest = width - n
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def gram_of(length: int) -> int:
    """The size of the substrings whose smallest digest is a string's anchor."""
    return min(GRAM, max(1, length // 2))


def units_of(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Anchor, first start, number of starts, whether the anchor stands twice or more in it, and where in the unit it stands
    first, of each unit.

    Together the units hold every start of a string once. Cuts at CHUNK and LONGEST_RUN only keep units small: they
    may make two units of equal strings differ, and such units are then compared by their bytes.
    """
    gram = gram_of(length)
    width, raw = length - gram + 1, np.frombuffer(text, np.uint8)
    parts = []
    for at in range(0, len(raw) - length + 1, CHUNK):
        grams = _gram_digests(raw[at : at + CHUNK + length - 1], gram)
        least = _sliding_min(grams, width)
        first = np.concatenate([[0], np.nonzero(least[1:] != least[:-1])[0] + 1])
        count = np.diff(np.append(first, len(least)))
        if (count > LONGEST_RUN).any():
            pieces = -(-count // LONGEST_RUN)
            inside = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            end = np.repeat(first + count, pieces)
            first = np.repeat(first, pieces) + inside * LONGEST_RUN
            count = np.minimum(end - first, LONGEST_RUN)
        size = count + width - 1
        begin = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(begin - first, size)
        found = np.nonzero(grams[place] == np.repeat(least[first], size))[0]
        owner = np.searchsorted(begin, found, "right") - 1
        hits = np.bincount(owner, minlength=len(first))
        # Every unit holds its anchor, so the first find of each owner is where the owner changes.
        spot = found[np.concatenate([[True], owner[1:] != owner[:-1]])] - begin
        parts.append((least[first].view(np.int64), first + at, count, hits > 1, spot))
    if not parts:
        none = np.array([], np.int64)
        return none, none, none, np.array([], bool), none
    return tuple(np.concatenate(p) for p in zip(*parts))


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts with a place in the order of documents (null ids last, with the greatest number) and a digest of 63 bits that tells
    rows of one place apart; it is negative where the row has an id.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.xxhash64(text).bitwiseAND(F.lit(LAST))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"),
        F.when(F.col("doc_id").isNull(), digest).otherwise(-digest - 1).alias("tie"),
        text.alias("text"),
    )


def _unit_rows(docs: DataFrame, length: int, anchors_only: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for whole in batches:
            for batch in blocks(whole):
                doc, tie, raw = (batch.column(k) for k in range(3))
                raw = [t.encode() for t in raw.to_pylist()]
                found = [units_of(t, length) for t in raw]
                anchor = pa.array(np.concatenate([f[0] for f in found]))
                twice = pa.array(np.concatenate([f[3] for f in found]))
                if anchors_only:
                    yield pa.RecordBatch.from_arrays([anchor, twice], names=["anchor", "twice"])
                    continue
                owner = np.repeat(np.arange(len(raw)), [len(f[0]) for f in found])
                content = np.fromiter(
                    (
                        digest(t[s : s + n + length - 1])
                        for t, f in zip(raw, found)
                        for s, n in zip(f[1].tolist(), f[2].tolist())
                    ),
                    dtype=np.uint64,
                    count=len(owner),
                ).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        anchor,
                        pa.array(content),
                        doc.take(pa.array(owner)),
                        tie.take(pa.array(owner)),
                        pa.array(np.concatenate([f[1] for f in found]).astype(np.int32)),
                        pa.array(np.concatenate([f[2] for f in found]).astype(np.int32)),
                        pa.array(np.where(np.concatenate([f[3] for f in found]), -1, np.concatenate([f[4] for f in found])).astype(np.int32)),
                    ],
                    names=["anchor", "content", "doc", "tie", "start", "count", "spot"],
                )

    schema = "anchor bigint, twice boolean"
    if not anchors_only:
        schema = "anchor bigint, content bigint, doc bigint, tie bigint, start int, count int, spot int"
    return map_batches(_keyed(docs), run, schema)


def _shared_units(docs: DataFrame, length: int) -> DataFrame:
    """Units whose anchor stands more than once. The anchors' counts are stored first, so that the join reads two plain
    exchanges and a hot anchor is split."""
    counts = _unit_rows(docs, length, anchors_only=True).groupBy("anchor").agg(
        F.sum(F.when(F.col("twice"), 2).otherwise(1)).alias("n")
    )
    repeated = stored(counts.filter("n > 1").select("anchor"), "anchors")
    del counts
    release(docs.sparkSession)
    return stored(_unit_rows(docs, length, anchors_only=False).join(repeated, "anchor", "left_semi"), "units")


_PLACE = ("doc", "tie", "start")


def _same_document_first(doc: str, start: str):
    return F.struct(F.col(doc).alias("doc"), F.col(start).alias("start"))


def _earliest(units: DataFrame) -> DataFrame:
    """The earliest unit of each content."""
    first = units.groupBy("anchor", "content").agg(
        F.min(F.struct("doc", "start", "tie")).alias("first"),
        F.max("count").alias("count"),
        F.min("spot").alias("spot"),
    )
    return stored(first.select("anchor", "content", "first.*", "count", "spot"), "earliest")


def _repeated_units(units: DataFrame, earliest: DataFrame) -> DataFrame:
    first = earliest.select("anchor", "content", F.col("doc").alias("doc_1"), F.col("start").alias("start_1"))
    later = (F.col("doc") > F.col("doc_1")) | ((F.col("doc") == F.col("doc_1")) & (F.col("start") > F.col("start_1")))
    return units.join(first, ["anchor", "content"]).filter(later).select(*_PLACE, "count")


def _unit_bytes(docs: DataFrame, earliest: DataFrame, length: int) -> DataFrame:
    """The bytes of units whose anchor has several; a document's units travel as one list, bounded by its length."""
    sizes = earliest.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("count") + (length - 1)).alias("bytes"),
        F.max(F.col("spot") < 0).alias("twice"),
    )
    several = cut(
        sizes.filter("n > 1 or twice").select(
            "anchor", ((F.col("n") > HOT_UNITS) | (F.col("bytes") > HOT_BYTES)).alias("hot")
        )
    )
    wanted = earliest.join(several, "anchor").groupBy("doc", "tie").agg(
        F.collect_list(F.struct("anchor", "hot", "start", "count", "spot")).alias("units")
    )
    joined = _keyed(docs).dropDuplicates(["doc", "tie"]).join(wanted, ["doc", "tie"]).select("doc", "tie", "text", "units")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole):
                rows = []
                for doc, tie, text, units in zip(*(batch.column(k).to_pylist() for k in range(4))):
                    raw = text.encode()
                    rows += [
                        (u["anchor"], u["hot"], doc, tie, u["start"], u["count"], u["spot"],
                         raw[u["start"] : u["start"] + u["count"] + length - 1])
                        for u in units
                    ]
                columns = list(zip(*rows)) if rows else [[]] * 8
                long, short = pa.int64(), pa.int32()
                kinds = (long, pa.bool_(), long, long, short, short, short, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["anchor", "hot", "doc", "tie", "start", "count", "spot", "bytes"],
                )

    return map_batches(
        joined, run, "anchor bigint, hot boolean, doc bigint, tie bigint, start int, count int, spot int, bytes binary"
    )


def worth_sorting(anchor: np.ndarray, spot: np.ndarray, text: np.ndarray, begin: np.ndarray, size: np.ndarray, length: int) -> np.ndarray:
    """Whether each unit can share a string with another one of its anchor, or with itself.

    A string holds its anchor and, to the left or to the right of it, at least half of its other bytes. So two units with a
    common string agree on the anchor and that much on one side of it. Units that agree with no other one on either side
    need not be sorted. Where the anchor stands twice in a unit (`spot` is negative), all units of that anchor are kept.
    """
    gram = gram_of(length)
    side = (length - gram + 1) // 2
    digests = _gram_digests(text, gram + side) if len(text) >= gram + side else np.array([], np.uint64)
    twice = spot < 0
    keep = np.isin(anchor, anchor[twice]) if twice.any() else np.zeros(len(anchor), dtype=bool)
    sides = (np.where(spot >= side, begin + spot - side, -1), np.where(spot + gram + side <= size, begin + spot, -1))
    for at in sides:
        there = np.nonzero((at >= 0) & ~twice)[0]
        # Anchor and digest mixed: equal pairs give equal keys, and a chance meeting only keeps a unit too many.
        key = digests[at[there]] * np.uint64(_BASE) ^ anchor[there].view(np.uint64)
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        keep[there[order[1:][same]]] = True
        keep[there[order[:-1][same]]] = True
    return keep


class _Block:
    """Units of whole anchors, sorted together."""

    def __init__(self, length: int) -> None:
        self.length, self.parts, self.size = length, [], 0

    def add(self, part: pa.RecordBatch) -> None:
        self.parts.append(part)
        self.size += part.column(6).nbytes

    def repeats(self) -> pa.RecordBatch:
        """Runs of starts whose string also starts earlier, as (doc, tie, start, count)."""
        length = self.length
        whole = pa.Table.from_batches(self.parts).combine_chunks()
        anchor, doc, tie, start, count, spot = (
            whole.column(k).to_numpy().astype(np.int64) for k in range(6)
        )
        size = pc.binary_length(whole.column(6)).to_numpy().astype(np.int64)
        text = np.frombuffer(b"".join(whole.column(6).to_pylist()), np.uint8)
        begin = np.cumsum(size) - size
        kept = np.nonzero(worth_sorting(anchor, spot, text, begin, size, length))[0]
        if not len(kept):
            none = np.array([], np.int64)
            return _runs(none, none, none > 0, doc, tie)
        own = np.concatenate([text[b : b + n] for b, n in zip(begin[kept].tolist(), size[kept].tolist())])
        size, count, first = size[kept], count[kept], start[kept]
        begin = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(kept)), count)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        at, place = begin[owner] + inside, first[owner] + inside
        of = doc[kept][owner]
        rank = suffix_ranks(own.astype(np.int64) + 1, length)
        order = np.argsort(rank[at], kind="stable")
        group = np.cumsum(~equal_neighbours(own, at[order], length))
        # The earliest place of each group of equal strings.
        by_place = np.lexsort((place[order], of[order], group))
        group, order = group[by_place], order[by_place]
        lead = np.concatenate([[True], group[1:] != group[:-1]])
        leader = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]
        later = np.zeros(len(at), dtype=bool)
        later[order] = (of[order] != of[leader]) | (place[order] != place[leader])
        return _runs(owner, place, later, doc[kept], tie[kept])


def _runs(owner: np.ndarray, place: np.ndarray, later: np.ndarray, doc: np.ndarray, tie: np.ndarray) -> pa.RecordBatch:
    hit = np.nonzero(later)[0]
    new = np.ones(len(hit), dtype=bool)
    new[1:] = (np.diff(hit) != 1) | (np.diff(owner[hit]) != 0)
    first = hit[new]
    number = np.diff(np.append(np.nonzero(new)[0], len(hit)))
    own = owner[first]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc[own], pa.int64()),
            pa.array(tie[own], pa.int64()),
            pa.array(place[first].astype(np.int32)),
            pa.array(number.astype(np.int32)),
        ],
        names=["doc", "tie", "start", "count"],
    )


def _sorted_repeats(units: DataFrame, length: int) -> DataFrame:
    """Repeats among the units of one anchor, by suffix arrays of blocks that hold whole anchors."""
    dealt = units.drop("hot").repartition("anchor").sortWithinPartitions("anchor")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, last = _Block(length), None
        for batch in batches:
            anchor = batch.column(0).to_numpy()
            if not len(anchor):
                continue
            ends = np.append(np.nonzero(anchor[1:] != anchor[:-1])[0] + 1, len(anchor))
            sizes = np.cumsum(pc.binary_length(batch.column(6)).to_numpy(zero_copy_only=False))
            done = 0
            # A block ends where an anchor does, once it holds enough.
            if block.size >= BLOCK_BYTES and anchor[0] != last:
                yield block.repeats()
                block = _Block(length)
            for end in ends[:-1].tolist():
                held = int(sizes[end - 1] - (sizes[done - 1] if done else 0))
                if block.size + held >= BLOCK_BYTES:
                    block.add(batch.slice(done, end - done))
                    yield block.repeats()
                    block, done = _Block(length), end
            block.add(batch.slice(done))
            last = anchor[-1]
        if block.parts:
            yield block.repeats()

    return map_batches(dealt, run, "doc bigint, tie bigint, start int, count int")


def _digested_repeats(units: DataFrame, length: int) -> DataFrame:
    """Repeats among the units of anchors with very many: every string's digest, grouped and joined by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, tie, start, count, raw in zip(*(batch.column(k).to_pylist() for k in range(5))):
                keys = [xxhash.xxh3_128_digest(raw[k : k + length]) for k in range(count)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.binary()),
                        pa.array([doc] * count, pa.int64()),
                        pa.array([tie] * count, pa.int64()),
                        pa.array(np.arange(start, start + count, dtype=np.int32)),
                    ],
                    names=["key", "doc", "tie", "start"],
                )

    strings = map_batches(
        units.select("doc", "tie", "start", "count", "bytes"), run, "key binary, doc bigint, tie bigint, start int"
    )
    first = strings.groupBy("key").agg(
        F.min(_same_document_first("doc", "start")).alias("first"), F.count(F.lit(1)).alias("n")
    )
    first = stored(first.filter("n > 1").select("key", "first"), "strings")
    later = strings.join(first, "key").filter(_same_document_first("doc", "start") > F.col("first"))
    return later.select(*_PLACE, F.lit(1).alias("count"))


def repeated_runs(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Runs of starts (`doc`, `tie`, `start`, `count`) of strings that also start earlier."""
    spark = docs.sparkSession
    units = _shared_units(docs, length)
    release(spark)
    earliest = _earliest(units)
    release(spark)
    repeats = stored(_repeated_units(units, earliest), "repeated-units")
    release(spark)
    fetched = stored(_unit_bytes(docs, earliest, length), "unit-bytes")
    release(spark)
    found = repeats.unionByName(_sorted_repeats(fetched.filter("not hot"), length))
    hot = fetched.filter("hot")
    if not hot.isEmpty():
        found = found.unionByName(_digested_repeats(hot, length))
    return found


def remove_repeats(docs: DataFrame, length: int = LENGTH, kept: bool = False) -> DataFrame:
    """`doc_id`, `n_bytes`, `n_removed`, `n_spans` and `kept_sha256` of every whole text, one result row per row; with
    `kept` also the remaining bytes as `kept`.

    A byte is removed if a string of `length` bytes covers it that also starts earlier: in a document with a smaller id, or
    before in the same one. Strings are judged on the input. Null ids come last. Rows that share an id and a text are one
    document, each with the same result; rows that share an id only are judged as one document's strings, each by
    its own text. A null or shorter text keeps everything, an empty table gives an empty one, other columns are not read.
    """
    runs = repeated_runs(docs, length).groupBy("doc", "tie").agg(
        F.collect_list(F.struct("start", "count")).alias("runs")
    )
    runs = stored(runs, "runs")
    release(docs.sparkSession)
    numbered = _keyed(docs).withColumn("doc_id", F.when((F.col("doc") < LAST) | (F.col("tie") < 0), F.col("doc")))
    joined = numbered.join(runs, ["doc", "tie"], "left").select("doc_id", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole):
                rows = [
                    _without(text.encode(), found, length)
                    for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
                ]
                columns = [
                    batch.column(0),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.int64()),
                    pa.array([hashlib.sha256(r[3]).hexdigest() for r in rows], pa.string()),
                ]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if kept:
                    columns, names = [*columns, pa.array([r[3] for r in rows], pa.binary())], [*names, "kept"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return map_batches(joined, run, schema + (", kept binary" if kept else ""))


def _without(raw: bytes, runs: list | None, length: int) -> tuple[int, int, int, bytes]:
    if not runs:
        return len(raw), 0, 0, raw
    start = np.array([r["start"] for r in runs], dtype=np.int64)
    stop = start + np.array([r["count"] for r in runs], dtype=np.int64) - 1 + length
    edge = np.zeros(len(raw) + 1, dtype=np.int32)
    np.add.at(edge, start, 1)
    np.add.at(edge, stop, -1)
    gone = np.cumsum(edge[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return len(raw), int(gone.sum()), spans, np.frombuffer(raw, np.uint8)[~gone].tobytes()
