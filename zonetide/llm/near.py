"""SimHash near-duplicates of a pipeline: candidates by BK-trees over shards, each link confirmed by exact Jaccard similarity.

At a similarity of 0.8 two SimHashes differ in some 15 % of their bits, too many for pieces that must agree by the pigeonhole. So the
fingerprint is as long as the corpus asks for: it is cut into pieces so short that a pair agrees in at least one with a stated
probability, and so many that a shard, named by a piece and its bits, stays small. Within a shard a BK-tree over the first
128 bits finds each text's nearest earlier one. Where it finds any, all pairs of the shard within the radius are candidates; in a
shard of very many first the nearest alone, then every pair whose texts the confirmed links have not joined is compared where the
shard lies, and only links that join two groups leave it, fewer than it has texts. Every link is confirmed on the texts' whole
shingle sets, so no text is lost to a chance of the digests, and components of the confirmed links are the groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonetide.llm.common import blocks, cut, map_batches, release, spare, stored, texts
from zonetide.llm.components import components

#: Words of a shingle, and the least Jaccard similarity of the shingle sets of a group's neighbours.
WORDS, LEAST = 5, 0.8
#: Bits that the trees compare, and how many may differ: at the least similarity 19 do on average, give or take 4.
KEY_BITS, RADIUS = 128, 32
#: Texts that a shard should hold on average, in one block, and the share of pairs at the least similarity that meet nowhere.
SHARD, BLOCK, MISSED = 32, 2_048, 0.02
#: Bytes of shingle sets that a block should hold at most, where sets are compared within a shard.
BLOCK_BYTES = 1 << 24
#: The name of a pair of blocks; pairs a text that a unit gives at once; rows of a block that are compared at once.
UNIT, MANY, STRIP = ("piece", "bits", "a", "b"), 4, 128
_FACTOR = 0x9E3779B97F4A7C15


def pieces_for(n: int) -> tuple[int, int]:
    """Bits of a piece, and the number of pieces, for `n` texts."""
    bits = max(8, math.ceil(math.log2(max(n, 1) / SHARD))) if n > SHARD else 8
    overlap = 2 * LEAST / (1 + LEAST)
    agree = (1 - math.acos(overlap) / math.pi) ** bits
    return bits, math.ceil(math.log(MISSED) / math.log(1 - agree))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted digests of the different shingles: `words` words in a row, or the whole text if it has fewer; none of no word.

    Words are runs without ASCII white space, A-Z lower-cased.
    """
    parts = text.encode().lower().split()
    if not parts:
        return np.array([], np.uint64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    n = max(1, len(own) - words + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(min(words, len(own))):
        out = out * np.uint64(_FACTOR) + own[k : k + n]
    out ^= out >> np.uint64(29)
    return np.unique(out * np.uint64(0xBF58476D1CE4E5B9))


def fingerprint(digests: np.ndarray, bits: int) -> np.ndarray:
    """The majority of every bit over the digests, 64 bits at a time; nought for none."""
    out = []
    for k in range(-(-bits // 64)):
        x = digests ^ np.uint64(_FACTOR * (2 * k + 1) & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        ones = np.unpackbits(x.astype("<u8").view(np.uint8).reshape(len(x), 8), axis=1).sum(axis=0, dtype=np.int64)
        out.append(2 * ones > len(digests))
    return np.concatenate(out)


class Tree:
    """BK-tree of numbers with names: a child hangs below its parent at the key that is their distance."""

    def __init__(self) -> None:
        self.root: list | None = None

    def add(self, value: int, name: int) -> None:
        if self.root is None:
            self.root = [value, {}, name]
            return
        node = self.root
        while below := node[1].get(d := (node[0] ^ value).bit_count()):
            node = below
        node[1][d] = [value, {}, name]

    def nearest(self, value: int, radius: int) -> int | None:
        """The name of a nearest value within the radius. Only edges that may lead to a nearer one are followed."""
        best, found, open_ = radius + 1, None, [self.root] if self.root else []
        while open_ and best:
            node = open_.pop()
            d = (node[0] ^ value).bit_count()
            if d < best:
                best, found = d, node[2]
            for edge, child in node[1].items():
                if d - best < edge < d + best:
                    open_.append(child)
        return found


def _prints(marked: DataFrame, marks: list[str], bits: int, pieces: int) -> DataFrame:
    """Per row its id, marks, the digest of its words, the key of the trees and the bits of each piece."""
    read = marked.select("doc_id", "text", *marks)
    schema = "doc_id " + read.schema["doc_id"].dataType.simpleString()
    schema += ", mark_1 bigint, mark_2 bigint, words_1 bigint, words_2 bigint, key binary, pieces array<int>"
    weights = 1 << np.arange(bits, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole):
                digests, keys, named = [], [], []
                for text in batch.column(1).to_pylist():
                    text = text or ""
                    print_ = fingerprint(shingles(text), max(KEY_BITS, bits * pieces))
                    digests.append(xxhash.xxh3_128_digest(b" ".join(text.encode().lower().split())))
                    keys.append(np.packbits(print_[:KEY_BITS]).tobytes())
                    named.append(print_[: bits * pieces].reshape(pieces, bits) @ weights)
                halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                flat = np.concatenate(named).astype(np.int32) if named else np.array([], np.int32)
                edges = np.arange(0, len(flat) + 1, pieces, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), batch.column(2), batch.column(3), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                        pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(edges), pa.array(flat)),
                    ],
                    names=["doc_id", "mark_1", "mark_2", "words_1", "words_2", "key", "pieces"],
                )

    return map_batches(read, run, schema)


def _members(one: DataFrame, *others: str) -> DataFrame:
    """A row per text and shard."""
    return one.select("tid", "key", *others, F.posexplode("pieces").alias("piece", "bits"))


def _cuts(member: DataFrame, held: Column | None = None) -> DataFrame:
    """The shards beyond a block of rows, or of `held` bytes, and into how many blocks they are cut."""
    held = F.lit(0) if held is None else held
    sizes = member.groupBy("piece", "bits").agg(F.count(F.lit(1)).alias("size"), F.sum(held).alias("held"))
    cuts = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("held") / BLOCK_BYTES)).cast("int")
    return cut(sizes.select("piece", "bits", cuts.alias("cuts")).filter("cuts > 1"))


def _dealt(member: DataFrame, cuts: DataFrame, *others: str) -> DataFrame:
    """The texts' rows by shard and unit, a unit's rows together and in order.

    A shard beyond a block is cut by a hash, and every pair of its blocks is a unit, so a hot shard is many tasks' work.
    """
    marked = member.join(cuts, ["piece", "bits"], "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    dealt = marked.withColumn("own", F.pmod(F.xxhash64("tid", F.lit(7)), F.col("cuts")).cast("int")).select(
        "tid", "key", *others, "piece", "bits", "own", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("other")
    )
    return dealt.select(
        "piece", "bits", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "tid", "key", *others
    )


def _sorted(dealt: DataFrame) -> DataFrame:
    return dealt.repartition(*UNIT).sortWithinPartitions(*UNIT, "own", "tid")


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[list], list[list]]]:
    """A unit's name and the rows of its two blocks, of which the second is empty where a block meets itself."""
    last, left, right = None, [], []
    for batch in batches:
        for piece, bits, a, b, own, *row in zip(*[c.to_pylist() for c in batch.columns]):
            of = (piece, bits, a, b)
            if of != last:
                if last is not None:
                    yield last, left, right
                last, left, right = of, [], []
            (left if own == a else right).append(row)
    if last is not None:
        yield last, left, right


def _within(left: list[list], right: list[list]) -> Iterator[tuple[int, np.ndarray]]:
    """Which pairs of a unit are within the radius: a first row of the one block and a matrix of some rows from there on."""
    one, two = (np.frombuffer(b"".join(r[1] for r in side), "<u8").reshape(-1, KEY_BITS // 64) for side in (left, right or left))
    for k in range(0, len(left), STRIP):
        near = np.zeros((len(one[k : k + STRIP]), len(two)), dtype=np.int64)
        for word in range(KEY_BITS // 64):
            near += np.bitwise_count(one[k : k + STRIP, None, word] ^ two[None, :, word])
        near = near <= RADIUS
        yield k, near if right else np.tril(near, k - 1)


def _column(side: list[list], k: int) -> np.ndarray:
    return np.array([r[k] for r in side], dtype=np.int64)


def _candidates(one: DataFrame) -> DataFrame:
    """Pairs (`u`, `v`) of different texts that meet in some shard within the radius, nearest ones by the unit's tree.

    A unit of few pairs gives all of them. One of very many, as a large group of near copies has, gives each text's
    nearest and its own name without a pair: `_joined` gives what its links have not joined. Of two blocks a text asks
    one earlier block by a hash, and the unit gives its name if it has any pair, so that a shard's pairs do not grow with its blocks.
    """

    def search(of: tuple, left: list, right: list) -> tuple[np.ndarray, bool]:
        tree, out = Tree(), []
        for name, key in left:
            if of[2] == of[3] and (other := tree.nearest(int.from_bytes(key), RADIUS)) is not None:
                out.append((min(other, name), max(other, name)))
            tree.add(int.from_bytes(key), name)
        for name, key in right:
            asks = (name * _FACTOR >> 32 & (1 << 32) - 1) % of[3] == of[2]
            if asks and (other := tree.nearest(int.from_bytes(key), RADIUS)) is not None:
                out.append((min(other, name), max(other, name)))
        nearest = np.array(out, dtype=np.int64).reshape(-1, 2)
        if right:
            return nearest, any(near.any() for _, near in _within(left, right))
        if not out:
            return nearest, False
        every, n = [], 0
        ids = _column(left, 0)
        for k, near in _within(left, right):
            x, y = np.nonzero(near)
            n += len(x)
            if n > MANY * len(left):
                return nearest, True
            every.append(np.sort(np.stack([ids[k + x], ids[y]], axis=1), axis=1))
        return np.concatenate(every), False

    def batch_of(rows: list) -> pa.RecordBatch:
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64() if k < 2 else pa.int32()) for k, c in enumerate(columns)], names=["u", "v", *UNIT]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for of, left, right in _units(batches):
            if len(left) + len(right) < 2 or not left or (of[2] != of[3] and not right):
                continue
            pairs, more = search(of, left, right)
            # The unit's name stands beside no pair, so that pairs of several units are one row.
            rows += [(*pair, None, None, None, None) for pair in pairs.tolist()] + ([(None, None, *of)] if more else [])
            if len(rows) > BLOCK:
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)

    schema = "u bigint, v bigint, " + ", ".join(f"{c} int" for c in UNIT)
    member = _members(one)
    return map_batches(_sorted(_dealt(member, _cuts(member))), run, schema).distinct()


def _apart(rooted: DataFrame, units: DataFrame) -> DataFrame:
    """The texts of these units that have one of another root within the radius, by shard."""
    member = _members(rooted, "root")
    dealt = _dealt(member, _cuts(member), "root").join(units, list(UNIT), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for of, left, right in _units(batches):
            if not left or (of[2] != of[3] and not right):
                continue
            (ids, roots), (others, below) = ((_column(side, 0), _column(side, 2)) for side in (left, right or left))
            one, two = np.zeros(len(ids), bool), np.zeros(len(others), bool)
            for k, near in _within(left, right):
                near &= roots[k : k + STRIP, None] != below[None, :]
                one[k : k + STRIP] |= near.any(axis=1)
                two |= near.any(axis=0)
            found = np.unique(np.concatenate([ids[one], others[two]]))
            shard = [pa.array(np.full(len(found), c, np.int32)) for c in of[:2]]
            yield pa.RecordBatch.from_arrays([*shard, pa.array(found)], names=["piece", "bits", "tid"])

    return map_batches(_sorted(dealt), run, "piece int, bits int, tid bigint").distinct()


def _joining(left: list[list], right: list[list], least: float) -> list[tuple[int, int]]:
    """Of a unit's pairs within the radius whose sets have at least the similarity, those that join two roots not joined yet.

    Every such pair is compared unless links before it have joined its texts, so the links given join what all would; they
    are fewer than the unit's rows.
    """
    rows, begin = left + right, len(left) if right else 0
    ids, sets = _column(rows, 0), [np.frombuffer(r[3], "<u8") for r in rows]
    sizes = np.array([len(s) for s in sets])
    names, at = np.unique(np.concatenate(sets), return_inverse=True)
    sets = np.split(at.astype(np.int32), np.cumsum(sizes)[:-1])
    label = np.unique(_column(rows, 2), return_inverse=True)[1]
    own, out = np.zeros(len(names), bool), []
    for k, near in _within(left, right):
        for x, of in enumerate(near, k):
            y = begin + np.flatnonzero(of)
            # Sets of sizes too unlike cannot be alike.
            y = y[(sizes[y] > 0) & (sizes[y] >= least * sizes[x]) & (sizes[x] >= least * sizes[y])]
            own[sets[x]] = True
            while len(y := y[label[y] != label[x]]):
                some, y = y[:STRIP], y[STRIP:]
                edges = np.cumsum(sizes[some]) - sizes[some]
                common = np.add.reduceat(own[np.concatenate([sets[j] for j in some])], edges, dtype=np.int64)
                alike = some[common >= least * (sizes[x] + sizes[some] - common)]
                if len(alike):
                    labels, first = np.unique(label[alike], return_index=True)
                    out += [(int(ids[x]), int(ids[j])) for j in alike[first]]
                    label[np.isin(label, labels)] = label[x]
            own[sets[x]] = False
    return out


def _joined(asked: DataFrame, rooted: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links (`u`, `v`) that join the roots of the asked texts as all confirmed pairs of a shard within the radius would."""
    cuts = _cuts(asked.join(sets.select("tid", F.octet_length("digests").alias("held")), "tid"), F.col("held"))
    member = asked.join(rooted.select("tid", "key", "root"), "tid").join(sets, "tid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for of, left, right in _units(batches):
            if left and (of[2] == of[3] or right) and (links := _joining(left, right, least)):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=["u", "v"])

    return map_batches(_sorted(_dealt(member, cuts, "root", "digests")), run, "u bigint, v bigint")


def _confirmed(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs whose shingle sets have at least the similarity, by the sets as a whole."""
    left = sets.select(F.col("tid").alias("u"), F.col("digests").alias("one"))
    right = sets.select(F.col("tid").alias("v"), F.col("digests").alias("two"))
    both = pairs.join(left, "u").join(right, "v").select("u", "v", "one", "two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                one, two = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                common = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(common >= least * (len(one) + len(two) - common))
            out = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([out.column(0), out.column(1)], names=["u", "v"])

    return map_batches(both, run, "u bigint, v bigint")


def keep_first(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of which each group of near-duplicates keeps one: that with the smallest id.

    Texts of the same words, whatever their case and white space, are one group; so are texts that links of a shingle
    similarity of at least `least` join. Texts without a word, null ones too, are of the same words. Of rows that share the smallest
    id, or if all ids of a group are null, a digest of 128 bits of id and text decides; rows equal in both are one row. Columns,
    their order and values stay, and an empty table stays empty.
    """
    spark = docs.sparkSession
    marks = [spare(docs, "row_mark_1"), spare(docs, "row_mark_2")]
    marked = docs.withColumns(
        {marks[0]: F.xxhash64("doc_id", "text"), marks[1]: F.xxhash64(F.lit(1), "text", "doc_id")}
    )
    bits, pieces = pieces_for(docs.count())
    rows = stored(_prints(marked, marks, bits, pieces), "near-prints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark_1", "mark_2")
    same = rows.groupBy("words_1", "words_2").agg(
        F.min(order).alias("first"), F.any_value("key").alias("key"), F.any_value("pieces").alias("pieces")
    )
    one = cut(same.select("first", "key", "pieces").withColumn("tid", F.monotonically_increasing_id()))
    release(spark)
    found = cut(_candidates(one))
    release(spark)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole):
                raw = [shingles(t).astype("<u8").tobytes() for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["tid", "digests"])

    def sets_of(asked: DataFrame) -> DataFrame:
        wanted = one.join(asked.distinct(), "tid").select(
            "tid", F.col("first.mark_1").alias(marks[0]), F.col("first.mark_2").alias(marks[1])
        )
        text = texts(marked, *marks).dropDuplicates(marks).join(wanted, marks).select("tid", "text")
        sets = stored(map_batches(text, digest, "tid bigint, digests binary"), "near-sets")
        release(spark)
        return sets

    pairs = found.filter("u IS NOT NULL").select("u", "v")
    asked = pairs.select(F.col("u").alias("tid")).unionByName(pairs.select(F.col("v").alias("tid")))
    links = cut(_confirmed(pairs, sets_of(asked), least))
    release(spark)
    units = found.filter("u IS NULL").select(*UNIT)
    if not units.isEmpty():
        # Only pairs that could still join two groups are left to compare, all of them.
        roots = components(links).withColumnRenamed("node", "tid")
        rooted = one.select("tid", "key", "pieces").join(roots, "tid", "left").withColumn("root", F.coalesce("root", "tid"))
        rooted = cut(rooted)
        asked = cut(_apart(rooted, units))
        release(spark)
        links = links.unionByName(cut(_joined(asked, rooted, sets_of(asked.select("tid")), least)))
        release(spark)
    roots = components(links).withColumnRenamed("node", "tid")
    grouped = cut(one.select("tid", "first").join(roots, "tid", "left").withColumn("root", F.coalesce("root", "tid")))
    firsts = grouped.groupBy("root").agg(F.min("first").alias("first"))
    chosen = cut(firsts.select(F.col("first.mark_1").alias(marks[0]), F.col("first.mark_2").alias(marks[1])))
    release(spark)
    # Repeats collapse before the shuffle; the join reads the same partitions.
    return marked.dropDuplicates(marks).join(chosen, marks, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
