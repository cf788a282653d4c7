"""Suffix ranks of one block by the difference cover of 3: sort sampled triples, recurse on their names, merge the rest.

Ranks are only needed to a depth, so the recursion ends once a name stands for that many symbols. Suffixes that agree to
the depth get neighbouring ranks, in any order among themselves.
"""

from __future__ import annotations

import numpy as np

#: Symbols are packed three to a word, so a block has fewer than 2 ** 21 of them.
BITS = 21
MAX_SYMBOLS = (1 << BITS) - 8


def _names(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense names from 1 in the order of the keys."""
    order = np.argsort(keys)
    ranked = keys[order]
    fresh = np.empty(len(keys), dtype=bool)
    fresh[:1] = True
    np.not_equal(ranked[1:], ranked[:-1], out=fresh[1:])
    names = np.empty(len(keys), dtype=np.int64)
    names[order] = np.cumsum(fresh)
    return names, int(fresh.sum())


def suffix_ranks(symbols: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix of `symbols` (integers from 1) a rank: those that differ within `depth` symbols are ranked in their
    order, and those that agree stand together.
    """
    n = len(symbols)
    if n > MAX_SYMBOLS:
        raise ValueError(f"a block has at most {MAX_SYMBOLS} symbols, not {n}")
    t = np.zeros(n + 6, dtype=np.uint64)
    t[:n] = symbols
    if depth <= 1 or n < 3:
        keys = (t[:n] << np.uint64(2 * BITS)) | (t[1 : n + 1] << np.uint64(BITS)) | t[2 : n + 2]
        return _names(keys)[0]
    one, two = np.arange(1, n, 3), np.arange(2, n, 3)
    sampled = np.concatenate([one, two])
    triples = (t[sampled] << np.uint64(2 * BITS)) | (t[sampled + 1] << np.uint64(BITS)) | t[sampled + 2]
    names, distinct = _names(triples)
    if depth > 3 and distinct < len(sampled):
        # A smallest symbol keeps the suffixes of the first part from running on into the second.
        reduced = np.concatenate([names[: len(one)] + 1, [1], names[len(one) :] + 1])
        found = suffix_ranks(reduced, -(-depth // 3))
        names = np.concatenate([found[: len(one)], found[len(one) + 1 :]])
    rank = np.zeros(n + 6, dtype=np.uint64)
    rank[sampled] = names
    rest = np.arange(0, n, 3)
    shift = np.uint64(BITS + 1)

    def by_one(at: np.ndarray) -> np.ndarray:
        return (t[at] << shift) | rank[at + 1]

    def by_two(at: np.ndarray) -> np.ndarray:
        return (((t[at] << np.uint64(BITS)) | t[at + 1]) << shift) | rank[at + 2]

    out = np.empty(n, dtype=np.int64)
    # A suffix's rank is the number of smaller ones: among the sampled by rank, between the parts by symbols and rank.
    ordered = np.sort(names)
    own = np.searchsorted(ordered, names)
    rest_one, rest_two = by_one(rest), by_two(rest)
    sorted_one, sorted_two = np.sort(rest_one), np.sort(rest_two)
    keys_one, keys_two = by_one(one), by_two(two)
    out[one] = own[: len(one)] + np.searchsorted(sorted_one, keys_one)
    out[two] = own[len(one) :] + np.searchsorted(sorted_two, keys_two)
    out[rest] = (
        np.searchsorted(sorted_one, rest_one)
        + np.searchsorted(np.sort(keys_one), rest_one)
        + np.searchsorted(np.sort(keys_two), rest_two)
    )
    return out + 1


def equal_neighbours(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each place in `order` starts the same `length` bytes as the one before it, compared in full."""
    padded = np.zeros(len(text) + 8, dtype=np.uint64)
    padded[: len(text)] = text
    words = np.zeros(len(text) + 1, dtype=np.uint64)
    for k in range(8):
        words[: len(text)] |= padded[k : k + len(text)] << np.uint64(8 * k)
    same = np.ones(len(order), dtype=bool)
    same[:1] = False
    a, b, left = order[1:], order[:-1], np.arange(1, len(order))
    for at in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        equal = words[a + at] == words[b + at]
        same[left[~equal]] = False
        a, b, left = a[equal], b[equal], left[equal]
    return same
