"""URL filters: allow and block entries in a trie over reversed host labels and path segments."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonetide.llm.common import map_batches

#: The trie is broadcast, so the entries are counted first: about 300 bytes each, 150 MB at this bound.
MAX_RULES = 500_000


@dataclass
class Node:
    """A host label or path segment; `ends` holds entries whose last, perhaps unfinished, segment starts here."""

    below: dict[str, Node] = field(default_factory=dict)
    path: Node | None = None
    whole: tuple[int, str, str] | None = None
    ends: dict[str, tuple[int, str, str]] = field(default_factory=dict)


def _better(old, new):
    """The longer entry; of two equal ones the one that blocks."""
    return new if old is None or (new[0], new[2] == "block") > (old[0], old[2] == "block") else old


def build_trie(rules: Iterable[tuple[str, str]]) -> Node:
    """Entries are (verdict, host with path), for instance ("block", "example.org/es/")."""
    root, n = Node(), 0
    for verdict, rule in rules:
        n += 1
        if n > MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} entries: too many to broadcast")
        if verdict not in ("allow", "block"):
            raise ValueError(f"verdict must be allow or block: {verdict}")
        host, slash, path = rule.partition("/")
        node = root
        for label in reversed(host.lower().split(".")):
            node = node.below.setdefault(label, Node())
        entry = (len(rule), rule, verdict)
        if not slash:
            node.whole = _better(node.whole, entry)
            continue
        node.path = node.path or Node()
        *full, last = path.split("/")
        node = node.path
        for segment in full:
            node = node.below.setdefault(segment, Node())
        node.ends[last] = _better(node.ends.get(last), entry)
    return root


def longest(root: Node, host: str, path: str) -> tuple[str | None, str | None]:
    """The longest entry that fits, and its verdict."""
    best, node = None, root
    segments = path.split("/")[1:] if path.startswith("/") else []
    for label in reversed(host.split(".")):
        node = node.below.get(label)
        if node is None:
            break
        if node.whole:
            best = _better(best, node.whole)
        at = node.path
        for k, segment in enumerate(segments):
            if at is None:
                break
            if len(at.ends) > len(segment) + 1:
                fits = [at.ends[p] for n in range(len(segment) + 1) if (p := segment[:n]) in at.ends]
            else:
                fits = [e for p, e in at.ends.items() if segment.startswith(p)]
            # An entry may end inside this segment, whatever follows it.
            for entry in fits:
                best = _better(best, entry)
            at = at.below.get(segment) if k + 1 < len(segments) else None
    return (None, None) if best is None else (best[1], best[2])


def filter_urls(
    pages: DataFrame, rules: Iterable[tuple[str, str]], default: str = "allow", key: str = "page_id"
) -> DataFrame:
    """`key`, host, path, rule and verdict of each row's `url`.

    Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; path: then up to `?`, `#` or the end. A
    null url, and one without `://`, has an empty host and path, fits no entry and gets the default verdict. The
    longest entry wins; of two equal ones the block entry. Rows are judged one by one: repeated rows and ids give
    repeated results, an empty table an empty one, other columns are not read.
    """
    spark = pages.sparkSession
    trie = spark.sparkContext.broadcast(build_trie(rules))
    rest = F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    parts = pages.select(key, F.translate(host, upper, lower).alias("host"), path.alias("path"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = trie.value
        for batch in batches:
            found = [longest(root, h, p) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] or default for f in found], pa.string()),
                ],
                names=[*batch.schema.names, "rule", "verdict"],
            )

    kind = pages.schema[key].dataType.simpleString()
    return map_batches(parts, judge, f"`{key}` {kind}, host string, path string, rule string, verdict string")


#: The entries that the registered query applies.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

ORACLE = r"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), s AS (
  SELECT page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM u
), m AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
  END AS rule FROM s
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM m
"""
