"""Quality rules per document, and host-level verdicts from rates shrunk by an empirical beta prior."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonetide.llm.common import spare, stored, texts

_SPACE = "\t\n\x0b\f\r"
MIN_WORDS = 50
REPEAT_PERCENT = 50
#: Soft rules: more symbols than a tenth of the words, a third of the lines repeated, mean word length out of bounds.
SYMBOL_SHARE, LINE_SHARE, WORD_LENGTH = 0.1, 0.3, (2.0, 14.0)
#: A host is bad when its shrunk rate of failing documents is above this.
BAD_RATE = 0.5


@dataclass(frozen=True)
class BetaPrior:
    alpha: float
    beta: float


def with_metrics(docs: DataFrame) -> tuple[DataFrame, str]:
    """The table with a struct of the document's figures and rule results, and the name of that column."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words, lines, grams, twice, name = (spare(docs, c) for c in ("words", "lines", "grams", "twice", "figures"))
    cleaned = F.translate(text, _SPACE, " " * len(_SPACE))
    out = docs.withColumns(
        {
            words: F.array_remove(F.split(cleaned, " ", -1), ""),
            lines: F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    # Digests tell most texts, which have no window twice, from the rest; the rest compare the windows' words.
    out = out.withColumn(
        grams,
        F.expr(
            f"if(size(`{words}`) < 3, cast(array() as array<bigint>), transform(slice(`{words}`, 3, size(`{words}`)), "
            f"(w, i) -> xxhash64(`{words}`[i], `{words}`[i + 1], w)))"
        ),
    )
    windows = (
        f"array_sort(transform(`{grams}`, (h, i) -> "
        f"struct(concat_ws(' ', `{words}`[i], `{words}`[i + 1], `{words}`[i + 2]) as t, i as i)))"
    )
    out = out.withColumn(
        twice,
        F.when(F.size(F.array_distinct(grams)) < F.size(grams), F.expr(windows)).otherwise(
            F.expr("cast(array() as array<struct<t: string, i: int>>)")
        ),
    )
    places = (
        f"array_sort(transform(filter(`{twice}`, (x, k) -> x.t = get(`{twice}`, k - 1).t or "
        f"x.t = get(`{twice}`, k + 1).t), x -> x.i))"
    )
    starts = spare(docs, "starts")
    out = out.withColumn(starts, F.when(F.size(twice) > 0, F.expr(places)).otherwise(F.expr("cast(array() as array<int>)")))
    repeated = F.expr(
        f"aggregate(transform(`{starts}`, (x, k) -> least(3, coalesce(get(`{starts}`, k + 1) - x, 3))), 0L, (a, x) -> a + x)"
    )
    symbols = F.char_length(text) - F.char_length(F.translate(text, "#*$%&|<>", ""))
    out = out.withColumn(
        name,
        F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.translate(text, _SPACE + " ", "")).cast("long").alias("word_chars"),
            symbols.cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.size(lines).cast("long").alias("n_lines"),
            repeated.alias("n_repeat_words"),
        ),
    )
    return out.drop(words, lines, grams, twice, starts), name


def base_failed(f: str) -> Column:
    n = F.col(f"{f}.n_words")
    return (n < MIN_WORDS) | (F.col(f"{f}.n_repeat_words") * 100 > n * REPEAT_PERCENT)


def soft_failed(f: str) -> Column:
    """Whether any of the soft rules fails."""
    n, chars = F.col(f"{f}.n_words"), F.col(f"{f}.word_chars")
    low, high = WORD_LENGTH
    return (
        (F.col(f"{f}.n_symbols") > n * F.lit(SYMBOL_SHARE))
        | (F.col(f"{f}.n_dup_lines") > F.col(f"{f}.n_lines") * F.lit(LINE_SHARE))
        | (chars < n * F.lit(low))
        | (chars > n * F.lit(high))
    )


def host_rates(judged: DataFrame, host: str, failed: Column) -> DataFrame:
    """Documents and failing documents of each host; partial sums meet in the shuffle, so a hot host is one row a task."""
    return judged.groupBy(host).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(failed, 1).otherwise(0)).alias("k")
    )


def fit_prior(hosts: DataFrame) -> BetaPrior:
    """Beta prior from the hosts' mean rate and its variance, less what chance alone gives; four sums reach the driver.

    Without spread beyond chance, or with fewer than two hosts, all hosts share the mean: a prior of great weight.
    """
    rate = F.col("k") / F.col("n")
    n, mean, square, inverse = hosts.agg(
        F.count(F.lit(1)), F.avg(rate), F.avg(rate * rate), F.avg(F.lit(1.0) / F.col("n"))
    ).first()
    if not n:
        return BetaPrior(1.0, 1.0)
    mean = round(min(max(mean, 1e-6), 1 - 1e-6), 9)
    spread = mean * (1 - mean)
    variance = square - mean * mean - spread * inverse
    weight = spread / variance - 1 if n > 1 and variance > spread / 1e6 else 1e6
    weight = round(min(max(weight, 1e-3), 1e6), 6)
    return BetaPrior(mean * weight, (1 - mean) * weight)


def bad_hosts(hosts: DataFrame, prior: BetaPrior, rate: float = BAD_RATE) -> DataFrame:
    shrunk = (F.col("k") + F.lit(prior.alpha)) / (F.col("n") + F.lit(prior.alpha + prior.beta))
    return hosts.withColumn("rate", shrunk).filter(F.col("rate") > rate)


def judge(docs: DataFrame, host: str = "source", whole: bool = True) -> tuple[DataFrame, str, str]:
    """The table (unless `whole`, without its texts) with its figures and the verdict `kept`, and the names of these two columns.

    A document fails by itself when the base rule says so. A document that breaks a soft rule is dropped only where its
    host's rate of failing documents, shrunk to the prior, is above BAD_RATE: a host condemns doubtful documents, never
    clean ones. Documents without a host form one group.

    The figures are stored once, then read for the rates and for the verdicts. Bad hosts are joined by whatever their
    measured size allows; a shuffled join of them has no aggregate above it, so the adaptive planner may split a hot host.
    """
    out, figures = with_metrics(docs)
    out = stored(out if whole else out.drop("text"), "quality")
    failed = base_failed(figures) | soft_failed(figures)
    hosts = stored(host_rates(out, host, failed), "hosts")
    bad = bad_hosts(hosts, fit_prior(hosts))
    kept, mark, other = spare(out, "kept"), spare(out, "host_is_bad"), spare(out, "bad_host")
    bad = bad.select(F.col(f"`{host}`").alias(other), F.lit(True).alias(mark))
    joined = out.join(bad, F.col(f"`{host}`").eqNullSafe(F.col(other)), "left")
    doubtful = F.coalesce(F.col(mark), F.lit(False)) & soft_failed(figures)
    return joined.withColumn(kept, ~base_failed(figures) & ~doubtful).drop(other, mark), figures, kept


def quality(docs: DataFrame, host: str = "source") -> DataFrame:
    """Figures and verdict of every whole text, one result row per row.

    A null or empty text has no words and fails. A null id stays null, a null host is a host; repeated rows give repeated
    results and count each; an empty table gives an empty one; other columns are not read.
    """
    out, f, kept = judge(docs.select("doc_id", "text", F.col(f"`{host}`").alias("host")), "host", whole=False)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return out.select(
        "doc_id",
        *[F.col(f"{f}.{n}").alias(n) for n in names],
        base_failed(f).alias("base_failed"),
        F.col(kept).alias("kept"),
        soft_failed(f).alias("soft_failed"),
    )


def keep_good(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows that the rules keep, with their own columns."""
    out, _, kept = judge(docs, host)
    return out.filter(F.col(kept)).select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d
), g AS (
  SELECT rid, i, concat_ws(' ', ws[i], ws[i + 1], ws[i + 2]) AS g FROM (
    SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), c AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM (
      SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS m FROM g) WHERE m > 1)
  GROUP BY rid
), f AS (
  SELECT rid, doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN c USING (rid)
), b AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed,
    n_symbols > n_words * CAST({SYMBOL_SHARE} AS DOUBLE) OR n_dup_lines > n_lines * CAST({LINE_SHARE} AS DOUBLE)
    OR word_chars < n_words * CAST({WORD_LENGTH[0]} AS DOUBLE)
    OR word_chars > n_words * CAST({WORD_LENGTH[1]} AS DOUBLE) AS soft_failed FROM f
), h AS (
  SELECT source, count(*) AS n, sum(CASE WHEN base_failed OR soft_failed THEN 1 ELSE 0 END) AS k FROM b GROUP BY source
), s AS (
  SELECT count(*) AS n, round(least(greatest(avg(k / n), 1e-6), 1 - 1e-6), 9) AS mean, avg((k / n) * (k / n)) AS square,
    avg(1.0 / n) AS inverse FROM h
), v AS (SELECT n, mean, square - mean * mean - mean * (1 - mean) * inverse AS variance FROM s
), p AS (
  SELECT mean, round(least(greatest(CASE WHEN n > 1 AND variance > mean * (1 - mean) / 1e6
    THEN mean * (1 - mean) / variance - 1 ELSE 1e6 END, 1e-3), 1e6), 6) AS weight FROM v
), bad AS (SELECT source FROM h, p WHERE (k + mean * weight) / (n + weight) > {BAD_RATE})
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (soft_failed AND EXISTS (SELECT 1 FROM bad WHERE bad.source IS NOT DISTINCT FROM b.source))
  AS kept, soft_failed
FROM b
"""
