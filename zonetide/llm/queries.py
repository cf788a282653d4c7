"""The registered queries of these operators, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from zonetide.llm import (
    alignment,
    bpe,
    decontaminate,
    languages,
    licences,
    negatives,
    pii,
    quality,
    simhash,
    suffixes,
    token_counts,
    toxicity,
    urls,
)
from zonetide.llm.common import table
from zonetide.session import prepare

Query = Callable[[SparkSession, str], DataFrame]


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Query:
    return lambda spark, sf_dir: run(prepare(spark), sf_dir)


QUERIES: dict[str, Query] = {
    "op1_pii": _query(lambda s, d: pii.find_pii(table(s, d, "documents"))),
    "op2_decontaminate": _query(
        lambda s, d: decontaminate.find_contamination(table(s, d, "documents"), table(s, d, "benchmark"))
    ),
    "op3_quality": _query(lambda s, d: quality.quality(table(s, d, "documents"))),
    "op4_suffixes": _query(lambda s, d: suffixes.remove_repeats(table(s, d, "documents"))),
    "op5_urls": _query(lambda s, d: urls.filter_urls(table(s, d, "pages"), urls.RULES)),
    "op6_licences": _query(lambda s, d: licences.scan(table(s, d, "documents"))),
    "op7_simhash": _query(lambda s, d: simhash.near_duplicates(table(s, d, "documents"))),
    "op8_bpe": _query(lambda s, d: bpe.round_trip(table(s, d, "documents"))),
    "op9_token_counts": _query(lambda s, d: token_counts.count_tokens(table(s, d, "documents"))),
    "op10_toxicity": _query(lambda s, d: toxicity.toxicity(table(s, d, "documents"), table(s, d, "labels"))),
    "op11_alignment": _query(lambda s, d: alignment.align(table(s, d, "documents"))),
    "op12_negatives": _query(lambda s, d: negatives.hard_negatives(table(s, d, "embeddings"))),
    "op13_languages": _query(lambda s, d: languages.language_id(table(s, d, "documents"))),
}

ORACLES: dict[str, str] = {"op3_quality": quality.ORACLE, "op5_urls": urls.ORACLE, "op12_negatives": negatives.ORACLE}
