"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import (
    op1_sentencepiece,
    op2_extract,
    op3_mix,
    op4_order_minhash,
    op5_pii,
    op6_neighbours,
    op7_toxicity,
    op8_simhash,
    op9_nbsvm,
    op10_substrings,
    op11_collocations,
    op12_circulant,
    op13_audit,
)
from ledgerloom.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _over(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, name))


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_nbsvm.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_sentencepiece": _over("documents", op1_sentencepiece.encoded),
    "op2_extract": _over("pages", op2_extract.main_texts),
    "op3_mix": _over("documents", op3_mix.mixture),
    "op4_order_minhash": _over("documents", op4_order_minhash.fingerprints),
    "op5_pii": _over("documents", op5_pii.personal_data),
    "op6_neighbours": _over("embeddings", op6_neighbours.nearest),
    "op7_toxicity": _op7,
    "op8_simhash": _over("documents", op8_simhash.near_duplicates),
    "op9_nbsvm": _op9,
    "op10_substrings": _over("documents", op10_substrings.without_repeats),
    "op11_collocations": _over("documents", op11_collocations.collocations),
    "op12_circulant": _over("documents", op12_circulant.near_duplicates),
    "op13_audit": _op13,
}

ORACLE_SQL: dict[str, str] = {
    "op11_collocations": op11_collocations.ORACLE_SQL,
    "op12_circulant": op12_circulant.ORACLE_SQL,
    "op13_audit": op13_audit.ORACLE_SQL,
}
