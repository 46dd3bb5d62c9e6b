"""From raw documents to encoded training text, in stages that each write and reread Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import near_dedup, op1_sentencepiece, op3_mix, op5_pii, op7_toxicity
from ledgerloom.llm.shared import staged, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op7_toxicity.reject_toxic(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", lambda spark, docs, sf_dir: near_dedup.one_of_each_group(docs)),
    ("pii", lambda spark, docs, sf_dir: op5_pii.redact_documents(docs)),
    ("mixing", lambda spark, docs, sf_dir: op3_mix.mixed_documents(docs)),
    ("sentencepiece", lambda spark, docs, sf_dir: op1_sentencepiece.encode_documents(docs)),
]

# Trained models and tokenizers are outside SQL; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
