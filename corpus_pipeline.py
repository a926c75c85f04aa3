"""Corpus pipeline: quality, exact and near duplicates, secrets, packing. Part of the corpus operators.

Each stage gets all that its predecessor kept, and all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tarnflow.llm import exact_dedup, packing, quality_gam, secret_scan, simhash
from tarnflow.session import read_table, stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model, fitted on the labels, doesn't reject; empty texts are scored too."""
    model = quality_gam.train(docs, read_table(spark, sf_dir, "labels"))
    return quality_gam.accepted(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, but for the case of A-Z, the one with the largest id."""
    return exact_dedup.exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with similar five-word shingles (0.8 or more), the one with the smallest id."""
    return simhash.near_dedup(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked and ``n_chars`` counted anew where that changed them."""
    return secret_scan.masked(docs, length="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents' pieces, packed into sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("exact", exact),
    ("near", near),
    ("secrets", secrets),
    ("packing", packed),
]

#: The classifier, the fingerprints and the tokenizer have no SQL form; a brute-force version tests the stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each but the last written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
