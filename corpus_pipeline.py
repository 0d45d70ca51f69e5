"""A training corpus from raw documents: quality, near-duplicates, privacy, mixture, tokens.

Each stage gets the documents that the one before has left, and each decision takes effect:
rejected documents go, one document of each group of near copies stays, personal data is
masked, sources are taken to their weights, and what is left is encoded.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from farelight.llm import bpe, mixing, privacy, quality, simhash
from farelight.llm.common import ship_package
from farelight.llm.queries import VOCABULARY
from farelight.session import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects. A null text has no words and is rejected."""
    ship_package(spark)
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by fingerprints, the document of the smallest id."""
    ship_package(spark)
    return simhash.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with addresses, numbers of cards and phones masked."""
    ship_package(spark)
    return privacy.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, or parts of them, as often as their source's weight takes them."""
    ship_package(spark)
    return mixing.mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their number, and digests of them and of what they decode to."""
    ship_package(spark)
    coded = bpe.encode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    digests = F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    return coded.select("doc_id", "n_tokens", "ids", *digests)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("pii", personal_data),
    ("source_mixing", mixture),
    ("byte_bpe", tokens),
]

#: The mixture draws blocks by a seeded generator, which SQL does not have; tests compare
#: the stages with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
