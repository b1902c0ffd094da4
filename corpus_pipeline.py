"""The corpus pipeline: quality, language, near duplicates, mixing, token ids.

Each stage takes what its predecessor kept and, but for the last, returns rows
with the columns of ``documents``. The models of the first two stages are learned
from the rows they are given, outside the held-out fold.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from spanvec.llm import byte_bpe, jaccard_join, language_crf, pairwise_quality, source_mix
from spanvec.llm.queries import vocabulary
from spanvec.session import ship_package, shared_dir


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return pairwise_quality.keep_good(docs, pairwise_quality.learn(docs, labels))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found."""
    ship_package(spark)
    return language_crf.keep_known(docs, language_crf.learn(docs))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of five-word shingles at 0.8 hold together."""
    ship_package(spark)
    return jaccard_join.one_of_each(docs, size=5, num=80, den=100)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    ship_package(spark)
    return source_mix.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's token ids, and of the bytes they decode to."""
    ship_package(spark)
    return byte_bpe.encode_documents(docs, vocabulary(), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", good_documents),
    ("language ID", known_language),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing sources", mixed),
    ("byte-level BPE", token_ids),
]

#: Two stages are learned models: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
