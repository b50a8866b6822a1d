"""The corpus pipeline: quality, near duplicates, benchmark passages, secrets, tokens.

Each stage takes the documents that its predecessor kept, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.llm import bpe, decontaminate, queries, quality_model, secrets, similarity
from shoal.llm.storage import stored
from shoal.llm.tables import table
from shoal.session import prepared

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def by_itself(stage: Stage) -> Stage:
    """Also a stage that is run alone has the library's settings: without their bound of bytes, Arrow batches have 10,000 rows however long the texts are."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(prepared(spark), docs, sf_dir)

    return run_stage


@by_itself
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones outside the held-out fold, accepts."""
    return quality_model.accept(docs, queries.quality(spark, sf_dir, docs))


@by_itself
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group of near copies."""
    return similarity.first_of_each(docs).select(docs.columns)


@by_itself
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a notable share of benchmark passages."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


@by_itself
def secret(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark, and their lengths as they are then."""
    return secrets.redact(docs).withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))).select(docs.columns)


@by_itself
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each text, and a digest of the bytes that they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = stored(bpe.encode(docs, ranks, public_tokenizers.PATTERN))  # else each task would keep workers for both steps
    decoded = bpe.decode(encoded, ranks)
    return decoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("secrets", secret), ("tokens", tokens)]

#: The stages learn a model and compare sets of n-grams, which SQL can't express; tests/llm compares them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
