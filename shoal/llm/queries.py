"""The registered queries of this subpackage: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.llm import bpe, decontaminate, language, licenses, quality_model, quality_rules, secrets, similarity, token_counts, warc
from shoal.llm.storage import shared_folder, stored
from shoal.llm.tables import table


def remainder(n: int) -> Column:
    """Of the crc32 of doc_id as text; it deals documents to folds."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = language.train(language.sample(docs, doc="doc_id", text="text", lang="lang", where=remainder(4) != 2))
    out = language.identify(docs, model, keep=["doc_id"])
    return out.select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score", "phrases")


def quality(spark: SparkSession, sf: str, docs: DataFrame) -> quality_model.Model:
    return quality_model.train(*quality_model.labelled(docs, table(spark, sf, "labels"), where=remainder(5) != 0))


def op2_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    out = quality_model.score(docs, quality(spark, sf, docs), keep=["doc_id"])
    return out.select("doc_id", (remainder(5) == 0).alias("held_out"), "score", "predicted")


def op3_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.scan(table(spark, sf, "documents"), table(spark, sf, "benchmark"), keep=["doc_id"])


def op4_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark)
    warc.write(table(spark, sf, "pages"), path)
    return warc.page_records(warc.read(spark, path, payload=False)).drop("intact")


def op5_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.digests(bpe.encode(table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN), ranks)


def op6_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    scores = token_counts.zipf_scores(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    return token_counts.token_counts(table(spark, sf, "documents"), scores, public_tokenizers.PATTERN)


def op7_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The documents have no paths; source, language and id make one."""
    docs = table(spark, sf, "documents")
    path = F.concat_ws("/", F.col("source"), F.col("lang"), F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".txt")))
    return licenses.scan(docs.withColumn("path", path), keep=["doc_id"])


def op8_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.scan(table(spark, sf, "documents"), keep=["doc_id"])


def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    counted = stored(quality_rules.measures(table(spark, sf, "documents"), keep=["doc_id"]))
    chosen = quality_rules.cutoffs(counted, table(spark, sf, "labels"))
    return quality_rules.judged(counted, chosen).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_similarity_join(spark: SparkSession, sf: str) -> DataFrame:
    return similarity.similar(table(spark, sf, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
