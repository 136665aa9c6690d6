"""Queries over the test tables, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from omnibus.llm import (
    bpe, decontamination, extraction, hard_negatives, language_id, licenses, ngram_join, sharding, sql, token_rollups,
    topk, toxicity, warc, whitening,
)
from omnibus.llm.common import table
from omnibus.sources.shared import fresh_folder


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).drop("row")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_item", "n_shared", "containment")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), bpe.WordBpe.from_file(bpe.vocabulary_path()))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.library())


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ngram_join.join(docs).select("doc_id", "class_id", "class_rows", "n_links")


def op9_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extraction.extract(pages, extraction.fit(pages))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup = token_rollups.Rollup(spark, fresh_folder(spark, "token-rollup"))
    return token_rollups.load(table(spark, sf_dir, "documents"), rollup, token_rollups.Counter.installed())


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0, moved)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_decontamination": op2_decontamination,
    "op3_bpe": op3_bpe,
    "op4_sharding": op4_sharding,
    "op5_warc": op5_warc,
    "op6_topk": op6_topk,
    "op7_licenses": op7_licenses,
    "op8_ngram_join": op8_ngram_join,
    "op9_extraction": op9_extraction,
    "op10_token_counts": op10_token_counts,
    "op11_whitening": op11_whitening,
    "op12_language_id": op12_language_id,
    "op13_hard_negatives": op13_hard_negatives,
}
SQL: dict[str, str] = {
    "op2_decontamination": sql.DECONTAMINATION,
    "op5_warc": sql.WARC,
    "op6_topk": sql.TOPK,
    "op8_ngram_join": sql.NGRAM_JOIN,
    "op13_hard_negatives": sql.HARD_NEGATIVES,
}
