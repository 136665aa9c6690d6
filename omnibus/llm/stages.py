"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame, one operator each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from omnibus.llm import bpe, decontamination as benchmark, ngram_join, toxicity as toxic
from omnibus.llm.common import stored, table

reread = stored


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learned from their labelled part, does not reject."""
    model = toxic.fit(docs, table(spark, sf_dir, "labels"))
    return toxic.score(docs, model).where("predicted = 0").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of the n-gram join."""
    return ngram_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return benchmark.clean(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document: its token count and the digests of its ids and of the text they decode to."""
    return bpe.digests(docs, bpe.WordBpe.from_file(bpe.vocabulary_path()))
