"""Corpus cleaning: each stage takes the documents its predecessor kept.

All stages but the last return the columns of ``documents``; the last returns
one row per kept document with its encoding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from omnibus.llm import stages

STAGES = [
    ("toxicity", stages.toxicity),
    ("ngram_jaccard_join", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("bpe", stages.encoding),
]

#: Trees and merge tables have no SQL form; the tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stages.reread(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
