"""Words, shingles, interim tables and connected components shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from omnibus.operators.skew import rekeyed
from omnibus.sources.shared import cut, fresh_folder

#: A word is a run of letters, marks and digits of the lower-cased text.
WORD = r"[\p{L}\p{M}\p{N}]+"
SHINGLE_WORDS = 5
SIMILARITY = 0.8


def words(text: Column) -> Column:
    """The words of a text in order; none for NULL."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def shingles(tokens: Column, size: int, make) -> Column:
    """``make(words)`` for each run of ``size`` words; no run, no entry.

    ``tokens`` is bound to a lambda's argument first: wherever the optimizer
    moves the expression to, the words are made once per row and not per run.
    """

    def runs(bound: Column) -> Column:
        starts = F.when(F.size(bound) >= size, F.sequence(F.lit(0), F.size(bound) - size)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(starts, lambda i: make([F.get(bound, i + k) for k in range(size)]))

    return F.get(F.transform(F.array(tokens), runs), F.lit(0))


def shingle_hashes(tokens: Column, size: int = SHINGLE_WORDS) -> Column:
    return shingles(tokens, size, lambda run: F.xxhash64(*run))


def shingle_texts(tokens: Column, size: int = SHINGLE_WORDS) -> Column:
    return shingles(tokens, size, lambda run: F.concat_ws(" ", *run))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write an interim table to the shared folder and read it back, with its size known."""
    path = fresh_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node of each connected component, for all nodes with an edge.

    Alternates two rewrites of the edge list.  In the first each node hands its
    larger neighbours to its smallest one, in the second its smaller neighbours;
    both keep the components and shorten paths, until every edge points at its
    root.  Each step is a keyed minimum and a join against it, so a node with
    very many edges is pre-aggregated and its join can be split.  The state is
    checkpointed after each pass.
    """
    ends = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    # Every edge points from its larger node to its smaller one.
    state = cut(ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if state.isEmpty():
        return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    while True:
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Larger neighbours of u move to the smallest node around u.
        large = both.where("v > u").join(rekeyed(low, "u"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(rekeyed(low, "u"), "u")
        small = joined.select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")
        )
        after = cut(small.where("u <> v").distinct())
        # Done once no node points at two roots and no root points further.
        heads = after.groupBy("u").count()
        twice = heads.where("count > 1").limit(1)
        onward = after.select(F.col("v").alias("u")).distinct().join(heads.select("u"), "u", "left_semi").limit(1)
        state = after
        if twice.union(onward.withColumn("count", F.lit(0).cast("long"))).isEmpty():
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
