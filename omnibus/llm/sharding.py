"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers.

1. Equal rows are counted, not carried, and each distinct row falls into one of
   ``BUCKETS`` buckets by a hash.  Rows are numbered within their bucket, buckets
   by the running total of their counts: a global row number that depends on the
   rows alone, not on files, partitions or executors.  Only the bucket totals,
   ``BUCKETS`` rows at most, pass through one task.
2. A generalized Feistel network over Z_a x Z_b, with a b just above the number
   of rows n, permutes [0, a b).  Results of n or more walk on until they fall
   below n; that is a permutation of [0, n).  The longest walk is found first,
   from the a b - n numbers outside, so each walk runs to its end.
3. The permuted number p gives shard p mod shards and slot p div shards: counts
   differ by one at most, slots have no gaps, and anyone can compute them.

Defined cases: a NULL text has size 1 and the checksum of ''.  Rows equal in
doc_id, size and checksum are interchangeable; each gets a number of its own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from omnibus.llm.common import stored

SHARDS = 8
SEED = 17
ROUNDS = 6
BUCKETS = 4096
#: A row that is repeated very often is dealt out in runs of so many.
RUN = 4096


def radices(n: int) -> tuple[int, int]:
    """a, b >= 2 with a b >= n and as few numbers in excess as a near-square allows."""
    a = max(2, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(2, -(-n // a))


def feistel(number: Column, a: int, b: int, seed: int = SEED, rounds: int = ROUNDS) -> Column:
    """One pass of the permutation of [0, a b)."""

    def turn(state: Column, k: Column) -> Column:
        left, right = state["l"], state["r"]
        by_right = F.pmod(left + F.pmod(F.xxhash64(right, k, F.lit(seed)), F.lit(a).cast("bigint")), F.lit(a))
        by_left = F.pmod(right + F.pmod(F.xxhash64(left, k, F.lit(seed)), F.lit(b).cast("bigint")), F.lit(b))
        even = F.pmod(k, F.lit(2)) == 0
        return F.struct(
            F.when(even, by_right).otherwise(left).cast("bigint").alias("l"),
            F.when(even, right).otherwise(by_left).cast("bigint").alias("r"),
        )

    number = number.cast("bigint")
    start = F.struct((number % a).alias("l"), F.call_function("div", number, F.lit(a).cast("bigint")).alias("r"))
    keys = F.sequence(F.lit(0), F.lit(rounds - 1))
    return F.aggregate(keys, start, turn, lambda s: s["l"] + s["r"] * F.lit(a).cast("bigint"))


def longest_walk(spark: SparkSession, n: int, a: int, b: int, seed: int = SEED) -> int:
    """Passes that the longest walk of any number below n takes.

    Walks enter the numbers outside at those that no other number outside leads
    to; cycles that lie outside as a whole are never entered.
    """
    every = spark.range(n, a * b).select(F.col("id").alias("p"))
    onward = lambda df: df.select(feistel(F.col("p"), a, b, seed).alias("p")).where(F.col("p") >= n)
    outside = stored(every.join(onward(every), "p", "left_anti"), "walks")
    passes = 1
    while not outside.isEmpty():
        outside = stored(onward(outside), "walks")
        passes += 1
    return passes


def permuted(spark: SparkSession, number: Column, n: int, seed: int = SEED) -> Column:
    """The permutation of [0, n) applied to a row number."""
    a, b = radices(n)
    passes = longest_walk(spark, n, a, b, seed)
    again = lambda p, _: F.when(p >= n, feistel(p, a, b, seed)).otherwise(p)
    return F.aggregate(F.sequence(F.lit(1), F.lit(passes)), feistel(number, a, b, seed), again)


def numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with a column ``number``, from 0 without gaps, and how many there are."""
    names = rows.columns
    counted = (
        rows.groupBy(*names)
        .count()
        .withColumn("_order", F.xxhash64(*names))
        .withColumn("_bucket", F.pmod("_order", F.lit(BUCKETS)))
    )
    counted = stored(counted, "shard-rows")
    totals = counted.groupBy("_bucket").agg(F.sum("count").alias("rows"))
    starts = stored(
        totals.withColumn(
            "_start",
            F.sum("rows").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)),
        ).select("_bucket", F.coalesce("_start", F.lit(0)).alias("_start"), "rows"),
        "shard-starts",
    )
    n = starts.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    before = Window.partitionBy("_bucket").orderBy("_order", *names).rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("count").over(before), F.lit(0)) + F.col("_start")
    runs = (
        counted.join(F.broadcast(starts.drop("rows")), "_bucket")  # BUCKETS rows at most
        .withColumn("_first", first)
        .withColumn("_run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.call_function("div", F.col("count") - 1, F.lit(RUN).cast("bigint")))))
    )
    low = F.col("_first") + F.col("_run") * RUN
    high = F.least(low + RUN, F.col("_first") + F.col("count")) - 1
    return runs.select(*names, F.explode(F.sequence(low, high)).alias("number")), n


def shards(
    docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text", seed: int = SEED
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    table, n = numbered(rows)
    table = table.withColumn("_p", permuted(docs.sparkSession, F.col("number"), n, seed))
    return table.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("_p") % shards).cast("int").alias("shard"),
        F.call_function("div", F.col("_p"), F.lit(shards).cast("bigint")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
