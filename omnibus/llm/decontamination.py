"""Benchmark decontamination: short test items inside long documents, by MinHash containment.

Containment |item & text| / |item| of word shingles, not Jaccard similarity,
says whether a long text holds a short item, and a MinHash of the long text
would hardly ever agree with the item's.  So only the item is sampled: the k
smallest hashes of its shingle set are a uniform sample of it, and each one is
found in a text with a chance equal to the containment.

1. Items are partitioned by their number of shingles.  Each partition has its
   own k, the least for which an item exactly at the threshold leaves no hit
   with a chance of ``1 - recall`` at most, whatever its size in the partition's
   range; the last partition is open and has the bound for all sizes.
2. Every shingle of every text is looked up among the sampled hashes.  Texts
   with a hit and the items they hit are candidates.
3. Candidates are verified on the shingle texts themselves, all of them.

The lookup side grows with the items, not with the texts; Spark broadcasts it
while its measured size is under the session's threshold and shuffles beyond.
Before that, a bitmap over the first bits of the sampled hashes drops the
shingles that can't hit, so that few are shuffled.  It has 2^``WORD_BITS`` words
of 64 bits at most, however many items there are, and so is always broadcast.

Defined cases: shingles are sets, so repeats count once.  A text or item of
fewer words than a shingle is one shingle as a whole, so a short item is held by
texts of the same words and no others; one without words has no shingles, holds
nothing and is held by nothing.  Items with one id and different texts are
compared each, and the best containment is reported, of equal ones that of more
shingles; repeated rows of a text give their pair once per row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnibus.llm.common import SHINGLE_WORDS, SIMILARITY, shingle_hashes, shingle_texts, stored, words

RECALL = 1 - 1e-6
#: The bitmap of sampled hashes has 2^18 words, 4 MB of keys and bits.
WORD_BITS = 18
#: Upper bounds of the item sizes of all partitions but the last.
SIZES = (8, 16, 32, 64, 128, 256, 512)


def _draws(n: int, containment: float, recall: float) -> int:
    """Least k for items of exactly ``n`` shingles.

    Of n shingles at most n - ceil(c n) are missing; k draws without
    replacement that are all missing have the chance below.
    """
    missing = n - math.ceil(containment * n - 1e-9)
    k, chance = 0, 1.0
    while chance > 1 - recall and k <= missing:
        chance *= (missing - k) / (n - k)
        k += 1
    return k


def sample_size(smallest: int, containment: float, recall: float = RECALL, largest: int | None = None) -> int:
    """k for items of ``smallest`` to ``largest`` shingles, or of ``smallest`` and more."""
    if largest is not None:
        return max(1, *(_draws(n, containment, recall) for n in range(smallest, largest + 1)))
    k = _draws(smallest, containment, recall)
    # Larger items have a larger share missing at most 1 - c; bound them all.
    if containment < 1:
        k = max(k, math.ceil(math.log(1 - recall) / math.log(1 - containment)))
    return max(k, 1)


def _or_whole(runs: Column, tokens: Column, whole: Column) -> Column:
    """The runs of ``size`` words, or the words as one where they are fewer."""
    return F.when((F.size(runs) == 0) & (F.size(tokens) > 0), F.array(whole)).otherwise(runs)


def gram_hashes(tokens: Column, size: int) -> Column:
    return _or_whole(shingle_hashes(tokens, size), tokens, F.xxhash64(F.concat_ws(" ", tokens)))


def gram_texts(tokens: Column, size: int) -> Column:
    return _or_whole(shingle_texts(tokens, size), tokens, F.concat_ws(" ", tokens))


def item_sketches(items: DataFrame, item_id: str, text: str, size: int, containment: float, recall: float) -> DataFrame:
    """(item_id, item_key, n, grams, sampled): distinct shingle texts and the sampled hashes of each item."""
    tokens = items.select(F.col(item_id).alias("item_id"), words(F.col(text)).alias("_w")).dropDuplicates()
    sets = tokens.select(
        "item_id",
        F.array_distinct(gram_texts(F.col("_w"), size)).alias("grams"),
        F.array_sort(F.array_distinct(gram_hashes(F.col("_w"), size))).alias("hashes"),
    ).where(F.size("grams") > 0)
    k = F.lit(sample_size(SIZES[-1] + 1, containment, recall))
    for low, high in reversed([*zip((0, *SIZES), SIZES)]):
        k = F.when(F.size("grams") <= high, F.lit(sample_size(low + 1, containment, recall, high))).otherwise(k)
    return sets.select(
        "item_id",
        F.xxhash64(F.coalesce(F.col("item_id").cast("string"), F.lit("")), "grams").alias("item_key"),
        F.size("grams").alias("n"),
        "grams",
        F.slice("hashes", 1, k).alias("sampled"),
    )


def _word_and_bit(hash_: Column) -> tuple[Column, Column]:
    """Place of a hash in the bitmap: its first bits."""
    bit = F.shiftrightunsigned(hash_, 64 - WORD_BITS - 6).bitwiseAND(F.lit(63)).cast("int")
    return F.shiftrightunsigned(hash_, 64 - WORD_BITS).cast("int"), bit


def may_hit(hashes: DataFrame, lookup: DataFrame) -> DataFrame:
    """The rows of ``hashes`` whose bit is set by a hash of ``lookup``: all that have a partner, and few others."""
    word, bit = _word_and_bit(F.col("hash"))
    bitmap = lookup.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("bit"))
    bitmap = bitmap.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    # 2^WORD_BITS rows at most.
    near = hashes.withColumn("word", word).join(F.broadcast(bitmap), "word")
    set_ = F.call_function("shiftrightunsigned", F.col("bits"), bit).bitwiseAND(F.lit(1)) == 1
    return near.where(set_).select(*hashes.columns)


def contained(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = SHINGLE_WORDS,
    containment: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """(doc_id, text_key, item_id, n_item, n_shared, containment) for each document and item it holds."""
    sketches = stored(item_sketches(items, item_id, item_text, size, containment, recall), "items")
    lookup = stored(
        sketches.select("item_id", "item_key", F.explode("sampled").alias("hash")).distinct(), "item-hashes"
    )
    keyed = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_key"), words(F.col(text)).alias("_w")
    )
    hashes = keyed.select("doc_id", "text_key", F.explode(gram_hashes(F.col("_w"), size)).alias("hash"))
    hits = may_hit(hashes, lookup).join(lookup, "hash")
    hits = stored(hits.select("doc_id", "text_key", "item_id", "item_key").distinct(), "hits")
    # Texts with a hit are read again, once, with all items they hit.
    wanted = hits.select("doc_id", "text_key").distinct()
    same = (F.col("c.doc_id").eqNullSafe(F.col("w.doc_id"))) & (F.col("c.text_key") == F.col("w.text_key"))
    texts = (
        docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
        .alias("c")
        .join(wanted.alias("w"), same, "left_semi")
        .groupBy("doc_id", "text_key")
        .agg(F.first("text").alias("text"), F.count("*").cast("int").alias("copies"))
        .select("doc_id", "text_key", "copies", words(F.col("text")).alias("_w"))
        .select("doc_id", "text_key", "copies", F.array_distinct(gram_texts(F.col("_w"), size)).alias("has"))
    )
    same = (F.col("t.doc_id").eqNullSafe(F.col("h.doc_id"))) & (F.col("t.text_key") == F.col("h.text_key"))
    checked = (
        texts.alias("t")
        .join(hits.alias("h"), same)
        .join(sketches.select("item_key", "n", "grams"), "item_key")
        .select(
            F.col("t.doc_id").alias("doc_id"),
            F.col("t.text_key").alias("text_key"),
            "copies",
            "item_id",
            F.col("n").alias("n_item"),
            F.size(F.array_intersect("grams", "has")).alias("n_shared"),
        )
        .where(F.col("n_shared") >= containment * F.col("n_item") - 1e-9)
    )
    best = checked.groupBy("doc_id", "text_key", "copies", "item_id").agg(
        F.max(F.struct((F.col("n_shared") / F.col("n_item")).alias("share"), "n_item", "n_shared")).alias("best")
    )
    return best.select(
        "doc_id",
        "text_key",
        "item_id",
        "best.n_item",
        "best.n_shared",
        F.round("best.share", 6).alias("containment"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that hold an item."""
    found = contained(docs, items, **options)
    held = stored(found.select("doc_id", "text_key").distinct(), "contaminated")
    doc_id, text = options.get("doc_id", "doc_id"), options.get("text", "text")
    same = docs[doc_id].eqNullSafe(held["doc_id"]) & (F.xxhash64(docs[text]) == held["text_key"])
    return docs.join(held, same, "left_anti")
