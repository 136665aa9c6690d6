"""Jaccard self-join on word n-grams by MinHash banding, checked on full n-gram sets.

1. Each text becomes the set of its word n-grams, as 64-bit hashes, and a
   MinHash signature cut into bands.  Rows with equal sets form one class, so
   exact copies, however many, go on as one row.
2. Classes are shuffled on their band hashes.  Each bucket links its members to
   its smallest one; the components of these links are the candidate groups.
   Two classes that share a band are in one group.
3. Groups are cut into levels of set sizes and these into blocks by a hash, bounded
   in members and on average in n-grams.  Sets of levels that aren't neighbours can't
   be similar; each pair of blocks of other levels is one task's input: it intersects the full sets of its members and returns per
   member the rows it is similar to and its local component, never the pairs.
4. Counts are summed, and local components joined to the final classes.

Recall: bands and rows follow from the wanted recall of a pair exactly at the
threshold; pairs above it are found with higher probability still.

Defined cases: a text of fewer words than ``size`` has one n-gram, all its
words; one without words (NULL, empty, only signs) has none, is similar to
nothing and forms its own class.  Repeated rows count as documents of their own.
``class_id`` is the smallest doc_id of a class; NULL ids are passed over.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnibus.llm.common import SHINGLE_WORDS, SIMILARITY, components, stored, words
from omnibus.operators.skew import rekeyed

RECALL = 0.9999
#: Signature length that the choice of bands may use.
MAX_HASHES = 80
#: Members of a block; a task compares two blocks at a time.
BLOCK = 400
#: N-grams of a block, on average; the sizes in a block differ by little, as they are of one level.
BLOCK_GRAMS = 1_000_000
_SEED = 20240607
_COLUMNS = 8192


def plan_bands(similarity: float, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the longest rows for which so many bands reach the recall within ``most`` hashes."""
    choice = None
    for rows in range(1, most + 1):
        chance = similarity**rows
        bands = 1 if chance >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - chance))
        if bands * rows > most:
            break
        choice = (bands, rows)
    if choice is None:
        raise ValueError(f"{most} hashes are too few for recall {recall} at similarity {similarity}")
    return choice


def row_key(columns: DataFrame, doc_id: str, text: str) -> Column:
    known = [F.coalesce(columns[c].cast("string"), F.lit("")) for c in (doc_id, text)]
    return F.unhex(F.md5(F.concat_ws("|", *known)))


def ngram_set(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct n-gram hashes of a text given by its word hashes."""
    if not len(word_hashes):
        return word_hashes
    size = min(size, len(word_hashes))
    count = len(word_hashes) - size + 1
    mixed = np.full(count, np.uint64(size))
    for k in range(size):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + word_hashes[k : k + count]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def set_key(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def _batch_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
    ends = column.offsets.to_numpy()
    for i in range(len(column)):
        yield ngram_set(values[ends[i] : ends[i + 1]], size)


def _word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def sketch(docs: DataFrame, doc_id: str, text: str, size: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, row_key, set_key, n_grams, bands): one row per document; set_key NULL without words."""

    def signatures(batches):
        rng = np.random.default_rng(_SEED)
        scale = rng.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        shift = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)
        number = np.arange(1, bands + 1, dtype=np.uint64)
        for batch in batches:
            keys, counts, found = [], [], []
            for grams in _batch_sets(batch.column("hashes"), size):
                if not len(grams):
                    keys.append(None)
                    counts.append(0)
                    found.append(None)
                    continue
                low = np.full(bands * rows, np.uint64(0xFFFFFFFFFFFFFFFF))
                for start in range(0, len(grams), 2048):
                    part = grams[start : start + 2048, None]
                    np.minimum(low, (part * scale + shift).min(axis=0), out=low)
                low = low.reshape(bands, rows)
                mixed = number.copy()
                for k in range(rows):
                    mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + low[:, k]
                    mixed ^= mixed >> np.uint64(31)
                keys.append(set_key(grams))
                counts.append(len(grams))
                found.append(mixed.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row_key"),
                    pa.array(keys, pa.binary()),
                    pa.array(counts, pa.int64()),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                names=["doc_id", "row_key", "set_key", "n_grams", "bands"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        row_key(docs, doc_id, text).alias("row_key"),
        _word_hashes(F.col(text)).alias("hashes"),
    ).mapInArrow(signatures, f"doc_id {kind}, row_key binary, set_key binary, n_grams bigint, bands array<bigint>")


def _similar(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, limit: Fraction) -> np.ndarray:
    """Boolean matrix: which sets of ``left`` and ``right`` (indexes) reach the similarity, exactly."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[column] > 1
    owner, column = owner[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        a, b = np.searchsorted(column, [start, start + _COLUMNS])
        has = np.zeros((len(sets), min(_COLUMNS, int(column[-1]) + 1 - start)), dtype=np.float32)
        has[owner[a:b], column[a:b] - start] = 1
        common += has[left] @ has[right].T
    common = common.astype(np.int64)
    union = sizes[left][:, None] + sizes[right][None, :] - common
    return common * limit.denominator >= union * limit.numerator


def _local_roots(adjacent: np.ndarray) -> np.ndarray:
    """Smallest index of each one's component."""
    label = np.arange(len(adjacent))
    while True:
        best = np.where(adjacent, label[None, :], len(label)).min(axis=1, initial=len(label))
        after = np.minimum(label, best)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def compare_blocks(members: pa.Table, limit: Fraction) -> pa.Table:
    """Members of one block pair -> (set_key, links, root) by the exact similarity."""
    members = members.sort_by("set_key")
    sets = [np.frombuffer(s, np.uint64) for s in members["grams"].to_pylist()]
    block = members["block"].to_numpy()
    copies = members["copies"].to_numpy()
    keys = members["set_key"].to_pylist()
    n = len(sets)
    low, high = members["i"][0].as_py(), members["j"][0].as_py()
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    adjacent = np.zeros((n, n), dtype=bool)
    if len(left) and len(right):
        adjacent[np.ix_(left, right)] = _similar(sets, left, right, limit)
    adjacent |= adjacent.T
    np.fill_diagonal(adjacent, False)
    roots = _local_roots(adjacent)
    return pa.table(
        {
            "set_key": pa.array(keys, pa.binary()),
            "links": pa.array(adjacent @ copies, pa.int64()),
            "root": pa.array([keys[r] for r in roots], pa.binary()),
        }
    )


def _grams(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame, size: int) -> DataFrame:
    """``wanted`` with the full n-gram set of each class, read from one of its documents."""

    def sets(batches):
        for batch in batches:
            grams = list(_batch_sets(batch.column("hashes"), size))
            same = [k == set_key(g) for k, g in zip(batch.column("set_key").to_pylist(), grams)]
            kept = batch.drop_columns(["hashes"]).append_column(
                "grams", pa.array([g.tobytes() for g in grams], pa.binary())
            )
            yield kept.filter(pa.array(same, pa.bool_()))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema)
    found = (
        docs.select(row_key(docs, doc_id, text).alias("row_key"), F.col(text).alias("text"))
        .join(wanted, "row_key")
        .select(*wanted.columns, _word_hashes(F.col("text")).alias("hashes"))
        .mapInArrow(sets, f"{kinds}, grams binary")
    )
    return found.dropDuplicates(["set_key"])  # a repeated row gives its set again


def blocked(members: DataFrame) -> DataFrame:
    """(root, near, block, set_key, copies, row_key): ``near`` has (level, blocks) of the levels to compare with."""
    sizes = members.groupBy("root", "level").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_grams") / BLOCK_GRAMS)).alias("blocks")
    )
    other = sizes.select("root", F.col("level").alias("l"), F.col("blocks").alias("b"))
    near = (
        sizes.join(other, "root")
        .where(F.abs(F.col("level") - F.col("l")) <= 1)
        .groupBy("root", "level", "blocks")
        .agg(F.collect_list(F.struct("l", "b")).alias("near"))
    )
    return (
        members.join(rekeyed(near, "root"), ["root", "level"])
        .withColumn("block", _block_id(F.col("level"), F.pmod(F.xxhash64("set_key"), F.col("blocks"))))
        .select("root", "near", "block", "set_key", "copies", "row_key")
    )


def _block_id(level: Column, number: Column) -> Column:
    return F.shiftleft(level.cast("bigint"), 40) + number


def _blocks_of(near: str) -> Column:
    first = F.lit(0).cast("bigint")
    return F.flatten(
        F.transform(near, lambda x: F.transform(F.sequence(first, x["b"] - 1), lambda k: _block_id(x["l"], k)))
    )


def join(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE_WORDS,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """(doc_id, row_key, class_id, class_rows, n_links, class_key), one row per row of ``docs``.

    A class is a connected component of documents whose n-gram sets have the
    similarity; ``n_links`` counts the other rows that a row itself is similar to.
    """
    bands, rows = plan_bands(similarity, recall)
    limit = Fraction(similarity).limit_denominator(10_000)
    sketched = stored(sketch(docs, doc_id, text, size, bands, rows), "ngram-sketch")
    classes = stored(
        sketched.where("set_key IS NOT NULL")
        .groupBy("set_key", "n_grams", "bands")
        .agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id"), F.min("row_key").alias("row_key")),
        "ngram-classes",
    )
    banded = classes.select("set_key", F.posexplode("bands").alias("number", "band"))
    heads = banded.groupBy("number", "band").agg(F.min("set_key").alias("head"), F.count("*").alias("n"))
    shared = rekeyed(heads.where("n > 1").drop("n"), "band")
    near = banded.join(shared, ["number", "band"]).select("set_key", "head")
    groups = stored(components(near, "set_key", "head"), "ngram-groups")
    members = groups.union(groups.select("root", "root").distinct())
    # Similar sets are of one level or of neighbours; the factor keeps rounding on the safe side.
    level = F.floor(F.log("n_grams") / math.log(1.001 / similarity))
    members = (
        members.withColumnRenamed("node", "set_key")
        .join(classes.select("set_key", "n_grams", "copies", "row_key"), "set_key")
        .withColumn("level", level)
    )
    wanted = blocked(members)
    full = _grams(docs, doc_id, text, stored(wanted, "ngram-wanted"), size)
    paired = full.withColumn("other", F.explode(_blocks_of("near"))).select(
        "root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "set_key",
        "copies", "grams",
    )
    compared = stored(
        paired.groupBy("root", "i", "j").applyInArrow(
            lambda t: compare_blocks(t, limit), "set_key binary, links bigint, root binary"
        ),
        "ngram-links",
    )
    links = compared.groupBy("set_key").agg(F.sum("links").alias("links"))
    near_roots = components(compared, "set_key", "root")
    rooted = (
        classes.select("set_key", "copies", "first_id")
        .join(near_roots.withColumnRenamed("node", "set_key"), "set_key", "left")
        .join(links, "set_key", "left")
        .withColumn("root", F.coalesce("root", "set_key"))
    )
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("class_id"), F.sum("copies").alias("class_rows"))
    described = rooted.join(rekeyed(ids, "root"), "root").select(
        "set_key", "root", "class_id", "class_rows", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    alone = F.col("set_key").isNull()
    return (
        sketched.drop("n_grams", "bands")
        .join(described, "set_key", "left")
        .select(
            "doc_id",
            "row_key",
            F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
            F.when(alone, F.lit(1)).otherwise(F.col("class_rows")).cast("bigint").alias("class_rows"),
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("root", "row_key").alias("class_key"),
        )
    )


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row left of each class: that with the class's smallest doc_id.

    Among rows of that id the smallest row key stays; of a row that is repeated
    as a whole, one.  Rows without words all stay, but for whole repeats.
    """
    doc_id, text = options.get("doc_id", "doc_id"), options.get("text", "text")
    joined = stored(join(docs, **options), "ngram-joined")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_key"))  # NULL ids last
    keepers = joined.groupBy("class_key").agg(F.min(order).alias("best"))
    best = keepers.select(F.col("best.row_key").alias("row_key")).distinct()
    dropped = rekeyed(joined.select("row_key").distinct().join(best, "row_key", "left_anti"), "row_key")
    keyed = docs.select(row_key(docs, doc_id, text).alias("_key"), F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    kept = keyed.join(dropped.withColumnRenamed("row_key", "_key"), "_key", "left_anti")
    repeated = joined.groupBy("row_key").count().where("count > 1").select(F.col("row_key").alias("_key"))
    repeated = stored(repeated.join(dropped.withColumnRenamed("row_key", "_key"), "_key", "left_anti"), "ngram-repeats")
    if repeated.isEmpty():
        return kept.select("_row.*")
    once = kept.join(repeated, "_key", "left_semi").groupBy("_key").agg(F.first("_row").alias("_row"))
    return kept.join(repeated, "_key", "left_anti").union(once).select("_row.*")
