"""Hard-negative mining: exact inner products by Kronecker-packed integers.

A block of candidates is packed component by component: the j-th components of
all of them, made non-negative by a bias, lie in separated fields of one wide
integer.  An anchor multiplies each of its components once by such an integer
and adds the products up; every field then holds that candidate's score plus a
known offset, and fields are wide enough never to touch.

1. Rows are laid out by label and cut into blocks.  Anchors meet the blocks that
   hold their own label, and the best of those rows are the positives.
2. Anchors meet all blocks with their positives' scores; of the rows with other
   labels in a block, the first ones inside each positive's band leave it.

A block is packed from the rows of the anchor's label in the first pass and from
the others in the second, so each pair is multiplied once.  No more than
``POSITIVES`` rows an anchor, or ``NEGATIVES`` a positive, leave a block.

Defined cases: rows with a NULL id or label, a NULL vector, or a NULL or
non-finite component take no part.  A row repeated as a whole counts once.  Rows
that share an id but differ are rows of their own: each is an anchor of its own,
whose results stand under the same id, and never a candidate of another row of
that id.  Shorter vectors count as padded with zeros.  An anchor without another
row of its label, and a positive without a row in its band, give no row.
Components and scores beyond 64 bits stop at the ends of that range.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from omnibus.llm.common import stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: A negative's score lies between these shares, in hundredths, of its positive's.
LOW, HIGH = 30, 90
CANDIDATE_BLOCK = 4096
ANCHOR_BLOCK = 512
_ENDS = (-(1 << 63), (1 << 63) - 1)


class Packed:
    """Candidates (rows of ``v``) as one wide integer per component; ``largest`` bounds all components."""

    def __init__(self, v: np.ndarray, largest: int):
        self.count, self.bias = len(v), largest
        # |sum of a * (x + bias)| stays within ``offset``; adding it makes every field non-negative.
        self.offset = max(1, v.shape[1] * 2 * largest * largest)
        bits = (2 * self.offset).bit_length()
        self.bytes = 4 if bits <= 32 else 8 * math.ceil(bits / 64)
        self.words = [self._fields(v[:, j]) for j in range(v.shape[1])]
        self.offsets = int.from_bytes(self.offset.to_bytes(self.bytes, "little") * self.count, "little")

    def _fields(self, column: np.ndarray) -> int:
        if self.bytes <= 8:
            return int.from_bytes((column + self.bias).astype(f"<u{self.bytes}").tobytes(), "little")
        return int.from_bytes(b"".join((x + self.bias).to_bytes(self.bytes, "little") for x in column.tolist()), "little")

    def scores(self, anchor: list[int]) -> np.ndarray:
        """The inner product of ``anchor`` with every candidate, as 64-bit integers."""
        total = self.offsets
        for a, word in zip(anchor, self.words):
            if a:
                total += a * word
        packed = total.to_bytes(self.bytes * self.count, "little")
        known = self.offset + self.bias * sum(anchor)
        if self.bytes <= 8:
            # The sum of a field lies below 2^64 and a score below 2^63, so the wrapped difference is exact.
            fields = np.frombuffer(packed, f"<u{self.bytes}").astype(np.uint64)
            return (fields - np.uint64(known % (1 << 64))).view(np.int64)
        cut = (packed[i : i + self.bytes] for i in range(0, len(packed), self.bytes))
        exact = (int.from_bytes(c, "little") - known for c in cut)
        return np.array([min(max(s, _ENDS[0]), _ENDS[1]) for s in exact], dtype=np.int64)


def quantized(vectors: DataFrame, vec_id: str, label: Column, embedding: str) -> DataFrame:
    """(vec_id, label, v): integer components of the rows that take part, each row once."""
    real = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    v = F.col(embedding)
    return (
        vectors.where(v.isNotNull() & F.forall(v, real) & F.col(vec_id).isNotNull())
        .select(
            F.col(vec_id).cast("bigint").alias("vec_id"),
            label.cast("bigint").alias("label"),
            F.transform(v, lambda x: F.floor(SCALE * x.cast("double")).cast("bigint")).alias("v"),
        )
        .where("label IS NOT NULL")
        .dropDuplicates()
    )


def _matrix(lists: pa.ListArray, width: int, kind: str) -> np.ndarray:
    lengths = np.diff(lists.offsets.to_numpy())
    filled = np.zeros((len(lists), width), dtype=kind)
    filled[np.arange(width)[None, :] < lengths[:, None]] = lists.flatten().to_numpy()
    return filled


def _candidate_blocks(rows: DataFrame, width: int, kind: str) -> DataFrame:
    """(labels, c_ids, c_labels, c_data): neighbouring rows of ``rows``, their labels also as a list."""

    def pack(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, CANDIDATE_BLOCK):
                part = batch.slice(start, CANDIDATE_BLOCK)
                labels = part.column("label").to_numpy()
                yield pa.RecordBatch.from_pydict({
                    "labels": pa.array([np.unique(labels)], pa.list_(pa.int64())),
                    "c_ids": pa.array([part.column("vec_id").to_numpy().tobytes()], pa.binary()),
                    "c_labels": pa.array([labels.tobytes()], pa.binary()),
                    "c_data": pa.array([_matrix(part.column("v"), width, kind).tobytes()], pa.binary()),
                })

    return rows.mapInArrow(pack, "labels array<bigint>, c_ids binary, c_labels binary, c_data binary")


def _anchor_blocks(rows: DataFrame, width: int, kind: str, carried: tuple[str, ...]) -> DataFrame:
    """Neighbouring anchors of one label; each column of ``carried`` (bigint, or a list of POSITIVES) as bytes."""

    def pack(batches):
        for batch in batches:
            labels = batch.column("label").to_numpy()
            ends = [*(np.flatnonzero(np.diff(labels)) + 1), len(labels)]
            start = 0
            for end in ends:
                while start < end:
                    part = batch.slice(start, min(ANCHOR_BLOCK, end - start))
                    columns = {
                        "label": pa.array([labels[start]], pa.int64()),
                        "a_data": pa.array([_matrix(part.column("v"), width, kind).tobytes()], pa.binary()),
                    }
                    for name in carried:
                        values = part.column(name)
                        flat = values.flatten() if pa.types.is_list(values.type) else values
                        columns["a_" + name] = pa.array([flat.to_numpy().astype(np.int64).tobytes()], pa.binary())
                    yield pa.RecordBatch.from_pydict(columns)
                    start += part.num_rows

    fields = ["label bigint", "a_data binary", *(f"a_{name} binary" for name in carried)]
    return rows.mapInArrow(pack, ", ".join(fields))


def _sides(row: dict, width: int, kind: str, same: bool, largest: int):
    """(anchors, ids of the candidates wanted, their packed form); None where the block has none."""
    wanted = (np.frombuffer(row["c_labels"], np.int64) == row["label"]) == same
    if not wanted.any():
        return None
    anchors = np.frombuffer(row["a_data"], kind).reshape(-1, width)
    data = np.frombuffer(row["c_data"], kind).reshape(-1, width)[wanted].astype(np.int64)
    return anchors, np.frombuffer(row["c_ids"], np.int64)[wanted], Packed(data, largest)


def _first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= least)
        return near[np.lexsort((ids[near], ~score[near]))[:k]]
    return np.lexsort((ids, ~score))[:k]


def _positives_in(row: dict, width: int, kind: str, largest: int, k: int):
    """First pass over one pair of blocks: (anchor_id, key, vec_id, score)."""
    if (sides := _sides(row, width, kind, True, largest)) is None:
        return
    anchors, ids, packed = sides
    for own, key, anchor in zip(_ints(row["a_vec_id"]), _ints(row["a_key"]), anchors.tolist()):
        others = np.flatnonzero(ids != own)
        score = packed.scores(anchor)[others]
        best = _first(score, ids[others], k)
        yield own, key, ids[others[best]], score[best]


def _negatives_in(row: dict, width: int, kind: str, largest: int, k: int):
    """Second pass: (anchor_id, key, place, positive_id, positive_score, vec_id, score)."""
    if (sides := _sides(row, width, kind, False, largest)) is None:
        return
    anchors, ids, packed = sides
    size = np.frombuffer(row["a_found"], np.int64)
    positives = np.frombuffer(row["a_ids"], np.int64).reshape(len(size), -1)
    reached = np.frombuffer(row["a_scores"], np.int64).reshape(len(size), -1)
    for i, (own, key, anchor) in enumerate(zip(_ints(row["a_vec_id"]), _ints(row["a_key"]), anchors.tolist())):
        score = packed.scores(anchor)
        for place in range(size[i]):
            top = int(reached[i, place])
            low, high = -(-LOW * top // 100), HIGH * top // 100
            if low > high:
                continue
            inside = np.flatnonzero((score >= low) & (score <= high) & (ids != own))
            best = inside[_first(score[inside], ids[inside], k)]
            yield own, key, place, int(positives[i, place]), top, ids[best], score[best]


def _ints(packed: bytes) -> list[int]:
    return np.frombuffer(packed, np.int64).tolist()


def _per_pair(pairs: DataFrame, compute, names: list[str]) -> DataFrame:
    """Rows of ``compute``, whose last two values are arrays and whose others hold for all of them."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                found = [f for f in compute(batch.slice(i, 1).to_pylist()[0]) if len(f[-1])]
                if not found:
                    continue
                sizes = [len(f[-1]) for f in found]
                columns = [np.repeat(np.array(c, dtype=np.int64), sizes) for c in list(zip(*found))[:-2]]
                columns += [np.concatenate([f[-2] for f in found]), np.concatenate([f[-1] for f in found])]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return pairs.mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def mine(
    vectors: DataFrame, is_anchor, label: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
    vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` makes a condition from the id column; ``label`` is the column ``label`` by default.
    """
    rows = quantized(vectors, vec_id, F.col("label") if label is None else label, embedding)
    # Neighbours share a label, and a label with very many rows spans several partitions.
    rows = stored(
        rows.repartitionByRange("label", F.xxhash64("vec_id", "v")).sortWithinPartitions("label"), "labelled-vectors"
    )
    bounds = rows.agg(
        F.count("*").alias("n"),
        F.max(F.size("v")).alias("width"),
        F.max(F.array_max("v")).alias("high"),
        F.min(F.array_min("v")).alias("low"),
    ).first()
    width = max(1, bounds["width"] or 0)
    largest = max(1, bounds["high"] or 0, -(bounds["low"] or 0))
    kind = "<i2" if largest < 2**15 else "<i4" if largest < 2**31 else "<i8"
    slots = max(1, bounds["n"] // CANDIDATE_BLOCK)
    slot = F.pmod(F.xxhash64("c_ids"), F.lit(slots)).cast("int")
    blocks = stored(_candidate_blocks(rows, width, kind).withColumn("slot", slot), "labelled-blocks")
    anchors = rows.where(is_anchor(F.col("vec_id"))).withColumn("key", F.xxhash64("label", "v"))
    # First pass
    held = blocks.select("slot", F.explode("labels").alias("label")).distinct()
    sent = _anchor_blocks(anchors, width, kind, ("vec_id", "key")).join(held, "label")
    found = _per_pair(
        sent.join(blocks.drop("labels"), "slot"),
        lambda row: _positives_in(row, width, kind, largest, positives),
        ["anchor_id", "key", "vec_id", "score"],
    )
    order = Window.partitionBy("anchor_id", "key").orderBy(F.desc("score"), "vec_id")
    placed = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    listed = placed.groupBy("anchor_id", "key").agg(
        F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("best")
    )
    padded = lambda name: F.transform(
        F.sequence(F.lit(0), F.lit(positives - 1)), lambda i: F.coalesce(F.get("best", i)[name], F.lit(0).cast("bigint"))
    )
    listed = stored(
        listed.select(
            F.col("anchor_id").alias("vec_id"),
            "key",
            F.size("best").cast("bigint").alias("found"),
            padded("vec_id").alias("ids"),
            padded("score").alias("scores"),
        ),
        "positives",
    )
    # Second pass
    known = anchors.join(listed, ["vec_id", "key"]).sortWithinPartitions("label")
    sent = _anchor_blocks(known, width, kind, ("vec_id", "key", "found", "ids", "scores"))
    sent = sent.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    found = _per_pair(
        sent.join(blocks.drop("labels"), "slot"),
        lambda row: _negatives_in(row, width, kind, largest, negatives),
        ["anchor_id", "key", "place", "positive_id", "positive_score", "negative_id", "negative_score"],
    )
    order = Window.partitionBy("anchor_id", "key", "place").orderBy(F.desc("negative_score"), "negative_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
