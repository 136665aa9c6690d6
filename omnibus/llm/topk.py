"""Exact top-k by inner product: three-phase uniform threshold over dimension slices.

A score is a sum over ``LISTS`` slices of the dimensions, so each slice ranks
the candidates by its part of the score.  Queries and candidates are cut into
blocks; each query block meets each candidate block once in each pass.

1. A query block meets about the square root of all candidate slots.  Each block
   there takes the k best of each slice's list, adds up their full scores and
   returns the k best sums.  The k-th best of these is reached by k rows, so it
   is a lower bound of the k-th best score of all: the safe cutoff.
2. The cutoff t goes out with the query blocks, to all candidate blocks.  A
   candidate that reaches t has at least t / LISTS in some slice; each slice gives
   up all entries from there.  Blocks, and queries within a block, whose lengths
   by slice (Cauchy and Schwarz) rule t out are not multiplied, or no further.
3. The entries given up, and only they, are resolved to their full scores; those
   of t and more compete for the k places.

No more than k rows leave a block for each query, and no row below the cutoff.
Components are integers, so sums are exact: in doubles while they stay below
2^53, in 64-bit integers below 2^63, in Python integers beyond.

Defined cases: vectors that are NULL or hold a NULL or non-finite component take
no part, nor do rows without vec_id.  A row repeated with its id and vector
counts once; rows of the query's own id are never its candidates.  Different
vectors under one id are rows of their own: each may be found, and as queries
they share one list.  Shorter
vectors count as padded with zeros.  Components and scores beyond 64 bits stop
at the ends of that range.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from omnibus.llm.common import stored

K = 20
SCALE = 64
LISTS = 4
CANDIDATE_BLOCK = 2048
QUERY_BLOCK = 1024
_LEAST = -(1 << 63)


def quantized(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v): integer components of the vectors that take part, each row once."""
    real = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    v = F.col(embedding)
    return (
        vectors.where(v.isNotNull() & F.forall(v, real) & F.col(vec_id).isNotNull())
        .select(
            F.col(vec_id).cast("bigint").alias("vec_id"),
            F.transform(v, lambda x: F.floor(SCALE * x.cast("double")).cast("bigint")).alias("v"),
        )
        .dropDuplicates()
    )


def _packed(rows: DataFrame, width: int, block: int, carry: str | None = None) -> DataFrame:
    """One row per block: ids and components as bytes, and the column ``carry`` with them."""

    def pack(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, block):
                part = batch.slice(start, block)
                lists = part.column("v")
                lengths = np.diff(lists.offsets.to_numpy())
                filled = np.zeros((len(lists), width), dtype=np.int64)
                filled[np.arange(width)[None, :] < lengths[:, None]] = lists.flatten().to_numpy()
                columns = [part.column("vec_id").to_numpy().tobytes(), filled.tobytes()]
                if carry:
                    columns.append(part.column(carry).to_numpy().tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c], pa.binary()) for c in columns], names=["ids", "data", "extra"][: len(columns)]
                )

    return rows.mapInArrow(pack, "ids binary, data binary" + (", extra binary" if carry else ""))


def _sides(row: dict, width: int, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """(query ids, candidate ids, queries, candidates, edges of the slices)."""
    ids, others = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["c_ids"], np.int64)
    q = np.frombuffer(row["q_data"], np.int64).reshape(len(ids), width).astype(kind)
    c = np.frombuffer(row["c_data"], np.int64).reshape(len(others), width).astype(kind)
    return ids, others, q, c, sorted(set(np.linspace(0, width, LISTS + 1).astype(int).tolist()))


def _best(query: np.ndarray, score: np.ndarray, other: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's k best entries, ties to the smaller id."""
    order = np.lexsort((other, -score, query))
    ranked = query[order]
    first = np.searchsorted(ranked, ranked)
    return order[np.arange(len(order)) - first < k]


def _whole(score: np.ndarray) -> np.ndarray:
    if score.dtype == object:
        score = np.clip(score, _LEAST, (1 << 63) - 1)
    return score.astype(np.int64)


def _cutoff_block(row: dict, k: int, width: int, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Phase 1: (query ids, scores), the k best full scores among the local lists' leaders."""
    ids, others, q, c, edges = _sides(row, width, kind)
    parts = [q[:, a:b] @ c[:, a:b].T for a, b in zip(edges, edges[1:])]
    own = ids[:, None] == others[None, :]
    leads = np.zeros(own.shape, dtype=bool)
    take = min(k + 1, len(others))  # one more, as the query itself may lead
    for part in parts:
        order = part if part.dtype != object else part.astype(float)
        leads[np.arange(len(ids))[:, None], np.argpartition(-order, take - 1, axis=1)[:, :take]] = True
    query, other = np.nonzero(leads & ~own)
    score = _whole(sum(parts)[query, other])
    kept = _best(query, score, others[other], k)
    return ids[query[kept]], score[kept]


def _lengths(matrix: np.ndarray, edges: list[int]) -> np.ndarray:
    """(slice, row): length of each row's part in each slice, rounded up."""
    whole = matrix.astype(np.float64)
    parts = [np.sqrt((whole[:, a:b] ** 2).sum(axis=1)) for a, b in zip(edges, edges[1:])]
    return np.array(parts) * (1 + 1e-9)


def _resolve_block(row: dict, k: int, width: int, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phases 2 and 3: (query ids, vec ids, scores) of the entries that reach the cutoff."""
    ids, others, q, c, edges = _sides(row, width, kind)
    cutoff = np.frombuffer(row["extra"], np.int64)
    own_lengths, lengths = _lengths(q, edges), _lengths(c, edges)
    least = cutoff.astype(np.float64) - 1 - np.abs(cutoff.astype(np.float64)) * 1e-9
    # Queries that some candidate may serve, by what is still to be multiplied.
    ahead = own_lengths * lengths.max(axis=1)[:, None]
    kept = np.flatnonzero(ahead.sum(axis=0) >= least)
    total = np.zeros((len(kept), len(others)), dtype=kind)
    enough = np.zeros(total.shape, dtype=bool)
    for n, (a, b) in enumerate(zip(edges, edges[1:])):
        part = q[kept, a:b] @ c[:, a:b].T
        total = total + part
        enough |= part * (len(edges) - 1) >= cutoff[kept].astype(kind)[:, None]
        if n + 2 < len(edges) and kind != "object":
            may = (total + ahead[n + 1 :, kept].sum(axis=0)[:, None]).max(axis=1) >= least[kept]
            kept, total, enough = kept[may], total[may], enough[may]
    enough &= ids[kept][:, None] != others[None, :]
    query, other = np.nonzero(enough)
    score = _whole(total[query, other])
    query = kept[query]
    safe = score >= cutoff[query]
    query, other, score = query[safe], other[safe], score[safe]
    best = _best(query, score, others[other], k)
    return ids[query[best]], others[other[best]], score[best]


def _met(queries: DataFrame, candidates: DataFrame, slots: int, seen: int) -> DataFrame:
    """Each query block beside the candidate blocks of ``seen`` slots, by an equal join on the slot."""
    sent = queries.withColumnRenamed("ids", "q_ids").withColumnRenamed("data", "q_data")
    start = F.pmod(F.xxhash64("q_ids"), F.lit(slots))
    turn = F.transform(F.sequence(F.lit(0), F.lit(seen - 1)), lambda i: F.pmod(start + i, F.lit(slots)).cast("int"))
    sent = sent.withColumn("slot", F.explode(turn))
    kept = candidates.withColumnRenamed("ids", "c_ids").withColumnRenamed("data", "c_data")
    return sent.join(kept, "slot").drop("slot")


def _per_block(pairs: DataFrame, compute, names: list[str]) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in compute(row)], names=names)

    return pairs.mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def search(
    vectors: DataFrame, query_filter, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each row that meets ``query_filter``.

    ``query_filter`` makes a condition from the id column.
    """
    rows = stored(quantized(vectors, vec_id, embedding), "vectors")
    bounds = rows.agg(
        F.max(F.size("v")).alias("width"),
        F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))).alias("most"),
    ).first()
    width = max(1, bounds["width"] or 0)
    largest = LISTS * width * (bounds["most"] or 0.0) ** 2
    kind = "float64" if largest < 2**53 else "int64" if largest < 2**63 else "object"
    blocks = _packed(rows, width, CANDIDATE_BLOCK)
    slots = max(1, rows.count() // CANDIDATE_BLOCK)
    blocks = stored(
        blocks.withColumn("slot", F.pmod(F.xxhash64("ids"), F.lit(slots)).cast("int")), "candidate-blocks"
    )
    asked = rows.where(query_filter(F.col("vec_id")))
    # Phase 1
    pairs = _met(_packed(asked, width, QUERY_BLOCK), blocks, slots, math.isqrt(slots - 1) + 1)
    led = _per_block(pairs, lambda row: _cutoff_block(row, k, width, kind), ["query_id", "score"])
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))
    cutoffs = stored(led.withColumn("place", place).where(F.col("place") == k).select("query_id", "score"), "cutoffs")
    # Phases 2 and 3
    known = asked.join(cutoffs.withColumnRenamed("query_id", "vec_id"), "vec_id", "left").withColumn(
        "cutoff", F.coalesce("score", F.lit(_LEAST).cast("bigint"))
    )
    pairs = _met(_packed(known.select("vec_id", "v", "cutoff"), width, QUERY_BLOCK, "cutoff"), blocks, slots, slots)
    found = _per_block(pairs, lambda row: _resolve_block(row, k, width, kind), ["query_id", "vec_id", "score"])
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
