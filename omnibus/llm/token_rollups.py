"""Token counts by source, language and tokenizer version, kept up to date by signed deltas.

A batch changes documents: ``insert`` adds a row, ``delete`` takes away all that
stands under an id, ``revise`` does both.  Committing it writes, under the
batch's own folders,

* ``ledger``: one signed row per document and tokenizer version, from which a
  later batch takes what it has to retract;
* ``deltas``: the sums of those rows by source, language and version;
* ``commits``: a marker, last.

Totals are the sums of the deltas of marked batches, so a batch counts as a
whole or not at all.  A batch whose marker stands is left alone when it comes
again; one that broke off is written over.  Deltas are small whatever the
batch's size: one row per group.

Defined cases: a NULL text has 0 tokens and bytes.  NULL sources and languages
are groups of their own; rows without an id stand under the id NULL together.
Rows repeated in a batch all count.  Deleting an id that isn't there, and an
empty batch, change nothing.  Groups without documents left are not shown.
"""

from __future__ import annotations

import base64
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from omnibus.llm.common import stored

GROUP = ("source", "lang", "tokenizer")
SUMS = ("n_docs", "n_tokens", "n_bytes")
LEDGER = "doc_id bigint, source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint, n_bytes bigint"


class Counter:
    """Counts tokens of a public byte-level vocabulary given as ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, version: str):
        self._ranks, self._pattern, self.version = ranks, pattern, version

    @classmethod
    def installed(cls, name: str = "byte_bpe_50k") -> Counter:
        import public_tokenizers

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return cls(ranks, public_tokenizers.PATTERN, name)

    def __getstate__(self):
        return {"_ranks": self._ranks, "_pattern": self._pattern, "version": self.version}

    @cached_property
    def _encoding(self):
        import tiktoken

        return tiktoken.Encoding(self.version, pat_str=self._pattern, mergeable_ranks=self._ranks, special_tokens={})

    def count(self, text: str) -> int:
        return len(self._encoding.encode_ordinary(text))


def counted(docs: DataFrame, counter: Counter) -> DataFrame:
    """(doc_id, source, lang, tokenizer, n_tokens, n_bytes) of every row, over the whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(counter)

    def run(batches):
        tokens = shared.value
        for batch in batches:
            counts = [tokens.count(v.as_py() or "") for v in batch.column("text")]
            yield batch.drop_columns(["text"]).append_column("n_tokens", pa.array(counts, pa.int64()))

    body = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "source", "lang", F.octet_length(body).cast("bigint").alias("n_bytes"),
        body.alias("text"),
    )
    kinds = "doc_id bigint, source string, lang string, n_bytes bigint, n_tokens bigint"
    return rows.mapInArrow(run, kinds).withColumn("tokenizer", F.lit(counter.version))


class Rollup:
    """The rollup whose tables lie in ``folder``, which all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, table: str, batch: str = "") -> str:
        return f"{self.folder}/{table}" + (f"/batch={batch}" if batch else "")

    def _exists(self, path: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def committed(self, batch: str) -> bool:
        return self._exists(self._path("commits", batch))

    def _marked(self, table: str, columns: str) -> DataFrame:
        """Rows of a table's committed batches, their batch with them."""
        columns += ", batch string"
        if not self._exists(self._path("commits")):
            return self.spark.createDataFrame([], columns)
        marks = self.spark.read.schema("at bigint, batch string").parquet(self._path("commits")).select("batch")
        return self.spark.read.schema(columns).parquet(self._path(table)).join(marks.distinct(), "batch", "left_semi")

    def ledger(self) -> DataFrame:
        return self._marked("ledger", LEDGER).drop("batch")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply ``changes`` (op, doc_id, source, lang, tokenizer, n_tokens, n_bytes); False if it was applied before."""
        if self.committed(batch):
            return False
        columns = [c.split()[0] for c in LEDGER.split(", ")]
        added = changes.where("op IN ('insert', 'revise')").withColumn("n_docs", F.lit(1).cast("bigint"))
        gone = changes.where("op IN ('delete', 'revise')").select("doc_id", "tokenizer").distinct().alias("g")
        held = self.ledger().groupBy("doc_id", *GROUP).agg(*[F.sum(c).alias(c) for c in SUMS]).alias("h")
        same = F.col("h.doc_id").eqNullSafe(F.col("g.doc_id")) & F.col("h.tokenizer").eqNullSafe(F.col("g.tokenizer"))
        taken = held.join(gone, same, "left_semi").where("n_docs <> 0")
        taken = taken.select("doc_id", *GROUP, *[(-F.col(c)).alias(c) for c in SUMS])
        path = self._path("ledger", batch)
        added.select(*columns).unionByName(taken.select(*columns)).write.mode("overwrite").parquet(path)
        written = self.spark.read.schema(LEDGER).parquet(path)
        deltas = written.groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in SUMS])
        deltas.write.mode("overwrite").parquet(self._path("deltas", batch))  # one row per group
        self.spark.range(1).toDF("at").coalesce(1).write.mode("overwrite").parquet(self._path("commits", batch))
        return True

    def totals(self) -> DataFrame:
        deltas = self._marked("deltas", ", ".join([f"{c} string" for c in GROUP] + [f"{c} bigint" for c in SUMS]))
        return deltas.groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in SUMS]).where("n_docs <> 0")


def provisional(docs: DataFrame, version: str) -> DataFrame:
    """Counts before a tokenizer has run: four bytes a token."""
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "source", "lang", F.lit(version).alias("tokenizer"),
        F.call_function("div", size + 3, F.lit(4).cast("bigint")).alias("n_tokens"), size.alias("n_bytes"),
    )


def load(docs: DataFrame, rollup: Rollup, counter: Counter) -> DataFrame:
    """Totals after two batches: all documents with provisional counts, then the exact counts as revisions."""
    rollup.commit("provisional", provisional(docs, counter.version).withColumn("op", F.lit("insert")))
    exact = stored(counted(docs, counter), "token-counts")
    rollup.commit("exact", exact.withColumn("op", F.lit("revise")))
    return rollup.totals()
