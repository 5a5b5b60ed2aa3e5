"""Token ids as Parquet list columns.

Documents are dealt by ranges of their id, encoded in order and written as shards whose row
groups, pages and encodings are set here: ids dictionary-coded and, where a dictionary grows too
large, delta-coded; small pages with page indexes. Reading metadata never touches the ids, and
reading a few documents' ids touches few pages.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .chunks import arrow_slices
from .token_counts import encoded

#: Documents of a shard on average, and the writer's settings.
SHARD_DOCS = 8192
BROADCAST_SHARDS = 500_000
PARQUET = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(512 << 10),
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
}


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int | None = 0, text_col: str = "text", id_col: str = "doc_id", shard_docs: int = SHARD_DOCS) -> None:
    """Encodes the whole text of every row (null as empty), appends end_id, and writes shards at path.

    Columns: id, shard int, first long (ids of the shard before this row), n_tokens long, ids
    array<int>. Rows are in ascending id order over shards and within them; rows without an id come
    first, repeated ids are ordered by text. An empty table gives no rows.
    """
    chosen = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    shards = max(1, -(-chosen.count() // shard_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, done = TaskContext.get().partitionId(), 0
        for part, texts in arrow_slices(batches, "text"):
            flat, sizes = encoded(tokenizer, texts)
            if end_id is not None:
                flat, sizes = np.insert(flat, np.cumsum(sizes), end_id), sizes + 1
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.view("<i4")))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.full(part.num_rows, shard, np.int32)), pa.array(done + offsets[:-1]), pa.array(sizes), ids], names=["id", "shard", "first", "n_tokens", "ids"])
            done += int(offsets[-1])

    kind = chosen.schema["id"].dataType.simpleString()
    ordered = chosen.repartitionByRange(shards, F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    rows = ordered.mapInArrow(run, "id " + kind + ", shard int, first long, n_tokens long, ids array<int>")
    rows.withColumnRenamed("id", id_col).write.options(**PARQUET).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The written rows with start, the ids of all documents before. Select what is needed: without
    the ids column only metadata pages are read. The running total is over shards, not documents."""
    return with_starts(spark.read.parquet(path), path)


def with_starts(rows: DataFrame, path: str) -> DataFrame:
    """rows read from path (shard, first and others) with start in place of shard and first. The table of
    shards is broadcast up to BROADCAST_SHARDS rows of 16 bytes, so that ids aren't shuffled; beyond, joined."""
    totals = rows.sparkSession.read.parquet(path).groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(F.col("shard").alias("of"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    few = totals.count() <= BROADCAST_SHARDS
    joined = rows.join(F.broadcast(bases) if few else bases, rows["shard"] == bases["of"])
    return joined.withColumn("start", F.col("base") + F.col("first")).drop("of", "base", "first", "shard")


def ids_digest(rows: DataFrame, ids_col: str = "ids", out_col: str = "ids_crc32") -> DataFrame:
    """rows with the unsigned crc32 of the ids as little-endian 32-bit integers in place of the ids."""
    kept = [c for c in rows.columns if c != ids_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(ids_col)
            at = ids.offsets.to_numpy()
            flat = np.ascontiguousarray(ids.values.to_numpy(), "<i4")
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(crc, pa.int64())], names=[*kept, out_col])

    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.mapInArrow(run, f"{fields}, `{out_col}` long")
