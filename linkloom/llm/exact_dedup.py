"""Exact deduplication over an extendible-hash index on shared files.

Every row enters the index under a 64-bit hash of its normalised text. A directory of key prefixes
is doubled while a bucket holds more keys than it should; owner tasks process contiguous ranges of
buckets in key order. An owner keeps a chain of the different texts of a key, told apart by their
bytes, counts each link's rows and finds the row that stays; what it writes to the shared folder is
the result. Bytes travel only for keys that occur more than once: one copy a batch, and of a batch's
rows with one text one partial result, so that a text of a third of all rows costs its owner an entry
a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .shared import content_key, content_sha, drop_written, kept_once, keyed_join, written

#: Keys of a bucket before it splits, and the deepest directory: at most 2^16 entries, which bounds
#: what the driver holds; where they don't suffice, buckets grow.
BUCKET_KEYS, MAX_DEPTH = 2048, 16
#: Hashes that occur repeatedly are broadcast up to this number (8 bytes each), else joined by a shuffle.
BROADCAST_KEYS = 500_000
ENTRY = ["owner", "bucket", "h", "part", "sha", "norm", "size", "n", "id", "row"]


@dataclass
class Directory:
    """depth: global depth; bucket: for each prefix of so many bits, its bucket; local: buckets' depths."""

    depth: int
    bucket: np.ndarray
    local: list[int]

    @classmethod
    def grown(cls, cells: np.ndarray, capacity: int) -> Directory:
        """From key counts of the deepest prefixes. Buckets are numbered in key order in the end."""
        deepest = int(np.log2(len(cells)))
        sums = np.concatenate([[0], np.cumsum(cells)])
        depth, bucket, local, first = 0, np.zeros(1, np.int64), [0], [0]
        waiting = [0]
        while waiting:
            b = waiting.pop()
            width = 1 << (deepest - local[b])
            begin = first[b]
            if sums[begin + width] - sums[begin] <= capacity or local[b] == deepest:
                continue
            if local[b] == depth:  # its one entry can't lead to two buckets: the directory doubles
                bucket, depth = np.repeat(bucket, 2), depth + 1
            local[b] += 1
            new = len(local)
            local.append(local[b])
            first.append(begin + width // 2)
            at = first[new] >> (deepest - depth)
            bucket[at : at + (1 << (depth - local[new]))] = new
            waiting += [b, new]
        order = np.argsort(first)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return cls(depth, place[bucket], [local[k] for k in order])

    def of(self, keys: np.ndarray, bits: int) -> np.ndarray:
        return self.bucket[(keys.astype(np.uint64) >> np.uint64(bits - self.depth)).astype(np.int64)] if self.depth else np.zeros(len(keys), np.int64)


def without_spaces(text: Column) -> Column:
    """Every character of [\\x20\\x09-\\x0D] deleted."""
    return F.translate(text, " \t\n\x0b\f\r", "")


def exact_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", normalise=without_spaces, hash_bits: int = 62, bucket_keys: int = BUCKET_KEYS, extra: dict[str, Column] | None = None, same: Callable[[pa.Buffer, pa.Buffer], bool] = pa.Buffer.equals) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of every row.

    Rows are copies if their normalised texts are the same bytes; null counts as empty, and empty
    texts are copies of each other. The one with the most code points in its original text stays,
    then the smallest id (a missing id comes last); of fully equal rows exactly one is kept. Other
    columns don't matter; an empty table gives no rows. extra adds columns computed from the row.
    hash_bits, which forces collisions, and same, the owners' comparison, are for tests.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    norm = normalise(text)
    key = F.shiftrightunsigned(F.xxhash64(norm), 64 - hash_bits)
    sha = F.unhex(F.sha2(norm, 256))
    rows = written(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), key.alias("h"), sha.alias("sha"), F.length(text).alias("n"), *(c.alias(f"extra_{k}") for k, c in (extra or {}).items())), "dedup-rows")
    keys = written(rows.groupBy("h").agg(F.count(F.lit(1)).alias("rows")), "dedup-keys")
    index = _index(docs.select(key.alias("h"), sha.alias("sha"), norm.cast("binary").alias("norm")), rows, keys, hash_bits, bucket_keys, same)
    drop_written(keys)
    joined = keyed_join(rows, index.where("size > 1").select("sha", "stays", "size"), "sha", "left")
    alone = F.col("size").isNull()
    return joined.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("stays.id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("stays.row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        *(F.col(f"extra_{k}").alias(k) for k in extra or {}),
    )


def _index(texts: DataFrame, rows: DataFrame, keys: DataFrame, bits: int, capacity: int, same: Callable) -> DataFrame:
    """The written index: an entry (bucket, h, chain, sha, stays, size) for each different text."""
    deepest = min(MAX_DEPTH, bits)
    cells = np.zeros(1 << deepest, np.int64)
    for r in keys.groupBy(F.shiftrightunsigned("h", bits - deepest).alias("cell")).count().collect():
        cells[r["cell"]] = r["count"]
    n = int(cells.sum())
    directory = Directory.grown(cells, max(capacity, n >> (MAX_DEPTH - 1)))
    buckets = len(directory.local)
    owners = min(buckets, max(1, n // capacity))
    repeated = keys.where("rows > 1").select(F.col("h").alias("rh"))
    few = repeated.count() <= BROADCAST_KEYS
    sent = texts.join(F.broadcast(repeated) if few else repeated, F.col("h") == F.col("rh"), "left_semi")
    kind = rows.schema["id"].dataType.simpleString()
    entry = f"owner int, bucket long, h long, part int, sha binary, norm binary, size long, n int, id {kind}, row long"
    id_type = to_arrow_type(rows.schema["id"].dataType)

    def dealt(h: pa.Array) -> list[pa.Array]:
        bucket = directory.of(h.to_numpy(), bits)
        return [pa.array((bucket * owners // buckets).astype(np.int32)), pa.array(bucket), h]

    def send_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts of repeated keys, copies within a batch once."""
        for batch in batches:
            norm, first = batch.column("norm"), {}
            for i, k in enumerate(batch.column("sha").to_pylist()):
                j = first.setdefault(k, i)
                if i != j and not norm[i].as_buffer().equals(norm[j].as_buffer()):
                    raise ValueError("two different texts have one sha256")
            own = batch.take(pa.array([*first.values()], pa.int64()))
            none = lambda t: pa.nulls(own.num_rows, t)
            yield pa.RecordBatch.from_arrays([*dealt(own.column("h")), pa.array(np.zeros(own.num_rows, np.int32)), own.column("sha"), own.column("norm"), none(pa.int64()), none(pa.int32()), none(id_type), none(pa.int64())], names=ENTRY)

    def send_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of the rows of a batch with one text their number and the one of them that may stay."""
        for batch in batches:
            order = pc.sort_indices(batch, sort_keys=[("n", "descending"), ("id", "ascending"), ("row", "ascending")])
            batch = batch.take(order)
            _, first, size = np.unique(batch.column("sha").dictionary_encode().indices.to_numpy(), return_index=True, return_counts=True)
            own = batch.take(pa.array(first))
            yield pa.RecordBatch.from_arrays([*dealt(own.column("h")), pa.array(np.ones(own.num_rows, np.int32)), own.column("sha"), pa.nulls(own.num_rows, pa.binary()), pa.array(size, pa.int64()), *(own.column(c) for c in ("n", "id", "row"))], names=ENTRY)

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """An owner's entries in key order, of each key the texts first."""
        at, links, of = None, [], {}

        def closed() -> Iterator[tuple]:
            for place, (sha, _, size, best) in enumerate(links):
                yield (*at, place, sha, size, *best)

        for batch in batches:
            out = []
            norm = batch.column("norm")
            columns = [batch.column(c).to_pylist() for c in ("bucket", "h", "part", "sha", "size", "n", "id", "row")]
            for i, (bucket, h, part, sha, size, n_, id_, row) in enumerate(zip(*columns, strict=True)):
                if (bucket, h) != at:
                    out += closed()
                    at, links, of = (bucket, h), [], {}
                if part == 0:  # a text: the link that has its bytes, or a new one
                    mine = norm[i].as_buffer()
                    found = next((k for k, link in enumerate(links) if same(link[1], mine)), len(links))
                    if found == len(links):
                        links.append([sha, pa.py_buffer(mine.to_pybytes()), 0, None])
                    of[sha] = found
                    continue
                if sha not in of:  # the key has one row
                    of[sha] = len(links)
                    links.append([sha, None, 0, None])
                link, best = links[of[sha]], (n_, id_, row)
                link[2] += size
                if link[3] is None or _rank(best) < _rank(link[3]):
                    link[3] = best
            yield _entries(out, id_type)
        yield _entries([*closed()], id_type)

    entries = sent.mapInArrow(send_texts, entry).unionByName(rows.select("h", "sha", "n", "id", "row").mapInArrow(send_rows, entry))
    owned = entries.repartitionById(owners, "owner").sortWithinPartitions("bucket", "h", "part", "sha")
    found = owned.mapInArrow(chained, f"bucket long, h long, chain int, sha binary, size long, n int, id {kind}, row long")
    return written(found.select("bucket", "h", "chain", "sha", F.struct("id", "row").alias("stays"), "size"), "dedup-index")


def _rank(row: tuple) -> tuple:
    n, id_, place = row
    return (-n, id_ is None, 0 if id_ is None else id_, place)


def _entries(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int32(), id_type, pa.int64()]
    columns = [*zip(*rows, strict=True)] or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names=["bucket", "h", "chain", "sha", "size", "n", "id", "row"])


def without_copies(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows that stay, with all their columns; one of each group, also where rows repeat an id."""
    found = exact_duplicates(docs, text_col, id_col, extra={"key": content_key(id_col, text_col), "sha": content_sha(text_col)}).where("kept")
    return kept_once(docs, found.select("key", F.col(id_col).alias("id"), "sha"), id_col, text_col)
