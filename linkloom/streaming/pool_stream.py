"""Linking a stream of pool records to a fixed set of entities, one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import blocking


def link_stream(pool: DataFrame, s1: DataFrame, path: str, checkpoint: str, decide: Callable[[DataFrame], DataFrame] | None = None, k: int = blocking.TOP_K) -> StreamingQuery:
    """Candidates of each arriving record (entity_id, src, business_name, business_address, country) against the
    entities, appended to a Parquet table; a batch that is run again replaces its own folder."""
    prepared = blocking.prepared(s1).cache()

    def batch(records: DataFrame, number: int) -> None:
        both = prepared.unionByName(blocking.prepared(records).select(*prepared.columns))
        pairs = blocking.ranked(blocking.key_evidence(both), k)
        (decide(pairs) if decide else pairs).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return pool.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
