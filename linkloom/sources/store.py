"""Tables that a plan reads more than once, written where the driver and all executors see them."""

from __future__ import annotations

import posixpath
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; in local mode, where it isn't set, a temporary one of this machine.
    On a cluster the missing setting is an error."""
    if where := spark.conf.get("spark.checkpoint.dir", None):
        return where
    if not (spark.conf.get("spark.master", "") or "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _LOCAL.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="linkloom-store-"))


def stored(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table: computed once, however often it is read, and not again when an executor is lost.
    What was shuffled for it goes at once, not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = posixpath.join(shared_folder(spark), "linkloom", f"{label}-{uuid.uuid4().hex}")
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
