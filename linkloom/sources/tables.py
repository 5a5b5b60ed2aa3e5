"""Readers and writers of the tab-separated contracts and their Parquet forms."""

from __future__ import annotations

import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = ["entity_id", "business_name", "business_address", "country"]
TRUTH = ["source1_entity_id", "matched_entity_ids"]


def read_tsv(spark: SparkSession, path: str, columns: list[str] | None = None, quote: str = "") -> DataFrame:
    """A tab-separated file of strings: no quoting unless asked, blanks are empty strings, and a header
    or a row that isn't of these columns is an error."""
    columns = columns or RECORD
    header = spark.read.text(path).first()
    found = (header[0] if header else "").split("\t")
    if found != columns:
        raise ValueError(f"header is {found}, expected {columns}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = spark.read.schema(schema).options(sep="\t", quote=quote, header=True, mode="FAILFAST", enforceSchema=True).csv(path)
    return df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns])


def positioned(df: DataFrame, name: str = "pos") -> DataFrame:
    """df with its rows' dense file order. Order is part of the contract of result lists."""
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.LongType(), False)])
    return df.sparkSession.createDataFrame(df.rdd.zipWithIndex().map(lambda r: (*r[0], r[1])), schema)


def pool(s2: DataFrame, s3: DataFrame) -> DataFrame:
    return s2.withColumn("src", F.lit("S2")).unionByName(s3.withColumn("src", F.lit("S3")))


def cached_parquet(spark: SparkSession, source: str, cache: str, columns: list[str] | None = None) -> DataFrame:
    """The file through its Parquet copy, which is made if it isn't there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{cache}/_SUCCESS")
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        read_tsv(spark, source, columns).write.mode("overwrite").parquet(cache)
    return spark.read.parquet(cache)


def id_lists(df: DataFrame, columns: list[str] | None = None, unique: bool = True) -> DataFrame:
    """(s1_id, ids array) of a list table; malformed lists, blank and repeated entities are errors."""
    from ..operators.validate import parse_ids

    key, value = columns or TRUTH
    named = df.select(F.when(F.trim(key) == "", F.raise_error(F.lit("blank entity id")).cast("string")).otherwise(F.col(key)).alias("s1_id"), parse_ids(F.col(value)).alias("ids"))
    if unique and (twice := named.groupBy("s1_id").count().where("count > 1").first()):
        raise ValueError(f"repeated entity {twice['s1_id']}")
    return named


def profile(df: DataFrame, prefix: str | None = None, max_rows: int | None = None) -> DataFrame:
    """Per country (blank as <EMPTY>): rows, blank names, blank addresses, ids with another prefix. max_rows, a
    stated limit, takes the first rows by id."""
    rows = df.orderBy("entity_id").limit(max_rows) if max_rows else df
    blank = lambda c: F.count_if(F.trim(c) == "")
    wrong = F.count_if(~F.startswith("entity_id", F.lit(prefix))) if prefix else F.lit(0).cast("long")
    label = F.when(F.trim("country") == "", "<EMPTY>").otherwise(F.col("country"))
    return rows.groupBy(label.alias("country")).agg(F.count(F.lit(1)).alias("rows"), blank("business_name").alias("blank_names"), blank("business_address").alias("blank_addresses"), wrong.alias("prefix_errors"))


def write_lists(lists: DataFrame, path: str, value_name: str = "matched_entity_ids", overwrite: bool = False) -> None:
    """(pos, s1_id, ids) as one tab-separated file in the order of pos."""
    out = lists.orderBy("pos").select(F.col("s1_id").alias("source1_entity_id"), F.col("ids").alias(value_name))
    out.coalesce(1).write.mode("overwrite" if overwrite else "errorifexists").options(sep="\t", quote="", header=True, emptyValue="").csv(path)


def empty_lists(s1: DataFrame) -> DataFrame:
    """The baseline that calls every entity a singleton; ids must be S1 ids."""
    wrong = F.raise_error(F.concat(F.lit("not an S1 id: "), "entity_id")).cast("string")
    return s1.select("pos", F.when(F.startswith("entity_id", F.lit("S1-")), F.col("entity_id")).otherwise(wrong).alias("s1_id"), F.lit("").alias("ids"))


def write_pairs(pairs: DataFrame, path: str) -> None:
    """Pair features by country: floats as 32 bits, zstd, large row groups, atomically by the committer."""
    narrow = [F.col(f.name).cast("float").alias(f.name) if f.dataType == T.DoubleType() else F.col(f.name) for f in pairs.schema.fields]
    pairs.select(*narrow).write.partitionBy("country").option("compression", "zstd").parquet(path)


def read_pairs(spark: SparkSession, path: str, columns: list[str], split: str | None = None) -> DataFrame:
    """Some columns of the candidates of a split: pruned and pushed down to the scan."""
    df = spark.read.parquet(path)
    if split is not None:
        df = df.where((F.col("split") == split) & F.col("is_candidate"))
    return df.select(*columns)


def write_json(value: dict, path: str, overwrite: bool = False) -> None:
    """A small report of the driver, complete or not at all."""
    target = Path(path)
    if target.exists() and not overwrite:
        raise FileExistsError(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=target.parent)
    with os.fdopen(handle, "w", encoding="utf-8") as file:
        json.dump(value, file, indent=2, sort_keys=True)
        file.flush()
        os.fsync(file.fileno())
    os.replace(temporary, target)
