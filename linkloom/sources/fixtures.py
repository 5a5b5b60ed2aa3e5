"""Linkage views over the standard star-schema tables: the same definitions in DuckDB are in plans.oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def er_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text linkage: documents with the same first eight words belong together, the least id owning the
    others; single documents are partly moved to the pool as orphans."""
    raw = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("country"), F.slice(F.split("text", " "), 1, 12).alias("w"))
    raw = raw.withColumn("head", F.array_join(F.slice("w", 1, 8), " "))
    heads = raw.groupBy("head").agg(F.min("doc_id").alias("own"), F.count(F.lit(1)).alias("n"))
    member = F.col("doc_id") != F.col("own")
    src = (
        F.when(member, F.when(F.col("doc_id") % 2 == 0, "S2").otherwise("S3"))
        .when((F.col("n") == 1) & (F.col("doc_id") % 4 == 3), F.when(F.col("doc_id") % 8 == 3, "S2").otherwise("S3"))
        .otherwise("S1")
    )
    number = F.col("own") % 97 + F.when(member & (F.col("doc_id") % 3 == 0), 1).otherwise(0)
    address = F.when(F.col("doc_id") % 11 == 0, "").otherwise(F.concat_ws(" ", F.array_join(F.slice("w", 5, 8), " "), number.cast("string")))
    return raw.join(heads, "head").select(
        F.concat_ws("-", src, F.col("doc_id").cast("string")).alias("entity_id"),
        F.array_join(F.slice("w", 1, 4), " ").alias("business_name"),
        address.alias("business_address"),
        "country",
        src.alias("src"),
        "doc_id",
        F.when(member, F.concat(F.lit("S1-"), F.col("own").cast("string"))).alias("owner_id"),
    )


def er_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many equal names: parts as businesses."""
    p = table(spark, sf_dir, "part")
    src = F.concat(F.lit("S"), (F.col("p_partkey") % 3 + 1).cast("string"))
    return p.select(
        F.concat_ws("-", src, F.col("p_partkey").cast("string")).alias("entity_id"),
        F.col("p_name").alias("business_name"),
        F.concat_ws(" ", F.col("p_size").cast("string"), "p_brand", "p_type").alias("business_address"),
        F.col("p_type").alias("country"),
        src.alias("src"),
    )


def er_eval(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(entities, scored): every order is an entity (s1_id, country); its lines are scored records
    (s1_id, rec_id, label, score), orders without lines being true singletons."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    entities = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").select(F.col("o_orderkey").alias("s1_id"), F.col("c_nationkey").alias("country"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("s1_id"), F.col("l_linenumber").alias("rec_id"))
    scored = lines.agg(F.max((F.col("l_returnflag") == "R").cast("int")).alias("label"), F.round(F.max("l_discount") * 10, 6).alias("score"))
    return entities, scored
