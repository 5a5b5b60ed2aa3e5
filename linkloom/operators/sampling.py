"""Seeded choices by hashes of ids: reproducible in any engine and under any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import md5_int


def seeded(seed: int, *parts: Column) -> Column:
    """A hash of seed and parts in [0, 1)."""
    return md5_int(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts])) / F.lit(float(1 << 32))


def assign_split(key: Column, seed: int = 42, train: float = 0.8, calibration: float = 0.1, holdout: float = 0.1) -> Column:
    """train, calibration or holdout; equal keys always fall together."""
    if min(train, calibration, holdout) < 0 or abs(train + calibration + holdout - 1) > 1e-9:
        raise ValueError("fractions must be positive and sum to 1")
    u = seeded(seed, key)
    return F.when(u < train, "train").when(u < train + calibration, "calibration").otherwise("holdout")


def match_count_bin(n: Column) -> Column:
    return F.when(n < 0, F.raise_error(F.lit("negative count"))).when(n <= 1, n.cast("string")).when(n <= 3, "2-3").when(n <= 5, "4-5").otherwise("6+")


def sample_entities(entities: DataFrame, n: int, seed: int = 7) -> DataFrame:
    """n entities without replacement: those of the least hashes."""
    return entities.withColumn("_u", seeded(seed, F.col("entity_id"))).orderBy("_u", "entity_id").limit(n).drop("_u")


def closed_universe(records: DataFrame, n: int, seed: int = 7) -> DataFrame:
    """The sampled entities, all records that they own, and orphans at the rate of the sample."""
    s1 = records.where("src = 'S1'")
    chosen = sample_entities(s1, n, seed)
    rate = n / max(1, s1.count())
    owned = records.where("src <> 'S1'").join(chosen.select(F.col("entity_id").alias("owner_id")), "owner_id", "left_semi")
    orphans = records.where("src <> 'S1' and owner_id is null").where(seeded(seed + 1, F.col("entity_id")) < rate)
    return chosen.unionByName(owned).unionByName(orphans)


def class_capped(rows: DataFrame, cap: int, positive_share: float = 0.4, seed: int = 3) -> DataFrame:
    """At most cap rows, at most positive_share of them positive; room that a class doesn't use goes to the other."""
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    positives, negatives = counts.get(1, 0), counts.get(0, 0)
    take = min(positives, int(cap * positive_share))
    rest = min(negatives, cap - take)
    take = min(positives, cap - rest)
    order = Window.partitionBy("label").orderBy(seeded(seed, F.col("s1_id"), F.col("rec_id")), "s1_id", "rec_id")
    return rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= F.when(F.col("label") == 1, take).otherwise(rest)).drop("_n")


def fold_of(name: Column, folds: int = 3) -> Column:
    """Records of one normalised name share a fold."""
    return F.crc32(name.cast("binary")) % folds
