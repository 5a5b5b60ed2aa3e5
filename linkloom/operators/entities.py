"""Entities beside their candidates: manifest, lookups, placeholders, samples at full density, counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import blocking, sampling

#: Fixed value: the least first score with which a pair goes on to the second stage.
SURVIVES = 0.05


def manifest(views: DataFrame, truth: DataFrame | None = None, seed: int = 42) -> DataFrame:
    """(s1_id, split, country, truth_count) of the S1 rows of channel_views.

    With truth (s1_id, ids) the split is by country, core name and canonical address, so entities that
    look the same fall together; an entity without a truth row is an error. Without truth all are test.
    """
    s1 = views.where("src = 'S1'").select(F.col("entity_id").alias("s1_id"), "country", "name_core", "canonical")
    if truth is None:
        return s1.select("s1_id", F.lit("test").alias("split"), "country", F.lit(0).alias("truth_count"))
    counted = s1.join(truth.select("s1_id", F.size("ids").alias("n")), "s1_id", "left")
    missing = F.raise_error(F.concat(F.lit("no truth row for "), F.col("s1_id"))).cast("int")
    split = sampling.assign_split(F.concat_ws("\x1f", "country", "name_core", "canonical"), seed)
    return counted.select("s1_id", split.alias("split"), "country", F.coalesce("n", missing).alias("truth_count"))


def lookup(manifest_rows: DataFrame, truth: DataFrame, s1_id: str) -> Row:
    """One entity's manifest row with its ids; an entity that the manifest lacks is a KeyError."""
    found = manifest_rows.where(F.col("s1_id") == s1_id).join(truth.select("s1_id", "ids"), "s1_id", "left").first()
    if found is None:
        raise KeyError(s1_id)
    return found


def records_of(records: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records whose ids are among wanted (rec_id), each once."""
    return records.join(wanted.select(F.col("rec_id").alias("entity_id")), "entity_id", "left_semi")


def missed(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """The true pairs (s1_id, rec_id) that are no candidates."""
    return truth.select("s1_id", "rec_id").join(candidates.select("s1_id", "rec_id"), ["s1_id", "rec_id"], "left_anti")


def survivors(scored: DataFrame, least: float = SURVIVES, score: str = "p1") -> DataFrame:
    """The pairs that the second stage judges."""
    return scored.where(F.col(score) >= least)


def with_placeholders(entities: DataFrame, candidates: DataFrame) -> DataFrame:
    """The candidates (s1_id, strings, numbers and booleans), is_candidate true, and for each entity without
    any a row of blanks and zeros, is_candidate false. What entities have beside s1_id comes from them.
    Candidates are joined by shuffle: their file is far smaller than their rows in memory."""
    own = candidates.drop(*[c for c in entities.columns if c != "s1_id"])
    joined = entities.join(own.withColumn("is_candidate", F.lit(True)).hint("merge"), "s1_id", "left")

    def filled(field: T.StructField) -> Column:
        blank = F.lit("") if isinstance(field.dataType, T.StringType) else F.lit(0).cast(field.dataType)
        return F.when(F.col("is_candidate").isNull(), blank).otherwise(F.col(field.name)).alias(field.name)

    rest = [filled(f) for f in own.schema.fields if f.name != "s1_id"]
    return joined.select(*entities.columns, *rest, F.coalesce("is_candidate", F.lit(False)).alias("is_candidate"))


def density_sample(records: DataFrame, n: int, k: int | None = blocking.TOP_K, seed: int = 7) -> DataFrame:
    """The ranked candidates of n sampled entities among those of all: counts, ranks and shares are taken over
    every S1 entity and the whole pool first, so they are what they are when nothing is sampled."""
    ranked = blocking.ranked(blocking.key_evidence(records), k)
    chosen = sampling.sample_entities(records.where("src = 'S1'"), n, seed).select(F.col("entity_id").alias("s1_id"))
    return ranked.join(chosen, "s1_id", "left_semi")


def countries(records: DataFrame) -> DataFrame:
    """The distinct countries in order."""
    return records.select("country").distinct().orderBy("country")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Per country the rows of each table, 0 where a table has none."""
    tagged = reduce(DataFrame.unionByName, [t.select("country", F.lit(name).alias("of")) for name, t in tables.items()])
    return tagged.groupBy("country").agg(*[F.count_if(F.col("of") == name).alias(name) for name in tables])


def match_summary(entities: DataFrame, truth: DataFrame) -> DataFrame:
    """Share of entities without a match, mean and most matches an entity; pairs (s1_id, rec_id) are the truth."""
    counted = entities.select("s1_id").join(truth.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n")), "s1_id", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    total = F.count(F.lit(1))
    return counted.agg(F.round(F.try_divide(F.count_if(F.col("n") == 0), total), 6).alias("singleton_rate"), F.round(F.avg("n"), 6).alias("mean_matches"), F.max("n").alias("most_matches"))
