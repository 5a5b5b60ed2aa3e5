"""Contracts of result lists, as DataFrames of violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_ids(value: Column) -> Column:
    """Ids of a comma-separated list, trimmed; blank is none. An empty part or a repeated id is an error."""
    parts = F.transform(F.split(value, ","), lambda x: F.trim(x))
    blank = F.trim(F.coalesce(value, F.lit(""))) == ""
    bad = F.exists(parts, lambda x: x == "") | (F.size(F.array_distinct(parts)) < F.size(parts))
    return F.when(blank, F.array().cast("array<string>")).when(bad, F.raise_error(F.concat(F.lit("malformed id list: "), value)).cast("array<string>")).otherwise(parts)


def list_violations(entities: DataFrame, matches: DataFrame, candidates: DataFrame, pool_ids: DataFrame | None = None) -> DataFrame:
    """(s1_id, problem): entities of one side missing in the other or repeated; repeated or wrongly prefixed ids;
    matches outside the candidates; ids that the pool lacks. Inputs: (s1_id, ids) with comma lists."""
    ids = lambda c: F.filter(F.split(c, ","), lambda x: x != "")
    m, c = matches.select("s1_id", ids("ids").alias("m")), candidates.select("s1_id", ids("ids").alias("c"))
    known = entities.select("s1_id")
    problems = [
        known.join(m, "s1_id", "left_anti").select("s1_id", F.lit("no match row").alias("problem")),
        m.join(known, "s1_id", "left_anti").select("s1_id", F.lit("unknown entity").alias("problem")),
        known.join(c, "s1_id", "left_anti").select("s1_id", F.lit("no candidate row").alias("problem")),
        m.groupBy("s1_id").count().where("count > 1").select("s1_id", F.lit("repeated entity").alias("problem")),
        m.where(F.size(F.array_distinct("m")) < F.size("m")).select("s1_id", F.lit("repeated id").alias("problem")),
        m.where(F.exists("m", lambda x: ~(F.startswith(x, F.lit("S2-")) | F.startswith(x, F.lit("S3-"))))).select("s1_id", F.lit("wrong prefix").alias("problem")),
        m.join(c, "s1_id").where(F.size(F.array_except("m", "c")) > 0).select("s1_id", F.lit("match is no candidate").alias("problem")),
    ]
    if pool_ids is not None:
        listed = m.select("s1_id", F.explode("m").alias("entity_id"))
        problems.append(listed.join(pool_ids.select("entity_id"), "entity_id", "left_anti").select("s1_id", F.lit("unknown id").alias("problem")).distinct())
    out = problems[0]
    for p in problems[1:]:
        out = out.unionByName(p)
    return out


def list_counters(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """rows, empty_matches, matched_links, candidate_links."""
    size = F.when(F.col("ids") == "", 0).otherwise(F.size(F.split("ids", ",")))
    m = matches.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("ids") == "").alias("empty_matches"), F.sum(size).cast("long").alias("matched_links"))
    return m.join(F.broadcast(candidates.agg(F.sum(size).cast("long").alias("candidate_links"))))


def aligned_counts(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """nt, np, tp of two tables (pos, s1_id, ids) that must agree row by row: any difference is an error."""
    t, p = truth.select(F.col("pos"), F.col("s1_id").alias("ts"), F.col("ids").alias("ti")), predicted.select(F.col("pos"), F.col("s1_id").alias("ps"), F.col("ids").alias("pi"))
    both = t.join(p, "pos", "full")
    ids = lambda c: F.filter(F.split(c, ","), lambda x: x != "")
    same = F.when(F.col("ts").eqNullSafe(F.col("ps")) & F.col("ts").isNotNull(), F.col("ts")).otherwise(F.raise_error(F.concat(F.lit("rows differ at position "), F.col("pos").cast("string"))).cast(t.schema["ts"].dataType))
    return both.select(same.alias("s1_id"), F.size(ids("ti")).alias("nt"), F.size(ids("pi")).alias("np"), F.size(F.array_intersect(ids("ti"), ids("pi"))).alias("tp"))


def keyed_counts(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """The same in any order by s1_id; entities that only one side has come out with a null count."""
    ids = lambda c: F.filter(F.split(c, ","), lambda x: x != "")
    t, p = truth.select("s1_id", ids("ids").alias("t")), predicted.select("s1_id", ids("ids").alias("p"))
    return t.join(p, "s1_id", "full").select("s1_id", F.size("t").alias("nt"), F.size("p").alias("np"), F.size(F.array_intersect("t", "p")).alias("tp"))


def owner_violations(truth: DataFrame) -> DataFrame:
    """Pool ids with more than one owner."""
    return truth.groupBy("rec_id").agg(F.count_distinct("s1_id").alias("owners")).where("owners > 1")
