"""Entity-level F-beta, threshold scans and reports. Every entity counts, with or without candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The scan's grid, and the finer one of the curve.
GRID = [round(0.30 + 0.05 * i, 2) for i in range(14)]
FINE_GRID = [round(0.05 + 0.02 * i, 2) for i in range(46)] + [0.97, 0.98, 0.99, 0.995]


def fbeta(n_true: Column, n_predicted: Column, hits: Column, beta: float = 0.5) -> Column:
    """1 if both are empty, 0 without hits, else (1 + b2) hits / (b2 n_true + n_predicted)."""
    if beta <= 0:
        raise ValueError("beta must be positive")
    b2 = beta * beta
    return F.when((n_true == 0) & (n_predicted == 0), 1.0).when(hits == 0, 0.0).otherwise((1 + b2) * hits / (b2 * n_true + n_predicted))


def entity_fbeta(truth: Column, predicted: Column, beta: float = 0.5) -> Column:
    """The same from two distinct arrays."""
    return fbeta(F.size(truth), F.size(predicted), F.size(F.array_intersect(truth, predicted)), beta)


def entity_counts(entities: DataFrame, scored: DataFrame, threshold: float, score: str = "score") -> DataFrame:
    """entities with nt, np and tp at one threshold, zeros for those without records."""
    counts = scored.groupBy("s1_id").agg(F.sum("label").alias("nt"), F.count_if(F.col(score) >= threshold).alias("np"), F.sum(F.when(F.col(score) >= threshold, F.col("label")).otherwise(0)).alias("tp"))
    return entities.join(counts, "s1_id", "left").na.fill(0, ["nt", "np", "tp"])


def macro_fbeta(counts: DataFrame, beta: float = 0.5) -> DataFrame:
    """One row per country: macro F, over singletons and others apart, and micro precision and recall."""
    f = fbeta(F.col("nt"), F.col("np"), F.col("tp"), beta)
    return counts.groupBy("country").agg(
        F.count(F.lit(1)).alias("entities"),
        F.round(F.avg(f), 6).alias("macro_f"),
        F.round(F.avg(F.when(F.col("nt") == 0, f)), 6).alias("singleton_f"),
        F.round(F.avg(F.when(F.col("nt") > 0, f)), 6).alias("linked_f"),
        F.round(F.try_divide(F.sum("tp"), F.sum("np")), 6).alias("precision"),
        F.round(F.try_divide(F.sum("tp"), F.sum("nt")), 6).alias("recall"),
    )


def threshold_scan(entities: DataFrame, scored: DataFrame, grid: list[float] | None = None, beta: float = 0.5) -> DataFrame:
    """(t, macro_f, predicted, hits, exact, singletons_right) at each threshold.

    An entity's result changes only at its own scores, so its records are ranked once and each entity
    is read at every threshold from counts per score step: one shuffle, no join with the grid.
    """
    grid = sorted(grid or GRID)
    aggs = [F.sum("label").alias("nt")]
    for i, t in enumerate(grid):
        over = F.col("score") >= t
        aggs += [F.count_if(over).alias(f"np{i}"), F.sum(F.when(over, F.col("label")).otherwise(0)).alias(f"tp{i}")]
    per = entities.select("s1_id").join(scored.groupBy("s1_id").agg(*aggs), "s1_id", "left").na.fill(0)
    sums = []
    for i in range(len(grid)):
        n, hit = F.col(f"np{i}"), F.col(f"tp{i}")
        sums += [F.avg(fbeta(F.col("nt"), n, hit, beta)).alias(f"f{i}"), F.sum(n).alias(f"sn{i}"), F.sum(hit).alias(f"st{i}"), F.count_if((n == hit) & (hit == F.col("nt"))).alias(f"ex{i}"), F.count_if((F.col("nt") == 0) & (n == 0)).alias(f"so{i}")]
    total = per.agg(*sums, F.count(F.lit(1)).alias("entities"), F.sum("nt").alias("links"), F.count_if(F.col("nt") == 0).alias("singletons"))
    rows = F.array(*[F.struct(F.lit(t).alias("t"), F.col(f"f{i}").alias("f"), F.col(f"sn{i}").alias("predicted"), F.col(f"st{i}").alias("hits"), F.col(f"ex{i}").alias("exact"), F.col(f"so{i}").alias("singletons_right")) for i, t in enumerate(grid)])
    return total.select(F.explode(rows).alias("r"), "entities", "links", "singletons").select("r.t", F.round("r.f", 6).alias("macro_f"), "r.predicted", "r.hits", "r.exact", "r.singletons_right", "entities", "links", "singletons")


def plateau(scan: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """The largest threshold whose score is within the tolerance of the best."""
    best = scan.agg(F.max("macro_f").alias("best"))
    return scan.join(F.broadcast(best)).where(F.col("macro_f") >= F.col("best") - tolerance).agg(F.max("t").alias("threshold"), F.max("best").alias("best"))


def threshold_curve(entities: DataFrame, scored: DataFrame, grid: list[float] | None = None) -> DataFrame:
    """A row per threshold of the fine grid, rates 0 where undefined."""
    scan = threshold_scan(entities, scored, grid or FINE_GRID)
    rate = lambda a, b: F.round(F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0)), 6)
    return scan.select("t", "macro_f", rate("exact", "entities").alias("exact_rate"), rate("hits", "predicted").alias("link_precision"), rate("hits", "links").alias("link_recall"), "predicted", "hits", rate("singletons_right", "singletons").alias("singleton_accuracy"))


def prefix_hits(scored: DataFrame) -> DataFrame:
    """scored with rank and true positives among the records of the entity down to each score."""
    order = Window.partitionBy("s1_id").orderBy(F.col("score").desc(), "rec_id")
    return scored.withColumns({"rank": F.row_number().over(order), "hits": F.sum("label").over(order.rowsBetween(Window.unboundedPreceding, 0))})


def metric_report(counts: DataFrame, beta: float = 0.5) -> DataFrame:
    """Overall (country null) and per country from entity counts: nulls where a rate is undefined."""
    f = fbeta(F.col("nt"), F.col("np"), F.col("tp"), beta)
    rated = counts.withColumns({"f": f, "single": F.col("nt") == 0, "right": (F.col("np") == F.col("tp")) & (F.col("tp") == F.col("nt"))})
    rate = lambda a, b: F.round(F.try_divide(a, b), 6)
    return rated.groupingSets([[], ["country"]], "country").agg(
        F.count(F.lit(1)).alias("entities"),
        F.round(F.avg("f"), 6).alias("macro_f"),
        F.round(F.avg(F.when(~F.col("single"), F.col("f"))), 6).alias("linked_macro_f"),
        rate(F.count_if("right"), F.count(F.lit(1))).alias("exact_rate"),
        rate(F.count_if(F.col("single") & (F.col("np") == 0)), F.count_if("single")).alias("singleton_accuracy"),
        rate(F.count_if(F.col("single") & (F.col("np") > 0)), F.count_if("single")).alias("singleton_false_rate"),
        F.sum("nt").alias("true_links"),
        F.sum("np").alias("predicted_links"),
        F.sum("tp").alias("hits"),
        rate(F.sum("tp"), F.sum("np")).alias("link_precision"),
        rate(F.sum("tp"), F.sum("nt")).alias("link_recall"),
    )


def candidate_recall(entities: DataFrame, candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """Recall of the candidates and the macro F that a perfect scorer would reach on them. Joins are by shuffle:
    candidates and truth are far smaller as files than in memory."""
    nt = truth.groupBy("s1_id").agg(F.count(F.lit(1)).alias("nt"))
    hits = candidates.join(truth.hint("merge"), ["s1_id", "rec_id"]).groupBy("s1_id").agg(F.count(F.lit(1)).alias("tp"))
    per = entities.select("s1_id").join(nt.hint("merge"), "s1_id", "left").join(hits.hint("merge"), "s1_id", "left").na.fill(0)
    f = fbeta(F.col("nt"), F.col("tp"), F.col("tp"))
    return per.agg(F.sum("nt").alias("links"), F.sum("tp").alias("recalled"), F.round(F.try_divide(F.sum("tp"), F.sum("nt")), 6).alias("recall"), F.round(F.avg(f), 6).alias("ceiling"))


def candidate_statistics(entities: DataFrame, candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """Per split and per split and country: entities, those with candidates, links, recalled, fully recalled,
    singletons and the ceiling. entities: (s1_id, split, country). Joins are by shuffle, as in candidate_recall."""
    nc = candidates.groupBy("s1_id").agg(F.count(F.lit(1)).alias("nc"))
    nt = truth.groupBy("s1_id").agg(F.count(F.lit(1)).alias("nt"))
    hits = candidates.join(truth.hint("merge"), ["s1_id", "rec_id"]).groupBy("s1_id").agg(F.count(F.lit(1)).alias("tp"))
    per = entities.join(nc.hint("merge"), "s1_id", "left").join(nt.hint("merge"), "s1_id", "left").join(hits.hint("merge"), "s1_id", "left").na.fill(0, ["nc", "nt", "tp"])
    f = fbeta(F.col("nt"), F.col("tp"), F.col("tp"))
    return per.groupingSets([["split"], ["split", "country"]], "split", "country").agg(
        F.count(F.lit(1)).alias("entities"), F.count_if(F.col("nc") > 0).alias("with_candidate"), F.sum("nc").alias("links"), F.sum("nt").alias("true_links"), F.sum("tp").alias("recalled"),
        F.count_if((F.col("nt") > 0) & (F.col("tp") == F.col("nt"))).alias("all_recalled"), F.count_if(F.col("nt") == 0).alias("singletons"), F.round(F.avg(f), 6).alias("oracle_f"),
    )


def loss_parts(counts: DataFrame, candidates_tp: DataFrame) -> DataFrame:
    """Per entity: ceiling minus result, false positives and false negatives. candidates_tp: (s1_id, ctp)."""
    joined = counts.join(candidates_tp, "s1_id", "left").na.fill(0, ["ctp"])
    ceiling = fbeta(F.col("nt"), F.col("ctp"), F.col("ctp"))
    got = fbeta(F.col("nt"), F.col("np"), F.col("tp"))
    return joined.select("s1_id", F.round(ceiling - got, 6).alias("loss"), (F.col("np") - F.col("tp")).alias("false_positives"), (F.col("nt") - F.col("tp")).alias("false_negatives"))
