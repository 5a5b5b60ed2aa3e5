"""Learned pair scoring with Spark's own learners."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import fold_of

#: Trees, learning rate, depth and least rows of a leaf of the three stages.
STAGES = {1: (250, 0.06, 6, 40), 2: (200, 0.05, 5, 30), 3: (300, 0.05, 5, 30)}


def boosted(features: list[str], stage: int = 1, trees: int | None = None, seed: int = 1, validation: str | None = None) -> Pipeline:
    n, rate, depth, least = STAGES[stage]
    learner = GBTClassifier(labelCol="label", featuresCol="features", weightCol="weight", maxIter=trees or n, stepSize=rate, maxDepth=depth, minInstancesPerNode=least, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed)
    if validation:
        learner.setValidationIndicatorCol(validation)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"), learner])


def logistic(features: list[str]) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), LogisticRegression(labelCol="label", featuresCol="features", weightCol="weight", maxIter=300)])


def balanced(rows: DataFrame) -> DataFrame:
    """rows with a weight that gives both classes the same sum."""
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n = sum(counts.values())
    weight = F.lit(1.0)
    for label, count in counts.items():
        weight = F.when(F.col("label") == label, n / (2.0 * count)).otherwise(weight)
    return rows.withColumn("weight", weight)


def scored(model: PipelineModel, rows: DataFrame, name: str = "p1") -> DataFrame:
    out = model.transform(rows)
    return out.select(*[c for c in rows.columns if c != name], vector_to_array("probability")[1].alias(name))


def out_of_fold(rows: DataFrame, make: Callable[[], Pipeline], folds: int = 3, group: str = "name", name: str = "p1") -> DataFrame:
    """Every row scored by a model that hasn't seen its group's fold."""
    dealt = rows.withColumn("fold", fold_of(F.col(group), folds))
    parts = [scored(make().fit(balanced(dealt.where(F.col("fold") != f))), dealt.where(F.col("fold") == f), name) for f in range(folds)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def pair_report(rows: DataFrame, score: str = "p1", at: float = 0.5) -> DataFrame:
    """Precision, recall and F0.5 of pairs at a threshold."""
    hit = F.col(score) >= at
    base = rows.agg(F.count_if(hit).alias("predicted"), F.sum("label").alias("positives"), F.count_if(hit & (F.col("label") == 1)).alias("hits"))
    p, r = F.try_divide("hits", "predicted"), F.try_divide("hits", "positives")
    return base.select("predicted", "positives", "hits", p.alias("precision"), r.alias("recall"), F.try_divide(1.25 * p * r, 0.25 * p + r).alias("f05"))


def passes_gate(report: DataFrame, least: float = 0.90) -> bool:
    """Whether the overall and every country's macro F reach the gate."""
    return report.where(F.col("macro_f") < least).limit(1).count() == 0


def chosen_variant(control: float, baseline: float, variants: dict[str, float], margin: float = 0.002) -> str | None:
    """The third stage's variant: the best that beats both the structural control and the baseline by the margin,
    else the control if it beats the baseline by it, else none."""
    better = {k: v for k, v in variants.items() if v >= control + margin and v >= baseline + margin}
    if better:
        return max(better, key=better.get)
    return "structural" if control >= baseline + margin else None


def selected_model(curves: DataFrame) -> DataFrame:
    """From (model, place, t, macro_f) the row of the best score, then the higher threshold; a later model wins
    only if strictly better."""
    return curves.orderBy(F.col("macro_f").desc(), "place", F.col("t").desc()).limit(1)
