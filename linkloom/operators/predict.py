"""From a stored model and candidate rows to both result lists."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..sources import tables
from . import decide, models, validate


def save_model(spark: SparkSession, model: PipelineModel, path: str, meta: dict) -> None:
    """A fitted pipeline and what is to be known about it, such as features and threshold."""
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    return PipelineModel.load(f"{path}/model"), json.loads(spark.read.text(f"{path}/meta").first()[0])


def predict_lists(entities: DataFrame, scored: DataFrame, threshold: float, matches_path: str, candidates_path: str, score: str = "score", overwrite: bool = False) -> dict:
    """Writes the matches (scores from the threshold on) and the candidates of all entities (pos, s1_id), ids by
    (-score, id), in the order of pos, and returns their counters."""
    matches = decide.entity_lists(entities, scored.where(scored[score] >= threshold), score)
    candidates = decide.entity_lists(entities, scored, score)
    order = entities.select("pos", "s1_id")
    tables.write_lists(order.join(matches, "s1_id"), matches_path, overwrite=overwrite)
    tables.write_lists(order.join(candidates, "s1_id"), candidates_path, "candidate_entity_ids", overwrite)
    return validate.list_counters(matches, candidates).first().asDict()


def predict(entities: DataFrame, rows: DataFrame, path: str, matches_path: str, candidates_path: str) -> dict:
    """predict_lists of candidate rows by a stored model; its meta names the threshold."""
    model, meta = load_model(rows.sparkSession, path)
    return predict_lists(entities, models.scored(model, rows, "score"), meta["threshold"], matches_path, candidates_path)
