"""Plans of the linkage queries, read without running them: what may be broadcast.

Spark takes exploded rows to be as small as the rows they come from. At 0.1 GB of documents seven million
keys were broadcast for that, and the driver's memory ended the query."""

import re
import time

import pytest
from pyspark.sql import functions as F

from linkloom.operators import features
from linkloom.plans import catalogue
from linkloom.sources import fixtures

#: Queries whose candidates come from exploded keys.
KEYED = ["candidates_topk", "candidates_evidence", "inference_diagnostics", "candidate_statistics", "candidate_recall", "one_owner", "recall_at_k", "least_safe_k", "density_sample", "placeholder_candidates", "band_idf", "ratio_features", "set_partial_ratio", "stage1_features", "consensus_support", "consensus_support_ratio", "candidates_evidence_parts", "candidates_topk_parts", "house_number_profile", "number_features", "pair_model_oof"]


def broadcast_explosions(df):
    """The broadcasts of df's plan with an exploded table below that isn't aggregated first."""
    found = []

    def walk(node, above):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.initialPlan(), above)
        if name == "Generate" and above is not None:
            found.append(above)
        above = node.toString()[:300] if name == "BroadcastExchange" else None if "Aggregate" in name else above
        below = node.children()
        for i in range(below.size()):
            walk(below.apply(i), above)

    walk(df._jdf.queryExecution().executedPlan(), None)
    return found


@pytest.fixture
def unwritten(monkeypatch):
    """Only records are stored and nothing is fitted, so all that follows records is in the result's plan."""
    store = catalogue.stored
    monkeypatch.setattr(catalogue, "stored", lambda df, label: store(df, label) if label == "records" else df)
    monkeypatch.setattr(catalogue.models, "out_of_fold", lambda rows, make: rows.withColumn("p1", F.lit(0.0)))


@pytest.mark.parametrize("name", KEYED)
def test_exploded_keys_are_not_broadcast(spark, small, unwritten, name):
    assert broadcast_explosions(catalogue.QUERIES[name](spark, small)) == []


def test_records_are_joined_by_shuffle(spark):
    records = spark.sql("select * from values ('S1-1', array('1')), ('S2-2', array('1', '2')) as t(entity_id, numbers)")
    pair = features.paired(spark.sql("select 'S1-1' as s1_id, rec_id from values ('S2-2') as t(rec_id)"), records, ["numbers"])
    assert "Broadcast" not in pair._jdf.queryExecution().executedPlan().toString()
    assert [(r.a_numbers, r.b_numbers) for r in pair.collect()] == [(["1"], ["1", "2"])]


#: Queries that join the stored candidates, or records again.
JOINED = ["placeholder_candidates", "candidate_recall", "candidate_statistics", "band_idf", "consensus_support_ratio", "consensus_support", "recall_at_k", "least_safe_k", "pair_model_oof"]


def broadcast_rows(df):
    """The broadcasts of df's plan but those of few rows by definition: ranges, and aggregates of all rows or by country."""
    found = []

    def few(node):
        text, below = node.toString().split("\n")[0], node.children()
        if "Aggregate" in node.nodeName() and re.search(r"keys=\[(country#\d+)?\]", text) or node.nodeName() == "Range":
            return True
        return below.size() > 0 and all(few(below.apply(i)) for i in range(below.size()))

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.initialPlan())
        if node.nodeName() == "BroadcastExchange" and not few(node):
            found.append(node.toString()[:400])
        below = node.children()
        for i in range(below.size()):
            walk(below.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


@pytest.mark.parametrize("name", JOINED)
def test_candidates_and_records_are_not_broadcast(spark, small, monkeypatch, name):
    store = catalogue.stored
    monkeypatch.setattr(catalogue, "stored", lambda df, label: df if label == "pair-rows" else store(df, label))
    monkeypatch.setattr(catalogue.models, "out_of_fold", lambda rows, make: rows.withColumn("p1", F.lit(0.0)))
    assert broadcast_rows(catalogue.QUERIES[name](spark, small)) == []


def test_part_records_are_dealt_out(spark, small, monkeypatch):
    monkeypatch.setattr(catalogue, "stored", lambda df, label: df)
    assert fixtures.er_parts(spark, small).rdd.getNumPartitions() == 1
    assert catalogue._parts(spark, small).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1


def test_stored_leaves_no_shuffle_files(spark):
    """Over 1 GB of documents the key joins' 3 GB stayed on disk beside all that followed."""

    def files():
        return {f for f in spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString(" ").split() if "/shuffle_" in f}

    there = files()
    table = catalogue.stored(spark.range(1000).repartition(3, "id"), "test")
    for _ in range(50):
        if not files() - there:
            break
        time.sleep(0.1)
    assert not files() - there and table.count() == 1000
