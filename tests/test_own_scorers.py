"""The queries by the operators' own string scores, against brute force over the scored pairs."""

from collections import defaultdict

import pandas as pd
from pyspark.sql import functions as F

from linkloom.functions import similarity as S
from linkloom.plans.catalogue import QUERIES


def test_ranked_pool_and_hard_negatives(spark, small):
    pairs = defaultdict(list)
    for r in QUERIES["channel_features"](spark, small).select("s1_id", "rec_id", "score").collect():
        pairs[r.s1_id].append((-r.score, r.rec_id))
    want = {(s, rec, place, -score) for s, found in pairs.items() for place, (score, rec) in enumerate(sorted(found)[:40], 1)}
    got = [(r.s1_id, r.rec_id, r.place, r.score) for r in QUERIES["ranked_pool_ratio"](spark, small).collect()]
    assert len(got) == len(want) and set(got) == want
    negatives = defaultdict(list)
    hard = QUERIES["hard_negatives_ratio"](spark, small).collect()
    true = {(r.s1_id, r.rec_id) for r in hard if r.label == 1}
    for s, rec, place, _ in sorted(want, key=lambda x: x[2]):
        if (s, rec) not in true:
            negatives[s].append((rec, place))
    assert {(r.s1_id, r.rec_id, r.place) for r in hard if r.label == 0} == {(s, *x) for s, found in negatives.items() for x in found[:3]}


def test_consensus_support(spark, small):
    rows = QUERIES["consensus_support_ratio"](spark, small).collect()
    name = {r.entity_id: r.name for r in QUERIES["norm_text"](spark, small).collect()}
    members = defaultdict(list)
    for r in rows:
        if r.p1 >= 0.5:
            members[r.country, r.s1_id].append((r.rec_id, r.p1))
    asked = sorted({(name[r.rec_id], name[m]) for r in rows for m, _ in members[r.country, r.s1_id] if m != r.rec_id})
    table = spark.createDataFrame(asked, "a string, b string").select("a", "b", S.token_set_ratio(F.col("a"), F.col("b")).alias("s"))
    score = {(r.a, r.b): int(r.s + 0.5) for r in table.collect()}  # the definition holds scores as whole numbers
    for r in rows:
        others = [(m, p) for m, p in members[r.country, r.s1_id] if m != r.rec_id]
        assert r.nconf_others == len(others)
        assert abs(r.bestn - max((score[name[r.rec_id], name[m]] * p for m, p in others), default=0.0)) < 1e-9


def test_consensus_support_scores_forms(spark, tmp_path, monkeypatch):
    """All pairs of 200 copies were scored, some 40,000 times name and address."""
    spark.range(200).selectExpr("id as doc_id", "'one two three four five six seven eight nine' as text", "'en' as lang").write.parquet(f"{tmp_path}/documents.parquet")
    scores = spark.sparkContext.accumulator(0)

    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        scores.add(len(a))
        return (a == b) * 100.0

    monkeypatch.setattr(S, "token_set_ratio", F.pandas_udf(alike, "double"))
    rows = QUERIES["consensus_support_ratio"](spark, str(tmp_path)).collect()
    assert len(rows) > 150 and max(r.sup for r in rows) > 100
    assert 0 < scores.value < 200
