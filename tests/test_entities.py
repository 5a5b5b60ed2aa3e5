"""Manifest, lookups, placeholders, samples at full density, stored models and both lists on small cases."""

import pytest
from pyspark.sql import functions as F

from linkloom.operators import blocking, entities, models, predict

ROWS = [
    ("S1-1", "Tall Pine Books", "4 Mill Road", "US", "S1"), ("S1-2", "tall pine books", "4 Mill Rd", "US", "S1"), ("S1-3", "Blue Kite", "9 Hill Street", "FR", "S1"),
    ("S2-1", "Tall Pine Books", "4 Mill Rd", "US", "S2"), ("S3-1", "Blue Kite", "9 Hill St", "FR", "S3"),
]


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame(ROWS, "entity_id string, business_name string, business_address string, country string, src string")


def truth_of(spark, rows):
    return spark.createDataFrame(rows, "s1_id string, ids array<string>")


def test_manifest(spark, records):
    views = blocking.channel_views(records)
    truth = truth_of(spark, [("S1-1", ["S2-1"]), ("S1-2", []), ("S1-3", ["S3-1", "S3-2"])])
    found = entities.manifest(views, truth)
    rows = {r.s1_id: r for r in found.collect()}
    assert {k: r.truth_count for k, r in rows.items()} == {"S1-1": 1, "S1-2": 0, "S1-3": 2}
    assert rows["S1-1"].split == rows["S1-2"].split  # the same core name and canonical address
    assert {(r.split, r.truth_count) for r in entities.manifest(views).collect()} == {("test", 0)}
    with pytest.raises(Exception, match="no truth row for S1-3"):
        entities.manifest(views, truth.where("s1_id <> 'S1-3'")).collect()
    assert entities.lookup(found, truth, "S1-3").ids == ["S3-1", "S3-2"]
    with pytest.raises(KeyError):
        entities.lookup(found, truth, "S1-9")


def test_missed_and_records_of(spark, records):
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-3", "S3-1"), ("S1-2", "S3-1")], "s1_id string, rec_id string")
    left = entities.missed(pairs, pairs.where("s1_id = 'S1-1'"))
    assert {tuple(r) for r in left.collect()} == {("S1-3", "S3-1"), ("S1-2", "S3-1")}
    assert [r.entity_id for r in entities.records_of(records, left).collect()] == ["S3-1"]


def test_placeholders(spark):
    who = spark.createDataFrame([("a", "US"), ("b", "FR")], "s1_id string, country string")
    pairs = spark.createDataFrame([("a", "r1", "US", 0.5, None), ("a", "r2", "US", 0.1, True)], "s1_id string, rec_id string, country string, score double, hit boolean")
    out = {tuple(r) for r in entities.with_placeholders(who, pairs).select("s1_id", "country", "rec_id", "score", "hit", "is_candidate").collect()}
    assert out == {("a", "US", "r1", 0.5, None, True), ("a", "US", "r2", 0.1, True, True), ("b", "FR", "", 0.0, False, False)}
    assert entities.with_placeholders(who, pairs.where("false")).where("not is_candidate").count() == 2


def test_density_sample_keeps_the_counts_of_all(records):
    prepared = blocking.prepared(records)
    whole = {(r.s1_id, r.rec_id): (r.ncand_rec, r.krank, r.kshare) for r in blocking.ranked(blocking.key_evidence(prepared)).collect()}
    some = {(r.s1_id, r.rec_id): (r.ncand_rec, r.krank, r.kshare) for r in entities.density_sample(prepared, 1).collect()}
    assert all(whole[k] == v for k, v in some.items()) and len({k[0] for k in some}) <= 1
    assert {(r.s1_id, r.rec_id) for r in entities.density_sample(prepared, 3).collect()} == set(whole)
    assert whole[("S1-1", "S2-1")][0] == 2


def test_survivors_and_counts(spark, records):
    scored = spark.createDataFrame([("a", 0.049), ("b", 0.05), ("c", None)], "s1_id string, p1 double")
    assert [r.s1_id for r in entities.survivors(scored).collect()] == ["b"]
    assert [r.country for r in entities.countries(records).collect()] == ["FR", "US"]
    s1, pool = records.where("src = 'S1'"), records.where("src <> 'S1'")
    assert {tuple(r) for r in entities.table_counts({"s1": s1, "pool": pool.where("country = 'US'")}).collect()} == {("US", 2, 1), ("FR", 1, 0)}
    links = spark.createDataFrame([("S1-1", "x"), ("S1-1", "y")], "s1_id string, rec_id string")
    assert tuple(entities.match_summary(s1.select(F.col("entity_id").alias("s1_id")), links).first()) == (0.666667, 0.666667, 2)


def test_stored_model_gives_both_lists(spark, tmp_path):
    rows = spark.createDataFrame([(f"e{i % 4}", f"r{i:02}", i % 2, float(i % 2) + i / 100) for i in range(40)], "s1_id string, rec_id string, label int, x double")
    model = models.logistic(["x"]).fit(models.balanced(rows))
    predict.save_model(spark, model, f"file://{tmp_path}/m", {"threshold": 0.5})
    who = spark.createDataFrame([(i, f"e{i}") for i in range(5)], "pos long, s1_id string")
    counters = predict.predict(who, rows, f"file://{tmp_path}/m", f"file://{tmp_path}/matches", f"file://{tmp_path}/candidates")
    assert counters["rows"] == 5 and counters["candidate_links"] == 40 and counters["empty_matches"] == 3 and counters["matched_links"] == 20
    written = spark.read.options(sep="\t", header=True).csv(f"file://{tmp_path}/matches").collect()
    assert [r[0] for r in written] == [f"e{i}" for i in range(5)] and written[1][1].split(",")[0] == "r37"
