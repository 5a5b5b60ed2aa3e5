"""Similarity, blocking, metrics, decisions, contracts and sources on small cases."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from linkloom.functions import similarity as S
from linkloom.operators import blocking, consensus, decide, features, metrics, models, sampling, validate
from linkloom.sources import tables
from linkloom.streaming.pool_stream import link_stream


def textbook_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_lcs_equals_textbook():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ("".join(rng.choice("abcd ") for _ in range(rng.randrange(90))) for _ in "ab")
        assert S.lcs_length(a, b) == textbook_lcs(a, b)


def test_scores():
    assert S._ratio("", "") == 100 and S._ratio("ab", "") == 0 and S._ratio("abcd", "abed") == 75
    assert S._token_set("a b c", "c b") == 100 and S._token_set("", "a") == 0
    assert S._partial("main", "12 main street") == 100 and S._partial("", "") == 100


RECORDS = [
    ("S1-1", "Northwind Glass Works LLC", "48 Harbor Ln", "US", "S1"), ("S1-2", "River Bakery", "7 Lake Road", "US", "S1"), ("S1-3", "Quiet Cafe", "", "US", "S1"),
    ("S2-1", "northwind glass works", "48 Harbor Lane", "US", "S2"), ("S3-1", "Northwind Glass", "48 Harbor Ln", "US", "S3"), ("S2-2", "River Bakery", "", "US", "S2"), ("S2-9", "Nobody", "5 Nowhere", "US", "S2"),
]


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame(RECORDS, "entity_id string, business_name string, business_address string, country string, src string")


def test_blocking_finds_the_true_pairs(records):
    top = blocking.ranked(blocking.key_evidence(blocking.prepared(records))).collect()
    pairs = {(r.rec_id, r.s1_id) for r in top if r.krank == 0}
    assert pairs == {("S2-1", "S1-1"), ("S3-1", "S1-1"), ("S2-2", "S1-2")}
    assert all(0 < r.kshare <= 1 and 0 <= r.kgap <= 1 for r in top)


def test_channel_keys_of_too_many_records_are_dropped(spark):
    rows = [("S1-1", "Fern Cafe", "1 Elm Road", "US", "S1"), *[(f"S2-{i}", "Fern Cafe", f"{i} Oak Road", "US", "S2") for i in range(2, 8)]]
    views = blocking.channel_views(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string, src string"))
    assert blocking.channel_candidates(views, 6, 0).count() == 6 and blocking.channel_candidates(views, 5, 0).count() == 0


def test_channels_equal_all_pairs(records):
    views = blocking.channel_views(records)
    got = {(r.s1_id, r.rec_id): r["mask"] for r in blocking.channel_candidates(views).collect()}
    keys = {}
    for r in blocking.channel_keys(views).collect():
        keys.setdefault(r.entity_id, set()).add((r.bit, r.key))
    want = {}
    for a in RECORDS[:3]:
        for b in RECORDS[3:]:
            if common := keys[a[0]] & keys[b[0]]:
                want[a[0], b[0]] = sum({bit for bit, _ in common})
    assert got == want and got["S1-1", "S2-1"] & 2


def test_heuristic_prefers_agreeing_numbers(spark):
    rows = [("S1-1", "Quill Paper Mill", "31 Cedar Avenue", "US", "S1"), ("S2-1", "Quill Paper Mill", "31 Cedar Ave", "US", "S2"), ("S2-2", "Quill Paper Mill", "77 Birch Avenue", "US", "S2"), ("S2-3", "QUILL PAPER MILL SAS", "31 Cedar Avenue", "US", "S2")]
    views = blocking.channel_views(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string, src string"))
    columns = ["name_view", "name_fold", "name_core", "canonical", "address_fold", "name_numbers", "address_numbers", "scripts", "src"]
    pair = features.channel_features(features.paired(blocking.channel_candidates(views), views, columns))
    score = {r.rec_id: r.s for r in pair.select("rec_id", features.heuristic_score(pair).alias("s")).collect()}
    assert score["S2-1"] > score["S2-2"] and score["S2-3"] > 0.8
    assert len(features.STAGE1) == len(set(features.STAGE1)) == 32 and features.STAGE1[9:17] == ["ats", "ar", "apr", "numj", "numeq", "aempty", "lna", "isS2"]


def test_consensus(spark, records):
    scored = spark.createDataFrame([("US", "S1-1", "S2-1", 0.9), ("US", "S1-1", "S3-1", 0.6), ("US", "S1-2", "S2-2", 0.9), ("US", "S1-2", "S2-9", 0.1)], "country string, s1_id string, rec_id string, p1 double")
    got = {r.rec_id: r for r in consensus.with_consensus(scored, blocking.prepared(records)).collect()}
    assert got["S2-1"].nconf_others == 1 and got["S2-1"].numagree == 1 and got["S2-1"].besta > 0
    assert got["S2-2"].nconf_others == 0 and got["S2-2"].bestn == 0 and got["S2-9"].nconf_others == 1


SCORED = "country string, s1_id string, rec_id string, p1 double"
MEMBER = "entity_id string, name string, address string, numbers array<string>, src string"


@pytest.mark.parametrize("deal", [2, 100])
def test_consensus_against_brute_force(spark, monkeypatch, deal):
    """Copies, forms dealt over tasks, equal scores, no confident record, blank addresses, an id that records repeat, a record not there."""
    monkeypatch.setattr(consensus, "DEAL", deal)
    texts = [("acme tool works", "1 main street"), ("acme tool works", ""), ("acme tools", "2 main street"), ("zeta", "9 side road")]
    records = [(f"R{i}", *texts[i % 7 % 4], [texts[i % 7 % 4][1][:1]] if i % 3 else [], f"S{2 + i % 5 % 2}") for i in range(40)]
    records += [("R3", "acme tool works", "1 main street", ["1"], "S2"), ("R3", "acme tools", "1 main street", ["1"], "S3"), ("R8", *records[8][1:])]
    scored = [("US", f"E{i % 3}", f"R{i}", (0.5, 0.9, 0.9, 0.2, 0.7)[i % 5]) for i in range(42)] + [("US", "E3", "R1", 0.2), ("US", "E3", "R2", 0.8), ("FR", "E0", "R5", 0.9), ("US", "E4", "R8", 0.9)]
    want = {}
    for c, e, a, _ in scored:
        pairs = [(x, y, pm) for c2, e2, m, pm in scored if (c2, e2) == (c, e) and m != a and pm >= 0.5 for x in records if x[0] == a for y in records if y[0] == m]
        like = lambda p, q: 100 * len({*p.split()} & {*q.split()}) / len({*p.split()} | {*q.split()}) if p and q else 0.0
        of = [(like(x[1], y[1]), like(x[2], y[2]), x, y, pm) for x, y, pm in pairs]
        sup = [x[4] != y[4] for sn, sa, x, y, _ in of if sa >= 90 and sn >= 80]
        others = sum((c2, e2) == (c, e) and m != a and pm >= 0.5 for c2, e2, m, pm in scored)
        want[c, e, a] = (others, len(sup), sum(sup), max((sn * pm for sn, *_, pm in of), default=0), max((sa * pm for _, sa, *_, pm in of), default=0), sum(bool(x[3]) and x[3] == y[3] for *_, x, y, _ in of))
    found = consensus.with_consensus(spark.createDataFrame(scored, SCORED), spark.createDataFrame(records, MEMBER), score=consensus.jaccard_100).collect()
    assert len(found) == len(want) == len(scored)
    for r in found:
        assert (r.nconf_others, r.sup, r.cross, r.bestn, r.besta, r.numagree) == pytest.approx(want[r.country, r.s1_id, r.rec_id]), r


def test_consensus_compares_forms_and_shuffles_no_pairs(spark):
    """An entity of 600 copies made 359,400 pairs, which were shuffled with their texts."""
    scores = spark.sparkContext.accumulator(0)

    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        scores.add(len(a))
        return (a == b) * 100.0

    records = spark.range(600).select(F.concat(F.lit("R"), "id").alias("entity_id"), F.lit("acme").alias("name"), F.lit("1 main street").alias("address"), F.array(F.lit("1")).alias("numbers"), F.lit("S2").alias("src"))
    scored = records.select(F.lit("US").alias("country"), F.lit("E").alias("s1_id"), F.col("entity_id").alias("rec_id"), F.lit(0.9).alias("p1"))
    out = consensus.with_consensus(scored, records, score=F.pandas_udf(alike, "double"))
    assert {(r.nconf_others, r.sup, r.cross, r.bestn, r.besta, r.numagree) for r in out.collect()} == {(599, 599, 0, 90.0, 90.0, 599)}
    assert 0 < scores.value <= 4


@pytest.mark.parametrize(("nt", "np", "tp", "want"), [(0, 0, 0, 1), (0, 1, 0, 0), (2, 0, 0, 0), (2, 3, 2, 5 / 7), (2, 1, 1, 5 / 6)])
def test_fbeta(spark, nt, np, tp, want):
    assert abs(spark.range(1).select(metrics.fbeta(F.lit(nt), F.lit(np), F.lit(tp)).alias("f")).first().f - want) < 1e-12


def test_macro_counts_every_entity(spark):
    entities = spark.createDataFrame([("a", "US"), ("b", "US")], "s1_id string, country string")
    scored = spark.createDataFrame([("a", "x", 1, 0.9), ("a", "y", 1, 0.1)], "s1_id string, rec_id string, label int, score double")
    assert abs(metrics.macro_fbeta(metrics.entity_counts(entities, scored, 0.5)).first().macro_f - 11 / 12) < 1e-6
    with pytest.raises(ValueError):
        metrics.fbeta(F.lit(1), F.lit(1), F.lit(1), 0)


def test_lists_and_contracts(spark):
    entities = spark.createDataFrame([("S1-1",), ("S1-2",)], "s1_id string")
    links = spark.createDataFrame([("S1-1", "S2-1", 0.5), ("S1-1", "S3-1", 0.9)], "s1_id string, rec_id string, score double")
    lists = decide.entity_lists(entities, links, "score")
    assert sorted(map(tuple, lists.collect())) == [("S1-1", "S3-1,S2-1"), ("S1-2", "")]
    assert validate.list_violations(entities, lists, lists).count() == 0
    bad = spark.createDataFrame([("S1-1", "S2-1,S2-1"), ("S1-3", "X-1")], "s1_id string, ids string")
    problems = {(r.s1_id, r.problem) for r in validate.list_violations(entities, bad, lists, spark.createDataFrame([("S2-1",)], "entity_id string")).collect()}
    assert problems == {("S1-2", "no match row"), ("S1-3", "unknown entity"), ("S1-1", "repeated id"), ("S1-3", "wrong prefix"), ("S1-3", "unknown id")}
    with pytest.raises(Exception, match="rows differ"):
        validate.aligned_counts(lists.withColumn("pos", F.lit(1)).limit(1), bad.withColumn("pos", F.lit(2)).limit(1)).collect()
    with pytest.raises(Exception, match="malformed"):
        bad.select(validate.parse_ids(F.col("ids"))).collect()


def test_splits_and_bins(spark):
    with pytest.raises(ValueError):
        sampling.assign_split(F.lit("x"), 1, 0.7, 0.2, 0.2)
    got = [r.b for r in spark.createDataFrame([(i,) for i in (0, 1, 2, 3, 4, 5, 6, 11)], "n int").select(sampling.match_count_bin(F.col("n")).alias("b")).collect()]
    assert got == ["0", "1", "2-3", "2-3", "4-5", "4-5", "6+", "6+"]


def test_tsv_round_trip(spark, tmp_path):
    path = tmp_path / "s1.tsv"
    path.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-2\tA "quoted\\ name\t\tUS\nS1-1\tÜ\t1 St\t\n', encoding="utf-8")
    df = tables.read_tsv(spark, str(path))
    assert [tuple(r) for r in df.collect()] == [("S1-2", 'A "quoted\\ name', "", "US"), ("S1-1", "Ü", "1 St", "")]
    lists = tables.empty_lists(tables.positioned(df))
    tables.write_lists(lists, str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_text() == "source1_entity_id\tmatched_entity_ids\nS1-2\t\nS1-1\t\n"
    with pytest.raises(Exception, match="exists"):
        tables.write_lists(lists, str(tmp_path / "out"))
    with pytest.raises(ValueError, match="header"):
        tables.read_tsv(spark, str(path), tables.TRUTH)
    profile = {r.country: r for r in tables.profile(df, "S1-").collect()}
    assert profile["<EMPTY>"].rows == 1 and profile["US"].blank_addresses == 1
    assert tables.cached_parquet(spark, str(path), str(tmp_path / "c")).count() == tables.cached_parquet(spark, "gone", str(tmp_path / "c")).count() == 2
    tables.write_json({"a": 1}, str(tmp_path / "r.json"))
    with pytest.raises(FileExistsError):
        tables.write_json({}, str(tmp_path / "r.json"))


def test_pairs_are_pruned_at_the_scan(spark, tmp_path):
    rows = spark.createDataFrame([("a", "b", "train", True, 0.5, "US"), ("a", "c", "holdout", True, 0.25, "IN")], "s1_id string, rec_id string, split string, is_candidate boolean, score double, country string")
    tables.write_pairs(rows, str(tmp_path / "p"))
    got = tables.read_pairs(spark, str(tmp_path / "p"), ["s1_id", "score"], "train")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert got.collect()[0].score == 0.5 and "EqualTo(split,train)" in plan and "rec_id" not in plan.split("ReadSchema")[1]


def test_out_of_fold_model_learns(spark):
    rng = random.Random(2)
    rows = [(f"n{i % 40}", float(x := rng.random()), int(x > 0.5)) for i in range(400)]
    df = spark.createDataFrame(rows, "name string, x double, label int")
    out = models.out_of_fold(df, lambda: models.logistic(["x"]))
    report = models.pair_report(out).first()
    assert out.count() == 400 and report.f05 > 0.9
    assert models.chosen_variant(0.93, 0.92, {"e5": 0.931}) == "structural" and models.chosen_variant(0.9, 0.9, {"e5": 0.91}) == "e5" and models.chosen_variant(0.9, 0.9, {}) is None


def test_stream_equals_batch(spark, records, tmp_path):
    pool = records.where("src <> 'S1'")
    pool.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(pool.schema).parquet(str(tmp_path / "in"))
    link_stream(stream, records.where("src = 'S1'"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    batch = blocking.ranked(blocking.key_evidence(blocking.prepared(records)))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.rec_id, r.s1_id, r.krank) for r in got.collect()} == {(r.rec_id, r.s1_id, r.krank) for r in batch.collect()}
