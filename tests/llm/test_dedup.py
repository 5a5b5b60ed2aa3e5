"""Exact and near duplicates against brute force."""

import random
import re
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import exact_dedup, near_dedup, queries
from linkloom.llm.near_dedup import NearConfig

SCHEMA = "doc_id long, text string, keep_id string, key long"


def edge_rows():
    rows = [(1, "a b  c"), (2, "abc"), (3, " a\tbc\n"), (4, None), (5, ""), (6, " \n"), (7, "x"), (7, "x"), (8, "x "), (None, "no id"), (None, "no id"), (9, "noid"), (10, "ABC"), (11, "abc"), (12, "é"), (13, "é")]
    return rows + [(100 + i, "hot hot" if i % 3 else "hothot") for i in range(60)]


def brute_exact(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc_id, text or ""))
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        for doc_id, _ in members:
            out.append((doc_id or -1, best[0] or -1, len(members), sha256(norm.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("bits", [62, 3])
def test_exact_with_and_without_collisions(spark, bits):
    df = spark.createDataFrame([(*r, "clash", 0) for r in edge_rows()], SCHEMA).repartition(5)
    got = exact_dedup.exact_duplicates(df, hash_bits=bits, bucket_keys=2).collect()
    assert sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.text_sha256) for r in got) == brute_exact(edge_rows())
    kept = defaultdict(int)
    for r in got:
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1}


def test_exact_result_comes_from_the_chains(spark):
    """With a comparison that finds all bytes of a key equal, texts of one key become one group."""
    df = spark.createDataFrame([(*r, "clash", 0) for r in edge_rows()], SCHEMA).repartition(5)
    got = exact_dedup.exact_duplicates(df, hash_bits=1, bucket_keys=2, same=lambda a, b: True).collect()
    assert sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.text_sha256) for r in got) != brute_exact(edge_rows())


def test_keyed_join_splits_hot_keys(spark, monkeypatch):
    from linkloom.llm import shared

    monkeypatch.setattr(shared, "HOT_ROWS", 20)
    rows = shared.written(spark.range(400).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN null ELSE id END AS k"), "test-rows")
    table = spark.range(0, 500, 2).selectExpr("id AS k", "id * 10 AS v").unionByName(spark.createDataFrame([(7, 70)], "k long, v long"))
    assert [r.k for r in shared.hot_keys(rows, "k").collect()] == [7]
    for how in ("inner", "left"):
        got = sorted((r.id, -1 if r.v is None else r.v) for r in shared.keyed_join(rows, table, "k", how).collect())
        assert got == sorted((r.id, -1 if r.v is None else r.v) for r in rows.join(table, "k", how).collect())


def test_rows_without_id_meet_their_own_class_only(spark):
    """Many rows without an id, each with a text of its own, are one read each, not one a class."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(400)}" for _ in range(60)]
    texts = [" ".join([*base[:k], f"x{k}", *base[k:]]) for k in range(60)] * 2
    df = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string").withColumn("n", F.monotonically_increasing_id())
    got = near_dedup.near_duplicates(df, NearConfig(shingle_words=2))
    rows = got.collect()
    assert len(rows) == 120 and {r.component_id for r in rows} == {None}
    assert near_dedup.without_near_copies(df, NearConfig(shingle_words=2)).count() == 1


def test_exact_rows_that_stay(spark):
    df = spark.createDataFrame([(*r, "clash", i) for i, r in enumerate(edge_rows())], SCHEMA)
    out = exact_dedup.without_copies(df)
    assert out.columns == df.columns
    assert sorted(re.sub(r"\s", "", r.text or "") for r in out.collect()) == sorted({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in edge_rows()})
    assert exact_dedup.without_copies(df.limit(0)).count() == 0


def test_directory_doubles_and_keeps_key_order():
    rng = np.random.default_rng(4)
    cells = rng.integers(0, 30, 256)
    cells[7] = 500
    d = exact_dedup.Directory.grown(cells, 40)
    assert len(d.bucket) == 1 << d.depth and (np.diff(d.bucket) >= 0).all() and set(d.bucket) == set(range(len(d.local)))
    width = 256 >> d.depth
    sums = np.bincount(np.repeat(d.bucket, width), weights=cells)
    assert all(s <= 40 or d.local[b] == 8 for b, s in enumerate(sums))


def brute_components(rows, words, numerator, denominator):
    sets = []
    for _, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    root = [*range(len(rows))]

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and denominator * both >= numerator * (len(sets[i]) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), 1 << 60), doc_id)
    return sorted((doc_id, len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(rows))


def near_rows():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(25):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 8, 30, 120]))]
        for _ in range(rng.choice([1, 3, 9])):
            changed = list(words)
            for _ in range(rng.randrange(0, 1 + len(words) // 9)):
                changed[rng.randrange(len(changed))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(changed).title() if base % 2 else "\n".join(changed)))
    chain = [rng.choice(vocabulary) for _ in range(80)]
    for k in range(14):  # each like the next, the ends unlike
        chain[5 * k : 5 * k + 3] = [f"new{k}a", f"new{k}b", f"new{k}c"]
        rows.append((len(rows), " ".join(chain)))
    return rows + [(len(rows) + i, t) for i, t in enumerate([None, "", "  ", "one", "ONE", "one two", "x" * 5000])]


@pytest.mark.parametrize("words", [2, 5])
def test_near_components(spark, words):
    rows = near_rows()
    df = spark.createDataFrame([(*r, "clash", 0) for r in rows], SCHEMA).repartition(3)
    got = near_dedup.near_duplicates(df, NearConfig(shingle_words=words))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute_components(rows, words, 4, 5)


def test_small_tiles_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "TILE", 3)
    monkeypatch.setattr(near_dedup, "TILE_SHINGLES", 200)
    rows = near_rows()
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), NearConfig(shingle_words=2))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute_components(rows, 2, 4, 5)


def test_near_edges_and_rows_that_stay(spark):
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (None, "p q r"), (8, None), (9, ""), (2, "A b c d e f"), (3, "other words in this one here")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = near_dedup.near_duplicates(df)
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got.collect()) == sorted([("3", "2"), ("3", "2"), ("None", "2"), ("None", "None"), ("8", "8"), ("9", "9"), ("2", "2"), ("3", "3")])
    kept = near_dedup.without_near_copies(df)
    assert sorted(str(r.text) for r in kept.collect()) == sorted(["A b c d e f", "p q r", "None", "", "other words in this one here"]) and kept.columns == df.columns
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def test_near_query_equals_brute_force(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = queries.op10_near_dedup(spark, small).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, 2, 4, 5)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    for n in (3, 50, 2000):
        hits = []
        for _ in range(40):
            a = rng.integers(0, 1 << 62, n).astype(np.uint64)
            b = np.concatenate([a[: int(0.8 * n)], rng.integers(0, 1 << 62, n - int(0.8 * n)).astype(np.uint64)])
            truth = len(set(a) & set(b)) / len(set(a) | set(b))
            hits.append((near_dedup.signature(np.unique(a), 160) == near_dedup.signature(np.unique(b), 160)).mean() - truth)
        assert abs(np.mean(hits)) < 0.06


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {r.node: r.root for r in near_dedup.components(links).collect()} == {i: 0 for i in range(41)} | {100: 100, 101: 100}
