from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from linkloom.llm import mixing, queries


def brute_targets(sizes, weights=(1, 2, 3), most=3.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, target = float(sum(sizes.values())), dict.fromkeys(order, 0.0)
    open_, left = set(order), total
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1, "c": 5, None: 100}, {"a": 5}, {"a": 0, "b": 7}, {"é": 3, "z": 1, "Z": 1, None: 2}, {f"s{i}": i * i for i in range(30)}])
def test_targets(spark, sizes):
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame([*sizes.items()], "source string, source_size long")).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in want)


def rows():
    out = [(i, "w " * (1 + i * 7 % 40), f"s{i % 4}", "clash") for i in range(900)]
    return out + [(1000, None, "s1", "x"), (1001, " \n", None, "x"), (1002, "one two", None, "x"), (1003, "same row", "s2", "x"), (1003, "same row", "s2", "x"), (None, "no id", "s2", "x")]


def test_mix_meets_targets_and_bounds(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, source string, taken string")
    got = mixing.mixed_copies(df, fan_in=8).collect()
    assert len(got) == len(rows())
    words, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        words[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    targets = {r.source: (r.target, r.source_size) for r in got}
    sizes = defaultdict(int)
    for _, text, source, _ in rows():
        sizes[source] += len((text or "").split())
    want = brute_targets(dict(sizes))
    for s, (target, size) in targets.items():
        assert size == sizes[s] and abs(target - want[s]) < 1e-6 * (1 + target) and abs(words[s] - target) <= largest[s]
    again = mixing.mixed_copies(df.repartition(7), fan_in=8).collect()
    key = lambda r: (r.doc_id or -1, r.key, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixed_rows(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, source string, taken string")
    out = mixing.mixed(df).collect()
    drawn = {(r.doc_id, r.key): r.copies for r in mixing.mixed_copies(df).collect() if r.size}
    assert sum(drawn.values()) <= sum(1 for r in out if (r.text or "").split()) <= sum(drawn.values()) + 3
    assert sum(1 for r in out if not (r.text or "").split()) == 2
    assert mixing.mixed(df.limit(0)).count() == 0 and mixing.mixed_copies(df.limit(0)).count() == 0


def test_equal_rows_spread(spark, monkeypatch):
    equal = [(None, "the same row", "s", i) for i in range(3000)]
    other = [(i, "w " * (1 + i % 9), "st"[i % 2], i) for i in range(3000)]
    df = spark.createDataFrame(equal + other, "doc_id long, text string, source string, place long")
    largest = []

    def spy(table, label, **options):
        out = real(table, label, **options)
        if label == "mix-level":
            largest.append(out.agg(F.max(F.size("done"))).first()[0] + 1)
        return out

    real = mixing.written
    monkeypatch.setattr(mixing, "written", spy)
    monkeypatch.setattr(mixing, "RUN_BITS", 5)
    got = mixing.mixed_copies(df).collect()
    assert max(largest) <= 3 * mixing.FAN_IN
    assert len(got) == len({r.key for r in got}) == 6000
    words = {s: sum(r.taken for r in got if r.source == s) for s in "st"}
    for r in got[:1] + got[-1:]:
        assert abs(words[r.source] - r.target) <= 9
    again = mixing.mixed_copies(df.repartition(9)).collect()
    key = lambda r: (r.doc_id or -1, r.key, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    out = mixing.mixed(df).collect()
    assert len(out) == sum(r.copies for r in got) and max(Counter(r.place for r in out if r.doc_id is None).values()) <= 3


def test_draws_are_fair(spark):
    df = spark.createDataFrame([(i, "a b c d e", "s", "x") for i in range(400)] + [(1000 + i, "a " * 10, "t", "x") for i in range(400)], "doc_id long, text string, source string, taken string")
    total = defaultdict(int)
    for seed in range(6):
        for r in mixing.mixed_copies(df, seed=seed, fan_in=16).where("source = 's'").collect():
            total[r.doc_id % 10] += r.copies
    mean = sum(total.values()) / 10
    assert max(abs(x - mean) for x in total.values()) < 0.2 * mean


def test_query(spark, small):
    rows_ = queries.op8_source_mixing(spark, small).collect()
    assert len(rows_) == 200 and all(r.taken <= 3 * r.size for r in rows_)
