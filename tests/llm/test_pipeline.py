"""Each stage against brute force on its own input."""

import re
from collections import Counter, defaultdict

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline

from .test_dedup import brute_components


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    extra = spark.createDataFrame([(9001, "12 34 --", "en", "src0", 8), (9002, None, None, None, None), (9003, "Schöne neue Welt der Wörter", None, None, 5), (9004, "Schöne  neue Welt der Wörter", "de", "src1", 6)], docs.schema)
    at = docs.unionByName(extra)
    rows = {"start": at.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, small)
        rows[name] = out.collect()
        if name != "BPE encoding":
            assert out.columns == docs.columns
            at = spark.createDataFrame(rows[name], docs.schema)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert sorted(r.doc_id for r in rows[names[0]]) == sorted(r.doc_id for r in rows["start"] if any(c.isalpha() for c in r.text or ""))

    groups = defaultdict(list)
    for r in rows[names[0]]:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r.text)].append((-len(r.text), r.doc_id))
    assert sorted(r.doc_id for r in rows[names[1]]) == sorted(min(g)[1] for g in groups.values())

    near = brute_components([(r.doc_id, r.text) for r in rows[names[1]]], 5, 4, 5)
    assert sorted(r.doc_id for r in rows[names[2]]) == sorted({c for _, n, c in near})

    before = {r.doc_id: r for r in rows[names[2]]}
    copies = Counter(r.doc_id for r in rows[names[3]])
    assert set(copies) <= set(before) and max(copies.values()) <= 3
    assert all(before[r.doc_id] == r for r in rows[names[3]])

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert len(rows[names[4]]) == len(rows[names[3]])
    for r in rows[names[4]]:
        assert r.ids == library.encode(before[r.doc_id].text, add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_run(spark, small):
    assert corpus_pipeline.run(spark, small).count() > 0 and corpus_pipeline.ORACLE_SQL is None
