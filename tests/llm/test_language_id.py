import numpy as np

import corpus_pipeline
from linkloom.llm import language_id, queries


def test_held_out_accuracy(spark, small):
    rows = queries.op5_language_id(spark, small).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == 200 and held and all(0 <= r.score <= 1 for r in rows)
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) >= 0.95 * len(held)


def test_edges(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = language_id.fit_languages(docs)
    long = "the of and that " * 60_000
    odd = spark.createDataFrame([(1, None, "e"), (2, "", "e"), (3, "12 34 ...", "e"), (4, long, "e"), (None, "the of and that", "e"), (4, long, "e")], "doc_id long, text string, lang_pred string")
    got = sorted(((r.doc_id or 0, r.lang_pred) for r in language_id.predict_languages(odd, model).collect()))
    assert got == [(0, "en"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en")]
    assert language_id.identified(odd, model).count() == 3
    none = language_id.fit_languages(docs.limit(0))
    assert {(r.lang_pred, r.score) for r in language_id.predict_languages(odd, none).collect()} == {("und", 0.0)}


def test_neighbours_do_not_matter(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(40)
    model = language_id.fit_languages(docs)
    texts = [r.text for r in docs.collect()]
    together = model.predict(texts)
    alone = [model.predict([x]) for x in texts]
    assert together[0] == [x[0][0] for x in alone]
    assert max(abs(a - b[1][0]) for a, b in zip(together[1], alone, strict=True)) < 1e-9


def test_nothing_learned_keeps_texts_with_letters(spark):
    rows = [(i, f"some words {i}", None) for i in range(20)] + [(100, "12 34", None), (101, None, None), (102, "Ж", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.language(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == [*range(20), 102]


def test_the_score_takes_part(spark):
    even = np.full((3, language_id.BUCKETS), -np.log(language_id.BUCKETS))
    model = language_id.LanguageModel(["a", "b", "c"], even, np.log(np.full(3, 1 / 3)))
    docs = spark.createDataFrame([(1, "any words"), (2, "12")], "doc_id long, text string")
    assert language_id.identified(docs, model).count() == 0
    assert [r.doc_id for r in language_id.identified(docs, model, least_score=0.3).collect()] == [1]
