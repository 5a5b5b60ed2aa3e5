"""Encoding, counting and token output against the libraries."""

import gc
import random
import tracemalloc
import weakref
import zlib
from functools import reduce
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from linkloom.llm import bpe_automaton, chunks, near_dedup, queries, token_counts, token_output
from linkloom.llm.shared import new_path

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "  a  b\n\n c \t", "it's we'LL 'd''s<|endoftext|> x <|endoftext|>", "\x1c a \x85b\xa0c　 d é é ﬁ İ ß Σς", "a" * 3000, "한국어 😀 ½²٣", " x᠎y"]


def odd_texts(n=300):
    rng = random.Random(5)
    pool = [lambda: rng.randrange(1, 128), lambda: rng.randrange(1, 0x300), lambda: rng.randrange(1, 0xD800), lambda: 32, lambda: 97, lambda: 10]
    return ODD + ["".join(chr(rng.choice(pool)()) for _ in range(rng.randrange(40))) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark, small):
    rows = [(10**6 + i, t, "clash") for i, t in enumerate(odd_texts(60))] + [(5, None, "x"), (5, None, "x"), (None, "no id", "x"), (5, "same", "x")]
    return spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", F.lit("n").alias("ids")).unionByName(spark.createDataFrame(rows, "doc_id long, text string, ids string"))


def test_automaton_equals_library():
    machine, library = bpe_automaton.automaton(BYTE), Tokenizer.from_file(BYTE)
    for text in odd_texts(1500):
        ids = library.encode(text, add_special_tokens=False).ids
        assert machine.encode(text) == ids, text
        assert machine.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_code_point_is_encoded_as_by_the_library():
    machine, library = bpe_automaton.automaton(BYTE), Tokenizer.from_file(BYTE)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and c < 0x30000 or 0xE0000 <= c < 0xE0200]
    texts = ["".join(f"a{c}b 1{c}2 {c} .{c}! {c}{c}'s{c}\n{c}" for c in points[k : k + 500]) for k in range(0, len(points), 500)]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    for text, ids, packed in zip(texts, want, machine.encode_packed(texts), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == ids, hex(ord(text[1]))


def test_fine_cuts_change_nothing():
    rng, marks = random.Random(9), "'.,!?;:-_#*()<>|\n \t\"~`\x01"
    words = ["it", "s", "we", "re", "Ünder", "élan", "ĳs", "12", "ﬁ", "<|endoftext|>", "x'll", "İ", "ŉ", "中文", "\u0338", ""]
    texts = ["".join(rng.choice(words) + rng.choice(marks) * rng.choice((0, 1, 1, 2, 3)) for _ in range(rng.randrange(12))) for _ in range(4000)]
    for path, encode in ((BYTE, bpe_automaton.automaton(BYTE).encode_packed), (BYTE, token_counts._memo(BYTE).packed), (WORD, token_counts._memo(WORD).packed)):
        assert token_counts._memo(path).cuts
        want = [x.ids for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == want


def test_small_table_still_reads_all(monkeypatch):
    monkeypatch.setattr(bpe_automaton, "STEPS_KEPT", 5)
    machine, library = bpe_automaton.TokenAutomaton.from_file(BYTE), Tokenizer.from_file(BYTE)
    assert machine.encode("a walk over the table, again and again") == library.encode("a walk over the table, again and again", add_special_tokens=False).ids


def test_a_byte_completes_one_arc():
    """Every prefix of a word has one path: of all arcs that end at a byte exactly one is there."""
    machine, rng = bpe_automaton.TokenAutomaton.from_file(BYTE), random.Random(4)
    for _ in range(300):
        machine.word("".join(rng.choice("aeinrst hlodukü") for _ in range(12)).encode())
    for (state, byte), (_, token) in [((k >> 8, k & 255), v) for k, v in machine._table.items()]:
        arcs = [machine._ends[to] for node, before in machine._sets[state] if (to := machine._next[node].get(byte)) is not None and machine._ends[to] >= 0 and (before < 0 or machine.has_arc(before, machine._ends[to]))]
        assert arcs == [token]


def test_automaton_table_equals_its_states():
    machine, rng = bpe_automaton.automaton(BYTE), random.Random(2)
    for _ in range(20000):
        before, token = rng.randrange(3000), rng.randrange(3000)
        assert machine.has_arc(before, token) == machine.has_arc_by_states(machine.enters[before], token)


def test_small_memo_still_encodes_all(monkeypatch):
    machine = bpe_automaton.TokenAutomaton.from_file(BYTE)
    machine.memo.entries = 3
    library = Tokenizer.from_file(BYTE)
    texts = odd_texts(200)
    got = [np.frombuffer(x, "<u4").tolist() for k in range(0, len(texts), 7) for x in machine.encode_packed(texts[k : k + 7])]
    assert got == [library.encode(x, add_special_tokens=False).ids for x in texts]


def test_round_trip_query(spark, docs):
    library = Tokenizer.from_file(BYTE)
    got = sorted(tuple(r) for r in bpe_automaton.bpe_round_trip(docs.where("doc_id is not null"), BYTE).collect())
    want = []
    for r in docs.where("doc_id is not null").collect():
        text = r.text or ""
        ids = library.encode(text, add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(text.encode()).hexdigest()))
    assert got == sorted(want)


def test_encode_then_decode(spark, docs):
    own = docs.where("doc_id >= 1000000")
    back = bpe_automaton.bpe_decode(bpe_automaton.bpe_encode(own, BYTE), BYTE)
    assert sorted(map(tuple, back.collect())) == sorted((r.doc_id, r.text) for r in own.collect())


def test_counts_and_cache(spark, docs):
    library, path = Tokenizer.from_file(WORD), new_path(spark, "test-cache")
    want = sorted(((r.doc_id or -1, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect()))
    for _ in range(2):
        got = token_counts.cached_token_counts(docs, WORD, path)
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got.collect()) == want
    cache = spark.read.parquet(path)
    assert cache.count() == cache.select("content_sha256").distinct().count()
    assert token_counts.cached_token_counts(docs.limit(0), WORD, path).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_of_each_library(name):
    path = public_tokenizers.path(name)
    encode, _ = token_counts.library(path)
    texts = odd_texts(400)
    assert token_counts.count_tokens(path, pa.array(texts)).tolist() == [len(x) for x in encode(texts)]


def test_token_output(spark, docs):
    library, path = Tokenizer.from_file(BYTE), new_path(spark, "test-output")
    token_output.write_tokens(docs, BYTE, path, shard_docs=50)
    read = token_output.read_tokens(spark, path)
    rows = token_output.ids_digest(read.select("doc_id", "start", "n_tokens", "ids")).collect()
    start, got = 0, sorted(map(tuple, rows), key=lambda r: r[1])
    source = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    assert len(got) == len(source)
    for (doc_id, at, n, crc), r in zip(got, source, strict=True):
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 0]
        assert (doc_id, at, n, crc) == (r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += n
    empty = new_path(spark, "test-output")
    token_output.write_tokens(docs.limit(0), BYTE, empty)
    assert token_output.read_tokens(spark, empty).count() == 0


def test_metadata_reads_leave_the_ids(spark, docs):
    path = new_path(spark, "test-output")
    token_output.write_tokens(docs, BYTE, path)
    plan = token_output.read_tokens(spark, path).select("doc_id", "start", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan


def test_queries_run(spark, small):
    assert queries.op2_bpe_codec(spark, small).count() == queries.op6_token_counts(spark, small).count() == 200


def test_other_operators_let_encoders_go():
    """A worker that another operator takes doesn't keep the encoder's table and memo, and makes them again."""
    before = bpe_automaton.automaton(BYTE)
    ids, held = before.encode_packed(ODD), weakref.ref(before)
    del before
    texts = pa.RecordBatch.from_pydict({"text": ["one", None]})
    assert [part for _, part in chunks.text_slices([texts], "text")] == [["one", ""]]
    assert held() is None and bpe_automaton.library_classes.cache_info().currsize == 0
    assert bpe_automaton.automaton(BYTE).encode_packed(ODD) == ids


def test_encoders_let_other_operators_go():
    """A worker that an encoder takes doesn't keep near dedup's words; near dedup's own tasks do."""
    bpe_automaton.automaton.cache_clear()
    near_dedup.shingle_set("these words are kept", 2)
    list(chunks.text_slices([], "text", own="words"))
    assert near_dedup._WORDS
    bpe_automaton.automaton(BYTE)
    assert not near_dedup._WORDS


def test_automaton_is_compact():
    """Two workers of an executor hold it beside a full heap."""
    tracemalloc.start()
    machine = bpe_automaton.TokenAutomaton.from_file(BYTE)
    gc.collect()
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 22e6 and all(machine._ends[at] == t for t in (65, 300, 40_000) for at in [reduce(machine._next.child, machine.labels[t], 0)])


def test_words_go_straight_to_the_model():
    library, asked = Tokenizer.from_file(BYTE), []

    def encode(texts):
        asked.extend(texts)
        return [library.encode(x, add_special_tokens=False).ids for x in texts]

    words = [x for c in chunks.LETTERS for x in (f" a{c}", f"{c}bc", f" {c}")]
    odd = ["<|endoftext|>", " a1", "  a", "", " "]
    got = [np.frombuffer(x, "<u4").tolist() for x in token_counts._joined(library, encode, chunks.space_led)([*words, *odd])]
    assert asked == odd and got == [library.encode(x, add_special_tokens=False).ids for x in [*words, *odd]]
