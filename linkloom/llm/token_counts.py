"""Token counts behind a digest cache.

A count depends only on the normalised content and on the tokenizer's version, so it is stored
under both digests. Counting joins the rows to the cache, encodes one row of each digest that
the cache lacks, and appends what it found.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe_automaton import byte_letters
from .chunks import LETTERS, PUNCTUATION, Memo, arrow_slices, space_free, space_led
from .shared import keyed_join, path_exists, written

#: Texts that are given to the library at a time.
BATCH = 2048
CACHE_SCHEMA = "content_sha256 binary, tokenizer_sha256 string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """The version of a tokenizer: the digest of its file."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def collapse_spaces(text: Column) -> Column:
    """Normalisation for tokenizers that drop white space: runs of ASCII white space become one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


@lru_cache(maxsize=4)
def library(path: str):
    """A worker's tokenizer of the library that a file belongs to, and how its texts are chunked."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: model.encode(texts, num_threads=1), None
    tok = _tokenizer(path)
    kind = str(tok.pre_tokenizer)
    cut = space_led if kind.startswith("ByteLevel(") and "add_prefix_space=False" in kind and "use_regex=True" in kind and tok.normalizer is None else space_free if _drops_space(tok) else None


    def encode(texts: list[str]) -> Iterator[list[int]]:
        for k in range(0, len(texts), BATCH):  # the library's encodings are large: few at a time
            yield from (x.ids for x in tok.encode_batch_fast(texts[k : k + BATCH], add_special_tokens=False))

    return encode, cut


def _drops_space(tok) -> bool:
    """Whether texts may be cut at ASCII white space: it never is, nor becomes, part of a token, and no
    special string holds any. Shown by a probe of the loaded tokenizer."""
    whole = lambda x: tok.encode(x, add_special_tokens=False).ids
    apart = whole("ab") + whole("c1'") + whole("ć") + whole("9") + whole(".") + whole("d")
    glued = any(c.isspace() for t in tok.get_added_tokens_decoder().values() for c in t.content)
    return not glued and all(whole(s.join(["ab", "c1'", "ć", "9", ".", "d"])) == apart for s in (" ", "  ", "\n", "\t ", "\r\x0b\x0c")) and whole(" ab ") == whole("ab") and whole(" ") == []


def _cuts_punctuation(tok) -> bool:
    """Whether texts may be cut between letters and punctuation (chunks.LETTERS, PUNCTUATION). Shown by a
    probe of the loaded tokenizer: of each letter beside a mark, and of each pair of marks between letters."""
    known: dict[str, list[int]] = {}

    def whole(x: str) -> list[int]:
        if x not in known:
            known[x] = tok.encode(x, add_special_tokens=False).ids
        return known[x]

    marks = [*PUNCTUATION, *(a + b for a in PUNCTUATION for b in PUNCTUATION)]
    return all(whole(f"{c}.{c}") == whole(c) + whole(".") + whole(c) for c in LETTERS) and all(whole(f"a{m}b") == whole("a") + whole(m) + whole("b") for m in marks)


@lru_cache(maxsize=4)
def _memo(path: str) -> Memo:
    encode, cut = library(path)
    tok = _tokenizer(path)
    return Memo(_joined(tok, encode, cut), cut, _cuts_punctuation(tok), [t.content for t in tok.get_added_tokens_decoder().values()])


def _joined(tok, encode, cut):
    """Encodes pieces by what their splitting allows. For byte-level splitting, letters with at most one space
    before them are one word, which goes straight to the library's model. Else, where the last token of a word
    is marked as such, words of letters are encoded side by side, in texts of many. Other pieces are encoded alone."""
    words = tok.get_vocab(with_added_tokens=True)
    special = "".join({c for t in tok.get_added_tokens_decoder().values() for c in t.content[:1]})
    letters = f"[{re.escape(''.join(c for c in LETTERS if c not in special))}]+"
    if cut is space_led:
        plain_, of_plain = re.compile(f" ?{letters}").fullmatch, _by_model(tok)
    else:
        marks = np.zeros(max(words.values()) + 1, bool)
        marks[[i for w, i in words.items() if w.endswith("</w>")]] = True
        plain_, of_plain = re.compile(letters).fullmatch if marks.any() else (lambda x: None), _side_by_side(encode, marks)

    def run(pieces: list[str]) -> Iterator[bytes]:
        out: list[bytes | None] = [None] * len(pieces)
        plain = [i for i, x in enumerate(pieces) if plain_(x)]
        for k in range(0, len(plain), BATCH):
            at = plain[k : k + BATCH]
            whole, ends = of_plain([pieces[i] for i in at])
            for i, a, b in zip(at, [0, *ends], ends, strict=False):
                out[i] = whole[a:b]
            if len(ends) != len(at):
                raise ValueError("pieces that were encoded side by side can't be told apart")
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, encode([pieces[i] for i in rest]), strict=True):
            out[i] = np.array(x, "<u4").tobytes()
        return out

    return run


def _by_model(tok):
    """(packed ids, where each word's end) of words by the library's model, to which bytes are letters."""
    model, letter = tok.model, {b: c for c, b in byte_letters().items()}

    def run(words: list[str]) -> tuple[bytes, list[int]]:
        found = [*map(model.tokenize, "\n".join(words).encode().decode("latin-1").translate(letter).split(letter[10]))]
        ids = np.array([t.id for x in found for t in x], "<u4")
        return ids.tobytes(), (np.cumsum([*map(len, found)]) * 4).tolist()

    return run


def _side_by_side(encode, marks: np.ndarray):
    """The same by the whole library in one text, where marked tokens end a word."""

    def run(words: list[str]) -> tuple[bytes, list[int]]:
        ids = np.array(next(iter(encode([" ".join(words)]))), "<u4")
        return ids.tobytes(), (np.flatnonzero(marks[ids]) * 4 + 4).tolist()

    return run


def encoded(path: str, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(the ids of all texts by the library one after the other, the number of each text's)."""
    encode, cut = library(path)
    if cut is not None:
        return _memo(path).encoded(texts)
    parts = [np.array(x, "<u4") for x in encode(texts.to_pylist())]
    return np.concatenate([np.zeros(0, "<u4"), *parts]), np.array([len(x) for x in parts], np.int64)


def count_tokens(path: str, texts: pa.Array) -> np.ndarray:
    return encoded(path, texts)[1]


def cached_token_counts(docs: DataFrame, tokenizer: str, cache_path: str, text_col: str = "text", id_col: str = "doc_id", normalise=collapse_spaces) -> DataFrame:
    """(id, n_bytes, n_tokens) of every row, of its whole text; null counts as empty: no bytes, no tokens.

    The cache at cache_path (Parquet, CACHE_SCHEMA) may be missing at first. Rows of equal content,
    however many, are encoded once: the row with the smallest id (nulls last) stands for its digest.
    Rows that repeat its id and text, or lack an id as it does, come along but are encoded once a batch.
    normalise must not change counts. An empty table gives no rows; other columns don't matter.
    """
    spark: SparkSession = docs.sparkSession
    version = tokenizer_digest(tokenizer)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("place", F.xxhash64("text"))
    digest = F.unhex(F.sha2(normalise(F.col("text")), 256))
    slim = written(keyed.select("id", "place", digest.alias("digest"), F.octet_length("text").cast("long").alias("n_bytes")), "token-rows")

    def known() -> DataFrame:
        if not path_exists(spark, cache_path):
            return spark.createDataFrame([], "digest binary, n_tokens long")
        own = spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("tokenizer_sha256") == version)
        return own.groupBy(F.col("content_sha256").alias("digest")).agg(F.max("n_tokens").alias("n_tokens"))

    first = slim.groupBy("digest").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "place")).alias("first")).join(known(), "digest", "left_anti")
    first = first.select("digest", F.col("first.id").alias("first_id"), F.col("first.place").alias("first_place"))
    misses = keyed.join(first, F.col("id").eqNullSafe(F.col("first_id")) & (F.col("place") == F.col("first_place")))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in arrow_slices(batches, "text"):
            _, at = np.unique(part.column("digest").dictionary_encode().indices.to_numpy(), return_index=True)
            at = pa.array(at)
            yield pa.RecordBatch.from_arrays([part.column("digest").take(at), pa.array([version] * len(at), pa.string()), pa.array(count_tokens(tokenizer, texts.take(at)), pa.int64())], names=["content_sha256", "tokenizer_sha256", "n_tokens"])

    found = misses.select("digest", "text").mapInArrow(encode, CACHE_SCHEMA).dropDuplicates(["content_sha256"])
    found.write.mode("append").parquet(cache_path)
    return keyed_join(slim, known(), "digest").select(F.col("id").alias(id_col), "n_bytes", "n_tokens")
