"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .chunks import text_slices

UNKNOWN = "und"
ORDERS = (2, 3)
BUCKETS = 1 << 15
#: Rows that the model is fitted on: about so many of each language, chosen by a hash of their id.
SAMPLE_PER_LANGUAGE = 4000
#: The matrix has a row for each language, so their number is bounded; more is an error.
MAX_LANGUAGES = 1000
PIECE = 400_000
#: A language is known if its posterior is at least that of all others together.
LEAST_SCORE = 0.5
_LETTER = re.compile("[A-Za-z]")


@dataclass
class LanguageModel:
    """languages, and for each the log probabilities of its buckets and its log prior."""

    languages: list[str]
    log_probability: np.ndarray
    log_prior: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """The likeliest language and its posterior; `und` and 0 where there is no letter or no model."""
        labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return labels, scores
        total = np.tile(self.log_prior, (len(texts), 1))
        for rows, starts, grams in pieces(texts):
            for k in range(len(self.languages)):
                of = self.log_probability[k]
                for hashes in grams:
                    np.add.at(total[:, k], rows, np.add.reduceat(of[hashes], starts))
        best = total.argmax(axis=1)
        shifted = np.exp(total - total.max(axis=1, keepdims=True))
        share = shifted.max(axis=1) / shifted.sum(axis=1)
        for i, text in enumerate(texts):
            if has_letter(text):
                labels[i], scores[i] = self.languages[best[i]], float(share[i])
        return labels, scores


def has_letter(text: str) -> bool:
    return bool(_LETTER.search(text)) or any(map(str.isalpha, text))


def pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Buckets of the lower-cased texts' n-grams, texts side by side up to PIECE characters:
    (text of each segment, where segments begin, buckets at each character for each order).

    An n-gram belongs to the text that it begins in and reaches into the blanks behind it, so no
    text's n-grams depend on another's. Long texts come in several pieces that overlap.
    """
    reach = max(ORDERS) - 1
    rows: list[int] = []
    parts: list[str] = []
    size = 0
    for i, text in enumerate(texts):
        text = text.lower()
        for k in range(0, len(text), PIECE):
            own = text[k : k + PIECE + reach]
            n = min(PIECE, len(text) - k)
            if rows and size + n > PIECE:
                yield _hashed(rows, parts, reach)
                rows, parts, size = [], [], 0
            rows.append(i)
            parts.append(own + " " * (n + reach - len(own)))
            size += n
    if rows:
        yield _hashed(rows, parts, reach)


def _hashed(rows: list[int], parts: list[str], reach: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    code = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum([len(x) for x in parts])
    starts = ends - [len(x) for x in parts]
    own = np.ones(len(code), bool)
    for k in range(1, reach + 1):
        own[ends - k] = False
    counts = np.concatenate([[0], np.cumsum(own)])
    grams = []
    for n in ORDERS:
        h = np.full(len(code), n, np.uint32)
        for k in range(n):
            h *= np.uint32(0x01000193)
            h[: len(code) - k] ^= code[k:]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        grams.append((h >> np.uint32(17))[own].astype(np.int64) & (BUCKETS - 1))
    return np.array(rows), counts[starts], grams


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0; a missing id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit_languages(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample_per_language: int = SAMPLE_PER_LANGUAGE, smoothing: float = 0.5) -> LanguageModel:
    """Fits on rows with a text and a label: about sample_per_language of each, whole texts. Priors are
    the labels' shares of all these rows. The driver gets languages x buckets counts, nothing else."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    known = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(known) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    known = sorted((r["lang"], r["count"]) for r in known)
    if not known:
        return LanguageModel([], np.zeros((0, BUCKETS)), np.zeros(0))
    place = {lang: k for k, (lang, _) in enumerate(known)}
    share = F.create_map(*[F.lit(x) for lang, n in known for x in (lang, min(1.0, sample_per_language / n))])
    drawn = F.pmod(F.xxhash64(F.lit("language sample"), "id"), F.lit(1 << 30)) / F.lit(float(1 << 30)) < share[F.col("lang")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(place), BUCKETS), np.int64)
        for part, texts in text_slices(batches, "text"):
            of = np.array([place[x] for x in part.column("lang").to_pylist()])
            for owners, starts, grams in pieces(texts):
                for hashes in grams:
                    lang = np.repeat(of[owners], np.diff([*starts, len(hashes)]))
                    counts += np.bincount(lang * BUCKETS + hashes, minlength=counts.size).reshape(counts.shape)
        lang, bucket = counts.nonzero()
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int64()), pa.array(bucket, pa.int64()), pa.array(counts[lang, bucket])], names=["lang", "bucket", "n"])

    spread = rows.where(drawn).select("text", "lang").repartition(8).mapInArrow(count, "lang long, bucket long, n long")
    counts = np.zeros((len(place), BUCKETS))
    for r in spread.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["lang"], r["bucket"]] = r["n"]
    counts += smoothing
    prior = np.log([n for _, n in known])
    return LanguageModel([lang for lang, _ in known], np.log(counts / counts.sum(axis=1, keepdims=True)), prior - np.logaddexp.reduce(prior))


def predict_languages(docs: DataFrame, model: LanguageModel, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, lang_pred, score) of every row, from its whole text alone; the model is broadcast, of at most
    languages x buckets doubles. `und` with score 0 if the text is null, has no letter, or nothing was learned."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, "text"):
            labels, scores = shared.value.predict(texts)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(labels, pa.string()), pa.array(scores, pa.float64())], names=[id_col, "lang_pred", "score"])

    return chosen.mapInArrow(run, f"`{id_col}` {chosen.schema['id'].dataType.simpleString()}, lang_pred string, score double")


def identified(docs: DataFrame, model: LanguageModel, text_col: str = "text", least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows, all columns as they are, whose language is known: those without letters go, and those whose
    likeliest language scores less than least_score. Where nothing was learned, all with letters stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def known(texts: list[str]) -> list[bool]:
        if not shared.value.languages:
            return [*map(has_letter, texts)]
        return [x != UNKNOWN and score >= least_score for x, score in zip(*shared.value.predict(texts), strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.RecordBatch.from_arrays([batch.column(at)], names=["text"])
            keep: list[bool] = []
            for _, texts in text_slices([own], "text"):
                keep += known(texts)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
