"""Golden rows of the text functions."""

import pytest
from pyspark.sql import functions as F

from linkloom.functions import keys as K
from linkloom.functions import text as T


def one(spark, make, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(make(*[F.col(c) for c in df.columns]).alias("x")).first().x


@pytest.mark.parametrize(("raw", "want"), [("  Líreque & Co., LTD. ", "lireque co ltd"), ("Straße Œuvre", "strasse oeuvre"), (None, ""), ("...", ""), ("12-B Main", "12 b main")])
def test_norm(spark, raw, want):
    assert one(spark, T.norm, raw) == want


def test_other_scripts_are_romanised(spark):
    got = one(spark, T.norm, "हिन्दी Ltd")
    assert got.endswith(" ltd") and got.isascii() and len(got) > 6
    assert one(spark, lambda s: T.norm(s, other_scripts=False), "हिन्दी Ltd") == "ltd"


@pytest.mark.parametrize(("raw", "want"), [("limited", "lmtd"), ("pharma", "frm"), ("aapple", "apl"), ("book", "bk")])
def test_skeleton(spark, raw, want):
    assert one(spark, T.skeleton_token, raw) == want
    assert one(spark, T.skeleton, f"{raw} {raw}") == f"{want} {want}"


def test_tokens(spark):
    assert one(spark, T.address_tokens, "0011118 main st") == ["11118", "main", "s218", "st"]
    assert one(spark, T.address_tokens, "000 a 5") == ["0", "5"]
    assert one(spark, T.name_tokens, "") == ["~"]
    assert one(spark, T.name_tokens, "apex a 7 books") == ["7", "apex", "books", "skapks", "skbks", "~apexa7bo"]
    assert one(spark, T.number_set, "12b 0012 7") == ["12", "7"]


def test_flags(spark):
    assert one(spark, T.is_non_latin, "Ünï") is False and one(spark, T.is_non_latin, "తె") is True
    assert one(spark, T.looks_like_domain, "Shop.COM now") is True and one(spark, T.looks_like_domain, "#tag") is True and one(spark, T.looks_like_domain, "company") is False


def test_views(spark):
    view = one(spark, T.view_text, "  Líreque & Co., LTD. ")
    assert view == "líreque and co ltd"
    assert one(spark, T.core_name, view) == "líreque"  # this view and its forms are fixed values
    assert one(spark, T.core_name, "ace sa") == "ace sa" and one(spark, T.core_name, "ace sarl") == "ace" and one(spark, T.core_name, "oak and company limited") == "oak"
    assert one(spark, T.canonical_address, "12 ct sq ter no 5 ste 2") == "12 ct sq ter number 5 suite 2"
    assert one(spark, T.latin_folded, view) == "lireque and co ltd" and one(spark, T.core_name, "apex private limited") == "apex"
    assert one(spark, T.core_name, "co ltd") == "co ltd"
    assert one(spark, T.view_text, "ＡＰＥＸ  INC") == "apex inc"
    assert one(spark, lambda s: T.canonical_address(T.view_text(s)), "1001 17th St., Apt 4B") == "1001 17th street apartment 4b"
    assert one(spark, lambda s: T.numeric_tokens(T.view_text(s)), "1001 17th St., Apt 4B") == ["1001", "17th", "4b"]
    telugu = "తె‍లుగు షాప్"
    assert one(spark, T.script_flags, telugu) == ["TELUGU"] and one(spark, T.script_flags, "A Я") == ["CYRILLIC", "LATIN"]
    assert one(spark, T.script_flags, "中 ª b") == ["LATIN", "OTHER"] and one(spark, T.script_flags, "12 !") == []
    assert one(spark, T.numeric_tokens, "४२ road 12a 7é x9") == ["४२", "12a"]
    folded = one(spark, T.view_text, telugu)
    assert one(spark, T.latin_folded, folded) == folded and " " in folded
    assert one(spark, T.last_word, "12 main st 4b") == "main" and one(spark, T.last_word, "1 2") == ""


def test_ngrams_and_hashes(spark):
    assert "ape" in one(spark, T.char_ngrams, "apex") and one(spark, T.char_ngrams, "") == [] and one(spark, T.char_ngrams, "a") == ["^a$"]
    same = one(spark, lambda a, b: K.hamming(K.simhash(T.char_ngrams(a)), K.simhash(T.char_ngrams(b))), "apex industries", "apex industries")
    near = one(spark, lambda a, b: K.hamming(K.simhash(T.char_ngrams(a)), K.simhash(T.char_ngrams(b))), "apex industries", "apex industry")
    far = one(spark, lambda a, b: K.hamming(K.simhash(T.char_ngrams(a)), K.simhash(T.char_ngrams(b))), "apex industries", "river bakery")
    assert same == 0 and near < far
    assert one(spark, lambda s: K.simhash(T.char_ngrams(s)), "") == 0
    assert len(one(spark, lambda s: K.bands(K.simhash(T.char_ngrams(s))), "apex")) == 4
    assert one(spark, lambda s: K.channel_names(F.lit(17)), "") == ["EXACT_NAME", "NAME_LSH"]


def test_keys(spark):
    keys = one(spark, lambda s: K.conjunctive_keys(F.split(F.lit("a b"), " "), F.split(F.lit("x y z"), " ")), "")
    assert sorted((k.ktype, k.key) for k in keys) == sorted([("A", "x|y"), ("A", "x|z"), ("A", "y|z"), ("N", "a|b"), *[("X", f"{a}|{b}") for a in "ab" for b in "xyz"]])
    assert one(spark, lambda s: K.unordered_pairs(F.split(F.lit("a"), " ")), "") == []
