"""Text normalisation as column expressions; Python runs only for scripts that Spark can't fold."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Latin letters that aren't a base letter with marks, and what they become.
LETTER_PAIRS = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "þ": "th", "ł": "l", "ı": "i"}

#: Legal forms at the end of a name.
LEGAL_SUFFIXES = [
    "and co", "and company", "private limited", "pvt ltd", "co", "company", "corp", "corporation", "inc", "incorporated", "limited", "llc", "llp", "ltd", "plc", "pvt", "sas", "sarl",
]

#: Address abbreviations.
ADDRESS_WORDS = {
    "apt": "apartment", "ave": "avenue", "bldg": "building", "blvd": "boulevard", "dr": "drive", "fl": "floor", "hwy": "highway", "ln": "lane", "no": "number", "rd": "road", "ste": "suite", "st": "street",
}

#: Scripts that are named; any other letter is OTHER.
SCRIPTS = ["ARABIC", "BENGALI", "CYRILLIC", "DEVANAGARI", "GUJARATI", "GURMUKHI", "KANNADA", "LATIN", "MALAYALAM", "TAMIL", "TELUGU"]


def _fold_table() -> tuple[str, str]:
    """Accented Latin letters up to U+024F and U+1EFF, and their base letters."""
    source, target = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code) and "LATIN" in unicodedata.name(base, ""):
            source.append(chr(code))
            target.append(base)
    return "".join(source), "".join(target)


_ACCENTED, _BASE = _fold_table()


def fold_latin(s: Column) -> Column:
    """Lower-cased, accents taken from Latin letters, ligatures spelled out."""
    out = F.translate(F.lower(s), _ACCENTED, _BASE)
    for letter, plain in LETTER_PAIRS.items():
        out = F.replace(out, F.lit(letter), F.lit(plain))
    return out


@F.pandas_udf(StringType())
def romanised(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Letters of other scripts spelled by their Unicode names: a consonant's inherent vowel goes before a
    vowel sign or virama."""
    known: dict[str, tuple[str, str]] = {}

    def spell(c: str) -> tuple[str, str]:
        if c not in known:
            name = unicodedata.name(c, "")
            last = name.rsplit(" ", 1)[-1].lower()
            kind = "vowel" if "VOWEL SIGN" in name else "virama" if "VIRAMA" in name else "letter" if "LETTER" in name else "digit" if c.isdecimal() else "mark"
            known[c] = (kind, str(unicodedata.decimal(c)) if kind == "digit" else last)
        return known[c]

    def one(text: str | None) -> str | None:
        if text is None or text.isascii():
            return text
        out = ""
        for c in text:
            if ord(c) < 0x250:
                out += c
                continue
            kind, said = spell(c)
            if kind in ("vowel", "virama"):
                out = out.removesuffix("a") + (said if kind == "vowel" else "")
            elif kind in ("letter", "digit"):
                out += said
            elif not unicodedata.category(c).startswith(("M", "Cf")):
                out += " "
        return out

    for batch in texts:
        yield batch.map(one, na_action="ignore")


def is_non_latin(s: Column) -> Column:
    """Whether a letter lies beyond the Latin blocks."""
    return s.rlike(r"[\p{L}&&[^\u0000-ɏ]]")


def norm(s: Column, other_scripts: bool = True) -> Column:
    """ASCII letters and digits in lower case, runs of all else one space. Other scripts are romanised in
    Python, and only in rows that have them; without that they separate words."""
    s = F.coalesce(s, F.lit(""))
    if other_scripts:
        s = F.when(is_non_latin(s), romanised(F.when(is_non_latin(s), s))).otherwise(s)
    return F.trim(F.regexp_replace(fold_latin(s), "[^a-z0-9]+", " "))


def looks_like_domain(s: Column) -> Column:
    return F.lower(s).rlike(r"\.(com|net|org|in|fr|co|io)\b|^[#@]")


def words(s: Column) -> Column:
    return F.filter(F.split(s, " "), lambda w: w != "")


def skeleton_token(t: Column) -> Column:
    """Phonetic skeleton: spellings unified, vowels and h dropped after the first letter, repeats squeezed."""
    for a, b in (("ph", "f"), ("w", "v"), ("z", "j"), ("x", "ks"), ("c", "k"), ("q", "k")):
        t = F.replace(t, F.lit(a), F.lit(b))
    rest = F.regexp_replace(F.substr(t, F.lit(2)), "[aeiouyh]", "")
    return F.regexp_replace(F.concat(F.substr(t, F.lit(1), F.lit(1)), rest), r"(.)\1+", "$1")


def skeleton(normed: Column) -> Column:
    return F.array_join(F.transform(words(normed), skeleton_token), " ")


def name_tokens(name: Column) -> Column:
    """Tokens of a normalised name (two letters or a digit), its first 8 characters without spaces after ~,
    and skeletons of its alphabetic tokens of three letters or more after sk; sorted, distinct."""
    tokens = words(name)
    plain = F.filter(tokens, lambda t: (F.length(t) > 1) | t.rlike("^[0-9]$"))
    prefix = F.array(F.concat(F.lit("~"), F.substr(F.replace(name, F.lit(" "), F.lit("")), F.lit(1), F.lit(8))))
    sounds = F.transform(F.filter(tokens, lambda t: t.rlike("^[a-z]{3,}$")), lambda t: F.concat(F.lit("sk"), skeleton_token(t)))
    return F.array_sort(F.array_distinct(F.concat(plain, prefix, sounds)))


def without_zeros(digits: Column) -> Column:
    return F.when(digits.rlike("^0+$"), "0").otherwise(F.regexp_replace(digits, "^0+", ""))


def address_tokens(address: Column) -> Column:
    """Tokens of a normalised address (two letters or a digit); numbers lose leading zeros, and those of two
    digits or more also give their last two after s2; sorted, distinct."""
    tokens = F.filter(words(address), lambda t: (F.length(t) >= 2) | t.rlike("^[0-9]$"))
    short = F.transform(tokens, lambda t: F.when(t.rlike("^[0-9]+$"), without_zeros(t)).otherwise(t))
    ends = F.transform(F.filter(short, lambda t: t.rlike("^[0-9]{2,}$")), lambda t: F.concat(F.lit("s2"), F.right(t, F.lit(2))))
    return F.array_sort(F.array_distinct(F.concat(short, ends)))


def number_set(normed: Column) -> Column:
    """Digit runs anywhere, without leading zeros; sorted, distinct."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(normed, F.lit("([0-9]+)")), without_zeros)))


@F.pandas_udf(StringType())
def compatible_folded(texts: pd.Series) -> pd.Series:
    """NFKC and case folding."""
    return texts.map(lambda x: x if x.isascii() and x.islower() else unicodedata.normalize("NFKC", x).casefold(), na_action="ignore")


def view_text(s: Column) -> Column:
    """Compatibility-folded text in which letters, numbers and marks of every script stay and & is a word."""
    s = F.coalesce(s, F.lit(""))
    plain = s.rlike(r"^[\x00-\x7F]*$")
    folded = F.when(plain, F.lower(s)).otherwise(compatible_folded(F.when(~plain, s)))
    spelled = F.replace(folded, F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(spelled, r"[^\p{L}\p{N}\p{M}]+", " "))


def latin_folded(view: Column) -> Column:
    """A view without the accents of Latin letters; other scripts keep their marks."""
    return F.translate(view, _ACCENTED, _BASE)


_SUFFIX = "( (" + "|".join(sorted(LEGAL_SUFFIXES, key=lambda x: -len(x.split()))) + "))+$"


def core_name(view: Column) -> Column:
    """Without legal forms at its end; what is nothing but legal forms stays."""
    bare = F.trim(F.regexp_replace(F.concat(F.lit(" "), view), _SUFFIX, ""))
    return F.when(bare == "", view).otherwise(bare)


def canonical_address(view: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in ADDRESS_WORDS.items() for x in pair])
    return F.array_join(F.transform(words(view), lambda t: F.coalesce(F.try_element_at(table, t), t)), " ")


def token_sorted(view: Column) -> Column:
    return F.array_join(F.array_sort(words(view)), " ")


def numeric_tokens(view: Column) -> Column:
    """Digits of any script with Latin letters behind them that stand alone, in order, repeats kept."""
    return F.regexp_extract_all(view, F.lit(r"(?<![\p{L}\p{N}_])(\p{Nd}+[a-zıſ]*)(?![\p{L}\p{N}_])"), 1)


@lru_cache(maxsize=1)
def _script_ranges() -> dict[str, str]:
    """Script -> the code points, as ranges of a character class, of the letters that are named after it."""
    found: dict[str, list[list[int]]] = {s: [] for s in SCRIPTS}
    for code in range(0x20000):
        if chr(code).isalpha() and (script := next((s for s in SCRIPTS if s in unicodedata.name(chr(code), "")), None)):
            ranges = found[script]
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    return {s: "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in ranges) for s, ranges in found.items()}


def script_flags(raw: Column) -> Column:
    """Sorted names of the scripts of its letters, by the letters' Unicode names."""
    raw = F.coalesce(raw, F.lit(""))
    ranges = _script_ranges()
    named = [F.when(raw.rlike(f"[{ranges[s]}]"), s) for s in SCRIPTS]
    other = F.when(raw.rlike(rf"[\p{{L}}&&[^{''.join(ranges.values())}]]"), "OTHER")
    return F.array_sort(F.array_compact(F.array(*named, other)))


def last_word(view: Column) -> Column:
    """The last token of three characters or more with a letter, else empty."""
    return F.coalesce(F.get(F.reverse(F.filter(words(view), lambda t: (F.length(t) >= 3) & t.rlike(r"\p{L}"))), F.lit(0)), F.lit(""))


def char_ngrams(value: Column, n: int = 3) -> Column:
    """Distinct sorted n-grams of ^value$ with spaces collapsed; a shorter one whole, of an empty one none."""
    padded = F.concat(F.lit("^"), F.trim(F.regexp_replace(value, " +", " ")), F.lit("$"))
    count = F.length(padded) - (n - 1)
    grams = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.substr(padded, i, F.lit(n)))
    return F.when(F.length(padded) <= 2, F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(grams)))
