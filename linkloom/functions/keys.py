"""Blocking keys: conjunctions of two tokens, signature bands and channel masks."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

#: Channel bits of the multi-channel blocker, from the lowest.
CHANNELS = ["EXACT_NAME", "EXACT_CORE", "EXACT_ADDRESS", "EXACT_CANONICAL", "NAME_LSH", "ADDRESS_LSH", "NUMBER_FIRST", "NUMBER_LAST"]


def unordered_pairs(tokens: Column) -> Column:
    """a|b for all a before b in a sorted array."""
    n = F.size(tokens)
    pairs = F.flatten(F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.transform(F.slice(tokens, i + 1, n), lambda b: F.concat_ws("|", F.element_at(tokens, i.cast("int")), b))))
    return F.when(n < 2, F.array().cast("array<string>")).otherwise(pairs)


def crossed_pairs(left: Column, right: Column) -> Column:
    return F.flatten(F.transform(left, lambda a: F.transform(right, lambda b: F.concat_ws("|", a, b))))


def conjunctive_keys(name_tokens: Column, address_tokens: Column) -> Column:
    """array<struct<ktype, key>>: A pairs of address tokens, X name by address, N pairs of name tokens."""

    def typed(kind: str, keys: Column) -> Column:
        return F.transform(keys, lambda k: F.struct(F.lit(kind).alias("ktype"), k.alias("key")))

    return F.concat(typed("A", unordered_pairs(address_tokens)), typed("X", crossed_pairs(name_tokens, address_tokens)), typed("N", unordered_pairs(name_tokens)))


def md5_int(value: Column, digits: int = 8) -> Column:
    """The first hexadecimal digits of the md5 as a number: equal in every engine."""
    return F.conv(F.substr(F.md5(value), F.lit(1), F.lit(digits)), 16, 10).cast("long")


@F.pandas_udf(LongType())
def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """64-bit similarity hash of an array of grams: bit b is 1 if at least half of the grams' hashes (the first
    half of md5) have it; 0 without grams."""
    known: dict[str, bytes] = {}

    def digest(gram: str) -> bytes:
        if gram not in known:
            if len(known) > 200_000:
                known.clear()
            known[gram] = md5(gram.encode()).digest()[:8]
        return known[gram]

    def one(grams) -> int:
        if grams is None or not len(grams):
            return 0
        bits = np.unpackbits(np.frombuffer(b"".join(map(digest, grams)), np.uint8).reshape(-1, 8), axis=1)
        return int.from_bytes(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) >= len(grams)).tobytes(), "big", signed=True)

    for batch in batches:
        yield pd.Series([one(x) for x in batch], dtype="int64")


def bands(hash_: Column, count: int = 4, width: int = 16) -> Column:
    """Slices of a hash, the lowest first."""
    return F.array(*[F.shiftrightunsigned(hash_, width * b).bitwiseAND((1 << width) - 1).cast("int") for b in range(count)])


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def channel_names(mask: Column) -> Column:
    return F.array_compact(F.array(*[F.when(mask.bitwiseAND(1 << i) != 0, name) for i, name in enumerate(CHANNELS)]))
