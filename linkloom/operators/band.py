"""Extra features for pairs in the ambiguous score band: token rarity and house numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

LOW, HIGH = 0.05, 0.97


def in_band(score: Column, low: float = LOW, high: float = HIGH) -> Column:
    return score.between(low, high)


def nearest_to(scored: DataFrame, threshold: float, most: int, score: str = "p2") -> DataFrame:
    """The `most` pairs whose score is nearest to the threshold, ties by ids: a stated limit of the band."""
    return scored.orderBy(F.abs(F.col(score) - threshold), "s1_id", "rec_id").limit(most)


def token_df(records: DataFrame, column: str) -> DataFrame:
    """(country, token, df): S1 records of a country that have the token in the view, with n, its S1 records."""
    s1 = records.where("src = 'S1'")
    n = s1.groupBy("country").agg(F.count(F.lit(1)).alias("n"))
    tokens = s1.select("country", F.explode(F.array_distinct(T.words(F.col(column)))).alias("token"))
    return tokens.groupBy("country", "token").agg(F.count(F.lit(1)).alias("df")).join(n, "country")


def idf_profile(pairs: DataFrame, records: DataFrame, column: str, prefix: str) -> DataFrame:
    """pairs (country, s1_id, rec_id) with com, mis, ext (rarity of common, S1-only and pool-only tokens),
    maxmis, maxext and jac, each with the prefix. Rarity of a token of document frequency d among n
    records is ln((n+1)/(d+1)) / ln(n+1). Only what a country has one row of may be broadcast."""
    view = records.select("entity_id", F.array_distinct(T.words(F.col(column))).alias("tokens"))
    a, b = (view.select(F.col("entity_id").alias(of), F.col("tokens").alias(x)).hint("merge") for of, x in (("s1_id", "a"), ("rec_id", "b")))
    both = pairs.select("country", "s1_id", "rec_id").join(a, "s1_id").join(b, "rec_id")

    def typed(kind: str, tokens: Column) -> Column:
        return F.transform(tokens, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("token")))

    kinds = F.concat(*[typed(k, t) for k, t in (("com", F.array_intersect("a", "b")), ("mis", F.array_except("a", "b")), ("ext", F.array_except("b", "a")))])
    exploded = both.select("country", "s1_id", "rec_id", F.explode(kinds).alias("k")).select("country", "s1_id", "rec_id", "k.kind", "k.token")
    df = token_df(records, column)
    n = records.where("src = 'S1'").groupBy("country").agg(F.count(F.lit(1)).alias("n_s1"))
    idf = F.log((F.col("n_s1") + 1) / (F.coalesce("df", F.lit(0)) + 1)) / F.log(F.col("n_s1") + 1)
    rated = exploded.join(n, "country").join(df.drop("n").hint("merge"), ["country", "token"], "left").withColumn("idf", idf)
    of = lambda kind: F.when(F.col("kind") == kind, F.col("idf"))
    sums = rated.groupBy("country", "s1_id", "rec_id").agg(*[F.coalesce(F.sum(of(k)), F.lit(0.0)).alias(f"{prefix}{k}") for k in ("com", "mis", "ext")], *[F.coalesce(F.max(of(k)), F.lit(0.0)).alias(f"{prefix}max{k}") for k in ("mis", "ext")])
    names = [f"{prefix}{k}" for k in ("com", "mis", "ext", "maxmis", "maxext")]
    out = pairs.join(sums.hint("merge"), ["country", "s1_id", "rec_id"], "left").na.fill(0.0, names)
    return out.withColumn(f"{prefix}jac", F.col(f"{prefix}com") / (F.col(f"{prefix}com") + F.col(f"{prefix}mis") + F.col(f"{prefix}ext") + 1e-9))


def house_numbers(pair: DataFrame) -> DataFrame:
    """Ten features of a_numbers against b_numbers: least edit distance, equality of some pair, a proper
    suffix, only the last digit different, missing, and counts. -1 and missing if a side has none."""
    a, b = F.col("a_numbers"), F.col("b_numbers")
    crossed = F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.struct(x.alias("x"), y.alias("y")))))
    missing = (F.size(a) == 0) | (F.size(b) == 0)
    some = lambda test: F.when(missing, -1).otherwise(F.exists(crossed, lambda p: test(p["x"], p["y"])).cast("int"))
    but_last = lambda x: F.substr(x, F.lit(1), F.length(x) - 1)
    return pair.withColumns({
        "hn_min_edit": F.when(missing, -1).otherwise(F.array_min(F.transform(crossed, lambda p: F.levenshtein(p["x"], p["y"])))),
        "hn_exact": some(lambda x, y: x == y),
        "hn_suffix": some(lambda x, y: (x != y) & (F.endswith(x, y) | F.endswith(y, x))),
        "hn_lastdigit": some(lambda x, y: (x != y) & (F.length(x) == F.length(y)) & (but_last(x) == but_last(y))),
        "hn_missing": missing.cast("int"),
        "hn_ncommon": F.size(F.array_intersect(a, b)), "hn_nA": F.size(a), "hn_nB": F.size(b), "hn_onlyA": F.size(F.array_except(a, b)), "hn_onlyB": F.size(F.array_except(b, a)),
    })
