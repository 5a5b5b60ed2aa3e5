"""Candidate pairs: conjunctive keys under a frequency cap, or equality channels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import text as T

CAP_LEAST, CAP_SHARE, TOP_K, NO_KEY = 8, 3e-5, 8, 9999
#: Pool records that a lookup by equal names or addresses, and by bands or numbers, may return.
MOST_EXACT, MOST_OTHER = 2000, 800


def prepared(records: DataFrame) -> DataFrame:
    """records with normalised views, skeletons, token arrays and numbers: computed once per record."""
    out = records.withColumn("name", T.norm(F.col("business_name"))).withColumn("address", T.norm(F.col("business_address")))
    return out.withColumns({"skeleton": T.skeleton(F.col("name")), "name_tokens": T.name_tokens(F.col("name")), "address_tokens": T.address_tokens(F.col("address")), "numbers": T.number_set(F.col("address"))})


def record_keys(records: DataFrame) -> DataFrame:
    """(entity_id, src, country, ktype, key) of prepared records."""
    exploded = records.select("entity_id", "src", "country", F.explode(K.conjunctive_keys(F.col("name_tokens"), F.col("address_tokens"))).alias("k"))
    return exploded.select("entity_id", "src", "country", "k.ktype", "k.key")


def usable_keys(s1_keys: DataFrame, s1: DataFrame, cap_least: int = CAP_LEAST, cap_share: float = CAP_SHARE) -> DataFrame:
    """(country, ktype, key, df) with 1 <= df <= cap, cap = max(cap_least, half-even round of cap_share * n)
    for a country's n entities. Frequent keys are dropped by their definition, which also removes skew."""
    caps = s1.groupBy("country").agg(F.greatest(F.lit(cap_least), F.bround(F.lit(cap_share) * F.count(F.lit(1))).cast("long")).alias("cap"))
    df = s1_keys.groupBy("country", "ktype", "key").agg(F.count(F.lit(1)).alias("df"))
    return df.join(caps, "country").where(F.col("df") <= F.col("cap"))


def key_evidence(records: DataFrame, cap_least: int = CAP_LEAST, cap_share: float = CAP_SHARE) -> DataFrame:
    """(country, rec_id, s1_id, sA, sX, sN, nA, nX, nN, mdA, mdX, mdN, cap, ksum, mindf) of all pairs of a pool
    record and an S1 entity that share a usable key; cap is the country's.

    Spark takes exploded keys to be as small as the records they come from and would broadcast them, so
    both joins are by shuffle."""
    all_keys = record_keys(records)
    s1_keys = all_keys.where("src = 'S1'")
    usable = usable_keys(s1_keys, records.where("src = 'S1'"), cap_least, cap_share)
    on = ["country", "ktype", "key"]
    indexed = s1_keys.select(*on, F.col("entity_id").alias("s1_id")).join(usable.hint("merge"), on)
    shared = all_keys.where("src <> 'S1'").select(*on, F.col("entity_id").alias("rec_id")).join(indexed.hint("merge"), on)
    aggs = []
    for t in "AXN":
        of = F.col("ktype") == t
        aggs += [F.sum(F.when(of, 1.0 / F.col("df")).otherwise(0.0)).alias(f"s{t}"), F.count_if(of).alias(f"n{t}"), F.coalesce(F.min(F.when(of, F.col("df"))), F.lit(NO_KEY)).alias(f"md{t}")]
    pairs = shared.groupBy("country", "rec_id", "s1_id").agg(*aggs, F.max("cap").alias("cap"))
    return pairs.withColumn("ksum", F.round(F.col("sA") + F.col("sX") + F.col("sN"), 9)).withColumn("mindf", F.least("mdA", "mdX", "mdN"))


def ranked(pairs: DataFrame, k: int | None = TOP_K) -> DataFrame:
    """pairs with ncand_rec, krank (0-based, ties to the smaller s1_id), kshare and kgap; the best k per record.
    The count is of all candidates, before k cuts."""
    own = Window.partitionBy("country", "rec_id")
    best = own.orderBy(F.col("ksum").desc(), "s1_id")
    whole = best.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    top = F.max("ksum").over(own)
    out = pairs.withColumns({
        "ncand_rec": F.count(F.lit(1)).over(own),
        "krank": F.row_number().over(best) - 1,
        "kshare": F.col("ksum") / top,
        "kgap": (top - F.coalesce(F.nth_value("ksum", 2).over(whole), F.lit(0.0))) / top,
    })
    return out if k is None else out.where(F.col("krank") < k)


def recall_at(pairs: DataFrame, truth: DataFrame, most: int = 16) -> DataFrame:
    """(k, recalled, recall) for k = 1..most from ranked pairs and truth (rec_id, s1_id), joined by shuffle."""
    hit = pairs.join(truth.hint("merge"), ["rec_id", "s1_id"]).groupBy("krank").count()
    total = truth.agg(F.count(F.lit(1)).alias("total"))
    ks = truth.sparkSession.range(1, most + 1).select(F.col("id").cast("int").alias("k"))
    counted = F.broadcast(ks).join(hit.where(F.col("krank") < most), F.col("krank") < F.col("k"), "left").groupBy("k").agg(F.coalesce(F.sum("count"), F.lit(0)).alias("recalled"))
    return counted.join(F.broadcast(total)).select("k", "recalled", F.round(F.try_divide(F.col("recalled"), F.col("total")), 6).alias("recall"))


def least_safe_k(curve: DataFrame, loss: float = 0.002) -> DataFrame:
    """(k): the smallest k of recall_at's curve whose recall is within loss of that at its largest k."""
    best = curve.agg(F.max_by("recall", "k").alias("best"))
    return curve.join(F.broadcast(best)).where(F.col("recall") >= F.round(F.col("best") - loss, 6)).agg(F.min("k").alias("k"))


def channel_views(records: DataFrame) -> DataFrame:
    """records with the views, hashes and numbers of the multi-channel blocker."""
    name, address = T.view_text(F.col("business_name")), T.view_text(F.col("business_address"))
    out = records.withColumns({"name_view": name, "address_view": address, "scripts": T.script_flags(F.col("business_name"))})
    out = out.withColumns({"name_fold": T.latin_folded(F.col("name_view")), "name_core": T.core_name(F.col("name_view")), "canonical": T.canonical_address(F.col("address_view")), "address_fold": T.latin_folded(F.col("address_view")), "address_missing": F.col("address_view") == ""})
    out = out.withColumns({
        "address_numbers": T.numeric_tokens(F.col("canonical")),
        "name_numbers": T.numeric_tokens(F.col("name_view")),
        "tail": T.last_word(F.col("canonical")),
        "name_hash": K.simhash(T.char_ngrams(F.when(F.col("name_core") == "", F.col("name_view")).otherwise(F.col("name_core")))),
        "address_hash": K.simhash(T.char_ngrams(F.col("canonical"))),
    })
    return out.withColumns({"first_number": F.coalesce(F.get("address_numbers", F.lit(0)), F.lit("")), "last_number": F.coalesce(F.try_element_at("address_numbers", F.lit(-1)), F.lit(""))})


def channel_keys(views: DataFrame) -> DataFrame:
    """(entity_id, src, country, bit, key): a row for each channel in which the record has a key that isn't blank."""

    def key(bit: int, *parts) -> object:
        return F.struct(F.lit(1 << bit).alias("bit"), F.concat_ws("|", *parts).alias("key"))

    exact = [F.when(F.col(c) != "", key(i, F.col(c))) for i, c in enumerate(("name_view", "name_core", "address_view", "canonical"))]
    lsh = [F.when(F.col(of) != "", key(i, F.lit(str(b)), F.element_at(K.bands(F.col(h)), b + 1).cast("string"))) for i, of, h in ((4, "name_view", "name_hash"), (5, "canonical", "address_hash")) for b in range(4)]
    numbers = [F.when((F.col(c) != "") & (F.col("tail") != ""), key(i, F.col(c), F.col("tail"))) for i, c in ((6, "first_number"), (7, "last_number"))]
    keys = F.array_compact(F.array(*exact, *lsh, *numbers))
    return views.select("entity_id", "src", "country", F.explode(keys).alias("k")).select("entity_id", "src", "country", "k.bit", "k.key")


def channel_candidates(views: DataFrame, most_exact: int = MOST_EXACT, most_other: int = MOST_OTHER) -> DataFrame:
    """(country, s1_id, rec_id, mask) of all pairs that share a channel key: one equi-join for all channels,
    in place of a disjunction, which would compare all pairs of a country. A key of more pool records than
    a lookup of its channel may return tells nothing apart and is dropped by that definition, so no key
    joins more than these with an entity."""
    keys = channel_keys(views)
    on = ["country", "bit", "key"]
    left = keys.where("src = 'S1'").select(*on, F.col("entity_id").alias("s1_id"))
    right = keys.where("src <> 'S1'").select(*on, F.col("entity_id").alias("rec_id"))
    usable = right.groupBy(*on).agg(F.count(F.lit(1)).alias("df")).where(F.col("df") <= F.when(F.col("bit") < 1 << 4, most_exact).otherwise(most_other)).select(*on)
    shared = left.join(usable, on).join(right, on)
    return shared.groupBy("country", "s1_id", "rec_id").agg(F.bit_or("bit").alias("mask"))
