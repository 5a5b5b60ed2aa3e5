"""The engine's operators applied to the standard tables: one query for each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import similarity as S
from ..functions import text as T
from ..operators import band, blocking, consensus, decide, features, metrics, models, sampling, validate
from ..operators import entities as manifest_ops
from ..sources import fixtures, tables
from ..sources.store import stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _docs(spark: SparkSession, d: str) -> DataFrame:
    """Prepared records: written, as most plans read them several times."""
    return stored(blocking.prepared(fixtures.er_docs(spark, d)), "records")


def _parts(spark: SparkSession, d: str) -> DataFrame:
    """Prepared records: dealt out first, as few small files hold the rows of very many keys."""
    dealt = fixtures.er_parts(spark, d).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "entity_id")
    return stored(blocking.prepared(dealt), "records")


def _candidates(records: DataFrame, k: int = blocking.TOP_K) -> DataFrame:
    return stored(blocking.ranked(blocking.key_evidence(records), k), "candidates")


def _truth(records: DataFrame) -> DataFrame:
    return records.where("owner_id is not null").select(F.col("owner_id").alias("s1_id"), F.col("entity_id").alias("rec_id"))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


@query
def norm_text(spark: SparkSession, d: str) -> DataFrame:
    return blocking.prepared(fixtures.er_docs(spark, d)).select("entity_id", "name", "address")


@query
def text_flags(spark: SparkSession, d: str) -> DataFrame:
    urls = fixtures.table(spark, d, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"), F.col("url").alias("s"))
    heads = fixtures.er_docs(spark, d).select(F.col("entity_id").alias("id"), F.col("business_name").alias("s"))
    return urls.unionByName(heads).select("id", T.is_non_latin(F.col("s")).alias("non_latin"), T.looks_like_domain(F.col("s")).alias("domain"))


@query
def skeletons(spark: SparkSession, d: str) -> DataFrame:
    both = [blocking.prepared(records).select("entity_id", "skeleton") for records in (fixtures.er_docs(spark, d), fixtures.er_parts(spark, d))]
    return both[0].unionByName(both[1])


@query
def token_views(spark: SparkSession, d: str) -> DataFrame:
    return blocking.prepared(fixtures.er_docs(spark, d)).select("entity_id", *[F.array_join(c, " ").alias(c) for c in ("name_tokens", "address_tokens", "numbers")])


@query
def record_keys(spark: SparkSession, d: str) -> DataFrame:
    return blocking.record_keys(blocking.prepared(fixtures.er_docs(spark, d))).select("entity_id", "ktype", "key")


@query
def key_df_capped(spark: SparkSession, d: str) -> DataFrame:
    records = _docs(spark, d)
    return blocking.usable_keys(blocking.record_keys(records.where("src = 'S1'")), records.where("src = 'S1'"))


@query
def candidates_evidence(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(blocking.key_evidence(_docs(spark, d)), "sA", "sX", "sN", "ksum")


@query
def candidates_evidence_parts(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(blocking.key_evidence(_parts(spark, d)), "sA", "sX", "sN", "ksum")


@query
def candidates_topk(spark: SparkSession, d: str) -> DataFrame:
    top = blocking.ranked(blocking.key_evidence(_docs(spark, d)))
    return _rounded(top, "kshare", "kgap").select("country", "rec_id", "s1_id", "ncand_rec", "krank", "kshare", "kgap", "mindf")


@query
def candidates_topk_parts(spark: SparkSession, d: str) -> DataFrame:
    top = blocking.ranked(blocking.key_evidence(_parts(spark, d)))
    return _rounded(top, "kshare", "kgap").select("country", "rec_id", "s1_id", "ncand_rec", "krank", "kshare", "kgap", "mindf")


@query
def owner_partition(spark: SparkSession, d: str) -> DataFrame:
    r = fixtures.er_docs(spark, d).select("entity_id", "src", "owner_id", "country")
    s1 = r.where("src = 'S1'").select(F.col("entity_id").alias("owner_id"))
    pool = tables.pool(r.where("src = 'S2'"), r.where("src = 'S3'"))
    owned = pool.join(s1, "owner_id", "left_semi").withColumn("kind", F.lit("owned"))
    orphans = pool.join(s1, "owner_id", "left_anti").withColumn("kind", F.lit("orphan"))
    return owned.unionByName(orphans).groupBy("country", "src", "kind").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("owner_id").alias("owners"))


@query
def candidate_recall(spark: SparkSession, d: str) -> DataFrame:
    records = _docs(spark, d)
    s1 = records.where("src = 'S1'").select(F.col("entity_id").alias("s1_id"))
    return metrics.candidate_recall(s1, _candidates(records), _truth(records))


@query
def recall_at_k(spark: SparkSession, d: str) -> DataFrame:
    records = _docs(spark, d)
    return blocking.recall_at(blocking.ranked(blocking.key_evidence(records), 16), _truth(records))


@query
def least_safe_k(spark: SparkSession, d: str) -> DataFrame:
    records = _docs(spark, d)
    return blocking.least_safe_k(blocking.recall_at(blocking.ranked(blocking.key_evidence(records), 16), _truth(records)))


@query
def number_features(spark: SparkSession, d: str) -> DataFrame:
    records = _parts(spark, d)
    pairs = _candidates(records).select("rec_id", "s1_id", "mindf", "mdA", "mdX", "mdN", "cap")
    pair = features.paired(pairs, records, ["name", "address", "numbers", "business_name", "src"])
    out = features.relative_df(features.pool_flags(features.number_features(pair)))
    return _rounded(out, "numj").select("rec_id", "s1_id", "numj", "numeq", "lnn", "lna", "nonlat", "dom", "aempty", "isS2", "mindf_rel", "mdA_rel", "mdX_rel", "mdN_rel")


def _name_pairs(spark: SparkSession, d: str) -> DataFrame:
    records = _docs(spark, d)
    pairs = _candidates(records).select("rec_id", "s1_id")
    return features.paired(pairs, records, ["name", "skeleton", "address"])


@query
def ratio_features(spark: SparkSession, d: str) -> DataFrame:
    """The ratios among the string scores, as whole numbers."""
    return features.string_scores(_name_pairs(spark, d)).select("rec_id", "s1_id", "nr", "nsk", "nso", "ar")


@query
def set_partial_ratio(spark: SparkSession, d: str) -> DataFrame:
    pair = features.string_scores(_name_pairs(spark, d))
    return pair.select("rec_id", "s1_id", "nts", "npr", "nskts", "ats", "apr")


@query
def stage1_features(spark: SparkSession, d: str) -> DataFrame:
    records = _docs(spark, d)
    return features.stage1_features(_candidates(records), records)


@query
def consensus_support(spark: SparkSession, d: str) -> DataFrame:
    records = _docs(spark, d)
    scored = _candidates(records).select("country", "s1_id", "rec_id", F.round("kshare", 6).alias("p1"))
    found = consensus.with_consensus(scored, records, score=consensus.jaccard_100)
    return found.withColumns({c: F.round(c, 9) for c in ("bestn", "besta")})


@query
def consensus_support_ratio(spark: SparkSession, d: str) -> DataFrame:
    """consensus_support by the operator's own token-set ratio."""
    records = _docs(spark, d)
    scored = _candidates(records).select("country", "s1_id", "rec_id", F.round("kshare", 6).alias("p1"))
    return consensus.with_consensus(scored, records)


@query
def band_idf(spark: SparkSession, d: str) -> DataFrame:
    records = _docs(spark, d)
    pairs = _candidates(records).where(band.in_band(F.col("kshare"))).select("country", "s1_id", "rec_id")
    out = band.idf_profile(pairs, records, "name", "n")
    return _rounded(out, "ncom", "nmis", "next", "nmaxmis", "nmaxext", "njac")


@query
def house_number_profile(spark: SparkSession, d: str) -> DataFrame:
    records = _parts(spark, d)
    pairs = _candidates(records).select("rec_id", "s1_id")
    pair = band.house_numbers(features.paired(pairs, records, ["numbers"]))
    return pair.drop("a_numbers", "b_numbers")


@query
def macro_fbeta(spark: SparkSession, d: str) -> DataFrame:
    entities, scored = fixtures.er_eval(spark, d)
    return metrics.macro_fbeta(metrics.entity_counts(entities, scored, 0.5))


@query
def threshold_scan(spark: SparkSession, d: str) -> DataFrame:
    return metrics.threshold_scan(*fixtures.er_eval(spark, d)).select("t", "macro_f", "predicted", "hits")


@query
def threshold_plateau(spark: SparkSession, d: str) -> DataFrame:
    return metrics.plateau(metrics.threshold_scan(*fixtures.er_eval(spark, d)))


@query
def threshold_curve(spark: SparkSession, d: str) -> DataFrame:
    return metrics.threshold_curve(*fixtures.er_eval(spark, d))


@query
def prefix_hits(spark: SparkSession, d: str) -> DataFrame:
    return metrics.prefix_hits(fixtures.er_eval(spark, d)[1]).select("s1_id", "rec_id", "rank", "hits")


@query
def metric_report(spark: SparkSession, d: str) -> DataFrame:
    entities, scored = fixtures.er_eval(spark, d)
    return metrics.metric_report(metrics.entity_counts(entities, scored, 0.5))


@query
def loss_decomposition(spark: SparkSession, d: str) -> DataFrame:
    entities, scored = fixtures.er_eval(spark, d)
    counts = metrics.entity_counts(entities, scored, 0.5)
    reachable = scored.where("score >= 0.3").groupBy("s1_id").agg(F.sum("label").alias("ctp"))
    return metrics.loss_parts(counts, reachable)


@query
def one_owner(spark: SparkSession, d: str) -> DataFrame:
    pairs = blocking.key_evidence(_docs(spark, d))
    return decide.one_owner(pairs, "ksum").select("rec_id", "s1_id")


@query
def entity_lists(spark: SparkSession, d: str) -> DataFrame:
    entities, scored = fixtures.er_eval(spark, d)
    return decide.entity_lists(entities, scored.where("score >= 0.5"), "score")


@query
def inference_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    records = _docs(spark, d)
    pairs = _candidates(records)
    return decide.inference_diagnostics(records, pairs, decide.one_owner(pairs.where("kshare >= 0.5"), "ksum"))


def _lists(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    entities, scored = fixtures.er_eval(spark, d)
    return entities, decide.entity_lists(entities, scored.where("label = 1")), decide.entity_lists(entities, scored.where("score >= 0.5"))


@query
def keyed_score(spark: SparkSession, d: str) -> DataFrame:
    entities, truth, predicted = _lists(spark, d)
    return metrics.metric_report(validate.keyed_counts(truth, predicted).join(entities, "s1_id"))


@query
def aligned_score(spark: SparkSession, d: str) -> DataFrame:
    _, truth, predicted = _lists(spark, d)
    counts = validate.aligned_counts(truth.withColumn("pos", F.col("s1_id")), predicted.withColumn("pos", F.col("s1_id")))
    return counts.agg(F.count(F.lit(1)).alias("entities"), F.round(F.avg(metrics.fbeta(F.col("nt"), F.col("np"), F.col("tp"))), 6).alias("macro_f"))


@query
def validate_outputs(spark: SparkSession, d: str) -> DataFrame:
    entities, scored = fixtures.er_eval(spark, d)
    tagged = scored.withColumn("rec_id", F.concat(F.lit("S2-"), F.col("s1_id").cast("string"), F.lit("-"), F.col("rec_id").cast("string")))
    matches = decide.entity_lists(entities.where("s1_id % 50 <> 7"), tagged.where("score >= 0.5"))
    candidates = decide.entity_lists(entities, tagged.where("score >= 0.6 or s1_id % 3 <> 0"))
    bad = validate.list_violations(entities, matches, candidates)
    return bad.groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


@query
def list_counters(spark: SparkSession, d: str) -> DataFrame:
    _, truth, predicted = _lists(spark, d)
    return validate.list_counters(predicted, truth)


@query
def profile_source(spark: SparkSession, d: str) -> DataFrame:
    return tables.profile(fixtures.er_docs(spark, d).where("src <> 'S1'"), "S2-")


def _channel_pairs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    views = stored(blocking.channel_views(fixtures.er_docs(spark, d)), "views")
    return views, stored(blocking.channel_candidates(views), "channel-pairs")


@query
def channel_retrieval(spark: SparkSession, d: str) -> DataFrame:
    return _channel_pairs(spark, d)[1]


@query
def channel_popcount(spark: SparkSession, d: str) -> DataFrame:
    _, pairs = _channel_pairs(spark, d)
    return pairs.groupBy("mask").agg(F.count(F.lit(1)).alias("pairs")).withColumn("channels", F.bit_count("mask")).withColumn("names", F.array_join(K.channel_names(F.col("mask")), ","))


_VIEW_COLUMNS = ["name_view", "name_fold", "name_core", "canonical", "address_fold", "name_numbers", "address_numbers", "scripts", "src"]


def _scored_channels(spark: SparkSession, d: str, scores: bool) -> DataFrame:
    views, pairs = _channel_pairs(spark, d)
    pair = features.channel_features(features.paired(pairs, views, _VIEW_COLUMNS), scores)
    return pair.withColumn("score", F.round(features.heuristic_score(pair), 6))


@query
def channel_features(spark: SparkSession, d: str) -> DataFrame:
    out = _scored_channels(spark, d, True)
    return out.drop(*[c for c in out.columns if c.startswith(("a_", "b_"))])


@query
def ranked_pool(spark: SparkSession, d: str) -> DataFrame:
    return decide.ranked_pool(_scored_channels(spark, d, False)).select("s1_id", "rec_id", "score", "place")


@query
def hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    truth = _truth(fixtures.er_docs(spark, d)).withColumn("label", F.lit(1))
    ranked = decide.ranked_pool(_scored_channels(spark, d, False)).join(truth, ["s1_id", "rec_id"], "left").na.fill(0, ["label"])
    return decide.hard_negatives(ranked.select("s1_id", "rec_id", "label", "place"), 3)


@query
def ranked_pool_ratio(spark: SparkSession, d: str) -> DataFrame:
    """ranked_pool by the operator's own string scores."""
    return decide.ranked_pool(_scored_channels(spark, d, True)).select("s1_id", "rec_id", "score", "place")


@query
def hard_negatives_ratio(spark: SparkSession, d: str) -> DataFrame:
    """hard_negatives of the ranking by the operator's own string scores."""
    truth = _truth(fixtures.er_docs(spark, d)).withColumn("label", F.lit(1))
    ranked = decide.ranked_pool(_scored_channels(spark, d, True)).join(truth, ["s1_id", "rec_id"], "left").na.fill(0, ["label"])
    return decide.hard_negatives(ranked.select("s1_id", "rec_id", "label", "place"), 3)


@query
def inject_missed(spark: SparkSession, d: str) -> DataFrame:
    _, pairs = _channel_pairs(spark, d)
    return decide.inject_missed(pairs.select("s1_id", "rec_id", "mask"), _truth(fixtures.er_docs(spark, d)))


@query
def candidate_statistics(spark: SparkSession, d: str) -> DataFrame:
    records = _docs(spark, d)
    s1 = records.where("src = 'S1'").select(F.col("entity_id").alias("s1_id"), sampling.assign_split(F.col("entity_id")).alias("split"), "country")
    return metrics.candidate_statistics(s1, _candidates(records).select("s1_id", "rec_id"), _truth(records))


@query
def name_address_views(spark: SparkSession, d: str) -> DataFrame:
    views = blocking.channel_views(fixtures.er_docs(spark, d))
    joined = [F.array_join(c, " ").alias(c) for c in ("address_numbers", "scripts")]
    return views.select("entity_id", "name_view", "name_fold", "name_core", T.token_sorted(F.col("name_fold")).alias("name_sorted"), "canonical", "tail", "address_missing", *joined)


@query
def split_assign(spark: SparkSession, d: str) -> DataFrame:
    entities, _ = fixtures.er_eval(spark, d)
    return entities.select("s1_id", sampling.assign_split(F.col("s1_id").cast("string")).alias("split"))


@query
def match_bins(spark: SparkSession, d: str) -> DataFrame:
    entities, scored = fixtures.er_eval(spark, d)
    counts = metrics.entity_counts(entities, scored, 0.5)
    return counts.groupBy(sampling.match_count_bin(F.col("nt")).alias("bin")).agg(F.count(F.lit(1)).alias("entities"))


@query
def char_ngrams(spark: SparkSession, d: str) -> DataFrame:
    p = fixtures.table(spark, d, "part")
    return p.select("p_partkey", F.explode(T.char_ngrams(F.col("p_name"))).alias("gram"))


@query
def universe_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.closed_universe(fixtures.er_docs(spark, d), 100).select("entity_id", "src")


@query
def class_capped_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.class_capped(fixtures.er_eval(spark, d)[1], 2000).select("s1_id", "rec_id", "label")


@query
def query_manifest(spark: SparkSession, d: str) -> DataFrame:
    records = fixtures.er_docs(spark, d)
    views = blocking.channel_views(records)
    lists = decide.entity_lists(records.where("src = 'S1'").select(F.col("entity_id").alias("s1_id")), _truth(records))
    return manifest_ops.manifest(views, lists.select("s1_id", validate.parse_ids(F.col("ids")).alias("ids")))


@query
def missed_records(spark: SparkSession, d: str) -> DataFrame:
    """The records of the true pairs that the candidates lack."""
    records = _docs(spark, d)
    lost = manifest_ops.missed(_truth(records), _candidates(records))
    return manifest_ops.records_of(records, lost).select("entity_id", "name", "address")


@query
def placeholder_candidates(spark: SparkSession, d: str) -> DataFrame:
    records = _docs(spark, d)
    s1 = records.where("src = 'S1'").select(F.col("entity_id").alias("s1_id"), "country")
    kept = manifest_ops.survivors(_candidates(records).select("country", "s1_id", "rec_id", "krank", F.round("kshare", 6).alias("p1")))
    return manifest_ops.with_placeholders(s1, kept)


@query
def density_sample(spark: SparkSession, d: str) -> DataFrame:
    found = manifest_ops.density_sample(_docs(spark, d), 100)
    return _rounded(found, "kshare", "kgap").select("country", "rec_id", "s1_id", "ncand_rec", "krank", "kshare", "kgap")


@query
def distinct_countries(spark: SparkSession, d: str) -> DataFrame:
    return manifest_ops.countries(fixtures.er_docs(spark, d))


@query
def table_counts(spark: SparkSession, d: str) -> DataFrame:
    records = fixtures.er_docs(spark, d)
    return manifest_ops.table_counts({name.lower(): records.where(F.col("src") == name) for name in ("S1", "S2", "S3")})


@query
def match_summary(spark: SparkSession, d: str) -> DataFrame:
    records = stored(fixtures.er_docs(spark, d), "records")
    return manifest_ops.match_summary(records.where("src = 'S1'").select(F.col("entity_id").alias("s1_id")), _truth(records))


@query
def embedding_cosine(spark: SparkSession, d: str) -> DataFrame:
    e = fixtures.table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").alias("v"))
    first = e.groupBy("label").agg(F.min_by("v", "vec_id").alias("w"))
    return e.join(first, "label").select("vec_id", F.round(S.cosine(F.col("v"), F.col("w")), 6).alias("cosine"))


@query
def pair_model_oof(spark: SparkSession, d: str) -> DataFrame:
    """Out-of-fold scores of a small boosted model on native pair features, summarised per country."""
    records = _docs(spark, d)
    pairs = _candidates(records)
    pair = features.number_features(features.paired(pairs, records, ["name", "numbers"]))
    truth = _truth(records).withColumn("label", F.lit(1))
    names = ["ksum", "kshare", "kgap", "krank", "ncand_rec", "nA", "nX", "nN", "numj", "numeq"]
    rows = pair.join(truth.hint("merge"), ["s1_id", "rec_id"], "left").na.fill(0, ["label"]).select("country", "s1_id", "rec_id", F.col("a_name").alias("name"), "label", *names)
    out = models.out_of_fold(stored(rows, "pair-rows"), lambda: models.boosted(names, trees=5))
    return out.groupBy("country").agg(F.count(F.lit(1)).alias("pairs"), F.sum("label").alias("positives"), F.count_if((F.col("p1") >= 0.5) & (F.col("label") == 1)).alias("hits"))
