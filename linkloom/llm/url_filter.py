"""URL filters: rules, and a tree of path templates for what no rule decides.

Per host, paths form a tree of segments. Variable segments become wildcards: by their form (numbers,
hexadecimal, dates, long words) and, among siblings, where a segment is too rare to be a branch of
its own. Sibling branches that don't differ statistically, in how they go on and end and in their
labels, are merged pair by pair. A path's template is its way through the tree. The rules' verdicts are
labels; a node of the tree is judged by the smoothed blocked share of its labels if most of its urls
have one, and a template by the nearest node at or above it that is, so that labels reach urls that no
rule fits. All expressions are Spark's own; urls are aggregated to distinct path forms first, so a host
of any size costs as much as its forms.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class TemplateConfig:
    """The tree has as many levels as the paths. least_rows, least_share: a word segment with fewer rows or a
    smaller share of its siblings' rows is variable, so a node has at most 1 / least_share branches to compare.
    z: critical value (1 %) of the tests that two branches are labelled, and blocked, at the same rate; that
    of how they go on is CHI_SQUARE's for the ways that occur. strength: pseudo-observations at the labels'
    overall share; reject: smoothed share from which a node is rejected; coverage: least share of a node's
    urls that must be labelled for it to be judged."""

    least_rows: int = 5
    least_share: float = 0.01
    z: float = 2.58
    strength: float = 5.0
    reject: float = 0.9
    coverage: float = 0.5


#: Critical values (1 %) of chi-square by degrees of freedom from 0.
CHI_SQUARE = [0.0, 6.635, 9.210, 11.345, 13.277, 15.086, 16.812, 18.475]


def url_host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without :// or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_verdict(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. A rule `host/path` fits its host and all
    subdomains, if the url's path starts with the rule's; of equally long rules the first as text wins."""
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        at, slash, start = text.partition("/")
        fits = ((host == at) | F.endswith(host, F.lit(f".{at}"))) & F.startswith(path, F.lit(slash + start))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def segment_form(segment: Column) -> Column:
    """A segment's wildcard by its form, else the segment itself, with its file ending set apart."""
    end = F.regexp_extract(segment, r"(\.[A-Za-z0-9]{1,5})$", 1)
    stem = F.regexp_replace(segment, r"\.[A-Za-z0-9]{1,5}$", "")
    form = (
        F.when(stem.rlike(r"^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$"), "{date}")
        .when(stem.rlike(r"^[0-9]+$"), "{number}")
        .when(stem.rlike(r"^(?=.*[0-9])[0-9a-fA-F-]{8,}$"), "{hex}")
        .when(stem.rlike(r"[0-9]"), "{mixed}")
        .when(F.length(stem) > 24, "{long}")
        .otherwise(stem)
    )
    return F.concat(form, end)


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], config: TemplateConfig = TemplateConfig(), id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, template, blocked_share) of every row.

    The rules' verdicts are the labels that nodes are judged by; blocked_share is that of the node that
    judges the template, null if none does, which allows. A url without host is allowed, with a null template. Repeated rows are judged alike and
    count as often as they occur; other columns don't matter; an empty table gives no rows.
    """
    url = F.col(url_col).cast("string")
    parsed = pages.select(F.col(id_col).alias("id"), url_host(url).alias("host"), url_path(url).alias("path"))
    rule, verdict = rule_verdict(F.col("host"), F.col("path"), rules)
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    forms = F.transform(segments, segment_form)
    judged = parsed.withColumn("rule", rule).withColumn("by_rule", verdict).withColumn("form", F.array_join(forms, "/"))
    tree = path_templates(judged.where("host <> ''"), config)
    joined = judged.join(tree.select(F.col("host").alias("th"), F.col("form").alias("tf"), "template", "blocked_share", "rejected"), (F.col("host") == F.col("th")) & (F.col("form") == F.col("tf")), "left")
    by_template = F.when(F.coalesce("rejected", F.lit(False)), "block").otherwise("allow")
    return joined.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("by_rule", by_template).alias("verdict"), "template", "blocked_share")


def path_templates(judged: DataFrame, config: TemplateConfig = TemplateConfig()) -> DataFrame:
    """(host, form, template, blocked_share, rejected) of the distinct forms of (host, form, by_rule)."""
    blocked, labelled = F.count_if(F.col("by_rule") == "block"), F.count(F.col("by_rule"))
    forms = judged.groupBy("host", "form").agg(F.count(F.lit(1)).alias("n"), labelled.alias("labelled"), blocked.alias("blocked"))
    tree = written(forms.withColumn("parts", F.when(F.col("form") == "", F.array()).otherwise(F.split("form", "/"))).withColumn("template", F.lit("")), "url-forms")
    closed, level = [tree.where(F.size("parts") == 0)], 0
    growing = tree.where(F.size("parts") > 0)
    while not growing.isEmpty():
        level += 1
        grown = written(_grown(growing, level, config), "url-tree")
        closed.append(grown.where("closed").drop("closed"))
        growing = grown.where("not closed").drop("closed")
    tree = written(reduce(DataFrame.unionByName, closed), "url-templates")
    nodes = tree.groupBy("host", "template").agg(F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    return tree.select("host", "form", "template").join(_judged(nodes, config).select(F.col("host").alias("h"), F.col("template").alias("t"), "blocked_share", "rejected"), (F.col("host") == F.col("h")) & (F.col("template") == F.col("t"))).drop("h", "t")


def _judged(leaves: DataFrame, config: TemplateConfig) -> DataFrame:
    """(host, template, blocked_share, rejected) of leaves (host, template, n, labelled, blocked): those of the
    nearest node from the leaf up to the host's root of which enough is labelled."""
    overall = leaves.agg(F.sum("labelled"), F.sum("blocked")).first()
    prior = (overall[1] / overall[0]) if overall[0] else 0.0
    steps = F.split("template", "/")
    above = leaves.select("host", "template", "n", "labelled", "blocked", F.explode(F.sequence(F.lit(1), F.size(steps))).alias("level"))
    above = above.withColumn("node", F.array_join(F.slice(F.split("template", "/"), F.lit(1), F.col("level")), "/"))
    share = (F.sum("blocked") + config.strength * prior) / (F.sum("labelled") + config.strength)
    nodes = above.groupBy("host", "node").agg(share.alias("share"), (F.sum("labelled") / F.sum("n")).alias("covered"))
    known = nodes.where(F.col("covered") >= config.coverage).select(F.col("host").alias("nh"), "node", "share")
    best = above.select("host", "template", "level", F.col("node").alias("of")).join(known, (F.col("host") == F.col("nh")) & (F.col("of") == F.col("node")), "left")
    best = best.groupBy("host", "template").agg(F.max_by("share", F.when(F.col("share").isNotNull(), F.col("level"))).alias("blocked_share"))
    return best.withColumn("rejected", F.coalesce(F.col("blocked_share") >= config.reject, F.lit(False)))


#: The ways on that the branch test tells apart.
_WAYS = ("end", "{number}", "{hex}", "{date}", "{mixed}", "{long}", "file", "word")


def _way(part: Column) -> Column:
    return (
        F.when(part.isNull(), "end")
        .when(F.startswith(part, F.lit("{")), F.regexp_extract(part, r"^(\{[a-z]+\})", 1))
        .when(F.contains(part, F.lit(".")), "file")
        .otherwise("word")
    )


def _grown(tree: DataFrame, level: int, config: TemplateConfig) -> DataFrame:
    """The paths with one more level decided: each branch at it is itself, a wildcard, or merged with siblings.
    Closed are those that end here or that fewer than least_rows go on with: below, every word would be
    rare by definition, so the rest of their templates is known. All others take part in the next level."""
    part, next_part = F.get("parts", F.lit(level - 1)), F.get("parts", F.lit(level))
    reach = tree.where(part.isNotNull()).withColumn("part", part).withColumn("way", _way(next_part))
    ways = [F.sum(F.when(F.col("way") == w, F.col("n")).otherwise(0)).alias(f"w{i}") for i, w in enumerate(_WAYS)]
    branches = reach.groupBy("host", "template", "part").agg(F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"), *ways)
    branches = written(branches, "url-branches")
    total = branches.groupBy(F.col("host").alias("ph"), F.col("template").alias("pt")).agg(F.sum("n").alias("pn"))
    both = branches.join(total, (F.col("host") == F.col("ph")) & (F.col("template") == F.col("pt"))).drop("ph", "pt")
    formed = F.startswith("part", F.lit("{"))
    rare = (F.col("n") < config.least_rows) | (F.col("n") < config.least_share * F.col("pn"))
    both = both.withColumn("kind", F.when(formed, "formed").when(rare, "rare").otherwise("word"))
    merged = _merged(both.where("kind = 'word'"), config)
    both = both.join(merged, ["host", "template", "part"], "left")
    both = both.withColumn("step", F.when(formed, F.col("part")).when(F.col("kind") == "rare", F.lit("{rare}")).otherwise(F.col("merged")))
    going = both.groupBy(F.col("host").alias("gh"), F.col("template").alias("gt"), F.col("step").alias("gs")).agg(F.sum(F.col("n") - F.col("w0")).alias("going"))
    both = both.join(going, (F.col("host") == F.col("gh")) & (F.col("template") == F.col("gt")) & (F.col("step") == F.col("gs")))
    steps = both.select(F.col("host").alias("ph"), F.col("template").alias("pt"), F.col("part").alias("pp"), "step", "going")
    on = (F.col("host") == F.col("ph")) & (F.col("template") == F.col("pt")) & (part == F.col("pp"))
    closed = (F.size("parts") <= level) | (F.col("going") < config.least_rows)
    rest = F.transform(F.slice("parts", level + 1, F.greatest(F.size("parts") - level, F.lit(0))), lambda p: F.when(F.startswith(p, F.lit("{")), p).otherwise("{rare}"))
    template = F.array_join(F.concat(F.array(F.concat("template", F.lit("/"), "step")), F.when(closed, rest).otherwise(F.array())), "/")
    return tree.join(steps, on).select("host", "form", "n", "labelled", "blocked", "parts", template.alias("template"), closed.alias("closed"))


def _differ(x1: Column, n1: Column, x2: Column, n2: Column) -> Column:
    """The z of two shares x1 / n1 and x2 / n2; 0 where one has no cases or nothing varies."""
    p = (x1 + x2) / (n1 + n2)
    variance = p * (1 - p) * (1 / n1 + 1 / n2)
    return F.when((n1 == 0) | (n2 == 0), 0.0).when(variance <= 0, 0.0).otherwise(F.abs(x1 / n1 - x2 / n2) / F.sqrt(variance))


def _merged(branches: DataFrame, config: TemplateConfig) -> DataFrame:
    """(host, template, part, merged) of word branches: from the most frequent on, each joins the first group
    of siblings that it doesn't differ from, or begins one. A group of several is named after its first.
    A node has at most 1 / least_share such branches, so its array is bounded."""
    ways = F.array(*[F.col(f"w{i}").cast("long") for i in range(len(_WAYS))])
    row = F.struct((-F.col("n")).alias("order"), F.col("part"), F.col("n").cast("long").alias("n"), F.col("labelled").cast("long").alias("labelled"), F.col("blocked").cast("long").alias("blocked"), ways.alias("ways"))
    nodes = branches.groupBy("host", "template").agg(F.array_sort(F.collect_list(row)).alias("rows"))

    def alike(group: Column, x: Column) -> Column:
        cells = F.filter(F.zip_with(group["ways"], x["ways"], lambda v, w: F.struct(v.alias("v"), w.alias("w"))), lambda c: c["v"] + c["w"] > 0)
        a, b = F.sqrt(x["n"] / group["n"]), F.sqrt(group["n"] / x["n"])
        chi = F.aggregate(cells, F.lit(0.0), lambda s, c: s + F.pow(c["v"] * a - c["w"] * b, 2) / (c["v"] + c["w"]))
        critical = F.element_at(F.array(*map(F.lit, CHI_SQUARE)), F.size(cells))
        labelled = _differ(group["labelled"], group["n"], x["labelled"], x["n"])
        blocked = _differ(group["blocked"], group["labelled"], x["blocked"], x["labelled"])
        return (chi <= critical + 1e-9) & (labelled <= config.z) & (blocked <= config.z)

    def group_of(parts: Column, n: Column, labelled: Column, blocked: Column, ways: Column) -> Column:
        return F.struct(parts.alias("parts"), n.alias("n"), labelled.alias("labelled"), blocked.alias("blocked"), ways.alias("ways"))

    def placed(groups: Column, x: Column) -> Column:
        at = F.array_position(F.transform(groups, lambda g: alike(g, x)), F.lit(True))
        joined = F.transform(groups, lambda g, i: F.when(i + 1 == at, group_of(F.concat(g["parts"], F.array(x["part"])), g["n"] + x["n"], g["labelled"] + x["labelled"], g["blocked"] + x["blocked"], F.zip_with(g["ways"], x["ways"], lambda v, w: v + w))).otherwise(g))
        return F.when(at > 0, joined).otherwise(F.concat(groups, F.array(group_of(F.array(x["part"]), x["n"], x["labelled"], x["blocked"], x["ways"]))))

    none = F.array().cast("array<struct<parts:array<string>,n:bigint,labelled:bigint,blocked:bigint,ways:array<bigint>>>")
    groups = nodes.select("host", "template", F.explode(F.aggregate("rows", none, placed)).alias("g"))
    name = F.when(F.size("g.parts") > 1, F.concat(F.lit("{~"), F.col("g.parts")[0], F.lit("}"))).otherwise(F.col("g.parts")[0])
    return groups.select("host", "template", name.alias("merged"), F.explode("g.parts").alias("part"))
