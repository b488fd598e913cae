"""URL filters: domain rules first, then a path-template tree learned per host.

Template tree: the paths of a host form a tree of segments. Digits in a
segment become `<n>`. At each node, segments that hold too small a share of a
node with many children become the wildcard `*`. Branches that remain beside
each other are compared with the node's largest branch: those whose tails are
distributed much as that branch's, by Jensen-Shannon divergence, are merged
with it into `{}`. Labels have no part in that; they enter through purity: a
template is rejected when its smoothed labelled purity
(blocked + prior) / (labelled + weight) exceeds a threshold. Labels are any
verdicts on URLs; by default those that the rules give, so a rule on one branch
also tells of branches that are built like it.

Defined cases: a NULL URL, or one without `://`, has an empty host and path;
no rule fits it, and its template has no labels, so it is allowed. Segments
beyond the tree's depth stay together as one tail. Repeated rows count as
often as they occur. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import table, written

# The rules of the query, (rule, verdict).
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

DEPTH = 6
MAX_CHILDREN, MIN_SHARE = 8, 0.02
SIMILAR = 0.05
PRIOR, PRIOR_WEIGHT, REJECT = 0.3, 4.0, 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host, and path, of a URL; both empty where there is no '://'."""
    there = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return (F.when(there, F.translate(host, upper, lower)).otherwise(F.lit("")),
            F.when(there, path).otherwise(F.lit("")))


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or NULL."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        domain, _, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def segments(path: Column, depth: int = DEPTH) -> Column:
    """Segments of a path with digits generalised; what lies deeper stays one segment."""
    return F.split(F.regexp_replace(F.regexp_replace(path, r"^/", ""), r"[0-9]+", "<n>"), "/", depth)


def learn_templates(urls: DataFrame, depth: int = DEPTH, max_children: int = MAX_CHILDREN,
                    min_share: float = MIN_SHARE, similar: float = SIMILAR) -> DataFrame:
    """(host, segs, template, blocked, labelled): the template of each generalised path of each host.

    urls: host, segs, label ('block', 'allow' or NULL). After the first
    aggregate the work is on distinct generalised paths. One round for each
    level of the tree; every round is a partial aggregate and a join.
    """
    label = F.coalesce("label", F.lit("none"))
    paths = written(urls.groupBy("host", "segs", label.alias("label")).agg(F.count("*").alias("n")).withColumn(
        "prefix", F.lit("")), "paths")
    deepest = paths.agg(F.max(F.size("segs"))).first()[0] or 0
    for level in range(min(depth, deepest)):
        seg = F.try_element_at("segs", F.lit(level + 1))
        tail = F.array_join(F.slice("segs", level + 2, depth), "/")
        here = paths.where(F.size("segs") > level)
        kids = written(here.groupBy("host", "prefix", seg.alias("seg"), tail.alias("tail")).agg(F.sum("n").alias("n")), "kids")
        nodes = kids.groupBy("host", "prefix").agg(F.sum("n").alias("node_n"))
        child = kids.groupBy("host", "prefix", "seg").agg(F.sum("n").alias("seg_n"))
        wide = child.groupBy("host", "prefix").agg(F.count("*").alias("width"))
        shares = written(child.join(nodes, ["host", "prefix"]).join(wide, ["host", "prefix"]).withColumn(
            "kept", (F.col("width") <= max_children) | (F.col("seg_n") >= min_share * F.col("node_n"))), "shares")
        # Jensen-Shannon divergence of each kept branch from the largest one, over their tails
        beside = shares.where("kept AND width > 1").select("host", "prefix", "seg", "seg_n")
        largest = beside.groupBy("host", "prefix").agg(F.max(F.struct("seg_n", "seg")).alias("top")).select(
            "host", "prefix", F.col("top.seg").alias("seg"), F.col("top.seg_n").alias("top_n"))
        tops = kids.join(largest, ["host", "prefix", "seg"]).select(
            "host", "prefix", "tail", (F.col("n") / F.col("top_n")).alias("q"))
        both = kids.join(beside, ["host", "prefix", "seg"]).join(tops, ["host", "prefix", "tail"])
        p, q = F.col("n") / F.col("seg_n"), F.col("q")
        m = (p + q) / 2
        # a tail that only one of them has adds half of its share there
        parts = both.groupBy("host", "prefix", "seg").agg(
            F.sum(p * F.log2(p / m) / 2 + q * F.log2(q / m) / 2).alias("shared"),
            F.sum(p).alias("mass_p"), F.sum(q).alias("mass_q"))
        alike = parts.where(F.col("shared") + (2 - F.col("mass_p") - F.col("mass_q")) / 2 <= similar).select(
            "host", "prefix", "seg", F.lit(True).alias("alike"))
        crowd = alike.groupBy("host", "prefix").agg(F.count("*").alias("crowd"))
        names = written(shares.join(alike, ["host", "prefix", "seg"], "left").join(crowd, ["host", "prefix"], "left").select(
            F.col("host").alias("h"), F.col("prefix").alias("p"), F.col("seg").alias("s"),
            F.when(~F.col("kept"), "*").when(F.col("alike") & (F.col("crowd") > 1), "{}").otherwise(F.col("seg")).alias("name")),
            "names")
        joined = paths.withColumn("seg", seg).join(
            names, (F.col("host") == F.col("h")) & (F.col("prefix") == F.col("p")) & (F.col("seg") == F.col("s")), "left")
        paths = written(joined.select("host", "segs", "label", "n", F.when(
            F.col("name").isNull(), F.col("prefix")).otherwise(F.concat("prefix", F.lit("/"), "name")).alias("prefix")), "paths")
    count = lambda *kinds: F.sum(F.when(F.col("label").isin(*kinds), F.col("n")).otherwise(0))
    totals = paths.groupBy("host", "prefix").agg(
        F.sum("n").alias("urls"), count("block").alias("blocked"), count("block", "allow").alias("labelled"))
    members = paths.select(F.col("host").alias("h"), "segs", F.col("prefix").alias("p")).distinct()
    return members.join(totals, (F.col("h") == F.col("host")) & (F.col("p") == F.col("prefix"))).select(
        "host", "segs", F.col("prefix").alias("template"), "urls", "blocked", "labelled")


def smoothed_purity(blocked: Column, labelled: Column, prior: float = PRIOR, weight: float = PRIOR_WEIGHT) -> Column:
    return (blocked + prior * weight) / (labelled + weight)


def filter_urls(pages: DataFrame, key: str = "page_id", url: str = "url", rules=RULES,
                labels: DataFrame | None = None) -> DataFrame:
    """(key, host, path, rule, template, purity, verdict) of every row.

    labels(url, label): further labelled URLs to learn templates from.
    """
    host, path = host_and_path(F.col("u"))
    split = pages.select(F.col(key).alias("k"), F.col(url).cast("string").alias("u")).select("k", host.alias("host"), path.alias("path"))
    split = split.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    split = split.withColumn("segs", segments(F.col("path")))
    known = split.select("host", "segs", F.col("found.verdict").alias("label"))
    if labels is not None:
        host, path = host_and_path(F.col("url"))
        known = known.unionByName(labels.select(host.alias("host"), segments(path).alias("segs"), "label"))
    templates = written(learn_templates(known).select(
        F.col("host").alias("h"), F.col("segs").alias("s"), "template",
        smoothed_purity(F.col("blocked"), F.col("labelled")).alias("purity")), "templates")
    out = split.join(templates, (F.col("host") == F.col("h")) & (F.col("segs") == F.col("s")), "left")
    method = F.when(F.col("purity") > REJECT, "block").otherwise("allow")
    return out.select(F.col("k").alias(key), "host", "path", F.col("found.rule").alias("rule"), "template", "purity",
                      F.coalesce(F.col("found.verdict"), method).alias("verdict"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract result of filter_urls over all pages; the rules' verdicts label the templates."""
    return filter_urls(table(spark, sf_dir, "pages"))
