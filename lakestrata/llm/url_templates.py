"""Operator 4: URL filter by rules and per-host path-template trees.

Explicit rules come first. What they label teaches the rest: per host, path segments form a tree; a
segment of numbers or hex digits becomes a placeholder, a node with very many rare children makes them a
wildcard, and siblings whose labelled rates are statistically alike (the Wilson interval of each lies on the
same side of one half) become one branch. A template is rejected if its purity, the share of blocked labels smoothed from its
parent's side, reaches ``REJECT``. The smoothing comes down the tree: a template without labels is judged by the labelled
branches beside it, of which it takes many of one kind, and one blocked branch of a host does not condemn the others.

Urls are pre-aggregated to (host, segments) before anything else, so the tree works on distinct shapes; the
levels are joins and sums over that table, and a hot host is many shapes and sums. The tree has the paths' real
depth, but a step follows whatever all shapes below a node have in common, so there are as many steps as branchings or
ends of other shapes on one path. A segment that begins with ``*`` is written ``%2A``.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and is judged
by the template of the empty host (allowed without labels); repeated rows get equal results; other columns
do not matter; at most ``MAX_RULES`` rules (they are part of the expression).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.tables import Scratch, documents

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
MAX_RULES = 1000
MAX_CHILDREN, RARE = 32, 0.01
MIN_LABELS, PRIOR_WEIGHT, REJECT = 5, 10.0, 0.8
#: labelled branches that count as much as the prior of the node they hang from
BRANCH_WEIGHT = 4.0
_Z = 1.96

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def parse(urls: DataFrame, url_col: str) -> DataFrame:
    """``urls`` with ``host`` and ``path``."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    return urls.withColumns({"host": F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), "path": F.regexp_extract(url, _URL, 2)})


def fitting_rule(rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits ``host`` and ``path``, else null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is asked first
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(slash + path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _segments(path: Column) -> Column:
    """The path's parts with numbers and long hex runs as placeholders."""
    parts = F.array_remove(F.split(path, "/"), "")
    parts = F.transform(parts, lambda x: F.regexp_replace(F.regexp_replace(x, r"(?i)\b(?=[0-9a-f]*[0-9])[0-9a-f]{12,}\b", "{h}"), "[0-9]+", "{n}"))
    return F.transform(parts, lambda x: F.regexp_replace(x, r"^\*", "%2A"))


def _wilson(bad: Column, n: Column, sign: int) -> Column:
    p, z2 = bad / n, _Z * _Z
    return (p + z2 / (2 * n) + sign * _Z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)


def _common(a: Column, b: Column) -> Column:
    """How many parts two arrays begin with in common; ``a`` is not the larger."""
    differ = F.array_position(F.zip_with(F.slice(a, F.lit(1), F.least(F.size(a), F.size(b))), F.slice(b, F.lit(1), F.least(F.size(a), F.size(b))), lambda x, y: x != y), True)
    return F.when(differ > 0, differ.cast("int") - 1).otherwise(F.size(a))


def grow_templates(shapes: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, segments, template, prior) from (host, segments, n, labelled, bad). ``prior`` is what a template's blocked
    share is taken for before its own labels: the mean share of the labelled branches beside it, each branch one unit,
    smoothed by the prior of the node they hang from, and so on up to an even chance at the host."""
    tree, step, steps = shapes.withColumns({"template": F.lit(""), "prior": F.lit(0.5)}), 0, []
    done = tree.filter(F.size("segments") == 0)
    live = tree.filter(F.size("segments") > 0).withColumn("at", F.lit(0))
    while live.limit(1).count():
        live = live.withColumns({"part": F.get("segments", F.col("at")), "rest": F.slice("segments", F.col("at") + 1, F.size("segments"))})
        child = live.groupBy("host", "template", "part").agg(*(F.sum(c).alias(c) for c in ("n", "labelled", "bad")), F.first("prior").alias("above"),
                                                             F.min("rest").alias("least"), F.max("rest").alias("most"))
        child = scratch.keep(child, f"child-{step}")
        rate = F.when(F.col("labelled") > 0, F.col("bad") / F.col("labelled"))
        node = child.groupBy("host", "template").agg(
            F.count("*").alias("children"), F.sum("n").alias("all"),
            ((F.coalesce(F.sum(rate), F.lit(0.0)) + BRANCH_WEIGHT * F.first("above")) / (F.count(rate) + BRANCH_WEIGHT)).alias("beside"))
        rare = (F.col("children") > MAX_CHILDREN) & (F.col("n") < RARE * F.col("all"))
        told = F.col("labelled") >= MIN_LABELS
        name = (F.when(rare, F.lit("*")).when(told & (_wilson(F.col("bad"), F.col("labelled"), -1) > 0.5), F.lit("*blocked"))
                .when(told & (_wilson(F.col("bad"), F.col("labelled"), 1) < 0.5), F.lit("*allowed")))
        # an only child: nothing changes on the way that all its shapes have in common
        left = F.when(F.col("children") == 1, _common(F.col("least"), F.col("most"))).otherwise(1)
        named = child.join(node, ["host", "template"]).select("host", "template", "part", "beside", left.alias("left"), name.alias("name"))
        grown = live.join(named, ["host", "template", "part"])
        names = F.when(F.col("name").isNull(), F.slice("segments", F.col("at") + 1, F.col("left"))).otherwise(F.array_repeat("name", F.col("left")))
        grown = grown.withColumns({"template": F.concat("template", F.lit("/"), F.array_join(names, "/")), "prior": F.col("beside"), "at": F.col("at") + F.col("left")})
        grown = scratch.keep(grown.select(*tree.columns, "at"), f"tree-{step}")
        scratch.drop(f"child-{step}")
        steps.append(scratch.path(f"tree-{step}"))
        live, step = grown.filter(F.size("segments") > F.col("at")), step + 1
    if steps:
        done = done.unionByName(scratch.spark.read.schema(grown.schema).parquet(*steps).filter(F.size("segments") == F.col("at")).drop("at"))
    return done


def judge_urls(pages: DataFrame, scratch: Scratch, *, id_col: str = "page_id", url_col: str = "url",
               rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict, template, purity, labelled."""
    rule, verdict = fitting_rule(rules)
    rows = parse(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")), "url")
    rows = rows.withColumns({"rule": rule, "by_rule": verdict, "segments": _segments(F.col("path"))}).drop("url")
    shapes = rows.groupBy("host", "segments").agg(F.count("*").alias("n"), F.count("by_rule").alias("labelled"),
                                                  F.count_if(F.col("by_rule") == "block").alias("bad"))
    shapes = scratch.keep(shapes, "shapes")
    tree = grow_templates(shapes, scratch)
    sums = tree.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"), F.min("prior").alias("prior"))
    purity = (F.col("bad") + PRIOR_WEIGHT * F.col("prior")) / (F.col("labelled") + PRIOR_WEIGHT)
    sums = sums.select("host", "template", "labelled", purity.alias("purity"))
    judged = scratch.keep(tree.select("host", "segments", "template").join(sums, ["host", "template"]), "judged")
    out = rows.join(judged, ["host", "segments"], "left")
    by_template = F.when(F.col("purity") >= REJECT, F.lit("block")).otherwise(F.lit("allow"))
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("by_rule", by_template).alias("verdict"), "template",
                      "purity", "labelled")


def op4_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(documents(spark, sf_dir, "pages"), Scratch(spark, "urls"))


QUERIES = {"op4_url_templates": op4_url_templates}
ORACLES: dict[str, str] = {}
