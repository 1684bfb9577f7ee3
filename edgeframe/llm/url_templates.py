"""URL filter by a tree of path templates.

Explicit rules come first (host and its subdomains, path prefix, longest rule wins).  For the
rest, each host's paths form a tree of templates:

* digits become ``#``; a node with more than ``FANOUT`` children keeps those that hold
  ``HEAVY`` of its pages and turns the others into the wildcard ``*``.  The tree is as deep as the
  paths are; below a node with no more than ``FANOUT`` paths nothing can become a wildcard, so their
  rest is taken as it is.  A literal ``*`` or ``~`` stands as ``%2A`` or ``%7E``;
* sibling templates that differ in their last literal segment merge if a two-proportion test
  (``Z``) cannot tell their shares of bad labelled pages apart: in the order of the shares, a
  template joins the one before it (the segment becomes ``~`` and the number of the group);
* a template's purity is its share of good labelled pages, smoothed with ``PRIOR`` pages towards
  its host's share, which is smoothed towards the share of all.  It is blocked if that is below
  ``LEAST``, or if even ``UPPER`` standard errors above it are below the share of all.

Nodes and templates are keyed by structs of host, template and segment, never by joined text: a raw
url may hold any character.

Everything is DataFrame work on distinct paths with counts, level by level; lookups by a node that
may hold a third of all rows go through the library's hot-key join.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeframe.llm.textcol import written
from edgeframe.operators.common import hot_key_join

FANOUT, HEAVY = 20, 0.05
Z = 2.0
PRIOR, LEAST, UPPER = 20.0, 0.5, 1.64

#: (verdict, host, path prefix)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and the path; both empty for a null url or one without ``://``."""
    rest = F.coalesce(F.get(F.split(F.col(url), "://", 2), F.lit(1)), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def rule_columns(rules: list[tuple[str, str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def paths(pages: DataFrame, good: DataFrame | None = None, number: Column | None = None) -> DataFrame:
    """One row per host and path: ``at`` (its key), n pages, good and bad labelled pages.  ``good`` has
    (number, good boolean); ``number`` is the label key that a path names."""
    host, path = host_and_path()
    seen = (pages.select(host.alias("host"), path.alias("path")).groupBy("host", "path")
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("at", F.struct("host", "path")))
    if good is None:
        return seen.withColumns({"good": F.lit(0).cast("long"), "bad": F.lit(0).cast("long")})
    seen = seen.withColumn("number", number)
    of = good.where(F.col("number").isNotNull()).groupBy("number").agg(F.min("good").alias("is_good"))
    named = seen.where(F.col("number").isNotNull()).join(of, "number", "left")
    both = named.unionByName(seen.where(F.col("number").isNull()).withColumn("is_good", F.lit(None).cast("boolean")))
    return both.select("host", "path", "n", "at", *[
        F.when(F.col("is_good") == F.lit(v), F.col("n")).otherwise(0).alias(k) for k, v in (("good", True), ("bad", False))])


def template_tree(seen: DataFrame, fanout: int = FANOUT, heavy: float = HEAVY) -> DataFrame:
    """``seen`` with ``template``."""
    shaped = F.regexp_replace(F.regexp_replace("path", "^/", ""), r"[0-9]+", "#")
    parts = F.split(F.replace(F.replace(shaped, F.lit("*"), F.lit("%2A")), F.lit("~"), F.lit("%7E")), "/")
    state = written(seen.withColumns({"parts": parts, "template": F.lit("")}), "paths")
    d = 0
    while d < (state.agg(F.max(F.size("parts"))).first()[0] or 0):
        inner = state.where(F.size("parts") > d).withColumn("node", F.struct("host", "template"))
        inner = inner.withColumn("child", F.struct("host", "template", F.get("parts", F.lit(d)).alias("segment")))
        children = inner.groupBy("node", "child").agg(F.sum("n").alias("pages"), F.count(F.lit(1)).alias("rows"))
        nodes = children.groupBy("node").agg(F.sum("pages").alias("all"), F.sum("rows").alias("paths"),
                                             F.count(F.lit(1)).alias("kinds"))
        wild = (F.col("kinds") > fanout) & (F.col("pages") < heavy * F.col("all"))
        decided = written(hot_key_join(children, nodes, "node", "kinds")
                          .select("child", "rows", wild.alias("wild"), (F.col("paths") <= fanout).alias("few")), "children")
        grown = hot_key_join(inner.drop("node"), decided, "child", "rows")
        label = F.when(F.col("wild"), F.lit("*")).otherwise(F.get("parts", F.lit(d)))
        rest = F.array_join(F.slice("parts", d + 1, F.greatest(F.size("parts") - d, F.lit(0))), "/")
        grown = grown.withColumns({
            "template": F.concat("template", F.lit("/"), F.when(F.col("few"), rest).otherwise(label)),
            "parts": F.when(F.col("few"), F.slice("parts", 1, d + 1)).otherwise(F.col("parts"))})
        state = written(grown.select(state.columns).unionByName(state.where(F.size("parts") <= d)), "paths")
        d += 1
    return state.drop("parts")


def judged_templates(tree: DataFrame, z: float = Z, prior: float = PRIOR, least: float = LEAST,
                     upper: float = UPPER) -> DataFrame:
    """(key, paths, merged, purity, verdict) for each host and template; key is their struct."""
    key = F.struct("host", "template")
    t = tree.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in ("good", "bad")],
                                             F.count(F.lit(1)).alias("paths")).withColumn("key", key)
    # the last literal segment: one without a wildcard or digits
    open_end = F.regexp_replace("template", r"/[^/#*~]+((?:/[^/]*[#*~][^/]*|/)*)\z", "/~$1")
    kin = Window.partitionBy("host", "family")
    labelled = F.col("good") + F.col("bad")
    t = t.withColumn("family", open_end).withColumns({
        "pool": F.sum("bad").over(kin) / F.nullif(F.sum(labelled).over(kin), F.lit(0))})
    pool = F.coalesce("pool", F.lit(0.0))
    ordered = kin.orderBy("share", "template")
    t = t.withColumn("share", (F.col("bad") + pool) / (labelled + 1))
    error = F.sqrt(pool * (1 - pool) * (1 / (labelled + 1) + 1 / (F.lag(labelled).over(ordered) + 1)))
    apart = F.coalesce((F.col("share") - F.lag("share").over(ordered) > z * error).cast("int"), F.lit(0))
    t = t.withColumn("apart", apart).withColumn("group", F.sum("apart").over(ordered))
    t = t.withColumn("alike", F.count(F.lit(1)).over(Window.partitionBy("host", "family", "group")))
    t = t.withColumn("merged", F.when(F.col("alike") > 1, F.replace("family", F.lit("~"), F.concat(
        F.lit("~"), F.col("group").cast("string")))).otherwise(F.col("template")))
    same, host = Window.partitionBy("host", "merged"), tree.groupBy("host").agg(
        F.sum("good").alias("host_good"), F.sum(labelled).alias("host_labelled"))
    total = host.agg(F.sum("host_good").alias("g"), F.sum("host_labelled").alias("l")).collect()[0]
    everywhere = (float(total["g"] or 0) + 1) / (float(total["l"] or 0) + 1)      # no label: all are held good
    own = F.col("host_good") + prior * everywhere
    weight = F.sum(labelled).over(same) + prior
    purity = (F.sum("good").over(same) + prior * own / (F.col("host_labelled") + prior)) / weight
    top = F.col("purity") + upper * F.sqrt(F.greatest(F.col("purity") * (1 - F.col("purity")), F.lit(0.0)) / F.col("weight"))
    return t.join(host, "host").select("key", "paths", "merged", purity.alias("purity"), weight.alias("weight")).select(
        "key", "paths", "merged", "purity",
        F.when((F.col("purity") < least) | (top < everywhere), "block").otherwise("allow").alias("verdict"))


def verdicts(pages: DataFrame, good: DataFrame | None = None, number: Column | None = None,
             rules: list[tuple[str, str, str]] = RULES, **options) -> DataFrame:
    """Query op3, one row per row of ``pages``: page_id, host, path, rule, verdict, then template and
    purity of the path.  Paths of any length and depth are taken whole.  Null urls have host and path empty and their own template; without labels
    every template is pure; repeated rows and repeated labels change nothing but counts (a
    number labelled both ways is bad)."""
    tree = template_tree(paths(pages, good, number), **options)
    templates = judged_templates(tree)
    keyed = tree.select("at", "n", F.struct("host", "template").alias("key"))
    of_path = written(hot_key_join(keyed, written(templates, "templates"), "key", "paths")
                      .select("at", "n", "merged", "purity", F.col("verdict").alias("by_template")), "of_path")
    host, path = host_and_path()
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("at", F.struct("host", "path"))
    rule, verdict = rule_columns(rules, F.col("host"), F.col("path"))
    return hot_key_join(rows, of_path, "at", "n").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, "by_template").alias("verdict"),
        F.col("merged").alias("template"), "purity")


def page_labels(labels: DataFrame) -> DataFrame:
    """(number, good) from a labels table: good unless of low quality or toxic; null: no label."""
    bad = (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)
    return labels.where(F.col("quality").isNotNull() | F.col("toxic").isNotNull()).select(
        F.col("doc_id").cast("long").alias("number"), (~bad).alias("good"))


def last_number() -> Column:
    """The document that a page's path names: the number its last segment begins with."""
    return F.expr("try_cast(nullif(regexp_extract(path, '/([0-9]+)[^/]*/?$', 1), '') AS BIGINT)")
