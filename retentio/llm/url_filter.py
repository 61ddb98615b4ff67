"""URL filter: rules first, then a path-template tree per host.

Per host the paths form a tree of segments.  Three steps turn it into
templates, all over aggregated (host, template) counts, so a host that holds a
third of all pages is one row per distinct template after the map side:

1. variable segments (numbers, hexadecimal ids, very long names) become typed
   wildcards;
2. level by level down to the longest path, where a node has more than ``max_children`` different literal
   children, those with less than ``1 / max_children`` of its pages become one
   ``*`` child (names a site generates, not sections it has);
3. from the leaves up, sibling branches (templates that differ in one literal
   segment) whose labelled block rates do not differ significantly from their
   pooled rate are merged: they share one labelled count.  A branch without
   labels joins siblings that all agree.

The purity of a template is the block rate of its branch smoothed towards the
nodes above it, theirs towards the host's and that towards the global one; a
template with few or no labels so takes its purity from the tree.  It is
rejected if that purity is ``threshold`` or more and some level it comes from
has ``min_labels`` labelled pages.  Labels are the verdicts of the rules (or a ``label`` column given
by the caller: 1 block, 0 allow, NULL unknown).

Defined results: a NULL url or one without ``://`` has the empty host and
path; NULL ids stay NULL; repeated rows are counted and returned as often as
they occur; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentio.llm.common import stage, table

# Fixed rules of the query: (verdict, rule)
QUERY_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_fits(rule: str) -> Column:
    host, _, path = rule.partition("/")
    return (((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host)))
            & F.startswith(F.col("path"), F.lit("/" + path)))


def match_rule(rules) -> Column:
    """The longest rule that fits (``host/path``), as struct(rule, verdict)."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        out = F.when(rule_fits(rule), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def typed_segments(path: Column) -> Column:
    """Path segments with variable ones as typed wildcards; a suffix such as .html stays."""
    segments = F.split(F.regexp_replace(path, r"^/", ""), "/", -1)
    return F.transform(segments, lambda s: F.when(s.rlike(r"^[0-9]+$"), F.lit("{n}"))
                       .when(s.rlike(r"^(?=.*[0-9])[0-9a-fA-F-]{8,}$"), F.lit("{h}"))
                       .when(F.length(s) > 40, F.lit("{s}"))
                       .otherwise(F.regexp_replace(s, r"[0-9]+", "{n}")))


def _wild(s: Column) -> Column:
    return s.rlike(r"^(\*|\{[nhs]\})")


def _depths(t: DataFrame, column: str, least: int, same_length: bool = False) -> list[int]:
    """Levels at which some host has at least ``least`` different segments that are not wild: no
    other level can hold a node with so many literal children, whatever is merged above it."""
    keys = ["host", "_at", *(["_size"] if same_length else [])]
    seen = (t.select("host", F.size(column).alias("_size"), F.posexplode(column).alias("_at", "_here"))
            .filter(~_wild(F.col("_here"))).select(*keys, "_here").distinct())
    levels = seen.groupBy(*keys).count().filter(F.col("count") >= least).select("_at").distinct()
    return sorted(r["_at"] for r in levels.collect())


def templates(counts: DataFrame, max_children: int = 50) -> DataFrame:
    """``leaf`` (typed segments) -> ``template`` per host with fan-out wildcards.

    ``counts`` has one row per (host, leaf).  Every level of the longest path that
    can hold a wide node is generalised, from the top down."""
    t = counts.withColumn("template", F.col("leaf"))
    for d in _depths(t, "template", max_children + 1):
        here = F.get(F.col("template"), F.lit(d))
        prefix = F.slice(F.col("template"), 1, d)
        t = t.withColumn("_prefix", prefix).withColumn("_here", here)
        literal = F.col("_here").isNotNull() & ~_wild(F.col("_here"))
        children = t.filter(literal).groupBy("host", "_prefix", "_here").agg(F.sum("n").alias("_n"))
        fan_out = children.groupBy("host", "_prefix").agg(F.count("*").alias("_children"), F.sum("_n").alias("_all"))
        rare = (children.join(fan_out, ["host", "_prefix"])
                .filter((F.col("_children") > max_children) & (F.col("_n") * max_children < F.col("_all")))
                .select("host", "_prefix", "_here", F.lit(True).alias("_rare")))
        t = (t.join(rare, ["host", "_prefix", "_here"], "left")
             .withColumn("template", F.when(F.col("_rare"), F.transform(
                 "template", lambda s, i: F.when(i == d, F.lit("*")).otherwise(s))).otherwise(F.col("template")))
             .drop("_prefix", "_here", "_rare"))
        t = stage(t, "templates")      # small: one row per (host, leaf); keeps the plan flat
    return t


def merge_branches(t: DataFrame, z: float = 1.96) -> DataFrame:
    """(host, template, labelled, blocked, branch).  From the leaves up, a literal segment of
    ``branch`` becomes ``~`` where the branch's labelled block rate lies within ``z`` standard
    errors of its pooled siblings'; a branch without labels joins siblings that all agree."""
    per = (t.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
           .withColumn("branch", F.col("template")))
    for d in reversed(_depths(per, "template", 2, same_length=True)):
        pooled = F.transform("branch", lambda s, i: F.when(i == d, F.lit("~")).otherwise(s))
        each = (per.groupBy("host", "branch").agg(F.sum("labelled").alias("_l"), F.sum("blocked").alias("_c"))
                .withColumn("_here", F.get(F.col("branch"), F.lit(d)))
                .filter(~_wild(F.col("_here")) & ~F.col("_here").isin("", "~")).withColumn("pooled", pooled))
        pool = each.groupBy("host", "pooled").agg(F.sum("_l").alias("_n"), F.sum("_c").alias("_b"))
        rate, pool_rate = F.try_divide("_c", "_l"), F.try_divide("_b", "_n")
        error = F.sqrt(F.try_divide(pool_rate * (1 - pool_rate), F.col("_l")))
        tested = each.join(pool, ["host", "pooled"]).withColumn("similar", F.abs(rate - pool_rate) <= z * error)
        agree = tested.groupBy("host", "pooled").agg(F.bool_and("similar").alias("agree"))      # NULL: no labels at all
        moved = (tested.join(agree, ["host", "pooled"]).filter(F.coalesce("similar", "agree", F.lit(False)))
                 .select("host", "branch", "pooled"))
        per = (per.join(moved, ["host", "branch"], "left")
               .select("host", "template", "labelled", "blocked", F.coalesce("pooled", "branch").alias("branch")))
        per = stage(per, "branches")
    return per


def template_verdicts(t: DataFrame, threshold: float = 0.9, min_labels: int = 20, strength: float = 10.0) -> DataFrame:
    """(host, template, n_labelled, purity, rejected) with hierarchical smoothing.

    The levels of a template are its host, the nodes above it (templates of as many segments
    under one prefix) and its branch.  Each level's block rate is smoothed towards the one
    above, the host's towards the global one.  ``n_labelled`` is the count of the lowest level
    with ``min_labels`` labelled pages, and of the branch if no level has as many."""
    merged = stage(merge_branches(t), "merged")
    total = t.agg(F.try_divide(F.sum("blocked"), F.sum("labelled")).alias("r"))
    base = F.coalesce(total.scalar(), F.lit(0.0))
    sums = [F.sum("labelled").alias("_n"), F.sum("blocked").alias("_b")]
    host = merged.groupBy("host").agg(*sums).select("host", F.struct(F.lit(-1).alias("k"), "_n", "_b").alias("_top"))
    branch = merged.groupBy("host", "branch").agg(*sums).select(
        "host", "branch", F.struct(F.lit(1 << 30).alias("k"), "_n", "_b").alias("_own"))
    above = (merged.withColumn("_size", F.size("template"))
             .withColumn("_k", F.explode(F.sequence(F.lit(0), F.greatest(F.col("_size") - 1, F.lit(0)))))
             .withColumn("_prefix", F.slice(F.col("template"), 1, F.col("_k"))))
    node = above.groupBy("host", "_size", "_prefix").agg(*sums).filter(F.col("_n") > 0)
    nodes = (above.join(node, ["host", "_size", "_prefix"]).groupBy("host", "template")
             .agg(F.sort_array(F.collect_list(F.struct(F.col("_k").alias("k"), "_n", "_b"))).alias("_nodes")))
    levels = F.concat(F.array("_top"), F.coalesce("_nodes", F.array().cast("array<struct<k:int,_n:bigint,_b:bigint>>")),
                      F.array("_own"))
    purity = F.aggregate("_levels", F.col("_base"), lambda p, x: (x["_b"] + strength * p) / (x["_n"] + strength))
    enough = F.try_element_at(F.filter("_levels", lambda x: x["_n"] >= min_labels), F.lit(-1))["_n"]
    scored = (merged.join(host, "host").join(branch, ["host", "branch"]).join(nodes, ["host", "template"], "left")
              .withColumn("_levels", levels).withColumn("_base", base)
              .withColumn("purity", purity).withColumn("_enough", enough))
    return scored.select("host", "template", F.coalesce("_enough", "_own._n").alias("n_labelled"), "purity",
                         (F.col("_enough").isNotNull() & (F.col("purity") >= threshold)).alias("rejected"))


def judge(pages: DataFrame, rules=QUERY_RULES, id_col: str = "page_id", url_col: str = "url",
          label_col: str | None = None, max_children: int = 50, threshold: float = 0.9,
          min_labels: int = 20) -> DataFrame:
    """One row per page: id, host, path, rule, template, purity, verdict."""
    url = F.col(url_col).cast("string")
    p = pages.select(F.col(id_col).alias("_id"), host_of(url).alias("host"), path_of(url).alias("path"),
                     *([F.col(label_col).cast("int").alias("_given")] if label_col else []))
    p = p.withColumn("_rule", match_rule(rules)).withColumn("leaf", typed_segments(F.col("path")))
    label = F.when(F.col("_rule.verdict") == "block", 1).when(F.col("_rule.verdict") == "allow", 0)
    if label_col:
        label = F.coalesce(F.col("_given"), label)
    counts = (p.select("host", "leaf", label.alias("_label")).groupBy("host", "leaf")
              .agg(F.count("*").alias("n"), F.count("_label").alias("labelled"),
                   F.coalesce(F.sum("_label"), F.lit(0)).alias("blocked")))
    counts = stage(counts, "url-counts")
    t = templates(counts, max_children)
    judged = (t.select("host", "leaf", "template")
              .join(template_verdicts(t, threshold, min_labels), ["host", "template"])
              .select("host", "leaf", F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"),
                      "n_labelled", "purity", "rejected"))
    return (p.join(judged, ["host", "leaf"], "left")
            .select(F.col("_id").alias(id_col), "host", "path", F.col("_rule.rule").alias("rule"),
                    F.coalesce(F.col("_rule.verdict"), F.when(F.col("rejected"), F.lit("block"))
                               .otherwise(F.lit("allow"))).alias("verdict"),
                    "template", "n_labelled", F.round("purity", 6).alias("purity")))


def query(spark, sf_dir):
    """op10: verdict of every page url."""
    return judge(table(spark, sf_dir, "pages"))
