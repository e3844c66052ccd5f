"""URL filters: written rules first, then a path-template tree learned per host.

The tree of a host has path segments as branches. Segments that few pages of their node share are
generalised to wildcards, however many others there are. Sibling branches whose labels look alike are
merged, and a template is rejected when its smoothed share of bad labels is high. A branch without
labels follows its node, unless the node's branches differ: then only what all hosts show counts.
Every level is a grouping by host and template, so a host with a third of all rows is summed in each
task before rows are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.llm.common import lower_ascii, table, written
from tallylake.llm.registry import query

#: Path segments that are branches of their own, unless another depth is given; what lies deeper is one last segment.
MAX_DEPTH = 6
#: A segment that fewer pages have at its place in the tree becomes a wildcard.
MIN_SUPPORT = 5
#: Branches of one node are summed in so many classes of their share of bad labels before they are compared.
SHARE_CLASSES = 64
#: Branches are merged when their shares of bad labels differ by fewer standard errors than this.
MERGE_Z = 1.64
#: Labels that a template's parent counts for.
SMOOTHING = 5.0
#: Bad labels that no label at all counts as, of one.
PRIOR = 0.1
REJECT_AT = 0.5


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(_after(url), "/", 1)).otherwise("")
    return F.coalesce(lower_ascii(F.substring_index(F.substring_index(rest, "?", 1), "#", 1)), F.lit(""))


def _after(url: Column) -> Column:
    return F.substr(url, F.instr(url, "://") + F.lit(3))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.substring_index(_after(url), "?", 1), "#", 1)).otherwise("")
    return F.coalesce(F.when(F.instr(rest, "/") > 0, F.substr(rest, F.instr(rest, "/"))).otherwise(""), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null where none does. ``rules`` is a written list."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host) + len(r.path), r.host, r.path)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, rule.host + rule.path).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def segments_of(path: Column, depth: int = MAX_DEPTH) -> Column:
    """``depth`` segments at most; the last one holds all that lies deeper. Segments made of digits (with an ending or not),
    long hexadecimal digits or dates are wildcards from the start."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/", depth)
    variable = r"^(?:[0-9]+(?:\.[A-Za-z]+)?|[0-9a-fA-F-]{16,}|[0-9]{4}-[0-9]{2}(?:-[0-9]{2})?)/?$"
    return F.transform(parts, lambda s: F.when(s.rlike(variable), "*").otherwise(s))


def _generalised(counted: DataFrame) -> DataFrame:
    """Replace, level by level, segments that fewer than MIN_SUPPORT pages have below their node by ``*``.

    ``counted``: host, segments, pages, n, bad, with one row per host and segments. Adds ``template``.
    """
    now = counted.withColumn("template", F.array().cast("array<string>"))
    deepest = counted.agg(F.max(F.size("segments"))).first()[0] or 0
    for depth in range(deepest):
        now = now.withColumn("segment", F.get("segments", F.lit(depth)))
        rare = now.where("segment IS NOT NULL").groupBy("host", "template", "segment").agg(F.sum("pages").alias("support"))
        rare = rare.where(F.col("support") < MIN_SUPPORT)
        now = now.join(rare, ["host", "template", "segment"], "left")
        named = F.when(F.col("support").isNotNull(), "*").otherwise(F.col("segment"))
        longer = F.when(F.col("segment").isNull(), F.col("template")).otherwise(F.concat("template", F.array(named)))
        now = now.withColumn("template", longer).drop("support", "segment")
    return now


def _merged(classes: pd.DataFrame) -> pd.DataFrame:
    """Neighbours in share of bad labels join while the shares can't be told apart; SHARE_CLASSES rows at most."""
    rows = classes.assign(share=(classes.bad + PRIOR) / (classes.n + 1.0)).sort_values(["share", "class"])
    groups: list[list[float]] = []
    where = []
    for n, bad in zip(rows.n, rows.bad, strict=True):
        if groups:
            m, b = groups[-1]
            pooled = (bad + b + PRIOR) / (n + m + 1.0)
            error = (pooled * (1 - pooled) * (1 / (n + 1.0) + 1 / (m + 1.0))) ** 0.5
            if abs((bad + PRIOR) / (n + 1.0) - (b + PRIOR) / (m + 1.0)) < MERGE_Z * error:
                groups[-1] = [m + n, b + bad]
                where.append(len(groups) - 1)
                continue
        groups.append([n, bad])
        where.append(len(groups) - 1)
    rows["merged_n"], rows["merged_bad"] = [groups[i][0] for i in where], [groups[i][1] for i in where]
    rows["kinds"] = len(groups)
    return rows[["host", "parent", "class", "merged_n", "merged_bad", "kinds"]]


def template_purity(labelled: DataFrame, depth: int = MAX_DEPTH) -> tuple[DataFrame, DataFrame]:
    """Templates and their smoothed shares of bad labels.

    ``labelled``: host, path, and bad (1, 0, or null where there is no label), a row per page. Returns
    host, segments, template of each distinct path, and host, template, share of each node of the trees.
    """
    counted = labelled.select("host", segments_of(F.col("path"), depth).alias("segments"), "bad").groupBy("host", "segments").agg(
        F.count("*").alias("pages"), F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    paths = written(_generalised(written(counted, "url-paths")), "url-templates")
    leaves = paths.groupBy("host", "template").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = leaves.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    everywhere = ((total["bad"] or 0) + PRIOR) / ((total["n"] or 0) + 1.0)
    # Each node of the trees once: the leaves' counts, summed along every prefix of their templates.
    prefix = F.explode(F.transform(F.sequence(F.lit(0), F.size("template")), lambda i: F.slice("template", 1, i)))
    nodes = leaves.select("host", prefix.alias("node"), "n", "bad").groupBy("host", "node").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad")
    )
    nodes = written(nodes, "url-nodes")
    roots = nodes.where(F.size("node") == 0)
    share = (F.col("bad") + SMOOTHING * F.lit(everywhere)) / (F.col("n") + SMOOTHING)
    level = roots.select("host", "node", share.alias("share"))
    every = level
    deepest = nodes.agg(F.max(F.size("node"))).first()[0] or 0
    by_class = ["host", "parent", "class"]
    for size in range(1, deepest + 1):
        here = nodes.where(F.size("node") == size).select(
            "host", F.slice("node", 1, size - 1).alias("parent"), F.element_at("node", size).alias("branch"),
            F.col("n").cast("double"), F.col("bad").cast("double"),
        )
        own = F.floor((F.col("bad") + PRIOR) / (F.col("n") + 1.0) * SHARE_CLASSES).cast("int")
        here = here.withColumn("class", F.when(F.col("n") > 0, own))  # none without labels
        classes = here.where("class IS NOT NULL").groupBy(*by_class).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        merged = written(classes.groupBy("host", "parent").applyInPandas(
            _merged, "host string, parent array<string>, class int, merged_n double, merged_bad double, kinds int"
        ), "url-merged")
        mixed = merged.where("kinds > 1").select("host", "parent", F.lit(True).alias("mixed")).distinct()
        above = level.select("host", F.col("node").alias("parent"), F.col("share").alias("above"))
        joined = here.drop("n", "bad").join(merged.drop("kinds"), by_class, "left").join(mixed, ["host", "parent"], "left")
        unknown = F.when(F.col("mixed"), F.lit(everywhere)).otherwise(F.col("above"))
        known = (F.col("merged_bad") + SMOOTHING * F.col("above")) / (F.col("merged_n") + SMOOTHING)
        level = written(joined.join(above, ["host", "parent"]).select(
            "host", F.concat("parent", F.array("branch")).alias("node"), F.coalesce(known, unknown).alias("share"),
        ), f"url-level-{size}")
        every = every.unionByName(level)
    return paths.select("host", "segments", "template"), every.select("host", F.col("node").alias("template"), "share")


def judge_urls(pages: DataFrame, rules: Sequence[Rule], depth: int = MAX_DEPTH) -> DataFrame:
    """page_id, host, path, rule, verdict, template, bad_share of every page.

    Input columns: page_id, url; others are ignored. A rule's verdict goes first. The pages that rules
    decide are the labels of the tree (block is bad), and its templates decide the rest; ``depth`` segments
    of a path are told apart, what lies deeper is one text. Rules of one length that fit the same url go by
    their host and path, the last one first; a share of exactly REJECT_AT blocks. A null url or one
    without ``://`` has an empty host and path; they are the pages of one host like any other. Repeated
    rows are judged alike, each one on its own; no rows give no rows.
    """
    read = pages.select(F.col("page_id").cast("long"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = read.withColumns({"rule": name, "ruled": verdict})
    paths, shares = template_purity(ruled.select("host", "path", (F.col("ruled") == "block").cast("int").alias("bad")), depth)
    judged = paths.join(shares, ["host", "template"])
    keyed = ruled.withColumn("segments", segments_of(F.col("path"), depth))
    out = keyed.join(judged, ["host", "segments"], "left")
    tree = F.when(F.col("share") >= REJECT_AT, "block").otherwise("allow")
    return out.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", tree).alias("verdict"),
        F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), F.col("share").alias("bad_share"),
    )


RULES = [
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"),
]


@query("op7_url_filter")
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), RULES)
