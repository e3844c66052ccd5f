"""Connected components over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.llm.common import few, scratch, written


def components(links: DataFrame) -> DataFrame:
    """node, component: the least node reachable, for every node of ``links`` (columns a, b, of one ordered type).

    In each round every node takes the first node among itself and its neighbours, in an order by hashes, then what that
    one took. Nodes that took the same one are one node from there on, with the links that still lead to others, so
    each round joins fewer rows than the one before: a star is one node after two rounds, a chain loses a good part in
    each. Links of a node to itself only name the node; null nodes are ignored.
    """
    with scratch(links.sparkSession) as kept:
        labels = _labels(links)
        least = written(labels.groupBy("label").agg(F.min("node").alias("component")), "least")
        return kept(labels.join(few(least, "label", "component"), "label").select("node", "component"), "components")


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )


def _labels(links: DataFrame) -> DataFrame:
    """node, label: some node of the same component, one for all of them."""
    known = links.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    links = written(known.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while True:
        # A hub's links are summed in each task before they are shuffled.
        first = F.min(F.struct(F.xxhash64("other").alias("place"), "other"))
        heard = _both_ways(links).groupBy("node").agg(first.alias("first"))
        own = F.struct(F.xxhash64("node").alias("place"), F.col("node").alias("other"))
        took = written(heard.select("node", F.least(own, "first").getField("other").alias("took")), "labels")
        of_took = few(took, "node", "took").select(F.col("node").alias("took"), F.col("took").alias("label"))
        # What a node took has links itself, so it took something as well.
        step = written(took.join(of_took, "took").select("node", "label"), "labels")
        moved = few(step, "node", "label")
        if labels is None:
            labels = step
        else:
            later = moved.select(F.col("node").alias("label"), F.col("label").alias("next"))
            labels = written(labels.join(later, "label", "left").select("node", F.coalesce("next", "label").alias("label")), "labels")
        for end in ("a", "b"):
            links = links.join(moved.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label")), end)
        links = links.select(F.least("a_label", "b_label").alias("a"), F.greatest("a_label", "b_label").alias("b"))
        links = written(links.where("a != b").distinct(), "links")
        if not links.limit(1).count():
            return labels
