"""Connected components of a graph of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.durable import drop_durable, durable


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); the component is its smallest node.

    Each round every node points at the smallest node among itself and its neighbours, pointers are
    followed to their roots, and the links are rewritten between roots and made distinct. Roots of a
    component shrink at least by half per round. Every round is written, so a lost executor costs
    one round. No links give an empty result; self-links and repeated links do no harm.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
    edges = durable(both.distinct(), "component-edges")
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        pointers = durable(
            edges.groupBy("node").agg(F.least("node", F.min("other")).alias("root")), "component-pointers"
        )
        roots = _followed(pointers)
        first = roots.withColumnRenamed("root", "first")
        second = roots.select(F.col("node").alias("other"), F.col("root").alias("second"))
        merged = durable(
            edges.join(first, "node")
            .join(second, "other")
            .where(F.col("first") != F.col("second"))
            .select(F.col("first").alias("node"), F.col("second").alias("other"))
            .distinct(),
            "component-edges",
        )
        drop_durable(edges)
        rounds.append(roots)
        edges = merged
    if not rounds:
        return edges.select("node", F.col("node").alias("component"))
    labels = rounds[0].withColumnRenamed("root", "component")
    for roots in rounds[1:]:
        step = roots.select(F.col("node").alias("component"), F.col("root").alias("next"))
        labels = labels.join(step, "component", "left").select("node", F.coalesce("next", "component").alias("component"))
    written = durable(labels, "component-labels")
    drop_durable(edges, *rounds)
    return written


def _followed(pointers: DataFrame) -> DataFrame:
    """Pointers (node, root) jumped until every root points at itself. Pointers only go down."""
    while True:
        target = pointers.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = durable(
            pointers.join(target, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")),
            "component-pointers",
        )
        open_ends = jumped.where("moved").isEmpty()
        drop_durable(pointers)
        pointers = jumped
        if open_ends:
            written = jumped.select("node", "root")
            written._durable_path = jumped._durable_path
            return written
        pointers = jumped.select("node", "root")
        pointers._durable_path = jumped._durable_path
