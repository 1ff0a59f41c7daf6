"""Connected components of a link table by min-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._io import hinted, saved


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the links; root is the smallest node it reaches.

    A round gives every node the smallest label around it and then that label's own label, so that a chain of n links
    takes about log n rounds. Labels are combined before the shuffle, and each round is written out, which cuts the
    lineage and lets a lost executor's part be read again. Nodes must not be null."""
    both = saved(links.select(F.col(a).alias("node"), F.col(b).alias("near")).unionByName(links.select(F.col(b).alias("node"), F.col(a).alias("near"))).where("node <> near").distinct(), "links")
    labels = saved(both.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("root")), "labels")
    for _ in range(most_rounds):
        around = both.join(labels.select(F.col("node").alias("near"), F.col("root").alias("seen")), "near").groupBy("node").agg(F.min("seen").alias("seen"))
        # a root also learns the smallest label that any node of its tree has met
        met = labels.join(around, "node").groupBy(F.col("root").alias("node")).agg(F.min("seen").alias("met"))
        best = labels.join(around, "node").join(met, "node", "left").select("node", F.least("root", "seen", F.coalesce("met", "root")).alias("to"), F.col("root").alias("was"))
        jump = best.select(F.col("node").alias("to"), F.col("to").alias("further"))
        following = best.join(jump, "to").select("node", F.least("to", "further").alias("root"), (F.least("to", "further") != F.col("was")).alias("moved"))
        following = saved(following, "labels")
        moved = following.where("moved").limit(1).count()
        labels = following.drop("moved")
        if not moved:
            return labels
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def joined(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """components() of ``links`` (a, b) together with those that gave ``labels`` (node, root; None: no links yet).

    Only the components meet: a link inside one adds nothing, and of the links between two of them one counts, so that
    the rounds go by the number of components that new links join, not by that of all links found so far."""
    if labels is None:
        return components(links)
    at = lambda c: labels.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    ends = links.join(at("a"), "a", "left").join(at("b"), "b", "left").select(F.coalesce("root_a", "a").alias("x"), F.coalesce("root_b", "b").alias("y"))
    between = saved(ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links-between")
    above = components(between)
    further = hinted(above.select(F.col("node").alias("root"), F.col("root").alias("further")))
    moved = labels.join(further, "root", "left").select("node", F.coalesce("further", "root").alias("root"))
    return saved(moved.unionByName(above.join(labels.select("node"), "node", "left_anti")), "labels")
