"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import stage


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``a, b``, long): the smallest node that it is connected with.

    Each round takes the smallest label among a node and its neighbours, then the label of that label.
    The second step halves the way to the root, so that the rounds grow with the logarithm of a
    component's width. Labels are written out each round: a lost executor costs the round, not the run.
    A label that many nodes share is looked up in a table with one row per label, and
    the minimum per node is folded before the shuffle; adaptive execution may split the lookup.
    """
    pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = pairs.unionByName(pairs.select(F.col("other").alias("node"), F.col("node").alias("other")))
    both = stage(both, "component-edges")
    labels = stage(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("label")), "component-labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("other"), "label"), "other")
        lowest = around.groupBy("node").agg(F.min("label").alias("near"))
        nearer = stage(
            labels.join(lowest, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")), "component-near"
        )
        of_label = nearer.select(F.col("node").alias("label"), F.col("label").alias("next"))
        # A root is its own label's label; only what points at a moved node has to look again.
        moved = of_label.filter("label != next")
        labels = stage(
            nearer.join(moved, "label", "left").select("node", F.coalesce("next", "label").alias("label"), "old"), "component-labels"
        )
        if labels.filter("label != old").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
