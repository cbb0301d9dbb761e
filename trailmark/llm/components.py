"""Connected components of an edge table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm.shared import BROADCAST_ROWS, materialise, shuffled


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(a, b) long edges to (node, component): the smallest node that is reachable, for every node that has an edge.

    Each round, every node takes the least label among its own and its neighbours', then the label of that label, so a
    chain of n nodes takes about log n rounds. Minima are combined before the shuffle, a node with very many edges is
    dealt out by adaptive execution, and each round's labels are written to the shared folder: nothing gathers in one place.
    Labels that a count shows to be few are sent to the tasks, so a round shuffles only the minima.
    """
    way = lambda x, y: F.struct(F.col(x).alias("node"), F.col(y).alias("other"))
    ways = F.array(way("a", "b"), way("b", "a"), way("a", "a"), way("b", "b"))  # a node is its own neighbour too
    both = materialise(edges.where("a <> b").select(F.inline(ways)).distinct(), "edges")
    labels = materialise(both.groupBy("node").agg(F.min("other").alias("component")), "labels")
    sent = F.broadcast if labels.count() <= BROADCAST_ROWS else shuffled
    for _ in range(max_rounds):
        of = labels.select(F.col("node").alias("other"), F.col("component").alias("seen"))
        own = F.max(F.when(F.col("node") == F.col("other"), F.col("seen")))
        step = both.join(sent(of), "other").groupBy("node").agg(own.alias("was"), F.min("seen").alias("next"))
        root = labels.select(F.col("node").alias("next"), F.col("component").alias("up"))
        # The root's own label is a node's label too, as a label is always a node that is reachable.
        step = step.join(sent(root), "next", "left").select("node", "was", F.least("next", F.coalesce("up", "next")).alias("component"))
        step = materialise(step, "labels")
        labels = step.select("node", "component")
        if step.where("was <> component").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
