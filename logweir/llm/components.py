"""Connected components of a large graph, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); ``root`` is the smallest node of the component.

    Each round hooks a node's label, and the label of that label, to the smallest label next to it, then lets every
    node take its label's label. Labels only fall and are nodes of the same component, so it ends at the minimum; the
    number of rounds grows with the logarithm of the longest path. Each round's labels are stored, so that a round
    reads two tables and a hot label is split by adaptive execution. The edges and labels never leave the executors;
    the driver sees two numbers a round. No edges: no rows.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), "labels")
    before = None
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("low"))
        offers = labels.join(near, labels["node"] == near["a"]).where("low < root")
        hooked = stored(
            labels.union(offers.select("node", "low")).union(offers.select("root", "low"))
            .groupBy("node").agg(F.min("root").alias("root")), "labels")
        up = hooked.select(F.col("node").alias("via"), F.col("root").alias("top"))
        labels = stored(hooked.join(up, hooked["root"] == up["via"]).select("node", F.col("top").alias("root")), "labels")
        now = labels.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "root"))).first()
        if now == before:
            return labels
        before = now
