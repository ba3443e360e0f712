"""Connected components of an edge table: smallest label, with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored

#: A component of any shape is done in about twice the logarithm of its diameter; far more rounds mean a fault.
MOST_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of edges (u, v), longs: label is the smallest node of its component.

    Each round takes the smallest label among a node and its neighbours, then the label of that label. Rows are summed
    before every shuffle and joins may be split by Spark where a node has very many edges. Each round is written to the
    shared folder, so a lost executor repeats one round at most.

    Defined cases: edges with a null end, and from a node to itself, link nothing; repeated edges count once; no edges give no rows.
    """
    both = stored(edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).filter("u <> v").distinct())
    labels = stored(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("label")))
    for _ in range(MOST_ROUNDS):
        near = both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["u"], "left").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        far = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        now = stored(step.join(far, "label", "left").select("node", "was", F.least("label", "far").alias("label")))
        changed = now.filter("label <> was").limit(1).count()
        labels = now.select("node", "label")
        if not changed:
            return labels
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
