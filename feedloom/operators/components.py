"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import ensure_checkpoint_dir


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that a node is linked to, by label propagation with pointer jumping.

    edges: (a, b) of BIGINT. Each round is checkpointed in the shared folder, so a lost executor repeats one round only. Labels only fall, so the rounds end;
    they go on until none falls any more.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct().checkpoint()
    labels = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("component")).checkpoint()
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("near"))
        new = labels.join(near, labels["node"] == near["a"], "left").select("node", "component", F.least("component", F.coalesce("near", "component")).alias("low"))
        roots = new.select(F.col("node").alias("root"), F.col("low").alias("root_low"))
        new = new.join(roots, new["low"] == roots["root"], "left").select("node", "component", F.coalesce("root_low", "low").alias("low")).checkpoint()
        moved = new.filter("low <> component").limit(1).count()
        labels = new.select("node", F.col("low").alias("component"))
        if not moved:
            return labels
