"""Connected components of an undirected graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matricula.session import stored


def contracted(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with the same components, where each b keeps its smallest a and its other a are joined to that one.

    For stars whose many b share few a: one edge a b, and the pairs of a once each however many b they share."""
    least = F.min("a").over(Window.partitionBy("b"))
    each = edges.withColumn("least", least)
    kept = each.select(F.explode(F.array(F.struct(F.col("least").alias("a"), "b"), F.struct(F.col("least").alias("a"), F.col("a").alias("b")))).alias("e"))
    return kept.select("e.*").where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of edges (a, b); null ends are left out.

    Each round every node takes the smallest label around it and then its label's label, so paths shorten by doubling.
    Rounds are written to the shared folder; labels never leave the executors, only the count of changes does."""
    pairs = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    both = stored(pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component")), "labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        stepped = labels.join(around, "node", "left").select("node", F.col("component").alias("was"), F.least("component", F.coalesce("near", "component")).alias("label"))
        stepped = stored(stepped, "labels")
        jump = stepped.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = stored(stepped.join(jump, "label", "left").select("node", "was", F.least("label", F.coalesce("further", "label")).alias("component")), "labels")
        changed = new.where(F.col("was") != F.col("component")).limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            return labels
