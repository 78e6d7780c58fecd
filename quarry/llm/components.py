"""Connected components of links, as a loop of joins over tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.storage import removed, saved


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with a link; component is the least node that can be reached.

    Each round every node takes the least label among its neighbours, then the label of that label, so
    chains shorten by half. Links are summed up per node by partial aggregates before the shuffle.
    """
    edges = saved(links.select(F.col(a).alias("x"), F.col(b).alias("y")).union(links.select(F.col(b), F.col(a))).distinct(), "edges")
    labels = saved(edges.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("y")).select("node", F.least("node", "y").alias("label")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("y"), "label"), "y").groupBy(F.col("x").alias("node")).agg(F.min("label").alias("near"))
        low = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("further"))
        new = saved(low.join(jump, "low", "left").select("node", "old", F.least("low", F.coalesce("further", "low")).alias("label")), "labels")
        removed(labels)
        labels = new.select("node", "label")
        if not new.filter("label < old").limit(1).count():
            removed(edges)
            return labels.select("node", F.col("label").alias("component"))
        labels = new.select("node", "label")
