"""Connected components of a graph stored as a table of links."""

from pyspark.sql import DataFrame, functions as F

from ..workspace import Workspace


def connected_components(links: DataFrame, a: str, b: str, workspace: Workspace) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for every node with a link.

    In each round a node takes the smallest label among its neighbours' and then the
    label of its label, so paths shorten by half. Each round is written out: nothing
    is collected but the number of nodes that still changed. Links to itself, repeated
    links and links with a null end are harmless.
    """
    both = links.select(F.col(a).alias("u"), F.col(b).alias("v")).dropna().filter("u <> v")
    edges = workspace.save(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = workspace.save(
        edges.groupBy("u").agg(F.min("v").alias("v")).select(
            F.col("u").alias("node"), F.least("u", "v").alias("component")
        ),
        "labels",
    )
    while True:
        label_of = labels.select(F.col("node").alias("v"), F.col("component").alias("near"))
        nearest = edges.join(label_of, "v").groupBy("u").agg(F.min("near").alias("near"))
        stepped = labels.join(nearest.withColumnRenamed("u", "node"), "node").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("step")
        )
        jump = labels.select(F.col("node").alias("step"), F.col("component").alias("jump"))
        # The table before this round serves the jump; its labels only ever fall.
        moved = stepped.join(jump, "step").select(
            "node", "before", F.least("step", "jump").alias("component")
        )
        labels = workspace.save(moved, "labels")
        if labels.filter("component <> before").isEmpty():
            return labels.select("node", "component")
