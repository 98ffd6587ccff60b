"""Connected components of a table of links, by label passing with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the least node it is linked with.

    Each round every node takes the least label among its neighbours and then its label's label,
    so a chain of n links takes about log n rounds. Labels are minima, pre-aggregated before their
    shuffle; the joins look up one row per node, so AQE can split a hub's links. A null end links
    nothing; no links give no rows.
    """
    links = links.filter("a is not null and b is not null and a <> b").select("a", "b")
    edges = materialize(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select(
        "node", F.least("node", "b").alias("root")), "labels")
    while True:
        near = (
            edges.join(labels.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        )
        step = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("further"))
        step = materialize(step.join(jump, "root", "left").select(
            "node", "old", F.least("root", F.coalesce("further", "root")).alias("root")), "labels")
        labels = step.select("node", "root")
        if step.filter("root <> old").isEmpty():
            return labels
