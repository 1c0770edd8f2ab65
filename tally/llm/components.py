"""Connected components of a link table, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.shared import written


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` of every node of ``links``: the least id that can be reached.

    Each round a node takes the least label among its own, its neighbours' and
    that of the node its label names; rounds end when no label changes, after
    about the logarithm of the longest path. Labels are written to the shared
    folder each round. Null ends and self links are ignored. Joins on a much
    linked node read two written tables, so AQE can split them.
    """
    proper = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    rows = 2 * links.count()
    both = proper.unionByName(proper.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = written(both, "edges", rows)
    labels = written(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("other"))
                     .select("id", F.least("id", "other").alias("component")), "labels", rows)
    while True:
        known = labels.select(F.col("id").alias("b"), F.col("component").alias("near"))
        nearest = edges.join(known, "b").groupBy(F.col("a").alias("id")).agg(F.min("near").alias("near"))
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("far"))
        moved = (labels.join(jump, "component").join(nearest, "id")
                 .select("id", F.col("component").alias("before"), F.least("component", "far", "near").alias("component")))
        moved = written(moved, "labels", rows)
        if moved.where("before <> component").isEmpty():
            return moved.select("id", "component")
        labels = moved.select("id", "component")
