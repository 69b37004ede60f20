"""Connected components of a graph of links, by alternating large and small stars.

Each round is two joins and two aggregates over the edges, stored in the shared folder, so
a hub with a third of all edges is an ordinary skewed join. Rounds stop when the edges no
longer change; the number of edges never grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creaseline.sources.workspace import settled


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's neighbours to the smallest of them (or to the node itself)."""
    if large:
        both = edges.union(edges.select("b", "a")).toDF("node", "next")
        least = both.groupBy("node").agg(F.least(F.min("next"), F.col("node")).alias("least"))
        moved = both.join(least, "node").where("next > node").select(F.col("next").alias("a"), F.col("least").alias("b"))
    else:
        down = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("next"))
        least = down.groupBy("node").agg(F.min("next").alias("least"))
        moved = down.join(least, "node").select(F.col("next").alias("a"), F.col("least").alias("b"))
        moved = moved.union(least.select("node", "least"))
    return moved.where("a <> b").distinct()


def component_labels(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node, component: every node of the edges with the smallest node of its component.

    Columns a and b are longs. Edges with a null end and loops are left out; repeated
    edges count once. Without edges there are no rows.
    """
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    edges = settled(edges, "edges")
    before = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            break
        before = mark
        edges = settled(_star(_star(edges, True), False), "edges")
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
