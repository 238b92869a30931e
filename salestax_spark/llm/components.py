"""Connected components by alternating large and small stars; nothing is gathered on the driver or in one task.

Every step takes minima per node with partial aggregation, writes them, and joins the edges with them, both sides plain
tables, so that Spark can split a node that holds a large share of all edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestax_spark.llm.common import Scratch


def _star(edges: DataFrame, scratch: Scratch, step: str, large: bool) -> DataFrame:
    """Large: every larger neighbour is hung on the least neighbour. Small: every smaller one, and the node itself."""
    if large:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges
    least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    least = scratch.write(f"{step}-least", least)
    if large:
        # Edges are (larger, smaller): the larger end b of an edge at a hangs on the least neighbour of a.
        hung = edges.select(F.col("b").alias("node"), F.col("a").alias("far")).join(least.withColumnRenamed("a", "node"), "node")
        hung = hung.select(F.col("far").alias("a"), F.col("m").alias("b"))
    else:
        hung = edges.join(least, "a").select("b", "m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        hung = hung.unionByName(least.select("a", F.col("m").alias("b")))
    out = scratch.write(step, hung.where("a <> b").distinct())
    scratch.drop(f"{step}-least")
    return out


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(pairs: DataFrame, label: str = "components", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an edge of ``pairs`` (two columns of one orderable type); root is the least node."""
    scratch = Scratch(pairs.sparkSession, label)
    x, y = pairs.columns
    ordered = pairs.where(F.col(x) != F.col(y)).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct()
    edges, name = scratch.write("edges", ordered), "edges"
    before = _fingerprint(edges)
    for k in range(max_rounds):
        grown = _star(edges, scratch, f"large-{k}", large=True)
        shrunk = _star(grown, scratch, f"small-{k}", large=False)
        scratch.drop(f"large-{k}", name)
        edges, name = shrunk, f"small-{k}"
        now = _fingerprint(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
