"""Connected components of an edge table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, forget, release


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest one (itself included)."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and itself, are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
    return linked.where("u != v").distinct()


def connected_components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest node.

    edges: (u, v) of an orderable type. Each round is written to the shared
    folder, so lost executors cost one round at most. Stops when a round
    changes nothing: all edges then lead to their component's smallest node.
    """
    now = durable(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    for _ in range(most):
        before, now = now, durable(_small_star(_large_star(now)))
        forget(before)
        del before
        release(edges.sparkSession)  # what the round has shuffled
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(new) == mark:
            break
        mark = tuple(new)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
