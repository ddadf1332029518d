"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.llm import common

# Tasks that write a table of edges, for each core. Rows are two numbers, so even many of them are
# little, and hundreds of near-empty tasks would take longer than the work.
TASKS_PER_CORE = 2


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    return common.stored(rows.coalesce(TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism), purpose)


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, label): the smallest node of each node's component, for all nodes that have an edge.

    Each round hangs nodes below the smallest neighbour that a neighbour of theirs has, first for
    larger and then for smaller neighbours; the rounds are logarithmic in the longest path. Minima are
    summed up in each task before the shuffle and written before they are joined, so the join is
    broadcast if they are few and splits the tasks of a node with many edges if not. No edge reaches
    the driver, only their number and a checksum.
    """
    a, b = F.col(left), F.col(right)
    pairs = stored(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")), "edges")
    state = None
    while True:
        hung = stored(_large_star(pairs), "hung")
        pairs = stored(_small_star(hung).distinct(), "edges")
        checksum = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        now = tuple(pairs.agg(F.count("*"), checksum).first())
        if now == state or not now[0]:
            break
        state = now
    nodes = pairs.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.union(stored(pairs.select("b").distinct(), "roots").select(F.col("b").alias("node"), F.col("b").alias("label")))


def _large_star(pairs: DataFrame) -> DataFrame:
    """Larger neighbours of a node hang below the smallest of the node and its neighbours."""
    near = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = stored(near.groupBy("a").agg(F.min("b").alias("m")), "smallest")
    least = smallest.select(F.col("a").alias("of"), F.least("a", "m").alias("m"))
    # Only pairs (smaller, larger): the larger one is hung.
    up = pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))
    hung = up.join(least, up["a"] == least["of"])
    return hung.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(pairs: DataFrame) -> DataFrame:
    """A node and its smaller neighbours hang below the smallest of them."""
    least = stored(pairs.groupBy("a").agg(F.min("b").alias("m")), "smallest")
    hung = pairs.join(least.select(F.col("a").alias("of"), "m"), F.col("a") == F.col("of"))
    moved = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(least.select("a", F.col("m").alias("b")))
