"""Connected components of a graph given by edges, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentide.llm.spark_util import checkpoint


#: Edges that a task handles: few edges are not worth many tasks and files.
TASK_ROWS = 200_000


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b); a component is named by its least node.

    Large-star and small-star steps in turn: each replaces edges by edges to the least neighbour, so
    the edges never become more than twice as many and the rounds are logarithmic in practice. Loops
    and repeated edges do no harm; no edges give no rows. A node with many edges is only ever
    aggregated (combined on the map side) and joined by rows, never collected."""
    edges = checkpoint(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    tasks = 1 + 2 * edges.count() // TASK_ROWS
    few = lambda df: df.coalesce(tasks)
    edges, state = few(edges), None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = few(both.groupBy("a").agg(F.min("b").alias("m"))).select("a", F.least("a", "m").alias("m"))
        large = few(few(both.where("b > a").join(least, "a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        least = few(large.groupBy("a").agg(F.min("b").alias("m")))
        small = few(large.join(least, "a")).select(F.greatest("b", "m").alias("x"), F.least("b", "m").alias("y")).where("x <> y")
        edges = few(checkpoint(few(small.union(least.select("a", "m")).toDF("a", "b").distinct())))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return few(edges.groupBy("a").agg(F.min("b").alias("component"))).withColumnRenamed("a", "node").union(
        few(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
    )
