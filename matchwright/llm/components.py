"""Connected components of an edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.session import stage


def _parents(edges: DataFrame) -> DataFrame:
    """Edges as (a, b) with b < a, each once."""
    return (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least value around that node."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    near = edges.join(least, "a")
    return near.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
        least.select("a", F.col("m").alias("b"))
    )


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges to (node, root): root is the least value of the component. Nodes without an edge are absent.

    Alternating large and small stars; every round is a written table, so lost executors cost
    one round and lineage does not grow. Null ends are dropped, repeated and reversed edges
    count once, an empty table gives an empty table.
    """
    now = stage(_parents(edges.select("a", "b").dropna()), "component-edges")
    seen = None
    while True:
        # one row to the driver: the edge set no longer changes once all edges point at roots
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = mark
        now = stage(_parents(_small_star(_parents(_large_star(now)))), "component-edges")
