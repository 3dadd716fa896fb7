"""Connected components of a graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.texts import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that has a link; the root is the smallest node of its component.

    Each round points every node at its smallest neighbour, follows these pointers to their ends and keeps the links between
    different ends, so the graph shrinks to nothing in few rounds. Every round is written to the shared folder.
    Links may be given in either direction, repeated, or from a node to itself.
    """
    edges = stage(links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "edges")
    ends = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    found = ends.select("node", F.col("node").alias("root"))
    edges = edges.where("a <> b")
    while not edges.isEmpty():
        lowest = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up"))
        up = resolve(stage(lowest, "pointers"))
        found = stage(follow(found, up, "root"), "roots")
        edges = follow(follow(edges, up, "a"), up, "b")
        edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        edges = stage(edges.distinct(), "edges")
    return found


def follow(rows: DataFrame, up: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``column`` replaced by where it points, if it points anywhere."""
    pointers = up.select(F.col("node").alias("_node"), F.col("up").alias("_up"))
    moved = rows.join(pointers, rows[column] == pointers["_node"], "left")
    return moved.withColumn(column, F.coalesce("_up", column)).select(rows.columns)


def resolve(up: DataFrame) -> DataFrame:
    """Pointers followed to their ends, doubling the distance each time."""
    while True:
        further = stage(follow(up, up, "up"), "pointers")
        if further.join(up, ["node", "up"], "left_anti").isEmpty():
            return further
        up = further
