"""Connected components of an edge list, by hooking and pointer jumping on written tables.

Each round every node hooks to its smallest neighbour (map-side minimum, so a
hub costs no more than other nodes), parents are replaced by their parents'
parents, and edges are moved to the parents; loops and repeats vanish. Every
node that is not the smallest among its neighbours goes, so the rounds are few.
Nothing is collected but the number of edges left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.shared import staged


def _parents(edges: DataFrame) -> DataFrame:
    """(node, parent): the smallest of a node and its neighbours, then of theirs."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("near"))
    )
    hooked = staged(both.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("parent")), "hooked")
    return _jumped(_jumped(hooked))


def _jumped(parents: DataFrame) -> DataFrame:
    """Parents replaced by their own parents."""
    up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("up"))
    return parents.join(up, "parent", "left").select("node", F.coalesce("up", "parent").alias("parent"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is a node of the component."""
    links = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    roots = None
    while links.head() is not None:
        parents = staged(_parents(links), "parents")
        if roots is None:
            roots = parents.withColumnRenamed("parent", "root")
        else:
            up = parents.select(F.col("node").alias("root"), F.col("parent").alias("up"))
            roots = roots.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
            roots = staged(roots, "roots")
        of_a = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        of_b = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        moved = links.join(of_a, "a").join(of_b, "b").filter("pa <> pb")
        links = staged(moved.select(F.greatest("pa", "pb").alias("a"), F.least("pa", "pb").alias("b")).distinct(), "edges")
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    return roots
