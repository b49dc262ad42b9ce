"""Connected components of a link table, by contraction; every step is a join or an aggregate on staged tables.

Each round sends every node to the smallest of itself and its neighbours, follows those pointers to their ends, and
keeps the links between different ends. The ends are local minima, at most half the nodes of a component, so rounds
grow with the logarithm of the largest component, as do the steps that follow pointers. The driver sees counts only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from calloom.session import stage


def _follow(pointers: DataFrame) -> DataFrame:
    """Pointers (node, root) moved on to the last node of their chain; every root is a node itself."""
    while True:
        ahead = pointers.select(F.col("node").alias("root"), F.col("root").alias("next"))
        moved = stage(
            pointers.join(ahead, "root", "left").select("node", F.coalesce("next", "root").alias("root"), (F.col("next") != F.col("root")).alias("moved"))
        )
        pointers = moved.select("node", "root")
        if moved.filter("moved").isEmpty():
            return pointers


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of ``links`` (columns a, b): the smallest node it is connected with.

    Links from a node to itself and links with a null end say nothing; repeated links count once. Without links the
    result is empty.
    """
    links = links.select("a", "b").filter("a <> b")
    links = stage(links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = None
    while not links.isEmpty():
        nearest = links.groupBy("a").agg(F.min("b").alias("b"))
        ends = _follow(nearest.select(F.col("a").alias("node"), F.least("a", "b").alias("root")))
        if labels is None:
            labels = ends.withColumnRenamed("root", "component")
        else:
            labels = stage(
                labels.join(ends.withColumnRenamed("node", "component"), "component", "left")
                .select("node", F.coalesce("root", "component").alias("component"))
            )
        of = lambda end: ends.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))  # noqa: B023, E731
        links = stage(
            links.join(of("a"), "a").join(of("b"), "b")
            .select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).filter("a <> b").distinct()
        )
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
