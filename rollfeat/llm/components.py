"""Connected components of a graph that is a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollfeat.llm.store import Store


def _flat(parents: DataFrame, store: Store, most_rows: int) -> DataFrame:
    """Follow ``parent`` to the root, doubling the distance each time."""
    while True:
        above = parents.select(F.col("id").alias("parent"), F.col("parent").alias("above"))
        step = store.keep(parents.join(above, "parent").select("id", F.col("above").alias("parent"), (F.col("above") != F.col("parent")).alias("moved")), most_rows)
        parents = step.select("id", "parent")
        if step.where("moved").isEmpty():
            return parents


def components(edges: DataFrame, store: Store) -> DataFrame:
    """``(id, component)`` of every vertex of ``edges`` (columns ``a`` and ``b``): the least id it can reach.

    Each round points every vertex to its least neighbour, follows these pointers to their roots and goes on with the edges
    between roots. A round at least halves the vertices. All of it are joins and sums over tables, with sums begun
    before the shuffle, so that a vertex with very many edges is no burden.
    """
    found, vertices = None, 0
    while True:
        n = edges.count()
        if not n:
            return found if found is not None else edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
        vertices = vertices or 2 * n
        both = edges.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("id"), F.col("a").alias("other")))
        least = both.groupBy("id").agg(F.min("other").alias("other"))
        parents = _flat(store.keep(least.select("id", F.least("id", "other").alias("parent")), 2 * n), store, 2 * n)
        if found is None:
            found = parents.withColumnRenamed("parent", "component")
        else:
            onward = parents.select(F.col("id").alias("component"), F.col("parent").alias("root"))
            found = store.keep(found.join(onward, "component", "left").select("id", F.coalesce("root", "component").alias("component")), vertices)
        edges = store.keep(between(edges, parents, "parent"), n)


def between(edges: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """The edges between different labels, once each, smaller label first."""
    of_a = labels.select(F.col("id").alias("a"), F.col(label).alias("label_a"))
    of_b = labels.select(F.col("id").alias("b"), F.col(label).alias("label_b"))
    joined = edges.join(of_a, "a").join(of_b, "b").where("label_a <> label_b")
    return joined.select(F.least("label_a", "label_b").alias("a"), F.greatest("label_a", "label_b").alias("b")).distinct()
