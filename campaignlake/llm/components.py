"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import materialize


def _toward_minimum(edges: DataFrame, smaller_only: bool) -> DataFrame:
    """Link the neighbours of every vertex to the smallest vertex around it.

    The minimum per vertex is an aggregate that combines before the shuffle, and it is joined back, so
    that a vertex with very many links is split like any skewed join key.
    """
    if smaller_only:
        lowest = edges.groupBy("a").agg(F.min("b").alias("low"))
        moved = edges.join(lowest, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
            F.struct(F.col("a").alias("a"), F.col("low").alias("b")),
        )).alias("e")).select("e.*")
    else:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        moved = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame, first: str, second: str) -> DataFrame:
    """(vertex, component) for every vertex that has a link; the component is its smallest vertex.

    Alternates two local steps: every vertex hangs its larger neighbours, then its smaller ones, under
    its smallest neighbour, until each component is a star around its minimum. The number of rounds
    follows the logarithm of the longest chain. Each round is a stored table of links, never more than
    there were; links to oneself, repeated links and nulls do not count.
    """
    edges = links.select(F.col(first).cast("long").alias("a"), F.col(second).cast("long").alias("b")).where("a <> b")
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = None
    while True:
        edges = materialize(_toward_minimum(_toward_minimum(edges, False), True), "links")
        row = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.max("b"), F.min("a")
        ).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    stars = edges.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
    return stars.union(stars.select(F.col("component").alias("vertex"), "component").distinct())
