"""Connected components of a link table on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def connected_components(links: DataFrame) -> DataFrame:
    """`links` (a, b: long) -> (node, root) for every node that has a link; the root is the
    smallest node of the component. Alternates the large star and the small star, each a
    group-by for the smallest neighbour and a join back, until the edges stand still;
    every round's edges are checkpointed. Neighbours are never gathered in one task."""
    edges = checkpointed(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                         .filter("a <> b").distinct())
    before = _signature(edges)
    while before[0]:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, F.col("a") == F.col("u")).filter("b > a and b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # small star: all smaller neighbours of a node, and the node, hang on the smallest
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        hung = large.join(low, F.col("a") == F.col("u"))
        small = (hung.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionAll(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())
        edges = checkpointed(small)
        after = _signature(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
