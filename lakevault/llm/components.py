"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import discard, stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; ``edges`` has long columns u and v.

    Each round hangs the larger neighbours of every node on its smallest one (large
    star), then the smaller ones too (small star), until nothing changes: then every
    node hangs on the smallest of its component. Edges never become more; a node's
    minimum is a partial aggregate, and a node with a great many edges is on the
    side of the join that Spark splits. Every round's edges are written.
    """
    edges = edges.where(F.col("u") != F.col("v"))
    edges = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v")))
        old, edges = edges, stored(small.where(F.col("u") != F.col("v")).distinct(), "edges")
        discard(old)
        after = _state(edges)
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = after
