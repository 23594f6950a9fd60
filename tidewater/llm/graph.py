"""Connected components of an edge list by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """(node, comp): each node of ``edges`` with the smallest node it is connected to.

    Alternates two rewrites of the edge list until it no longer changes: every
    node's larger neighbours are linked to its smallest neighbour, then every
    node's smaller ones are. Both keep connectivity, never add edges, and end in
    stars within a logarithmic number of rounds, so no group is ever expanded
    into pairs. Each round is written to the shared folder. The smallest
    neighbour is an aggregate with map-side combine; a node with very many
    neighbours only meets them in joins, which adaptive execution can split.
    """
    links = edges.select(F.least(src, dst).alias("u"), F.greatest(src, dst).alias("v")).where("u < v").distinct()
    links = stored(links, "edges")
    signature = None
    while True:
        # large-star: for each node, neighbours above it go to the least of its closed neighbourhood
        both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").where("u < v").distinct()
        # small-star: for each node, the neighbours below it and itself go to the least of them
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.col("m").alias("u"), F.col("u").alias("w"), "v")
        links = stored(
            small.select("u", "v").unionByName(small.select("u", F.col("w").alias("v"))).where("u < v").distinct(), "edges"
        )
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == signature:
            break
        signature = now
    return links.select(F.col("v").alias("node"), F.col("u").alias("comp")).unionByName(
        links.select(F.col("u").alias("node"), F.col("u").alias("comp")).distinct()
    )
