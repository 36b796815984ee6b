"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``links(u, v)``, both long; root is the smallest node reachable.

    A round points each node's larger neighbours, then its smaller ones, at
    the smallest of its neighbourhood; the rounds grow with the logarithm of
    a component's length.  A hub's smallest neighbour comes from a map-side
    aggregate, and the join back is an equi-join that AQE can split.  Every
    round is stored in the shared folder and replaces the one before.
    """
    edges = scratch.store(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                          .where("u <> v").distinct(), "edges0")
    state, k = None, 0
    while True:
        found = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
        if found == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select("v", "v").distinct())
        state, k = found, k + 1
        both = edges.union(edges.select("v", "u"))
        # Stored before they are joined, so that AQE can split a hub with very many neighbours.
        low = scratch.store(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low")
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = scratch.store(large, "large")
        low = scratch.store(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low).distinct())
        edges = scratch.store(small, f"edges{k}")
        scratch.drop(f"edges{k - 1}")
