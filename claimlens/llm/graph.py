"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them (edges run from larger to smaller)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of ``edges(u, v)``; root is the least node that it reaches.

    Every round is a few map-side combined group-bys and equi-joins (AQE splits the
    partitions of a hub); its edges are written to the shared folder, so lineage stays
    one round long. The number of edges never grows, and nothing but three numbers per
    round reaches the driver. No edges give no rows; self-loops and nulls are ignored.
    """
    spark = edges.sparkSession
    now, path = stored(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    signature = _signature(now)
    while signature[0]:
        following, next_path = stored(_small_star(_large_star(now)), "edges")
        drop_stored(spark, [path])
        now, path, before, signature = following, next_path, signature, _signature(following)
        if signature == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
