"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.session import stage


def _state(links: DataFrame) -> tuple:
    """Size and order-free checksum of a table of distinct links."""
    mark = F.xxhash64("u", "v")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(mark % (1 << 40)), F.bit_xor(mark)).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("m").alias("u"), "v").where("u < v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("w"), "m")
    moved = links.join(least, F.col("v") == F.col("w")).select(F.col("m").alias("u"), F.col("u").alias("v"))
    return moved.union(least.select(F.col("m").alias("u"), F.col("w").alias("v"))).where("u < v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v); root: the smallest node reachable.

    Large and small stars alternate until nothing changes, which leaves one star for each
    component. A step aggregates minima and joins them back, so the neighbours of a hub are
    never gathered in one place; steps are cut by written tables. Links of a node with
    itself, repeated and reversed links, and nulls have no effect.
    """
    links = links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    links = stage(links.where("u < v").distinct(), "links")
    state = _state(links)
    while True:
        links = stage(_small_star(_large_star(links)), "links")
        if state == (state := _state(links)):
            break
    roots = links.select(F.col("u").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return links.select(F.col("v").alias("node"), F.col("u").alias("root")).union(roots)
