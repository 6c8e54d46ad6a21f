"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.session import cut_lineage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("lo", "hi"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of a link to another node; root is the component's least node.

    ``links`` may repeat pairs, hold both directions and links to oneself; pairs with a null are ignored. Each round
    hangs larger neighbours, then smaller ones, under the least neighbour; the number of rounds grows with the
    logarithm of the size. Only minima are aggregated, so a hub costs no more than its number of links.
    """
    edges = cut_lineage(links.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
                        .where((F.col(a).isNotNull()) & F.col(b).isNotNull() & (F.col("lo") < F.col("hi"))).distinct())
    state = _state(edges)
    while state[0]:
        ends = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(edges.select("hi", "lo"))
        least = ends.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = edges.join(least, F.col("lo") == F.col("u")).select(F.col("m").alias("lo"), "hi").distinct()
        parent = large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        moved = large.join(parent, F.col("hi") == F.col("u"))
        small = moved.where(F.col("m") < F.col("lo")).select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
        edges = cut_lineage(small.union(parent.select(F.col("m").alias("lo"), F.col("u").alias("hi"))).distinct())
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        edges.select("lo", "lo").distinct())
