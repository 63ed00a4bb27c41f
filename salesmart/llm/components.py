"""Connected components by alternating stars, on written tables.

Each round hangs every node's larger neighbours under its smallest one (large
star), then every node and its smaller neighbours under the smallest of them
(small star).  Both are a minimum per node, which combines before the shuffle,
and a join of two written tables, which Spark can split where a node has very
many neighbours.  Nothing but a count and a checksum comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.workspace import settle


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = settle(both.groupBy("a").agg(F.least("a", F.min("b")).alias("least")), "least")
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` must run from the larger node ``a`` to the smaller ``b``."""
    least = settle(edges.groupBy("a").agg(F.min("b").alias("least")), "least")
    moved = edges.join(least, "a").filter("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) of longs: (node, root) for each node that isn't its component's smallest."""
    edges = settle(
        links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    state = None
    while True:
        checksum = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if checksum == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = checksum
        if checksum[0]:
            edges = settle(_small_star(settle(_large_star(edges), "links")), "links")
