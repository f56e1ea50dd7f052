"""Connected components of a table of links, by large-star and small-star rounds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gabarito.staging import staged


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung on the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(staged(least, "least"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung on the smallest of them."""
    least = staged(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): nodes of `links` that are not the smallest of their component.

    Links are pairs of integers in any order; self links and repeated ones do no harm. Each
    round is a table in the shared folder, and rounds go on until nothing changes. The groupings
    are partial minima; written before they are joined, so that adaptive execution can split the
    links of a node that has a large share of them.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    state, edges = None, staged(edges, "links")
    while True:
        size, sum_ = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not size or (size, sum_) == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = (size, sum_)
        edges = staged(small_star(staged(large_star(edges), "links")), "links")
