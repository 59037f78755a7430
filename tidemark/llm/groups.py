"""Connected components of a table of links, without gathering any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.storage import materialise


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)``: the smallest node reachable from each node that has a link.

    Alternates two steps on the links until they no longer change: hang the larger
    neighbours of a node on its smallest one, then its smaller ones. Each round is
    a minimum per node with partial sums and joins on narrow rows that adaptive
    execution can split; rounds are written to the shared folder. Links of a node
    with itself and repeated ones do no harm; no row comes out for an empty table.
    """
    edges = materialise(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.filter("v > u").join(smallest.hint("merge"), "u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        )
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest.hint("merge"), "u")
        edges = materialise(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
            .unionByName(smallest.select("u", F.col("m").alias("v"))).distinct(),
            "links",
        )
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
