"""Connected components of a link table, by alternating star contraction in DataFrames.

Each round links every node's larger neighbours to its smallest one, then its smaller ones likewise
(large star, small star), until nothing changes; the number of rounds grows with the logarithm of a
component's size. A node of many links never meets in one task: the smallest neighbour is an aggregate
combined before the shuffle, and the links are joined to it under adaptive execution. Rounds are written
to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.session import staged


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Links (u, v) with u > v, rewired to the smallest neighbour."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    if large:
        least = least.select("u", F.least("u", "m").alias("m"))
        joined = both.join(least, "u").where(F.col("v") > F.col("u"))
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        joined = both.join(least, "u")
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") > F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b); a component is its smallest node.

    Rows with a null end or two equal ends say nothing; repeated links count once.
    """
    links = links.where(F.col("a") != F.col("b"))
    links = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    mark, links = _mark(links := staged(links, "links")), links
    while True:
        links = staged(_stars(_stars(links, True), False), "links")
        now = _mark(links)
        if now == mark:
            break
        mark = now
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
