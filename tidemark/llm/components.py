"""Connected components of links by alternating large and small stars.

Every round re-links each node to the smallest node it knows: the large star moves larger neighbours, the small
star smaller ones. The number of links never grows, the smallest neighbour is found with map-side partial minima, and
each round is written to the shared folder. Nodes are joined to their minimum by sort-merge joins of written tables,
which adaptive execution splits where one node has very many links. Nothing is collected but a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    if large:
        sides = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = written(sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-least")
    joined = sides.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return out.distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that occurs in the links (u, v); the root is the smallest node reachable."""
    def state(df):
        return df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    links = written(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "cc-links")
    before = state(links)
    while before[0]:
        links = written(_star(written(_star(links, True), "cc-large"), False), "cc-small")
        now = state(links)
        if now == before:
            break
        before = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
