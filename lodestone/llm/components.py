"""Connected components of a table of links, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.shared import dropped, written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of links (a, b), both long: the smallest node that
    it reaches. Rounds of two steps until only stars are left: each node hands its larger
    neighbours to the smallest one it sees, then its smaller ones. A node with very many
    links meets them in a sum, which is written, and a join, which splits when skewed, as
    its sides come straight from exchanges; never in one list.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "stars")
    while True:
        # in stars every u has one v, and no v is a u
        seen = edges.select(F.col("u").alias("x"), F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("up")))
        seen = seen.groupBy("x").agg(F.sum("up").alias("up"), F.min("up").alias("down"))
        if not seen.where("up > 1 or up = 1 and down = 0").limit(1).count():
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large: neighbours above u go to the smallest of u and its neighbours
        low = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # small: u and its neighbours below go to the smallest of them
        large = written(large, "large")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        dropped(edges, low, large, least)
        edges = new
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
