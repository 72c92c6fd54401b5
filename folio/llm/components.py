"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import checkpointed

SALTS = 8


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: each node's larger neighbours are linked to its smallest neighbour (or itself).
    Small star: a node and its smaller neighbours are linked to the smallest of them."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    # a node may have any number of links: they are dealt to SALTS parts, and its smallest neighbour to each
    salted = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = both.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(salted, ["u", "salt"])
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    else:
        out = joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.filter("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of ``links`` (columns u, v of one ordered type).

    Runs until nothing changes; the links of a round are checkpointed.  Every
    round keeps the components, and ends with all nodes linked to their smallest."""
    edges = checkpointed(links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while True:
        edges = checkpointed(_stars(_stars(edges, True), False))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("u")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select(F.col("u").alias("node"), F.col("u").alias("component")))
