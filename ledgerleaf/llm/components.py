"""Connected components of links by alternating large and small stars; no neighbourhood is ever collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, save


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: every node hands its greater neighbours to its least neighbour; small: its smaller ones and itself."""
    if large:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    handed = around.join(least, "u").where(F.col("v") > F.col("u") if large else F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        handed = handed.unionByName(least.select("u", F.col("m").alias("v")))
    return handed.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """links (u, v) -> (id, component): for every linked id the smallest id it reaches."""
    edges = save(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links")
    before = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        old, before = edges, now
        edges = save(_star(_star(edges, True), False), "links")
        discard(old)
    joined = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return joined.unionByName(roots)
