"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lendgrid.llm.frames import written


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest node around: the larger neighbours (large star) or the node and the smaller ones."""
    if large:
        around = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = around.join(least, "a")
    if large:
        hung = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        hung = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return hung.filter("a != b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for the nodes of ``links`` (``a``, ``b``: whole numbers).

    Nodes without links are not listed. Each round groups by node with sums before the shuffle and joins back, so neither a node
    with very many links nor a large component meets in one task. Each round is written, and only counts reach the driver.
    """
    now = written(links.filter("a != b").select(F.col("a").cast("long"), F.col("b").cast("long")).distinct(), "links")
    before = None
    while True:
        count = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(count) == before or count[0] == 0:
            break
        before = tuple(count)
        now = written(_stars(_stars(now, True), False), "stars")
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
