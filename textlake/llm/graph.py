"""Connected components by alternating star contractions, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.plans.staging import stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours of each node on its smallest neighbour (or itself).

    The large star moves the greater neighbours, the small star the smaller ones and the
    node itself. Minima are pre-aggregated before the shuffle; no neighbour list is built.
    """
    both = links.select("a", "b")
    if large:
        both = both.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
    return moved.where("a <> b").distinct()


def _state(links: DataFrame):
    return links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links(a, b), root being the smallest connected node."""
    links = stage(links.select("a", "b").where("a <> b").distinct(), "links")
    before = _state(links)
    while before[0]:
        links = stage(_star(_star(links, True), False), "links")
        now = _state(links)
        if now == before:
            break
        before = now
    # every node now hangs on its root
    tops = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(tops)
