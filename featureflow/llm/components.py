"""Connected components of links by alternating large-star and small-star steps; no node's links meet in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.llm.common import stored


def _toward_least(links: DataFrame) -> DataFrame:
    """(node, other) to (node, other, least): the least id among a node and its others."""
    least = links.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("least"))
    return links.join(least, "node")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))).head())


def components(links: DataFrame) -> DataFrame:
    """node, component (the least reachable id) for every node of `links` (a, b) but the least of each component.

    Links go either way and may repeat; links of a node to itself and null ends say nothing.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).distinct()
    links = stored(links)
    state = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("other").alias("node"), F.col("node").alias("other")))
        large = _toward_least(both).where("other > node").select(F.col("other").alias("node"), F.col("least").alias("other"))
        large = large.where("node <> other").distinct()  # each node points to a smaller one
        pointed = _toward_least(large)
        small = pointed.where("other <> least").select(F.col("other").alias("node"), F.col("least").alias("other"))
        small = small.unionByName(pointed.select("node", F.col("least").alias("other"))).distinct()
        links, before = stored(small), state
        state = _state(links)
        if state == before:
            return links.select("node", F.col("other").alias("component"))
