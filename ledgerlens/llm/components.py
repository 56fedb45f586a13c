"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import equi_split
from ledgerlens.session import checkpoint_dir


def _mins(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))


def _hooked(edges: DataFrame) -> DataFrame:
    """Every edge with ``m``, the smallest of its ``u`` and that one's neighbours. A hot ``u`` can be split."""
    return equi_split(edges, _mins(edges), "u", "c", "inner").select("u", "v", F.least("m", "u").alias("m"))


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _hooked(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    hooked = _hooked(down)
    return (hooked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
            .unionByName(hooked.select("u", F.col("m").alias("v"))).distinct())


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``links`` (a, b): root is its component's smallest node.

    Lineage is cut by a reliable checkpoint each round; rounds grow with the
    logarithm of the longest path. Roots are not listed as nodes of themselves.
    """
    checkpoint_dir(links.sparkSession)
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u != v").distinct().checkpoint()
    state = None
    for _ in range(most_rounds):
        edges = small_star(large_star(edges)).checkpoint()
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
