"""Connected components of a large graph, by joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeline.operators.joins import lookup_join
from lakeline.session import Scratch


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``links (a, b)``: root is the smallest node reached.

    Large-star and small-star steps in turn: a star step hangs every neighbour of a node on the
    smallest one, so the number of links never grows. A node's smallest neighbour is a minimum that
    combines before the shuffle, and comes back to its links by ``lookup_join``, which cuts nodes with very
    many links over tasks. Each round is written to the shared folder; rounds grow with the logarithm of
    the longest chain.
    """
    scratch = Scratch(links.sparkSession, "components")
    links = scratch.keep(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a > b").distinct(), "0")
    mark, turn = _mark(links), 0
    while True:
        both = links.union(links.select(F.col("b"), F.col("a"))).toDF("a", "b")
        met = _met(both, F.least("a", F.min("b")), scratch, f"{turn}-least")
        large = scratch.keep(met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")), f"{turn}-large")
        hung = _met(large, F.min("b"), scratch, f"{turn}-hung")
        small = scratch.keep(hung.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").union(
            hung.select("a", F.col("m").alias("b"))).distinct(), f"{turn + 1}")
        before, mark = mark, _mark(small)
        scratch.drop(f"{turn}", f"{turn}-least", f"{turn}-large", f"{turn}-hung")
        links, turn = small, turn + 1
        if mark == before:
            break
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _met(links: DataFrame, least: Column, scratch: Scratch, name: str) -> DataFrame:
    """``a, b, m``: each link with the least neighbour of ``a``."""
    known = scratch.keep(links.groupBy("a").agg(least.alias("m"), F.count(F.lit(1)).alias("uses")), name)
    return lookup_join(links, known, "a", "uses", "b").select("a", "b", "m")


def _mark(links: DataFrame) -> tuple:
    """Count and order-free checksum of a link table."""
    wide = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(wide)).first())
