"""Connected components by repeated contraction, with all links in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import landed


def _jumped(parent: DataFrame) -> DataFrame:
    """Follow parents until every node points at its tree's root (doubling: log2(depth) joins)."""
    while True:
        up = parent.select(F.col("id").alias("_up"), F.col("parent").alias("_upper"))
        step = landed(
            parent.join(up, F.col("parent") == F.col("_up"), "left")
            .select("id", F.coalesce("_upper", "parent").alias("parent"),
                    (F.coalesce("_upper", "parent") != F.col("parent")).alias("_moved")), "jump")
        moved = not step.filter("_moved").isEmpty()
        parent = step.select("id", "parent")
        if not moved:
            return parent


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` for every node of ``links(a, b)``: the smallest id it can reach.

    Each round every node takes its smallest neighbour if that is smaller than itself; these
    parents form trees whose root is their smallest node.  Trees collapse to their roots by
    pointer doubling, links between two trees become links between roots, and the rest
    vanish.  The number of trees falls at least by half each round.

    Minima are combined before they are shuffled, and every join reads landed tables on both
    sides, so Spark's skew join can split a node with very many links.  Null ends and links
    of a node to itself are ignored; an empty table gives an empty result.
    """
    links = landed(links.select("a", "b").filter("a < b or b < a")
                   .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    found = None
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        parent = _jumped(landed(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("_least"))
                                .select("id", F.least("id", "_least").alias("parent")), "parents"))
        if found is None:
            found = parent.select("id", F.col("parent").alias("component"))
        else:
            up = parent.select(F.col("id").alias("_up"), F.col("parent").alias("_upper"))
            found = landed(found.join(up, F.col("component") == F.col("_up"), "left")
                           .select("id", F.coalesce("_upper", "component").alias("component")), "found")
        up_a = parent.select(F.col("id").alias("a"), F.col("parent").alias("_a"))
        up_b = parent.select(F.col("id").alias("b"), F.col("parent").alias("_b"))
        links = landed(links.join(up_a, "a").join(up_b, "b").filter("_a <> _b")
                       .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "links")
    return found if found is not None else links.select(F.col("a").alias("id"), F.col("b").alias("component"))
