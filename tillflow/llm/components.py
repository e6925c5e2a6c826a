"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.session import written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step of the large-star / small-star method: ties neighbours to the smallest one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    tied = both.join(least, "a")
    kept = tied.where("b > a") if large else tied.where("b <> m")
    moved = kept.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.unionByName(least.where("m < a").select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def _is_stars(links: DataFrame) -> bool:
    """Every id hangs on one centre, and no centre hangs on another."""
    if not links.groupBy("a").count().where("count > 1").isEmpty():
        return False
    return links.select(F.col("b").alias("a")).distinct().join(links, "a", "left_semi").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every id in a link; the component is its smallest id.

    Links from a node to itself, repeated links, and links with a null end change nothing. A round costs a few
    shuffles of the links and is written to the shared folder; the number of rounds grows with the logarithm of the
    longest path, and only yes-or-no answers reach the driver.
    """
    links = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), (F.col(a) != F.col(b)).alias("_two"))
    # greatest() and least() skip nulls; the comparison doesn't.
    links = written(links.where("_two").select("a", "b").distinct())
    while not _is_stars(links):
        links = written(_stars(_stars(links, large=True), large=False))
    centres = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)
