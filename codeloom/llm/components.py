"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.session import ensure_checkpoint_dir


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the smallest node names a component.

    Alternates the large-star and the small-star step until no edge changes, which takes a
    logarithmic number of rounds even on long chains. A hub is never gathered: each step is a
    minimum per node, combined before the shuffle, joined back to the edges. Loops, repeated
    edges and both directions are allowed; an empty table gives an empty one.
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    links = _downward(edges).distinct().checkpoint()
    state = _state(links)
    while True:
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low"))
        large = (
            both.join(least, "a")
            .where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.least("a", "low").alias("b"))
        )
        large = _downward(large).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a")
        links = (
            _downward(small.select(F.col("b").alias("a"), F.col("low").alias("b")))
            .unionByName(least.select("a", F.col("low").alias("b")))
            .distinct()
            .checkpoint()
        )
        now = _state(links)
        if now == state:
            break
        state = now
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _downward(edges: DataFrame) -> DataFrame:
    """Each edge from its larger to its smaller node, loops left out."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")


def _state(links: DataFrame) -> tuple:
    return tuple(
        links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )
