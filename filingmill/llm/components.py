"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingmill.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node), of the nodes that edges a, b join; without edges, none.

    Large and small stars in turn (Kiveris et al., 2014): every node hands its neighbours the smallest
    one it knows, until each component is a star. A round is two aggregations and two joins over the
    edges, written to the shared folder; the number of rounds grows with the logarithm of the length of
    paths. Nothing but two numbers about the edges reaches the driver."""
    stars = stored(_down(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), "edges")
    before = None
    while before != (now := _state(stars)):
        before = now
        stars = stored(_small_star(_large_star(stars)), "edges")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _down(edges: DataFrame) -> DataFrame:
    """From the larger node u to the smaller v, each once."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return down.filter("u <> v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return _down(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _down(moved.unionByName(least.withColumnRenamed("m", "v")))
