"""Connected components of a graph that is only held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendengine.llm.common import remove_stored, stored


def _links(df: DataFrame, a, b) -> DataFrame:
    return (
        df.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    )


def _mark(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(spark: SparkSession, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link; root is the smallest node that it reaches.

    Alternating star contraction: each round hangs the larger neighbours of a node, then the smaller ones, below
    its smallest neighbour, so the number of links never grows and long chains halve. Every round is a table in
    the shared folder; the driver sees a count and a sum. A null end is no link. Minima are combined
    before they are shuffled; a hub's rows in the joins are split by Spark's skew join.
    """
    edges = stored(spark, _links(links.dropna(subset=[a, b]), F.col(a), F.col(b)), "links")
    mark = _mark(edges)
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.least("m", "u").alias("b")).distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        met = large.join(low, "a")
        small = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", "m"))
        after = stored(spark, _links(small, F.col("a"), F.col("b")), "links")
        found = _mark(after)
        remove_stored(spark, edges)
        edges = after
        if found == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = found
