"""Connected components by alternating large-star and small-star steps over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import Scratch


def star(pairs: DataFrame, large: bool, write: Scratch) -> DataFrame:
    """One step on (u, v) pairs; minima are combined before the shuffle and no node gathers its neighbours.

    The minima are written, so both sides of their join are plain shuffles, which adaptive execution
    splits where a hub has many of the pairs.
    """
    both = pairs.union(pairs.select("v", "u")) if large else pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    low = write(low, "minima")
    joined = both.join(low, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of (src, dst); the component is its smallest node.

    The number of rounds grows with the logarithm of a component's size; the edge set is written to
    the shared folder after each, and the rounds end when a round changes nothing.
    """
    scratch, mark = Scratch(edges.sparkSession), None
    pairs = edges.select(F.col("src").alias("u"), F.col("dst").alias("v")).where("u <> v")
    for k in range(max_rounds):
        pairs = scratch(star(star(pairs, True, scratch), False, scratch), f"round-{k}")
        scratch.drop(f"round-{k - 1}", "minima")
        now = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if (now.n, now.h) == mark:
            break
        mark = (now.n, now.h)
    else:
        raise RuntimeError(f"components have not settled in {max_rounds} rounds")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
