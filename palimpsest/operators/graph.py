"""Entities, relations, containment and neighbourhoods."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def neighbourhood(edges: DataFrame, nodes: DataFrame, most: int) -> DataFrame:
    """(node_id, node_type, truncated): the ends of the first ``most`` edges (by relation_id) and whether there were more."""
    first = edges.orderBy("relation_id").limit(most + 1)
    ranked = first.agg(F.sort_array(F.collect_list(F.struct("relation_id", "source_id", "target_id"))).alias("e"))  # at most ``most`` + 1
    ends = ranked.select((F.size("e") > most).alias("truncated"), F.explode(F.slice("e", 1, most)).alias("x"))
    ends = ends.select("truncated", F.explode(F.array("x.source_id", "x.target_id")).alias("node_id")).distinct()
    return ends.join(nodes, "node_id").select("node_id", "node_type", "truncated")


def closure(edges: DataFrame, depth: int) -> DataFrame:
    """(ancestor, descendant, depth): all pairs within ``depth`` steps of (parent, child), each with its least depth.

    Each step joins the pairs that the last one reached first with the edges; both are checkpointed, so no step is
    computed again, and the steps end when nothing new is reached.
    """
    edges = edges.distinct()
    reach = front = edges.select(F.col("parent").alias("ancestor"), F.col("child").alias("descendant"), F.lit(1).alias("depth"))
    for d in range(2, depth + 1):
        step = front.join(edges, front.descendant == edges.parent).select("ancestor", F.col("child").alias("descendant"), F.lit(d).alias("depth")).distinct()
        front = cut_lineage(step.join(reach, ["ancestor", "descendant"], "left_anti").select("ancestor", "descendant", "depth"))
        if front.isEmpty():
            break
        reach = reach.union(front)
    return reach


def cut_lineage(rows: DataFrame) -> DataFrame:
    """``rows`` written to the checkpoint folder that all executors share; a local session gets a folder of its own."""
    context = rows.sparkSession.sparkContext
    if not context.getCheckpointDir():
        named = rows.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="palimpsest-"))
    return rows.checkpoint()


def contained_items(edges: DataFrame, seeds: DataFrame, *, depth: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(id, depth, kept) of all that is reached from ``seeds`` (id) over (parent, child), and counters.

    Rows are in breadth-first order (depth, then id); those past ``most`` aren't kept.
    """
    reach = front = seeds.select(F.col("id"), F.lit(0).alias("depth")).distinct()
    for d in range(1, depth + 1):
        step = front.join(edges, front.id == edges.parent).select(F.col("child").alias("id"), F.lit(d).alias("depth")).distinct()
        front = cut_lineage(step.join(reach, "id", "left_anti").select("id", "depth"))
        if front.isEmpty():
            break
        reach = reach.union(front)
    sizes = reach.groupBy("depth").agg(F.count("*").alias("_n"))
    ahead = sizes.select("depth", F.coalesce(F.sum("_n").over(Window.orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"))  # a row a level
    ranked = reach.withColumn("_k", F.row_number().over(Window.partitionBy("depth").orderBy("id"))).join(ahead, "depth")
    out = ranked.select("id", "depth", (F.col("_k") + F.col("_ahead") <= most).alias("kept"))
    counters = out.agg(F.count("*").alias("items"), F.count_if(F.col("depth") > 1).alias("nested"), F.count_if(~F.col("kept")).alias("beyond_limit"), F.max("depth").alias("deepest"))
    return out, counters
