"""Conversations as layout envelopes, and heading paths as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def heading_paths(sections: DataFrame) -> DataFrame:
    """(document_id, section, path) of (document_id, section, parent, heading): headings from the root down, however deep; a cycle ends where it closes."""
    up = sections.select("document_id", "section", F.col("parent").alias("next"), F.array("heading").alias("path"), F.array("section").alias("seen"))
    parents = sections.select("document_id", F.col("section").alias("next"), F.col("parent").alias("above"), F.col("heading").alias("over"), F.lit(True).alias("there"))
    done = None
    while True:
        joined = up.join(parents, ["document_id", "next"], "left").withColumn("goes_on", F.col("there").isNotNull() & ~F.array_contains("seen", F.col("next"))).persist()
        ends = joined.where("NOT goes_on").select("document_id", "section", "path")
        done = ends if done is None else done.union(ends)
        up = joined.where("goes_on").select(
            "document_id", "section", F.col("above").alias("next"), F.concat(F.array("over"), "path").alias("path"), F.array_append("seen", F.col("next")).alias("seen")
        )
        if up.isEmpty():  # every path has reached its root
            break
    return done.withColumn("path", F.filter("path", lambda h: h != ""))


def conversation_envelopes(turns: DataFrame) -> DataFrame:
    """Every conversation as an envelope: one section, a paragraph per turn in the order of the turns."""
    held = turns.groupBy(F.col("conv_id").cast("string").alias("document_id")).agg(F.array_sort(F.collect_list(F.struct("turn", "text", "role"))).alias("ts"))
    paragraphs = F.transform("ts", lambda x: F.struct(x["text"].alias("content"), x["role"].alias("role"), F.lit(None).cast("string").alias("source")))
    elements = F.transform("ts", lambda _, i: F.concat(F.lit("/paragraphs/"), i.cast("string")))
    sections = F.array(F.struct(elements.alias("elements"), F.lit(0).alias("offset")))
    empty = lambda ddl: F.array().cast(ddl)
    content = F.struct(
        paragraphs.alias("paragraphs"), sections.alias("sections"),
        empty("array<struct<row_count: int, column_count: int, caption: string, source: string, cells: array<struct<row: int, col: int, content: string, kind: string>>>>").alias("tables"),
        empty("array<struct<role: string, figure_id: string, source: string, elements: array<string>>>").alias("figures"),
        F.lit("").alias("markdown"), empty("array<struct<number: int, spans: array<struct<offset: int, length: int>>>>").alias("pages"),
    )
    return held.select("document_id", F.array(content).alias("contents"))


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with ``columns`` computed once a row, for what is dear and read often.

    Filters on what is made of a plain column are moved below it, and each of its uses is computed there anew;
    they can't be moved below a generator.
    """
    made = F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items()))))
    kept = [F.col(c) for c in rows.columns if c not in columns]
    return rows.select(*kept, made)


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` dealt over all shuffle partitions by ``keys``: for short rows of few files or row groups whose further work is dear.

    A number that is stated isn't lowered for the rows' few bytes.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
