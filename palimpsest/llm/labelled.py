"""Bounded samples of labelled rows, and the fold that no classifier learns from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str = "doc_id") -> Column:
    """The contract's fold: crc32 of the id as text is divisible by 5 (a null id is not held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def sample_labelled(docs: DataFrame, labels: DataFrame, label: str, per_class: int, columns: list[str]) -> list:
    """Rows (columns..., label) of at most ``per_class`` documents of each class outside the fold.

    The choice is by a hash of the id, and of rows that share an id by one of their columns, so it is
    the same for every layout of the tables; documents with two different labels are left out.
    """
    known = labels.where(F.col(label).isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.min(label).alias("_y"), F.max(label).alias("_y2"))
    known = known.where("_y = _y2").select(F.col("doc_id").alias("_id"), "_y")
    order = F.xxhash64("_id", F.lit("sample"))
    chosen = known.where("_y = 0").orderBy(order, "_id").limit(per_class).union(known.where("_y = 1").orderBy(order, "_id").limit(per_class))
    picked = docs.join(F.broadcast(chosen), docs.doc_id == chosen["_id"])  # at most 2 * per_class ids
    one = picked.groupBy("doc_id").agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("_row"), F.first("_y").alias("label"))
    return one.select("_row.*", "label").orderBy("label", F.xxhash64("doc_id")).collect()
