"""Nearest vectors behind a filter, by inverted lists: every row is in the list of its nearest centroid.

Centroids are fitted on a bounded sample (``IndexPlan.sample`` rows); every row is indexed.  A search looks into the
lists whose centroids are nearest to a query (``probes``).  As an approximate search it ends there.  As an exact one it
goes on with the lists that could still hold a better row: an angle between a query and a row is at least that to the
list's centroid less the list's widest own angle, so lists whose bound is below what was found are never read.

Queries and rows meet by list.  Lists are cut into parts of ``group_rows`` rows, queries of a list into parts of
``group_queries``, and every pair of parts is one task's matrix product, of which the best ``k`` a query leave it; a
list with a third of all rows is just many parts.  The driver holds the centroids, and a count and a width a list.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.operators.retrieval import top_of


@dataclass(frozen=True)
class IndexPlan:
    lists: int = 64
    #: Rows that the centroids are fitted on, chosen by a hash of their ids.
    sample: int = 20_000
    rounds: int = 12
    group_rows: int = 4096
    group_queries: int = 1024


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-300)


def _rows_of(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    own = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return _unit(own.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(own), -1)) if len(own) else np.empty((0, 0))


def usable(vectors: DataFrame, size: int | None = None) -> DataFrame:
    """Rows with an id and a vector of numbers (of ``size`` of them) that isn't all zero."""
    whole = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.exists("embedding", lambda x: x != 0) & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x))
    return vectors.where(whole & (F.size("embedding") == size) if size else whole)


def fitted(vectors: DataFrame, plan: IndexPlan = IndexPlan()) -> np.ndarray:
    """Unit centroids by k-means on the sphere; vectors of the most frequent length count.  An empty table has none."""
    rows = usable(vectors)
    size = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if size is None:
        return np.empty((0, 0))
    chosen = rows.where(F.size("embedding") == size.n).select("embedding", F.xxhash64("vec_id").alias("h"), "vec_id").orderBy("h", "vec_id").limit(plan.sample)
    x = _rows_of(chosen.select("embedding").toArrow().column(0))
    if len(x) <= plan.lists:
        return np.unique(x, axis=0)
    centers = x[:: len(x) // plan.lists][: plan.lists].copy()  # the sample is in the order of a hash
    for _ in range(plan.rounds):
        own = np.argmax(x @ centers.T, axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, x)
        lost = np.bincount(own, minlength=len(centers)) == 0
        # an empty list moves to the rows that fit worst where they are
        sums[lost] = x[np.argsort(np.max(x @ centers.T, axis=1))[: int(lost.sum())]]
        centers = _unit(sums)
    return centers


def indexed(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The usable rows of ``vectors`` with list, and near: the cosine to its centroid.  Write it partitioned by list to keep it."""
    size = centroids.shape[1] if len(centroids) else 0
    rows = usable(vectors, size) if size else vectors.where("false")
    at = rows.columns.index("embedding")
    sent = vectors.sparkSession.sparkContext.broadcast(centroids)  # plan.lists of them
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s = _rows_of(batch.column(at)) @ sent.value.T
                own = np.argmax(s, axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32)), pa.array(s[np.arange(len(own)), own])], [*batch.schema.names, "list", "near"])

    return rows.mapInArrow(run, f"{fields}, list int, near double")


def _met(rows: DataFrame, pairs: DataFrame, k: int, same: tuple[str, ...], plan: IndexPlan) -> DataFrame:
    """(query_id, vec_id, score): the best ``k`` of every part, for pairs (query_id, list, q, f_...)."""
    spark = rows.sparkSession
    sizes = [(r["list"], -(-r.n // plan.group_rows)) for r in rows.groupBy("list").agg(F.count("*").alias("n")).collect()]  # one for each list
    asked = [(r["list"], -(-r.n // plan.group_queries)) for r in pairs.groupBy("list").agg(F.count("*").alias("n")).collect()]
    parts = spark.createDataFrame([(a, n, m) for a, n in sizes for b, m in asked if a == b] or [(-1, 1, 1)], "list int, parts int, query_parts int")
    filters = [F.col(c).cast("string").alias(f"f_{c}") for c in same]
    split = lambda key, n: F.pmod(F.xxhash64(key, F.lit(17)), F.col(n)).cast("int")
    left = rows.select("vec_id", "embedding", "list", *filters).join(F.broadcast(parts), "list")  # a row for each list
    left = left.withColumns({"part": split("vec_id", "parts"), "query_part": F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1))}).drop("parts", "query_parts")
    right = pairs.join(F.broadcast(parts), "list").withColumns({"query_part": split("query_id", "query_parts"), "part": F.explode(F.sequence(F.lit(0), F.col("parts") - 1))}).drop("parts", "query_parts")
    names = ["query_id", "vec_id", "score"]

    def best(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        own, ids = a.column("vec_id").to_numpy(), b.column("query_id").to_numpy()
        s = _rows_of(b.column("q")) @ _rows_of(a.column("embedding")).T
        s[ids[:, None] == own[None, :]] = -np.inf
        for c in same:
            x, y = (np.array(t.column(f"f_{c}").to_pylist(), object) for t in (b, a))
            s[(x[:, None] != y[None, :]) | (x == None)[:, None]] = -np.inf  # noqa: E711
        s, keys = top_of(s, np.broadcast_to(own, s.shape), k)
        ok = np.isfinite(s).ravel()
        return pa.table([pa.array(np.repeat(ids, s.shape[1])[ok]), pa.array(keys.ravel()[ok]), pa.array(s.ravel()[ok])], names=names)

    by = ["list", "part", "query_part"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(best, "query_id long, vec_id long, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 12)), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def nearest(rows: DataFrame, centroids: np.ndarray, queries: DataFrame, k: int, *, probes: int = 8, exact: bool = True, same: tuple[str, ...] = (), plan: IndexPlan = IndexPlan()) -> DataFrame:
    """(query_id, vec_id, score, rank): the ``k`` rows of an index nearest to each query (vec_id, embedding) by cosine, itself left out.

    Only rows that equal the query in the columns ``same`` are ranked (null equals nothing); other filters go on ``rows``
    beforehand.  Ties go to the smaller id.  Queries without a usable vector find nothing; repeated query ids count as one query.
    """
    spark = rows.sparkSession
    if not len(centroids):
        return spark.createDataFrame([], "query_id long, vec_id long, score double, rank int")
    wide = {r["list"]: r.near for r in rows.groupBy("list").agg(F.min("near").alias("near")).collect()}  # one for each list
    angle = np.arccos(np.clip(np.array([wide.get(i, 2.0) for i in range(len(centroids))]), -1, 1))
    full = np.array([i in wide for i in range(len(centroids))])
    sent = spark.sparkContext.broadcast((centroids, angle, full))
    own = usable(queries, centroids.shape[1]).dropDuplicates(["vec_id"])
    own = own.select(F.col("vec_id").cast("long").alias("query_id"), F.col("embedding").alias("q"), *(F.col(c).cast("string").alias(f"f_{c}") for c in same))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers, wide, full = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            s = _rows_of(batch.column(1)) @ centers.T
            bound = np.cos(np.maximum(np.arccos(np.clip(s, -1, 1)) - wide[None, :], 0)) + 1e-9
            place = np.argsort(np.argsort(-np.where(full[None, :], s, -2), axis=1, kind="stable"), axis=1)
            q, lists = np.nonzero(np.broadcast_to(full[None, :], s.shape))
            rows_ = batch.take(pa.array(q))
            yield pa.RecordBatch.from_arrays([*rows_.columns, pa.array(lists.astype(np.int32)), pa.array(place[q, lists].astype(np.int32)), pa.array(bound[q, lists])], [*batch.schema.names, "list", "place", "bound"])

    pairs = own.mapInArrow(run, f"{kinds}, list int, place int, bound double")
    fields = ["query_id", "list", "q", *(f"f_{c}" for c in same)]
    first = _ranked(_met(rows, pairs.where(F.col("place") < probes).select(*fields), k, same, plan), k)
    if not exact:
        return first
    worst = first.groupBy("query_id").agg(F.min("score").alias("worst"), F.count("*").alias("n"))
    more = pairs.where(F.col("place") >= probes).join(worst, "query_id", "left").where((F.coalesce("n", F.lit(0)) < k) | (F.col("bound") >= F.col("worst")))
    return _ranked(first.drop("rank").union(_met(rows, more.select(*fields), k, same, plan)), k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(query_id, recall): the share of the exact rows (query_id, vec_id) that were found."""
    both = exact.select("query_id", "vec_id").join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    return both.groupBy("query_id").agg((F.count("hit") / F.count("*")).alias("recall"))
