"""Sinks that replace, reconcile or promote tables after a check."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    at, fs = _fs(spark, path)
    fs.delete(at, True)


def _move(spark: SparkSession, source: str, target: str) -> None:
    a, fs = _fs(spark, source)
    b, _ = _fs(spark, target)
    if not fs.rename(a, b):
        raise OSError(f"{source} can't be moved to {target}")


def table_digest(rows: DataFrame) -> str:
    """SHA-256 of a table's rows, whatever their order: digests of digests by hash bucket, so no task sees all rows."""
    row = F.sha2(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}), 256)
    buckets = rows.select(row.alias("h")).groupBy(F.substring("h", 1, 4).alias("b")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("d"))
    return buckets.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat("b", "d"))), ""), 256)).first()[0]


def replace_corpus(tables: dict[str, tuple[DataFrame, str]], root: str) -> dict[str, dict]:
    """Writes every (rows, sort key) as JSON lines beside ``root`` and, once all are there, puts them in its place.

    Returns {name: {rows, sha256}} of what was written.  The old tables are kept until the new ones stand.
    """
    spark = next(iter(tables.values()))[0].sparkSession
    root = root.rstrip("/")
    staging, old = f"{root}.new-{uuid.uuid4().hex}", f"{root}.old-{uuid.uuid4().hex}"
    told: dict[str, dict] = {}
    for name, (rows, key) in tables.items():
        path = f"{staging}/{name}"
        rows.repartitionByRange(F.col(key)).sortWithinPartitions(key).write.json(path)
        written = spark.read.schema(rows.schema).json(path)
        told[name] = {"rows": written.count(), "sha256": table_digest(written)}
    at, fs = _fs(spark, root)
    if fs.exists(at):
        _move(spark, root, old)
    _move(spark, staging, root)
    _delete(spark, old)
    return told


def merge_or_upload(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """``target`` with the rows of ``rows`` instead of its own of the same key; of several new rows of a key the greatest counts."""
    from palimpsest.operators.ledger import last_of

    new = last_of(rows, [key])
    return target.join(new.select(key), key, "left_anti").unionByName(new.select(*target.columns))


def pruned(target: DataFrame, wanted: DataFrame, key: str, full_run: bool) -> tuple[DataFrame, DataFrame]:
    """(kept, deleted): a full run deletes keys that aren't wanted any more, any other run nothing."""
    if not full_run:
        return target, target.limit(0)
    keys = wanted.select(key).distinct()
    return target.join(keys, key, "left_semi"), target.join(keys, key, "left_anti")


def promote(spark: SparkSession, view: str, path: str, expected: int) -> None:
    """Points ``view`` at the table of ``path`` if it has as many rows as were sent; fails, and leaves the view, if not."""
    rows = spark.read.parquet(path)
    n = rows.count()
    if n != expected:
        raise ValueError(f"{path} has {n} rows of {expected}; {view} stays as it is")
    rows.createOrReplaceTempView(view)


def run_manifest(spark: SparkSession, path: str, **facts) -> None:
    """One JSON row of a run's facts."""
    spark.createDataFrame([{k: v for k, v in sorted(facts.items())}]).coalesce(1).write.mode("overwrite").json(path)


def write_joined_csv(rows: DataFrame, path: str) -> None:
    """CSV with a header; arrays are joined by semicolons."""
    flat = [F.array_join(c, ";").alias(c) if kind.startswith("array") else F.col(c) for c, kind in rows.dtypes]
    rows.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def changed_sidecars(rows: DataFrame, written: DataFrame, key: str) -> DataFrame:
    """(key, payload) of sidecars whose JSON isn't what was written (key, payload) before."""
    rest = sorted(c for c in rows.columns if c != key)
    made = rows.select(key, F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}).alias("payload"))
    return made.join(written.select(key, "payload"), [key, "payload"], "left_anti")


def package_manifest(spark: SparkSession, root: str, names: dict[str, bool]) -> list[dict]:
    """[{name, size, sha256}] of the files ``names`` (name: may it be empty) below ``root``; a missing or empty one fails."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    name = F.substring_index("path", "/", -1)
    rows = files.where(name.isin(*names)).select(name.alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))
    found = {r.name: r.asDict() for r in rows.collect()}  # a row a name
    for n, may_be_empty in names.items():
        if n not in found:  # scans pass over empty files
            at, fs = _fs(spark, f"{root}/{n}")
            if may_be_empty and fs.exists(at):
                found[n] = {"name": n, "size": 0, "sha256": hashlib.sha256(b"").hexdigest()}
            else:
                raise ValueError(f"{n} is missing or empty in {root}")
    return [found[n] for n in names]


def store_snapshots(pages: DataFrame, root: str) -> int:
    """Adds contents (kind, content) that aren't there yet to the store, a Parquet table by kind and the digest's first two digits; returns how many."""
    spark = pages.sparkSession
    cols = ["kind", F.sha2("content", 256).alias("sha256"), F.col("content").cast("binary").alias("content"), F.length("content").alias("raw_size")]
    rows = pages.select(*cols).dropDuplicates(["kind", "sha256"]).withColumn("shard", F.substring("sha256", 1, 2))
    at, fs = _fs(spark, root)
    before = 0
    if fs.exists(at):
        known = spark.read.parquet(root).select("kind", "sha256")
        before = known.count()
        rows = rows.join(known, ["kind", "sha256"], "left_anti")
    rows.write.mode("append").partitionBy("kind", "shard").option("compression", "gzip").parquet(root)
    return spark.read.parquet(root).count() - before
