"""Incremental versions of the ledger operators (an extension: the batch operators need no stream)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def latest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row a key: that with the largest ``order``; ties go by a hash of the row."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last(), F.xxhash64(*rows.columns))
    return rows.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


#: Hash buckets of a state; a batch rewrites those that its keys fall into.
BUCKETS = 64


def _versions(spark: SparkSession, state: str) -> dict[int, list[tuple[int, str]]]:
    """{bucket: [(version, path)]} of a state, at most BUCKETS times a few."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/bucket=*/version=*")
    found: dict[int, list[tuple[int, str]]] = {}
    for status in at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at) or []:
        path = status.getPath().toString()
        bucket, version = (int(x.rpartition("=")[2]) for x in path.rsplit("/", 2)[1:])
        found.setdefault(bucket, []).append((version, path))
    return found


def current_state(spark: SparkSession, state: str, upto: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
    """The rows of each bucket's last version (not after ``upto``); None while there are none."""
    paths = []
    for bucket, own in _versions(spark, state).items():
        known = [v for v in own if upto is None or v[0] <= upto]
        if known and (buckets is None or bucket in buckets):
            paths.append(max(known)[1])
    return spark.read.option("basePath", state).parquet(*paths).drop("version", "bucket") if paths else None


def keyed_upsert(state: str, keys: list[str], order: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: batch n writes version n + 1 of the hash buckets that its keys fall into.

    A batch that is run again reads the versions up to n and writes the same version again.  Of a bucket that was
    rewritten, the two last versions stay.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
        touched = [r.b for r in batch.select(bucket.alias("b")).distinct().collect()]  # at most BUCKETS
        if not touched:
            return
        known = current_state(spark, state, batch_id, touched)
        rows = batch if known is None else batch.unionByName(known.select(batch.columns))
        out = latest(rows, keys, order).withColumns({"bucket": bucket, "version": F.lit(batch_id + 1)})
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "version").parquet(state)
        for own in (v for b, v in _versions(spark, state).items() if b in touched):
            for _, path in sorted(own)[:-2]:
                at = spark._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)

    return merge


def upsert_stream(rows: DataFrame, state: str, checkpoint: str, keys: list[str], order: str) -> DataStreamWriter:
    return rows.writeStream.foreachBatch(keyed_upsert(state, keys, order)).option("checkpointLocation", checkpoint)


def first_seen(rows: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """Rows whose keys weren't met within ``delay`` before (resume by cache key)."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(rows: DataFrame, key: str, time: str, *, width: str, delay: str, value: Column | None = None) -> DataFrame:
    """(window_start, key, n, total) of tumbling windows; rows later than ``delay`` are left out."""
    counted = rows.withWatermark(time, delay).groupBy(F.window(time, width).alias("w"), key)
    total = F.sum(value if value is not None else F.lit(1))
    return counted.agg(F.count("*").alias("n"), total.alias("total")).select(F.col("w.start").alias("window_start"), key, "n", "total")


def over_limit(rows: DataFrame, key: str, time: str, limit: int, *, width: str, delay: str) -> DataFrame:
    """Fixed-window rate limit: the windows in which a key has more than ``limit`` rows."""
    return windowed_counts(rows, key, time, width=width, delay=delay).where(F.col("n") > limit).select("window_start", key, "n")
