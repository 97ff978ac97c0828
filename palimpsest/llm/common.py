"""What the operators share: tables, word patterns, and shared-folder materialization."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed by the contracts: words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local master without that setting gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="palimpsest-")
        spark.sparkContext.setCheckpointDir(base)
    return base


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write ``df`` once as Parquet in the shared folder and read it back.

    Unlike ``checkpoint()`` this computes the plan once and stores columns, compressed.
    """
    return Scratch(df.sparkSession)(df, label)


class Scratch:
    """Tables in the shared folder that belong together: call to write one, ``drop`` to delete those of labels."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.base, self.made, self.n = spark, f"{shared_dir(spark)}/palimpsest-{uuid.uuid4().hex}", {}, 0

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        if not self.n:
            atexit.register(self._leave)
        self.n += 1
        path = f"{self.base}/{label}-{self.n}"
        self.made.setdefault(label, []).append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _leave(self) -> None:
        """At the session's end nothing reads the tables any more; without a session they stay for the cluster's own cleaning."""
        if self.spark.sparkContext._jsc is not None:
            self.drop()

    def drop(self, *labels: str) -> None:
        """Delete the tables of ``labels`` (of all, if none is given); nothing may read them any more."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for label in labels or tuple(self.made):
            for path in self.made.pop(label, ()):
                at = jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(conf).delete(at, True)


def keyed_rows(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with a key that every reading of them gives alike: the place in their Parquet files, else a number they are written with."""
    try:
        return rows.withColumn(name, F.concat("_metadata.file_path", F.lit("#"), F.col("_metadata.row_index").cast("string")))
    except AnalysisException:  # not read from Parquet files
        return Scratch(rows.sparkSession)(rows.withColumn(name, F.monotonically_increasing_id()), "keyed")


#: Rows of texts that Spark sends to a Python worker in one Arrow batch; the buffers of both sides hold one batch.
BATCH_ROWS = 2500


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Sets the session's Arrow batches to ``rows`` rows, so that memory beside the heap doesn't grow with Spark's 10,000."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices, so that no more than ``rows`` texts are Python objects at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def lower_ascii(col):
    """A-Z lower-cased and nothing else (``lower()`` would also fold other letters)."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
