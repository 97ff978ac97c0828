"""Tables and strict readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def strict_jsonl(spark: SparkSession, path: str, schema: StructType, required: tuple[str, ...] = ()) -> DataFrame:
    """JSON lines; blank lines are skipped, a bad line or a blank required field fails the read, naming the file."""
    lines = spark.read.text(path).select(F.trim("value").alias("line"), F.col("_metadata.file_path").alias("file")).where("line <> ''")
    row = F.from_json("line", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    parsed = lines.withColumn("row", row).withColumn("good", F.try_parse_json("line").isNotNull() & F.col("line").startswith("{"))
    checked = parsed.withColumn("row", F.when(F.col("good"), F.col("row")).otherwise(F.raise_error(F.concat(F.lit("not a JSON object in "), "file", F.lit(": "), F.substring("line", 1, 80)))))
    out = checked.select("row.*")
    for c in required:
        out = out.withColumn(c, F.when(F.trim(F.col(c)) != "", F.col(c)).otherwise(F.raise_error(F.lit(f"blank {c}")).cast("string")))
    return out


def lenient_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines without those that don't read."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def write_sorted_json(df: DataFrame, path: str, key: str) -> str:
    """JSON lines in order of ``key`` across files; returns the digest of what was written."""
    from palimpsest.sources.sinks import table_digest

    df.repartitionByRange(F.col(key)).sortWithinPartitions(key).write.mode("overwrite").json(path)
    return table_digest(df.sparkSession.read.schema(df.schema).json(path))


def write_evidence_csv(df: DataFrame, path: str) -> None:
    """Every cell quoted, quotes doubled, lines ended by CR LF."""
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').option("lineSep", "\r\n").csv(path)
