"""Scans with checks: numbered lines, query sets, pairs, manifests, artifacts, stored snapshots, logs."""

from __future__ import annotations

import gzip
import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value) of text files: lines are counted in each block a task reads, blocks summed by file."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    sizes = lines.groupBy("file", "block").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sizes.select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))  # a row a block
    own = F.row_number().over(Window.partitionBy("file", "block").orderBy("id"))
    return lines.withColumn("own", own).join(ahead, ["file", "block"]).select("file", (F.col("own") + F.col("ahead")).alias("line_no"), "value")


def json_objects(lines: DataFrame, schema: StructType, required: tuple[str, ...] = ()) -> DataFrame:
    """Numbered lines as rows with (file, line_no); blank lines are skipped, anything but an object, or a blank required field, fails with its place."""
    rows = lines.where(F.trim("value") != "")
    place = F.concat("file", F.lit(":"), F.col("line_no").cast("string"))
    good = F.try_parse_json("value").isNotNull() & F.ltrim("value").startswith("{")
    row = F.when(good, F.from_json("value", schema)).otherwise(F.raise_error(F.concat(F.lit("not a JSON object at "), place)))
    out = rows.select("file", "line_no", row.alias("r")).select("file", "line_no", "r.*")
    for c in required:
        told = F.trim(F.col(c).cast("string")) != ""
        out = out.withColumn(c, F.when(told, F.col(c)).otherwise(F.raise_error(F.concat(F.lit(f"blank {c} at "), F.concat("file", F.lit(":"), F.col("line_no").cast("string"))))))
    return out


def last_rows(lines: DataFrame, schema: StructType, key: str, only: Column | None = None) -> DataFrame:
    """Of lines that read, the last row of each key (of those that ``only`` allows); others are dropped."""
    good = F.try_parse_json("value").isNotNull() & F.ltrim("value").startswith("{")
    rows = lines.where(good).select("line_no", F.from_json("value", schema).alias("r")).select("line_no", "r.*").where(F.col(key).isNotNull())
    rows = rows.where(only) if only is not None else rows
    rest = [c for c in rows.columns if c not in (key, "line_no")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), "line_no").alias("r")).select(key, "r.*")


def query_set(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, id, category, query, expected) of an evaluation set; blank lines and # comments are skipped, id and query are required."""
    lines = numbered_lines(spark, path).where(~F.ltrim("value").startswith("#"))
    schema = StructType.fromDDL("id string, category string, query string, expected_document_ids array<string>")
    out = json_objects(lines, schema, ("id", "query"))
    return out.select("line_no", "id", "category", "query", F.coalesce("expected_document_ids", F.array().cast("array<string>")).alias("expected"))


def positional_pairs(left: DataFrame, right: DataFrame, same: tuple[str, ...]) -> DataFrame:
    """Rows of two scans by their place among the lines that hold one; unequal lengths or values of ``same`` fail with the place.

    Columns of ``right`` get a ``right_`` before their names.
    """
    from palimpsest.operators.enrichment import ranked

    a = ranked(left, "line_no").alias("a")
    b = ranked(right, "line_no").select("at", *(F.col(c).alias(f"right_{c}") for c in right.columns)).alias("b")
    both = a.join(b, F.col("a.at") == F.col("b.at"), "full_outer")
    at = F.coalesce("a.at", "b.at").cast("string")
    alike = F.lit(True)
    for c in same:
        alike = alike & F.col(c).eqNullSafe(F.col(f"right_{c}"))
    problem = F.when(F.col("a.at").isNull() | F.col("b.at").isNull(), F.concat(F.lit("one side ends before row "), at)).when(~alike, F.concat(F.lit("rows differ at "), at))
    checked = F.when(problem.isNull(), F.coalesce("a.at", "b.at")).otherwise(F.raise_error(problem).cast("bigint"))
    return both.select(*(F.col(f"a.{c}") for c in left.columns), *(F.col(f"b.right_{c}") for c in right.columns), checked.alias("at"))


def selected(rows: DataFrame, key: str, ids: list[str] | None, limit: int | None, order: str = "line_no") -> DataFrame:
    """All rows, or those of ``ids``; of them the first ``limit`` in order."""
    out = rows.where(F.col(key).isin(ids)) if ids else rows
    return out.orderBy(order).limit(limit) if limit else out


def embedding_candidates(rows: DataFrame, ids: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """(line_no, id, document_id, content, content_sha256) of chunks; both ids are required, contents are trimmed."""
    need = lambda c: F.when(F.trim(F.col(c)) != "", F.col(c)).otherwise(F.raise_error(F.concat(F.lit(f"blank {c} in row "), F.col("line_no").cast("string"))))
    text = F.trim(F.coalesce("content", F.lit("")))
    out = rows.select("line_no", need("id").alias("id"), need("document_id").alias("document_id"), text.alias("content"), F.sha2(text, 256).alias("content_sha256"))
    return selected(out, "document_id", ids, limit)


def manifests(spark: SparkSession, root: str, schema: StructType, kind: str, version: int) -> DataFrame:
    """Rows with path of all JSON files below ``root`` that read and are of this schema and version; others are left out."""
    texts = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(root)
    rows = texts.select(F.col("_metadata.file_path").alias("path"), "value").where(F.try_parse_json("value").isNotNull())
    read = rows.select("path", F.from_json("value", StructType([*schema.fields, *StructType.fromDDL("schema string, version int").fields])).alias("r")).select("path", "r.*")
    return read.where((F.col("schema") == kind) & (F.col("version") == version)).drop("schema", "version")


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, relative, name, size, modified_at) of the files below ``root``; their contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    flat = F.regexp_replace("path", "^file:/*", "/")
    base = root.removeprefix("file://").rstrip("/") + "/"
    relative = F.when(F.instr(flat, base) > 0, F.substr(flat, F.instr(flat, base) + len(base))).otherwise(flat)
    return files.select("path", relative.alias("relative"), F.substring_index("path", "/", -1).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified_at"))


_CANONICAL = r"^([^/]+)/([^/]+)/([^/]+)/([0-9a-f]{64})\.json$"


def artifacts(files: DataFrame) -> DataFrame:
    """(analyzer, api_version, document_id, sha256, path) of files whose place says what they are: four parts, the last a digest."""
    part = lambda k: F.regexp_extract("relative", _CANONICAL, k)
    return files.where(F.col("relative").rlike(_CANONICAL)).select(part(1).alias("analyzer"), part(2).alias("api_version"), part(3).alias("document_id"), part(4).alias("sha256"), "path")


def artifact_census(files: DataFrame) -> DataFrame:
    """(kind, n, bytes) of artifact files: canonical, range_result, range_metadata or other."""
    in_parts = F.col("relative").rlike(r"(^|/)[^/]*\.parts/")
    kind = (
        F.when(F.col("relative").rlike(_CANONICAL), "canonical").when(in_parts & F.col("name").endswith(".meta.json"), "range_metadata")
        .when(in_parts & F.col("name").startswith("pages-"), "range_result").otherwise("other")
    )
    return files.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))


def recovery_tier(counts: DataFrame) -> DataFrame:
    """Add tier to counts (documents, snapshots, raw, sources, sidecars, canonical, outputs): how well a ledger can be rebuilt."""
    has = lambda c: F.col(c) > 0
    tier = (
        F.when(has("documents") & has("snapshots") & has("sources"), "A").when(has("raw") & has("sources"), "A_RAW_EVIDENCE_NEEDS_MANIFESTS").when(has("sources") & has("sidecars"), "B")
        .when(has("sources"), "C").when(has("canonical"), "D").when(has("outputs"), "E").otherwise("none")
    )
    return counts.withColumn("tier", tier)


def downloads(files: DataFrame) -> DataFrame:
    """(document_id, path, size) of downloaded files by their stem; hidden ones, older versions, metadata and sidecars are left out."""
    kept = ~F.col("name").startswith(".") & ~F.col("relative").rlike(r"(^|/)(_versions|_metadata)/") & ~F.col("name").endswith(".metadata.json")
    return files.where(kept).select(F.regexp_extract("name", r"^(.+?)(\.[^.]*)?$", 1).alias("document_id"), "path", "size")


def unzipped_facts(content: pd.Series) -> pd.DataFrame:
    """Sizes and digest of a gzip file's content; nulls if it can't be read."""
    out = []
    for data in content:
        try:
            raw = gzip.decompress(data)
            out.append((len(data), len(raw), hashlib.sha256(raw).hexdigest()))
        except (OSError, EOFError, TypeError, ValueError):
            out.append((None if data is None else len(data), None, None))
    return pd.DataFrame(out, columns=["size", "raw_size", "sha256"])


def verified_snapshots(stored: DataFrame, files: DataFrame) -> DataFrame:
    """(sha256, problem) of stored snapshots (sha256, size, raw_size, path) against files (path, content): null if all agree."""
    facts = F.pandas_udf(unzipped_facts, "struct<size: long, raw_size: long, sha256: string>")
    found = files.select("path", facts("content").alias("f"))
    joined = stored.join(found, "path", "left")
    problem = (
        F.when(F.col("f").isNull(), "missing").when(F.col("f.size") != F.col("size"), "size").when(F.col("f.sha256").isNull(), "unreadable")
        .when(F.col("f.raw_size") != F.col("raw_size"), "raw_size").when(F.col("f.sha256") != F.col("sha256"), "sha256")
    )
    return joined.select("sha256", problem.alias("problem"))


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines of a path; none where it doesn't exist."""
    return spark.read.schema(schema).json(path) if exists(spark, path) else spark.createDataFrame([], schema)


def log_entries(logs: DataFrame, wanted: str, marker: str, schema: StructType, *, now: Column, days: int = 30, most: int = 20) -> DataFrame:
    """The newest ``most`` log lines (at, message) of ``days`` that hold ``wanted``, with the JSON behind ``marker`` read."""
    recent = logs.where(F.col("message").contains(wanted) & (F.unix_timestamp("at") > F.unix_timestamp(now) - days * 86_400))
    told = F.when(F.col("message").contains(marker), F.from_json(F.substr("message", F.instr("message", marker) + len(marker)), schema))
    return recent.orderBy(F.desc("at"), "message").limit(most).select("at", "message", told.alias("told"))


def coverage_intervals(rows: DataFrame, kind: str, version: int) -> DataFrame:
    """(start_day, end_day) of coverage manifests (schema, version, intervals of texts): other versions, and intervals that don't read or are upside down, are skipped."""
    each = rows.where((F.col("schema") == kind) & (F.col("version") == version)).select(F.explode("intervals").alias("i"))
    days = each.select(F.try_to_date("i.start", "yyyy-MM-dd").alias("start_day"), F.try_to_date("i.end", "yyyy-MM-dd").alias("end_day"))
    return days.where("start_day <= end_day")


def container_seeds(rows: DataFrame) -> DataFrame:
    """(id, title, kind) of rows that hold others, by id; blank columns fall back on the metadata's."""
    from palimpsest.functions.text import json_object
    from palimpsest.functions.titles import is_container

    meta = json_object(F.col("metadata"))
    pick = lambda c: F.coalesce(F.nullif(F.trim(F.col(c)), F.lit("")), F.try_element_at(meta, F.lit(c)))
    out = rows.select("id", pick("title").alias("title"), pick("kind").alias("kind"))
    return out.where(is_container(F.col("kind")))


def chosen_categories(catalogue: DataFrame, wanted: list[str]) -> tuple[DataFrame, DataFrame]:
    """Facet categories (category, ...) by slug, and the wanted slugs that name none."""
    from palimpsest.functions.titles import slug

    spark = catalogue.sparkSession
    asked = spark.createDataFrame([(w,) for w in wanted], "wanted string").select(slug(F.col("wanted")).alias("slug")).distinct()
    known = catalogue.withColumn("slug", slug(F.col("category")))
    return known.join(F.broadcast(asked), "slug"), asked.join(known, "slug", "left_anti")  # as many as were asked for
