"""What links records to where they come from: metadata, paths, hashes, logs, shelves, attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.text import first_text, json_object

# Fixed value: how a progress line is written.
PROGRESS = r"^\[0*(\d+)/0*(\d+|\?+)\]\s+(\S+)"


def metadata_projection(raw: Column) -> Column:
    """(company, language, document_types, file_types) of open JSON: a language may be a text or a list, of which the first text counts."""
    known = json_object(raw)
    text = lambda k: F.nullif(F.trim(F.try_element_at(known, F.lit(k))), F.lit(""))
    listed = lambda k: F.from_json(F.try_element_at(known, F.lit(k)), "array<string>")
    clean = lambda k: F.array_sort(F.array_distinct(F.filter(F.coalesce(listed(k), F.array().cast("array<string>")), lambda x: F.trim(x) != "")))
    language = F.when(F.ltrim(F.try_element_at(known, F.lit("language"))).startswith("["), first_text(listed("language"))).otherwise(text("language"))
    return F.struct(text("company").alias("company"), language.alias("language"), clean("document_types").alias("document_types"), clean("file_types").alias("file_types"))


def inherited(chunks: DataFrame, documents: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Chunks with their document's ``fields``; a chunk without a document keeps nulls."""
    return chunks.join(documents.select(key, *fields), key, "left")


def resolved_paths(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """(id, path) of wanted (id, candidates): the first candidate that is among ``files`` (path), null if none is."""
    each = wanted.select("id", F.posexplode_outer("candidates").alias("at", "path"))
    there = each.join(files.select("path").distinct().withColumn("_there", F.lit(True)), "path", "left")
    return there.groupBy("id").agg(F.min_by("path", F.when(F.col("_there"), F.col("at"))).alias("path"))


def result_hashes(records: DataFrame, key: str, order: list[str]) -> DataFrame:
    """(key, n, sha256): the digest of a document's records as JSON lines in their order."""
    rest = sorted(c for c in records.columns if c != key)
    line = F.to_json(F.struct(*rest), {"ignoreNullFields": "false"})
    held = records.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, line.alias("_line")))).alias("ls"))  # a document's records
    return held.select(key, F.size("ls").alias("n"), F.sha2(F.array_join(F.transform("ls", lambda x: x["_line"]), "\n"), 256).alias("sha256"))


def phase_counters(lines: DataFrame) -> DataFrame:
    """(phase, done, total, lines) of log lines (pos, message): the counters that each phase told last; other lines are passed over."""
    part = lambda k: F.regexp_extract("message", PROGRESS, k)
    rows = lines.where(F.col("message").rlike(PROGRESS)).select("pos", part(3).alias("phase"), part(1).cast("long").alias("done"), part(2).try_cast("long").alias("total"))
    return rows.groupBy("phase").agg(F.max_by("done", "pos").alias("done"), F.max_by("total", "pos").alias("total"), F.count("*").alias("lines"))


def shelf(actions: DataFrame) -> DataFrame:
    """(owner, chunk_id, since) of actions (owner, pos, action, chunk_id): what was added and not removed after; the first place of a stay counts."""
    last_removed = F.max(F.when(F.col("action") == "remove", F.col("pos"))).over(Window.partitionBy("owner", "chunk_id"))
    kept = actions.withColumn("_r", last_removed).where((F.col("action") == "add") & (F.col("_r").isNull() | (F.col("pos") > F.col("_r"))))
    return kept.groupBy("owner", "chunk_id").agg(F.min("pos").alias("since"))


def first_scope(*candidates: Column) -> Column:
    """The first of structs that says anything."""
    return F.coalesce(*candidates)


def attempt_states(log: DataFrame, most: int) -> DataFrame:
    """(document_id, attempts, state) of attempts (document_id, pos, ok): done at the first that goes well, quarantined after ``most`` that don't, open else."""
    out = log.groupBy("document_id").agg(F.min(F.when(F.col("ok"), F.col("pos"))).alias("_first"), F.count("*").alias("_n"), F.array_sort(F.collect_list("pos")).alias("_p"))  # a document's attempts
    attempts = F.when(F.col("_first").isNotNull(), F.array_position("_p", F.col("_first"))).otherwise(F.col("_n"))
    state = F.when(F.col("_first").isNotNull(), "DONE").when(F.col("_n") >= most, "QUARANTINED").otherwise("OPEN")
    return out.select("document_id", attempts.cast("long").alias("attempts"), state.alias("state"))


def set_scores(a: Column, b: Column) -> Column:
    """(precision, recall, f1) of two arrays as sets; zero where a denominator is."""
    both = F.size(F.array_intersect(a, b))
    p, r = (F.when(F.size(F.array_distinct(x)) > 0, both / F.size(F.array_distinct(x))).otherwise(F.lit(0.0)) for x in (a, b))
    return F.struct(p.alias("precision"), r.alias("recall"), F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0)).alias("f1"))
