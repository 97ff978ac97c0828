"""Are analysis artifacts what the ledger says they are, and which documents are to be analyzed (again)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.operators.normalize import once

# Statuses of a conversion that gave a result.
CONVERTED = ("success", "partial_success")


def _kind(v: Column) -> Column:
    """The kind of a variant in SQL's words, up to the first bracket; null of null."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def checked_artifacts(rows: DataFrame) -> DataFrame:
    """``rows`` (document_id, analyzer, version, payload, markdown_file, page_count, table_count, section_count, source_pages, conversion_status) with problems and usable.

    ``payload`` is the artifact's text, null if there is no file; ``markdown_file`` likewise.  ``problems`` is an array of
    (level, reason, expected, actual), errors and warnings in the order of the checks:

    * missing, not_an_object: nothing else can be said of such a payload;
    * analyzer, version: the payload names another one, or none;
    * contents, contents_empty: not an array, or an empty one; content_not_an_object, markdown_missing: the first
      content that is so (``actual`` is its place);
    * markdown_differs: the file isn't the contents' texts joined by a blank line; warning markdown_file_missing;
    * source_pages: another number of pages than the source has; warnings page_count, table_count, section_count: another than the ledger's;
    * conversion: a status that gave no result (null is fine); warning partial_success.

    ``usable`` is true where no problem is an error.  Counts that aren't told aren't compared.
    """
    v = F.try_parse_json("payload")
    of = lambda x, path, kind: F.try_variant_get(x, path, kind)
    rows = once(rows, _v=v).withColumns({"_kind": _kind(F.col("_v")), "_list": of(F.col("_v"), "$.contents", "variant"), "_items": of(F.col("_v"), "$.contents", "array<variant>")})
    text = lambda *paths: F.coalesce(*(F.nullif(of(F.col("_v"), p, "string"), F.lit("")) for p in paths))
    facts = F.transform(
        "_items",
        lambda x, i: F.struct(
            i.alias("at"), (_kind(x) == "OBJECT").alias("object"), (_kind(of(x, "$.markdown", "variant")) == "STRING").alias("told"), F.coalesce(of(x, "$.markdown", "string"), F.lit("")).alias("markdown"),
            *(F.greatest(F.coalesce(F.size(of(x, f"$.{c}", "array<variant>")), F.lit(0)), F.lit(0)).alias(c) for c in ("pages", "tables", "sections")),
        ),
    )
    rows = once(rows, _analyzer=text("$.analyzerId", "$.analyzer_id"), _version=text("$.apiVersion", "$.api_version"), _facts=facts)
    total = lambda c: F.aggregate("_facts", F.lit(0), lambda a, x: a + x[c])
    first = lambda bad: F.get(F.filter("_facts", bad), F.lit(0))["at"]
    rows = rows.withColumns({"_text": F.array_join(F.transform("_facts", lambda x: x["markdown"]), "\n\n"), "_pages": total("pages"), "_tables": total("tables"), "_sections": total("sections"), "_bad": first(lambda x: ~F.coalesce(x["object"], F.lit(False))), "_mute": first(lambda x: F.coalesce(x["object"], F.lit(False)) & ~F.coalesce(x["told"], F.lit(False)))})

    def problem(level: str, reason: str, when: Column, expected: Column | None = None, actual: Column | None = None) -> Column:
        none = F.lit(None).cast("string")
        told = [none if c is None else c.cast("string") for c in (expected, actual)]
        return F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(level).alias("level"), F.lit(reason).alias("reason"), told[0].alias("expected"), told[1].alias("actual")))

    parsed = F.coalesce(F.col("_kind") == "OBJECT", F.lit(False))
    listed = parsed & F.coalesce(_kind(F.col("_list")) == "ARRAY", F.lit(False))
    filled = listed & (F.size("_items") > 0)
    whole = filled & F.col("_bad").isNull() & F.col("_mute").isNull()
    differs = lambda a, b: F.col(a).isNotNull() & (F.col(a) != F.col(b))
    checks = [
        problem("error", "missing", F.col("payload").isNull()),
        problem("error", "not_an_object", F.col("payload").isNotNull() & ~parsed, None, F.lower("_kind")),
        problem("error", "analyzer", parsed & ~F.col("_analyzer").eqNullSafe(F.col("analyzer")), F.col("analyzer"), F.col("_analyzer")),
        problem("error", "version", parsed & ~F.col("_version").eqNullSafe(F.col("version")), F.col("version"), F.col("_version")),
        problem("error", "contents", parsed & ~listed),
        problem("error", "contents_empty", listed & (F.size("_items") == 0)),
        problem("error", "content_not_an_object", filled & F.col("_bad").isNotNull(), None, F.col("_bad")),
        problem("error", "markdown_missing", filled & F.col("_mute").isNotNull(), None, F.col("_mute")),
        problem("error", "markdown_differs", whole & (F.col("markdown_file") != F.col("_text")), F.length("_text"), F.length("markdown_file")),
        problem("warning", "markdown_file_missing", whole & F.col("markdown_file").isNull()),
        problem("error", "source_pages", filled & differs("source_pages", "_pages"), F.col("source_pages"), F.col("_pages")),
        *(problem("warning", c, filled & differs(c, f"_{c.removesuffix('_count')}s"), F.col(c), F.col(f"_{c.removesuffix('_count')}s")) for c in ("page_count", "table_count", "section_count")),
        problem("error", "conversion", ~F.col("conversion_status").isin(*CONVERTED), None, F.col("conversion_status")),
        problem("warning", "partial_success", F.col("conversion_status") == "partial_success"),
    ]
    out = once(rows, problems=F.array_compact(F.array(*checks)))
    out = out.withColumn("usable", ~F.exists("problems", lambda p: p["level"] == "error"))
    return out.drop("_v", "_kind", "_list", "_items", "_analyzer", "_version", "_facts", "_text", "_pages", "_tables", "_sections", "_bad", "_mute")


def artifact_problems(checked: DataFrame) -> DataFrame:
    """(document_id, analyzer, version, position, level, reason, expected, actual): one row for each problem, in the order of the checks."""
    return checked.select("document_id", "analyzer", "version", F.posexplode("problems").alias("position", "p")).select("document_id", "analyzer", "version", "position", "p.*")


def to_analyze(files: DataFrame, analyses: DataFrame, artifacts: DataFrame, *, force: bool = False, limit: int | None = None) -> DataFrame:
    """(document_id, file_id, sha256, reason) of documents that are to be analyzed, with ``limit`` the first so many by natural id.

    Of a document's current files (document_id, file_id, sha256, is_current) the one with the smallest id counts.  It
    is left out if its analysis (file_id, sha256, status) has succeeded and the artifact (document_id, sha256, usable)
    is usable; ``reason`` is forced, new, status or artifact.  Of several analyses or artifacts of one file a good one is
    enough.  Files without a document are left out.
    """
    from palimpsest.functions.text import natural_order

    current = files.where("is_current AND document_id IS NOT NULL").groupBy("document_id").agg(F.min(F.struct("file_id", "sha256")).alias("f")).select("document_id", "f.*")
    done = analyses.groupBy("file_id", "sha256").agg(F.max(F.coalesce(F.col("status") == "SUCCEEDED", F.lit(False))).alias("_done"))
    good = artifacts.groupBy("document_id", "sha256").agg(F.max(F.coalesce("usable", F.lit(False))).alias("_good"))
    rows = current.join(done, ["file_id", "sha256"], "left").join(good, ["document_id", "sha256"], "left")
    reason = F.when(F.lit(force), "forced").when(F.col("_done").isNull(), "new").when(~F.col("_done"), "status").when(~F.coalesce("_good", F.lit(False)), "artifact")
    out = rows.withColumn("reason", reason).where("reason IS NOT NULL").select("document_id", "file_id", "sha256", "reason")
    return out.orderBy(*natural_order(F.col("document_id"))).limit(limit) if limit is not None else out
