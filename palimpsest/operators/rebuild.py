"""A ledger rebuilt from what outlives it: snapshots, document manifests, sidecars, files and analysis artifacts.

Each source is checked against its evidence first; what is left is merged by precedence, every document gets a
grade of completeness and the facts it lacks, and documents that need them are queued for repair.  An overlay
then puts verified manifests over what precedence chose and tells every value that it changed.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.operators.ledger import last_of

# The facts of a document, and those that are missing where only its file is left.
FACTS = ("title", "source_url", "item_kind", "filing_date", "submitter", "company", "project", "filing_number")
MINIMAL = (*FACTS, "scout_raw_evidence", "container_relationships", "original_downloaded_at", "original_first_seen_at")
CONTAINER_KINDS = ("folder", "compound document")
REFERENCES, REFERENCE_LISTS = ("snapshot_id", "detail_snapshot_id"), ("snapshot_ids",)


def told(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def listed(*parts: Column) -> Column:
    """The sorted distinct strings of columns that are arrays of strings."""
    none = F.array().cast("array<string>")
    return F.array_sort(F.array_distinct(F.concat(*(F.array_compact(F.coalesce(p, none)) for p in parts))))


# --- snapshots and references to them ------------------------------------------------------------


def snapshot_key(kind: Column, url: Column, sha256: Column) -> Column:
    """A number for (kind, url, content) that every rebuild gives alike: 60 bits of a digest."""
    return F.conv(F.substring(F.sha2(F.concat_ws("\x1f", kind, url, F.lower(sha256)), 256), 1, 15), 16, 10).cast("long")


def checked_snapshots(manifests: DataFrame, artifacts: DataFrame) -> DataFrame:
    """``manifests`` (original_id, kind, url, sha256, size, compressed_size, path, ...) with snapshot_id and reason.

    ``reason`` tells why the artifact (path, size, compressed_size, sha256) at the manifest's path doesn't bear it
    out, null if it does; snapshot_id is null then.
    """
    seen = artifacts.groupBy("path").agg(F.first("compressed_size").alias("_c"), F.first("size").alias("_s"), F.first("sha256").alias("_h"), F.lit(True).alias("_there"))
    differs = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    reason = F.when(F.col("_there").isNull(), "missing").when(differs("compressed_size", "_c"), "compressed_size").when(differs("size", "_s"), "size")
    reason = reason.when(~F.lower("sha256").eqNullSafe(F.lower("_h")), "sha256")
    out = manifests.join(seen, "path", "left").withColumn("reason", reason)
    return out.withColumn("snapshot_id", F.when(F.col("reason").isNull(), snapshot_key(F.col("kind"), F.col("url"), F.col("sha256")))).drop("_c", "_s", "_h", "_there")


def snapshot_mapping(checked: DataFrame) -> DataFrame:
    """(original_id, snapshot_id): one row for each original id that was borne out; of several the smallest new id."""
    good = checked.where("snapshot_id IS NOT NULL AND original_id IS NOT NULL")
    return good.groupBy("original_id").agg(F.min("snapshot_id").alias("snapshot_id"))


def as_id(value: Any) -> int | None:
    """An id as a number: of whole numbers, of their text, and of fractions cut off; null of anything else."""
    if isinstance(value, str):
        value = value.strip()
        return int(value) if value.lstrip("+-").isdecimal() and len(value) < 20 and value.isascii() else None
    try:
        return int(value) if isinstance(value, (bool, int, float)) else None
    except (OverflowError, ValueError):
        return None


def walk_references(value: Any, meet: Callable[[Any], Any]) -> Any:
    """``value`` with ``meet`` put for every reference, at any depth, without recursion; unmet ones of a list go."""
    root = [value]
    todo: list[Any] = [root]
    while todo:
        at = todo.pop()
        for k, item in list(at.items() if isinstance(at, dict) else enumerate(at)):
            if isinstance(at, dict) and k in REFERENCES:
                at[k] = meet(item)
            elif isinstance(at, dict) and k in REFERENCE_LISTS and isinstance(item, list):
                at[k] = [m for m in map(meet, item) if m is not None]
            elif isinstance(item, (dict, list)):
                todo.append(item)
    return root[0]


def _parsed(text: str) -> list:
    """The value in a list, or an empty list if there is none."""
    try:
        return [json.loads(text)]
    except (ValueError, RecursionError):
        return []


def remapped_references(rows: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """``rows`` with the snapshot ids in the JSON of ``column`` put over by ``mapping`` (original_id, snapshot_id).

    Ids are read out of the texts, joined with the mapping, which may be of any size, and put back; texts that are
    alike are handled once.  An id that isn't mapped is null, and left out of a list.  Keys are sorted, as in the
    library's stable JSON.  Null and invalid texts, and such that are nested deeper than the parser goes, are null.
    """
    keyed = rows.withColumn("_alike", F.sha2(F.col(column), 256))
    texts = keyed.where(F.col("_alike").isNotNull()).groupBy("_alike").agg(F.first(column).alias("_text"))

    @F.pandas_udf("array<long>")
    def ids(texts):
        def found(text):
            out: list[int] = []
            walk_references(_parsed(text), lambda v: out.append(i) if (i := as_id(v)) is not None and abs(i) < 2**63 else None)
            return sorted(set(out))

        return texts.map(found)

    @F.pandas_udf("string")
    def put(texts, olds, news):
        def made(text, old, new):
            value = _parsed(text)
            if not value:
                return None
            known = {int(a): int(b) for a, b in zip(old, new)} if old is not None else {}
            return json.dumps(walk_references(value, lambda v: known.get(as_id(v)))[0], sort_keys=True, separators=(",", ":"), ensure_ascii=False)

        return type(texts)([made(*x) for x in zip(texts, olds, news)], dtype=object)

    each = texts.select("_alike", F.explode(ids("_text")).alias("original_id"))
    met = each.join(mapping.select(F.col("original_id").cast("long").alias("original_id"), F.col("snapshot_id").cast("long").alias("snapshot_id")), "original_id")
    pairs = met.groupBy("_alike").agg(F.collect_list(F.struct("original_id", "snapshot_id")).alias("_p"))  # ids of one text
    made = texts.join(pairs, "_alike", "left").select("_alike", put("_text", F.col("_p.original_id"), F.col("_p.snapshot_id")).alias("_made"))
    out = keyed.join(made, "_alike", "left")
    return out.select(*(F.col("_made").alias(c) if c == column else F.col(c) for c in rows.columns))


# --- documents -----------------------------------------------------------------------------------


def manifest_documents(manifests: DataFrame, mapping: DataFrame) -> DataFrame:
    """Documents of manifests (document_id, inner_id, is_file, scout_status, detail_snapshot_id, FACTS) with detail_snapshot_id put over, and missing.

    Manifests that name another document than they hold are left out; of several of one document the greatest row counts.
    """
    good = last_of(manifests.where("document_id = inner_id").select("document_id", "is_file", "scout_status", "detail_snapshot_id", *FACTS), ["document_id"])
    met = good.join(mapping.select(F.col("original_id").alias("detail_snapshot_id"), "snapshot_id"), "detail_snapshot_id", "left")
    lost = F.when(F.col("detail_snapshot_id").isNotNull() & F.col("snapshot_id").isNull(), "detail_snapshot_evidence")
    status = F.coalesce(told(F.col("scout_status")), F.lit("PENDING"))
    missing = listed(F.array(lost, F.when(status != "SUCCEEDED", F.concat(F.lit("scout_status:"), status))))
    return met.select("document_id", F.coalesce("is_file", F.lit(False)).alias("is_file"), status.alias("scout_status"), F.col("snapshot_id").alias("detail_snapshot_id"), *FACTS, missing.alias("missing"))


def trusted_sidecars(files: DataFrame, sidecars: DataFrame, schema: str) -> DataFrame:
    """``files`` (document_id, path, sha256, size) with issue, null where the sidecar (document_id, named_id, schema, sha256, downloaded_at, memberships, FACTS) can be trusted, and its facts (s_...)."""
    own = last_of(sidecars, ["document_id"]).select("document_id", F.col("named_id").alias("_n"), F.col("schema").alias("_v"), F.col("sha256").alias("_h"), F.col("downloaded_at").alias("s_downloaded_at"), F.col("memberships").alias("s_memberships"), *(F.col(c).alias(f"s_{c}") for c in FACTS), F.lit(True).alias("_there"))
    issue = F.when(F.col("_there").isNull(), "sidecar").when(~F.col("_v").eqNullSafe(F.lit(schema)), "sidecar_schema").when(~F.col("_n").eqNullSafe(F.col("document_id")), "sidecar_document_id")
    issue = issue.when(~F.lower("_h").eqNullSafe(F.lower("sha256")) | (F.col("_h") == ""), "sidecar_sha256")
    return files.join(own, "document_id", "left").withColumn("issue", issue).drop("_n", "_v", "_h", "_there")


def sidecar_missing() -> Column:
    """Facts that a trusted sidecar lacks; containers lack their relationships without memberships."""
    lack = [F.when(told(F.col(f"s_{c}")).isNull(), F.lit(c)) for c in FACTS]
    container = F.lower(F.coalesce("s_item_kind", F.lit(""))).isin(*CONTAINER_KINDS) & ~F.coalesce("s_memberships", F.lit(False))
    return F.array(*lack, F.when(container, "container_relationships"))


def rebuilt_documents(documents: DataFrame, files: DataFrame) -> DataFrame:
    """Documents of ``manifest_documents`` and files of ``trusted_sidecars`` in one table.

    (document_id, is_file, FACTS, path, sha256, recovered_from, completeness, state, refresh, missing).  With a
    trusted sidecar each fact is the manifest's, or the sidecar's where that is blank; with a file and no such
    sidecar none is sure; without a file the manifest's facts stand.
    """
    m = documents.withColumn("_m", F.lit(True)).withColumnRenamed("missing", "_lack").withColumnRenamed("is_file", "_is_file").drop("scout_status", "detail_snapshot_id")
    f = files.withColumn("_f", F.lit(True))
    both = m.join(f, "document_id", "full_outer")
    has_m, has_f, trusted = F.col("_m").isNotNull(), F.col("_f").isNotNull(), F.col("_f").isNotNull() & F.col("issue").isNull()
    facts = [F.when(trusted, F.coalesce(told(F.col(c)), told(F.col(f"s_{c}")))).when(~has_f, told(F.col(c))).alias(c) for c in FACTS]
    evidence = F.array(F.when(~has_m, "scout_raw_evidence"))
    minimal = F.array(*map(F.lit, MINIMAL), F.col("issue"))
    missing = F.when(trusted, listed(evidence, sidecar_missing(), F.col("_lack"))).when(has_f, listed(minimal)).otherwise(listed(F.col("_lack")))
    sources = F.array_compact(F.array(F.when(has_m & (trusted | ~has_f), "manifest"), F.when(trusted, "sidecar"), F.when(has_f, "file")))
    out = both.select("document_id", (has_f | F.coalesce("_is_file", F.lit(False))).alias("is_file"), *facts, "path", "sha256", F.array_join(sources, "+").alias("recovered_from"), missing.alias("missing"), "_m", "_f", "issue", "_lack")
    lacks = F.size("missing") > 0
    blind = F.col("_f").isNotNull() & F.col("issue").isNotNull()
    grade = F.when(blind & F.col("_m").isNull(), "minimal").when(lacks, "partial").otherwise("complete")
    # with a manifest and a trusted sidecar the manifest's own state stands
    known = F.when(F.col("_m").isNotNull(), F.size("_lack") > 0).otherwise(lacks)
    state = F.when(blind, "RECOVERED_MINIMAL").when(known, "RECOVERED_PARTIAL").otherwise("RECOVERED_COMPLETE")
    return out.select("document_id", "is_file", *FACTS, "path", "sha256", "recovered_from", grade.alias("completeness"), state.alias("state"), (blind | known).alias("refresh"), "missing")


def repair_queue(rebuilt: DataFrame) -> DataFrame:
    """(document_id, priority, missing) of documents that lack facts and are to be asked for again."""
    lack = rebuilt.where("refresh AND size(missing) > 0")
    return lack.select("document_id", F.when(F.col("completeness") == "minimal", "HIGH").otherwise("NORMAL").alias("priority"), "missing")


# --- analyses and the overlay --------------------------------------------------------------------

COUNTS = ("pages", "tables", "sections", "warnings")


@dataclass(frozen=True)
class Overlay:
    documents: DataFrame
    analyses: DataFrame
    conflicts: DataFrame
    counts: DataFrame


def checked_analyses(artifacts: DataFrame, files: DataFrame) -> DataFrame:
    """``artifacts`` (document_id, sha256, analyzer, version, payload_analyzer, payload_version, contents, COUNTS) with outcome.

    unmatched: no current file with that content; invalid: the payload names another analyzer or version, or has no
    contents; else recovered.  A payload that names none is taken for what its path says.
    """
    current = files.select("document_id", F.lower("sha256").alias("sha256"), F.lit(True).alias("_there")).distinct()
    own = artifacts.withColumn("sha256", F.lower("sha256")).join(current, ["document_id", "sha256"], "left")
    same = (F.coalesce(told(F.col("payload_analyzer")), "analyzer") == F.col("analyzer")) & (F.coalesce(told(F.col("payload_version")), "version") == F.col("version"))
    good = same & (F.coalesce("contents", F.lit(0)) > 0)
    outcome = F.when(F.col("_there").isNull(), "unmatched").when(~F.coalesce(good, F.lit(False)), "invalid").otherwise("recovered")
    return own.withColumn("outcome", outcome).drop("_there")


def recovered_analyses(checked: DataFrame) -> DataFrame:
    """One row for each (document_id, sha256, analyzer, version) recovered; counts of zero are unknown, but that of warnings."""
    key = ["document_id", "sha256", "analyzer", "version"]
    good = checked.where("outcome = 'recovered'")
    rows = good.select(*key, *(F.nullif(F.col(c), F.lit(0)).alias(c) for c in COUNTS[:3]), F.coalesce("warnings", F.lit(0)).alias("warnings"))
    return last_of(rows, key)


def overlay(rebuilt: DataFrame, manifests: DataFrame, analyses: DataFrame, analysis_manifests: DataFrame, artifacts: DataFrame) -> Overlay:
    """Verified evidence over precedence.

    Documents: a manifest that holds the document it names gives all FACTS, blank ones too (title and address as
    empty texts).  Analyses: a manifest (document_id, sha256, analyzer, version, path, size, artifact_sha256,
    updated_at, COUNTS) counts if the document's current file has its content and the artifact (path, size, sha256)
    is as it says (of several at its path, any); of several of one key the latest, of those the greatest row.
    ``conflicts`` (entity, key, field, before, after) has each value that was told before and is another now;
    ``counts`` (entity, outcome, n) the outcomes.
    """
    exact = last_of(manifests.where("document_id = inner_id").select("document_id", *FACTS), ["document_id"])
    blank = lambda c: F.coalesce(F.col(f"e.{c}"), F.lit("")) if c in ("title", "source_url") else F.col(f"e.{c}")
    joined = rebuilt.alias("r").join(exact.withColumn("_e", F.lit(True)).alias("e"), F.col("r.document_id") == F.col("e.document_id"), "left")
    there = F.col("_e").isNotNull()
    documents = joined.select(*(F.when(there, blank(c)).otherwise(F.col(f"r.{c}")).alias(c) if c in FACTS else F.col(f"r.{c}").alias(c) for c in rebuilt.columns), there.alias("exact"))

    key = ["document_id", "sha256", "analyzer", "version"]
    file_ = rebuilt.where("sha256 IS NOT NULL").select("document_id", F.lower("sha256").alias("sha256"), F.lit(True).alias("_file"))
    seen = artifacts.select(F.col("path").alias("_p"), F.col("size").alias("_s"), F.lower("sha256").alias("_h"))
    own = analysis_manifests.withColumn("sha256", F.lower("sha256")).join(file_, ["document_id", "sha256"], "left")
    own = own.withColumns({"_p0": F.col("path"), "_s0": F.col("size"), "_h0": F.lower("artifact_sha256")})  # names that no artifact has
    same = (F.col("_p") == F.col("_p0").outer()) & F.col("_s").eqNullSafe(F.col("_s0").outer()) & F.col("_h").eqNullSafe(F.col("_h0").outer())
    own = own.withColumn("_true", seen.where(same).exists())
    own = own.withColumn("outcome", F.when(F.col("_file").isNull(), "unmatched").when(~F.col("_true"), "invalid").otherwise("restored")).drop("_p0", "_s0", "_h0", "_true")
    restored = own.where("outcome = 'restored'").groupBy(*key).agg(F.max(F.struct("updated_at", *COUNTS)).alias("b")).select(*key, *(F.col(f"b.{c}").alias(c) for c in COUNTS))
    a, b = analyses.withColumn("_a", F.lit(True)).alias("a"), restored.withColumn("_b", F.lit(True)).alias("b")
    merged = a.join(b, key, "full_outer")
    over = F.col("_b").isNotNull()
    out = merged.select(*key, *(F.when(over, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in COUNTS), F.when(over, "manifest").otherwise("artifact").alias("source"))

    def changes(rows: DataFrame, entity: str, name: Column, pairs: list[tuple[str, Column, Column]], when: Column) -> DataFrame:
        each = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), x.cast("string").alias("before"), y.cast("string").alias("after")) for f, x, y in pairs)))
        found = rows.where(when).select(F.lit(entity).alias("entity"), name.alias("key"), each.alias("c")).select("entity", "key", "c.*")
        return found.where("before IS NOT NULL AND before <> '' AND NOT (before <=> after)")

    conflicts = changes(joined, "document", F.col("r.document_id").cast("string"), [(c, F.col(f"r.{c}"), blank(c)) for c in FACTS], there)
    conflicts = conflicts.unionByName(changes(merged, "analysis", F.concat_ws(":", *(F.col(c).cast("string") for c in key)), [(c, F.col(f"a.{c}"), F.col(f"b.{c}")) for c in COUNTS], over & F.col("_a").isNotNull()))
    return Overlay(documents, out, conflicts, _document_counts(rebuilt, manifests).union(own.groupBy(F.lit("analysis").alias("entity"), "outcome").agg(F.count("*").alias("n"))))


def _document_counts(rebuilt: DataFrame, manifests: DataFrame) -> DataFrame:
    """(entity, outcome, n) of documents: updated, missing_document, invalid_manifest.

    Ids are counted, not joined, and apart from the analyses: next to larger rows Spark would put all ids into one task.
    """
    told_by = lambda rows, m, r: rows.select("document_id", F.lit(m).alias("_m"), F.lit(r).alias("_r"))
    ids = told_by(manifests.where("document_id = inner_id"), 1, 0).union(told_by(rebuilt.where("document_id IS NOT NULL"), 0, 1))
    met = ids.groupBy("document_id").agg(F.max("_m").alias("_m"), F.sum("_r").alias("_r")).where("_m = 1")
    found = met.agg(F.sum("_r").alias("updated"), F.count_if(F.col("_r") == 0).alias("missing_document"))
    bad = manifests.agg(F.count_if(F.expr("NOT (document_id <=> inner_id) OR document_id IS NULL")).alias("invalid_manifest"))
    rows = found.unpivot([], ["updated", "missing_document"], "outcome", "n").union(bad.unpivot([], ["invalid_manifest"], "outcome", "n"))
    return rows.where("n > 0").select(F.lit("document").alias("entity"), "outcome", "n")
