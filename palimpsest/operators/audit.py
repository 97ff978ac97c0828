"""The audit of a ledger: containers and their members both ways, counts, endpoints, snapshots, open errors.

Every finding is a row (counter, key, detail, n); the counters are their sums, so none is told without its rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Findings about members, and all that make a ledger unsound.
MEMBERSHIP = ("duplicate_member_ids", "missing_member_documents", "missing_child_backlinks", "orphan_child_backlinks", "reported_count_mismatches", "parsed_count_mismatches", "effective_count_mismatches")
STRUCTURE = ("incomplete_containers", "missing_container_metadata", "missing_result_endpoints", "endpoint_mismatches", "containers_without_snapshot_references", "missing_container_snapshot_rows", "container_snapshot_wrong_kind", "raw_snapshot_failures")
TOTALS = ("documents_total", "containers_total", "containers_complete", "containers_empty", "nested_container_relationships_total", "container_snapshot_references", "raw_snapshots_verified", "unresolved_errors")


@dataclass(frozen=True)
class Audit:
    #: (counter, n): TOTALS, MEMBERSHIP, STRUCTURE, membership_mismatches, structural_failures, issues, ok (1 or 0) and unresolved:<severity>
    counters: DataFrame
    #: (counter, key, detail, n): every finding
    issues: DataFrame

    def examples(self, most: int = 50) -> DataFrame:
        """The first ``most`` findings, by counter and key."""
        return self.issues.orderBy("counter", "key", "detail").limit(most)


def _own_findings(endpoint: str) -> Column:
    """Findings of a container that its own row tells, as an array of (counter, detail, n)."""

    def found(counter: str, when: Column, detail: Column | None = None, n: Column | None = None) -> Column:
        return F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(counter).alias("counter"), (F.lit("") if detail is None else detail).alias("detail"), (F.lit(1) if n is None else n).cast("long").alias("n")))

    known, complete = F.col("has_metadata"), F.coalesce("complete", F.lit(False))
    said = lambda c, n: F.concat_ws(" != ", F.col(c).cast("string"), n.cast("string"))
    unlike = lambda c, n: F.col(c).isNotNull() & (F.col(c) != n)
    members, observed = F.size(F.array_distinct("member_ids")), F.size("observed_ids")
    twice = F.size("member_ids") - members
    place = F.trim(F.coalesce("endpoint", F.lit("")))
    return F.array_compact(
        F.array(
            found("missing_container_metadata", ~known),
            found("duplicate_member_ids", known & (twice > 0), twice.cast("string"), twice),
            found("incomplete_containers", known & ~complete),
            found("effective_count_mismatches", known & (F.upper(F.trim("state")) == "EMPTY") & (F.size("member_ids") > 0), F.lit("EMPTY")),
            found("parsed_count_mismatches", known & unlike("parsed", observed), said("parsed", observed)),
            found("effective_count_mismatches", known & unlike("effective", members), said("effective", members)),
            found("reported_count_mismatches", known & complete & unlike("reported", observed), said("reported", observed)),
            found("missing_result_endpoints", known & (place == "")),
            found("endpoint_mismatches", known & (place != "") & ~F.endswith(F.rtrim(place, F.lit("/")), F.concat(F.lit(endpoint), "document_id")), place),
            found("containers_without_snapshot_references", known & (F.size("snapshot_ids") == 0)),
        )
    )


def audit(documents: DataFrame, backlinks: DataFrame, snapshots: DataFrame, errors: DataFrame, *, verified: DataFrame | None = None, endpoint: str = "/Item/LoadResult/", fail_on_unresolved: bool = False) -> Audit:
    """The audit of documents (document_id, is_container, has_metadata, member_ids, observed_ids, complete, state, reported, parsed, effective, endpoint, snapshot_ids).

    ``backlinks`` (child, parent) are those that documents tell, blank parents are none; ``snapshots`` is (id,
    source_kind); ``errors`` is (severity, resolved_at); ``verified`` (id, ok), if given, has the outcome of reading
    snapshots.  Null arrays count as empty, null counts aren't held against anything, rows without an id are left out.
    A container without metadata is that finding alone.  ``ok`` needs no finding, and, with ``fail_on_unresolved``, no open error.
    """
    empty = {"member_ids": "array<string>", "observed_ids": "array<string>", "snapshot_ids": "array<bigint>"}
    rows = documents.where("document_id IS NOT NULL").withColumns({c: F.coalesce(c, F.array().cast(k)) for c, k in empty.items()} | {"has_metadata": F.coalesce("has_metadata", F.lit(False))})
    boxes = rows.where("is_container")
    names = ("counter", "key", "detail", "n")
    own = boxes.select("document_id", F.explode(_own_findings(endpoint)).alias("f")).select("f.counter", F.col("document_id").alias("key"), "f.detail", "f.n")

    known = rows.select(F.col("document_id").alias("child"), "is_container")
    edges = boxes.where("has_metadata").select(F.col("document_id").alias("parent"), F.explode(F.array_distinct("member_ids")).alias("child"))
    met = edges.join(known, "child", "left")
    told = backlinks.where("child IS NOT NULL AND trim(coalesce(parent, '')) <> ''").select("child", "parent")
    one = lambda counter, x, key, detail: x.select(F.lit(counter).alias("counter"), F.col(key).alias("key"), F.col(detail).cast("string").alias("detail"), F.lit(1).cast("long").alias("n"))
    lost = one("missing_member_documents", met.where("is_container IS NULL"), "parent", "child")
    mute = one("missing_child_backlinks", met.where("is_container IS NOT NULL").join(told.distinct(), ["child", "parent"], "left_anti"), "child", "parent")
    orphans = one("orphan_child_backlinks", told.join(known.select("child"), "child", "left_semi").join(edges, ["child", "parent"], "left_anti"), "child", "parent")

    used = boxes.where("has_metadata").select(F.col("document_id").alias("parent"), F.explode(F.array_distinct("snapshot_ids")).alias("id")).where("id IS NOT NULL")
    seen = used.join(snapshots.select("id", F.lower(F.trim("source_kind")).alias("kind"), F.lit(True).alias("there")), "id", "left")
    gone = one("missing_container_snapshot_rows", seen.where("there IS NULL"), "parent", "id")
    other = one("container_snapshot_wrong_kind", seen.where("there AND NOT coalesce(kind = 'container', false)"), "parent", "id")
    parts = [own.select(*names), lost, mute, orphans, gone, other]
    if verified is not None:
        parts.append(one("raw_snapshot_failures", verified.where("NOT coalesce(ok, false)").select(F.col("id").cast("string").alias("id")), "id", "id"))
    issues = reduce(DataFrame.unionByName, parts)

    open_errors = errors.where("resolved_at IS NULL")
    total = lambda counter, x: x.agg(F.lit(counter).alias("counter"), F.count("*").alias("n"))
    kinds = [
        total("documents_total", rows), total("containers_total", boxes), total("containers_complete", boxes.where("has_metadata AND complete")),
        total("containers_empty", boxes.where("has_metadata AND upper(trim(state)) = 'EMPTY'")), total("nested_container_relationships_total", met.where("is_container")),
        total("container_snapshot_references", used.select("id").distinct()), total("unresolved_errors", open_errors), total("issues", issues),
        open_errors.groupBy(F.concat(F.lit("unresolved:"), F.upper(F.trim("severity"))).alias("counter")).agg(F.count("*").alias("n")),
    ]
    if verified is not None:
        kinds.append(total("raw_snapshots_verified", verified.where("ok")))
    sums = issues.groupBy("counter").agg(F.sum("n").alias("n"))
    spark = documents.sparkSession
    zero = spark.createDataFrame([(c, 0) for c in (*TOTALS, *MEMBERSHIP, *STRUCTURE)], "counter string, n long")  # names only
    plain = reduce(DataFrame.unionByName, [sums, *kinds, zero]).groupBy("counter").agg(F.sum("n").alias("n"))
    held = lambda of: F.coalesce(F.sum(F.when(F.col("counter").isin(*of), F.col("n"))), F.lit(0))
    whole = plain.agg(held(MEMBERSHIP).alias("m"), held((*MEMBERSHIP, *STRUCTURE)).alias("s"), held(("unresolved_errors",)).alias("u"))
    ok = (F.col("s") == 0) & (F.lit(not fail_on_unresolved) | (F.col("u") == 0))
    last = whole.select(F.explode(F.array(*(F.struct(F.lit(c).alias("counter"), v.cast("long").alias("n")) for c, v in (("membership_mismatches", F.col("m")), ("structural_failures", F.col("s")), ("ok", ok.cast("long")))))).alias("x")).select("x.*")
    return Audit(plain.unionByName(last), issues)
