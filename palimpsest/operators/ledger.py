"""Ledger operators: upserts, current versions, differences, audits, selections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_of(rows: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """One row a key: the last in ``order``, or by all its columns where no order is told."""
    rest = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*rest), order) if order else F.max(F.struct(*rest))
    return rows.groupBy(*keys).agg(best.alias("r")).select(*keys, *(F.col(f"r.{c}").alias(c) for c in rest))


def keyed_merge(old: DataFrame, new: DataFrame, keys: list[str], soft: list[str], hard: list[str], order: str | None = None, unions: tuple[str, ...] = ()) -> DataFrame:
    """Full outer merge on ``keys`` of the last new row of each key.

    Soft fields keep the old value where the new one is null or blank, hard fields take the new one, and
    arrays of ``unions`` are joined and sorted.  ``state`` tells inserted, updated and kept rows apart.
    """
    o, n = old.withColumn("_o", F.lit(True)).alias("o"), last_of(new, keys, order).withColumn("_n", F.lit(True)).alias("n")
    on = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    joined = o.join(n, on, "full_outer")
    kinds = dict(new.dtypes)
    told = lambda c: F.nullif(F.col(f"n.{c}"), F.lit("")) if kinds[c] == "string" else F.col(f"n.{c}")
    there = F.col("_n").isNotNull()
    empty = lambda c: F.coalesce(c, F.array())
    picked = [F.coalesce(F.col(f"n.{k}"), F.col(f"o.{k}")).alias(k) for k in keys]
    picked += [F.coalesce(told(c), F.col(f"o.{c}")).alias(c) for c in soft]
    picked += [F.when(there, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in hard]
    picked += [F.array_sort(F.array_union(empty(F.col(f"o.{c}")), empty(F.col(f"n.{c}")))).alias(c) for c in unions]
    state = F.when(F.col("_o").isNull(), "inserted").when(there, "updated").otherwise("kept")
    return joined.select(*picked, state.alias("state"))


def upsert(old: DataFrame, new: DataFrame, key: str, soft: list[str], hard: list[str], order: str | None = None) -> DataFrame:
    """``keyed_merge`` on one key."""
    return keyed_merge(old, new, [key], soft, hard, order)


def current_version(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Add ``is_current``: true for the row of each key that comes first in ``order``."""
    return rows.withColumn("is_current", F.row_number().over(Window.partitionBy(key).orderBy(*order)) == 1)


def differences(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, status, fields): missing, extra or changed with the fields that differ (nulls are equal)."""
    a, b = left.alias("a"), right.alias("b")
    joined = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    changed = F.array_compact(F.array(*(F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in fields)))
    status = F.when(F.col(f"b.{key}").isNull(), "missing").when(F.col(f"a.{key}").isNull(), "extra").when(F.size(changed) > 0, "changed").otherwise("equal")
    out = joined.select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), status.alias("status"), F.array_join(changed, ",").alias("fields"))
    return out.withColumn("fields", F.when(F.col("status") == "changed", F.col("fields")).otherwise(""))


def backlinks(parents: DataFrame, children: DataFrame) -> DataFrame:
    """(counter, n) over edges (parent, child) as each side tells them: both, only parents', only children'."""
    p, c = parents.distinct().withColumn("in_p", F.lit(1)), children.distinct().withColumn("in_c", F.lit(1))
    both = p.join(c, ["parent", "child"], "full_outer")
    kind = F.when(F.col("in_c").isNull(), "parent_only").when(F.col("in_p").isNull(), "child_only").otherwise("agreed")
    return both.groupBy(kind.alias("counter")).agg(F.count("*").alias("n"))


def pending(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys aren't in ``done`` yet."""
    return rows.join(done.select(*keys).distinct(), keys, "left_anti")


def cache_split(wanted: DataFrame, cached: DataFrame, key: str) -> DataFrame:
    """Add ``hit``: whether the key is cached."""
    seen = cached.select(key).distinct().withColumn("_hit", F.lit(True))
    return wanted.join(seen, key, "left").withColumn("hit", F.coalesce("_hit", F.lit(False))).drop("_hit")


def merge_members(previous: Column, observed: Column, complete: Column) -> tuple[Column, Column]:
    """(effective, removed): the observed members if they are complete, else the union with the previous ones."""
    effective = F.array_sort(F.when(complete, F.array_distinct(observed)).otherwise(F.array_union(previous, observed)))
    return effective, F.array_sort(F.array_except(previous, effective))


def statuses(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


def final_status(complete: list[Column], errors: Column, audit_ok: Column) -> Column:
    """SUCCEEDED only if every part is complete, nothing failed and the audit agrees; PARTIAL else."""
    good = audit_ok & (errors == 0)
    for c in complete:
        good = good & c
    return F.when(good, "SUCCEEDED").otherwise("PARTIAL")


def version_flip(files: DataFrame, arrived: DataFrame) -> DataFrame:
    """(document_id, sha256, downloaded_at, is_current): one row per document and content; of each document the last arrival is current."""
    both = files.select("document_id", "sha256", "downloaded_at").unionByName(arrived.select("document_id", "sha256", "downloaded_at"))
    versions = both.groupBy("document_id", "sha256").agg(F.max("downloaded_at").alias("downloaded_at"))
    return current_version(versions, "document_id", [F.desc("downloaded_at"), F.col("sha256")])


def memberships(previous: DataFrame, observed: DataFrame) -> DataFrame:
    """(parent, child, state) of edges: observed ones, and previous ones of parents whose observation isn't complete.

    ``observed`` has complete per parent; a parent that wasn't observed keeps all it had.  State is added, kept or
    removed, so both sides' lists come from one table.
    """
    seen = observed.select("parent", F.explode_outer("children").alias("child"), "complete")
    whole = observed.select("parent", "complete")
    new = seen.where("child IS NOT NULL").select("parent", "child").distinct().withColumn("_n", F.lit(True))
    both = previous.select("parent", "child").distinct().withColumn("_p", F.lit(True)).join(new, ["parent", "child"], "full_outer").join(whole, "parent", "left")
    state = F.when(F.col("_p").isNull(), "added").when(F.col("_n").isNotNull() | ~F.coalesce("complete", F.lit(False)), "kept").otherwise("removed")
    return both.select("parent", "child", state.alias("state"))


def backlink_lists(edges: DataFrame) -> DataFrame:
    """(child, parents): for each child the sorted parents of its edges that aren't removed."""
    return edges.where("state <> 'removed'").groupBy("child").agg(F.array_sort(F.collect_set("parent")).alias("parents"))


def finalized(rows: DataFrame, *parts: str) -> Column:
    """SUCCEEDED if every part is complete, FAILED if one failed, PARTIAL else; null parts aren't required."""
    cols = [F.col(p) for p in parts]
    failed, done = F.lit(False), F.lit(True)
    for c in cols:
        failed, done = failed | F.coalesce(c == "FAILED", F.lit(False)), done & F.coalesce(c == "SUCCEEDED", F.lit(True))
    return F.when(failed, "FAILED").when(done, "SUCCEEDED").otherwise("PARTIAL")


def after_failure(attempts: Column, retryable: Column, most: int) -> Column:
    """What a failed attempt leaves: retried while it may be and attempts are left."""
    return F.when(retryable & (attempts < most), "FAILED_RETRYABLE").otherwise("FAILED_FINAL")


def reconciled_files(ledger_: DataFrame, listing: DataFrame) -> DataFrame:
    """(document_id, path, state): ledger rows (document_id, path, sha256, size) against files (document_id, path, sha256, size).

    valid: recorded and the same; invalid: recorded, but another content; missing: recorded, no file; adopt: a file that isn't recorded.
    """
    a, b = ledger_.alias("a"), listing.alias("b")
    joined = a.join(b, F.col("a.document_id") == F.col("b.document_id"), "full_outer")
    same = F.col("a.sha256").eqNullSafe(F.col("b.sha256")) & F.col("a.size").eqNullSafe(F.col("b.size"))
    state = F.when(F.col("a.document_id").isNull(), "adopt").when(F.col("b.document_id").isNull(), "missing").when(same, "valid").otherwise("invalid")
    return joined.select(F.coalesce("a.document_id", "b.document_id").alias("document_id"), F.coalesce("b.path", "a.path").alias("path"), state.alias("state"))


def run_states(log: DataFrame, now: Column, stale_after: int = 120) -> DataFrame:
    """(run_id, stage, status, started_at, heartbeat_at, done, errors, stale) of an append-only log (run_id, seq, at, kind, stage, status, done).

    The last told status and counter count; a run without an end is stale once its heartbeat is older than ``stale_after`` seconds,
    fractions of a second included.
    """
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c)
    out = log.groupBy("run_id").agg(F.min_by("stage", "seq").alias("stage"), last("status"), last("done"), F.min("at").alias("started_at"), F.max("at").alias("heartbeat_at"), F.count_if(F.col("kind") == "error").alias("errors"))
    open_ = ~F.coalesce(F.col("status"), F.lit("RUNNING")).isin("SUCCEEDED", "PARTIAL", "FAILED")
    seconds = lambda at: F.unix_micros(at.cast("timestamp")) / 1e6
    return out.withColumn("stale", open_ & (seconds(now) - seconds(F.col("heartbeat_at")) > stale_after))


def progress(done: Column, total: Column, seconds: Column) -> tuple[Column, Column]:
    """(rate per minute, seconds left); nulls where nothing is done or known."""
    rate = F.when((done > 0) & (seconds > 0), done / seconds)
    return rate * 60, F.when(total >= done, (total - done) / rate)


def download_candidates(rows: DataFrame, *, forced: bool = False, limit: int | None = None) -> DataFrame:
    """Rows (document_id, is_file, url, status, html) that may be downloaded, by natural id; ``limit`` counts only those."""
    from palimpsest.functions.text import natural_order

    usable = F.col("is_file") & (F.trim(F.coalesce("url", F.lit(""))) != "") & ~F.col("html")
    left = F.lit(True) if forced else ~F.coalesce("status", F.lit("")).isin("SUCCEEDED", "FAILED_FINAL", "NOT_APPLICABLE")
    out = rows.where(usable & left)
    order = natural_order(F.col("document_id"))
    return out.orderBy(*order).limit(limit) if limit else out


def is_fresh(status: Column, at: Column, now: Column, days: int) -> Column:
    return F.coalesce((status == "SUCCEEDED") & (F.unix_timestamp(now) - F.unix_timestamp(at) <= days * 86_400), F.lit(False))


def may_retry(attempts: Column, done: Column, quarantined: Column, most: int) -> Column:
    return ~F.coalesce(done, F.lit(False)) & ~F.coalesce(quarantined, F.lit(False)) & (F.coalesce(attempts, F.lit(0)) < most)


# Fixed value: the order of priorities.
PRIORITIES = ("HIGH", "NORMAL", "LOW")


def priority_order(col: Column) -> Column:
    return F.coalesce(*(F.when(col == p, k) for k, p in enumerate(PRIORITIES)), F.lit(len(PRIORITIES)))


def manifest_matches(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Add file_id to manifest rows (document_id, sha256): the current file of the document with that content, in any case of letters; null is unmatched."""
    known = files.where("is_current").select("document_id", F.lower("sha256").alias("_sha"), "file_id").dropDuplicates(["document_id", "_sha"])
    return manifest.withColumn("_sha", F.lower("sha256")).join(known, ["document_id", "_sha"], "left").drop("_sha")


def sidecar_reasons(sidecars: DataFrame, files: DataFrame, version: int, facts: tuple[str, ...]) -> DataFrame:
    """(document_id, reason, missing): why a sidecar (document_id, schema_version, sha256, facts...) can't be trusted, null if it can; and the facts it lacks."""
    joined = sidecars.alias("s").join(files.select("document_id", F.col("sha256").alias("_f")), "document_id", "left")
    reason = F.when(F.col("schema_version") != version, "schema").when(F.col("_f").isNull(), "document").when(F.lower("sha256") != F.lower("_f"), "sha256")
    missing = F.array_compact(F.array(*(F.when(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == "", F.lit(c)) for c in facts)))
    return joined.select("document_id", reason.alias("reason"), missing.alias("missing"))


def precedence_merge(key: str, fields: list[str], *sources: DataFrame) -> DataFrame:
    """(key, fields, grade): of every field the first source that says something; the grade is A if all do, B if some, C if none."""
    every = None
    for rank, rows in enumerate(sources):
        own = rows.select(key, *(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).alias(c) for c in fields), F.lit(rank).alias("_r"))
        every = own if every is None else every.unionByName(own)
    merged = every.groupBy(key).agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_r"))).alias(c) for c in fields))
    told = F.size(F.array_compact(F.array(*fields)))
    return merged.withColumn("grade", F.when(told == len(fields), "A").when(told > 0, "B").otherwise("C"))


def recovery_tasks(missing: Column, found: Column) -> tuple[Column, Column]:
    """(still missing, state) of a task after a fetch that found some facts."""
    left = F.array_except(missing, found)
    return left, F.when(F.size(left) == 0, "DONE").when(F.size(F.array_intersect(missing, found)) > 0, "PARTIAL").otherwise("PENDING")


def difference_counts(left: DataFrame, right: DataFrame, key: str, examples: int = 20) -> DataFrame:
    """(side, n, examples): keys of one side only, with the first ``examples`` of them."""
    out = None
    for name, a, b in (("missing", left, right), ("extra", right, left)):
        only = a.select(key).distinct().join(b.select(key).distinct(), key, "left_anti")
        first = only.orderBy(key).limit(examples).agg(F.array_sort(F.collect_list(key)).alias("examples"))  # at most ``examples``
        own = only.agg(F.count("*").alias("n")).crossJoin(first).select(F.lit(name).alias("side"), "n", "examples")  # one row each
        out = own if out is None else out.unionByName(own)
    return out


def with_columns_of(rows: DataFrame, schema, defaults: dict | None = None) -> DataFrame:
    """``rows`` in the shape of ``schema``: columns it lacks are null or a default, others are cast."""
    have, defaults = set(rows.columns), defaults or {}
    return rows.select(*((F.col(f.name) if f.name in have else F.lit(defaults.get(f.name))).cast(f.dataType).alias(f.name) for f in schema.fields))


def schema_problems(rows: DataFrame, schema) -> list[str]:
    """What ``rows`` lack of ``schema``, and what is of another type; further columns are allowed."""
    have = {f.name: f.dataType for f in rows.schema.fields}
    return [f"missing {f.name}" if f.name not in have else f"{f.name} is {have[f.name].simpleString()}" for f in schema.fields if have.get(f.name) != f.dataType]


def qualified_runs(runs: DataFrame) -> DataFrame:
    """Runs (status, dry_run, base_complete, failed_pages, audit_ok, start_day, end_day) that prove their interval."""
    good = (F.col("status") == "SUCCEEDED") & ~F.coalesce("dry_run", F.lit(False)) & F.col("base_complete") & (F.col("failed_pages") == 0) & F.col("audit_ok")
    return runs.where(good & (F.col("start_day") <= F.col("end_day")))


def date_range(newest: Column, today: Column, last_full: Column, *, refresh_days: int = 30, overlap_days: int = 7) -> tuple[Column, Column]:
    """(start, mode) of the next scan: the year's first day without rows or a full scan in ``refresh_days``, else a week before the newest row."""
    year = F.trunc(today, "year")
    full = last_full.isNull() | (F.datediff(today, last_full) >= refresh_days)
    start = F.when(newest.isNull() | full, year).otherwise(F.least(F.greatest(year, F.date_sub(newest, overlap_days)), today))
    mode = F.when(newest.isNull(), "bootstrap").when(full, "refresh").otherwise("overlap")
    return start, mode


def facet_labels(memberships_: DataFrame, base: DataFrame) -> DataFrame:
    """(document_id, facet, labels): the sorted labels of memberships (document_id, facet, label) of documents that are in ``base``; null or blank labels are none."""
    told = memberships_.where("trim(coalesce(label, '')) <> ''").join(base.select("document_id").distinct(), "document_id", "left_semi")
    return told.groupBy("document_id", "facet").agg(F.array_sort(F.collect_set("label")).alias("labels"))


#: What a finished normalization tells, gone again once it is started anew.
OUTPUTS = ("output_sha256", "pages", "chunks", "tables", "error_code")


def normalization_states(events: DataFrame) -> DataFrame:
    """(analysis_id, version, config_hash, status, started_at, finished_at, attempts, OUTPUTS): one row for each key of events (key, seq, at, status, OUTPUTS).

    A row of status RUNNING starts an attempt; any other ends the one that runs.  Outputs and the end's time are those of the
    last end, null while an attempt runs; an end before any start is left out, and so is a second end of one attempt.
    """
    key = ["analysis_id", "version", "config_hash"]
    begun = F.struct("seq", "at")
    starts = events.where("status = 'RUNNING'").groupBy(*key).agg(F.max(begun).alias("s"), F.count("*").alias("attempts"))
    ends = events.where("status <> 'RUNNING'").select(*key, "seq", "at", "status", *OUTPUTS).join(starts.select(*key, F.col("s.seq").alias("_from")), key).where("seq > _from")
    first = ends.groupBy(*key).agg(F.min(F.struct("seq", "at", "status", *OUTPUTS)).alias("e"))
    out = starts.join(first, key, "left")
    return out.select(*key, F.coalesce("e.status", F.lit("RUNNING")).alias("status"), F.col("s.at").alias("started_at"), F.col("e.at").alias("finished_at"), "attempts", *(F.col(f"e.{c}").alias(c) for c in OUTPUTS))
