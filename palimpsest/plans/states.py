"""Registered queries of ledgers and runs: merges, reconciliations, selections, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.operators import graph, ledger, sequences
from palimpsest.plans.documents import query


@query("""WITH o AS (SELECT o_custkey AS kind, o_orderpriority AS url, o_orderstatus AS sha, min(o_orderkey) AS doc FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY ALL),
n AS (SELECT o_custkey AS kind, o_orderpriority AS url, o_orderstatus AS sha, arg_max(CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END, o_orderkey) FILTER (true) AS doc0, max(o_orderkey) AS seq FROM orders WHERE o_orderkey % 4 <> 0 GROUP BY ALL),
m AS (SELECT kind, url, sha, CASE WHEN seq % 2 = 0 THEN seq END AS doc FROM n)
SELECT coalesce(m.kind, o.kind) AS kind, coalesce(m.url, o.url) AS url, coalesce(m.sha, o.sha) AS sha, coalesce(m.doc, o.doc) AS doc,
CASE WHEN o.kind IS NULL THEN 'inserted' WHEN m.kind IS NOT NULL THEN 'updated' ELSE 'kept' END AS state FROM o FULL JOIN m ON o.kind = m.kind AND o.url = m.url AND o.sha = m.sha""")
def snapshot_upsert(t) -> DataFrame:
    """Snapshots by a key of three parts; a document once known stays known; of several new rows of a key the last counts."""
    key = [F.col("o_custkey").alias("kind"), F.col("o_orderpriority").alias("url"), F.col("o_orderstatus").alias("sha")]
    old = t("orders").where("o_orderkey % 3 <> 0").groupBy(*key).agg(F.min("o_orderkey").alias("doc"))
    new = t("orders").where("o_orderkey % 4 <> 0").select(*key, F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")).alias("doc"), F.col("o_orderkey").alias("seq"))
    return ledger.keyed_merge(old, new, ["kind", "url", "sha"], ["doc"], [], "seq")


@query("""WITH o AS (SELECT c_custkey AS k, c_name AS title, c_mktsegment AS kind, [c_mktsegment] AS ids FROM customer WHERE c_custkey % 5 <> 0),
n AS (SELECT o_custkey AS k, arg_max(CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderpriority END, o_orderkey) AS title, arg_max(o_orderstatus, o_orderkey) AS kind, arg_max([o_orderstatus, o_orderpriority], o_orderkey) AS ids FROM orders GROUP BY 1)
SELECT coalesce(n.k, o.k) AS k, coalesce(nullif(n.title, ''), o.title) AS title, CASE WHEN n.k IS NOT NULL THEN n.kind ELSE o.kind END AS kind,
array_to_string(list_sort(list_distinct(list_concat(coalesce(o.ids, []), coalesce(n.ids, [])))), ',') AS ids FROM o FULL JOIN n ON o.k = n.k""")
def detail_apply(t) -> DataFrame:
    """Details over known rows: blank titles keep the old one, kinds are overwritten, identifiers are joined."""
    old = t("customer").where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("kind"), F.array("c_mktsegment").alias("ids"))
    title = F.when(F.col("o_orderkey") % 2 == 0, "").otherwise(F.col("o_orderpriority"))
    new = t("orders").select(F.col("o_custkey").alias("k"), title.alias("title"), F.col("o_orderstatus").alias("kind"), F.array("o_orderstatus", "o_orderpriority").alias("ids"), F.col("o_orderkey").alias("seq"))
    out = ledger.keyed_merge(old, new, ["k"], ["title"], ["kind"], "seq", ("ids",))
    return out.select("k", "title", "kind", F.array_join("ids", ",").alias("ids"))


@query("""WITH b AS (SELECT o_custkey AS d, o_orderpriority AS s, max(o_orderkey) AS seq FROM orders GROUP BY ALL)
SELECT d AS document_id, s AS sha256, seq AS downloaded_at, row_number() OVER (PARTITION BY d ORDER BY seq DESC, s) = 1 AS is_current FROM b""")
def file_versions(t) -> DataFrame:
    """One row per document and content, however often it came; the last that came is current."""
    rows = t("orders").select(F.col("o_custkey").alias("document_id"), F.col("o_orderpriority").alias("sha256"), F.col("o_orderkey").alias("downloaded_at"))
    return ledger.version_flip(rows.where("downloaded_at % 2 = 0"), rows.where("downloaded_at % 2 = 1"))


_EDGES = """p AS (SELECT DISTINCT l_orderkey AS parent, l_partkey AS child FROM lineitem WHERE l_linenumber < 4),
n AS (SELECT DISTINCT l_orderkey AS parent, l_partkey AS child FROM lineitem WHERE l_linenumber > 1 AND l_orderkey % 3 <> 0), w AS (SELECT DISTINCT l_orderkey AS parent, l_orderkey % 2 = 0 AS complete FROM lineitem WHERE l_orderkey % 3 <> 0),
j AS (SELECT coalesce(p.parent, n.parent) AS parent, coalesce(p.child, n.child) AS child, p.parent IS NULL AS no_p, n.parent IS NULL AS no_n FROM p FULL JOIN n ON p.parent = n.parent AND p.child = n.child),
e AS (SELECT j.parent, child, CASE WHEN no_p THEN 'added' WHEN NOT no_n OR NOT coalesce(complete, false) THEN 'kept' ELSE 'removed' END AS state FROM j LEFT JOIN w ON j.parent = w.parent)"""


def _edges(t) -> DataFrame:
    rows = t("lineitem").select(F.col("l_orderkey").alias("parent"), F.col("l_partkey").alias("child"), "l_linenumber")
    observed = rows.where("parent % 3 <> 0").groupBy("parent").agg(F.collect_set(F.when(F.col("l_linenumber") > 1, F.col("child"))).alias("children"), (F.first("parent") % 2 == 0).alias("complete"))
    return ledger.memberships(rows.where("l_linenumber < 4"), observed)


@query(f"WITH {_EDGES} SELECT * FROM e")
def container_members(t) -> DataFrame:
    """Members of containers after an observation: replaced where it is complete, joined where it isn't."""
    return _edges(t)


@query(f"WITH {_EDGES} SELECT child, string_agg(CAST(parent AS VARCHAR), ',' ORDER BY parent) AS parents FROM e WHERE state <> 'removed' GROUP BY 1")
def member_backlinks(t) -> DataFrame:
    return ledger.backlink_lists(_edges(t)).select("child", F.array_join(F.col("parents").cast("array<string>"), ",").alias("parents"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '1%' OR o_orderpriority LIKE '5%' THEN 'FAILED' WHEN o_orderstatus <> 'P' AND (o_orderkey % 2 = 0 OR o_orderkey % 3 = 0) THEN 'SUCCEEDED' ELSE 'PARTIAL' END AS status,
CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 5 < 3 THEN 'FAILED_RETRYABLE' ELSE 'FAILED_FINAL' END AS after_failure FROM orders""")
def status_finalization(t) -> DataFrame:
    """The status of a row by its parts, of which some aren't required; and what a failed attempt leaves."""
    pri = F.col("o_orderpriority")
    rows = t("orders").select(
        "o_orderkey", "o_orderstatus", F.when(pri.startswith("5") | ((F.col("o_orderstatus") == "F") & pri.startswith("1")), "FAILED").when(F.col("o_orderstatus") != "P", "SUCCEEDED").otherwise("PENDING").alias("base"),
        F.when(F.col("o_orderkey") % 3 != 0, F.when(F.col("o_orderkey") % 2 == 0, "SUCCEEDED").otherwise("RUNNING")).alias("detail"),
    )
    left = ledger.after_failure((F.col("o_orderkey") % 5).cast("int"), F.col("o_orderstatus") != "P", 3)
    return rows.select("o_orderkey", ledger.finalized(rows, "base", "detail").alias("status"), left.alias("after_failure"))


@query("""WITH a AS (SELECT o_orderkey AS document_id, 'f/' || o_orderkey AS path, o_orderstatus AS sha256, o_custkey AS size FROM orders WHERE o_orderkey % 5 <> 0),
b AS (SELECT o_orderkey AS document_id, 'g/' || o_orderkey AS path, CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE o_orderstatus END AS sha256, o_custkey AS size FROM orders WHERE o_orderkey % 7 <> 0)
SELECT coalesce(a.document_id, b.document_id) AS document_id, coalesce(b.path, a.path) AS path, CASE WHEN a.path IS NULL THEN 'adopt' WHEN b.path IS NULL THEN 'missing' WHEN a.sha256 = b.sha256 AND a.size = b.size THEN 'valid' ELSE 'invalid' END AS state
FROM a FULL JOIN b ON a.document_id = b.document_id""")
def file_reconciliation(t) -> DataFrame:
    cols = lambda p, sha: [F.col("o_orderkey").alias("document_id"), F.concat(F.lit(p), F.col("o_orderkey").cast("string")).alias("path"), sha.alias("sha256"), F.col("o_custkey").alias("size")]
    a = t("orders").where("o_orderkey % 5 <> 0").select(*cols("f/", F.col("o_orderstatus")))
    b = t("orders").where("o_orderkey % 7 <> 0").select(*cols("g/", F.when(F.col("o_orderkey") % 3 == 0, "x").otherwise(F.col("o_orderstatus"))))
    return ledger.reconciled_files(a, b)


@query("""WITH m AS (SELECT max(ts) AS now FROM events), e AS (SELECT user_id, event_id, ts, CASE WHEN event_id % 11 = 0 THEN 'error' ELSE 'beat' END AS kind, CASE WHEN event_id % 7 = 0 THEN 'SUCCEEDED' WHEN event_id % 7 = 1 THEN 'RUNNING' END AS status, CASE WHEN event_id % 2 = 0 THEN event_id END AS done FROM events)
SELECT user_id AS run_id, arg_max(status, CASE WHEN status IS NOT NULL THEN event_id END) AS status, max(done) AS done, min(ts) AS started_at, max(ts) AS heartbeat_at, count_if(kind = 'error') AS errors,
coalesce(arg_max(status, CASE WHEN status IS NOT NULL THEN event_id END), 'RUNNING') <> 'SUCCEEDED' AND epoch((SELECT now FROM m)) // 1 - epoch(max(ts)) // 1 > 120 AS stale FROM e GROUP BY 1""")
def run_states(t) -> DataFrame:
    """Latest state, errors and staleness of every run of an append-only log."""
    e = t("events")
    now = e.agg(F.max("ts").alias("now"))
    log = e.select(
        F.col("user_id").alias("run_id"), F.col("event_id").alias("seq"), F.col("ts").alias("at"), F.when(F.col("event_id") % 11 == 0, "error").otherwise("beat").alias("kind"), F.lit("scan").alias("stage"),
        F.when(F.col("event_id") % 7 == 0, "SUCCEEDED").when(F.col("event_id") % 7 == 1, "RUNNING").alias("status"), F.when(F.col("event_id") % 2 == 0, F.col("event_id")).alias("done"),
    )
    latest = now.first().now
    return ledger.run_states(log, F.lit(latest)).drop("stage")


@query("""SELECT user_id, count(*) AS done, round(count(*) / date_diff('second', min(ts), max(ts)) * 60, 6) AS per_minute, round((200 - count(*)) / (count(*) / date_diff('second', min(ts), max(ts))), 2) AS seconds_left FROM events GROUP BY 1 HAVING date_diff('second', min(ts), max(ts)) > 0 AND count(*) <= 200""")
def run_progress(t) -> DataFrame:
    rows = t("events").groupBy("user_id").agg(F.count("*").alias("done"), (F.unix_timestamp(F.max("ts")) - F.unix_timestamp(F.min("ts"))).alias("seconds"))
    rate, left = ledger.progress(F.col("done"), F.lit(200), F.col("seconds"))
    return rows.where("seconds > 0 AND done <= 200").select("user_id", "done", F.round(rate, 6).alias("per_minute"), F.round(left, 2).alias("seconds_left"))


@query("""SELECT o_orderkey AS document_id, 'u' || o_orderkey AS url FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 4 <> 0 AND o_orderpriority NOT LIKE '1%' AND NOT o_orderpriority LIKE '2%'""")
def download_candidates(t) -> DataFrame:
    """Files that may be fetched: with an address, no web page, neither done nor given up."""
    pri = F.col("o_orderpriority")
    rows = t("orders").select(
        F.col("o_orderkey").cast("string").alias("document_id"), (F.col("o_orderstatus") != "P").alias("is_file"), F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("u"), F.col("o_orderkey").cast("string"))).alias("url"),
        F.when(pri.startswith("1"), "SUCCEEDED").alias("status"), pri.startswith("2").alias("html"),
    )
    return ledger.download_candidates(rows).select(F.col("document_id").cast("long").alias("document_id"), "url")


@query("""SELECT o_orderkey, o_orderstatus <> 'P' AND o_orderdate >= TIMESTAMP '1997-06-01' - INTERVAL 30 DAY AS fresh, o_orderkey % 3 < 2 AND o_orderstatus <> 'O' AS retry, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 3 END, o_orderkey) AS position FROM orders""")
def work_selection(t) -> DataFrame:
    """What is fresh, what may be tried again, and the order of the queue by priority."""
    now = F.lit("1997-06-01 00:00:00").cast("timestamp")
    status = F.when(F.col("o_orderstatus") != "P", "SUCCEEDED").otherwise("FAILED")
    retry = ledger.may_retry((F.col("o_orderkey") % 3).cast("int"), F.col("o_orderstatus") == "O", F.lit(None).cast("boolean"), 2)
    priority = F.when(F.col("o_orderstatus") == "F", "HIGH").when(F.col("o_orderstatus") == "O", "NORMAL").otherwise("other")
    at = F.row_number().over(Window.partitionBy("o_custkey").orderBy(ledger.priority_order(priority), "o_orderkey"))
    return t("orders").select("o_orderkey", ledger.is_fresh(status, F.col("o_orderdate"), now, 30).alias("fresh"), retry.alias("retry"), at.alias("position"))


@query("""WITH f AS (SELECT o_orderkey AS document_id, upper(o_orderpriority) AS sha, min(o_orderkey * 10) AS file_id FROM orders WHERE o_orderkey % 4 <> 0 GROUP BY ALL)
SELECT m.o_orderkey AS document_id, file_id FROM orders m LEFT JOIN f ON f.document_id = m.o_orderkey AND sha = upper(CASE WHEN m.o_orderkey % 3 = 0 THEN 'other' ELSE lower(m.o_orderpriority) END)""")
def manifest_matches(t) -> DataFrame:
    files = t("orders").select(F.col("o_orderkey").alias("document_id"), F.upper("o_orderpriority").alias("sha256"), (F.col("o_orderkey") * 10).alias("file_id"), (F.col("o_orderkey") % 4 != 0).alias("is_current"))
    manifest = t("orders").select(F.col("o_orderkey").alias("document_id"), F.when(F.col("o_orderkey") % 3 == 0, "other").otherwise(F.lower("o_orderpriority")).alias("sha256"))
    return ledger.manifest_matches(manifest, files).select("document_id", "file_id")


@query("""SELECT p_partkey AS document_id, CASE WHEN p_size % 5 = 0 THEN 'schema' WHEN p_partkey % 4 = 0 THEN 'document' WHEN p_partkey % 3 = 0 THEN 'sha256' END AS reason,
array_to_string(list_filter([CASE WHEN p_partkey % 2 = 0 THEN 'title' END, CASE WHEN p_size > 25 THEN 'date' END], lambda x: x IS NOT NULL), ',') AS missing FROM part""")
def sidecar_gate(t) -> DataFrame:
    """Why a sidecar can't be trusted, and the facts it lacks."""
    p = t("part")
    side = p.select(
        F.col("p_partkey").alias("document_id"), F.when(F.col("p_size") % 5 == 0, 1).otherwise(2).alias("schema_version"), F.when(F.col("p_partkey") % 3 == 0, "x").otherwise(F.lower("p_brand")).alias("sha256"),
        F.when(F.col("p_partkey") % 2 == 0, " ").otherwise(F.col("p_name")).alias("title"), F.when(F.col("p_size") <= 25, F.col("p_type")).alias("date"),
    )
    files = p.where("p_partkey % 4 <> 0").select(F.col("p_partkey").alias("document_id"), F.col("p_brand").alias("sha256"))
    return ledger.sidecar_reasons(side, files, 2, ("title", "date")).withColumn("missing", F.array_join("missing", ","))


@query("""WITH m AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS title, CASE WHEN p_partkey % 3 = 0 THEN p_type END AS kind FROM part WHERE p_partkey % 5 <> 0), s AS (SELECT p_partkey AS k, upper(p_name) AS title, CASE WHEN p_partkey % 7 = 0 THEN p_brand END AS kind FROM part)
SELECT s.k, coalesce(m.title, s.title) AS title, coalesce(m.kind, s.kind) AS kind, CASE WHEN coalesce(m.kind, s.kind) IS NULL THEN 'B' ELSE 'A' END AS grade FROM s LEFT JOIN m ON s.k = m.k""")
def rebuilt_records(t) -> DataFrame:
    """Records put together from a manifest and, where it says nothing, from sidecars; graded by what is known."""
    p, k = t("part"), F.col("p_partkey")
    manifest = p.where("p_partkey % 5 <> 0").select(k.alias("k"), F.when(k % 2 == 0, F.col("p_name")).alias("title"), F.when(k % 3 == 0, F.col("p_type")).alias("kind"))
    sidecars = p.select(k.alias("k"), F.upper("p_name").alias("title"), F.when(k % 7 == 0, F.col("p_brand")).alias("kind"))
    return ledger.precedence_merge("k", ["title", "kind"], manifest, sidecars)


@query("""WITH m AS (SELECT l_orderkey AS k, list_sort(list_distinct(list(l_returnflag))) AS missing, list_distinct(list(CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag END) FILTER (l_linenumber % 2 = 0)) AS found FROM lineitem GROUP BY 1)
SELECT k, array_to_string(list_filter(missing, lambda x: NOT list_contains(coalesce(found, []), x)), ',') AS left_over, CASE WHEN len(list_filter(missing, lambda x: NOT list_contains(coalesce(found, []), x))) = 0 THEN 'DONE' WHEN len(coalesce(found, [])) > 0 THEN 'PARTIAL' ELSE 'PENDING' END AS state FROM m""")
def recovery_progress(t) -> DataFrame:
    """Missing facts less those that a fetch found, and the task's state."""
    m = t("lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.array_sort(F.collect_set("l_returnflag")).alias("missing"), F.collect_set(F.when(F.col("l_linenumber") % 2 == 0, F.col("l_returnflag"))).alias("found"))
    left, state = ledger.recovery_tasks(F.col("missing"), F.col("found"))
    return m.select("k", F.array_join(left, ",").alias("left_over"), state.alias("state"))


@query("""WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus <> 'P'), b AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 <> 0), m AS (SELECT k FROM a EXCEPT SELECT k FROM b), x AS (SELECT k FROM b EXCEPT SELECT k FROM a)
SELECT 'missing' AS side, (SELECT count(*) FROM m) AS n, coalesce((SELECT string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) FROM (SELECT k FROM m ORDER BY k LIMIT 20)), '') AS examples UNION ALL SELECT 'extra', (SELECT count(*) FROM x), coalesce((SELECT string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) FROM (SELECT k FROM x ORDER BY k LIMIT 20)), '')""")
def identity_differences(t) -> DataFrame:
    """Keys of one side only, counted, with the first twenty as examples."""
    a, b = t("orders").where("o_orderstatus <> 'P'").select(F.col("o_custkey").alias("k")), t("customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k"))
    return ledger.difference_counts(a, b, "k").withColumn("examples", F.array_join(F.col("examples").cast("array<string>"), ","))


@query("""SELECT o_custkey, strftime(min(d), '%Y-%m-%d') AS start_day, strftime(max(d), '%Y-%m-%d') AS end_day FROM (SELECT *, d - CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY d) AS INTEGER) AS g FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority NOT LIKE '1%' AND o_orderkey % 6 <> 0)) GROUP BY o_custkey, g""")
def qualified_coverage(t) -> DataFrame:
    """Intervals that runs prove: succeeded, complete, without failed pages, audited, not upside down; then merged."""
    day = F.to_date("o_orderdate")
    runs = t("orders").select(
        "o_custkey", F.when(F.col("o_orderstatus") == "F", "SUCCEEDED").otherwise("PARTIAL").alias("status"), F.lit(None).cast("boolean").alias("dry_run"), (~F.col("o_orderpriority").startswith("1")).alias("base_complete"),
        F.lit(0).alias("failed_pages"), F.lit(True).alias("audit_ok"), day.alias("start_day"), F.when(F.col("o_orderkey") % 6 == 0, F.date_sub(day, 1)).otherwise(day).alias("end_day"),
    )
    out = sequences.merge_intervals(ledger.qualified_runs(runs), "o_custkey", "start_day", "end_day")
    return out.select("o_custkey", F.date_format("start_day", "yyyy-MM-dd").alias("start_day"), F.date_format("end_day", "yyyy-MM-dd").alias("end_day"))


@query("""SELECT o_custkey, strftime(CASE WHEN max(CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END) IS NULL OR count(*) % 3 = 0 THEN DATE '1998-01-01' ELSE least(greatest(DATE '1998-01-01', CAST(max(o_orderdate) AS DATE) - 7), DATE '1998-06-30') END, '%Y-%m-%d') AS start_day,
CASE WHEN max(CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END) IS NULL THEN 'bootstrap' WHEN count(*) % 3 = 0 THEN 'refresh' ELSE 'overlap' END AS mode FROM orders GROUP BY 1""")
def scan_ranges(t) -> DataFrame:
    """The next scan of every customer: all of the year, or a week before the newest row."""
    rows = t("orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("newest"), F.count("*").alias("n"), F.max(F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey"))).alias("known"))
    today = F.lit("1998-06-30").cast("date")
    newest = F.when(F.col("known").isNotNull(), F.to_date("newest"))
    full = F.when(F.col("n") % 3 != 0, F.date_sub(today, 5))
    start, mode = ledger.date_range(newest, today, full)
    return rows.select("o_custkey", F.date_format(start, "yyyy-MM-dd").alias("start_day"), mode.alias("mode"))


@query("""WITH e AS (SELECT 'n' || n_nationkey AS p, 'c' || c_custkey AS c FROM nation JOIN customer ON c_nationkey = n_nationkey UNION ALL SELECT 'c' || o_custkey, 'o' || o_orderkey FROM orders),
r AS (SELECT 'n' || n_nationkey AS id, 0 AS depth FROM nation WHERE n_regionkey = 1), a AS (SELECT DISTINCT c AS id, 1 AS depth FROM e JOIN r ON p = r.id), b AS (SELECT DISTINCT c AS id, 2 AS depth FROM e JOIN a ON p = a.id), x AS (SELECT * FROM r UNION ALL SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT id, depth, row_number() OVER (ORDER BY depth, id) <= 100 AS kept FROM x""")
def container_contents(t) -> DataFrame:
    """All that is held by the nations of a region, breadth first; what lies past the limit is told apart."""
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    edges = t("customer").select(name("n", "c_nationkey").alias("parent"), name("c", "c_custkey").alias("child")).union(t("orders").select(name("c", "o_custkey"), name("o", "o_orderkey")))
    seeds = t("nation").where("n_regionkey = 1").select(name("n", "n_nationkey").alias("id"))
    return graph.contained_items(edges, seeds, depth=20, most=100)[0]


@query("""SELECT 'orders' AS counter, count(*) AS n FROM orders UNION ALL SELECT 'undated', count_if(o_orderdate IS NULL) FROM orders UNION ALL SELECT 'without_lines', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT 'lines_without_order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'lines_without_part', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part) UNION ALL SELECT 'negative', count_if(o_totalprice < 0) FROM orders""")
def ledger_audit(t) -> DataFrame:
    """Counters of an audit: what is there, what is undated, what leads nowhere on either side."""
    o, lines, p = t("orders"), t("lineitem"), t("part")
    one = lambda name, rows: rows.agg(F.lit(name).alias("counter"), F.count("*").alias("n"))
    parts = [
        one("orders", o), one("undated", o.where("o_orderdate IS NULL")), one("without_lines", o.join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")),
        one("lines_without_order", lines.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")), one("lines_without_part", lines.join(p, F.col("l_partkey") == F.col("p_partkey"), "left_anti")), one("negative", o.where("o_totalprice < 0")),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@query("SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS order_day, 'unknown' AS origin, CAST(NULL AS BIGINT) AS size FROM orders")
def migrated_rows(t) -> DataFrame:
    """Rows of an older shape in a newer one: what it adds is null or a default."""
    from pyspark.sql.types import StructType

    rows = t("orders").select("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"))
    return ledger.with_columns_of(rows, StructType.fromDDL("o_orderkey long, o_orderstatus string, order_day string, origin string, size long"), {"origin": "unknown"})


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def documents_with_success(t) -> DataFrame:
    done = t("orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return t("customer").join(done, "c_custkey", "left_semi").select("c_custkey")


