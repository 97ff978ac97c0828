"""Registered queries of provenance: metadata, paths, hashes, logs, shelves, attempts, comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions import text as fn
from palimpsest.operators import ledger, provenance, search_documents
from palimpsest.plans.documents import _TOK, query, tokens


@query("""SELECT p_partkey, trim(p_brand) AS company, CASE WHEN p_partkey % 3 = 0 THEN 'en' WHEN p_partkey % 3 = 1 THEN 'fr' END AS language, CASE WHEN p_partkey % 2 = 0 THEN 'a,b' ELSE '' END AS document_types FROM part""")
def metadata_fields(t) -> DataFrame:
    """Fields of open JSON; a language that is a list counts by its first text, what doesn't read is empty."""
    k = F.col("p_partkey")
    language = F.when(k % 3 == 0, '["", "en", "de"]').when(k % 3 == 1, '"fr"').otherwise('" "')
    types = F.when(k % 2 == 0, '["b", "a", "", "b"]').otherwise("7")
    raw = F.concat(F.lit('{"company": " '), "p_brand", F.lit(' ", "language": '), language, F.lit(', "document_types": '), types, F.lit("}"))
    rows = t("part").select("p_partkey", provenance.metadata_projection(raw).alias("m"))
    return rows.select("p_partkey", "m.company", "m.language", F.array_join("m.document_types", ",").alias("document_types"))


@query("SELECT l_orderkey, l_linenumber, o_orderstatus, o_orderpriority FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderkey % 3 > 0")
def inherited_metadata(t) -> DataFrame:
    documents = t("orders").where("o_orderkey % 3 > 0").withColumnRenamed("o_orderkey", "l_orderkey")
    return provenance.inherited(t("lineitem").select("l_orderkey", "l_linenumber"), documents, "l_orderkey", ["o_orderstatus", "o_orderpriority"])


@query("""SELECT o_orderkey AS id, CASE WHEN o_custkey % 2 = 0 THEN 'a/' || o_custkey WHEN o_custkey % 3 = 0 THEN 'b/' || o_custkey END AS path FROM orders""")
def artifact_paths(t) -> DataFrame:
    """The first of a record's possible places that has a file."""
    at = lambda p: F.concat(F.lit(p), F.col("o_custkey").cast("string"))
    files = t("orders").select(F.when(F.col("o_custkey") % 2 == 0, at("a/")).alias("path")).union(t("orders").select(F.when(F.col("o_custkey") % 3 == 0, at("b/")))).where("path IS NOT NULL").union(t("orders").select(at("c/")).where("o_custkey < 0"))
    return provenance.resolved_paths(t("orders").select(F.col("o_orderkey").alias("id"), F.array(at("x/"), at("a/"), at("b/")).alias("candidates")), files)


@query("""SELECT conv_id, CAST(count(*) AS INTEGER) AS n, sha256(string_agg('{"role":' || CASE WHEN role IS NULL THEN 'null' ELSE '"' || role || '"' END || ',"turn":' || turn || '}', chr(10) ORDER BY turn)) AS sha256 FROM conversations GROUP BY 1""")
def result_hashes(t) -> DataFrame:
    """A digest of every document's records in order."""
    return provenance.result_hashes(t("conversations").select("conv_id", "turn", "role"), "conv_id", ["turn"])


@query("""SELECT event_type AS phase, arg_max(event_id % 50, event_id) AS done, arg_max(CASE WHEN event_id % 3 > 0 THEN 120 END, event_id) FILTER (true) AS total0, count(*) AS lines FROM events WHERE event_id % 4 > 0 GROUP BY 1""".replace("arg_max(CASE WHEN event_id % 3 > 0 THEN 120 END, event_id) FILTER (true) AS total0", "CASE WHEN max(event_id) % 3 > 0 THEN 120 END AS total"))
def log_progress(t) -> DataFrame:
    """The counters that each phase of a log told last."""
    k = F.col("event_id")
    told = F.concat(fn.counter((k % 50).cast("int"), F.when(k % 3 > 0, 120)), F.lit(" "), "event_type", F.lit(" and more"))
    return provenance.phase_counters(t("events").select(k.alias("pos"), F.when(k % 4 > 0, told).otherwise("another line").alias("message")))


@query("""WITH a AS (SELECT user_id AS owner, event_id AS pos, CASE WHEN event_id % 5 = 0 THEN 'remove' ELSE 'add' END AS action, CAST(event_id % 13 AS VARCHAR) AS chunk_id FROM events), r AS (SELECT owner, chunk_id, max(pos) FILTER (action = 'remove') AS last FROM a GROUP BY ALL)
SELECT a.owner, a.chunk_id, min(pos) AS since FROM a JOIN r ON a.owner = r.owner AND a.chunk_id = r.chunk_id WHERE action = 'add' AND (last IS NULL OR pos > last) GROUP BY ALL""")
def evidence_shelf(t) -> DataFrame:
    """What lies on every user's shelf after all that was put there and taken away."""
    k = F.col("event_id")
    return provenance.shelf(t("events").select(F.col("user_id").alias("owner"), k.alias("pos"), F.when(k % 5 == 0, "remove").otherwise("add").alias("action"), (k % 13).cast("string").alias("chunk_id")))


@query("""WITH a AS (SELECT o_custkey AS d, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k, o_orderstatus = 'P' AS ok, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
SELECT d AS document_id, coalesce(min(CASE WHEN ok THEN k END), max(n)) AS attempts, CASE WHEN bool_or(ok) THEN 'DONE' WHEN max(n) >= 12 THEN 'QUARANTINED' ELSE 'OPEN' END AS state FROM a GROUP BY 1""")
def attempt_states(t) -> DataFrame:
    return provenance.attempt_states(t("orders").select(F.col("o_custkey").alias("document_id"), F.col("o_orderkey").alias("pos"), (F.col("o_orderstatus") == "P").alias("ok")), 12)


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'filter' WHEN o_orderkey % 2 = 0 THEN 'preview' ELSE 'shelf' END AS origin, CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 4 > 0 AND o_orderkey % 5 > 0 THEN 'SUCCEEDED' ELSE 'PARTIAL' END AS run_status FROM orders""")
def scope_precedence(t) -> DataFrame:
    """The scope that holds: filters, else what is shown, else the shelf; and a run's status by all its parts."""
    k = F.col("o_orderkey")
    scope = lambda name, there=None: F.when(there if there is not None else F.lit(True), F.struct(F.lit(name).alias("origin"), F.col("o_custkey").alias("document")))
    chosen = provenance.first_scope(scope("filter", k % 3 == 0), scope("preview", k % 2 == 0), scope("shelf"))
    status = ledger.final_status([F.col("o_orderstatus") != "P", k % 4 > 0], F.when(k % 5 == 0, 1).otherwise(0), F.lit(True))
    return t("orders").select("o_orderkey", chosen["origin"].alias("origin"), status.alias("run_status"))


@query(rf"""WITH d AS (SELECT doc_id, list_distinct({_TOK}) AS a FROM documents), c AS (SELECT conv_id, list_distinct(flatten(list({_TOK}))) AS b FROM conversations GROUP BY 1), s AS (SELECT doc_id, len(list_intersect(a, b)) AS o, len(a) AS na, len(b) AS nb FROM d JOIN c ON doc_id = conv_id)
SELECT doc_id, round(CASE WHEN na > 0 THEN o / na ELSE 0.0 END, 6) AS precision_, round(CASE WHEN nb > 0 THEN o / nb ELSE 0.0 END, 6) AS recall_, round(CASE WHEN o > 0 THEN 2 * o / (na + nb) ELSE 0.0 END, 6) AS f1, na < 10 AS sparse FROM s""")
def pairwise_scores(t) -> DataFrame:
    """Token precision, recall and F1 of two versions of a document, and whether there is little text to compare."""
    # texts without another version are left before they are cut into tokens, and only distinct tokens are shuffled
    talks = t("conversations").select(F.col("conv_id").alias("doc_id"), "text")
    b = talks.select("doc_id", F.array_distinct(tokens()).alias("b")).groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("b"))).alias("b"))
    both = t("documents").select("doc_id", "text").join(talks.select("doc_id"), "doc_id", "left_semi").join(b, "doc_id")
    s = both.select("doc_id", F.array_distinct(tokens()).alias("a"), "b").select("doc_id", provenance.set_scores(F.col("a"), F.col("b")).alias("s"), (F.size("a") < 10).alias("sparse"))
    return s.select("doc_id", F.round("s.precision", 6).alias("precision_"), F.round("s.recall", 6).alias("recall_"), F.round("s.f1", 6).alias("f1"), "sparse")


@query("""SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 12.5 WHEN 1 THEN 3.0 ELSE 0.0 END AS used, CASE s_suppkey % 3 WHEN 0 THEN 30.0 WHEN 1 THEN 2.0 ELSE 8.0 END AS wait, CASE WHEN s_suppkey % 2 = 0 THEN 'x y' END AS said, CASE s_suppkey % 3 WHEN 0 THEN 1200.5 WHEN 1 THEN NULL ELSE 3.0 END AS rate, s_suppkey % 2 = 0 AS well_formed FROM supplier""")
def scalar_coercions(t) -> DataFrame:
    """Meters by two spellings, waits by hint or doubling, texts or nulls, rates of text, error ids."""
    k = F.col("s_suppkey")
    a, b = F.when(k % 4 == 0, "12.5").when(k % 4 == 2, "-3"), F.when(k % 4 == 1, "3").otherwise("x")
    hint, attempt = F.when(k % 3 == 0, "99").otherwise("soon"), F.when(k % 3 == 1, 1).otherwise(3)
    said = F.when(k % 2 == 0, " x   y ").otherwise("  ")
    rate = F.when(k % 3 == 0, "$1,200.50").when(k % 3 == 1, "-1").otherwise(" 3 ")
    error = F.when(k % 2 == 0, "REC-0123456789ABCDEF").otherwise("REC-0123456789abcdef")
    return t("supplier").select(
        "s_suppkey", fn.usage_meter(a, b).alias("used"), fn.retry_delay(attempt, hint, 2.0, 30.0).alias("wait"), fn.text_or_null(said).alias("said"), fn.rate_per_thousand(rate).alias("rate"), fn.error_id_valid(error, "REC").alias("well_formed"),
    )


_WIDE = search_documents.FIELDS
_LISTED = (*search_documents.LISTS, "element_paths", "local_element_paths")


@query(f"""WITH c AS (SELECT *, conv_id || ':' || turn AS id, conv_id % 4 = 0 AS has FROM conversations)
SELECT sha256(id) AS key, id AS chunk_id, CAST(conv_id AS VARCHAR) AS document_id, CASE WHEN conv_id % 3 > 0 THEN CAST(conv_id * 2 AS VARCHAR) END AS filing_id, {", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in search_documents.TEXTS if c not in ("chunk_type", "title", "content", "heading", "source_url"))},
CASE WHEN turn % 2 = 0 THEN 'table' ELSE 'text' END AS chunk_type, CASE WHEN conv_id % 2 = 0 THEN 'Talk ' || conv_id END AS title, text AS content, CASE WHEN turn % 3 = 0 THEN role WHEN turn % 3 = 1 THEN '' END AS heading, 'https://records.invalid/' || conv_id AS source_url,
{", ".join(f"CAST(NULL AS INTEGER) AS {c}" for c in search_documents.NUMBERS if c not in ("chunk_index", "word_count"))}, CAST(turn AS INTEGER) AS chunk_index, CAST(length(text) AS INTEGER) AS word_count, CASE WHEN turn % 2 = 0 THEN role || '| ' ELSE role END AS section_path, {", ".join(f"'' AS {c}" for c in search_documents.LISTS[1:])},
CASE WHEN has THEN '' WHEN turn % 2 = 0 THEN '/contents/0/figures/1|/contents/0/paragraphs/' || turn || '|/contents/0/paragraphs/9' ELSE '/contents/0/paragraphs/' || turn END AS element_paths, CASE WHEN has THEN '' WHEN turn % 2 = 0 THEN '/figures/1|/paragraphs/9' ELSE '/paragraphs/' || turn END AS local_element_paths,
'https://desk.invalid/evidence/' || id AS url, coalesce(nullif(CASE WHEN turn % 3 = 0 THEN role WHEN turn % 3 = 1 THEN '' END, ''), CASE WHEN conv_id % 2 = 0 THEN 'Talk ' || conv_id END, 'Document ' || conv_id) AS citation_title, CASE WHEN turn % 5 = 0 THEN turn / 2 END AS vector FROM c""")
def wide_search_documents(t) -> DataFrame:
    """Chunks with their provenance as search documents of all fields, with url, title and vector."""
    ident = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    none, turn = F.lit(None).cast("string"), F.col("turn")
    heading = F.when(turn % 3 == 0, F.col("role")).when(turn % 3 == 1, "")
    chunks = t("conversations").select(
        ident.alias("id"), F.col("conv_id").alias("document_id"), F.when(F.col("conv_id") % 3 > 0, F.col("conv_id") * 2).alias("filing_id"), F.when(turn % 2 == 0, "table").otherwise("text").alias("chunk_type"),
        F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("Talk "), F.col("conv_id").cast("string"))).alias("title"), F.col("text").alias("content"), heading.alias("heading"), F.concat(F.lit("https://records.invalid/"), F.col("conv_id").cast("string")).alias("source_url"),
        turn.alias("chunk_index"), F.length("text").alias("word_count"), F.when(turn % 2 == 0, F.array("role", none, F.lit(""), F.lit(" "))).otherwise(F.array("role")).alias("section_path"),
    )
    at = F.concat(F.lit("/contents/0/paragraphs/"), turn.cast("string"))
    leaf = lambda a, b: F.struct(a.alias("element"), b.alias("local_element"))
    node = lambda a, b, c: F.struct(a.alias("element"), b.alias("local_element"), c.alias("child_elements"))
    no_child = F.expr(f"CAST(NULL AS array<{search_documents.CHILD}>)")
    figure = node(F.lit("/contents/0/figures/1"), F.lit("/figures/1"), F.array(leaf(at, none), leaf(F.lit("/contents/0/paragraphs/9"), F.lit("/paragraphs/9")), leaf(at, none)))
    text = node(at, F.concat(F.lit("/paragraphs/"), turn.cast("string")), no_child)
    provenance = t("conversations").where("conv_id % 4 <> 0").select(ident.alias("chunk_id"), F.when(turn % 2 == 0, F.array(figure)).otherwise(F.array(text, text)).alias("elements"))
    vectors = t("conversations").where("turn % 5 = 0").select(ident.alias("chunk_id"), F.array(turn / 2).alias("vector"))
    out = search_documents.search_documents(chunks, provenance, public_url=" https://desk.invalid/ ", vectors=vectors)
    return out.withColumns({c: F.array_join(c, "|") for c in _LISTED}).withColumn("vector", F.get("content_vector", F.lit(0))).drop("content_vector")
