"""Registered queries of search and answers: filters, lists, views, fusion, prompts, evaluation, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.operators import aggregates, retrieval, validation
from palimpsest.plans.documents import _BM25, _bm25, query




def turn_chunks(t) -> DataFrame:
    """Conversations as documents and turns as chunks with pages, headings and dates."""
    at = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))
    ident = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return t("conversations").select(
        F.col("conv_id").alias("document_id"), ident.alias("chunk_id"), at.alias("chunk_index"), F.when(F.col("turn") % 5 != 4, F.col("turn")).alias("page_start"), F.when(F.col("turn") % 5 != 4, F.col("turn") + F.col("conv_id") % 2).alias("page_end"),
        F.col("role").alias("heading"), F.when(F.col("conv_id") % 3 == 0, "").otherwise(F.concat(F.lit("Conversation "), F.col("conv_id").cast("string"))).alias("title"), F.coalesce("text", F.lit("")).alias("content"),
    )


_TURNS = """c AS (SELECT conv_id AS document_id, conv_id || ':' || turn AS chunk_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS chunk_index, CASE WHEN turn % 5 <> 4 THEN turn END AS page_start,
CASE WHEN turn % 5 <> 4 THEN turn + conv_id % 2 END AS page_end, role AS heading, CASE WHEN conv_id % 3 = 0 THEN '' ELSE 'Conversation ' || conv_id END AS title, coalesce(text, '') AS content FROM conversations)"""


@query("""SELECT o_orderkey FROM orders JOIN (SELECT l_orderkey, list(l_returnflag) AS f FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority IN ('1-URGENT', '5-LOW') AND list_has_any(f, ['A'])""")
def built_filter(t) -> DataFrame:
    """Filters built of lists of values: trimmed, distinct, blanks left out; an empty list filters nothing."""
    flags = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set("l_returnflag").alias("flags"))
    rows = t("orders").join(flags, "o_orderkey")
    return retrieval.scalar_filter(rows, {"o_orderstatus": [" F", "O", "F", ""], "o_orderpriority": ["1-URGENT ", "5-LOW"], "flags": ["A"], "o_orderkey": []}).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def scoped_rows(t) -> DataFrame:
    return retrieval.scoped(t("orders"), {"o_orderstatus": " F ", "o_orderpriority": "1-URGENT", "o_clerk": None}).select("o_orderkey")


@query(f"""WITH {_TURNS}, m AS (SELECT unnest(['newest', 'oldest', 'chunk', 'relevance']) AS mode), r AS (SELECT mode, chunk_id, row_number() OVER (PARTITION BY mode ORDER BY CASE mode WHEN 'newest' THEN -coalesce(page_start, -1) WHEN 'oldest' THEN coalesce(page_start, 1000000) WHEN 'chunk' THEN chunk_index ELSE -length(content) END, chunk_id) AS position FROM c, m)
SELECT * FROM r WHERE position <= 50""")
def result_lists(t) -> DataFrame:
    """The four orders of a result list, ties by chunk; fifty rows are the feature."""
    rows = turn_chunks(t).select("chunk_id", "chunk_index", F.col("page_start").alias("filing_date"), F.length("content").alias("score"))
    out = None
    for mode in ("newest", "oldest", "chunk", "relevance"):
        top = rows.orderBy(*retrieval.result_order(mode)).limit(retrieval.clamped(900, 50))
        own = top.select(F.lit(mode).alias("mode"), "chunk_id", F.row_number().over(Window.orderBy(*retrieval.result_order(mode))).alias("position"))  # of fifty rows
        out = own if out is None else out.unionByName(own)
    return out


@query(f"""WITH {_TURNS}, a AS (SELECT unnest(['1:0', '0:1', '3:2', '0:0']) AS chunk_id, unnest([0, 1, 2, 3]) AS position) SELECT position, chunk_id, content FROM a JOIN c USING (chunk_id)""")
def chunks_by_ids(t) -> DataFrame:
    """Chunks of a list of ids, in the order asked for."""
    return retrieval.by_ids(turn_chunks(t), ["1:0", " 0:1 ", "", "3:2", "1:0", "0:0"]).select("position", "chunk_id", "content")


@query(f"""WITH {_TURNS}, q AS (SELECT DISTINCT document_id, CASE WHEN document_id % 3 > 0 THEN document_id % 8 END AS page FROM c),
h AS (SELECT q.document_id, q.page, min(CASE WHEN q.page BETWEEN page_start AND page_end THEN chunk_index END) AS anchor, count(*) AS total FROM q JOIN c ON q.document_id = c.document_id GROUP BY ALL)
SELECT c.document_id, chunk_id, page IS NULL OR anchor IS NOT NULL AS page_found, total FROM c JOIN h ON c.document_id = h.document_id WHERE chunk_index > CASE WHEN anchor IS NULL THEN 0 ELSE greatest(0, anchor - 2) END AND chunk_index <= CASE WHEN anchor IS NULL THEN 0 ELSE greatest(0, anchor - 2) END + 3""")
def document_views(t) -> DataFrame:
    """Three chunks of every document around the page asked for, if it has that page."""
    chunks = turn_chunks(t)
    asked = chunks.select("document_id").distinct().select("document_id", F.when(F.col("document_id") % 3 > 0, F.col("document_id") % 8).alias("page"), F.lit(0).alias("offset"))
    return retrieval.document_view(chunks, asked, 3).select("document_id", "chunk_id", "page_found", "total")


@query(f"WITH {_TURNS} SELECT document_id, coalesce(page_start, 0) AS page, string_agg(chunk_id, ',' ORDER BY chunk_index) AS chunk_ids FROM c GROUP BY ALL")
def page_groups(t) -> DataFrame:
    return retrieval.page_groups(turn_chunks(t)).withColumn("chunk_ids", F.array_join("chunk_ids", ","))


@query(rf"""WITH {_TURNS} SELECT chunk_id, 'S' || chunk_index AS source, coalesce(nullif(heading, ''), nullif(title, ''), 'Document ' || document_id) AS shown_title, substring(trim(regexp_replace(content, '\s+', ' ', 'g')), 1, 320) AS excerpt FROM c""")
def source_citations(t) -> DataFrame:
    rows = retrieval.evidence_citations(turn_chunks(t).withColumn("rank", F.col("chunk_index")))
    return rows.select("chunk_id", "source", "shown_title", "excerpt")


@query(f"""WITH {_TURNS} SELECT document_id AS query_id, 'Question:' || chr(10) || 'What of ' || document_id || '?' || chr(10) || chr(10) || 'Retrieved evidence:' || chr(10) ||
string_agg('[S' || chunk_index || ']' || chr(10) || 'Title: ' || coalesce(nullif(heading, ''), nullif(title, ''), 'Document ' || document_id) || chr(10) || 'Document: ' || document_id || chr(10) || 'Extracted content:' || chr(10) || substring(content, 1, 50), chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY chunk_index) AS prompt FROM c GROUP BY document_id""")
def grounded_prompts(t) -> DataFrame:
    cited = retrieval.evidence_citations(turn_chunks(t).withColumn("rank", F.col("chunk_index")))
    asked = cited.withColumn("query_id", F.col("document_id")).withColumn("question", F.concat(F.lit("What of "), F.col("document_id").cast("string"), F.lit("?")))
    return retrieval.grounded_prompts(asked, "question", 50)


@query(r"""WITH a AS (SELECT conv_id, turn, 'see [S' || (turn + 1) || '] and [S' || (conv_id % 7) || '], not [S99]' AS answer FROM conversations), m AS (SELECT conv_id, turn, list_sort(list_distinct(list_filter([turn + 1, conv_id % 7, 99], lambda x: x >= 1 AND x <= 5))) AS cited FROM a)
SELECT conv_id, turn, array_to_string(cited, ',') AS cited, len(cited) > 0 AS grounded FROM m""")
def answer_citations(t) -> DataFrame:
    """Source marks of answers that exist; an answer without any isn't grounded."""
    said = F.concat(F.lit("see [S"), (F.col("turn") + 1).cast("string"), F.lit("] and [S"), (F.col("conv_id") % 7).cast("string"), F.lit("], not [S99]"))
    rows = t("conversations").select("conv_id", "turn", said.alias("answer"), F.lit(5).alias("n_sources"))
    return validation.citations(rows).select("conv_id", "turn", F.array_join(F.col("cited").cast("array<string>"), ",").alias("cited"), "grounded")


_VECTOR = """e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), vs AS (SELECT q.vec_id AS query_id, e.vec_id AS doc_id, list_cosine_similarity(q.v, e.v) AS s FROM e q, e WHERE q.vec_id % 100 = 0 AND q.vec_id <> e.vec_id),
vr AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 12) DESC, doc_id) AS rank FROM vs)"""


def _modes(t) -> tuple[DataFrame, DataFrame]:
    """The keyword ranking of documents and the vector ranking of embeddings for queries of the same ids, independent of one another."""
    e = t("embeddings")
    item = F.col("doc_id").alias("item")
    kw = _bm25(t).select("query_id", item, "rank")
    vec = retrieval.cosine_top_k(e, e.where("vec_id % 100 = 0"), 10).select("query_id", F.col("vec_id").alias("item"), "rank")
    return kw, vec


@query(f"""WITH {_BM25}, {_VECTOR}, u AS (SELECT query_id, doc_id AS item, rank FROM kw UNION ALL SELECT query_id, doc_id, rank FROM vr WHERE rank <= 10), f AS (SELECT query_id, item, round(sum(1 / (60 + rank)), 9) AS score FROM u GROUP BY ALL)
SELECT * FROM (SELECT query_id, item, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item) AS rank FROM f) WHERE rank <= 5""")
def hybrid_fusion(t) -> DataFrame:
    """Keyword and vector search, each over all rows, fused by reciprocal ranks."""
    return retrieval.hybrid_search(*_modes(t), 5, k=10)


@query(f"""WITH {_BM25}, {_VECTOR}, f AS (SELECT 'keyword' AS mode, query_id, doc_id AS item, rank FROM kw UNION ALL SELECT 'hybrid', query_id, doc_id, rank FROM vr WHERE rank <= 10),
g AS (SELECT *, query_id % 200 = 0 AS labelled, item % 10 = query_id % 10 AS relevant FROM f), r AS (SELECT mode, query_id, bool_or(labelled) AS labelled, coalesce(1 / min(CASE WHEN relevant THEN rank END), 0.0) AS rr FROM g GROUP BY ALL),
sets AS (SELECT query_id, coalesce(list(DISTINCT item) FILTER (mode = 'keyword'), []) AS a, coalesce(list(DISTINCT item) FILTER (mode = 'hybrid'), []) AS b FROM g GROUP BY 1), o AS (SELECT avg(CASE WHEN len(list_distinct(list_concat(a, b))) = 0 THEN 1.0 ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END) AS overlap FROM sets)
SELECT mode, count(*) AS queries, round(avg(CASE WHEN labelled THEN rr END), 6) AS mrr, round((SELECT overlap FROM o), 6) AS overlap FROM r GROUP BY mode""")
def mode_evaluation(t) -> DataFrame:
    """Two search modes over the same queries: mean reciprocal rank of labelled ones, and how much they agree."""
    kw, vec = _modes(t)
    both = kw.withColumn("mode", F.lit("keyword")).unionByName(vec.withColumn("mode", F.lit("hybrid")))
    marked = both.withColumn("labelled", F.col("query_id") % 200 == 0).withColumn("relevant", F.col("item") % 10 == F.col("query_id") % 10)
    return retrieval.mode_metrics(marked).withColumn("mrr", F.round("mrr", 6)).withColumn("overlap", F.round("overlap", 6))


@query("""WITH a AS (SELECT DISTINCT o_custkey AS query_id FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT o_custkey AS query_id FROM orders) SELECT query_id, false AS fell_back FROM a UNION ALL SELECT query_id, true FROM b WHERE query_id NOT IN (SELECT query_id FROM a)""")
def search_fallback(t) -> DataFrame:
    """The other mode's rows for queries that the first one finds nothing for."""
    rows = t("orders").select(F.col("o_custkey").alias("query_id"), "o_orderstatus")
    return retrieval.with_fallback(rows.where("o_orderstatus = 'F'").select("query_id").distinct(), rows.select("query_id").distinct())


# --- reports --------------------------------------------------------------------------------


@query("""SELECT o_orderstatus AS analyzer, o_orderpriority AS version, count(*) AS n, CAST(sum(coalesce(CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END, 0)) AS BIGINT) AS pages FROM orders GROUP BY ALL""")
def analyzer_inventory(t) -> DataFrame:
    pages = F.when(F.col("o_orderkey") % 3 > 0, F.col("o_custkey"))
    return t("orders").groupBy(F.col("o_orderstatus").alias("analyzer"), F.col("o_orderpriority").alias("version")).agg(F.count("*").alias("n"), F.sum(F.coalesce(pages, F.lit(0))).alias("pages"))


@query("""SELECT strftime(min(d), '%Y-%m-%d') AS earliest, strftime(max(d), '%Y-%m-%d') AS latest, count(d) AS dated, count(*) AS documents, round(sum(p) / (sum(s) / 3600.0), 4) AS pages_per_hour, count_if(p = x) AS exact_pages FROM
(SELECT CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_orderdate AS DATE) END AS d, o_orderkey % 50 + 1 AS p, o_custkey % 90 + 1 AS s, o_orderkey % 50 + CASE WHEN o_orderkey % 9 = 0 THEN 2 ELSE 1 END AS x FROM orders)""")
def corpus_totals(t) -> DataFrame:
    """Boundaries of dates, throughput and exact counts of a corpus."""
    k = F.col("o_orderkey")
    rows = t("orders").select(F.when(k % 7 > 0, F.to_date("o_orderdate")).alias("d"), (k % 50 + 1).alias("p"), (F.col("o_custkey") % 90 + 1).alias("s"), (k % 50 + F.when(k % 9 == 0, 2).otherwise(1)).alias("x"))
    return rows.agg(
        F.date_format(F.min("d"), "yyyy-MM-dd").alias("earliest"), F.date_format(F.max("d"), "yyyy-MM-dd").alias("latest"), F.count("d").alias("dated"), F.count("*").alias("documents"),
        F.round(F.sum("p") / (F.sum("s") / 3600.0), 4).alias("pages_per_hour"), F.count_if(F.col("p") == F.col("x")).alias("exact_pages"),
    )


@query("""SELECT count_if(d AND a <= 1) AS first_attempt, count_if(d AND a > 1) AS retried, count_if(NOT d AND a >= 3) AS quarantined, count_if(NOT d AND a < 3) AS unfinished, CAST(sum(CASE WHEN o_orderkey % 6 = 0 THEN 2 ELSE 0 END) AS BIGINT) AS timeouts FROM (SELECT o_orderkey, o_orderstatus = 'F' AS d, o_orderkey % 4 AS a FROM orders)""")
def reliability(t) -> DataFrame:
    k = F.col("o_orderkey")
    codes = F.when(k % 6 == 0, F.array(F.lit("TIMEOUT"), F.lit("OTHER"), F.lit("TIMEOUT"))).otherwise(F.array(F.lit("OTHER")))
    return aggregates.attempt_reliability(t("orders").select((F.col("o_orderstatus") == "F").alias("done"), (k % 4).alias("attempts"), codes.alias("codes")), 3)


@query("""WITH r AS (SELECT doc_id, unnest(['all', 'lang:' || lang]) AS cohort, (doc_id % 100) / 100.0 AS a, (doc_id % 97) / 100.0 AS b FROM documents)
SELECT cohort, count(*) AS n, count_if(a - b > 0.002) AS a_wins, count_if(a - b < -0.002) AS b_wins, count_if(abs(a - b) <= 0.002) AS ties, round(avg(a), 6) AS a_mean, round(avg(b), 6) AS b_mean FROM r WHERE cohort IS NOT NULL GROUP BY 1""")
def cohort_comparison(t) -> DataFrame:
    """Wins and ties of two scores in cohorts that may share rows; scores close to one another tie."""
    rows = t("documents").select("lang", ((F.col("doc_id") % 100) / 100.0).alias("a"), ((F.col("doc_id") % 97) / 100.0).alias("b"))
    cohorts = F.array_compact(F.array(F.lit("all"), F.concat(F.lit("lang:"), "lang")))
    return aggregates.cohort_wins(rows, cohorts, "a", "b").withColumn("a_mean", F.round("a_mean", 6)).withColumn("b_mean", F.round("b_mean", 6))


@query("""WITH c AS (SELECT doc_id, 'longest' AS cohort FROM (SELECT doc_id FROM documents ORDER BY n_chars DESC, doc_id LIMIT 15) UNION ALL SELECT doc_id, 'dense' FROM (SELECT doc_id FROM documents WHERE n_chars >= 500 ORDER BY length(regexp_replace(coalesce(text, ''), '[^.]', '', 'g')) / n_chars DESC, doc_id LIMIT 10)
UNION ALL SELECT doc_id, 'sample' FROM (SELECT doc_id FROM documents WHERE lang = 'fr' ORDER BY sha256(CAST(doc_id AS VARCHAR)), doc_id LIMIT 12))
SELECT doc_id, string_agg(cohort, ',' ORDER BY cohort) AS cohorts FROM c GROUP BY 1""")
def benchmark_cohorts(t) -> DataFrame:
    """Documents of a benchmark: the longest, the densest, and a sample by hash; the numbers are the feature."""
    dots = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), "[^.]", ""))
    rules = {
        "longest": (F.lit(True), [F.desc("n_chars")], 15), "dense": (F.col("n_chars") >= 500, [F.desc(dots / F.col("n_chars"))], 10),
        "sample": (F.col("lang") == "fr", [F.sha2(F.col("doc_id").cast("string"), 256)], 12),
    }
    return aggregates.top_cohorts(t("documents"), "doc_id", rules).withColumn("cohorts", F.array_join("cohorts", ","))


@query("""WITH s AS (SELECT l_orderkey, l_linenumber, CAST(sum(CASE l_returnflag WHEN 'R' THEN 3 WHEN 'A' THEN 2 ELSE 0 END) AS BIGINT) AS score FROM lineitem GROUP BY ALL) SELECT l_orderkey AS document_id, arg_max(l_linenumber, (score, -l_linenumber)) AS page, max(score) AS score FROM s GROUP BY 1""")
def audit_pages(t) -> DataFrame:
    """The page of every document that has the most tables and figures."""
    regions = t("lineitem").select(F.col("l_orderkey").alias("document_id"), F.col("l_linenumber").alias("page"), F.col("l_returnflag").alias("kind"))
    return aggregates.best_page(regions, {"R": 3, "A": 2})


@query("""WITH e AS (SELECT conv_id, turn, CASE WHEN turn % 4 = 3 AND conv_id % 5 = 0 THEN 'error' WHEN turn % 3 = 2 THEN 'citations' ELSE 'delta' END AS kind, coalesce(text, '') AS p FROM conversations), s AS (SELECT conv_id, min(CASE WHEN kind = 'error' THEN turn END) AS stop FROM e GROUP BY 1),
k AS (SELECT e.* FROM e JOIN s USING (conv_id) WHERE stop IS NULL OR turn <= stop)
SELECT conv_id AS answer_id, coalesce(string_agg(CASE WHEN kind = 'delta' THEN p END, '' ORDER BY turn), '') AS text, arg_max(p, turn) FILTER (kind = 'citations') AS last, bool_or(kind = 'error') AS failed FROM k GROUP BY 1""")
def answer_events(t) -> DataFrame:
    """Answer events folded: texts joined in order up to an error, the last of other kinds."""
    kind = F.when((F.col("turn") % 4 == 3) & (F.col("conv_id") % 5 == 0), "error").when(F.col("turn") % 3 == 2, "citations").otherwise("delta")
    return aggregates.answer_fold(t("conversations").select(F.col("conv_id").alias("answer_id"), F.col("turn").alias("pos"), kind.alias("kind"), F.coalesce("text", F.lit("")).alias("payload")))


@query("""WITH p AS (SELECT l_orderkey AS d, list(l_quantity) AS ps FROM lineitem WHERE l_linenumber > 2 GROUP BY 1) SELECT o_orderkey, CASE WHEN d IS NOT NULL THEN list_sum(ps) ELSE CAST(o_custkey AS DOUBLE) END AS pages FROM orders LEFT JOIN p ON d = o_orderkey""")
def usage_parts(t) -> DataFrame:
    """Pages used: the sum of parts, the whole's own number where there are none."""
    parts = t("lineitem").where("l_linenumber > 2").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list("l_quantity").alias("ps"))
    return t("orders").join(parts, "o_orderkey", "left").select("o_orderkey", aggregates.parts_else_whole(F.col("ps"), F.col("o_custkey")).alias("pages"))


@query("""WITH d AS (SELECT conv_id, coalesce(nullif(trim(arg_min(text, turn)), ''), 'New conversation') AS title, CASE WHEN conv_id % 4 > 0 THEN max(turn) END AS last FROM conversations GROUP BY 1)
SELECT conv_id, row_number() OVER (ORDER BY last DESC NULLS FIRST, conv_id) AS position, CASE WHEN last IS NULL THEN 'Undated' WHEN last >= 6 THEN 'Today' WHEN last >= 3 THEN 'Yesterday' ELSE 'Earlier' END AS bucket FROM d WHERE contains(lower(title), 'th')""")
def conversation_list(t) -> DataFrame:
    """Conversations by title, the last message first and undated ones before; in stretches of days."""
    d = t("conversations").groupBy("conv_id").agg(F.min_by("text", "turn").alias("title"), F.max("turn").alias("last"))
    d = d.select("conv_id", F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.lit("New conversation")).alias("title"), F.when(F.col("conv_id") % 4 > 0, F.col("last")).alias("last")).where(F.lower("title").contains("th"))
    bucket = F.when(F.col("last").isNull(), "Undated").when(F.col("last") >= 6, "Today").when(F.col("last") >= 3, "Yesterday").otherwise("Earlier")
    sizes = d.groupBy("last").agg(F.count("*").alias("n"))
    ahead = sizes.select("last", F.coalesce(F.sum("n").over(Window.orderBy(F.desc_nulls_first("last")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))  # a row a day
    at = F.row_number().over(Window.partitionBy("last").orderBy("conv_id"))
    own = d.withColumn("own", at).withColumn("bucket", bucket)
    joined = own.join(ahead, own["last"].eqNullSafe(ahead["last"]))
    return joined.select("conv_id", (F.col("own") + F.col("ahead")).alias("position"), "bucket")


@query("""WITH n AS (SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY c_custkey) AS k FROM customer) SELECT c_custkey, c_mktsegment AS node_type, CAST(row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS INTEGER) AS place FROM n WHERE k <= 80""")
def graph_layout(t) -> DataFrame:
    """The first eighty nodes in columns by type; eighty is the feature."""
    first = t("customer").orderBy("c_custkey").limit(80)
    return first.select("c_custkey", F.col("c_mktsegment").alias("node_type"), F.row_number().over(Window.partitionBy("c_mktsegment").orderBy("c_custkey")).alias("place"))


@query("""WITH u AS (SELECT o_orderstatus AS grp, l_returnflag AS meter, sum(l_quantity) AS units FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL), r AS (SELECT *, CASE meter WHEN 'A' THEN 2.0 WHEN 'N' THEN 0.5 WHEN 'R' THEN CASE WHEN grp = 'P' THEN NULL ELSE 4.0 END END AS rate FROM u)
SELECT grp, sum(units) AS units, coalesce(string_agg(CASE WHEN rate IS NULL THEN meter END, ',' ORDER BY meter), '') AS missing, CASE WHEN bool_and(rate IS NOT NULL) THEN round(sum(units * rate / 1000), 2) END AS cost FROM r GROUP BY 1""")
def metered_cost(t) -> DataFrame:
    """Costs at rates that differ by group; a meter without a rate leaves the group's cost open."""
    u = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_orderstatus").alias("grp"), F.col("l_returnflag").alias("meter"), F.col("l_quantity").alias("units"))
    rate = F.when(F.col("meter") == "A", 2.0).when(F.col("meter") == "N", 0.5).when(F.col("grp") != "P", 4.0)
    rates = u.select("grp", "meter").distinct().withColumn("rate", rate).where("rate IS NOT NULL")
    return aggregates.metered_cost(u, rates, "grp")


@query("""WITH e AS (SELECT user_id, event_id, event_type, value FROM events) SELECT user_id, arg_max(event_id, event_id) AS latest, min(event_id) AS first_one, any_value(user_id) AS again FROM e GROUP BY 1""")
def keyed_dedup(t) -> DataFrame:
    """First-seen and last-seen rows by key."""
    rows = t("events").select("user_id", "event_id")
    last = aggregates.last_wins(rows.withColumn("seq", F.col("event_id")), "user_id", "seq").select("user_id", F.col("event_id").alias("latest"))
    first = aggregates.first_wins(rows.withColumn("seq", F.col("event_id")), "user_id", "seq").select("user_id", F.col("event_id").alias("first_one"))
    return last.join(first, "user_id").withColumn("again", F.col("user_id"))
