"""Registered queries over texts, tables, pages, vectors and conversations, each with its SQL where SQL has it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions import text as fn
from palimpsest.operators import html_records, retrieval, sequences, validation, vector_index
from palimpsest.sources.tables import load

QUERIES: dict = {}
SQL: dict[str, str] = {}

#: Lists of the vector queries.
KNN = vector_index.IndexPlan(lists=16)

#: ASCII white space as both engines have it.
TOKENS = r"[^\x20\x09-\x0D]+"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: load(spark, sf_dir, name))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def tokens(col: str = "text"):
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(col), F.lit(""))), F.lit(f"({TOKENS})"), F.lit(1))


_TOK = r"regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+')"


# --- chunks -----------------------------------------------------------------------------------


@query()
def chunk_documents(t) -> DataFrame:
    """Sentence-aware greedy chunks; fragments and invariants are tested, the totals have SQL below."""
    return sequences.chunk_texts(t("documents"))


@query(r"""SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '\S+')) AS words, true AS within FROM documents WHERE len(regexp_extract_all(coalesce(text, ''), '\S+')) > 0""")
def chunk_invariants(t) -> DataFrame:
    """Chunks keep every word and none exceeds its bound."""
    chunks = sequences.chunk_texts(t("documents"))
    return chunks.groupBy("doc_id").agg(F.sum("words").alias("words"), (F.max("words") <= 300).alias("within"))


@query(r"""SELECT conv_id || ':' || turn AS chunk_id, sha256(conv_id || ':' || turn) AS search_key, coalesce(nullif(trim(role), ''), 'Document ' || conv_id) AS citation_title,
'https://records.invalid/' || conv_id AS url, length(coalesce(text, '')) AS chars FROM conversations""")
def search_documents(t) -> DataFrame:
    """Chunks as wide search rows: key, title with fallbacks, url."""
    ident = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    title = F.coalesce(F.nullif(F.trim("role"), F.lit("")), F.concat(F.lit("Document "), F.col("conv_id").cast("string")))
    return t("conversations").select(ident.alias("chunk_id"), fn.search_key(ident).alias("search_key"), title.alias("citation_title"), F.concat(F.lit("https://records.invalid/"), F.col("conv_id").cast("string")).alias("url"), F.length(F.coalesce("text", F.lit(""))).alias("chars"))


# --- functions --------------------------------------------------------------------------------


@query("""SELECT l_orderkey, l_linenumber, l_linenumber AS page, CASE WHEN l_returnflag = 'R' THEN NULL ELSE 4 END AS points, CASE WHEN l_returnflag = 'R' THEN NULL ELSE round(l_quantity + l_tax, 4) END AS last_point FROM lineitem""")
def source_regions(t) -> DataFrame:
    number = F.col("l_quantity").cast("string")
    bad = F.when(F.col("l_returnflag") == "R", "x").otherwise((F.col("l_quantity") + F.col("l_tax")).cast("string"))
    source = F.concat(F.lit("D("), F.col("l_linenumber").cast("string"), F.lit(","), number, F.lit(",1.5, 2,"), bad, F.lit(")"))
    rows = t("lineitem").select("l_orderkey", "l_linenumber", F.explode(fn.source_regions(source)).alias("r"))
    return rows.select("l_orderkey", "l_linenumber", F.col("r.page").alias("page"), F.when(F.col("r.polygon").isNotNull(), F.size("r.polygon")).alias("points"), F.round(F.element_at("r.polygon", -1), 4).alias("last_point"))


@query(r"""SELECT p_partkey, unnest([{'t': 'brand', 'v': regexp_extract(p_brand, 'Brand#(\d)(\d)', 0)}, {'t': 'maker', 'v': regexp_extract(p_brand, 'Brand#(\d)(\d)', 1)}, {'t': 'word', 'v': upper(regexp_extract(p_name, '^\w+', 0))}], recursive := true) FROM part""")
def title_identifiers(t) -> DataFrame:
    found = {"brand": F.regexp_extract("p_brand", r"Brand#(\d)(\d)", 0), "maker": F.regexp_extract("p_brand", r"Brand#(\d)(\d)", 1), "word": F.upper(F.regexp_extract("p_name", r"^\w+", 0))}
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("t"), v.alias("v")) for k, v in found.items())))
    return t("part").select("p_partkey", each.alias("x")).select("p_partkey", "x.t", "x.v")


@query("""SELECT o_orderkey, strftime(CASE WHEN o_orderpriority LIKE '3%' AND day(o_orderdate) <= 12 THEN make_date(year(o_orderdate), month(o_orderdate), day(o_orderdate)) ELSE CAST(o_orderdate AS DATE) END, '%Y-%m-%d') AS iso FROM orders""")
def date_normalize(t) -> DataFrame:
    """The orders' days written in five layouts and read back; day before month."""
    d = F.col("o_orderdate")
    p = F.substring("o_orderpriority", 1, 1)
    shown = F.when(p == "1", F.date_format(d, "yyyy/MM/dd")).when(p == "2", F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T10:00:00"))).when(p == "3", F.date_format(d, "d/M/yyyy")).when(p == "4", F.date_format(d, "MMMM d, yyyy")).otherwise(F.date_format(d, "d MMM yyyy"))
    return t("orders").select("o_orderkey", fn.normalize_date(shown).alias("iso"))


@query("""SELECT o_orderkey, strftime(least(CAST(date_trunc('month', o_orderdate) AS DATE) + 30, last_day(CAST(o_orderdate AS DATE))), '%Y-%m-%d') AS clamped FROM orders""")
def date_clamp(t) -> DataFrame:
    return t("orders").select("o_orderkey", fn.validate_date(F.concat(F.date_format("o_orderdate", "yyyy-MM-"), F.lit("31"))).alias("clamped"))


@query("""SELECT o_orderkey, first_page, least(first_page + 299, n) AS last_page FROM (SELECT o_orderkey, CAST(floor(o_totalprice / 100) AS BIGINT) + 1 AS n, unnest(range(1, CAST(floor(o_totalprice / 100) AS BIGINT) + 2, 300)) AS first_page FROM orders)""")
def page_ranges(t) -> DataFrame:
    n = F.floor(F.col("o_totalprice") / 100).cast("long") + 1
    rows = t("orders").select("o_orderkey", n.alias("n"), F.explode(F.sequence(F.lit(1).cast("long"), n, F.lit(300).cast("long"))).alias("first_page"))
    return rows.select("o_orderkey", "first_page", F.least(F.col("first_page") + 299, "n").alias("last_page"))


# --- text analytics ---------------------------------------------------------------------------


@query(rf"""WITH d AS (SELECT doc_id, {_TOK} AS w FROM documents), b AS (SELECT item_id, {_TOK} AS w FROM benchmark),
dg AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) ELSE [] END) AS g FROM d),
bg AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) ELSE [] END) AS g FROM b),
o AS (SELECT doc_id, item_id, count(*) AS both_n FROM dg JOIN bg USING (g) GROUP BY ALL),
dn AS (SELECT doc_id, count(*) AS n FROM dg GROUP BY 1), bn AS (SELECT item_id, count(*) AS n FROM bg GROUP BY 1)
SELECT doc_id, item_id, both_n, round(both_n / dn.n, 6) AS precision_, round(both_n / bn.n, 6) AS recall_, round(2 * both_n / (dn.n + bn.n), 6) AS f1 FROM o JOIN dn USING (doc_id) JOIN bn USING (item_id)""")
def ngram_overlap(t) -> DataFrame:
    """5-gram precision, recall and F1 of every pair of document and item with a common 5-gram."""
    d = t("documents").select("doc_id", tokens().alias("w")).select("doc_id", fn.ngrams(F.col("w"), 5).alias("g"))
    b = t("benchmark").select("item_id", tokens().alias("w")).select("item_id", fn.ngrams(F.col("w"), 5).alias("g"))
    dg, bg = d.select("doc_id", F.size("g").alias("dn"), F.explode("g").alias("g")), b.select("item_id", F.size("g").alias("bn"), F.explode("g").alias("g"))
    both = dg.join(bg, "g").groupBy("doc_id", "item_id").agg(F.count("*").alias("both_n"), F.max("dn").alias("dn"), F.max("bn").alias("bn"))
    n = F.col("both_n")
    return both.select("doc_id", "item_id", "both_n", F.round(n / F.col("dn"), 6).alias("precision_"), F.round(n / F.col("bn"), 6).alias("recall_"), F.round(2 * n / (F.col("dn") + F.col("bn")), 6).alias("f1"))


@query(rf"""WITH d AS (SELECT doc_id, {_TOK} AS w FROM documents), g AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) ELSE [] END AS g FROM d)
SELECT doc_id, len(g) AS total, CASE WHEN len(g) > 0 THEN round(1 - len(list_distinct(g)) / len(g), 6) ELSE 0.0 END AS rate FROM g""")
def repetition_rate(t) -> DataFrame:
    rows = t("documents").select("doc_id", tokens().alias("w"))
    total = F.greatest(F.size("w") - 4, F.lit(0)).cast("long")
    return rows.withColumn("g", fn.ngrams(F.col("w"), 5)).select("doc_id", total.alias("total"), F.when(total > 0, F.round(1 - F.size("g") / total, 6)).otherwise(0.0).alias("rate"))


@query("""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), q AS (SELECT * FROM e WHERE vec_id % 100 = 0),
s AS (SELECT q.vec_id AS query_id, e.vec_id, list_cosine_similarity(q.v, e.v) AS score FROM q, e WHERE q.vec_id <> e.vec_id)
SELECT query_id, vec_id, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, vec_id) AS rank FROM s) WHERE rank <= 10""")
def cosine_topk(t) -> DataFrame:
    """The ten nearest rows of every row whose id is divisible by 100 (the stated query set)."""
    e = t("embeddings")
    return retrieval.cosine_top_k(e, e.where("vec_id % 100 = 0"), 10).withColumn("score", F.round("score", 6))


@query("""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), s AS (SELECT q.vec_id AS query_id, e.vec_id, list_cosine_similarity(q.v, e.v) AS score FROM e AS q, e WHERE q.vec_id % 100 = 0 AND q.vec_id <> e.vec_id AND q.label = e.label),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, vec_id) AS rank FROM s) SELECT query_id, vec_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""")
def filtered_knn(t) -> DataFrame:
    """The ten nearest rows of the query's own label, through inverted lists, exact by the lists' bounds."""
    e = t("embeddings")
    centroids = vector_index.fitted(e, KNN)
    found = vector_index.nearest(vector_index.indexed(e, centroids), centroids, e.where("vec_id % 100 = 0"), 10, same=("label",), plan=KNN)
    return found.withColumn("score", F.round("score", 6))


@query("""SELECT vec_id AS query_id, 10 AS expected, true AS reached FROM embeddings WHERE vec_id % 100 = 0""")
def knn_recall(t) -> DataFrame:
    """Whether a search of three quarters of the lists finds nine in ten of the exact ten: these vectors have hardly any clusters."""
    e = t("embeddings")
    q, centroids = e.where("vec_id % 100 = 0"), vector_index.fitted(e, KNN)
    rows, exact = vector_index.indexed(e, centroids), retrieval.cosine_top_k(e, q, 10)
    found = vector_index.nearest(rows, centroids, q, 10, probes=KNN.lists * 3 // 4, exact=False, plan=KNN)
    share = vector_index.recall(found, exact).agg(F.avg("recall").alias("r"))
    return exact.groupBy("query_id").agg(F.count("*").cast("int").alias("expected")).join(F.broadcast(share)).select("query_id", "expected", (F.col("r") >= 0.9).alias("reached"))  # share is one row


@query("""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), q AS (SELECT * FROM e WHERE vec_id % 100 = 0),
s AS (SELECT q.vec_id AS query_id, q.label AS want, e.label AS got, e.vec_id, list_cosine_similarity(q.v, e.v) AS score FROM q, e WHERE q.vec_id <> e.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, vec_id) AS rank FROM s)
SELECT query_id, round(coalesce(1 / min(CASE WHEN want = got THEN rank END), 0.0), 6) AS rr FROM r WHERE rank <= 10 GROUP BY 1""")
def mrr_eval(t) -> DataFrame:
    """Reciprocal rank of the first row with the query's label."""
    e = t("embeddings")
    labels = e.select("vec_id", "label")
    found = retrieval.cosine_top_k(e, e.where("vec_id % 100 = 0"), 10).join(labels, "vec_id").join(labels.select(F.col("vec_id").alias("query_id"), F.col("label").alias("want")), "query_id")
    return retrieval.reciprocal_rank(found, F.col("label") == F.col("want"), F.lit(True)).withColumn("rr", F.round("rr", 6))


_BM25 = rf"""d AS (SELECT doc_id, {_TOK} AS w FROM documents), q AS (SELECT DISTINCT doc_id AS query_id, unnest(w[1:5]) AS term FROM d WHERE doc_id % 100 = 0),
tot AS (SELECT count(*) AS n, avg(len(w)) AS avgdl FROM d), p AS (SELECT doc_id, len(w) AS dl, unnest(w) AS term FROM d),
tf AS (SELECT term, doc_id, dl, count(*) AS tf FROM p WHERE term IN (SELECT term FROM q) GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
s AS (SELECT query_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) AS score FROM q JOIN tf USING (term) JOIN df USING (term), tot GROUP BY ALL),
kw AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s) WHERE rank <= 10)"""


def _bm25(t) -> DataFrame:
    docs = t("documents").select("doc_id", tokens().alias("tokens"))
    asked = docs.where("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), F.explode(F.slice("tokens", 1, 5)).alias("term"))
    return retrieval.bm25_top_k(docs, asked, 10)


@query(f"WITH {_BM25} SELECT query_id, doc_id, round(score, 3) AS score, rank FROM kw")
def keyword_bm25(t) -> DataFrame:
    """Ten best documents for the first five words of every document whose id is divisible by 100."""
    return _bm25(t).withColumn("score", F.round("score", 3))


@query(f"""WITH {_BM25}, sz AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY n_chars, doc_id) AS rank FROM kw JOIN documents USING (doc_id)),
u AS (SELECT query_id, doc_id AS item, rank FROM kw UNION ALL SELECT query_id, doc_id, rank FROM sz),
f AS (SELECT query_id, item, round(sum(1 / (60 + rank)), 9) AS score FROM u GROUP BY ALL)
SELECT * FROM (SELECT query_id, item, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item) AS rank FROM f) WHERE rank <= 5""")
def rrf_fusion(t) -> DataFrame:
    """Keyword ranking fused with a ranking of the same documents by size."""
    kw = _bm25(t)
    sized = kw.join(t("documents").select("doc_id", "n_chars"), "doc_id").withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("n_chars", "doc_id")))
    item = F.col("doc_id").alias("item")
    return retrieval.reciprocal_rank_fusion([kw.select("query_id", item, "rank"), sized.select("query_id", item, "rank")], 5)


@query(rf"""WITH s AS (SELECT d.doc_id, list_distinct({_TOK}) AS a FROM documents d), x AS (SELECT conv_id, list_distinct(flatten(list({_TOK}))) AS b FROM conversations GROUP BY 1)
SELECT s.doc_id, CASE WHEN len(list_concat(a, b)) = 0 THEN 1.0 ELSE round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6) END AS jaccard FROM s JOIN x ON s.doc_id = x.conv_id""")
def token_jaccard(t) -> DataFrame:
    a = t("documents").select("doc_id", F.array_distinct(tokens()).alias("a"))
    b = t("conversations").select(F.col("conv_id").alias("doc_id"), tokens().alias("b")).groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("b"))).alias("b"))
    return a.join(b, "doc_id").select("doc_id", F.round(retrieval.jaccard(F.col("a"), F.col("b")), 6).alias("jaccard"))


# --- validation -------------------------------------------------------------------------------


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_tax > 0.07 THEN 'confidence' WHEN l_linenumber > 3 THEN 'citation' WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'text' END AS reason FROM lineitem""")
def extraction_validation(t) -> DataFrame:
    """Model records checked against their batch: the first rule broken is the reason, null is valid."""
    rows = t("lineitem").select(
        "l_orderkey", "l_linenumber", F.array(F.col("l_linenumber").cast("string")).alias("cited"), F.array(F.lit("1"), F.lit("2"), F.lit("3")).alias("allowed"),
        F.when(F.col("l_tax") > 0.07, 1.2).otherwise(F.col("l_tax")).alias("confidence"),
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), " ").otherwise("text").alias("statement"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
    )
    return validation.first_violation(rows).select("l_orderkey", "l_linenumber", "reason")


@query(r"""SELECT conv_id, count(*) AS n, count_if(turn < prev) AS disordered, count_if(trim(coalesce(text, '')) = '') AS blank, count_if(role IS NULL) AS no_role FROM
(SELECT *, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM conversations) GROUP BY 1""")
def health_checks(t) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = t("conversations").withColumn("prev", F.lag("turn").over(w))
    return rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.count_if(F.col("turn") < F.col("prev")).alias("disordered"), F.count_if(F.trim(F.coalesce("text", F.lit(""))) == "").alias("blank"), F.count_if(F.col("role").isNull()).alias("no_role"))


@query("""SELECT md5_ AS key, min(doc_id) AS first_doc, count(*) AS copies FROM (SELECT sha256(coalesce(text, '')) AS md5_, doc_id FROM documents) GROUP BY 1""")
def snapshot_store(t) -> DataFrame:
    """Content-addressed snapshots: one row per distinct content, with its first document."""
    return t("documents").select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("key"), "doc_id").groupBy("key").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"))


# --- pages ------------------------------------------------------------------------------------


@query(r"""SELECT page_id, nullif(regexp_extract(html, '(?i)<html[^>]*\blang="([^"]*)"', 1), '') AS lang, len(regexp_extract_all(html, '(?i)<a href="')) AS links FROM pages""")
def html_records_check(t) -> DataFrame:
    return html_records.parse_pages(t("pages")).select("page_id", "lang", F.size("links").cast("long").alias("links"))


@query()
def html_pages(t) -> DataFrame:
    """Title, language, canonical link, meta fields, headings and links of every page."""
    p = html_records.parse_pages(t("pages"))
    return p.select("page_id", "title", "lang", "canonical", F.size("links").alias("n_links"), F.array_join("headings", " | ").alias("headings"))


@query(r"""SELECT page_id, regexp_extract(url, '^[^:]+', 0) AS scheme, regexp_extract(url, '://([^/?#]*)', 1) AS host, regexp_extract(url, '/(\d+)(?:\.html)?/?(?:[?#].*)?$', 1) AS item FROM pages""")
def item_reference(t) -> DataFrame:
    return t("pages").select("page_id", F.regexp_extract("url", "^[^:]+", 0).alias("scheme"), F.regexp_extract("url", "://([^/?#]*)", 1).alias("host"), F.regexp_extract("url", r"/(\d+)(?:\.html)?/?(?:[?#].*)?$", 1).alias("item"))


@query("""SELECT user_id, count(*) AS n, max(event_id) AS last_event FROM events GROUP BY 1""")
def upsert_state(t) -> DataFrame:
    """The state a streaming upsert reaches after all events."""
    return ledger_state(t("events"))


def ledger_state(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(F.count("*").alias("n"), F.max("event_id").alias("last_event"))
