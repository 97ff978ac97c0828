"""Registered queries of enrichment: entities, relations, events, model records, batches, caches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.operators import enrichment, model_records, normalize
from palimpsest.plans.documents import query


def filed_documents(t) -> DataFrame:
    """Orders as filed documents, with blanks, missing filings and companies that submit themselves by rule."""
    rows = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    k, text = F.col("o_orderkey"), lambda c: F.col(c).cast("string")
    return rows.select(
        text("o_orderkey").alias("document_id"), F.when(k % 5 == 0, F.lit("  ")).otherwise(F.concat(F.lit("Order "), text("o_orderkey"))).alias("title"),
        F.concat(F.lit("https://records.invalid/"), text("o_orderkey")).alias("source_url"), F.when(k % 3 != 0, text("o_custkey")).alias("filing_id"),
        F.when(k % 4 != 0, F.concat(F.lit("C"), (F.col("o_custkey") + 10000).cast("string"))).alias("filing_number"), F.when(k % 7 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("filing_date"),
        F.col("c_name").alias("company"), F.when(k % 2 == 0, text("c_custkey")).alias("company_id"), F.when(k % 6 == 0, F.upper("c_name")).otherwise(F.concat(F.lit("Clerk "), "o_orderpriority")).alias("submitter"),
        F.when(k % 8 != 0, F.col("n_name")).alias("project"),
    )


def sid(prefix: str, *parts: str) -> str:
    clean = ", ".join(f"lower(trim({p}))" for p in parts)
    return f"'{prefix}:' || substring(sha256(array_to_string(list_filter([{clean}], lambda x: x <> ''), chr(31))), 1, 24)"


_DOCS = f"""d AS (SELECT CAST(o_orderkey AS VARCHAR) AS document_id, CASE WHEN o_orderkey % 5 <> 0 THEN 'Order ' || o_orderkey END AS title, 'https://records.invalid/' || o_orderkey AS source_url,
CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS filing_id, CASE WHEN o_orderkey % 4 <> 0 THEN 'C' || (o_custkey + 10000) END AS filing_number, CASE WHEN o_orderkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS filing_date,
c_name AS company, CASE WHEN o_orderkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) END AS company_id, CASE WHEN o_orderkey % 6 = 0 THEN upper(c_name) ELSE 'Clerk ' || o_orderpriority END AS submitter, CASE WHEN o_orderkey % 8 <> 0 THEN n_name END AS project
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
e AS (SELECT *, 'document:' || document_id AS de, CASE WHEN filing_id IS NOT NULL THEN 'filing:' || filing_id WHEN filing_number IS NOT NULL THEN {sid("filing", "filing_number")} END AS fe,
{sid("organization", "company")} AS ce, {sid("organization", "submitter")} AS se, CASE WHEN project IS NOT NULL THEN {sid("project", "project")} END AS pe FROM d)"""


@query(f"""WITH {_DOCS}, r AS (SELECT document_id, unnest([{{'s': fe, 'k': 'CONTAINS', 't': de}}, {{'s': de, 'k': 'RELATES_TO', 't': ce}}, {{'s': fe, 'k': 'RELATES_TO', 't': ce}}, {{'s': se, 'k': 'SUBMITTED', 't': de}},
{{'s': de, 'k': 'CONCERNS', 't': pe}}, {{'s': fe, 'k': 'CONCERNS', 't': pe}}]) AS r FROM e)
SELECT {sid("relation", "r.s", "r.k", "r.t", "document_id")} AS id, r.s AS source_id, r.t AS target_id, r.k AS relationship_type, document_id FROM r WHERE r.s IS NOT NULL AND r.t IS NOT NULL""")
def document_relations(t) -> DataFrame:
    """All six kinds of edges of every document, each where both ends are known."""
    return enrichment.derived_relations(filed_documents(t))


@query(f"""WITH {_DOCS} SELECT {sid("event", "'filing_activity'", "document_id", "filing_date")} AS id, coalesce(title, 'Document ' || document_id || ' filed') AS title, coalesce(title, 'Document ' || document_id || ' filed') || ' was filed on ' || filing_date || '.' AS summary,
filing_date AS date_start, 'day' AS date_precision, document_id, len(list_distinct(list_filter([de, fe, ce, se, pe], lambda x: x IS NOT NULL))) AS entities, 'not_required' AS review_status FROM e WHERE filing_date IS NOT NULL""")
def filing_events(t) -> DataFrame:
    rows = enrichment.filing_events(filed_documents(t))
    return rows.select("id", "title", "summary", "date_start", "date_precision", "document_id", F.size("entity_ids").cast("long").alias("entities"), "review_status")


_ENTITIES = f"""{_DOCS}, o AS (SELECT document_id, unnest([{{'id': de, 'k': 'document', 'n': coalesce(title, 'Document ' || document_id), 'a': NULL, 'x': document_id, 'y': NULL, 'u': source_url, 'p': 0}},
{{'id': fe, 'k': 'filing', 'n': coalesce(filing_number, 'Filing ' || filing_id), 'a': CASE WHEN filing_number IS NOT NULL THEN 'Filing ' || filing_id END, 'x': filing_id, 'y': filing_number, 'u': source_url, 'p': 1}},
{{'id': ce, 'k': 'organization', 'n': company, 'a': NULL, 'x': company_id, 'y': NULL, 'u': NULL, 'p': 2}}, {{'id': se, 'k': 'organization', 'n': submitter, 'a': NULL, 'x': NULL, 'y': NULL, 'u': NULL, 'p': 3}},
{{'id': pe, 'k': 'project', 'n': project, 'a': NULL, 'x': NULL, 'y': NULL, 'u': NULL, 'p': 4}}], recursive := true) FROM e),
m AS (SELECT id, arg_min(k, (document_id, p)) AS entity_type, arg_min(n, (document_id, p)) AS name, coalesce(string_agg(DISTINCT a, ',' ORDER BY a), '') AS aliases,
coalesce(arg_max(x, (document_id, p)) FILTER (x IS NOT NULL), '') || '/' || coalesce(arg_max(y, (document_id, p)) FILTER (y IS NOT NULL), '') AS external, arg_min(u, (document_id, p)) FILTER (u IS NOT NULL) AS source_url, count(*) AS observations FROM o WHERE id IS NOT NULL GROUP BY id)"""


@query(f"WITH {_ENTITIES} SELECT * FROM m")
def document_entities(t) -> DataFrame:
    """Entities of all documents: first names, all aliases, last external ids, first urls."""
    out = enrichment.merged_entities(enrichment.observed_entities(filed_documents(t)), "document_id", "at")
    pick = lambda *keys: F.coalesce(*(F.try_element_at("external_ids", F.lit(k)) for k in keys), F.lit(""))
    external = F.concat(pick("document_id", "filing_id", "company_id"), F.lit("/"), pick("filing_number"))
    return out.select("id", "entity_type", "name", F.array_join("aliases", ",").alias("aliases"), external.alias("external"), "source_url", "observations")


@query(f"WITH {_ENTITIES} SELECT entity_type AS type, 'entities' AS \"table\", count(*) AS n FROM m GROUP BY 1 UNION ALL SELECT 'filing_activity', 'events', count(*) FROM e WHERE filing_date IS NOT NULL")
def intelligence_summary(t) -> DataFrame:
    docs = filed_documents(t)
    entities = enrichment.merged_entities(enrichment.observed_entities(docs), "document_id", "at")
    return enrichment.type_counts(("entities", entities, "entity_type"), ("events", enrichment.filing_events(docs), "event_type"))


@query(f"WITH {_ENTITIES} SELECT id, CASE WHEN substring(id, length(id)) IN ('0', '1', '2', '3') THEN upper(name) ELSE name END AS name, CASE WHEN substring(id, length(id)) IN ('0', '1', '2', '3') THEN 'model' ELSE 'derived' END AS origin FROM m")
def ledger_merge(t) -> DataFrame:
    """The model's record of an entity instead of the derived one, whole."""
    entities = enrichment.merged_entities(enrichment.observed_entities(filed_documents(t)), "document_id", "at").select("id", "name").withColumn("origin", F.lit("derived"))
    model = entities.where(F.substring("id", -1, 1).isin("0", "1", "2", "3")).select("id", F.upper("name").alias("name"), F.lit("model").alias("origin"))
    return enrichment.merged_ledgers(entities, model)


@query(f"""WITH {_ENTITIES}, r AS (SELECT unnest([{{'s': fe, 't': de}}, {{'s': de, 't': ce}}]) AS r FROM e WHERE CAST(document_id AS BIGINT) % 2 = 0),
u AS (SELECT DISTINCT unnest([r.s, r.t]) AS id FROM r WHERE r.s IS NOT NULL) SELECT id, name FROM m WHERE id IN (SELECT id FROM u)""")
def used_entities(t) -> DataFrame:
    """Entities at the ends of the relations of a filtered set of documents."""
    docs = filed_documents(t)
    relations = enrichment.derived_relations(docs.where("CAST(document_id AS BIGINT) % 2 = 0")).where("relationship_type = 'CONTAINS' OR (relationship_type = 'RELATES_TO' AND source_id LIKE 'document:%')")
    return enrichment.used_entities(enrichment.merged_entities(enrichment.observed_entities(docs), "document_id", "at"), relations, True).select("id", "name")


@query("""WITH RECURSIVE c AS (SELECT CAST(conv_id % 7 AS VARCHAR) AS d, event AS pos, conv_id || ':' || turn AS cid, length(text) AS s FROM (SELECT *, row_number() OVER (ORDER BY conv_id, turn) AS event FROM conversations) WHERE trim(coalesce(text, '')) <> ''),
k AS (SELECT *, row_number() OVER (ORDER BY pos) - 1 AS nr FROM c), o AS (SELECT *, d IS DISTINCT FROM lag(d) OVER (ORDER BY nr) AS opens FROM k), r AS (SELECT *, max(CASE WHEN opens THEN nr END) OVER (ORDER BY nr) AS run FROM o),
f AS (SELECT nr, run, d, cid, s, 1 AS batch, 1 AS n, s AS held FROM r WHERE nr = run
UNION ALL SELECT r.nr, r.run, r.d, r.cid, r.s, CASE WHEN n >= 4 OR held + r.s > 3000 THEN batch + 1 ELSE batch END, CASE WHEN n >= 4 OR held + r.s > 3000 THEN 1 ELSE n + 1 END, CASE WHEN n >= 4 OR held + r.s > 3000 THEN r.s ELSE held + r.s END FROM f JOIN r ON r.nr = f.nr + 1 AND r.run = f.run)
SELECT run, batch, d AS document_id, count(*) AS n, CAST(sum(s) AS BIGINT) AS characters, string_agg(cid, ',' ORDER BY nr) AS chunk_ids FROM f GROUP BY run, batch, d""")
def model_batches(t) -> DataFrame:
    """Contiguous runs of a document's chunks, closed by number and by characters."""
    turns = enrichment.ranked(t("conversations").withColumn("key", F.col("conv_id") * 1_000_000 + F.col("turn")), "key")
    chunks = turns.select((F.col("conv_id") % 7).cast("string").alias("document_id"), F.col("at").alias("pos"), F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("chunk_id"), F.col("text").alias("content"))
    out = enrichment.extraction_batches(chunks, most_chunks=4, most_characters=3000, size=F.length("content"))
    return out.withColumn("chunk_ids", F.array_join("chunk_ids", ","))


@query("""SELECT l_orderkey, min(CASE WHEN l_linenumber <> 2 THEN l_linenumber END) AS page_start, max(CASE WHEN l_linenumber <> 2 THEN l_linenumber + 1 END) AS page_end FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1""")
def evidence_pages(t) -> DataFrame:
    """First and last page of what a record cites; pages that aren't known don't count."""
    page = F.when(F.col("l_linenumber") != 2, F.col("l_linenumber"))
    ident = F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    chunks = t("lineitem").select(ident.alias("chunk_id"), page.alias("page_start"), (page + 1).alias("page_end")).distinct()
    records = t("lineitem").where("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.collect_set(ident).alias("cited"))
    return enrichment.evidence_pages(records, chunks, "l_orderkey")


@query(f"""WITH r AS (SELECT p_partkey, p_brand, p_type, CAST(p_partkey AS VARCHAR) AS d FROM part), x AS (SELECT *, 'brand:' || substring(sha256(lower(trim(p_brand))), 1, 24) AS s, 'type:' || substring(sha256(lower(trim(p_type))), 1, 24) AS g FROM r)
SELECT {sid("relation", "s", "'MAKES'", "g", "d", "d || ':1'", "d || ':2'")} AS id, s AS source_id, g AS target_id, d AS document_id, 'unreviewed' AS review_status FROM x""")
def model_relations(t) -> DataFrame:
    """Relations of model records: ids of both ends by type and name, the relation's with its evidence."""
    d = F.col("p_partkey").cast("string")
    records = t("part").select(
        d.alias("document_id"), F.col("p_brand").alias("source_name"), F.lit("brand").alias("source_type"), F.col("p_type").alias("target_name"), F.lit("type").alias("target_type"),
        F.lit("MAKES").alias("relationship_type"), F.array(F.concat(d, F.lit(":1")), F.concat(d, F.lit(":2"))).alias("cited"),
    )
    return enrichment.materialized_relations(records).select("id", "source_id", "target_id", "document_id", "review_status")


@query("""WITH w AS (SELECT o_orderkey, sha256(CAST(o_custkey AS VARCHAR)) AS h FROM orders), c AS (SELECT sha256(CAST(c_custkey AS VARCHAR)) AS h, arg_max(r, seq) AS response FROM
(SELECT c_custkey, c_name AS r, 1 AS seq FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, c_mktsegment, 2 FROM customer WHERE c_custkey % 6 = 0) GROUP BY c_custkey)
SELECT o_orderkey, response FROM w LEFT JOIN c USING (h)""")
def extraction_cache(t) -> DataFrame:
    """Requests with their cached responses by (hash, model, prompt); the latest response of a key counts."""
    of = lambda c: F.sha2(F.col(c).cast("string"), 256).alias("request_hash")
    key = [F.lit("m").alias("model"), F.lit("p1").alias("prompt_version")]
    c = t("customer")
    rows = c.where("c_custkey % 2 = 0").select(of("c_custkey"), *key, F.col("c_name").alias("response"), F.lit(1).alias("cached_at")).unionByName(
        c.where("c_custkey % 6 = 0").select(of("c_custkey"), *key, F.col("c_mktsegment").alias("response"), F.lit(2).alias("cached_at"))
    )
    other = c.select(of("c_custkey"), F.lit("other").alias("model"), F.lit("p1").alias("prompt_version"), F.lit("no").alias("response"), F.lit(9).alias("cached_at"))
    return enrichment.cached_requests(t("orders").select("o_orderkey", of("o_custkey"), *key), rows.unionByName(other)).select("o_orderkey", "response")


_PLAN = """w AS (SELECT doc_id, trim(coalesce(text, ''), ' ') AS x FROM documents), s AS (SELECT doc_id, x, sha256(x) AS content_sha256,
CASE WHEN x = '' THEN 'empty' WHEN length(x) > 5000 THEN 'oversized' WHEN doc_id % 3 = 0 THEN 'cached' ELSE 'missing' END AS state FROM w)"""


def _embedding_plan(t) -> DataFrame:
    chunks = t("documents").select(F.col("doc_id").alias("chunk_id"), F.col("text").alias("content"))
    own = t("documents").where("doc_id % 3 = 0").select(F.col("doc_id").alias("chunk_id"), F.sha2(F.trim(F.coalesce("text", F.lit(""))), 256).alias("content_sha256"))
    vector = F.array(F.lit(0.5), F.lit(0.25)).cast("array<float>")
    stale = own.select("chunk_id", F.lit("0").alias("content_sha256"), F.lit("m").alias("model"), vector.alias("vector"))
    short = t("documents").select(F.col("doc_id").alias("chunk_id"), F.sha2(F.trim(F.coalesce("text", F.lit(""))), 256).alias("content_sha256"), F.lit("m").alias("model"), F.slice(vector, 1, 1).alias("vector"))
    cache = own.select("chunk_id", "content_sha256", F.lit("m").alias("model"), vector.alias("vector")).unionByName(stale).unionByName(short)
    return enrichment.embedding_plan(chunks, cache, model="m", dimensions=2, most=5000)


@query(f"WITH {_PLAN} SELECT doc_id, content_sha256, state FROM s")
def embedding_lookup(t) -> DataFrame:
    """Vectors by chunk, content hash, model and dimensions; what is stale or of another size is missing."""
    return _embedding_plan(t).select(F.col("chunk_id").alias("doc_id"), "content_sha256", "state")


@query(f"WITH {_PLAN} SELECT count(*) AS selected, count_if(state = 'cached') AS cached, count_if(state = 'missing') AS missing, count_if(state = 'empty') AS empty, count_if(state = 'oversized') AS oversized, CAST(sum(length(x)) AS BIGINT) AS characters FROM s")
def embedding_counters(t) -> DataFrame:
    return enrichment.embedding_counters(_embedding_plan(t))


@query("""SELECT vec_id, sha256('{"dimensions":2,"model":"m","text":"' || label || '"}') AS request FROM embeddings""")
def request_keys(t) -> DataFrame:
    return t("embeddings").select("vec_id", enrichment.request_key(text=F.col("label").cast("string"), model=F.lit("m"), dimensions=F.lit(2)).alias("request"))


#: Every order is an answer of a model on two chunks of its customer's document; some break a rule.
_ANSWERS = """k AS (SELECT o_orderkey AS k, CAST(o_custkey % 500 AS VARCHAR) AS d, o_orderstatus AS s FROM orders),
r AS (SELECT *, CASE WHEN k % 23 = 0 THEN 'response' WHEN k % 13 = 0 THEN 'events:date' WHEN k % 17 = 0 THEN 'claims:confidence' WHEN k % 11 = 0 THEN 'obligations' WHEN k % 29 = 0 THEN 'obligations:text' WHEN k % 19 = 0 THEN 'relationships:evidence' END AS reason FROM k)"""


def _answers(t) -> DataFrame:
    k, d = F.col("o_orderkey"), (F.col("o_custkey") % 500).cast("string")
    chunk = lambda n: F.concat(k.cast("string"), F.lit(f":{n}"))
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    events = text('[{"event_type":"filed","title":"T', F.col("o_orderstatus"), '","summary":"s","date_start":"', F.when(k % 13 == 0, "2024-1").otherwise("1997-05"), '","confidence":0.5,"evidence_chunk_ids":["', chunk(1), '","', chunk(1), '"]}]')
    claims = text('[{"claim_type":"c","statement":"S', k % 3, '","confidence":', F.when(k % 17 == 0, "1.5").otherwise("1"), ',"evidence_chunk_ids":["', chunk(2), '"]}]')
    duty = text('{"obligation_type":"o","action":"', F.when(k % 29 == 0, " ").otherwise("Act"), '","confidence":"0.25","evidence_chunk_ids":["', chunk(2), '","', chunk(1), '"]}')
    duties = F.when(k % 11 == 0, F.lit("{}")).otherwise(text("[", duty, "]"))
    links = text('[{"source_name":"N', d, '","source_type":"organization","target_name":" P', k % 4, ' ","target_type":"project","relationship_type":"OWNS","confidence":0.9,"evidence_chunk_ids":["', F.when(k % 19 == 0, chunk(9)).otherwise(chunk(1)), '"]}]')
    response = F.when(k % 23 == 0, F.lit("{bad")).otherwise(text('{"events":', events, ',"claims":', claims, ',"obligations":', duties, ',"relationships":', links, "}"))
    orders = normalize.spread(t("orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "o_orderkey")
    return orders.select(d.alias("document_id"), k.alias("batch"), response.alias("response"), F.array(chunk(1), chunk(2)).alias("chunk_ids"))


@query(f"WITH {_ANSWERS} SELECT k AS batch, reason FROM r")
def model_answers(t) -> DataFrame:
    """Why an answer of a model can't be used: the first rule that it breaks."""
    return model_records.checked_answers(_answers(t)).select("batch", "reason")


_GOOD = f"""{_ANSWERS}, g AS (SELECT *, k || ':1' AS a, k || ':2' AS b, CASE WHEN k % 2 = 1 THEN 7 END AS p2 FROM r WHERE reason IS NULL)"""


@query(f"""WITH {_GOOD} SELECT 'event' AS kind, {sid("event", "d", "'filed'", "'T' || s", "'1997-05'", "a")} AS id, d AS document_id, 'T' || s AS told, k % 5 AS page_start, k % 5 + 1 AS page_end FROM g
UNION ALL SELECT 'claim', {sid("claim", "d", "'S' || (k % 3)", "b")}, d, 'S' || (k % 3), p2, p2 + 1 FROM g
UNION ALL SELECT 'obligation', {sid("obligation", "d", "'Act'", "b", "a")}, d, 'Act', least(k % 5, p2), greatest(k % 5 + 1, p2 + 1) FROM g
UNION ALL SELECT 'relation', {sid("relation", "'organization:' || substring(sha256(lower('N' || d)), 1, 24)", "'OWNS'", "'project:' || substring(sha256(lower('P' || (k % 4))), 1, 24)", "d", "a")}, d, 'organization:' || substring(sha256(lower('N' || d)), 1, 24), k % 5, k % 5 + 1 FROM g
UNION ALL SELECT DISTINCT 'entity', 'organization:' || substring(sha256(lower('N' || d)), 1, 24), NULL, 'N' || d, NULL::BIGINT, NULL::BIGINT FROM g UNION ALL SELECT DISTINCT 'entity', 'project:' || substring(sha256(lower('P' || (k % 4))), 1, 24), NULL, ' P' || (k % 4) || ' ', NULL::BIGINT, NULL::BIGINT FROM g""")
def model_tables(t) -> DataFrame:
    """Events, claims, obligations, relations and entities of all usable answers, with ids and the pages of their evidence."""
    k = F.col("o_orderkey")
    one = t("orders").select(F.concat(k.cast("string"), F.lit(":1")).alias("chunk_id"), (k % 5).alias("page_start"), (k % 5 + 1).alias("page_end"))
    two = t("orders").select(F.concat(k.cast("string"), F.lit(":2")).alias("chunk_id"), F.when(k % 2 == 1, F.lit(7)).cast("long").alias("page_start"), F.when(k % 2 == 1, F.lit(8)).cast("long").alias("page_end"))
    facts = t("customer").select(F.col("c_custkey").cast("string").alias("document_id"), *(F.col("c_name").alias(c) for c in model_records.COMMON))
    out = model_records.materialized(model_records.checked_answers(_answers(t)), one.union(two), facts, version="p1:model")
    kinds = [("event", out.events, "title"), ("claim", out.claims, "statement"), ("obligation", out.obligations, "action"), ("relation", out.relations, "source_id")]
    rows = [x.select(F.lit(kind).alias("kind"), "id", "document_id", F.col(told).alias("told"), F.col("evidence_page_start").alias("page_start"), F.col("evidence_page_end").alias("page_end")) for kind, x, told in kinds]
    none = F.lit(None)
    rows.append(out.entities.select(F.lit("entity").alias("kind"), "id", none.cast("string").alias("document_id"), F.col("name").alias("told"), none.cast("long").alias("page_start"), none.cast("long").alias("page_end")))
    return reduce(DataFrame.union, rows)
