"""Registered queries: filters, joins, ledgers, aggregation, sets and graphs, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.functions import text as fn
from palimpsest.functions import titles
from palimpsest.operators import aggregates, graph, ledger, sequences
from palimpsest.sources.tables import load

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (load) under its own name, with its DuckDB SQL."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: load(spark, sf_dir, name))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def day(col: str):
    return F.date_format(col, "yyyy-MM-dd")


# --- filters and projections ---------------------------------------------------------------


@query("""SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE') AND o_orderstatus IN ('O', 'F') AND o_orderdate >= TIMESTAMP '1995-01-01'""")
def scope_filter(t) -> DataFrame:
    """Values within a field are alternatives, fields are combined; all scoped rows."""
    wanted = (F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE")) & F.col("o_orderstatus").isin("O", "F") & (F.col("o_orderdate") >= "1995-01-01")
    return t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).where(wanted).select("o_orderkey", "o_custkey", day("o_orderdate").alias("order_day"))


@query("""SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50""")
def top_results(t) -> DataFrame:
    """Top results by relevance (price), ties by key; the limit is the feature."""
    return t("orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50).select("o_orderkey", "o_totalprice", day("o_orderdate").alias("order_day"))


@query("""SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags FROM lineitem GROUP BY 1
HAVING list_has_any(list(l_returnflag), ['A', 'R'])""")
def array_any_filter(t) -> DataFrame:
    flags = t("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_returnflag")).alias("f"))
    return flags.where(F.arrays_overlap("f", F.array(F.lit("A"), F.lit("R")))).select("l_orderkey", F.array_join("f", ",").alias("flags"))


@query("""SELECT l_orderkey, min(l_linenumber) AS page_start, max(l_linenumber) AS page_end,
CASE WHEN min(l_linenumber) = max(l_linenumber) THEN 'page ' || min(l_linenumber) ELSE 'pages ' || min(l_linenumber) || '-' || max(l_linenumber) END AS label
FROM lineitem GROUP BY 1 HAVING 3 BETWEEN min(l_linenumber) AND max(l_linenumber)""")
def page_range_contains(t) -> DataFrame:
    spans = t("lineitem").groupBy("l_orderkey").agg(F.min("l_linenumber").alias("page_start"), F.max("l_linenumber").alias("page_end"))
    return spans.where(F.lit(3).between(F.col("page_start"), F.col("page_end"))).withColumn("label", fn.page_label(F.col("page_start"), F.col("page_end")))


@query(r"""SELECT conv_id, turn, CASE WHEN regexp_matches(text, '["“][^"”]{3,}["”]') OR regexp_matches(text, '\b[A-Z]{1,5}[- ]?\d{4,}\b') THEN 'keyword' ELSE 'hybrid' END AS mode,
substring(trim(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')), 1, 320) AS excerpt FROM conversations""")
def retrieval_mode(t) -> DataFrame:
    short = F.substring(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")), 1, 320)
    mode = F.coalesce(fn.preferred_mode(F.col("text")), F.lit("hybrid"))
    return t("conversations").select("conv_id", "turn", mode.alias("mode"), short.alias("excerpt"))


@query(r"""SELECT doc_id, regexp_matches(lower(text), '\b(commission|board|cer|regulator|regulatory|finding|decision|determination|conclusion)\b') AS regulator, contains(lower(text), 'condition') AS condition,
CASE WHEN length(replace(text, chr(10), ' ')) > 300 THEN substring(replace(text, chr(10), ' '), 1, 297) || '...' ELSE replace(text, chr(10), ' ') END AS preview FROM documents""")
def finding_predicates(t) -> DataFrame:
    low = F.lower("text")
    return t("documents").select("doc_id", titles.is_regulator_claim(F.col("text"), F.lit(None)).alias("regulator"), low.contains("condition").alias("condition"), fn.preview(F.col("text")).alias("preview"))


@query("""SELECT p_partkey, '"' || replace(p_name, '"', '""') || '","' || replace(p_brand, '"', '""') || '"' AS line FROM part""")
def evidence_csv(t) -> DataFrame:
    return t("part").select("p_partkey", F.concat_ws(",", fn.csv_cell(F.col("p_name")), fn.csv_cell(F.col("p_brand"))).alias("line"))


# --- joins and ledgers ----------------------------------------------------------------------


@query("""SELECT l_orderkey, l_linenumber, p_brand, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey WHERE o_orderstatus = 'F' AND l_linestatus = 'F'""")
def current_success_join(t) -> DataFrame:
    done = t("orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_orderdate")
    lines = t("lineitem").where("l_linestatus = 'F'").select("l_orderkey", "l_linenumber", "l_partkey")
    joined = lines.join(done, F.col("l_orderkey") == F.col("o_orderkey")).join(t("part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return joined.select("l_orderkey", "l_linenumber", "p_brand", day("o_orderdate").alias("order_day"))


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def not_yet_processed(t) -> DataFrame:
    done = t("orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return ledger.pending(t("customer").select("c_custkey", "c_name"), done, ["c_custkey"])


@query("""SELECT a.l_orderkey, a.l_partkey AS first_part, b.l_partkey AS second_part, round(b.l_extendedprice - a.l_extendedprice, 2) AS delta
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = 1 AND b.l_linenumber = 2""")
def pair_compare(t) -> DataFrame:
    lines = t("lineitem").where("l_linenumber IN (1, 2)")
    a, b = (lines.where(F.col("l_linenumber") == k).select("l_orderkey", F.col("l_partkey").alias(p), F.col("l_extendedprice").alias(f"x{k}")) for k, p in ((1, "first_part"), (2, "second_part")))
    return a.join(b, "l_orderkey").select("l_orderkey", "first_part", "second_part", F.round(F.col("x2") - F.col("x1"), 2).alias("delta"))


@query("""SELECT o_custkey, o_orderkey AS latest_order, o_totalprice, n FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r,
count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) WHERE r = 1""")
def latest_per_key(t) -> DataFrame:
    best = t("orders").groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey", "o_totalprice")).alias("m"), F.count("*").alias("n"))
    return best.select("o_custkey", F.col("m.o_orderkey").alias("latest_order"), F.col("m.o_totalprice").alias("o_totalprice"), "n")


@query("""SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1 AS is_current FROM orders""")
def current_version_flip(t) -> DataFrame:
    return ledger.current_version(t("orders"), "o_custkey", [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_orderkey", "is_current")


_OLD = "SELECT o_orderkey AS k, o_orderstatus AS s, o_totalprice AS p FROM orders WHERE o_orderstatus <> 'P'"
_ALTERED = "o_orderkey AS k, CASE WHEN o_orderpriority LIKE '1%' THEN 'X' ELSE o_orderstatus END AS s, o_totalprice + CASE WHEN o_orderpriority LIKE '2%' THEN 1 ELSE 0 END AS p"
_NEW = f"SELECT {_ALTERED} FROM orders WHERE o_totalprice >= 20000"


def _snapshots(t) -> tuple[DataFrame, DataFrame]:
    """Two derived states of one ledger: rows are gone, added and altered by rule."""
    o = t("orders")
    old = o.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_totalprice").alias("p"))
    new = o.where("o_totalprice >= 20000").selectExpr(*_ALTERED.replace(" END AS s, ", " END AS s|").replace("AS k, ", "AS k|").split("|"))
    return old, new


@query(f"""WITH a AS ({_OLD}), b AS ({_NEW}), j AS (SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'extra'
WHEN a.s IS DISTINCT FROM b.s OR a.p IS DISTINCT FROM b.p THEN 'changed' ELSE 'equal' END AS status,
CASE WHEN a.s IS DISTINCT FROM b.s AND a.p IS DISTINCT FROM b.p THEN 's,p' WHEN a.s IS DISTINCT FROM b.s THEN 's' WHEN a.p IS DISTINCT FROM b.p THEN 'p' ELSE '' END AS f
FROM a FULL JOIN b ON a.k = b.k)
SELECT k, status, CASE WHEN status = 'changed' THEN f ELSE '' END AS fields FROM j""")
def ledger_diff(t) -> DataFrame:
    return ledger.differences(*_snapshots(t), "k", ["s", "p"])


@query(f"""WITH a AS ({_OLD}), b AS ({_NEW}) SELECT coalesce(b.k, a.k) AS k, coalesce(nullif(b.s, ''), a.s) AS s, CASE WHEN b.k IS NOT NULL THEN b.p ELSE a.p END AS p,
CASE WHEN a.k IS NULL THEN 'inserted' WHEN b.k IS NOT NULL THEN 'updated' ELSE 'kept' END AS state FROM a FULL JOIN b ON a.k = b.k""")
def ledger_upsert(t) -> DataFrame:
    return ledger.upsert(*_snapshots(t), "k", ["s"], ["p"])


@query(f"""WITH a AS ({_OLD}), b AS ({_NEW}) SELECT 'kept' AS side, count(*) AS n FROM (SELECT k FROM a INTERSECT SELECT k FROM b)
UNION ALL SELECT 'removed', count(*) FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT 'added', count(*) FROM (SELECT k FROM b EXCEPT SELECT k FROM a)""")
def set_reconciliation(t) -> DataFrame:
    old, new = (x.select("k") for x in _snapshots(t))
    side = lambda name, d: d.agg(F.lit(name).alias("side"), F.count("*").alias("n"))
    return side("kept", old.intersect(new)).unionByName(side("removed", old.subtract(new))).unionByName(side("added", new.subtract(old)))


@query("""WITH p AS (SELECT DISTINCT o_orderkey AS parent, l AS child FROM (SELECT o_orderkey, unnest(range(1, 4)) AS l FROM orders)),
c AS (SELECT DISTINCT l_orderkey AS parent, l_linenumber::BIGINT AS child FROM lineitem)
SELECT CASE WHEN c.parent IS NULL THEN 'parent_only' WHEN p.parent IS NULL THEN 'child_only' ELSE 'agreed' END AS counter, count(*) AS n
FROM p FULL JOIN c ON p.parent = c.parent AND p.child = c.child GROUP BY 1""")
def backlink_audit(t) -> DataFrame:
    told = t("orders").select(F.col("o_orderkey").alias("parent"), F.explode(F.array(*(F.lit(k).cast("long") for k in (1, 2, 3)))).alias("child"))
    return ledger.backlinks(told, t("lineitem").select(F.col("l_orderkey").alias("parent"), F.col("l_linenumber").cast("long").alias("child")))


@query("""SELECT c_custkey, coalesce(h, false) AS hit FROM customer LEFT JOIN (SELECT DISTINCT o_custkey, true AS h FROM orders WHERE o_totalprice > 150000) ON c_custkey = o_custkey""")
def cache_hit_split(t) -> DataFrame:
    cached = t("orders").where("o_totalprice > 150000").select(F.col("o_custkey").alias("c_custkey"))
    return ledger.cache_split(t("customer").select("c_custkey"), cached, "c_custkey")


@query("""WITH m AS (SELECT l_orderkey AS k, list_sort(list_distinct(list(l_linenumber) FILTER (l_linenumber <= 4))) AS prev, list_sort(list_distinct(list(l_linenumber) FILTER (l_linenumber <> 2))) AS obs, l_orderkey % 2 = 0 AS whole FROM lineitem GROUP BY 1),
e AS (SELECT k, coalesce(prev, []) AS prev, list_sort(CASE WHEN whole THEN coalesce(obs, []) ELSE list_distinct(list_concat(coalesce(prev, []), coalesce(obs, []))) END) AS eff FROM m)
SELECT k, array_to_string(eff, ',') AS effective, array_to_string(list_sort(list_filter(prev, lambda x: NOT list_contains(eff, x))), ',') AS removed FROM e""")
def member_merge(t) -> DataFrame:
    ids = lambda cond: F.collect_set(F.when(cond, F.col("l_linenumber")))
    m = t("lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(ids(F.col("l_linenumber") <= 4).alias("prev"), ids(F.col("l_linenumber") != 2).alias("obs"))
    effective, removed = ledger.merge_members(F.col("prev"), F.col("obs"), F.col("k") % 2 == 0)
    return m.select("k", F.array_join(effective.cast("array<string>"), ",").alias("effective"), F.array_join(removed.cast("array<string>"), ",").alias("removed"))


@query("SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY ALL")
def status_histogram(t) -> DataFrame:
    return ledger.statuses(t("orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")), "status", "priority")


# --- aggregation ----------------------------------------------------------------------------


@query("""WITH f AS (SELECT 'lang' AS facet, lang AS value FROM documents UNION ALL SELECT 'source', source FROM documents
UNION ALL SELECT 'quality', CAST(quality AS VARCHAR) FROM documents LEFT JOIN labels USING (doc_id)),
c AS (SELECT facet, value, count(*) AS n FROM f WHERE value IS NOT NULL GROUP BY ALL)
SELECT * FROM (SELECT facet, value, n, row_number() OVER (PARTITION BY facet ORDER BY n DESC, value) AS rank FROM c) WHERE rank <= 12""")
def facet_counts(t) -> DataFrame:
    rows = t("documents").select("doc_id", "lang", "source").join(t("labels").select("doc_id", "quality"), "doc_id", "left")
    return aggregates.facet_counts(rows, ["lang", "source", "quality"], 12)


@query("""SELECT l_returnflag, count(l_quantity) AS n, quantile_disc(l_extendedprice, 0.5) AS p50, quantile_disc(l_extendedprice, 0.9) AS p90, quantile_disc(l_extendedprice, 0.95) AS p95,
max(l_extendedprice) AS max_value, round(sum(l_extendedprice), 2) AS total, round(avg(l_extendedprice), 4) AS mean FROM lineitem GROUP BY 1""")
def nearest_rank_quantiles(t) -> DataFrame:
    out = aggregates.nearest_rank(t("lineitem"), "l_returnflag", "l_extendedprice", {"p50": 0.5, "p90": 0.9, "p95": 0.95})
    return out.withColumn("total", F.round("total", 2)).withColumn("mean", F.round("mean", 4))


@query("""WITH r AS (SELECT o_custkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) - 1 AS idx, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
SELECT o_custkey, o_totalprice AS percentile FROM r WHERE idx = CAST(round_even((n - 1) * 0.95, 0) AS BIGINT)""")
def bankers_percentile(t) -> DataFrame:
    return aggregates.bankers_percentile(t("orders"), "o_custkey", "o_totalprice", 0.95, "o_orderkey")


@query("""WITH e AS (SELECT 'nation:' || n_nationkey AS entity_id, c_custkey AS seq, n_name AS name, c_mktsegment AS alias, CASE WHEN c_custkey % 3 = 0 THEN c_name END AS source_url FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT entity_id, arg_min(name, seq) AS name, array_to_string(list_sort(list_distinct(list(alias))), ',') AS aliases, arg_min(source_url, CASE WHEN source_url IS NOT NULL THEN seq END) AS source_url, count(*) AS observations FROM e GROUP BY 1""")
def entity_merge(t) -> DataFrame:
    c = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = c.select(F.concat(F.lit("nation:"), F.col("n_nationkey").cast("string")).alias("entity_id"), F.col("c_custkey").alias("seq"), F.col("n_name").alias("name"), F.col("c_mktsegment").alias("alias"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).alias("source_url"))
    return aggregates.merge_entities(rows).withColumn("aliases", F.array_join("aliases", ","))


@query("""WITH u AS (SELECT o_orderstatus AS grp, l_returnflag AS meter, l_quantity AS units FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
r AS (SELECT *, CASE meter WHEN 'A' THEN 2.0 WHEN 'N' THEN 0.5 WHEN 'R' THEN CASE WHEN grp = 'P' THEN NULL ELSE 4.0 END END AS rate FROM u)
SELECT grp, sum(units) AS units, '' || coalesce(string_agg(DISTINCT CASE WHEN rate IS NULL THEN meter END, ','), '') AS missing,
CASE WHEN bool_and(rate IS NOT NULL) THEN round(sum(units * rate / 1000), 2) END AS cost FROM r GROUP BY 1""")
def usage_cost(t) -> DataFrame:
    u = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    meter = F.when((F.col("l_returnflag") == "R") & (F.col("o_orderstatus") == "P"), "R!").otherwise(F.col("l_returnflag"))
    out = aggregates.usage_cost(u.select(F.col("o_orderstatus").alias("grp"), meter.alias("meter"), F.col("l_quantity").alias("units")), {"A": 2.0, "N": 0.5, "R": 4.0}, "grp")
    return out.withColumn("missing", F.replace("missing", F.lit("!"), F.lit("")))


@query("""WITH x AS (SELECT d.doc_id, unnest([CASE WHEN n_chars >= 2000 THEN 'long' ELSE 'short' END, 'lang:' || lang]) AS cohort, quality, toxic, n_chars FROM documents d JOIN labels USING (doc_id))
SELECT cohort, count(*) AS n, count_if(quality - toxic > 0) AS wins, count_if(quality = toxic) AS ties, round(avg(CASE WHEN toxic = 0 THEN n_chars END), 2) AS clean_chars, round(sum(n_chars) / greatest(1, sum(quality)), 2) AS chars_ratio FROM x GROUP BY 1""")
def win_band_cohorts(t) -> DataFrame:
    rows = t("documents").select("doc_id", "lang", "n_chars").join(t("labels"), "doc_id")
    cohorts = F.array(F.when(F.col("n_chars") >= 2000, "long").otherwise("short"), F.concat(F.lit("lang:"), F.col("lang")))
    each = rows.withColumn("cohort", F.explode(cohorts))
    return each.groupBy("cohort").agg(
        F.count("*").alias("n"), F.count_if(F.col("quality") - F.col("toxic") > 0).alias("wins"), F.count_if(F.col("quality") == F.col("toxic")).alias("ties"),
        F.round(F.avg(F.when(F.col("toxic") == 0, F.col("n_chars"))), 2).alias("clean_chars"), F.round(aggregates.ratio_of_sums(F.col("n_chars"), F.col("quality")), 2).alias("chars_ratio"),
    )


@query("""SELECT lang, source, count(*) AS n, sum(n_chars) AS chars FROM documents GROUP BY ROLLUP (lang, source)""")
def corpus_rollup(t) -> DataFrame:
    return t("documents").rollup("lang", "source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("""SELECT source, count(*) AS documents, count(DISTINCT lang) AS langs, sum(strlen(coalesce(text, ''))) AS bytes, max(n_chars) AS longest, string_agg(DISTINCT lang, ',' ORDER BY lang) AS lang_list FROM documents GROUP BY 1""")
def publish_plan(t) -> DataFrame:
    return t("documents").groupBy("source").agg(
        F.count("*").alias("documents"), F.count_distinct("lang").alias("langs"), F.sum(F.octet_length(F.coalesce("text", F.lit("")))).alias("bytes"), F.max("n_chars").alias("longest"), F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("lang_list"),
    )


@query("""SELECT l_orderkey, count(*) AS cells, count_if(l_quantity > 45) AS out_of_bounds, sum(greatest(0, c - 1)) AS duplicates FROM
(SELECT l_orderkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey, l_returnflag) = 1 AS f, count(*) OVER (PARTITION BY l_orderkey, l_returnflag) AS cc, CASE WHEN f THEN cc ELSE 1 END AS c FROM lineitem) GROUP BY 1""")
def table_diagnostics(t) -> DataFrame:
    cells = t("lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.count("*").alias("c"), F.count_if(F.col("l_quantity") > 45).alias("o"))
    return cells.groupBy("l_orderkey").agg(F.sum("c").alias("cells"), F.sum("o").alias("out_of_bounds"), F.sum(F.greatest(F.lit(0), F.col("c") - 1)).alias("duplicates"))


# --- graph ----------------------------------------------------------------------------------


def _relations(t) -> DataFrame:
    """Submitted and concerns edges of every order, if their conditions hold, with stable ids."""
    rows = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    doc, org, place = (F.concat(F.lit(p), F.col(c).cast("string")) for p, c in (("document:", "o_orderkey"), ("organization:", "c_custkey"), ("project:", "n_nationkey")))
    options = F.array(
        F.struct((F.col("o_orderstatus") != "P").alias("there"), F.lit("SUBMITTED").alias("type"), org.alias("a"), doc.alias("b")),
        F.struct((F.col("c_acctbal") > 0).alias("there"), F.lit("CONCERNS").alias("type"), doc.alias("a"), place.alias("b")),
    )
    each = rows.select(F.explode(F.filter(options, lambda x: x["there"])).alias("r"))
    return each.select(fn.stable_id("relation", F.col("r.type"), F.col("r.a"), F.col("r.b")).alias("relation_id"), F.col("r.type").alias("relation_type"), F.col("r.a").alias("source_id"), F.col("r.b").alias("target_id"))


_RELATIONS = """r AS (SELECT unnest(list_filter([{'there': o_orderstatus <> 'P', 'type': 'SUBMITTED', 'a': 'organization:' || c_custkey, 'b': 'document:' || o_orderkey},
{'there': c_acctbal > 0, 'type': 'CONCERNS', 'a': 'document:' || o_orderkey, 'b': 'project:' || n_nationkey}], lambda x: x.there)) AS r
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
rel AS (SELECT 'relation:' || substring(sha256(lower(r.type) || chr(31) || lower(r.a) || chr(31) || lower(r.b)), 1, 24) AS relation_id, r.type AS relation_type, r.a AS source_id, r.b AS target_id FROM r)"""


@query(f"WITH {_RELATIONS} SELECT * FROM rel")
def derive_relations(t) -> DataFrame:
    return _relations(t)


@query(f"""WITH {_RELATIONS}, f AS (SELECT * FROM rel ORDER BY relation_id LIMIT 200), e AS (SELECT unnest([source_id, target_id]) AS node_id FROM f)
SELECT DISTINCT node_id, split_part(node_id, ':', 1) AS node_type, (SELECT count(*) FROM rel) > 200 AS truncated FROM e""")
def graph_neighbourhood(t) -> DataFrame:
    relations = _relations(t)
    nodes = relations.select(F.explode(F.array("source_id", "target_id")).alias("node_id")).distinct().withColumn("node_type", F.substring_index("node_id", ":", 1))
    return graph.neighbourhood(relations, nodes, 200)


@query("""WITH RECURSIVE e AS (SELECT 'r' || r_regionkey AS parent, 'n' || n_nationkey AS child FROM region JOIN nation ON n_regionkey = r_regionkey
UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer UNION ALL SELECT 'c' || o_custkey, 'o' || o_orderkey FROM orders),
c AS (SELECT parent AS ancestor, child AS descendant, 1 AS depth FROM e UNION ALL SELECT c.ancestor, e.child, c.depth + 1 FROM c JOIN e ON c.descendant = e.parent WHERE c.depth < 4)
SELECT ancestor, descendant, min(depth) AS depth FROM c GROUP BY ALL""")
def containment_closure(t) -> DataFrame:
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    edges = (
        t("region").join(t("nation"), F.col("n_regionkey") == F.col("r_regionkey")).select(name("r", "r_regionkey").alias("parent"), name("n", "n_nationkey").alias("child"))
        .union(t("customer").select(name("n", "c_nationkey"), name("c", "c_custkey"))).union(t("orders").select(name("c", "o_custkey"), name("o", "o_orderkey")))
    )
    return graph.closure(edges, 4)


# --- order ----------------------------------------------------------------------------------


@query("""WITH e AS (SELECT *, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y') WHEN 1 THEN strftime(ts, '%Y-%m') ELSE strftime(ts, '%Y-%m-%d') END AS date_start FROM events)
SELECT event_id, date_start, CASE event_id % 3 WHEN 0 THEN 'year' WHEN 1 THEN 'month' ELSE 'day' END AS date_precision,
row_number() OVER (PARTITION BY user_id ORDER BY date_start, event_id) AS position FROM e""")
def timeline_sorted(t) -> DataFrame:
    """Partial dates sort as text: a year before its months, a month before its days."""
    k = F.col("event_id") % 3
    start = F.when(k == 0, F.date_format("ts", "yyyy")).when(k == 1, F.date_format("ts", "yyyy-MM")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    rows = t("events").select("event_id", "user_id", start.alias("date_start"), F.when(k == 0, "year").when(k == 1, "month").otherwise("day").alias("date_precision"))
    return rows.withColumn("position", F.row_number().over(Window.partitionBy("user_id").orderBy("date_start", "event_id"))).drop("user_id")


@query("""SELECT o_orderkey, d AS deadline, row_number() OVER (PARTITION BY o_custkey ORDER BY coalesce(d, '9999'), o_orderkey) AS position
FROM (SELECT *, CASE WHEN o_orderkey % 4 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders)""")
def deadline_sort_nulls_last(t) -> DataFrame:
    rows = t("orders").withColumn("deadline", F.when(F.col("o_orderkey") % 4 != 0, day("o_orderdate")))
    order = Window.partitionBy("o_custkey").orderBy(F.coalesce("deadline", F.lit("9999")), "o_orderkey")
    return rows.select("o_orderkey", "deadline", F.row_number().over(order).alias("position"))


@query("""WITH i AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INTEGER) AS e FROM orders),
b AS (SELECT *, max(e) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM i),
g AS (SELECT *, sum(CASE WHEN m IS NULL OR s > m + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM b),
a AS (SELECT o_custkey, island, min(s) AS s, max(e) AS e FROM g GROUP BY ALL)
SELECT o_custkey, CAST(island AS BIGINT) AS island, strftime(s, '%Y-%m-%d') AS start_day, strftime(e, '%Y-%m-%d') AS end_day,
CAST(coalesce(lead(s) OVER (PARTITION BY o_custkey ORDER BY island) - e - 1, 0) AS INTEGER) AS gap_days FROM a""")
def interval_coverage(t) -> DataFrame:
    rows = t("orders").select("o_custkey", F.to_date("o_orderdate").alias("s"), F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 40).cast("int")).alias("e"))
    out = sequences.merge_intervals(rows, "o_custkey", "s", "e")
    return out.select("o_custkey", "island", day("start_day").alias("start_day"), day("end_day").alias("end_day"), "gap_days")


@query("""WITH r AS (SELECT *, CASE WHEN role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn) OR row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1 THEN 1 ELSE 0 END AS c FROM conversations),
n AS (SELECT *, sum(c) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS run FROM r)
SELECT conv_id, CAST(run AS BIGINT) AS run, any_value(role) AS role, count(*) AS turns, min(turn) AS first_turn, sum(length(coalesce(text, ''))) AS chars FROM n GROUP BY conv_id, run""")
def extraction_batches(t) -> DataFrame:
    runs = sequences.contiguous_runs(t("conversations"), "conv_id", "turn", F.col("role"))
    return runs.groupBy("conv_id", "run").agg(F.any_value("role").alias("role"), F.count("*").alias("turns"), F.min("turn").alias("first_turn"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("chars"))


@query("""SELECT conv_id, turn, CAST(coalesce(sum(length(coalesce(text, '')) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS span_start FROM conversations""")
def running_offsets(t) -> DataFrame:
    return sequences.running_offset(t("conversations"), "conv_id", "turn", F.length(F.coalesce("text", F.lit("")))).select("conv_id", "turn", "span_start")


@query("""WITH RECURSIVE c AS (SELECT conv_id, turn, strlen(coalesce(text, '')) + 64 AS s, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
f AS (SELECT conv_id, turn, k, 1 AS batch, 1 AS n, s AS held, s > 1000 AS oversized FROM c WHERE k = 1
UNION ALL SELECT c.conv_id, c.turn, c.k, CASE WHEN n >= 3 OR held + s > 1000 THEN batch + 1 ELSE batch END, CASE WHEN n >= 3 OR held + s > 1000 THEN 1 ELSE n + 1 END,
CASE WHEN n >= 3 OR held + s > 1000 THEN s ELSE held + s END, s > 1000 FROM f JOIN c ON c.conv_id = f.conv_id AND c.k = f.k + 1)
SELECT conv_id, turn, batch, oversized FROM f""")
def bounded_batches(t) -> DataFrame:
    size = F.octet_length(F.coalesce("text", F.lit("")))
    return sequences.bounded_batches(t("conversations"), "conv_id", "turn", size, 3, 1000, 64).select("conv_id", "turn", "batch", "oversized")


@query("""WITH i AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'paper:' || o_orderkey || ':A' ELSE CAST(o_orderkey AS VARCHAR) END AS id, o_custkey FROM orders)
SELECT o_orderkey, id, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN regexp_matches(id, '^[0-9]+$') THEN 0 ELSE 1 END, TRY_CAST(id AS HUGEINT), lower(id), id) AS position FROM i""")
def natural_sort(t) -> DataFrame:
    ident = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("paper:"), F.col("o_orderkey").cast("string"), F.lit(":A"))).otherwise(F.col("o_orderkey").cast("string"))
    rows = t("orders").select("o_orderkey", "o_custkey", ident.alias("id"))
    return rows.select("o_orderkey", "id", F.row_number().over(Window.partitionBy("o_custkey").orderBy(*fn.natural_order(F.col("id")))).alias("position"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS k, max(CASE WHEN l_returnflag = 'R' THEN l_linenumber END) OVER (PARTITION BY l_orderkey) AS anchor FROM lineitem)
WHERE k > greatest(0, coalesce(anchor, 1) - 1 - 1) AND k <= greatest(0, coalesce(anchor, 1) - 1 - 1) + 3""")
def document_window(t) -> DataFrame:
    """Three rows of each document around its anchor, a third of them before it."""
    w = Window.partitionBy("l_orderkey")
    rows = t("lineitem").withColumn("k", F.row_number().over(w.orderBy("l_linenumber", "l_partkey"))).withColumn("anchor", F.max(F.when(F.col("l_returnflag") == "R", F.col("l_linenumber"))).over(w))
    offset = F.greatest(F.lit(0), F.coalesce("anchor", F.lit(1)) - 1 - 3 // 3)
    return rows.where((F.col("k") > offset) & (F.col("k") <= offset + 3)).select("l_orderkey", "l_linenumber", "l_partkey")


@query("""WITH e AS (SELECT event_id, user_id, ts, value FROM events), l AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = (SELECT min(event_type) FROM events))
SELECT e.event_id, arg_max(l.event_id, (l.ts, l.event_id)) AS last_marker FROM e JOIN l ON e.user_id = l.user_id AND l.ts <= e.ts GROUP BY 1""")
def as_of_join(t) -> DataFrame:
    """Each event with the last marker of its user up to then: one sorted pass, no range join."""
    ev = t("events").select("event_id", "user_id", "ts", "event_type")
    first = ev.agg(F.min("event_type").alias("m"))
    marked = ev.join(F.broadcast(first)).withColumn("marker", F.when(F.col("event_type") == F.col("m"), F.struct("ts", "event_id")))
    upto = Window.partitionBy("user_id").orderBy("ts").rangeBetween(Window.unboundedPreceding, 0)
    return marked.withColumn("last", F.max("marker").over(upto)).where("last is not null").select("event_id", F.col("last.event_id").alias("last_marker"))


@query("""SELECT time_bucket(INTERVAL '1 hour', ts) AS hour_start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL""")
def tumbling_events(t) -> DataFrame:
    g = t("events").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return g.select(F.col("window.start").alias("hour_start"), "event_type", "n", "total")


@query("""WITH o AS (SELECT *, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL '30 minutes' OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL THEN 1 ELSE 0 END AS b FROM events),
s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM (SELECT *, 1 AS z FROM o))
SELECT user_id, min(ts) AS session_start, count(*) AS n FROM s GROUP BY user_id, session""")
def session_events(t) -> DataFrame:
    g = t("events").groupBy(F.session_window("ts", "30 minutes").alias("w"), "user_id").agg(F.count("*").alias("n"))
    return g.select("user_id", F.col("w.start").alias("session_start"), "n")


@query("""SELECT user_id, time_bucket(INTERVAL '60 seconds', ts) AS minute_start, count(*) AS requests, count(*) > 2 AS limited FROM events GROUP BY ALL""")
def rate_limit(t) -> DataFrame:
    g = t("events").groupBy(F.window("ts", "60 seconds").alias("w"), "user_id").agg(F.count("*").alias("requests"))
    return g.select("user_id", F.col("w.start").alias("minute_start"), "requests", (F.col("requests") > 2).alias("limited"))
