"""Entities, relations and events derived from document rows, and what a model's answers become."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.text import stable_id

# Fixed value: what each kind of model record must say.
REQUIRED = {
    "events": ("event_type", "title", "summary", "date_start"),
    "claims": ("claim_type", "statement"),
    "obligations": ("obligation_type", "action"),
    "relationships": ("source_name", "source_type", "target_name", "target_type", "relationship_type"),
}
FIELDS = ("title", "source_url", "filing_id", "filing_number", "filing_date", "company", "company_id", "submitter", "project")


def said(col: Column) -> Column:
    return F.nullif(F.trim(col.cast("string")), F.lit(""))


def identified(documents: DataFrame) -> DataFrame:
    """``documents`` (document_id and FIELDS) with blanks as nulls and the ids of the entities that each speaks of."""
    rows = documents.select(F.col("document_id").cast("string").alias("document_id"), *(said(F.col(c)).alias(c) for c in FIELDS))
    filing = F.when(F.col("filing_id").isNotNull(), F.concat(F.lit("filing:"), "filing_id")).when(F.col("filing_number").isNotNull(), stable_id("filing", F.col("filing_number")))
    named = {"company_entity": ("organization", "company"), "submitter_entity": ("organization", "submitter"), "project_entity": ("project", "project")}
    return rows.withColumns(
        {"document_entity": F.concat(F.lit("document:"), "document_id"), "filing_entity": filing}
        | {k: F.when(F.col(c).isNotNull(), stable_id(kind, F.col(c))) for k, (kind, c) in named.items()}
    )


def observed_entities(documents: DataFrame) -> DataFrame:
    """(id, entity_type, name, aliases, external_ids, source_url, document_id, at): every entity as each document shows it."""
    d = identified(documents)
    none = F.create_map().cast("map<string,string>")
    ids = lambda **kv: F.map_filter(F.create_map(*(x for k, v in kv.items() for x in (F.lit(k), v))), lambda _, v: v.isNotNull())
    title = F.coalesce("title", F.concat(F.lit("Document "), "document_id"))
    filing_name = F.coalesce("filing_number", F.concat(F.lit("Filing "), "filing_id"))
    alias = F.concat(F.lit("Filing "), "filing_id")
    aliases = F.when(alias.isNotNull() & (alias != filing_name), F.array(alias)).otherwise(F.array().cast("array<string>"))
    kinds = [
        ("document_entity", "document", title, F.array().cast("array<string>"), ids(document_id=F.col("document_id")), F.col("source_url")),
        ("filing_entity", "filing", filing_name, aliases, ids(filing_id=F.col("filing_id"), filing_number=F.col("filing_number")), F.col("source_url")),
        ("company_entity", "organization", F.col("company"), F.array().cast("array<string>"), ids(company_id=F.col("company_id")), F.lit(None).cast("string")),
        ("submitter_entity", "organization", F.col("submitter"), F.array().cast("array<string>"), none, F.lit(None).cast("string")),
        ("project_entity", "project", F.col("project"), F.array().cast("array<string>"), none, F.lit(None).cast("string")),
    ]
    names = ("id", "entity_type", "name", "aliases", "external_ids", "source_url")
    rows = [
        F.struct(*(c.alias(n) for n, c in zip(names, (F.col(k), F.lit(t), *rest))), F.lit(at).alias("at")) for at, (k, t, *rest) in enumerate(kinds)
    ]
    each = d.select("document_id", F.explode(F.array(*rows)).alias("e")).where("e.id IS NOT NULL")
    return each.select("e.*", "document_id")


def merged_entities(observed: DataFrame, *order: str) -> DataFrame:
    """One row an entity: the first name in ``order``, all aliases, external ids of later rows over earlier, the first url.

    What ids a key of an entity has is reduced per key before the entity is put together, so an entity of many
    documents is never held as the list of them.
    """
    at = F.struct(*order)
    base = observed.groupBy("id").agg(
        F.min_by(F.struct("entity_type", "name"), at).alias("first"),
        F.min_by("source_url", F.when(F.col("source_url").isNotNull(), at)).alias("source_url"),
        F.count("*").alias("observations"),
    )
    aliases = observed.select("id", F.explode("aliases").alias("alias")).distinct().groupBy("id").agg(F.array_sort(F.collect_list("alias")).alias("aliases"))
    known = observed.select("id", at.alias("at"), F.explode("external_ids").alias("k", "v")).groupBy("id", "k").agg(F.max_by("v", "at").alias("v"))
    external = known.groupBy("id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("external_ids"))
    out = base.join(aliases, "id", "left").join(external, "id", "left")
    empty = F.array().cast("array<string>")
    return out.select("id", "first.entity_type", "first.name", F.coalesce("aliases", empty).alias("aliases"), F.coalesce("external_ids", F.create_map().cast("map<string,string>")).alias("external_ids"), "source_url", "observations")


def derived_relations(documents: DataFrame) -> DataFrame:
    """(id, source_id, target_id, relationship_type, document_id): the six kinds of edges, each where both ends are known, once an id.

    Rows of documents, which are far shorter than their edges, are dealt by document.  An id ends with the document's,
    so only edges of documents told by several rows (or without an id) can be alike and are compared.
    """
    key = F.substring_index(F.lower(F.trim(F.col("document_id"))), "\x1f", -1)
    rows = documents.select(F.col("document_id").cast("string").alias("document_id"), *FIELDS).withColumn("_key", key)
    # rows without an id count twice, in the sum: as a condition of its own Spark would test it in one branch before the shuffle, and shuffle for each
    weight = F.when(F.col("_key") != "", 1).otherwise(2)
    rows = rows.withColumn("_alone", F.sum(weight).over(Window.partitionBy("_key")) == 1)
    return _edges(rows.where("_alone")).unionByName(_edges(rows.where("NOT _alone")).dropDuplicates(["id"]))


def _edges(documents: DataFrame) -> DataFrame:
    d = identified(documents)
    kinds = [
        ("filing_entity", "CONTAINS", "document_entity"), ("document_entity", "RELATES_TO", "company_entity"), ("filing_entity", "RELATES_TO", "company_entity"),
        ("submitter_entity", "SUBMITTED", "document_entity"), ("document_entity", "CONCERNS", "project_entity"), ("filing_entity", "CONCERNS", "project_entity"),
    ]
    rows = F.array(*(F.struct(F.col(s).alias("source_id"), F.lit(k).alias("relationship_type"), F.col(t).alias("target_id")) for s, k, t in kinds))
    each = d.select("document_id", F.explode(rows).alias("r")).where("r.source_id IS NOT NULL AND r.target_id IS NOT NULL")
    ident = stable_id("relation", F.col("r.source_id"), F.col("r.relationship_type"), F.col("r.target_id"), F.col("document_id"))
    return each.select(ident.alias("id"), "r.source_id", "r.target_id", "r.relationship_type", "document_id")


def filing_events(documents: DataFrame) -> DataFrame:
    """(id, event_type, title, summary, date_start, date_end, date_precision, entity_ids, document_id, confidence, review_status) of dated documents."""
    d = identified(documents).where("filing_date IS NOT NULL")
    title = F.coalesce("title", F.concat(F.lit("Document "), "document_id", F.lit(" filed")))
    ends = F.array_distinct(F.array_compact(F.array("document_entity", "filing_entity", "company_entity", "submitter_entity", "project_entity")))
    return d.select(
        stable_id("event", F.lit("filing_activity"), F.col("document_id"), F.col("filing_date")).alias("id"), F.lit("filing_activity").alias("event_type"), title.alias("title"),
        F.concat(title, F.lit(" was filed on "), "filing_date", F.lit(".")).alias("summary"), F.col("filing_date").alias("date_start"), F.col("filing_date").alias("date_end"),
        F.lit("day").alias("date_precision"), ends.alias("entity_ids"), "document_id", F.lit(1.0).alias("confidence"), F.lit("not_required").alias("review_status"),
    )


def used_entities(entities: DataFrame, relations: DataFrame, filtered: bool) -> DataFrame:
    """All entities, or of a filtered set of documents those at the end of a relation."""
    if not filtered:
        return entities
    ends = relations.select(F.explode(F.array("source_id", "target_id")).alias("id")).distinct()
    return entities.join(ends, "id", "left_semi")


def merged_ledgers(derived: DataFrame, model: DataFrame, key: str = "id") -> DataFrame:
    """The model's record of a key instead of the derived one, whole; both have the same columns."""
    both = derived.withColumn("_p", F.lit(0)).unionByName(model.withColumn("_p", F.lit(1)))
    rest = [c for c in derived.columns if c != key]
    return both.groupBy(key).agg(F.max_by(F.struct(*rest), "_p").alias("r")).select(key, *(F.col(f"r.{c}").alias(c) for c in rest))


def type_counts(*tables: tuple[str, DataFrame, str]) -> DataFrame:
    """(table, type, n) of (name, rows, column of the type)."""
    out = None
    for name, rows, kind in tables:
        own = rows.groupBy(F.col(kind).alias("type")).agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "type", "n")
        out = own if out is None else out.unionByName(own)
    return out


def extraction_batches(chunks: DataFrame, *, most_chunks: int, most_characters: int, size: Column) -> DataFrame:
    """(run, batch, document_id, n, characters, chunk_ids) of chunks (document_id, pos, chunk_id, content).

    A run is a stretch of rows of one document in the order of ``pos``; a batch ends before a chunk that
    would exceed either bound.  Runs are told by the row before: rows are dealt by ranges of ``pos`` in
    blocks of ``BLOCK`` positions, so that no task sees all rows.
    """
    from palimpsest.operators.sequences import batch_numbers

    kept = chunks.where("trim(coalesce(document_id, '')) <> '' AND trim(coalesce(content, '')) <> ''").select("document_id", "pos", "chunk_id", size.cast("long").alias("size"))
    rows = ranked(kept, "pos")
    before = rows.select((F.col("at") + 1).alias("at"), F.col("document_id").alias("before"))
    marked = rows.join(before, "at", "left").withColumn("opens", ~F.col("document_id").eqNullSafe(F.col("before")))
    # the run of a row: the place of the last row of its document at or before it that opens one
    last = Window.partitionBy("document_id").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    runs = marked.withColumn("run", F.max(F.when(F.col("opens"), F.col("at"))).over(last))
    units = runs.groupBy("run", "document_id").agg(F.array_sort(F.collect_list(F.struct("at", "size", "chunk_id"))).alias("us"))  # a document's chunks
    numbered = units.withColumn("batches", batch_numbers(F.transform("us", lambda u: u["size"]), F.lit(most_chunks), F.lit(most_characters)))
    each = numbered.select("run", "document_id", F.explode(F.arrays_zip("us", "batches")).alias("z")).select("run", "document_id", F.col("z.batches").alias("batch"), F.col("z.us").alias("u"))
    return each.groupBy("run", "batch", "document_id").agg(
        F.count("*").alias("n"), F.sum("u.size").alias("characters"), F.array_sort(F.collect_list(F.struct("u.at", "u.chunk_id"))).alias("ids")
    ).select("run", "batch", "document_id", "n", "characters", F.transform("ids", lambda x: x["chunk_id"]).alias("chunk_ids"))


def ranked(rows: DataFrame, order: str, width: int = 100_000) -> DataFrame:
    """Add ``at``: 0, 1, ... in ``order`` (a number without ties), counted by blocks of its values."""
    rows = rows.withColumn("_block", F.floor(F.col(order) / width))
    sizes = rows.groupBy("_block").agg(F.count("*").alias("_n"))
    ahead = sizes.select("_block", F.coalesce(F.sum("_n").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"))  # a row a block
    own = F.row_number().over(Window.partitionBy("_block").orderBy(order)) - 1
    return rows.withColumn("_own", own).join(ahead, "_block").withColumn("at", F.col("_own") + F.col("_ahead")).drop("_own", "_ahead", "_block")


def evidence_pages(records: DataFrame, chunks: DataFrame, key: str) -> DataFrame:
    """(key, page_start, page_end): least first and greatest last page of the chunks that a record cites in ``cited``."""
    each = records.select(key, F.explode_outer("cited").alias("chunk_id"))
    pages = each.join(chunks.select("chunk_id", "page_start", "page_end"), "chunk_id", "left")
    return pages.groupBy(key).agg(F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end"))


def materialized_relations(records: DataFrame) -> DataFrame:
    """Relations of model records (document_id, source_name, source_type, target_name, target_type, relationship_type, cited): both ends' ids and the relation's."""
    typed = lambda kind, name: F.concat(kind, F.lit(":"), F.substring(stable_id("x", name), 3, 24))
    rows = records.withColumns({"source_id": typed(F.col("source_type"), F.col("source_name")), "target_id": typed(F.col("target_type"), F.col("target_name"))})
    parts = F.concat(F.array("source_id", "relationship_type", "target_id", "document_id"), "cited")
    clean = F.filter(F.transform(parts, lambda p: F.lower(F.trim(p))), lambda p: p != "")
    ident = F.concat(F.lit("relation:"), F.substring(F.sha2(F.array_join(clean, "\x1f"), 256), 1, 24))
    return rows.withColumn("id", ident).withColumn("review_status", F.lit("unreviewed"))


def cached_requests(wanted: DataFrame, cache: DataFrame, keys: tuple[str, ...] = ("request_hash", "model", "prompt_version")) -> DataFrame:
    """``wanted`` with ``response`` from the cache (null where it must be asked for); the cache's latest row of a key counts."""
    latest = cache.groupBy(*keys).agg(F.max_by("response", "cached_at").alias("response"))
    return wanted.join(latest, list(keys), "left")


def embedding_plan(chunks: DataFrame, cache: DataFrame, *, model: str, dimensions: int, most: int = 24_000) -> DataFrame:
    """Add content_sha256, vector and state: cached, missing, empty or oversized, by (chunk_id, content hash, model, dimensions)."""
    text = F.trim(F.coalesce("content", F.lit("")))
    rows = chunks.withColumn("content_sha256", F.sha2(text, 256))
    known = cache.where((F.col("model") == model) & (F.size("vector") == dimensions)).groupBy("chunk_id", "content_sha256").agg(F.any_value("vector").alias("vector"))
    joined = rows.join(known, ["chunk_id", "content_sha256"], "left")
    state = F.when(text == "", "empty").when(F.length(text) > most, "oversized").when(F.col("vector").isNotNull(), "cached").otherwise("missing")
    return joined.withColumn("state", state)


def embedding_counters(plan: DataFrame) -> DataFrame:
    """(selected, cached, missing, empty, oversized, characters) of an embedding plan."""
    count = lambda s: F.count_if(F.col("state") == s).alias(s)
    return plan.agg(F.count("*").alias("selected"), *map(count, ("cached", "missing", "empty", "oversized")), F.sum(F.length(F.trim(F.coalesce("content", F.lit(""))))).alias("characters"))


def request_key(**parts: Column) -> Column:
    """SHA-256 of a request's parts as JSON with sorted names."""
    named = F.struct(*(v.alias(k) for k, v in sorted(parts.items())))
    return F.sha2(F.to_json(named, {"ignoreNullFields": "false"}), 256)
