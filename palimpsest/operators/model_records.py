"""What a model's answers become: checked as a whole, then events, claims, obligations, entities and relations.

An answer is a row (document_id, batch, response, chunk_ids): the JSON text of one batch and the chunks it may cite.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.text import stable_id
from palimpsest.operators.enrichment import REQUIRED
from palimpsest.operators.normalize import once, spread

# Fixed value: whole or partial dates, and what is put down of a record.
DATE = r"^[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?$"
FIELDS = {
    "events": ("event_type", "title", "summary", "date_start", "date_end", "date_precision"),
    "claims": ("claim_type", "statement", "subject"),
    "obligations": ("obligation_type", "action", "deadline", "status", "responsible_party"),
    "relationships": ("source_name", "source_type", "target_name", "target_type", "relationship_type"),
}
COMMON = ("filing_id", "filing_number", "company", "project", "source_url")


@dataclass(frozen=True)
class ModelTables:
    events: DataFrame
    claims: DataFrame
    obligations: DataFrame
    entities: DataFrame
    relations: DataFrame


def _kind(x: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(x), "^[A-Z]+", 0)


def _record(kind: str):
    """A record of a kind out of a variant: object, cited, confidence and the kind's FIELDS."""

    def made(x: Column) -> Column:
        cited = F.array_distinct(F.coalesce(F.try_variant_get(x, "$.evidence_chunk_ids", "array<string>"), F.array().cast("array<string>")))
        untold = F.coalesce(_kind(F.try_variant_get(x, "$.confidence", "variant")), F.lit("VOID")) == "VOID"
        sure = F.when(untold, F.lit(0.0)).otherwise(F.try_variant_get(x, "$.confidence", "string").try_cast("double"))
        told = [F.try_variant_get(x, f"$.{c}", "string").alias(c) for c in FIELDS[kind]]
        return F.struct((_kind(x) == "OBJECT").alias("object"), cited.alias("cited"), sure.alias("confidence"), *told)

    return made


def _broken(kind: str, allowed: Column):
    """The first rule that a record breaks, null if it breaks none."""

    def rule(x: Column) -> Column:
        bare = F.lit(False)
        for c in REQUIRED[kind]:
            bare = bare | (F.trim(F.coalesce(x[c], F.lit(""))) == "")
        out = F.when(~F.coalesce(x["object"], F.lit(False)), "object").when((F.size(x["cited"]) == 0) | (F.size(F.array_except(x["cited"], allowed)) > 0), "evidence")
        out = out.when(~F.coalesce((x["confidence"] >= 0) & (x["confidence"] <= 1), F.lit(False)), "confidence").when(bare, "text")
        if kind == "events":
            for c in ("date_start", "date_end"):
                out = out.when(x[c].isNotNull() & ~x[c].rlike(DATE), "date")
        return out

    return rule


def checked_answers(answers: DataFrame) -> DataFrame:
    """``answers`` with the parsed records of each kind and ``reason``, null if the whole answer can be used.

    The first kind, in the order of REQUIRED, and in it the first record that breaks a rule decides: a response that is no
    object (response), a kind that is no array (<kind>), a record that is no object (<kind>:object), cites nothing or what its batch
    doesn't have (<kind>:evidence), has a confidence that is no number from 0 to 1 (<kind>:confidence; none is 0), lacks a
    required text (<kind>:text) or, of events, has a date of another form (<kind>:date).
    """
    rows = once(answers, _v=F.try_parse_json("response"))
    rows = once(rows, **{kind: F.transform(F.try_variant_get(F.col("_v"), f"$.{kind}", "array<variant>"), _record(kind)) for kind in REQUIRED})
    reasons = [F.when(~F.coalesce(_kind(F.col("_v")) == "OBJECT", F.lit(False)), F.lit("response"))]
    for kind in REQUIRED:
        first = F.get(F.filter(F.transform(kind, _broken(kind, F.col("chunk_ids"))), lambda r: r.isNotNull()), F.lit(0))
        is_list = F.coalesce(_kind(F.try_variant_get(F.col("_v"), f"$.{kind}", "variant")) == "ARRAY", F.lit(False))
        reasons.append(F.when(~is_list, F.lit(kind)).otherwise(F.concat(F.lit(f"{kind}:"), first)))
    return rows.withColumn("reason", F.coalesce(*reasons)).drop("_v")


def _last(rows: DataFrame) -> DataFrame:
    """One row an id: that of the last batch, and in it the last place."""
    rest = [c for c in rows.columns if c not in ("id", "_batch", "_at")]
    return rows.groupBy("id").agg(F.max_by(F.struct(*rest), F.struct("_batch", "_at")).alias("r")).select("id", "r.*")


def materialized(checked: DataFrame, chunks: DataFrame, documents: DataFrame, *, version: str) -> ModelTables:
    """The five tables of the answers of ``checked_answers`` that can be used.

    Ids are stable: of an event its document, type, title, start and evidence; of a claim or obligation its document,
    statement or action and evidence; of an entity its type and name; of a relation both entities, the type, document and
    evidence.  Evidence pages are the least first and greatest last page of the cited chunks (chunk_id, page_start,
    page_end) that are known.  Facts COMMON are those of ``documents``; all is ``unreviewed`` and says its extractor's ``version``.
    Of records with one id the last stays, by batch and place; null documents are kept, with ids of what else there is.
    No table is sent whole to the tasks: joins are by shuffles, whatever Spark takes their sides' sizes to be.
    """
    key = F.struct("document_id", "batch").alias("_key")
    known = chunks.groupBy("chunk_id").agg(F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end"))
    # all tables come from these rows, and answers are dear to read: they are read once, before a shuffle that jobs at one time share
    good = spread(checked.where("reason IS NULL").select("document_id", "batch", key, "chunk_ids", *REQUIRED), "_key").persist(StorageLevel.DISK_ONLY)
    # pages by a join over what an answer may cite, once for all tables: chunks may be any number
    may = good.select("_key", F.explode("chunk_ids").alias("chunk_id")).join(known.hint("merge"), "chunk_id").groupBy("_key")
    pages = may.agg(F.map_from_entries(F.collect_set(F.struct("chunk_id", F.struct("page_start", "page_end")))).alias("_pages"))  # a batch's chunks
    good = good.drop("chunk_ids").join(pages.hint("merge"), "_key", "left").drop("_key").persist(StorageLevel.DISK_ONLY)
    facts = documents.select("document_id", *COMMON).dropDuplicates(["document_id"]).hint("merge")

    def of(kind: str) -> DataFrame:
        each = good.select("document_id", F.col("batch").alias("_batch"), "_pages", F.posexplode(kind).alias("_at", "x")).select("document_id", "_batch", "_at", "_pages", "x.*")
        page = lambda field: F.transform("cited", lambda c: F.try_element_at("_pages", c)[field])
        each = each.withColumns({"evidence_page_start": F.array_min(page("page_start")), "evidence_page_end": F.array_max(page("page_end"))}).drop("_pages", "object")
        return each.withColumnRenamed("cited", "evidence_chunk_ids").withColumns({"review_status": F.lit("unreviewed"), "extractor_version": F.lit(version)})

    def told(rows: DataFrame, *names: str) -> DataFrame:
        """The last row of each id, with the facts ``names`` of its document."""
        last = _last(rows)
        return last.join(facts, "document_id", "left").select(*last.columns, *names)

    def ident(prefix: str, *parts: str) -> Column:
        """Parts that are blank don't count; letters without case."""
        every = F.concat(*(F.array(F.coalesce(F.col(p), F.lit(""))) if p != "evidence_chunk_ids" else F.col(p) for p in parts))
        clean = F.filter(F.transform(every, lambda p: F.lower(F.trim(p))), lambda p: p != "")
        return F.concat(F.lit(f"{prefix}:"), F.substring(F.sha2(F.array_join(clean, "\x1f"), 256), 1, 24))

    evidence = "evidence_chunk_ids"
    events = of("events").withColumn("id", ident("event", "document_id", "event_type", "title", "date_start", evidence))
    events = events.withColumns({"date_basis": F.lit("occurrence_date"), "chunk_id": F.get(evidence, F.lit(0)), "page_start": F.col("evidence_page_start"), "page_end": F.col("evidence_page_end")})
    claims = of("claims").withColumn("id", ident("claim", "document_id", "statement", evidence))
    obligations = of("obligations").withColumn("id", ident("obligation", "document_id", "action", evidence))
    typed = lambda side: F.concat(F.col(f"{side}_type"), F.lit(":"), F.substring(stable_id("x", F.col(f"{side}_name")), 3, 24))
    relations = of("relationships").withColumns({"source_id": typed("source"), "target_id": typed("target")})
    relations = relations.withColumn("id", ident("relation", "source_id", "relationship_type", "target_id", "document_id", evidence))
    side = lambda s, at: F.struct(F.col(f"{s}_id").alias("id"), F.col(f"{s}_type").alias("entity_type"), F.col(f"{s}_name").alias("name"), F.lit(at).alias("side"))
    ends = relations.select("_batch", "_at", "document_id", F.explode(F.array(side("source", 0), side("target", 1))).alias("e")).select("e.id", "e.entity_type", "e.name", "document_id", "_batch", F.struct("document_id", "_at", "e.side").alias("_at"))
    entities = told(ends, "source_url").drop("document_id").withColumns({"aliases": F.array().cast("array<string>"), "external_ids": F.create_map().cast("map<string,string>")})
    return ModelTables(*(told(x, *COMMON) for x in (events, claims, obligations)), entities, told(relations.drop("source_name", "source_type", "target_name", "target_type"), *COMMON))
