"""Chunks and their provenance as wide search documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields of a search document, by what they hold.
TEXTS = ("chunk_type", "title", "content", "heading", "filing_date", "submitter", "company", "project", "filing_number", "source_url", "resolved_url", "file_path", "file_sha256", "analyzer_id", "api_version", "normalizer_version", "table_id", "figure_id", "azure_figure_id")
NUMBERS = ("chunk_index", "page_start", "page_end", "content_index", "word_count", "table_part", "table_row_start", "table_row_end")
LISTS = ("section_path", "application_types", "commodities", "document_types", "file_types", "roles")
FIELDS = ("key", "chunk_id", "document_id", "filing_id", *TEXTS, *NUMBERS, *LISTS, "element_paths", "local_element_paths")
#: An element of a chunk's evidence; a figure's have children of their own, which have none.
CHILD = "struct<element:string,local_element:string>"
ELEMENTS = f"array<struct<element:string,local_element:string,child_elements:array<{CHILD}>>>"


def strings(col: Column) -> Column:
    """The strings of a list that aren't empty; an empty list for null."""
    return F.filter(F.coalesce(col, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))


def paths(elements: Column, field: str) -> Column:
    """The distinct paths of elements and their children, each before its children, as they first come."""
    own = lambda e: F.concat(F.array(e[field]), F.coalesce(F.transform(e["child_elements"], lambda c: c[field]), F.array().cast("array<string>")))
    return F.array_distinct(F.array_compact(F.coalesce(F.flatten(F.transform(F.filter(elements, lambda e: e.isNotNull()), own)), F.array().cast("array<string>"))))


def search_documents(chunks: DataFrame, provenance: DataFrame, *, public_url: str | None = None, vectors: DataFrame | None = None) -> DataFrame:
    """One row of FIELDS for every chunk, and with ``vectors`` (chunk_id, vector) url, citation_title and content_vector too.

    ``chunks`` has id and any of the other fields, what it lacks is null (an empty list of LISTS); ``provenance`` is
    (chunk_id, elements: ELEMENTS), of several rows of a chunk the greatest counts, a chunk without any has no
    paths.  ``key`` is the digest of the id.  ``url`` leads to the chunk's evidence under ``public_url``, or is its source's;
    the title is the heading's, else the document's, else its number.  Chunks without an id are left out; an id that
    comes twice gives two rows of one key.
    """
    have = dict(chunks.dtypes)
    of = lambda c, kind: F.col(c).cast(kind) if c in have else F.lit(None).cast(kind)
    own = provenance.select("chunk_id", "elements").groupBy("chunk_id").agg(F.max("elements").alias("_elements"))
    rows = chunks.where("id IS NOT NULL").withColumn("_id", F.col("id").cast("string"))
    rows = rows.join(own.withColumnRenamed("chunk_id", "_id"), "_id", "left")
    picked = {
        "key": F.sha2("_id", 256), "chunk_id": F.col("_id"), "document_id": F.coalesce(of("document_id", "string"), F.lit("")), "filing_id": of("filing_id", "string"),
        **{c: of(c, "string") for c in TEXTS}, **{c: of(c, "int") for c in NUMBERS}, **{c: strings(of(c, "array<string>")) for c in LISTS},
        "element_paths": paths(F.col("_elements"), "element"), "local_element_paths": paths(F.col("_elements"), "local_element"),
    }
    out = rows.select(*(picked[c].alias(c) for c in FIELDS))
    if vectors is None:
        return out
    base = (public_url or "").strip().rstrip("/")
    said = lambda c: F.nullif(F.col(c), F.lit(""))
    url = F.concat(F.lit(f"{base}/evidence/"), "chunk_id") if base else F.col("source_url")
    title = F.coalesce(said("heading"), said("title"), F.concat(F.lit("Document "), "document_id"))
    known = vectors.groupBy("chunk_id").agg(F.any_value("vector").alias("content_vector"))
    return out.withColumns({"url": url, "citation_title": title}).join(known, "chunk_id", "left").select(*FIELDS, "url", "citation_title", "content_vector")
