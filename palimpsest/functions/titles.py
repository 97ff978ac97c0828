"""Labels, titles and file types of records: what a registry page shows, as stable fields."""

from __future__ import annotations

import io
import struct
import zipfile
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.functions.text import clean_text

# Fields of displayed labels, of facet categories, and identifiers in titles.
FIELD_ALIASES = {
    "title": "title", "document title": "title", "name": "title", "date": "date", "document date": "date", "filing date": "filing_date",
    "submitted": "filing_date", "submission date": "filing_date", "submitter": "submitter", "submitted by": "submitter", "company": "company",
    "organization": "organization", "organisation": "organization", "applicant": "applicant", "project": "project", "filing": "filing_number",
    "filing number": "filing_number", "filing no": "filing_number", "filing id": "filing_id", "document type": "document_type",
    "application type": "application_type", "file type": "file_type", "role": "role", "commodity": "commodity", "language": "language",
    "pages": "page_count", "page count": "page_count", "number of pages": "page_count", "description": "description", "subject": "subject",
    "author": "author", "contact": "contact", "hearing order": "hearing_order", "docket": "docket", "status": "regulatory_status",
}
FACET_FIELDS = {"Document Type": "document_types", "Application Type": "application_types", "File Type": "file_types", "Role": "roles", "Commodity": "commodities"}
FILING = r"(?i)\b(C\d{4,})(?:-(\d{1,4}))?\b"
EXHIBIT = r"(?i)\b(A(?=[0-9A-Z]{5,}\b)(?=[0-9A-Z]*\d)[0-9A-Z]{5,})\b"
REGULATORY_ID = r"(?i)\b((?:AO|GO|GPSO|EPR|MO|RO|XG|GC|GH|OH|MH|RH|OF|OM)[A-Z0-9]*(?:-[A-Z0-9]+)+)\b"
ACTIVITY = r"(?i)\b([A-Z]{2,8}(?:-[A-Z]{2,8})*[- ]?\d{2,4}(?:-\d{1,4})+)\b"
INSTRUMENTS = ("AO-", "GO-", "GPSO-", "EPR-", "MO-", "RO-")
INSTRUMENT_PARTS = ("ORDER", "GPSO", "AO-", "GO-")
FRENCH = r"(?iu)(?:^|\s|[-–—_/])(FR|FRENCH|FRANÇAIS)(?:\s|[-–—_/]|$)"
ENGLISH = r"(?iu)(?:^|\s|[-–—_/])(EN|ENGLISH|ANGLAIS)(?:\s|[-–—_/]|$)"
CONTAINERS = ("compound document", "folder")
PAPER_ONLY = ("paper only", "papier seulement")
NO_RESULTS = r"(?iu)no\s+(?:items?|results?|records?|documents?)\s+(?:(?:were|are)\s+)?(?:found|available)|there\s+(?:are|were)\s+no\s+(?:items?|results?|records?|documents?)|no\s+(?:items?|results?|records?|documents?)\s+to\s+display|aucun(?:e)?\s+(?:élément|résultat|document)(?:\s+n['’]a\s+été\s+trouvé)?"
REGULATOR_WORDS = r"\b(commission|board|cer|regulator|regulatory|finding|decision|determination|conclusion)\b"
OUTSTANDING_WORDS = r"\b(outstanding|open|pending|incomplete|not complete|not completed|due|overdue)\b"


def slug(col: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(clean_text(col)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def facet_field(col: Column) -> Column:
    """The field of a facet category: a known one, else its slug with underscores."""
    return F.coalesce(*(F.when(col == k, F.lit(v)) for k, v in FACET_FIELDS.items()), F.replace(slug(col), F.lit("-"), F.lit("_")))


def normalized_label(col: Column) -> Column:
    """A label for look-up: lower case, no closing colons or brackets, one space between words."""
    low = F.regexp_replace(F.lower(clean_text(col)), ":+$", "")
    return clean_text(F.regexp_replace(low, "[^a-z0-9]+", " "))


def canonical_field(col: Column) -> Column:
    """The stable field that a label stands for; null if it is none that is known."""
    label = normalized_label(col)
    known = F.create_map(*(F.lit(x) for kv in FIELD_ALIASES.items() for x in kv))
    rules = (
        (label.startswith("filing number"), "filing_number"), (label.startswith("document type"), "document_type"),
        (label.startswith("application type"), "application_type"), (label.endswith(" page count"), "page_count"),
    )
    return F.coalesce(F.try_element_at(known, label), *(F.when(c, F.lit(v)) for c, v in rules))


def page_title(col: Column, prefixes: tuple[str, ...]) -> Column:
    """A page's title without the site's names before it; null if nothing is left."""
    named = [r"\s*-\s*".join(f"\\Q{x}\\E" for x in p.split(" - ")) for p in prefixes]
    return F.nullif(clean_text(reduce(lambda c, p: F.regexp_replace(c, rf"(?i)^{p}\s*-\s*", ""), named, clean_text(col))), F.lit(""))


def title_language(col: Column) -> Column:
    """fr or en if a title has such a mark of its own; French is looked for first."""
    return F.when(clean_text(col).rlike(FRENCH), "fr").when(clean_text(col).rlike(ENGLISH), "en")


def title_identifiers(col: Column) -> Column:
    """Array of (type, value, confidence) in a title; of equal types and values the first stays."""
    text = clean_text(col)
    one = lambda kind, value, sure: F.struct(kind.alias("type"), value.alias("value"), F.lit(sure).alias("confidence"))
    every = lambda pattern: F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda x: F.upper(x))
    starts = lambda v, marks: reduce(lambda a, b: a | b, (v.startswith(m) for m in marks))
    holds = lambda v, marks: reduce(lambda a, b: a | b, (v.contains(m) for m in marks))
    kind = lambda instrument: F.when(instrument, "regulatory_instrument_number").otherwise("activity_number")
    activities = F.filter(F.transform(every(ACTIVITY), lambda v: F.replace(v, F.lit(" "), F.lit("-"))), lambda v: ~v.rlike(r"^C[-\d]*\d[-\d]*$"))
    found = F.concat(
        F.array(one(F.lit("filing_number"), F.upper(F.regexp_extract(text, FILING, 1)), 0.99), one(F.lit("filing_sequence"), F.regexp_extract(text, FILING, 2), 0.99)),
        F.transform(every(EXHIBIT), lambda v: one(F.lit("exhibit_number"), v, 0.98)),
        F.transform(every(REGULATORY_ID), lambda v: one(kind(starts(v, INSTRUMENTS)), v, 0.97)),
        F.transform(activities, lambda v: one(kind(holds(v, INSTRUMENT_PARTS)), v, 0.95)),
        F.array(one(F.lit("language_marker"), F.coalesce(title_language(text), F.lit("")), 1.0)),
    )
    found = F.filter(found, lambda x: x["value"] != "")
    key = lambda x: F.concat(x["type"], F.lit("="), x["value"])
    # through a lambda, so that the identifiers are made once
    first = lambda every_: F.filter(every_, lambda x, i: F.array_position(F.transform(every_, key), key(x)) == i + 1)
    return F.element_at(F.transform(F.array(found), first), 1)


def is_container(col: Column) -> Column:
    return F.lower(clean_text(col)).isin(*CONTAINERS)


def is_paper_only(col: Column) -> Column:
    return reduce(lambda a, b: a | b, (F.lower(clean_text(col)).contains(x) for x in PAPER_ONLY))


def is_known_html(kind: Column, extension: Column, mime: Column) -> Column:
    """Whether kind, extension or media type say that it is a web page."""
    base = F.lower(F.trim(F.substring_index(F.coalesce(mime, F.lit("")), ";", 1)))
    return F.lower(F.coalesce(kind, F.lit(""))).isin("html", "web page") | F.lower(F.coalesce(extension, F.lit(""))).isin(".html", ".htm", ".xhtml") | base.isin("text/html", "application/xhtml+xml")


def search_recognized(html: Column) -> Column:
    """A search page: one with a table body, a reported total, or words that say there are no rows."""
    from palimpsest.functions.text import reported_total

    text = clean_text(F.regexp_replace(F.coalesce(html, F.lit("")), "<[^>]*>", " "))
    return html.isNotNull() & (html.rlike(r"(?i)<tbody[\s>]") | reported_total(html).isNotNull() | text.rlike(NO_RESULTS))


def is_regulator_claim(kind: Column, claimant: Column) -> Column:
    return F.lower(F.concat_ws(" ", kind, F.coalesce(claimant, F.lit("")))).rlike(REGULATOR_WORDS)


def is_outstanding(status: Column) -> Column:
    return F.lower(F.coalesce(status, F.lit(""))).rlike(OUTSTANDING_WORDS)


def row_id(container: Column, item: Column, name: Column, row_text: Column, paper: Column) -> Column:
    """A stable id of a row that has no unique one: its exhibit number, else a hash of what it says."""
    both = clean_text(F.concat_ws(" ", name, row_text))
    exhibit = F.nullif(F.upper(F.regexp_extract(both, EXHIBIT, 1)), F.lit(""))
    print_ = F.substring(F.sha2(F.lower(clean_text(F.concat_ws("|", item, name, row_text))), 256), 1, 16)
    return F.concat(F.when(paper, "paper").otherwise("container-row"), F.lit(":"), container, F.lit(":"), F.coalesce(exhibit, print_))


def row_id_suffix(name: Column, row_text: Column) -> Column:
    """What is put behind an id that is taken."""
    return F.substring(F.sha2(clean_text(F.concat_ws(" ", name, row_text)), 256), 1, 8)


# File types by their first bytes (hex), and by extension.
MAGIC = (
    ("255044462D", ".pdf", "application/pdf"), ("89504E470D0A1A0A", ".png", "image/png"), ("FFD8FF", ".jpg", "image/jpeg"), ("474946383761", ".gif", "image/gif"),
    ("474946383961", ".gif", "image/gif"), ("49492A00", ".tif", "image/tiff"), ("4D4D002A", ".tif", "image/tiff"), ("7B5C727466", ".rtf", "application/rtf"),
)
OFFICE = "application/vnd.openxmlformats-officedocument."
ZIP_MEMBERS = (
    ("word/document.xml", ".docx", OFFICE + "wordprocessingml.document"), ("xl/workbook.xml", ".xlsx", OFFICE + "spreadsheetml.sheet"),
    ("ppt/presentation.xml", ".pptx", OFFICE + "presentationml.presentation"),
)
EXTENSIONS = {"application/pdf": ".pdf", "text/html": ".html", "text/plain": ".txt", "text/csv": ".csv", "image/png": ".png", "image/jpeg": ".jpg", "image/gif": ".gif", "image/tiff": ".tiff", "application/zip": ".zip", "application/json": ".json", "application/msword": ".doc"}


@F.pandas_udf(T.ArrayType(T.StringType()))
def zip_members(contents: pd.Series) -> pd.Series:
    """Names in the directory at a zip's end; null of anything that has none, and of null."""

    def names(raw: bytes | None) -> list[str] | None:
        try:
            return None if raw is None else zipfile.ZipFile(io.BytesIO(raw)).namelist()
        except (zipfile.BadZipFile, OSError, ValueError, NotImplementedError, struct.error):
            return None

    return contents.map(names).astype(object)


def file_type(content: Column, media_type: Column, filename: Column, catalogue: Column) -> Column:
    """(extension, mime, method, confidence) by magic, zip members, markup, media type, file name, catalogue, in this order.

    Members of a zip are those of its directory, so a name within a stored text is none; bytes that begin like a zip
    and have no readable directory are judged by the steps behind it.
    """
    hexed = F.hex(F.substring(content, 1, 16))
    text = F.lower(F.decode(F.regexp_replace(F.decode(F.substring(content, 1, 4096), "ISO-8859-1"), r"^\s+", "").cast("binary"), "ISO-8859-1"))
    kind = lambda ext, mime, how, sure: F.struct(F.lit(ext).alias("extension") if isinstance(ext, str) else ext.alias("extension"), F.lit(mime).alias("mime") if isinstance(mime, str) else mime.alias("mime"), F.lit(how).alias("method"), F.lit(sure).alias("confidence"))
    mime = F.lower(F.trim(F.substring_index(F.coalesce(media_type, F.lit("")), ";", 1)))
    by_mime = F.coalesce(*(F.when(mime == m, F.lit(e)) for m, e in EXTENSIONS.items()), F.lit(".bin"))
    suffix = F.lower(F.regexp_extract(F.coalesce(filename, F.lit("")), r"(\.[^./\s]+)$", 1))
    by_suffix = F.coalesce(*(F.when(suffix == e, F.lit(m)) for m, e in EXTENSIONS.items()), F.lit("application/octet-stream"))
    known = F.lower(F.coalesce(catalogue, F.lit("")))
    members = zip_members(F.when(hexed.startswith("504B0304"), content))
    zipped = members.isNotNull()
    ladder = [(hexed.startswith(h), kind(e, m, "magic", 1.0)) for h, e, m in MAGIC]
    ladder += [(zipped & F.array_contains(members, name), kind(e, m, "zip-signature", 1.0)) for name, e, m in ZIP_MEMBERS]
    ladder += [
        (zipped, kind(".zip", "application/zip", "zip-signature", 0.95)),
        (text.startswith("<!doctype html") | F.substring(text, 1, 1024).contains("<html") | F.substring(text, 1, 1024).contains("<body"), kind(".html", "text/html", "magic", 0.99)),
        (mime == "application/xhtml+xml", kind(".xhtml", "application/xhtml+xml", "content-type", 0.85)),
        (~mime.isin("", "application/octet-stream", "binary/octet-stream"), kind(by_mime, mime, "content-type", 0.8)),
        (suffix != "", kind(suffix, by_suffix, "filename", 0.65)),
        (known.contains("pdf"), kind(".pdf", "application/pdf", "catalogue-kind", 0.55)),
        (known.contains("html"), kind(".html", "text/html", "catalogue-kind", 0.55)),
    ]
    return F.coalesce(*(F.when(c, v) for c, v in ladder), kind(".bin", "application/octet-stream", "fallback", 0.0))


def download_problem(content: Column, found: Column, catalogue: Column) -> Column:
    """Why a downloaded file can't be used; null if it can."""
    return (
        F.when(content.isNull(), "missing").when(F.length(content) == 0, "empty")
        .when(F.lower(F.coalesce(catalogue, F.lit(""))).contains("pdf") & (found["extension"] != ".pdf"), "CATALOGUE_TYPE_MISMATCH")
        .when((found["extension"] == ".pdf") & ~F.hex(F.substring(content, 1, 5)).startswith("255044462D"), "not a PDF")
    )
