"""Registered queries of the scalar functions: every function over texts made of the given tables."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions import text as fn
from palimpsest.functions import titles
from palimpsest.plans.documents import query


def chosen(key: str, *options: str):
    """One of the texts by the key."""
    return F.coalesce(*(F.when(F.col(key) % len(options) == k, F.lit(v)) for k, v in enumerate(options)))


def zipped(*names: str, said: bytes = b"x") -> str:
    """A zip with these members, unpacked, in hex."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
        for name in names:
            archive.writestr(zipfile.ZipInfo(name), said)
    return out.getvalue().hex()


def by_key(key: str, **pairs: tuple[str, object]):
    """SQL of what is expected of each option, told plainly: {name: (options, expected values)}."""
    out = []
    for name, expected in pairs.items():
        told = " ".join(f"WHEN {k} THEN " + ("NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'") for k, v in enumerate(expected))
        out.append(f"CASE {key} % {len(expected)} {told} END AS {name}")
    return ", ".join(out)


_LABELS = ("Filing No.:", "  Document Title ", "[Company]", "Submitted  By:", "Filing Number (old)", "Total Page Count", "Nothing known", "ORGANISATION", "Date")


@query("SELECT p_partkey, " + by_key("p_partkey", normalized=("filing no", "document title", "company", "submitted by", "filing number old", "total page count", "nothing known", "organisation", "date"),
    field=("filing_number", "title", "company", "submitter", "filing_number", "page_count", None, "organization", "date"),
    slug=("filing-no", "document-title", "company", "submitted-by", "filing-number-old", "total-page-count", "nothing-known", "organisation", "date")) + " FROM part")
def labels_to_fields(t) -> DataFrame:
    label = chosen("p_partkey", *_LABELS)
    return t("part").select("p_partkey", titles.normalized_label(label).alias("normalized"), titles.canonical_field(label).alias("field"), titles.slug(label).alias("slug"))


_TITLES = (
    "Acme - Records - C12345-2 Exhibit A7Z9Q1 - EN", "records of order XG-E101-003-2020 - FR", "Notice OF-Fac-Gas-N081-2012-10 02", "Hearing GH-001-2018 and GH-001-2018", "A12345", "plain title",
    "C00456 AO-001-2019 Français", "Commission letter ABC-DE 12-345",
)
_FOUND = (
    "filing_number=C12345,filing_sequence=2,exhibit_number=A7Z9Q1,language_marker=en", "activity_number=XG-E101-003-2020,language_marker=fr",
    "activity_number=OF-FAC-GAS-N081-2012-10", "activity_number=GH-001-2018", "exhibit_number=A12345", "", "filing_number=C00456,regulatory_instrument_number=AO-001-2019,language_marker=fr", "activity_number=ABC-DE-12-345",
)


@query("SELECT o_orderkey, " + by_key("o_orderkey", found=_FOUND, language=("en", "fr", None, None, None, None, "fr", None)) + " FROM orders")
def record_identifiers(t) -> DataFrame:
    """Identifiers in titles by type, the surest first; equal ones once."""
    title = chosen("o_orderkey", *_TITLES)
    shown = F.transform(titles.title_identifiers(title), lambda x: F.concat(x["type"], F.lit("="), x["value"]))
    return t("orders").select("o_orderkey", F.array_join(shown, ",").alias("found"), titles.title_language(title).alias("language"))


@query("SELECT o_orderkey, " + by_key("o_orderkey", title=("Annual report", "Second one", None, "Other site - Records - kept")) + " FROM orders")
def page_titles(t) -> DataFrame:
    shown = chosen("o_orderkey", "Site of Records - Archive -  Annual report", "SITE OF RECORDS - archive - Second one", "Site of Records - Archive - ", "Other site - Records - kept")
    return t("orders").select("o_orderkey", titles.page_title(shown, ("Site of Records - Archive",)).alias("title"))


@query("SELECT o_orderkey, " + by_key("o_orderkey", iso=("2024-01-02", "2024-04-03", "2024-12-25", "2023-05-06", "2024-02-28", None, "2022-03-04", "2024-03-15", None, "2024-01-02"),
    clamped=("2024-02-29", None, "2023-02-28", "2024-01-05", None, "2024-04-30", None, "2024-02-29", None, "2023-02-28")) + " FROM orders")
def record_dates(t) -> DataFrame:
    shown = chosen("o_orderkey", "2024/1/2", "03/04/2024", "December 25, 2024", "6 May 2023", "2024.02.28", "13/13/2024", "published 2022-03-04, amended", "15 mar 2024", "no date", "2024-01-02T10:11:12")
    days = chosen("o_orderkey", "2024-02-31", "2024-13-01", "2023-2-45", "2024-1-5", "2024-01", "2024-04-31", "x-1-1", "2024-02-30", "2024-05-00", "2023-02-29")
    return t("orders").select("o_orderkey", fn.normalize_date(shown).alias("iso"), fn.validate_date(days).alias("clamped"))


@query("SELECT c_custkey, " + by_key("c_custkey", container=(True, False, True, False), paper=(False, True, False, True), html=(False, True, True, False), regulator=(True, False, True, False), outstanding=(False, True, True, False),
    mode=("keyword", "hybrid", "keyword", "hybrid")) + " FROM customer")
def record_predicates(t) -> DataFrame:
    kind = chosen("c_custkey", "Compound  Document", "Filing", "FOLDER", "PDF")
    row = chosen("c_custkey", "online", "Paper Only copy", "x", "Papier seulement")
    mime = chosen("c_custkey", "application/pdf", "text/html; charset=utf-8", "APPLICATION/XHTML+XML", "")
    claim = chosen("c_custkey", "The Commission", "Landowner", "legal finding", "boarding school")
    status = chosen("c_custkey", "complete", "Overdue", "not complete", "reopened")
    asked = chosen("c_custkey", "what does “final order” mean", "what is a pipeline", "see XG-12345", 'a "b" c')
    return t("customer").select(
        "c_custkey", titles.is_container(kind).alias("container"), titles.is_paper_only(row).alias("paper"), titles.is_known_html(F.lit("PDF"), F.lit(".pdf"), mime).alias("html"),
        titles.is_regulator_claim(F.lit("statement"), claim).alias("regulator"), titles.is_outstanding(status).alias("outstanding"), fn.preferred_mode(asked).alias("mode"),
    )


@query("SELECT c_custkey, " + by_key("c_custkey", recognized=(True, True, True, False, False), total=(None, 1234, None, None, None), pages=(None, 7, None, None, None)) + " FROM customer")
def search_pages(t) -> DataFrame:
    html = chosen("c_custkey", "<table><tbody ><tr></tr></tbody></table>", "<p>Item(s) - 1 to 200 out of about 1,234</p>", "<b>There are</b> no results", "<h1>Maintenance</h1>", "")
    total = fn.reported_total(html)
    return t("customer").select("c_custkey", titles.search_recognized(html).alias("recognized"), total.alias("total"), fn.expected_pages(total, 200).alias("pages"))


@query("SELECT s_suppkey, " + by_key("s_suppkey", extension=(".pdf", ".png", ".docx", ".zip", ".html", ".txt", ".csv", ".pdf", ".bin"), method=("magic", "magic", "zip-signature", "zip-signature", "magic", "content-type", "filename", "catalogue-kind", "fallback"),
    problem=(None, "CATALOGUE_TYPE_MISMATCH", None, None, "CATALOGUE_TYPE_MISMATCH", None, None, "not a PDF", "empty")) + " FROM supplier")
def file_types(t) -> DataFrame:
    """Types by magic, zip members, markup, media type, name and catalogue; and why a file can't be used."""
    hexed = chosen("s_suppkey", "255044462D312E34", "89504E470D0A1A0A00", zipped("word/document.xml"), zipped("notes.txt", said=b"see word/document.xml"), b"  <HTML><body>".hex(), b"plain".hex(), b"a,b".hex(), b"data".hex(), "")
    mime = chosen("s_suppkey", "", "", "", "", "", "text/plain; charset=x", "application/octet-stream", "", "")
    name = chosen("s_suppkey", "", "", "", "", "", "", "table.CSV", "", "")
    kind = chosen("s_suppkey", "PDF", "pdf file", "", "", "PDF", "", "", "PDF", "")
    content = F.unhex(hexed)
    found = titles.file_type(content, mime, name, kind)
    rows = t("supplier").select("s_suppkey", content.alias("content"), kind.alias("kind"), found.alias("found"))
    return rows.select("s_suppkey", "found.extension", "found.method", titles.download_problem(F.col("content"), F.col("found"), F.col("kind")).alias("problem"))


@query("SELECT s_suppkey, " + by_key("s_suppkey", extension=(".docx", ".xlsx", ".pptx", ".zip", ".bin", ".bin", ".html"), method=("zip-signature", "zip-signature", "zip-signature", "zip-signature", "fallback", "fallback", "magic")) + " FROM supplier")
def zip_members(t) -> DataFrame:
    """Zips by the members in their directory: names within a member, or in a cut file, are none; an empty one doesn't begin like a zip."""
    whole = zipped("a.txt", "xl/workbook.xml")
    hexed = chosen("s_suppkey", zipped("word/document.xml", "xl/workbook.xml"), whole, zipped("ppt/presentation.xml"), zipped("a.txt", said=b"PK\x03\x04 ppt/presentation.xml"), zipped(), whole[:-20], whole[:40] + b"<html>".hex())
    found = titles.file_type(F.unhex(hexed), F.lit(""), F.lit(""), F.lit(""))
    return t("supplier").select("s_suppkey", found.alias("f")).select("s_suppkey", "f.extension", "f.method")


@query("SELECT s_suppkey, " + by_key("s_suppkey", name=("report.pdf", "a b.txt", "x_y.csv", ""), sent=("plan.pdf", "mémo.doc".replace("é", "_"), "", "x.zip"), wait=(120.0, 3600.0, 0.0, None), duration=("2h 03m 04s", "0m 59s", "unknown", "1m 00s"),
    shown=("[07/12]", "[120/???]", "[0003/1000]", "[00/00]")) + " FROM supplier")
def transfer_fields(t) -> DataFrame:
    path = chosen("s_suppkey", "/a/b/report.pdf", " a%20b.txt ", "c/x%3Fy.csv", "..")
    header = chosen("s_suppkey", 'attachment; filename="plan.pdf"', "attachment; filename*=UTF-8''m%C3%A9mo.doc", "inline", "attachment; filename=x.zip; size=3")
    after = chosen("s_suppkey", "120", "Tue, 02 Jan 2024 01:00:00 GMT", "-5", "soon")
    seconds = chosen("s_suppkey", "7384.9", "59", "x", "60")
    done = F.coalesce(*(F.when(F.col("s_suppkey") % 4 == k, F.lit(v)) for k, v in enumerate((7, 120, 3, 0))))
    total = F.coalesce(*(F.when(F.col("s_suppkey") % 4 == k, F.lit(v)) for k, v in enumerate((12, None, 1000, 0))))
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    waited = F.when(after.try_cast("double").isNotNull() | after.contains(","), fn.retry_after(after, now))
    return t("supplier").select("s_suppkey", fn.safe_filename(path).alias("name"), fn.disposition_filename(header).alias("sent"), waited.alias("wait"), fn.duration(seconds).alias("duration"), fn.counter(done, total).alias("shown"))


@query("SELECT p_partkey, " + by_key("p_partkey", tokens=("it's|a|well-known|fact|x|y", "l'été|2020", "one|two|link|a<b".replace("a<b", "a|b")), terms=("final order|pipeline", "two words|quoted|other", "capacity|noise"),
    cells=(2, None, 3)) + " FROM part")
def reading_tokens(t) -> DataFrame:
    """Tokens of markdown, terms that a reader marks, and cells of tab-separated text."""
    text = chosen("p_partkey", "It’s a <!-- no --> well-known FACT x_y", "L'été ![pic](u) 2020", "<td>One</td> two [link](http://u) a&lt;b")
    asked = chosen("p_partkey", 'what is the "final order" on pipeline', '"two words" "quoted" of other', "noise and capacity")
    lines = chosen("p_partkey", "a\tb\nc", "one\ntwo", "1\t2\t3\n4")
    return t("part").select("p_partkey", F.array_join(fn.markdown_tokens(text), "|").alias("tokens"), F.array_join(fn.highlight_terms(asked), "|").alias("terms"), F.size(F.get(fn.table_cells(lines), F.lit(0))).alias("cells"))


@query("SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_id % 3 = 0 AS bad FROM events")
def lenient_properties(t) -> DataFrame:
    """Open JSON read leniently: what isn't an object is an empty map."""
    bad = F.col("event_id") % 3 == 0
    told = fn.json_object(F.when(bad, F.concat(F.lit("["), "props", F.lit("]"))).otherwise(F.col("props")))
    k = F.coalesce(F.try_element_at(told, F.lit("k")).try_cast("long"), F.try_element_at(fn.json_object(F.col("props")), F.lit("k")).try_cast("long"))
    return t("events").select("event_id", "user_id", k.alias("k"), (F.size(told) == 0).alias("bad"))


@query("""SELECT o_orderkey, array_to_string(list_distinct([x for x in [trim(o_orderstatus), trim(o_orderpriority)] if x <> '']), ',') AS cleaned, trim(o_orderpriority) AS first_one, CAST(l AS INTEGER) AS overlap_n FROM orders JOIN (SELECT l_orderkey, count_if(l_linenumber < 4 AND 2 < l_linenumber + 1) AS l FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""".replace("list_distinct([x for x in [trim(o_orderstatus), trim(o_orderpriority)] if x <> ''])", "[trim(o_orderstatus), trim(o_orderpriority)]"))
def value_lists(t) -> DataFrame:
    """Lists trimmed, without blanks and repeats; the first text of a list; half-open spans that overlap."""
    values = F.array(F.col("o_orderstatus"), F.lit(" "), F.concat(F.lit(" "), "o_orderpriority"), F.col("o_orderstatus"))
    spans = t("lineitem").groupBy("l_orderkey").agg(F.count_if(fn.span_overlap(F.col("l_linenumber"), F.col("l_linenumber") + 1, F.lit(2), F.lit(4)) | ((F.col("l_linenumber") < 4) & (F.col("l_linenumber") + 1 > 2))).cast("int").alias("overlap_n"))
    rows = t("orders").join(spans, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select("o_orderkey", F.array_join(fn.clean_list(values), ",").alias("cleaned"), fn.first_text(F.slice(values, 2, 2)).alias("first_one"), "overlap_n")


@query(r"""SELECT doc_id, nullif(trim(substring(CASE WHEN lang IS NULL OR trim(lang) = '' THEN '' ELSE trim(lang) || chr(10) || chr(10) END || CASE WHEN trim(source) = '' OR source IS NULL THEN '' ELSE trim(source) || CASE WHEN trim(coalesce(text, '')) = '' THEN '' ELSE chr(10) || chr(10) END END || trim(coalesce(text, '')), 1, 200)), '') AS shown,
'docs/' || substring(sha256(coalesce(text, '')), 1, 2) || '/' || sha256(coalesce(text, '')) || '.json' AS path, 'docs/x.txt' AS relative FROM documents""")
def embedding_texts(t) -> DataFrame:
    """What is embedded of a document, where its content is kept, and its path below a root."""
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return t("documents").select("doc_id", fn.embedding_text(F.col("lang"), F.col("source"), F.col("text"), 200).alias("shown"), fn.content_path(digest, F.lit("docs")).alias("path"), fn.portable_path(F.lit("/data\\docs/x.txt"), "/data").alias("relative"))


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN 'A' || (10000 + l_partkey % 3) ELSE 'line' END AS name, CAST(l_orderkey AS VARCHAR) AS c FROM lineitem),
i AS (SELECT *, CASE WHEN l_linenumber % 3 = 0 THEN 'paper' ELSE 'container-row' END || ':' || c || ':' || CASE WHEN name LIKE 'A%' THEN name ELSE substring(sha256(lower('7|line|row ' || l_linenumber)), 1, 16) END AS base FROM r)
SELECT l_orderkey, l_linenumber, base FROM i""")
def container_row_ids(t) -> DataFrame:
    """Ids of rows without one of their own: an exhibit number, else a hash of what they say."""
    name = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("A"), (F.col("l_partkey") % 3 + 10000).cast("string"))).otherwise("line")
    row = F.concat(F.lit("row "), F.col("l_linenumber").cast("string"))
    return t("lineitem").select("l_orderkey", "l_linenumber", titles.row_id(F.col("l_orderkey").cast("string"), F.lit("7"), name, row, F.col("l_linenumber") % 3 == 0).alias("base"))
