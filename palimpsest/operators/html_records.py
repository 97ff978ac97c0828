"""Typed records out of registry-like pages with the standard library's parser, batch by batch."""

from __future__ import annotations

import json
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.text import clean_text
from palimpsest.functions.titles import canonical_field, normalized_label, row_id, row_id_suffix

_SCHEMA = (
    "page_id long, title string, lang string, canonical string, meta map<string,string>, headings array<string>, links array<struct<href:string,text:string>>, rows array<array<string>>,"
    " pairs array<struct<label:string,value:string>>, options array<struct<category:string,id:string,label:string>>,"
    " results array<struct<cells:array<string>,icon:string,links:array<struct<label:string,href:string,text:string>>>>"
)
_ARROW = pa.schema(
    [
        ("page_id", pa.int64()), ("title", pa.string()), ("lang", pa.string()), ("canonical", pa.string()), ("meta", pa.map_(pa.string(), pa.string())),
        ("headings", pa.list_(pa.string())), ("links", pa.list_(pa.struct([("href", pa.string()), ("text", pa.string())]))), ("rows", pa.list_(pa.list_(pa.string()))),
        ("pairs", pa.list_(pa.struct([("label", pa.string()), ("value", pa.string())]))),
        ("options", pa.list_(pa.struct([("category", pa.string()), ("id", pa.string()), ("label", pa.string())]))),
        ("results", pa.list_(pa.struct([("cells", pa.list_(pa.string())), ("icon", pa.string()), ("links", pa.list_(pa.struct([("label", pa.string()), ("href", pa.string()), ("text", pa.string())])))]))),
    ]
)


# Pages whose records are Python objects at the same time.
PAGES_AT_ONCE = 64
_KEPT = ("title", "h1", "h2", "h3", "td", "th", "dt", "dd", "label", "option", "summary")


class _Reader(HTMLParser):
    """Collects what a record needs; text inside script and style is never read as markup."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: dict = {"title": None, "lang": None, "canonical": None, "meta": {}, "headings": [], "links": [], "rows": [], "pairs": [], "options": [], "results": []}
        self.open: list[tuple[str, list[str], dict]] = []
        self.row: dict | None = None  # the table row that is open
        self.body = False  # in a table's body
        self.term, self.labels, self.select, self.json = "", {}, None, False
        self.before = ""  # the last short text in front of a link

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "html":
            self.out["lang"] = a.get("lang")
        elif tag == "link" and "canonical" in a.get("rel", "").lower().split():
            self.out["canonical"] = a.get("href")
        elif tag == "meta" and (name := a.get("name") or a.get("property") or a.get("http-equiv")):
            self.out["meta"].setdefault(name, a.get("content", ""))
            self._pair(name, a.get("content", ""))
        elif tag == "tbody":
            self.body = True
        elif tag == "tr":
            self._close_row()
            self.row = {"th": [], "td": [], "links": [], "icon": None, "body": self.body}
            self.out["rows"].append([])
        elif tag == "select":
            self.select = a.get("id", "")
        elif tag in ("i", "span", "img") and self.row is not None and not self.row["icon"]:
            self.row["icon"] = a.get("title") or a.get("alt") or None
        elif tag == "script" and "json" in a.get("type", "").lower():
            self.json = True
        if tag == "a":
            self.label_before = self.before
        if tag in _KEPT or (tag == "a" and "href" in a):
            self.open.append((tag, [], a))

    def handle_data(self, data):
        for _, parts, _ in self.open:
            parts.append(data)
        if self.json:
            self._json(data)
        if data.strip() and len(data) <= 80:
            self.before = " ".join(data.split()).rstrip(":")

    def _pair(self, label: str, value: str) -> None:
        self.out["pairs"].append({"label": label, "value": value})

    def _json(self, data: str) -> None:
        try:
            told = json.loads(data)
        except ValueError:
            return
        for one in told if isinstance(told, list) else [told]:
            for k, v in one.items() if isinstance(one, dict) else ():
                if isinstance(v, (str, int, float)):
                    self._pair(f"json:{k}", str(v))

    def _close_row(self) -> None:
        row, self.row = self.row, None
        if row is None:
            return
        if row["th"] and row["td"]:
            self._pair(" ".join(row["th"]), " ".join(row["td"]))
        elif len(row["td"]) == 2 and len(row["td"][0]) <= 60:
            self._pair(*row["td"])
        if row["body"] and len(row["td"]) >= 3 and row["links"]:
            self.out["results"].append({"cells": row["td"], "icon": row["icon"], "links": row["links"]})

    def handle_endtag(self, tag):
        if tag in ("tr", "table", "tbody"):
            self._close_row()
            self.body = self.body and tag == "tr"
        elif tag == "select":
            self.select = None
        elif tag == "script":
            self.json = False
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                _, parts, a = self.open.pop(k)
                self._closed(tag, " ".join("".join(parts).split()), a)
                return

    def _closed(self, tag: str, text: str, a: dict) -> None:
        out = self.out
        if tag == "title" and out["title"] is None:
            out["title"] = text
        elif tag in ("h1", "h2", "h3"):
            out["headings"].append(text)
        elif tag == "a":
            out["links"].append({"href": a["href"], "text": text})
            if self.row is not None:
                self.row["links"].append({"label": self.label_before, "href": a["href"], "text": text})
        elif tag in ("td", "th"):
            if out["rows"]:
                out["rows"][-1].append(text)
            if self.row is not None:
                self.row[tag].append(text)
        elif tag == "dt":
            self.term = text
        elif tag == "dd" and self.term:
            self._pair(self.term, text)
            self.term = ""
        elif tag == "label" and a.get("for"):
            self.labels[a["for"]] = text
        elif tag == "option" and self.select in self.labels and a.get("value") and text:
            out["options"].append({"category": self.labels[self.select], "id": a["value"], "label": text})

    label_before = ""

    def close(self):
        super().close()
        self._close_row()


def parse_page(html: str | None) -> dict:
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    return reader.out


def parse_pages(pages: DataFrame) -> DataFrame:
    """One record per row of (page_id, html); broken markup gives what could be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (batch.slice(k, PAGES_AT_ONCE) for batch in batches for k in range(0, batch.num_rows, PAGES_AT_ONCE)):
            records = [parse_page(h.as_py()) for h in part.column(1)]
            columns = [part.column(0)] + [pa.array([list(r[f.name].items()) if f.name == "meta" else r[f.name] for r in records], f.type) for f in list(_ARROW)[1:]]
            yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)

    return pages.select("page_id", "html").mapInArrow(run, _SCHEMA)


# What a page's template says of itself.
TEMPLATE_LABELS = ("viewport", "dcterms creator", "dcterms issued", "dcterms modified", "dcterms subject")
TEMPLATE_VALUES = ("add to favourites", "width=device-width,initial-scale=1", "width=device-width, initial-scale=1")
TEMPLATE_PARTS = ("add to favourites", "ajouter aux favoris", "skip to main content", "passer au contenu principal")


def detail_fields(parsed: DataFrame) -> DataFrame:
    """(page_id, at, label, value, field): plausible pairs of a page, each once, in order; field is the stable one of the label."""
    each = parsed.select("page_id", F.posexplode("pairs").alias("at", "p")).select("page_id", "at", F.regexp_replace(clean_text(F.col("p.label")), ":+$", "").alias("label"), clean_text(F.col("p.value")).alias("value"))
    low, key = F.lower("value"), normalized_label(F.col("label"))
    template = low.isin(*TEMPLATE_VALUES) | (key.isin(*TEMPLATE_LABELS) & ~key.startswith("dcterms"))
    for part in TEMPLATE_PARTS:
        template = template | low.contains(part)
    good = (F.col("label") != "") & (F.col("value") != "") & ~template & (F.lower("label") != low) & (F.length("label") <= 120) & (F.length("value") <= 5000)
    one = each.where(good).groupBy("page_id", "label", "value").agg(F.min("at").alias("at"))
    return one.select("page_id", "at", "label", "value", canonical_field(F.col("label")).alias("field"))


def first_fields(details: DataFrame) -> DataFrame:
    """(page_id, field, value): the first value of every stable field of a page."""
    return details.where("field IS NOT NULL").groupBy("page_id", "field").agg(F.min_by("value", "at").alias("value"))


def facet_catalogue(parsed: DataFrame) -> DataFrame:
    """(category, id, label) of all options of a page's named selections."""
    return parsed.select(F.explode("options").alias("o")).select("o.*").distinct()


def result_records(parsed: DataFrame, item: str = r"/(item|download)/(\d+)", container: str | None = None) -> DataFrame:
    """(page_id, document_id, name, is_file, date_raw, submitter, kind, filing_number, company, project, identity) of result rows.

    ``item`` tells a link's kind and number.  In a container, rows on paper only and rows that share a number get
    ids of their own, with a suffix where two would be the same.
    """
    rows = parsed.select("page_id", F.posexplode("results").alias("at", "r")).select("page_id", "at", "r.*")
    own = F.get(F.filter("links", lambda d: F.regexp_extract(d["href"], f"(?i){item}", 2) != ""), F.lit(0))  # the first link to an item
    rows = rows.withColumn("own", own).where("own IS NOT NULL").withColumn("details", F.filter("links", lambda d: d["href"] != F.col("own.href")))
    rows = rows.withColumns({"href": F.col("own.href"), "link": F.col("own.text")}).drop("own")
    named = lambda word: F.get(F.filter("details", lambda d: normalized_label(d["label"]) == word), F.lit(0))["text"]
    filing = F.get(F.filter(F.transform("details", lambda d: F.regexp_extract(d["text"], r"(?i)Filing:\s*(\S+)", 1)), lambda x: x != ""), F.lit(0))
    out = rows.select(
        "page_id", "at", F.regexp_extract("href", f"(?i){item}", 2).alias("number"), F.col("link").alias("name"), (F.lower(F.regexp_extract("href", f"(?i){item}", 1)) == "download").alias("file"),
        F.get("cells", F.lit(1)).alias("date_raw"), F.get("cells", F.lit(2)).alias("submitter"), F.col("icon").alias("kind"), filing.alias("filing_number"), named("company").alias("company"), named("project").alias("project"),
        F.array_join("cells", " ").alias("row_text"),
    )
    if container is None:
        return out.select("page_id", F.col("number").alias("document_id"), "name", F.col("file").alias("is_file"), "date_raw", "submitter", "kind", "filing_number", "company", "project", F.lit("item").alias("identity"))
    paper = F.lower(F.concat_ws(" ", "name", "row_text", F.coalesce("kind", F.lit("")))).rlike("paper only|papier seulement")
    shared = F.count("*").over(Window.partitionBy("page_id", "number")) > 1
    marked = out.withColumn("paper", paper).withColumn("own", ~(paper | shared))
    made = row_id(F.lit(container), F.col("number"), F.col("name"), F.col("row_text"), F.col("paper"))
    marked = marked.withColumn("made", made)
    again = F.row_number().over(Window.partitionBy("page_id", "made").orderBy("at")) > 1
    ident = F.when(F.col("own"), F.col("number")).when(again, F.concat("made", F.lit(":"), row_id_suffix(F.col("name"), F.col("row_text")))).otherwise(F.col("made"))
    return marked.select(
        "page_id", ident.alias("document_id"), "name", (F.col("file") & F.col("own")).alias("is_file"), "date_raw", "submitter", F.when(F.col("paper"), "Paper Only").otherwise(F.col("kind")).alias("kind"), "filing_number", "company", "project",
        F.when(F.col("own"), "item").otherwise("container_row_synthetic").alias("identity"),
    )
