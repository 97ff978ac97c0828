"""A second layout format, as a local converter gives it, projected to the common envelope.

A native row is (document_id, texts, tables, pages, page_markdown, markdown):

* texts: array of (text, orig, label, prov), prov an array of (page_no, bbox: (l, t, r, b));
* tables: array of (prov, num_rows, num_cols, grid), grid an array of arrays of cells (text, start_row_offset_idx,
  start_col_offset_idx, row_span, col_span, column_header, row_header, prov);
* pages: map of page number (as text) to (width, height); page_markdown: map of page number to text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROV = "array<struct<page_no: int, bbox: struct<l: double, t: double, r: double, b: double>>>"
NATIVE = (
    f"document_id string, texts array<struct<text: string, orig: string, label: string, prov: {PROV}>>,"
    f" tables array<struct<prov: {PROV}, num_rows: int, num_cols: int, grid: array<array<struct<text: string, start_row_offset_idx: int, start_col_offset_idx: int,"
    f" row_span: int, col_span: int, column_header: boolean, row_header: boolean, prov: {PROV}>>>>>,"
    " pages map<string, struct<width: double, height: double>>, page_markdown map<int, string>, markdown string"
)
# The roles of labels; every other label has none.  A page's elements have places of their own up to this.
ROLES = {"section_header": "sectionHeading", "title": "title", "page_header": "pageHeader", "page_footer": "pageFooter"}
PLACES = 1_000_000


def role_of(label: Column) -> Column:
    return F.coalesce(*(F.when(label == k, F.lit(v)) for k, v in ROLES.items()), F.lit(None).cast("string"))


def page_of(prov: Column) -> Column:
    return F.get(prov, F.lit(0))["page_no"]


def source_of(prov: Column) -> Column:
    """``D(page,l,t,r,b)`` of the first provenance, to four places; without all four numbers the page alone, without a page null."""
    box = F.get(prov, F.lit(0))["bbox"]
    numbers = F.concat(*(F.concat(F.lit(","), F.format_string("%.4f", box[c])) for c in "ltrb"))
    whole = box["l"].isNotNull() & box["t"].isNotNull() & box["r"].isNotNull() & box["b"].isNotNull()
    return F.concat(F.lit("D("), page_of(prov).cast("string"), F.when(whole, numbers).otherwise(""), F.lit(")"))


def said(text: Column, orig: Column) -> Column:
    """A text, or what was read where there is none, without blanks at its ends."""
    return F.regexp_replace(F.coalesce(F.nullif(text, F.lit("")), orig, F.lit("")), r"^\s+|\s+$", "")


def _cells(table: Column) -> Column:
    """The grid's cells in one array; a place that is zero or untold is that in the grid, a span at least one."""

    def cell(x: Column, row: Column, col: Column, source: Column) -> Column:
        at = lambda told, own: F.coalesce(F.nullif(told, F.lit(0)), own.cast("int"))
        kind = F.when(x["column_header"], "columnHeader").when(x["row_header"], "rowHeader").otherwise("content")
        return F.struct(
            at(x["start_row_offset_idx"], row).alias("row"), at(x["start_col_offset_idx"], col).alias("col"), F.coalesce(x["text"], F.lit("")).alias("content"), kind.alias("kind"),
            at(x["row_span"], F.lit(1)).alias("row_span"), at(x["col_span"], F.lit(1)).alias("col_span"), F.coalesce(source_of(x["prov"]), source).alias("source"),
        )

    rows = lambda source: F.transform(table["grid"], lambda row, r: F.filter(F.transform(row, lambda x, c: F.when(x.isNotNull(), cell(x, r, c, source))), lambda x: x.isNotNull()))
    # the table's own source, written once a table, not once a cell
    return F.get(F.transform(F.array(source_of(table["prov"])), lambda source: F.flatten(F.filter(rows(source), lambda row: row.isNotNull()))), F.lit(0))


def _tables(tables: Column) -> Column:
    def table(x: Column) -> Column:
        grid = F.greatest(F.size(x["grid"]), F.lit(0))
        wide = F.coalesce(F.array_max(F.transform(x["grid"], lambda row: F.greatest(F.size(row), F.lit(0)))), F.lit(0))
        return F.struct(
            F.coalesce(F.nullif(x["num_rows"], F.lit(0)), grid).alias("row_count"), F.coalesce(x["num_cols"], wide).alias("column_count"), F.lit(None).cast("string").alias("caption"),
            source_of(x["prov"]).alias("source"), F.coalesce(_cells(x), F.expr("CAST(array() AS array<struct<row:int,col:int,content:string,kind:string,row_span:int,col_span:int,source:string>>)")).alias("cells"),
        )

    return F.transform(F.filter(tables, lambda x: x.isNotNull()), table)


def projected_envelopes(native: DataFrame) -> DataFrame:
    """(document_id, contents): one content a document, its elements in one section by page and place.

    Texts that are blank are left out and not counted.  A paragraph's span begins behind those before it, each
    with two characters more; tables come behind all texts of their page.  Elements without a page come first.
    Pages are those that an element names, or else those that the format lists; their slices of the text follow
    each other with two characters between those that aren't empty.  There are no figures.  Documents are rows:
    of several with one id the contents are one document's, so ids must be unique; a null id is left out.
    """
    rows = native.where("document_id IS NOT NULL")
    each = rows.select("document_id", F.posexplode("texts").alias("at", "x")).where("x IS NOT NULL")
    each = each.select("document_id", "at", said(F.col("x.text"), F.col("x.orig")).alias("content"), role_of(F.coalesce(F.nullif(F.col("x.label"), F.lit("")), F.lit("text"))).alias("role"), source_of(F.col("x.prov")).alias("source"), page_of(F.col("x.prov")).alias("page")).where("content <> ''")
    ahead = Window.partitionBy("document_id").orderBy("at")
    length = F.length("content")
    each = each.withColumns({"idx": F.row_number().over(ahead) - 1, "offset": (F.sum(length + 2).over(ahead) - length - 2).cast("int"), "length": length})
    span = F.struct("offset", "length")
    own = each.groupBy("document_id").agg(
        F.sort_array(F.collect_list(F.struct("idx", "content", "role", "source", span.alias("span"), "page"))).alias("ps"), F.sum(F.col("length") + 2).cast("long").alias("end")
    )
    none = F.expr("CAST(array() AS array<struct<idx:int,content:string,role:string,source:string,span:struct<offset:int,length:int>,page:int>>)")
    both = rows.join(own, "document_id", "left").withColumns({"ps": F.coalesce("ps", none), "end": F.coalesce("end", F.lit(0)), "ts": F.filter(F.coalesce("tables", F.array().cast(native.schema["tables"].dataType)), lambda x: x.isNotNull())})
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    texts = F.transform("ps", lambda p: F.struct((zero(p["page"]) * PLACES + p["span"]["offset"]).alias("place"), F.lit(0).alias("kind"), p["idx"].alias("idx"), F.concat(F.lit("/paragraphs/"), p["idx"].cast("string")).alias("e")))
    tables = F.transform("ts", lambda x, i: F.struct((zero(page_of(x["prov"])) * PLACES + F.col("end") + i).alias("place"), F.lit(1).alias("kind"), i.cast("int").alias("idx"), F.concat(F.lit("/tables/"), i.cast("string")).alias("e")))
    order = F.sort_array(F.concat(texts, tables))
    elements = F.transform(order, lambda x: x["e"])
    named = F.concat(F.transform("ps", lambda p: p["page"]), F.transform("ts", lambda x: page_of(x["prov"])))
    named = F.array_sort(F.array_distinct(F.array_compact(named)))
    listed = F.array_sort(F.array_distinct(F.array_compact(F.coalesce(F.transform(F.map_keys("pages"), lambda k: k.try_cast("int")), F.array().cast("array<int>")))))
    numbers = F.when(F.size(named) > 0, named).otherwise(listed)
    rows = both.withColumns({"elements": elements, "numbers": numbers})
    slice_ = lambda n: F.length(F.coalesce(F.try_element_at("page_markdown", n), F.lit("")))
    start = F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<struct<number:int,width:double,height:double,angle:int,spans:array<struct<offset:int,length:int>>>>)").alias("out"))

    def page(acc: Column, n: Column) -> Column:
        size = F.try_element_at("pages", n.cast("string"))
        made = F.struct(n.alias("number"), size["width"].alias("width"), size["height"].alias("height"), F.lit(0).alias("angle"), F.array(F.struct(acc["at"].alias("offset"), slice_(n).alias("length"))).alias("spans"))
        return F.struct((acc["at"] + slice_(n) + F.when(slice_(n) > 0, 2).otherwise(0)).alias("at"), F.concat(acc["out"], F.array(made)).alias("out"))

    paragraphs = F.transform("ps", lambda p: F.struct(p["content"].alias("content"), p["role"].alias("role"), p["source"].alias("source"), p["span"].alias("span")))
    sections = F.filter(F.array(F.struct(F.col("elements").alias("elements"), F.lit(0).alias("offset"))), lambda x: F.size(x["elements"]) > 0)
    figures = F.expr("CAST(array() AS array<struct<role:string,figure_id:string,source:string,elements:array<string>>>)")
    content = F.struct(
        paragraphs.alias("paragraphs"), sections.alias("sections"), _tables(F.col("ts")).alias("tables"), figures.alias("figures"), F.coalesce("markdown", F.lit("")).alias("markdown"),
        F.aggregate("numbers", start, page, lambda acc: acc["out"]).alias("pages"), F.lit("pt").alias("unit"),
    )
    return rows.select("document_id", F.array(content).alias("contents"))
