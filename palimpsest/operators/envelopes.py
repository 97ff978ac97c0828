"""Layout envelopes to chunks, table records and pages.

An envelope row is (document_id, contents): contents is an array of structs of

* paragraphs: array of (content, role, source), ``source`` as ``D(page,x,y,...)``;
* sections: array of (elements, offset), elements being pointers such as ``/paragraphs/3``;
* tables: array of (row_count, column_count, caption, source, cells), cells of (row, col, content, kind);
* figures: array of (role, figure_id, source, elements);
* markdown, and pages: array of (number, spans), spans of (offset, length).

The order in which a document's tree is walked, and the packing of one run of texts, are small
functions of one row; joins, numbering and tables are DataFrame operations.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from palimpsest.functions.text import source_pages, source_regions
from palimpsest.operators.sequences import groups_of, packed, words_in

# Roles whose paragraphs never reach a chunk, roles of figures that don't, and the least words of a figure.
EXCLUDED = ("pageHeader", "pageFooter", "pageNumber")
EXCLUDED_FIGURES = ("pageHeader", "pageFooter")
FIGURE_WORDS = 3
HEADER_KINDS = ("columnHeader", "stubHead")

ENVELOPE = (
    "document_id string, contents array<struct<paragraphs: array<struct<content: string, role: string, source: string>>,"
    " sections: array<struct<elements: array<string>, offset: int>>,"
    " tables: array<struct<row_count: int, column_count: int, caption: string, source: string, cells: array<struct<row: int, col: int, content: string, kind: string>>>>,"
    " figures: array<struct<role: string, figure_id: string, source: string, elements: array<string>>>,"
    " markdown: string, pages: array<struct<number: int, spans: array<struct<offset: int, length: int>>>>>>"
)
_POINTER = re.compile(r"^/(paragraphs|sections|tables|figures)/(\d+)$")


def walked(sections: list[list[tuple[str, int]]], offsets: list[int], headings: list[str], skipped: list[bool], n_tables: int, n_figures: int, orphans: bool = False) -> list[tuple[str, list[str], list[int]]]:
    """(kind, heading path, indices) in the order of reading; a run of paragraphs ends at a section, table or figure.

    Roots come first, by offset, then sections that no root leads to, then tables and figures that no
    section lists; with ``orphans`` also the paragraphs that none lists.
    """
    parent: dict[int, int] = {}
    holder: dict[tuple[str, int], int] = {}
    for at, elements in enumerate(sections):
        for kind, k in elements:
            if kind == "sections" and k < len(sections):
                parent[k] = at  # the last that lists it
            holder.setdefault((kind, k), at)  # the first

    def path(at: int | None) -> list[str]:
        chain: list[int] = []
        while at is not None and at not in chain:
            chain.append(at)
            at = parent.get(at)
        return [headings[k] for k in reversed(chain) if headings[k]]

    out: list[tuple[str, list[str], list[int]]] = []
    seen: set[tuple[str, int]] = set()
    by_offset = sorted(range(len(sections)), key=lambda k: offsets[k])
    for root in [k for k in by_offset if k not in parent] + by_offset:
        stack = [(root, iter(sections[root]))] if ("sections", root) not in seen else []
        seen.add(("sections", root))
        run: list[int] = []
        while stack:
            at, rest = stack[-1]
            kind, k = next(rest, (None, -1))
            if kind == "paragraphs":
                if k < len(skipped) and not skipped[k]:
                    run.append(k)
                    seen.add((kind, k))
                continue
            if run:
                out.append(("text", path(at), run))
                run = []
            if kind is None:
                stack.pop()
            elif kind == "sections" and k < len(sections) and (kind, k) not in seen:
                seen.add((kind, k))
                stack.append((k, iter(sections[k])))
            elif (kind == "tables" and k < n_tables) or (kind == "figures" and k < n_figures):
                seen.add((kind, k))
                out.append((kind[:-1], path(at), [k]))
    for kind, n in (("tables", n_tables), ("figures", n_figures)):
        out += [(kind[:-1], path(holder.get((kind, k))), [k]) for k in range(n) if (kind, k) not in seen]
    if orphans:
        out += [("text", [], [k]) for k in range(len(skipped)) if not skipped[k] and ("paragraphs", k) not in seen]
    return out


def contents_of(envelopes: DataFrame) -> DataFrame:
    """A row for each content, with its place and the tables and figures of the contents before it."""
    sizes = lambda field: F.transform("contents", lambda c: F.greatest(F.size(F.coalesce(c[field], F.array())), F.lit(0)))
    before = lambda field: F.aggregate(F.slice(field, F.lit(1), F.col("content_index")), F.lit(0), lambda a, n: a + n)
    each = envelopes.select("document_id", sizes("tables").alias("_tables"), sizes("figures").alias("_figures"), F.posexplode("contents").alias("content_index", "c"))
    return each.select("document_id", "content_index", before("_tables").alias("tables_before"), before("_figures").alias("figures_before"), "c.*")


def matrix(row_count: int, column_count: int, cells: Iterable[tuple[int, int, str, str | None]]) -> tuple[list[str], list[int]]:
    """Lines of a table (its cells joined by tabs, without blanks at the end) and its header rows: the last cell of a place counts, those outside don't."""
    placed, headers = {}, set()
    for row, col, content, kind in cells:
        placed[row, col] = content
        if kind in HEADER_KINDS:
            headers.add(row)
    columns = range(column_count)
    return ["\t".join([placed.get((r, c), "") for c in columns]).rstrip(" \t\n\v\f\r") for r in range(row_count)], sorted(headers)


def _plain(column: pa.Array) -> list:
    return column.to_numpy(zero_copy_only=False).tolist()


def _lists(column: pa.Array) -> tuple[list[int], pa.Array]:
    """Where each list of a column begins (and the last ends) in the elements of all, and these."""
    if not len(column):
        return [0], column.values.slice(0, 0)
    at = column.offsets.to_numpy()
    return (at - at[0]).tolist(), column.values.slice(at[0], at[-1] - at[0])


def _fields(column: pa.Array) -> dict[str, pa.Array]:
    return dict(zip((f.name for f in column.type), column.flatten()))


def _texts(column: pa.Array) -> list[str]:
    return _plain(pc.utf8_trim(column, " ").fill_null(""))


def _numbers(column: pa.Array) -> list[int]:
    return _plain(column.fill_null(0))


def _table_columns(tables: pa.Array) -> list[tuple[int, int, str | None, Iterator]]:
    """(rows, columns, caption, cells) of every table of a column: cells as ``matrix`` takes them."""
    t = _fields(tables)
    at, cells = _lists(t["cells"])
    c = _fields(cells)
    columns = (_numbers(c["row"]), _numbers(c["col"]), _texts(c["content"]), _plain(c["kind"]))
    own = [zip(*(x[a:b] for x in columns)) for a, b in pairwise(at)]
    return list(zip(_numbers(t["row_count"]), _numbers(t["column_count"]), _plain(t["caption"]), own))


class _Content(NamedTuple):
    row: int
    content_index: int
    tables_before: int
    figures_before: int
    said: list[str]
    order: list[tuple[str, list[str], list[int]]]
    tables: list[tuple[int, int, str | None, Iterator]]
    figures: list[tuple[str | None, list[int]]]


def _slim(envelopes: DataFrame) -> DataFrame:
    """(document_id, contents) with the fields that are read."""
    part = lambda c, field, own: c[field][own]  # noqa: E731  an array of what the elements have there
    slim = lambda c: F.struct(
        part(c, "paragraphs", "content").alias("said"), part(c, "paragraphs", "role").alias("roles"), part(c, "sections", "elements").alias("elements"), part(c, "sections", "offset").alias("offsets"),
        c["tables"].alias("tables"), part(c, "figures", "role").alias("figure_roles"), part(c, "figures", "elements").alias("figure_elements"),
    )
    return envelopes.select("document_id", F.transform("contents", slim).alias("contents"))


def _read(contents: pa.Array, known: dict, orphans: bool = False) -> Iterator[_Content]:
    """Every content of a column of ``_slim`` rows with its items in the order of reading.

    Columns are taken whole out of Arrow, not value by value.  A figure has the paragraphs it uses, none if it is no item.
    ``known`` keeps pointers that were parsed.
    """

    def pointers(elements: list[str | None]) -> list[tuple[str, int]]:
        out = []
        for e in elements:
            if e not in known:
                if len(known) > 100_000:
                    known.clear()
                m = _POINTER.match(e or "")
                known[e] = (m[1], int(m[2])) if m else None
            if known[e]:
                out.append(known[e])
        return out

    rows, each = _lists(contents)
    f = _fields(each)
    p_at, said = _lists(f["said"])
    said, roles = _texts(said), _texts(_lists(f["roles"])[1])
    s_at, elements = _lists(f["elements"])
    e_at, elements = _lists(elements)
    elements, offsets = _plain(elements), _numbers(_lists(f["offsets"])[1])
    t_at, tables = _lists(f["tables"])
    tables = _table_columns(tables)
    g_at, g_roles = _lists(f["figure_roles"])
    g_roles = _plain(g_roles)
    ge_at, g_elements = _lists(_lists(f["figure_elements"])[1])
    g_elements = _plain(g_elements)
    for row, (first, last) in enumerate(pairwise(rows)):
        n_tables = n_figures = 0
        for k in range(first, last):
            own, role = said[p_at[k] : p_at[k + 1]], roles[p_at[k] : p_at[k + 1]]
            sections = [pointers(elements[e_at[s] : e_at[s + 1]]) for s in range(s_at[k], s_at[k + 1])]
            heads = [next((i for kind, i in x if kind == "paragraphs" and i < len(role) and role[i] == "sectionHeading"), None) for x in sections]
            headings = ["" if i is None else own[i] for i in heads]
            skipped = [not text or r == "sectionHeading" or r in EXCLUDED for text, r in zip(own, role)]
            figures = []
            for g in range(g_at[k], g_at[k + 1]):
                used = [i for kind, i in pointers(g_elements[ge_at[g] : ge_at[g + 1]]) if kind == "paragraphs" and i < len(own) and own[i] and role[i] not in EXCLUDED]
                figures.append((g_roles[g], used))
            own_tables = tables[t_at[k] : t_at[k + 1]]
            order = walked(sections, offsets[s_at[k] : s_at[k + 1]], headings, skipped, len(own_tables), len(figures), orphans)
            yield _Content(row, k - first, n_tables, n_figures, own, order, own_tables, figures)
            n_tables, n_figures = n_tables + len(own_tables), n_figures + len(figures)


def _mapped(rows: DataFrame, schema: str, made: Callable[[pa.RecordBatch, dict], Iterator[tuple]], size: int = 500) -> DataFrame:
    """Rows of ``made`` over slices of ``size`` rows, in one Arrow pass."""
    types = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            for k in range(0, batch.num_rows, size):
                columns = list(zip(*made(batch.slice(k, size), known))) or [()] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(columns, types)], schema=types)

    return rows.mapInArrow(run, schema)


def table_matrices(contents: DataFrame) -> DataFrame:
    """(document_id, content_index, table_index, caption, row_count, column_count, lines, header_rows) of every table, each by itself."""
    tables = contents.select(F.col("document_id").cast("string").alias("document_id"), "content_index", F.posexplode("tables").alias("table_index", "t"))
    schema = "document_id string, content_index int, table_index int, caption string, row_count int, column_count int, lines array<string>, header_rows array<int>"

    def made(batch: pa.RecordBatch, _: dict) -> Iterator[tuple]:
        keys = (_plain(batch.column(c)) for c in ("document_id", "content_index", "table_index"))
        for *key, (rows, columns, caption, cells) in zip(*keys, _table_columns(batch.column("t"))):
            yield *key, caption, rows, columns, *matrix(rows, columns, cells)

    return _mapped(tables, schema, made)


def table_parts(lines: list[str], headers: list[int], target: int, most: int) -> list[tuple[str, int, int]]:
    """(text, first row, last row) of the groups of a table's rows that aren't blank; all but the first have the header lines before them."""
    sizes = [words_in(line) for line in lines]
    rows = [k for k, n in enumerate(sizes) if n]
    head = [k for k in headers if 0 <= k < len(lines) and sizes[k]]
    spans = groups_of([sizes[k] for k in rows], target, most, later=sum(sizes[k] for k in head))
    return [("\n".join(lines[k] for k in (head if a else []) + rows[a:b]), rows[a], rows[b - 1]) for a, b in spans]


def chunks(envelopes: DataFrame, *, target: int = 200, most: int = 300) -> DataFrame:
    """(document_id, chunk_index, chunk_id, chunk_type, section_path, content, words, content_index, table_id, table_part, table_row_start,
    table_row_end, figure_id, elements): chunks in reading order.

    Texts, tables and figures are numbered together in a document; a figure of fewer than three words or of a
    header or footer gives none.  Tables and figures are numbered over all contents of a document.  A document is one
    row and is read, packed and numbered in one pass without a shuffle, so ids must be unique.
    """
    schema = "document_id string, chunk_index int, kind string, section_path string, content string, words int, content_index int, number int, part int, first_row int, last_row int, elements array<string>"

    def groups(c: _Content, kind: str, refs: list[int]) -> Iterator[tuple[str, int, int | None, int | None, list[str]]]:
        if kind == "table":
            rows, columns, title, cells = c.tables[refs[0]]
            own = [f"/tables/{refs[0]}"]
            for text, first, last in table_parts(*matrix(rows, columns, cells), target, most):
                text = f"{title}\n{text}".strip() if title else text
                yield from ((t, w, first, last, own) for t, w, _ in packed([text], target, most))
        elif kind == "figure":
            role, used = c.figures[refs[0]]
            text = "\n".join([c.said[k] for k in used])
            if role not in EXCLUDED_FIGURES and words_in(text) >= FIGURE_WORDS:
                yield from ((t, w, None, None, [f"/figures/{refs[0]}"]) for t, w, _ in packed([text], target, most))
        else:
            for t, w, units in packed([c.said[k] for k in refs], target, most):
                yield t, w, None, None, list(dict.fromkeys([f"/paragraphs/{refs[u]}" for u in units]))

    def made(batch: pa.RecordBatch, known: dict) -> Iterator[tuple]:
        ids, row, at = _plain(batch.column("document_id")), -1, 0
        for c in _read(batch.column("contents"), known):
            row, at = c.row, at if c.row == row else 0
            for kind, path, refs in c.order:
                number = refs[0] + 1 + (c.tables_before if kind == "table" else c.figures_before)
                for part, (content, words, first, last, elements) in enumerate(groups(c, kind, refs), 1):
                    if content:
                        at += 1
                        yield ids[row], at, kind, " > ".join(path), content, words, c.content_index, number, part, first, last, elements

    rows = _mapped(_slim(envelopes), schema, made)
    number = lambda name, n: F.concat("document_id", F.lit(f":{name}:"), F.format_string("%04d", F.col(n)))
    of = lambda kind, value: F.when(F.col("kind") == kind, value)
    return rows.select(
        "document_id", "chunk_index", number("chunk", "chunk_index").alias("chunk_id"), F.col("kind").alias("chunk_type"), "section_path", "content", "words", "content_index",
        of("table", number("table", "number")).alias("table_id"), of("table", F.col("part")).alias("table_part"), F.col("first_row").alias("table_row_start"), F.col("last_row").alias("table_row_end"),
        of("figure", number("figure", "number")).alias("figure_id"), "elements",
    )


def pages(envelopes: DataFrame) -> DataFrame:
    """(document_id, page_id, content_index, page_number, printed_labels, headers, footers, content, markdown) of every page.

    A paragraph is on every page that its regions name; pieces are in the order of the paragraphs.  Pages and paragraphs
    are told in one list, so envelopes are made once and what is on a page meets in one grouping.
    """
    slices = lambda g: F.transform(F.coalesce(g["spans"], F.array().cast("array<struct<offset:int,length:int>>")), lambda s: F.substr(F.col("markdown"), s["offset"] + 1, s["length"]))
    no_page, no_paragraph = F.expr("CAST(NULL AS struct<number:int,markdown:string>)"), F.expr("CAST(NULL AS struct<content:string,role:string,source:string>)")
    told = lambda p: F.struct(F.struct(*(p[c].alias(c) for c in ("content", "role", "source"))).alias("p"), no_page.alias("pg"))
    page = lambda g: F.struct(no_paragraph.alias("p"), F.struct(g["number"].alias("number"), F.array_join(slices(g), "").alias("markdown")).alias("pg"))
    none = F.expr("CAST(array() AS array<struct<p:struct<content:string,role:string,source:string>,pg:struct<number:int,markdown:string>>>)")
    listed = F.concat(*(F.coalesce(F.transform(c, made), none) for c, made in (("paragraphs", told), ("pages", page))))
    keys = ["document_id", "content_index", "page_number"]
    each = contents_of(envelopes).select("document_id", "content_index", F.posexplode(listed).alias("at", "x"))
    numbers = F.array_distinct(source_pages(F.coalesce("x.p.source", F.lit(""))))
    is_page = F.col("x.pg").isNotNull()
    text = F.trim(F.coalesce("x.p.content", F.lit("")))
    told = each.select(
        "document_id", "content_index", "at", text.alias("text"), F.coalesce("x.p.role", F.lit("")).alias("role"), is_page.alias("is_page"), F.col("x.pg.markdown").alias("markdown"),
        F.explode(F.when(is_page, F.array("x.pg.number")).when(text != "", F.filter(numbers, lambda n: n.isNotNull()))).alias("page_number"),
    )
    held = lambda cond: F.sort_array(F.collect_list(F.when(~F.col("is_page") & cond, F.struct("at", "text"))))  # noqa: E731  a page's paragraphs
    role = F.col("role")
    found = told.groupBy(*keys).agg(
        held(role == "pageHeader").alias("h"), held(role == "pageFooter").alias("f"), held(role == "pageNumber").alias("n"), held(~role.isin(*EXCLUDED)).alias("b"),
        F.collect_list(F.when(F.col("is_page"), F.struct("markdown"))).alias("pgs"),
    )
    texts = lambda c: F.col(c)["text"]
    return found.select(*keys, texts("n").alias("printed_labels"), texts("h").alias("headers"), texts("f").alias("footers"), F.array_join(texts("b"), "\n\n").alias("content"), F.inline("pgs")).select(
        "document_id", F.concat("document_id", F.lit(":page:"), F.format_string("%04d", "page_number")).alias("page_id"), "content_index", "page_number", "printed_labels", "headers", "footers", "content", "markdown"
    )


def table_diagnostics(contents: DataFrame) -> DataFrame:
    """(document_id, content_index, table_index, cells, empty, out_of_bounds, duplicate_positions, multi_page, source_less) of every table, each by itself."""
    keys = ["document_id", "content_index", "table_index"]
    tables = contents.select("document_id", "content_index", F.posexplode("tables").alias("table_index", "t")).select(*keys, "t.*")
    n_pages = F.size(F.array_distinct(source_pages(F.coalesce("source", F.lit("")))))
    outside = lambda x: (x["row"] < 0) | (x["row"] >= F.col("row_count")) | (x["col"] < 0) | (x["col"] >= F.col("column_count"))
    # cells of one place are neighbours in the order of places
    places = F.sort_array(F.arrays_zip(F.col("cells.row").alias("row"), F.col("cells.col").alias("col")))
    start = F.struct(F.expr("CAST(NULL AS struct<row:int,col:int>)").alias("last"), F.lit(0).alias("n"))
    again = F.aggregate(places, start, lambda a, x: F.struct(x.alias("last"), (a["n"] + a["last"].eqNullSafe(x).cast("int")).alias("n")), lambda a: a["n"])
    number = lambda c, name: F.coalesce(c, F.lit(0)).cast("long").alias(name)
    counted = lambda cond, name: number(F.when(F.col("cells").isNotNull(), F.size(F.filter("cells", cond))), name)
    return tables.select(
        *keys, number(F.when(F.col("cells").isNotNull(), F.size("cells")), "cells"), counted(lambda x: F.trim(F.coalesce(x["content"], F.lit(""))) == "", "empty"), counted(outside, "out_of_bounds"),
        number(again, "duplicate_positions"), (n_pages > 1).alias("multi_page"), (n_pages == 0).alias("source_less"),
    )


def structure_counts(envelopes: DataFrame) -> DataFrame:
    """(document_id, pages, tables, sections, figures, paragraphs) by the arrays of all contents."""
    total = lambda field: F.aggregate("contents", F.lit(0), lambda a, c: a + F.greatest(F.size(F.coalesce(c[field], F.array())), F.lit(0))).alias(field)
    return envelopes.select("document_id", *map(total, ("pages", "tables", "sections", "figures", "paragraphs")))


def merged_regions(sources: DataFrame, key: str) -> DataFrame:
    """(key, regions, pages, page_start, page_end): the distinct regions (page, polygon) of a key's ``source`` texts, by page, then polygon.

    A region without numbers has a null polygon and comes first of its page; a key without regions has empty arrays.
    """
    each = sources.select(key, F.explode_outer(source_regions(F.coalesce("source", F.lit("")))).alias("r"))
    distinct = each.select(key, "r.page", "r.polygon").distinct().groupBy(key)
    regions = F.array_sort(F.collect_list(F.when(F.col("page").isNotNull(), F.struct("page", "polygon"))))
    return distinct.agg(regions.alias("regions"), F.array_sort(F.collect_set("page")).alias("pages"), F.min("page").alias("page_start"), F.max("page").alias("page_end"))


def element_paths(chunks_: DataFrame) -> DataFrame:
    """Add qualified: the chunk's pointers with its content's number before them, distinct, in order."""
    return chunks_.withColumn("qualified", F.array_distinct(F.transform("elements", lambda e: F.concat(F.lit("/contents/"), F.col("content_index").cast("string"), e))))


def projected_tokens(envelopes: DataFrame) -> DataFrame:
    """(document_id, content_index, position, kind, token_text): texts in the order of reading, with paragraphs that no section lists."""

    def made(batch: pa.RecordBatch, known: dict) -> Iterator[tuple]:
        ids = _plain(batch.column("document_id"))
        for c in _read(batch.column("contents"), known, orphans=True):
            for position, (kind, _, refs) in enumerate(c.order):
                if kind == "text":
                    yield ids[c.row], c.content_index, position, kind, " ".join([c.said[k] for k in refs])

    return _mapped(_slim(envelopes), "document_id string, content_index int, position int, kind string, token_text string", made)


def combined_ranges(parts: DataFrame) -> DataFrame:
    """(document_id, contents, warnings, parts, pages, holes, overlaps, complete) of results of page ranges put together in order.

    ``parts`` is (document_id, first_page, last_page, expected_pages, contents) and may have warnings.  ``pages`` are
    those covered, ``holes`` and ``overlaps`` the (first, last) pages that no range or more than one covers, up to the
    expected pages or the last one covered.  A document is complete if there are neither and its pages are the expected ones.
    """
    if "warnings" not in parts.columns:
        parts = parts.withColumn("warnings", F.array().cast("array<string>"))
    none = F.coalesce("warnings", F.array().cast("array<string>"))
    part = F.struct("first_page", "last_page", "contents", none.alias("warnings"))
    got = parts.groupBy("document_id").agg(F.array_sort(F.collect_list(part)).alias("ps"), F.max("expected_pages").alias("expected"))  # a document's ranges
    # the number of ranges over a page changes at their bounds only
    edges = parts.where("last_page >= first_page").select("document_id", F.explode(F.array(F.struct(F.col("first_page").alias("at"), F.lit(1).alias("d")), F.struct((F.col("last_page") + 1).alias("at"), F.lit(-1).alias("d")))).alias("e"))
    whole = parts.groupBy("document_id").agg(F.max("expected_pages").alias("n")).where("n IS NOT NULL")
    bounds = whole.select("document_id", F.explode(F.array(F.lit(1).cast("long"), F.col("n") + 1)).alias("at")).withColumn("d", F.lit(0))
    steps = edges.select("document_id", F.col("e.at").cast("long").alias("at"), F.col("e.d").alias("d")).union(bounds).groupBy("document_id", "at").agg(F.sum("d").alias("d"))
    over = Window.partitionBy("document_id").orderBy("at")
    spans = steps.select("document_id", "at", F.sum("d").over(over).alias("n"), (F.lead("at").over(over) - 1).alias("to")).where("to IS NOT NULL")
    listed = lambda cond: F.array_sort(F.collect_list(F.when(cond, F.struct(F.col("at").alias("first"), F.col("to").alias("last")))))
    covered = spans.groupBy("document_id").agg(F.sum(F.when(F.col("n") > 0, F.col("to") - F.col("at") + 1)).alias("pages"), listed(F.col("n") == 0).alias("holes"), listed(F.col("n") > 1).alias("overlaps"))
    out = got.join(covered, "document_id", "left")
    pages_ = F.coalesce("pages", F.lit(0))
    none = F.expr("CAST(array() AS array<struct<first:bigint,last:bigint>>)")
    holes, overlaps = F.coalesce("holes", none), F.coalesce("overlaps", none)
    return out.select(
        "document_id", F.flatten(F.transform("ps", lambda p: p["contents"])).alias("contents"), F.flatten(F.transform("ps", lambda p: p["warnings"])).alias("warnings"), F.size("ps").alias("parts"),
        pages_.alias("pages"), holes.alias("holes"), overlaps.alias("overlaps"), F.coalesce((F.size(holes) == 0) & (F.size(overlaps) == 0) & (pages_ == F.col("expected")), F.lit(False)).alias("complete"),
    )


__all__ = ["chunks", "pages", "table_matrices", "walked"]
