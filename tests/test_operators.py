"""Operators and functions on small written inputs."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.functions import text as fx
from palimpsest.operators import aggregates, envelopes, graph, ledger, retrieval, sequences
from palimpsest.sources import tables


def value(spark, column, **inputs):
    row = spark.createDataFrame([tuple(inputs.values())], ", ".join(f"{k} string" for k in inputs)) if inputs else spark.range(1)
    return row.select(column.alias("v")).first().v


@pytest.mark.parametrize("sizes, groups", [([2, 2, 2, 2], [0, 0, 1, 1]), ([3, 3], [0, 1]), ([5, 1], [0, 1]), ([], []), ([9], [0])])
def test_packing(spark, sizes, groups):
    got = spark.createDataFrame([(sizes,)], "s array<int>").select(sequences.pack(F.col("s"), 4, 5).alias("v")).first().v
    assert got == groups


@pytest.mark.parametrize("text, iso", [("2024/01/02", "2024-01-02"), ("03/04/2024", "2024-04-03"), ("13/13/2024", None), ("", None), (None, None)])
def test_dates(spark, text, iso):
    assert value(spark, fx.normalize_date(F.col("d")), d=text) == iso


@pytest.mark.parametrize("text, iso", [("2024-02-31", "2024-02-29"), ("2023-02-31", "2023-02-28"), ("2024-13-01", None), ("x", None)])
def test_days_past_the_end_of_a_month(spark, text, iso):
    assert value(spark, fx.validate_date(F.col("d")), d=text) == iso


def test_regions(spark):
    got = value(spark, fx.source_regions(F.col("d")), d="D(1,2.0,3.0);D(2,4,x)")
    assert [(r.page, r.polygon) for r in got] == [(1, [2.0, 3.0]), (2, None)]


def test_pointers(spark):
    got = [value(spark, fx.element_pointer(F.col("p")), p=p) for p in ("/tables/3", "/foo/1")]
    assert [(r["kind"], r["index"]) for r in got] == [("tables", 3), (None, None)]


def test_natural_order(spark):
    rows = spark.createDataFrame([(x,) for x in ("10", "9", "paper:4:A", "2")], "k string")
    assert [r.k for r in rows.orderBy(*fx.natural_order(F.col("k"))).collect()] == ["2", "9", "10", "paper:4:A"]


def test_stable_ids(spark):
    a = value(spark, fx.stable_id("p", F.col("x"), F.col("y"), F.col("z")), x="A ", y="", z="b")
    assert a == value(spark, fx.stable_id("p", F.col("x"), F.col("y")), x="a", y="b") and len(a) == 2 + 24


def test_intervals(spark):
    rows = spark.createDataFrame([(1, "2024-01-01", "2024-01-03"), (1, "2024-01-04", "2024-01-05"), (1, "2024-01-09", "2024-01-09")], "k int, s string, e string")
    rows = rows.select("k", F.to_date("s").alias("s"), F.to_date("e").alias("e"))
    got = sequences.merge_intervals(rows, "k", "s", "e").orderBy("island").collect()
    assert [(r.start_day.day, r.end_day.day, r.gap_days, r.next_day.day) for r in got] == [(1, 5, 3, 6), (9, 9, 0, 10)]


def test_batches(spark):
    rows = spark.createDataFrame([("k", i, s) for i, s in enumerate([4, 4, 4, 20, 1])], "k string, i int, s int")
    got = sequences.bounded_batches(rows, "k", "i", F.col("s"), 10, 9).orderBy("i").collect()
    assert [r.batch for r in got] == [1, 1, 2, 3, 4] and [r.oversized for r in got] == [False, False, False, True, False]


def test_json_lines(spark, tmp_path):
    schema = T.StructType.fromDDL("id string, n int")
    (tmp_path / "good.jsonl").write_text(json.dumps({"id": "a", "n": 1}) + "\n\n" + json.dumps({"id": "b"}) + "\n")
    (tmp_path / "bad.jsonl").write_text('{"id": "a"}\nnot json\n')
    assert [tuple(r) for r in tables.strict_jsonl(spark, f"{tmp_path}/good.jsonl", schema, ("id",)).collect()] == [("a", 1), ("b", None)]
    with pytest.raises(Exception, match="not a JSON object"):
        tables.strict_jsonl(spark, f"{tmp_path}/bad.jsonl", schema).collect()
    assert tables.lenient_jsonl(spark, f"{tmp_path}/bad.jsonl", schema).count() == 1


def envelope(spark, *contents):
    """Rows of one document of written contents; what a content leaves out is empty."""
    shape = T.StructType.fromDDL(envelopes.ENVELOPE)
    empty = {"paragraphs": [], "sections": [], "tables": [], "figures": [], "markdown": "", "pages": []}
    return spark.createDataFrame([{"document_id": "d", "contents": [empty | c for c in contents]}], shape)


def paragraph(content, role=None, page=1):
    return {"content": content, "role": role, "source": f"D({page},1.0)"}


def section(*elements, offset=0):
    return {"elements": list(elements), "offset": offset}


def test_deeply_nested_sections_keep_their_text(spark):
    """Sections nested 6 deep, a cycle of two, one that is listed twice, and one without a heading."""
    heads = [paragraph(f"H{i}", "sectionHeading") for i in range(6)]
    texts = [paragraph(f"text {i} of all") for i in range(12)]
    chain = [section(f"/paragraphs/{i}", f"/paragraphs/{6 + i}", *([f"/sections/{i + 1}"] if i < 5 else [])) for i in range(6)]
    more = [section("/paragraphs/12", "/sections/7", offset=9), section("/paragraphs/13", "/sections/6", offset=8), section("/paragraphs/14", "/sections/9", offset=10), section("/paragraphs/15")]
    got = envelopes.chunks(envelope(spark, {"paragraphs": heads + texts, "sections": chain + more})).orderBy("chunk_index").collect()
    assert [r.content for r in got] == [f"text {i} of all" for i in (0, 1, 2, 3, 4, 5, 8, 9, 7, 6)]
    assert [r.section_path for r in got[:6]] == [" > ".join(f"H{j}" for j in range(i + 1)) for i in range(6)]


def test_what_never_reaches_a_chunk(spark):
    """Headers, footers, page numbers, blanks and paragraphs of no section; they are on their pages all the same."""
    ps = [paragraph("Head", "pageHeader"), paragraph("T", "sectionHeading"), paragraph("body one"), paragraph("7", "pageNumber"), paragraph("Foot", "pageFooter", 2), paragraph(" "), paragraph("in no section"), paragraph("body two", page=2)]
    rows = envelope(spark, {"paragraphs": ps, "sections": [section(*(f"/paragraphs/{k}" for k in (0, 1, 2, 3, 4, 5, 7, 99)), "/nothing/1")], "pages": [{"number": 1, "spans": [{"offset": 0, "length": 3}]}, {"number": 2, "spans": [{"offset": 3, "length": 2}]}], "markdown": "abécd"})
    got = envelopes.chunks(rows).collect()
    assert [(r.content, r.section_path, r.elements) for r in got] == [("body one\n\nbody two", "T", ["/paragraphs/2", "/paragraphs/7"])]
    pages = {r.page_number: r for r in envelopes.pages(rows).collect()}
    assert (pages[1].headers, pages[1].printed_labels, pages[1].content, pages[1].markdown) == (["Head"], ["7"], "T\n\nbody one\n\nin no section", "abé")
    assert (pages[2].footers, pages[2].content, pages[2].markdown, pages[2].page_id) == (["Foot"], "body two", "cd", "d:page:0002")
    tokens = envelopes.projected_tokens(rows).orderBy("position").collect()
    assert [r.token_text for r in tokens] == ["body one body two", "in no section"]


def test_tables_and_figures(spark):
    """Cells by place, headers before later parts, captions, tables and figures that no section lists, numbers over all contents."""
    cell = lambda r, c, x, kind="content": {"row": r, "col": c, "content": x, "kind": kind}
    table = {"row_count": 4, "column_count": 3, "caption": "Cap", "source": "D(1,1.0)", "cells": [cell(0, 0, "h", "columnHeader"), cell(1, 0, "a"), cell(1, 2, "c"), cell(1, 0, "A"), cell(2, 3, "out"), cell(3, 1, "x y z")]}
    figure = lambda *ks, role=None: {"role": role, "figure_id": "f", "source": "D(1,1.0)", "elements": [f"/paragraphs/{k}" for k in ks]}
    ps = [paragraph("one two"), paragraph("three"), paragraph("foot", "pageFooter")]
    one = {"paragraphs": ps, "sections": [section("/figures/0", "/tables/0")], "tables": [table], "figures": [figure(0), figure(0, 1, 2), figure(0, 1, role="pageHeader")]}
    got = envelopes.chunks(envelope(spark, one, {"tables": [table]}), target=3, most=4).orderBy("chunk_index").collect()
    lines = envelopes.table_matrices(envelopes.contents_of(envelope(spark, one))).first()
    assert lines.lines == ["h", "A\t\tc", "", "\tx y z"] and lines.header_rows == [0]
    of = [r for r in got if r.content_index == 0]
    assert [(r.chunk_type, r.table_part, r.table_row_start, r.table_row_end) for r in of] == [("table", 1, 0, 1), ("table", 2, 3, 3), ("table", 3, 3, 3), ("figure", None, None, None)]
    assert of[0].content == "Cap\nh\nA\t\tc" and [r.content for r in of[1:3]] == ["Cap h x y", "z"] and of[3].content == "one two\nthree"
    assert {r.table_id for r in got if r.chunk_type == "table"} == {"d:table:0001", "d:table:0002"} and [r.figure_id for r in got if r.chunk_type == "figure"] == ["d:figure:0002"]
    assert [r.chunk_index for r in got] == list(range(1, len(got) + 1))


def test_table_parts():
    lines = ["h1 h2", "a b c", "", "d e f", "g"]
    assert envelopes.table_parts(lines, [0], 5, 6) == [("h1 h2\na b c", 0, 1), ("h1 h2\nd e f\ng", 3, 4)]
    assert envelopes.table_parts([], [], 5, 6) == [] and envelopes.table_parts(["", " "], [0], 5, 6) == []


def test_oversized_texts():
    s = lambda n, end=".": " ".join(["Word"] + ["w"] * (n - 1)) + end
    assert sequences.split_text(s(3), 4, 5) == [s(3)]
    assert sequences.split_text(s(12, ""), 4, 5) == [" ".join(["Word"] + ["w"] * 4), "w w w w w", "w w"]
    parts = sequences.split_text(f"{s(2)} {s(12)} {s(2)} {s(3)}", 4, 5)  # a long sentence is kept apart, its tail too
    assert [len(p.split()) for p in parts] == [2, 5, 5, 2, 5]
    assert [(n, u) for _, n, u in sequences.packed(["a b", "c d", "e f", "g"], 4, 5)] == [(4, [0, 1]), (3, [2, 3])]
    assert [n for _, n, _ in sequences.packed(["a b c d e", "f"], 4, 5)] == [5, 1]


def test_chunks_of_rows_that_share_an_id(spark):
    rows = [(1, "One text. It is short."), (1, "Another text."), (None, "No id here."), (None, None), (2, "")]
    got = sequences.chunk_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.content, r.chunk_index) for r in got) == [("1", "Another text.", 1), ("1", "One text. It is short.", 1), ("None", "No id here.", 1)]


def test_upsert_takes_the_last_new_row(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, s string, h int")
    new = spark.createDataFrame([(1, "", 5, 1), (1, "z", 6, 2), (3, "n", 7, 1), (3, "", 8, 2)], "k int, s string, h int, seq int")
    got = {r.k: (r.s, r.h, r.state) for r in ledger.upsert(old, new, "k", ["s"], ["h"], "seq").collect()}
    assert got == {1: ("z", 6, "updated"), 2: ("b", 1, "kept"), 3: (None, 8, "inserted")}


def test_nearest_rank_over_bands(spark):
    r = random.Random(3)
    rows = [(k, v) for k in "ab" for v in [r.choice([0.5, 1e9, -3.0, r.random()]) for _ in range(500)]] + [("c", 7.0), ("c", None), ("d", None)]
    got = {x.k: x for x in aggregates.nearest_rank(spark.createDataFrame(rows, "k string, v double"), "k", "v", {"p50": 0.5, "p90": 0.9}).collect()}
    for k in "abc":
        own = sorted(v for key, v in rows if key == k and v is not None)
        assert (got[k].n, got[k].p50, got[k].p90, got[k].max_value) == (len(own), own[-(-len(own) // 2) - 1], own[-(-9 * len(own) // 10) - 1], own[-1])
    assert "d" not in got


def test_cosine_with_nulls_ties_and_other_lengths(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [1.0]), (6, [1.0, None]), (7, [2.0, 0.0]), (None, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = retrieval.cosine_top_k(frame, frame.where("vec_id IN (1, 4, 5)"), 2).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [(1, 1, 2), (1, 2, 7)]
    assert retrieval.cosine_top_k(frame, frame.where("vec_id = 4"), 2).count() == 0


def test_closure_ends_with_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("b", "d")], "parent string, child string")
    got = {(r.ancestor, r.descendant): r.depth for r in graph.closure(edges, 20).collect()}
    assert got[("a", "d")] == 2 and got[("c", "d")] == 3 and got[("a", "a")] == 3 and len(got) == 12
    items, counters = graph.contained_items(edges, spark.createDataFrame([("a",)], "id string"), depth=20, most=3)
    assert {r.id: (r.depth, r.kept) for r in items.collect()} == {"a": (0, True), "b": (1, True), "c": (2, True), "d": (2, False)}
    assert counters.first().beyond_limit == 1


def test_scopes_are_required(spark):
    with pytest.raises(ValueError, match="scope"):
        retrieval.scoped(spark.range(1), {"company": " ", "project": None})
