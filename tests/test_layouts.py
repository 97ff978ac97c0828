"""The second layout format against the common one, ranges with holes, regions with polygons, groups by running sums."""

import random

from palimpsest.operators import envelopes, layout_projection, sequences
from palimpsest.operators.layout_projection import NATIVE


def box(page, *numbers):
    return [{"page_no": page, "bbox": dict(zip("ltrb", numbers))}]


def text(said, label="text", page=1, orig=None):
    return {"text": said, "orig": orig, "label": label, "prov": box(page, 1.0, 2.0, 3.0, 4.00005) if page else []}


def cell(said, header=False, **more):
    return {"text": said, "column_header": header, "row_header": None, "prov": None, "start_row_offset_idx": None, "start_col_offset_idx": None, "row_span": None, "col_span": None} | more


def native(spark, *docs):
    base = {"texts": None, "tables": None, "pages": None, "page_markdown": None, "markdown": None}
    return spark.createDataFrame([base | {"document_id": f"d{k}"} | d for k, d in enumerate(docs)], NATIVE)


TABLE = {"prov": box(2, 0.0, 0.0, 1.0, 1.0), "num_rows": None, "num_cols": None, "grid": [[cell("year", True), cell("tons", True)], [cell("1901"), None], [cell("1902"), cell("7 ")]]}
TEXTS = [text("Annual report", "title"), text("Running head", "page_header"), text("Tonnage", "section_header"), text(" First words of the report \n"), text("  "), text(None, orig="Second, as read"), text("On page two", page=2), text("3", "page_footer", 2), text("No page", page=None)]


def test_both_formats_of_a_document_give_equal_chunks(spark):
    common = {
        "document_id": "d0",
        "contents": [
            {
                "paragraphs": [{"content": c, "role": r, "source": None} for c, r in [("Annual report", "title"), ("Running head", "pageHeader"), ("Tonnage", "sectionHeading"), ("First words of the report", None), ("Second, as read", None), ("On page two", None), ("3", "pageFooter"), ("No page", None)]],
                "sections": [{"elements": [f"/paragraphs/{k}" for k in (7, 0, 1, 2, 3, 4, 5, 6)] + ["/tables/0"], "offset": 0}],
                "tables": [{"row_count": 3, "column_count": 2, "caption": None, "source": None, "cells": [{"row": r, "col": c, "content": v, "kind": "columnHeader" if r == 0 else "content"} for r, c, v in [(0, 0, "year"), (0, 1, "tons"), (1, 0, "1901"), (2, 0, "1902"), (2, 1, "7 ")]]}],
                "figures": [], "markdown": "", "pages": [],
            }
        ],
    }
    one = envelopes.chunks(spark.createDataFrame([common], envelopes.ENVELOPE))
    other = envelopes.chunks(layout_projection.projected_envelopes(native(spark, {"texts": TEXTS, "tables": [TABLE]})))
    assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))
    assert [r.content for r in other.orderBy("chunk_index").collect()] == ["No page\n\nAnnual report\n\nFirst words of the report\n\nSecond, as read\n\nOn page two", "year\ttons\n1901\n1902\t7"]


def test_projection(spark):
    rows = native(
        spark, {"texts": TEXTS, "tables": [None, TABLE], "pages": {"1": (612.0, 792.0), "9": (1.0, 1.0)}, "page_markdown": {1: "abc", 2: ""}}, {"pages": {"10": (1.0, 2.0), "2": (3.0, 4.0), "x": (0.0, 0.0)}, "page_markdown": {2: "four", 10: "t"}}, {"texts": [], "tables": []}, {"document_id": None, "texts": TEXTS},
        {"tables": [{"prov": None, "num_rows": 5, "num_cols": 0, "grid": None}, {"prov": box(3, None, 1.0, 1.0, 1.0), "num_rows": 0, "num_cols": None, "grid": [None, [cell("a", row_header=True, start_row_offset_idx=4, col_span=3)]]}]},
    )
    out = {r.document_id: r.contents[0] for r in layout_projection.projected_envelopes(rows).collect()}
    assert set(out) == {"d0", "d1", "d2", "d4"}
    ps = out["d0"].paragraphs
    assert [p.span.offset for p in ps] == [0, 15, 29, 38, 65, 82, 95, 98] and [p.role for p in ps][:3] == ["title", "pageHeader", "sectionHeading"]
    assert ps[0].source == "D(1,1.0000,2.0000,3.0000,4.0001)" or ps[0].source.startswith("D(1,1.0000,2.0000,3.0000,4.000")
    assert ps[7].source is None
    assert out["d0"].sections[0].elements == [f"/paragraphs/{k}" for k in (7, 0, 1, 2, 3, 4, 5, 6)] + ["/tables/0"]
    assert [(p.number, p.width, p.spans[0].offset, p.spans[0].length) for p in out["d0"].pages] == [(1, 612.0, 0, 3), (2, None, 5, 0)]
    assert [(p.number, p.spans[0].offset, p.spans[0].length) for p in out["d1"].pages] == [(2, 0, 4), (10, 6, 1)]  # pages that the format lists, where no element names one
    assert out["d1"].sections == out["d2"].sections == [] and out["d2"].paragraphs == [] and out["d2"].tables == [] and out["d2"].pages == []
    a, b = out["d4"].tables
    assert (a.row_count, a.column_count, a.cells, a.source) == (5, 0, [], None)
    assert (b.row_count, b.column_count, b.source) == (2, 1, "D(3)")
    assert [(c.row, c.col, c.kind, c.row_span, c.col_span, c.source) for c in b.cells] == [(4, 0, "rowHeader", 1, 3, "D(3)")]
    assert out["d4"].sections[0].elements == ["/tables/0", "/tables/1"]


def test_ranges(spark):
    rows = [("ok", 1, 300, 600, ["a"]), ("ok", 301, 600, 600, ["b", "c"]), ("twice", 1, 300, 600, ["a"]), ("twice", 1, 300, 600, ["b"]), ("hole", 1, 10, 40, ["a"]), ("hole", 21, 40, 40, ["b"]), ("over", 5, 12, 10, None), ("none", 7, 3, 5, ["x"]), ("open", 1, 4, None, ["y"])]
    frame = spark.createDataFrame(rows, "document_id string, first_page int, last_page int, expected_pages int, contents array<string>").selectExpr("*", "array('w' || first_page) AS warnings")
    got = {r.document_id: r for r in envelopes.combined_ranges(frame).collect()}
    spans = lambda xs: [(x["first"], x["last"]) for x in xs]
    assert (got["ok"].contents, got["ok"].warnings, got["ok"].parts, got["ok"].pages, got["ok"].complete) == (["a", "b", "c"], ["w1", "w301"], 2, 600, True)
    assert (got["twice"].pages, spans(got["twice"].holes), spans(got["twice"].overlaps), got["twice"].complete) == (300, [(301, 600)], [(1, 300)], False)  # two ranges as long as the whole aren't the whole
    assert (spans(got["hole"].holes), got["hole"].pages, got["hole"].complete) == ([(11, 20)], 30, False)
    assert (spans(got["over"].holes), got["over"].pages, got["over"].complete) == ([(1, 4)], 8, False)
    assert (spans(got["none"].holes), got["none"].pages, got["none"].complete) == ([(1, 5)], 0, False)
    assert (got["open"].pages, got["open"].complete) == (4, False)
    assert envelopes.combined_ranges(frame.limit(0).drop("warnings")).collect() == []


def test_regions(spark):
    rows = [("a", "D(2,1.0,2.0);D(1,5.0)"), ("a", "D(2,1.0,2.0);D(2,x)"), ("b", None), ("c", "")]
    got = {r.k: r for r in envelopes.merged_regions(spark.createDataFrame(rows, "k string, source string"), "k").collect()}
    assert [(r.page, r.polygon) for r in got["a"].regions] == [(1, [5.0]), (2, None), (2, [1.0, 2.0])]
    assert (got["a"].pages, got["a"].page_start, got["a"].page_end) == ([1, 2], 1, 2)
    assert got["b"].regions == got["c"].regions == [] and got["b"].page_start is None


def plain_groups(sizes, target, most, later):
    """The first end that a group may have, by its sums."""
    out = []
    while (at := out[-1][1] if out else 0) < len(sizes):
        room = most - (later if out else 0)
        out.append((at, next(e for e in range(at + 1, len(sizes) + 1) if e == len(sizes) or sum(sizes[at:e]) >= target or sum(sizes[at : e + 1]) > room)))
    return out


def test_groups_by_running_sums():
    rng = random.Random(6)
    for _ in range(3000):
        sizes = [rng.randrange(1, 9) for _ in range(rng.randrange(12))]
        target, most = rng.randrange(1, 12), rng.randrange(1, 14)
        later = rng.choice([0, 0, 2, 30])
        assert list(sequences.groups_of(sizes, target, most, later)) == plain_groups(sizes, target, most, later), (sizes, target, most, later)
