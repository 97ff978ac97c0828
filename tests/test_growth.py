"""Plans whose work would grow faster than the input: what is read twice, shuffled again or computed for every element."""

import pyarrow as pa

from palimpsest.operators import enrichment, envelopes, html_records, rebuild, sequences
from palimpsest.plans import registry

DATA = "/root/testdata/sf0.001"


def plan(frame) -> str:
    return frame._jdf.queryExecution().sparkPlan().toString()


def scans(frame, table: str) -> int:
    return plan(frame).count(f"{table}.parquet")


def exchanges(frame) -> int:
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_chunks_are_read_packed_and_numbered_without_a_shuffle(spark):
    paragraphs = [{"content": f"word {k}", "role": None, "source": None} for k in range(3)]
    content = lambda *elements: {"paragraphs": paragraphs, "sections": [{"elements": list(elements), "offset": None}], "tables": None, "figures": None, "markdown": None, "pages": None}
    rows = spark.createDataFrame([("a", [content("/paragraphs/2", "/paragraphs/0"), None, content("/paragraphs/1\n", "/paragraphs/9")]), ("b", None), ("c", [])], envelopes.ENVELOPE)
    got = envelopes.chunks(rows)
    assert exchanges(got) == 0
    assert [(r.document_id, r.chunk_index, r.content_index, r.content, r.elements) for r in got.collect()] == [("a", 1, 0, "word 2\n\nword 0", ["/paragraphs/2", "/paragraphs/0"]), ("a", 2, 2, "word 1", ["/paragraphs/1"])]
    assert exchanges(registry.queries()["envelope_walk"](spark, DATA)) == 1


def test_chunks_hold_few_texts_at_a_time(spark):
    docs = spark.range(150).selectExpr("CAST(id AS int) AS doc_id", "CASE WHEN id % 3 > 0 THEN concat('Text ', id, repeat(' word', 250)) WHEN id > 9 THEN ' ' END AS text").coalesce(1)
    got = sequences.chunk_texts(docs)
    assert "ArrowEvalPython" not in plan(got) and "MapInArrow" in plan(got)  # a batch's chunks as one column of Python objects, before
    rows = got.collect()
    assert len(rows) == 100 and all(r.chunk_index == 1 and r.words == 252 and r.content.startswith(f"Text {r.doc_id} ") and r.chunk_id == f"{r.doc_id}:chunk:0001" for r in rows)
    assert got.schema["doc_id"].dataType.simpleString() == "int"


def test_projected_text_meets_by_document_as_it_lies(spark):
    assert exchanges(registry.queries()["projected_text"](spark, DATA)) == 3  # six before: lines twice each way, texts and runs again for the join


def test_projected_layouts_stay_where_their_documents_lie(spark):
    assert exchanges(registry.queries()["projected_layouts"](spark, DATA)) == 2  # one, read twice; five before


def test_pages_make_their_envelopes_once(spark):
    got = registry.queries()["envelope_pages"](spark, DATA)
    assert scans(got, "lineitem") == 1 and exchanges(got) == 1  # two and four before
    paragraphs = [{"content": c, "role": r, "source": s} for c, r, s in [("a", None, "D(1,0);D(2,x)"), (" ", None, "D(1,0)"), ("n", "pageNumber", "D(2,1)"), ("b", None, "D(2,1)"), ("c", None, "D(7,1)"), ("d", None, None)]]
    listed = [{"number": 2, "spans": [{"offset": 1, "length": 2}, {"offset": 4, "length": 1}]}, {"number": 1, "spans": None}, {"number": 2, "spans": []}, {"number": 3, "spans": []}]
    rows = spark.createDataFrame([("x", [{"paragraphs": paragraphs, "sections": None, "tables": None, "figures": None, "markdown": "uvwxyz", "pages": listed}, None])], envelopes.ENVELOPE)
    found = sorted((r.page_number, r.content, r.printed_labels, r.headers, r.markdown) for r in envelopes.pages(rows).collect())
    assert found == [(1, "a", [], [], ""), (2, "a\n\nb", ["n"], [], ""), (2, "a\n\nb", ["n"], [], "vwy"), (3, "", [], [], "")]


def test_table_diagnostics_look_at_each_table_by_itself(spark):
    got = registry.queries()["envelope_table_diagnostics"](spark, DATA)
    assert scans(got, "lineitem") == 1 and exchanges(got) == 1  # two and four before
    cells = [(0, 0, "a"), (0, 0, " "), (None, 0, None), (None, 0, "b"), (None, 1, "b"), (-1, 0, "c"), (1, None, "d"), (2, 0, "e"), (0, 0, "f")]
    table = lambda own: {"row_count": 2, "column_count": 1, "caption": None, "source": "D(1,0);D(1,2)", "cells": own}
    content = {"paragraphs": None, "sections": None, "tables": [table([dict(zip(("row", "col", "content", "kind"), (*c, None))) for c in cells]), table([]), table(None)], "figures": None, "markdown": None, "pages": None}
    rows = envelopes.table_diagnostics(envelopes.contents_of(spark.createDataFrame([("x", [content])], envelopes.ENVELOPE)))
    found = [tuple(r)[2:] for r in rows.orderBy("table_index").collect()]
    assert found == [(0, 9, 2, 3, 3, False, False), (1, 0, 0, 0, 0, False, False), (2, 0, 0, 0, 0, False, False)]


def test_pages_are_parsed_a_few_at_a_time():
    class Rows:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return list(run(iter([pa.RecordBatch.from_pydict({"page_id": list(range(150)), "html": [f"<html lang=x{k}><a href=y>z</a>" for k in range(150)]})])))

    out = html_records.parse_pages(Rows())
    assert [b.num_rows for b in out] == [64, 64, 22]  # one batch of 150 before
    assert [r["lang"] for b in out for r in b.to_pylist()] == [f"x{k}" for k in range(150)]


def test_tables_are_made_behind_one_shuffle(spark):
    assert exchanges(registry.queries()["table_records"](spark, DATA)) == 1  # two before


def test_relations_shuffle_documents_not_edges(spark):
    fields = ("filing_id", "company", "submitter")
    docs = [("d1", "f1", "A", "B"), ("d2", "f1", "A", "B"), ("D2 ", "f1", "a", "C"), ("d2", None, "A", None), (None, "f1", "A", "B"), (None, "f1", "A", "B"), (" ", "f2", "A", None)]
    rows = spark.createDataFrame(docs, "document_id string, filing_id string, company string, submitter string").selectExpr("document_id", *(c if c in fields else f"CAST(NULL AS string) AS {c}" for c in enrichment.FIELDS))
    got = enrichment.derived_relations(rows)
    assert "hashpartitioning(_key" in got._jdf.queryExecution().executedPlan().toString()  # by the edges' ids alone before
    every = enrichment._edges(rows)
    ids = [r.id for r in got.collect()]
    assert len(ids) == len(set(ids)) and set(ids) == {r.id for r in every.collect()} and len(ids) < every.count()


def test_used_entities_take_relations_without_shuffling_them(spark):
    assert "hashpartitioning(_key" in registry.queries()["used_entities"](spark, DATA)._jdf.queryExecution().executedPlan().toString()


def test_only_texts_with_another_version_are_cut_into_tokens(spark):
    shown = registry.queries()["pairwise_scores"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert shown.find("regexp_extract_all(") < shown.find("Join ")  # tokens of all texts went into the join before


def test_overlay_counts_ids_apart_from_analyses(spark):
    shown = registry.queries()["overlay_counts"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in shown and "ExistingRDD" not in plan(registry.queries()["overlay_counts"](spark, DATA))
    documents = shown[: shown.index("analysis AS")]  # joined twice with the manifests beside the analyses before, all ids in one task
    assert documents.count("Join ") == 1 and "first(" not in shown


def test_overlay_takes_any_artifact_that_bears_a_manifest_out(spark):
    facts = ", ".join(f"'{c}' AS {c}" for c in rebuild.FACTS)
    manifests = spark.sql(f"SELECT id AS document_id, CASE WHEN id <> 'e' THEN id END AS inner_id, {facts} FROM VALUES ('a'), ('a'), ('c'), ('e'), (NULL) AS t(id)")
    rebuilt = spark.sql(f"SELECT id AS document_id, {facts}, h AS sha256 FROM VALUES ('a', 'aa'), ('b', 'aa'), (NULL, 'aa') AS t(id, h)")
    counts = "CAST(1 AS bigint) AS pages, CAST(1 AS bigint) AS tables, CAST(1 AS bigint) AS sections, CAST(1 AS bigint) AS warnings"
    own = spark.sql(f"SELECT 'a' AS document_id, 'AA' AS sha256, 'l' AS analyzer, '1' AS version, p AS path, s AS size, h AS artifact_sha256, '2024' AS updated_at, {counts} FROM VALUES ('r1', 9, 'FF'), ('r1', NULL, 'FF'), ('r2', NULL, NULL), (NULL, 9, 'FF') AS t(p, s, h)")
    seen = spark.sql("SELECT p AS path, s AS size, h AS sha256 FROM VALUES ('r1', 8, 'ff'), ('r1', 9, 'fF'), ('r1', 9, 'ff'), ('r2', NULL, NULL), (NULL, 9, 'ff') AS t(p, s, h)").coalesce(1)
    analyses = spark.sql(f"SELECT 'a' AS document_id, 'aa' AS sha256, 'l' AS analyzer, '1' AS version, {counts}")
    got = {(r.entity, r.outcome): r.n for r in rebuild.overlay(rebuilt, manifests, analyses, own, seen).counts.collect()}
    assert got == {("document", "updated"): 1, ("document", "missing_document"): 1, ("document", "invalid_manifest"): 2, ("analysis", "restored"): 2, ("analysis", "invalid"): 2}  # the first artifact at r1 alone before


def test_relations_shuffle_documents_once(spark):
    for name in ("document_relations", "used_entities"):
        got = registry.queries()[name](spark, DATA)
        got.collect()
        ran = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert any("ReusedExchange" in line and "_key#" in line for line in ran.splitlines())  # once for each branch before
    lines = [line for line in plan(registry.queries()["used_entities"](spark, DATA)).splitlines() if "bigint) % 2) = 0" in line]
    assert lines and not any("_we0#" in line for line in lines)  # wanted documents alone are shuffled; all of them before
