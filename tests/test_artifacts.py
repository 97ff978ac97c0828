"""Artifact checks on hand-written payloads, and the selection of documents to analyze."""

import json

from palimpsest.operators import artifacts

SCHEMA = "document_id string, analyzer string, version string, payload string, markdown_file string, page_count int, table_count int, section_count int, source_pages int, conversion_status string"
GOOD = {"analyzerId": "a", "apiVersion": "1", "contents": [{"markdown": "x", "pages": [1, 2], "tables": [{}]}, {"markdown": "y", "sections": [{}]}]}


def problems(spark, payload, **more):
    row = {"document_id": "d", "analyzer": "a", "version": "1", "payload": payload if payload is None or isinstance(payload, str) else json.dumps(payload), "markdown_file": "x\n\ny", "page_count": None, "table_count": None, "section_count": None, "source_pages": None, "conversion_status": None} | more
    checked = artifacts.checked_artifacts(spark.createDataFrame([row], SCHEMA))
    assert checked.columns == [*row, "problems", "usable"]
    return checked.first()


def test_payloads(spark):
    def reasons(payload, **more):
        r = problems(spark, payload, **more)
        return [p.reason for p in r.problems], r.usable

    assert reasons(GOOD) == ([], True)
    assert reasons(None) == (["missing"], False)
    for bad in ("{", "", "null", "3", '"text"', "[]"):
        assert reasons(bad) == (["not_an_object"], False), bad
    assert reasons({}) == (["analyzer", "version", "contents"], False)
    assert reasons(GOOD | {"analyzerId": "", "analyzer_id": "a", "apiVersion": None, "api_version": "2"}) == (["version"], False)
    assert reasons(GOOD | {"contents": {"markdown": "x"}}) == (["contents"], False) == reasons(GOOD | {"contents": None})
    assert reasons(GOOD | {"contents": []}) == (["contents_empty"], False)
    r = problems(spark, GOOD | {"contents": [{"markdown": "x"}, None, {"markdown": 5}]})
    assert [(p.reason, p.actual) for p in r.problems] == [("content_not_an_object", "1"), ("markdown_missing", "2")]
    assert reasons(GOOD | {"contents": [{"markdown": "", "pages": None}]}, markdown_file="") == ([], True)
    assert reasons(GOOD, markdown_file="x\ny") == (["markdown_differs"], False)
    assert reasons(GOOD, markdown_file=None) == (["markdown_file_missing"], True)
    r = problems(spark, GOOD, source_pages=3, page_count=2, table_count=2, section_count=0)
    assert [(p.level, p.reason, p.expected, p.actual) for p in r.problems] == [("error", "source_pages", "3", "2"), ("warning", "table_count", "2", "1"), ("warning", "section_count", "0", "1")]
    assert reasons(GOOD, conversion_status="failure") == (["conversion"], False) and reasons(GOOD, conversion_status="partial_success") == (["partial_success"], True)
    assert artifacts.artifact_problems(artifacts.checked_artifacts(spark.createDataFrame([], SCHEMA))).collect() == []


def test_selection(spark):
    files = spark.createDataFrame([("10", 5, "A", True), ("10", 4, "B", True), ("9", 1, "C", True), ("9", 0, "C0", False), ("x", 7, "D", True), ("2", 8, "E", True), ("3", 9, "F", True), (None, 11, "G", True)], "document_id string, file_id int, sha256 string, is_current boolean")
    analyses = spark.createDataFrame([(4, "B", "SUCCEEDED"), (4, "B", "FAILED"), (1, "C", "SUCCEEDED"), (7, "D", "FAILED"), (8, "E", "SUCCEEDED"), (9, "old", "SUCCEEDED")], "file_id int, sha256 string, status string")
    known = spark.createDataFrame([("10", "B", False), ("10", "B", True), ("9", "C", False), ("x", "D", True), ("2", "E2", True)], "document_id string, sha256 string, usable boolean")
    got = artifacts.to_analyze(files, analyses, known)
    assert {r.document_id: (r.file_id, r.reason) for r in got.collect()} == {"9": (1, "artifact"), "x": (7, "status"), "2": (8, "artifact"), "3": (9, "new")}
    assert [r.document_id for r in artifacts.to_analyze(files, analyses, known, limit=3).collect()] == ["2", "3", "9"]
    forced = artifacts.to_analyze(files, analyses, known, force=True, limit=9).collect()
    assert [r.document_id for r in forced] == ["2", "3", "9", "10", "x"] and {r.reason for r in forced} == {"forced"}
