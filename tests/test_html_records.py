"""Records of registry pages: result rows, facets, details."""

from palimpsest.operators import html_records

ROWS = """<table><tbody>
<tr><td><summary><i title="Document"></i><a href="/help">?</a><a href="/item/11">First one</a></summary><details>Company: <a href="/item/5">Acme</a> Project: <a href="/item/6">Line 3</a> <a href="/item/7">Filing: C123</a></details></td><td>2024-01-02</td><td>Jo</td></tr>
<tr><td><a href="/download/12">Second</a></td><td>2024-01-03</td><td>Al</td></tr>
<tr><td><a href="/item/13">A9Z8Y7 on paper</a> Paper Only</td><td></td><td></td></tr>
<tr><td><a href="/item/13">A9Z8Y7 on paper</a> Paper Only</td><td></td><td></td></tr>
<tr><td>no link</td><td>x</td><td>y</td></tr></tbody></table>"""
DETAIL = """<html lang="en"><head><title>T</title><meta name="viewport" content="width=device-width, initial-scale=1"><meta name="description" content="About it"></head><body>
<dl><dt>Filing No:</dt><dd>C99</dd><dt>Date</dt><dd>2024-05-06</dd><dt>Date</dt><dd>2024-05-07</dd></dl><table><tr><th>Company</th><td>Acme</td></tr><tr><td>Project:</td><td>Line 3</td></tr><tr><td>Role</td><td>role</td></tr></table>
<script type="application/ld+json">{"author": "Jo", "n": [1]}</script><label for="s1">Document Type</label><select id="s1"><option value="">All</option><option value="4">Order</option></select></body></html>"""


def parsed(spark, *pages):
    return html_records.parse_pages(spark.createDataFrame(list(enumerate(pages)), "page_id long, html string"))


def test_result_rows(spark):
    rows = sorted(html_records.result_records(parsed(spark, ROWS)).collect(), key=lambda r: r.document_id)
    assert [(r.document_id, r.name, r.is_file, r.date_raw, r.submitter) for r in rows][:2] == [("11", "First one", False, "2024-01-02", "Jo"), ("12", "Second", True, "2024-01-03", "Al")]
    assert (rows[0].filing_number, rows[0].company, rows[0].project, rows[0].kind) == ("C123", "Acme", "Line 3", "Document") and len(rows) == 4


def test_rows_of_a_container_get_ids_of_their_own(spark):
    rows = html_records.result_records(parsed(spark, ROWS), container="77").collect()
    ids = sorted(r.document_id for r in rows)
    assert ids[:2] == ["11", "12"] and ids[2] == "paper:77:A9Z8Y7" and ids[3].startswith("paper:77:A9Z8Y7:") and len(set(ids)) == 4
    assert {r.kind for r in rows if r.identity != "item"} == {"Paper Only"} and not any(r.is_file for r in rows if r.identity != "item")


def test_details_and_facets(spark):
    page = parsed(spark, DETAIL, None, "<p>broken <table><tr><td>a")
    details = html_records.detail_fields(page)
    assert {r.field: r.value for r in html_records.first_fields(details).collect()} == {"filing_number": "C99", "date": "2024-05-06", "company": "Acme", "project": "Line 3", "description": "About it"}
    assert ("json:author", "Jo") in {(r.label, r.value) for r in details.collect()}
    assert [tuple(r) for r in html_records.facet_catalogue(page).collect()] == [("Document Type", "4", "Order")]
