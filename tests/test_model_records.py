"""A model's answers: every rule by its own, duplicates, and what is left of odd answers."""

import json

from palimpsest.operators import model_records

ANSWER = "document_id string, batch long, response string, chunk_ids array<string>"
EVENT = {"event_type": "filed", "title": "A", "summary": "s", "date_start": "1997", "confidence": 0.5, "evidence_chunk_ids": ["c1"]}
LINK = {"source_name": "Ann", "source_type": "person", "target_name": "Ox Ltd", "target_type": "organization", "relationship_type": "LEADS", "evidence_chunk_ids": ["c2", "c1", "c2"]}
EMPTY = {"events": [], "claims": [], "obligations": [], "relationships": []}


def answers(spark, *responses):
    rows = [("d", k, r if r is None or isinstance(r, str) else json.dumps(r), ["c1", "c2"]) for k, r in enumerate(responses)]
    return model_records.checked_answers(spark.createDataFrame(rows, ANSWER))


def test_rules(spark):
    cases = [
        (EMPTY, None), (None, "response"), ("{", "response"), ([], "response"), ({}, "events"), (EMPTY | {"claims": {}}, "claims"), (EMPTY | {"events": [EVENT, 5]}, "events:object"), (EMPTY | {"events": [EVENT]}, None),
        (EMPTY | {"events": [EVENT | {"evidence_chunk_ids": []}]}, "events:evidence"), (EMPTY | {"events": [EVENT | {"evidence_chunk_ids": ["c9"]}]}, "events:evidence"), (EMPTY | {"events": [EVENT | {"evidence_chunk_ids": None}]}, "events:evidence"),
        (EMPTY | {"events": [EVENT | {"confidence": -0.1}]}, "events:confidence"), (EMPTY | {"events": [EVENT | {"confidence": "high"}]}, "events:confidence"), (EMPTY | {"events": [EVENT | {"confidence": None}]}, None), (EMPTY | {"events": [EVENT | {"confidence": "1"}]}, None),
        (EMPTY | {"events": [EVENT | {"title": " "}]}, "events:text"), (EMPTY | {"events": [EVENT | {"date_end": "97"}]}, "events:date"), (EMPTY | {"events": [EVENT | {"date_start": "1997-01-02", "date_end": "1997-02"}]}, None),
        (EMPTY | {"relationships": [{k: v for k, v in LINK.items() if k != "target_type"}], "obligations": None}, "obligations"), (EMPTY | {"relationships": [LINK | {"target_type": ""}]}, "relationships:text"),
        (EMPTY | {"events": [EVENT | {"title": ""}, EVENT | {"confidence": 3}], "claims": 1}, "events:text"),
    ]
    got = {r.batch: r.reason for r in answers(spark, *(c for c, _ in cases)).collect()}
    assert [got[k] for k in range(len(cases))] == [reason for _, reason in cases]


def test_tables(spark):
    claim = {"claim_type": "c", "statement": "Said so", "evidence_chunk_ids": ["c2"]}
    checked = answers(spark, EMPTY | {"events": [EVENT, EVENT | {"title": " a "}], "relationships": [LINK]}, EMPTY | {"events": [EVENT | {"summary": "later"}], "claims": [claim], "relationships": [LINK | {"source_name": "ANN"}]}, "{")
    chunks = spark.createDataFrame([("c1", 3, 4), ("c1", 2, 4), ("c2", None, 9)], "chunk_id string, page_start int, page_end int")
    facts = spark.createDataFrame([("d", "F1", "C1", "Ox", None, "u")], "document_id string, filing_id string, filing_number string, company string, project string, source_url string")
    out = model_records.materialized(checked, chunks, facts, version="v1")
    (event,) = out.events.collect()  # titles that differ in case and blanks alone are one event, the last stays
    assert (event.summary, event.page_start, event.page_end, event.chunk_id, event.filing_id, event.review_status, event.extractor_version) == ("later", 2, 4, "c1", "F1", "unreviewed", "v1")
    (link,) = out.relations.collect()
    assert (link.evidence_chunk_ids, link.evidence_page_start, link.evidence_page_end, link.confidence) == (["c2", "c1"], 2, 9, 0.0)
    people = {r.entity_type: r for r in out.entities.collect()}
    assert (people["person"].name, people["person"].id, people["person"].source_url) == ("ANN", link.source_id, "u") and people["organization"].id == link.target_id
    (said,) = out.claims.collect()
    assert (said.statement, said.evidence_page_start, said.evidence_page_end) == ("Said so", None, 9) and said.id.startswith("claim:")
    assert out.obligations.collect() == []
    other = model_records.materialized(checked, chunks.limit(0), facts.limit(0), version="v1")
    assert other.events.first().page_start is None and other.events.first().company is None
