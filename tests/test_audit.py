"""The audit on small ledgers, and wide search documents of chunks that lack most."""

from palimpsest.operators import audit, search_documents

DOCUMENT = "document_id string, is_container boolean, has_metadata boolean, member_ids array<string>, observed_ids array<string>, complete boolean, state string, reported int, parsed int, effective int, endpoint string, snapshot_ids array<bigint>"
LEAF = {"is_container": False}
BOX = {"is_container": True, "has_metadata": True, "member_ids": ["a", "b"], "observed_ids": ["a", "b"], "complete": True, "state": "LISTED", "reported": 2, "parsed": 2, "effective": 2, "endpoint": "https://x/Item/LoadResult/box/", "snapshot_ids": [1]}


def run(spark, documents, backlinks=(("a", "box"), ("b", "box")), snapshots=((1, " Container"),), errors=((None, None),), **more):
    names = [x.split()[0] for x in DOCUMENT.split(", ")]
    rows = spark.createDataFrame([tuple(({"document_id": k} | d).get(n) for n in names) for k, d in documents], DOCUMENT)
    frame = lambda data, schema: spark.createDataFrame(list(data), schema)
    out = audit.audit(rows, frame(backlinks, "child string, parent string"), frame(snapshots, "id long, source_kind string"), frame(errors, "severity string, resolved_at string"), **more)
    return {r.counter: r.n for r in out.counters.collect()}, {(r.counter, r.key, r.detail) for r in out.issues.collect()}, out


def test_a_sound_ledger(spark):
    documents = [("a", LEAF), ("b", LEAF), ("box", BOX), (None, BOX)]
    n, issues, _ = run(spark, documents, errors=[("error", None), ("error", "2024"), ("warning", None)])
    assert issues == set() and n["ok"] == 1 and n["structural_failures"] == n["issues"] == 0
    assert (n["documents_total"], n["containers_total"], n["containers_complete"], n["unresolved_errors"], n["unresolved:ERROR"], n["container_snapshot_references"]) == (3, 1, 1, 2, 1, 1)
    assert run(spark, documents, errors=[("error", None)], fail_on_unresolved=True)[0]["ok"] == 0
    assert run(spark, documents, errors=[("error", "x")], fail_on_unresolved=True)[0]["ok"] == 1
    assert run(spark, [], backlinks=[], snapshots=[], errors=[("e", "x")])[0]["ok"] == 1


def test_findings(spark):
    documents = [
        ("a", LEAF), ("b", {"is_container": True}), ("box", BOX | {"member_ids": ["a", "b", "a", "gone"], "reported": 3, "parsed": 4, "effective": 9, "endpoint": "https://x/Item/LoadResult/other", "snapshot_ids": [1, 2, 3, 3]}),
        ("empty", BOX | {"member_ids": ["a"], "observed_ids": None, "state": " empty ", "complete": None, "reported": 5, "parsed": None, "effective": None, "endpoint": " ", "snapshot_ids": None}),
    ]
    n, issues, out = run(spark, documents, backlinks=[("a", "box"), ("a", "box"), ("a", "nobody"), ("a", " "), ("ghost", "box")], snapshots=[(1, "container"), (2, "detail")], verified=spark.createDataFrame([(1, True), (2, False)], "id long, ok boolean"))
    assert issues == {
        ("missing_container_metadata", "b", ""), ("duplicate_member_ids", "box", "1"), ("missing_member_documents", "box", "gone"), ("missing_child_backlinks", "b", "box"), ("missing_child_backlinks", "a", "empty"), ("orphan_child_backlinks", "a", "nobody"),
        ("reported_count_mismatches", "box", "3 != 2"), ("parsed_count_mismatches", "box", "4 != 2"), ("effective_count_mismatches", "box", "9 != 3"), ("effective_count_mismatches", "empty", "EMPTY"), ("endpoint_mismatches", "box", "https://x/Item/LoadResult/other"),
        ("missing_result_endpoints", "empty", ""), ("incomplete_containers", "empty", ""), ("containers_without_snapshot_references", "empty", ""), ("missing_container_snapshot_rows", "box", "3"), ("container_snapshot_wrong_kind", "box", "2"), ("raw_snapshot_failures", "2", "2"),
    }
    assert n["ok"] == 0 and n["membership_mismatches"] == 9 and n["structural_failures"] == 17 and n["nested_container_relationships_total"] == 1 and n["raw_snapshots_verified"] == 1
    assert [r.counter for r in out.examples(3).collect()] == ["container_snapshot_wrong_kind", "containers_without_snapshot_references", "duplicate_member_ids"]


def test_search_documents_of_bare_chunks(spark):
    chunks = spark.createDataFrame([("c1", 7, "", None), (None, 1, "x", None), ("c2", None, "H", ["a", None, ""])], "id string, document_id long, heading string, roles array<string>")
    none = spark.createDataFrame([], f"chunk_id string, elements {search_documents.ELEMENTS}")
    out = {r.chunk_id: r for r in search_documents.search_documents(chunks, none, vectors=spark.createDataFrame([("c1", [1.0])], "chunk_id string, vector array<double>")).collect()}
    assert set(out) == {"c1", "c2"} and len(search_documents.FIELDS) == 39
    assert (out["c1"].citation_title, out["c1"].document_id, out["c1"].url, out["c1"].content_vector, out["c1"].element_paths) == ("Document 7", "7", None, [1.0], [])
    assert (out["c2"].citation_title, out["c2"].document_id, out["c2"].roles, out["c2"].content_vector) == ("H", "", ["a"], None)
    assert search_documents.search_documents(chunks, none).columns == list(search_documents.FIELDS)
