"""The rebuild from artifacts, the overlay, and references in open JSON, on small hand-written sources."""

import hashlib
import json
import random

from palimpsest.operators import rebuild
from palimpsest.operators.rebuild import FACTS, MINIMAL

TOLD = {c: c.upper() for c in FACTS}


def frame(spark, schema, rows):
    names = [x.split()[0] for x in schema.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


FACT_SCHEMA = ", ".join(f"{c} string" for c in FACTS)
MANIFEST = f"document_id string, inner_id string, is_file boolean, scout_status string, detail_snapshot_id long, {FACT_SCHEMA}"
SIDECAR = f"document_id string, named_id string, schema string, sha256 string, downloaded_at string, memberships boolean, {FACT_SCHEMA}"
FILE = "document_id string, path string, sha256 string, size long"


def manifests(spark, *rows):
    base = {"is_file": True, "scout_status": "SUCCEEDED", **TOLD}
    return frame(spark, MANIFEST, [{**base, "inner_id": r["document_id"], **r} for r in rows])


def sidecars(spark, *rows):
    base = {"schema": "v1", "sha256": "aa", **{c: f"side {c}" for c in FACTS}}
    return frame(spark, SIDECAR, [{**base, "named_id": r["document_id"], **r} for r in rows])


def files(spark, *ids):
    return frame(spark, FILE, [{"document_id": i, "path": f"f/{i}", "sha256": "AA", "size": 1} for i in ids])


def rebuilt(spark, m, s, f, mapping=()):
    documents = rebuild.manifest_documents(m, frame(spark, "original_id long, snapshot_id long", [{"original_id": a, "snapshot_id": b} for a, b in mapping]))
    return rebuild.rebuilt_documents(documents, rebuild.trusted_sidecars(f, s, "v1"))


def test_snapshots_are_held_against_their_artifacts(spark):
    schema = "original_id long, kind string, url string, sha256 string, size long, compressed_size long, path string"
    rows = [{"original_id": k, "kind": "detail", "url": f"u{k % 5}", "sha256": f"AB{k % 5}", "size": 10, "compressed_size": 4, "path": f"p{k}"} for k in range(7)] + [{"original_id": None, "kind": "x", "path": None}]
    raw = [{"path": f"p{k}", "size": 10 + (k == 2), "compressed_size": 4 + (k == 1), "sha256": f"ab{k % 5 if k != 3 else 9}"} for k in range(7) if k != 4]
    out = rebuild.checked_snapshots(frame(spark, schema, rows), frame(spark, "path string, size long, compressed_size long, sha256 string", raw))
    got = {r.original_id: (r.reason, r.snapshot_id) for r in out.collect()}
    assert {k: v[0] for k, v in got.items()} == {0: None, 1: "compressed_size", 2: "size", 3: "sha256", 4: "missing", 5: None, 6: None, None: "missing"}
    assert got[0][1] == got[5][1] != got[6][1] and got[1][1] is None  # one content at one address is one snapshot
    assert got[0][1] == int(hashlib.sha256(b"detail\x1fu0\x1fab0").hexdigest()[:15], 16)
    assert {r.original_id for r in rebuild.snapshot_mapping(out).collect()} == {0, 5, 6}


def test_grades_of_documents(spark):
    m = manifests(
        spark, {"document_id": "both"}, {"document_id": "blank", "title": "", "project": None}, {"document_id": "nofile", "detail_snapshot_id": 5}, {"document_id": "lost", "detail_snapshot_id": 6, "scout_status": None}, {"document_id": "other", "inner_id": "x"}, {"document_id": None},
        {"document_id": "untrusted"}, {"document_id": "partial", "scout_status": "PARTIAL"}, {"document_id": "folder", "is_file": False, "item_kind": "Folder"},
    )
    s = sidecars(
        spark, {"document_id": "both"}, {"document_id": "blank", "company": ""}, {"document_id": "side"}, {"document_id": "partial"}, {"document_id": "other"}, {"document_id": "untrusted", "sha256": "bb"},
        {"document_id": "old", "schema": "v0"}, {"document_id": "swapped", "named_id": "z"}, {"document_id": "box", "item_kind": "Compound Document"}, {"document_id": "box2", "item_kind": "folder", "memberships": True},
    )
    f = files(spark, "both", "blank", "side", "partial", "other", "untrusted", "old", "swapped", "alone", "box", "box2")
    out = {r.document_id: r for r in rebuilt(spark, m, s, f, [(5, 55)]).collect()}
    grade = {k: (r.completeness, r.state.removeprefix("RECOVERED_"), r.refresh, r.recovered_from) for k, r in out.items()}
    assert grade == {
        "both": ("complete", "COMPLETE", False, "manifest+sidecar+file"),
        "blank": ("partial", "COMPLETE", False, "manifest+sidecar+file"),  # the sidecar lacks a fact, the manifest is complete
        "nofile": ("complete", "COMPLETE", False, "manifest"),
        "lost": ("partial", "PARTIAL", True, "manifest"),
        "partial": ("partial", "PARTIAL", True, "manifest+sidecar+file"),
        "folder": ("complete", "COMPLETE", False, "manifest"),
        "untrusted": ("partial", "MINIMAL", True, "file"),
        "side": ("partial", "PARTIAL", True, "sidecar+file"),
        "other": ("partial", "PARTIAL", True, "sidecar+file"),
        "box": ("partial", "PARTIAL", True, "sidecar+file"),
        "box2": ("partial", "PARTIAL", True, "sidecar+file"),
        "old": ("minimal", "MINIMAL", True, "file"),
        "swapped": ("minimal", "MINIMAL", True, "file"),
        "alone": ("minimal", "MINIMAL", True, "file"),
    }
    assert (out["both"].title, out["blank"].title, out["blank"].project, out["side"].title, out["untrusted"].title) == ("TITLE", "side title", "side project", "side title", None)
    assert out["lost"].missing == ["detail_snapshot_evidence", "scout_status:PENDING"] and out["blank"].missing == ["company"]
    assert out["alone"].missing == sorted([*MINIMAL, "sidecar"]) and "sidecar_schema" in out["old"].missing and "sidecar_document_id" in out["swapped"].missing
    assert "container_relationships" in out["box"].missing and "container_relationships" not in out["box2"].missing
    assert (out["folder"].is_file, out["nofile"].is_file, out["alone"].is_file) == (False, True, True)
    queue = {r.document_id: r.priority for r in rebuild.repair_queue(rebuilt(spark, m, s, f, [(5, 55)])).collect()}
    assert {k for k, p in queue.items() if p == "HIGH"} == {"old", "swapped", "alone"} and set(queue) == {k for k, g in grade.items() if g[2]}


def test_rebuild_of_nothing(spark):
    none = manifests(spark), sidecars(spark), files(spark)
    assert rebuilt(spark, *none).collect() == []
    assert rebuilt(spark, none[0], none[1], files(spark, "a", "a")).count() == 2  # one row for each file


ANALYSIS = "document_id string, sha256 string, analyzer string, version string, payload_analyzer string, payload_version string, contents int, pages long, tables long, sections long, warnings long"
AMANIFEST = "document_id string, sha256 string, analyzer string, version string, path string, size long, artifact_sha256 string, updated_at string, pages long, tables long, sections long, warnings long"


def test_analyses_and_overlay(spark):
    m = manifests(spark, {"document_id": "a", "title": None, "company": "New"}, {"document_id": "gone"}, {"document_id": "x", "inner_id": "y"})
    s, f = sidecars(spark, {"document_id": "a"}, {"document_id": "b"}), files(spark, "a", "b")
    rows = rebuild.rebuilt_documents(rebuild.manifest_documents(manifests(spark, {"document_id": "a"}), frame(spark, "original_id long, snapshot_id long", [])), rebuild.trusted_sidecars(f, s, "v1"))
    base = {"document_id": "a", "sha256": "AA", "analyzer": "l", "version": "1", "contents": 1, "pages": 3, "tables": 0, "sections": 2, "warnings": None}
    artifacts = frame(spark, ANALYSIS, [base, {**base, "analyzer": "m", "payload_analyzer": "m", "payload_version": ""}, {**base, "analyzer": "n", "payload_analyzer": "z"}, {**base, "analyzer": "o", "contents": 0}, {**base, "sha256": "bb"}, {**base, "document_id": None}])
    checked = rebuild.checked_analyses(artifacts, f)
    assert sorted((r.analyzer, r.outcome) for r in checked.collect()) == [("l", "recovered"), ("l", "unmatched"), ("l", "unmatched"), ("m", "recovered"), ("n", "invalid"), ("o", "invalid")]
    analyses = rebuild.recovered_analyses(checked)
    assert [(r.pages, r.tables, r.sections, r.warnings) for r in analyses.where("analyzer = 'l'").collect()] == [(3, None, 2, 0)]
    entry = {"document_id": "a", "sha256": "aa", "analyzer": "l", "version": "1", "path": "r1", "size": 9, "artifact_sha256": "FF", "updated_at": "2024", "pages": 4, "tables": 1, "sections": 2, "warnings": 0}
    told = frame(spark, AMANIFEST, [{**entry, "updated_at": "2023", "pages": 99}, entry, {**entry, "analyzer": "p"}, {**entry, "path": "r2"}, {**entry, "path": "none"}, {**entry, "sha256": "cc"}])
    seen = frame(spark, "path string, size long, sha256 string", [{"path": "r1", "size": 9, "sha256": "ff"}, {"path": "r2", "size": 8, "sha256": "ff"}])
    out = rebuild.overlay(rows, m, analyses, told, seen)
    docs = {r.document_id: r for r in out.documents.collect()}
    assert (docs["a"].title, docs["a"].company, docs["a"].exact, docs["b"].title, docs["b"].exact) == ("", "New", True, "side title", False)
    assert {(r.analyzer, r.pages, r.tables, r.source) for r in out.analyses.collect()} == {("l", 4, 1, "manifest"), ("m", 3, None, "artifact"), ("p", 4, 1, "manifest")}
    assert {(r.entity, r.key, r.field, r.before, r.after) for r in out.conflicts.collect()} == {("document", "a", "title", "TITLE", ""), ("document", "a", "company", "COMPANY", "New"), ("analysis", "a:aa:l:1", "pages", "3", "4")}
    assert {(r.entity, r.outcome): r.n for r in out.counts.collect()} == {("document", "updated"): 1, ("document", "missing_document"): 1, ("document", "invalid_manifest"): 1, ("analysis", "restored"): 3, ("analysis", "invalid"): 2, ("analysis", "unmatched"): 1}


def plain(value, mapping):
    if isinstance(value, list):
        return [plain(v, mapping) for v in value]
    if not isinstance(value, dict):
        return value

    def at(v):
        try:
            return mapping.get(int(v)) if not isinstance(v, (list, dict)) and v is not None and v != "" else None
        except ValueError:
            return None

    out = {}
    for k, v in value.items():
        if k in ("snapshot_id", "detail_snapshot_id"):
            out[k] = at(v)
        elif k == "snapshot_ids" and isinstance(v, list):
            out[k] = [m for m in map(at, v) if m is not None]
        else:
            out[k] = plain(v, mapping)
    return out


def test_references_at_any_depth(spark):
    rng = random.Random(8)

    def made(depth):
        if depth == 0 or rng.random() < 0.2:
            return rng.choice([None, 3, "x", 2.5, True, "é"])
        if rng.random() < 0.4:
            return [made(depth - 1) for _ in range(rng.randrange(4))]
        one = lambda: rng.choice([rng.randrange(12), str(rng.randrange(12)), " 4 ", "", None, "no", 7.9, [1], {"snapshot_id": 1}])
        out = {k: made(depth - 1) for k in rng.sample("abcdef", rng.randrange(4))}
        if rng.random() < 0.5:
            out["snapshot_id"] = one()
        if rng.random() < 0.3:
            out["detail_snapshot_id"] = one()
        if rng.random() < 0.5:
            out["snapshot_ids"] = rng.choice([[one() for _ in range(rng.randrange(5))], "text", {"snapshot_id": 2}])
        return out

    values = [made(6) for _ in range(200)] + [{"snapshot_ids": [1, 99, 2]}, [[{"snapshot_id": 5}]], 7]
    mapping = {k: 1000 + k for k in range(0, 12, 2)} | {1: 1001}
    texts = [json.dumps(v) for v in values] + [json.dumps(values[0]), None, "{bad", ""]
    rows = frame(spark, "k int, t string, snapshot_id string", [{"k": k, "t": t, "snapshot_id": "own"} for k, t in enumerate(texts)])
    known = frame(spark, "original_id int, snapshot_id long", [{"original_id": a, "snapshot_id": b} for a, b in mapping.items()])
    got = {r.k: r.t for r in rebuild.remapped_references(rows, "t", known).collect()}
    assert len(got) == len(texts) and all(got[k] is None for k in range(len(values) + 1, len(texts)))
    for k, v in enumerate([*values, values[0]]):
        assert json.loads(got[k]) == plain(v, mapping), (v, got[k])
    assert got[len(values) - 3] == '{"snapshot_ids":[1001,1002]}'


def test_deep_json(spark):
    deep = "[" * 100_000 + "]" * 100_000
    some = '{"a":' * 300 + '{"snapshot_id":4}' + "}" * 300
    rows = frame(spark, "k int, t string", [{"k": 0, "t": deep}, {"k": 1, "t": some}])
    got = {r.k: r.t for r in rebuild.remapped_references(rows, "t", frame(spark, "original_id long, snapshot_id long", [{"original_id": 4, "snapshot_id": 44}])).collect()}
    assert got[0] is None and got[1] == some.replace(":4}", ":44}")
