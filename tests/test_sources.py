"""Scans and sinks on small written files."""

import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.sources import scans, sinks, tables


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
    return str(path)


def test_numbered_lines_over_blocks(spark, tmp_path):
    path = write(tmp_path / "a.txt", *(f"line {i} {'x' * 50}" for i in range(1, 400)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = scans.numbered_lines(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.line_no, r.value.split()[1]) for r in rows) == [(i, str(i)) for i in range(1, 400)]


def test_bad_lines_are_named(spark, tmp_path):
    schema = T.StructType.fromDDL("id string, n int")
    good = write(tmp_path / "good.jsonl", {"id": "a", "n": 1}, "", {"id": "b"})
    rows = scans.json_objects(scans.numbered_lines(spark, good), schema, ("id",)).orderBy("line_no").collect()
    assert [(r.line_no, r.id, r.n) for r in rows] == [(1, "a", 1), (3, "b", None)]
    for bad, told in ((write(tmp_path / "b1.jsonl", {"id": "a"}, "[1]"), r"not a JSON object at .*b1.jsonl:2"), (write(tmp_path / "b2.jsonl", {"id": " "}), r"blank id at .*b2.jsonl:1")):
        with pytest.raises(Exception, match=told):
            scans.json_objects(scans.numbered_lines(spark, bad), schema, ("id",)).collect()
    mixed = write(tmp_path / "m.jsonl", {"id": "a", "n": 1}, "no", {"id": "a", "n": 2}, {"id": "b", "n": 9}, {"n": 3})
    assert {r.id: r.n for r in scans.last_rows(scans.numbered_lines(spark, mixed), schema, "id", F.col("n") < 5).collect()} == {"a": 2}


def test_query_sets(spark, tmp_path):
    path = write(tmp_path / "q.jsonl", "# a comment", "", {"id": "1", "category": "x", "query": "one", "expected_document_ids": [7, "8"]}, {"id": "2", "query": "two"})
    got = scans.query_set(spark, path).orderBy("line_no").collect()
    assert [(r.line_no, r.id, r.query, r.expected) for r in got] == [(3, "1", "one", ["7", "8"]), (4, "2", "two", [])]
    with pytest.raises(Exception, match="blank query"):
        scans.query_set(spark, write(tmp_path / "bad.jsonl", {"id": "1", "query": " "})).collect()


def test_positional_pairs(spark, tmp_path):
    schema = T.StructType.fromDDL("id string, document_id string")
    read = lambda path: scans.json_objects(scans.numbered_lines(spark, path), schema).drop("file")
    a = read(write(tmp_path / "a.jsonl", {"id": "1", "document_id": "d"}, "", {"id": "2", "document_id": "d"}))
    b = read(write(tmp_path / "b.jsonl", {"id": "1", "document_id": "d"}, {"id": "2", "document_id": "d"}))
    assert [(r.at, r.id, r.right_id) for r in scans.positional_pairs(a, b, ("id", "document_id")).orderBy("at").collect()] == [(0, "1", "1"), (1, "2", "2")]
    for other, told in (([{"id": "1", "document_id": "d"}], "ends before row 1"), ([{"id": "1", "document_id": "e"}, {"id": "2", "document_id": "d"}], "rows differ at 0")):
        with pytest.raises(Exception, match=told):
            scans.positional_pairs(a, read(write(tmp_path / f"{told[:4]}.jsonl", *other)), ("id", "document_id")).collect()


def test_candidates_and_selection(spark):
    rows = spark.createDataFrame([(1, "a", "d1", " x "), (2, "b", "d2", None), (3, "c", "d1", "y")], "line_no long, id string, document_id string, content string")
    got = scans.embedding_candidates(rows, ["d1"], 1).collect()
    assert [(r.id, r.content, r.content_sha256) for r in got] == [("a", "x", hashlib.sha256(b"x").hexdigest())]
    assert [r.id for r in scans.selected(rows, "document_id", None, None).collect()] == ["a", "b", "c"]


def test_manifests_artifacts_and_tiers(spark, tmp_path):
    digest = "a" * 64
    write(tmp_path / "m" / "x" / "one.json", {"schema": "doc", "version": 2, "id": "1"})
    write(tmp_path / "m" / "two.json", {"schema": "doc", "version": 1, "id": "2"})
    write(tmp_path / "m" / "three.json", "{broken")
    got = scans.manifests(spark, str(tmp_path / "m"), T.StructType.fromDDL("id string"), "doc", 2).collect()
    assert [r.id for r in got] == ["1"] and got[0].path.endswith("one.json")
    for name in (f"an/v1/7/{digest}.json", f"an/v1/7/{digest}.parts/pages-1-300.json", f"an/v1/7/{digest}.parts/pages-1-300.meta.json", "an/notes.json", f"an/v1/7/{'z' * 64}.json"):
        write(tmp_path / "raw" / name, "{}")
    files = scans.listing(spark, str(tmp_path / "raw"), "*.json")
    assert [(r.analyzer, r.api_version, r.document_id, r.sha256) for r in scans.artifacts(files).collect()] == [("an", "v1", "7", digest)]
    assert {r.kind: r.n for r in scans.artifact_census(files).collect()} == {"canonical": 1, "range_result": 1, "range_metadata": 1, "other": 2}
    shape = "documents int, snapshots int, raw int, sources int, sidecars int, canonical int, outputs int"
    cases = [(1, 1, 0, 1, 0, 0, 0), (0, 0, 1, 1, 0, 0, 0), (0, 0, 0, 1, 1, 0, 0), (0, 0, 0, 1, 0, 1, 1), (0, 0, 0, 0, 0, 1, 0), (0, 0, 0, 0, 0, 0, 1), (1, 1, 1, 0, 0, 0, 0)]
    tiers = [scans.recovery_tier(spark.createDataFrame([c], shape)).first().tier for c in cases]
    assert tiers == ["A", "A_RAW_EVIDENCE_NEEDS_MANIFESTS", "B", "C", "D", "E", "none"]


def test_downloads_and_snapshots(spark, tmp_path):
    for name in ("12.pdf", "13", ".hidden", "_versions/12.pdf", "12.metadata.json"):
        write(tmp_path / "f" / name, "data")
    assert sorted(r.document_id for r in scans.downloads(scans.listing(spark, str(tmp_path / "f"))).collect()) == ["12", "13"]
    raw = b"<html>page</html>"
    packed = gzip.compress(raw)
    rows = [("p1", packed), ("p2", packed), ("p3", b"no gzip"), ("p4", packed)]
    files = spark.createDataFrame(rows, "path string, content binary")
    sha = hashlib.sha256(raw).hexdigest()
    stored = [(sha, len(packed), len(raw), "p1"), (sha, len(packed), 1, "p2"), ("x", 7, 1, "p3"), ("y", len(packed), len(raw), "p4"), ("z", 1, 1, "p5")]
    got = scans.verified_snapshots(spark.createDataFrame(stored, "sha256 string, size long, raw_size long, path string"), files).collect()
    assert sorted((r.sha256[:1], r.problem or "") for r in got) == sorted([(sha[0], ""), (sha[0], "raw_size"), ("x", "unreadable"), ("y", "sha256"), ("z", "missing")])
    assert sinks.store_snapshots(spark.createDataFrame([("k", "a"), ("k", "a"), ("k", "b")], "kind string, content string"), f"{tmp_path}/store") == 2
    assert sinks.store_snapshots(spark.createDataFrame([("k", "b"), ("j", "b")], "kind string, content string"), f"{tmp_path}/store") == 1


def test_logs_coverage_seeds_and_categories(spark, tmp_path):
    logs = spark.createDataFrame([("2024-01-10 00:00:00", 'x E1 data={"n": 3}'), ("2023-01-01 00:00:00", "old E1"), ("2024-01-11 00:00:00", "E1 plain"), ("2024-01-11 00:00:00", "E2")], "at string, message string").withColumn("at", F.to_timestamp("at"))
    got = scans.log_entries(logs, "E1", "data=", T.StructType.fromDDL("n int"), now=F.lit("2024-01-12 00:00:00").cast("timestamp")).collect()
    assert [(r.message, r.told and r.told.n) for r in got] == [("E1 plain", None), ('x E1 data={"n": 3}', 3)]
    rows = spark.createDataFrame([("c", 1, [("2024-01-01", "2024-01-05"), ("2024-02-01", "2024-01-01"), ("x", "2024-01-01")]), ("c", 2, [("2024-03-01", "2024-03-02")])], "schema string, version int, intervals array<struct<start:string,end:string>>")
    assert [str(r.start_day) for r in scans.coverage_intervals(rows, "c", 1).collect()] == ["2024-01-01"]
    seeds = spark.createDataFrame([(1, " ", '{"kind": "Folder", "title": "T"}', ""), (2, "Filing", "{}", "x"), (3, "compound document", "bad", "y")], "id int, kind string, metadata string, title string")
    assert sorted((r.id, r.title) for r in scans.container_seeds(seeds).collect()) == [(1, "T"), (3, "y")]
    chosen, unknown = scans.chosen_categories(spark.createDataFrame([("Document Type",), ("Role",)], "category string"), ["document-type", "Nothing Such"])
    assert [r.category for r in chosen.collect()] == ["Document Type"] and [r.slug for r in unknown.collect()] == ["nothing-such"]
    assert scans.read_or_empty(spark, f"{tmp_path}/none", T.StructType.fromDDL("a int")).count() == 0


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("b", 2), ("a", 1), ("c", None)], "id string, n int")
    first = tables.write_sorted_json(rows, f"{tmp_path}/sorted", "id")
    assert first == tables.write_sorted_json(rows.repartition(3), f"{tmp_path}/again", "id") != tables.write_sorted_json(rows.limit(2), f"{tmp_path}/less", "id")
    told = sinks.replace_corpus({"x": (rows, "id")}, f"{tmp_path}/corpus")
    assert told["x"] == {"rows": 3, "sha256": first}
    assert sinks.replace_corpus({"x": (rows.limit(1), "id"), "y": (rows, "id")}, f"{tmp_path}/corpus")["x"]["rows"] == 1
    assert sorted(p.name for p in tmp_path.iterdir() if p.name.startswith("corpus")) == ["corpus"] and sorted(p.name for p in (tmp_path / "corpus").iterdir()) == ["x", "y"]
    merged = {r.id: r.n for r in sinks.merge_or_upload(rows, spark.createDataFrame([("a", 7), ("a", 9), ("z", 0)], "id string, n int"), "id").collect()}
    assert merged == {"a": 9, "b": 2, "c": None, "z": 0}
    kept, gone = sinks.pruned(rows, rows.where("id <> 'a'"), "id", True)
    assert kept.count() == 2 and [r.id for r in gone.collect()] == ["a"] and sinks.pruned(rows, rows.limit(0), "id", False)[0].count() == 3
    rows.write.parquet(f"{tmp_path}/index")
    sinks.promote(spark, "live_index", f"{tmp_path}/index", 3)
    with pytest.raises(ValueError, match="3 rows of 4"):
        sinks.promote(spark, "live_index", f"{tmp_path}/index", 4)
    assert spark.table("live_index").count() == 3
    sinks.run_manifest(spark, f"{tmp_path}/manifest", rows=3, name="x")
    assert spark.read.json(f"{tmp_path}/manifest").first().asDict() == {"name": "x", "rows": 3}
    sinks.write_joined_csv(rows.withColumn("tags", F.array(F.lit("p"), F.lit("q"))), f"{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").first().tags == "p;q"
    written = rows.select("id", F.when(F.col("id") == "a", '{"n":1}').otherwise("{}").alias("payload"))
    assert sorted(r.id for r in sinks.changed_sidecars(rows, written, "id").collect()) == ["b", "c"]
    write(tmp_path / "pkg" / "documents.jsonl", "{}")
    (tmp_path / "pkg" / "tables.jsonl").write_text("")
    assert [m["name"] for m in sinks.package_manifest(spark, f"{tmp_path}/pkg", {"documents.jsonl": False, "tables.jsonl": True})] == ["documents.jsonl", "tables.jsonl"]
    with pytest.raises(ValueError, match="tables.jsonl"):
        sinks.package_manifest(spark, f"{tmp_path}/pkg", {"tables.jsonl": False})
    tables.write_evidence_csv(rows.select("id"), f"{tmp_path}/evidence")
    assert b'"a"\r\n' in b"".join(p.read_bytes() for p in (tmp_path / "evidence").glob("*.csv"))
