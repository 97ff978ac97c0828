"""Highlighted parts, packed vectors, facet labels and normalization states on odd values."""

from pyspark.sql import functions as F

from palimpsest.functions import text as fn
from palimpsest.operators import ledger


def test_highlighted(spark):
    rows = [("A (b) a.b", ["a", "(b)", "a.b"]), ("Été été", ["ÉTÉ"]), ("none", None), (None, ["x"]), ("", ["x"]), ("x", [None, ""]), ("cab", ["a", "cab"]), ("1+1=2 $5", ["1+1", "$5"]), ("ab\nAB", ["b\na"])]
    frame = spark.createDataFrame(rows, "t string, terms array<string>").withColumn("p", fn.highlighted(F.col("t"), F.col("terms")))
    got = [[(x.text, x.hit) for x in r.p] for r in frame.collect()]
    assert got == [
        [("A", True), (" ", False), ("(b)", True), (" ", False), ("a.b", True)], [("Été", True), (" ", False), ("été", True)], [("none", False)], [], [], [("x", False)], [("cab", True)],
        [("1+1", True), ("=2 ", False), ("$5", True)], [("a", False), ("b\nA", True), ("B", False)],
    ]
    assert all("".join(x for x, _ in p) == (t or "") for p, (t, _) in zip(got, rows))


def test_packed_floats(spark):
    rows = [(1, [1.0, -2.5]), (2, []), (3, None), (4, [1.0, None])]
    frame = spark.createDataFrame(rows, "k int, v array<float>").withColumn("b", fn.packed_floats(F.col("v"))).withColumn("u", fn.unpacked_floats("b", F.lit(2))).withColumn("z", fn.unpacked_floats("b", F.lit(0)))
    got = {r.k: (None if r.b is None else bytes(r.b), r.u, r.z) for r in frame.collect()}
    assert got == {1: (b"\x00\x00\x80?\x00\x00 \xc0", [1.0, -2.5], None), 2: (b"", None, []), 3: (None, None, None), 4: (None, None, None)}


def test_facet_labels(spark):
    rows = spark.createDataFrame([("a", "f", "x"), ("a", "f", "w"), ("a", "f", "x"), ("a", "g", " "), ("b", "f", "y"), (None, "f", "z")], "document_id string, facet string, label string")
    out = ledger.facet_labels(rows, spark.createDataFrame([("a",), ("a",), ("c",)], "document_id string"))
    assert [tuple(r) for r in out.collect()] == [("a", "f", ["w", "x"])]


def test_normalization_states(spark):
    schema = "analysis_id string, version string, config_hash string, seq int, at int, status string, output_sha256 string, pages int, chunks int, tables int, error_code string"
    event = lambda a, seq, status, sha=None, error=None: (a, "1", "c", seq, seq * 10, status, sha, 1 if sha else None, None, None, error)
    rows = [event("a", 1, "RUNNING"), event("a", 2, "FAILED", error="E"), event("a", 3, "RUNNING"), event("b", 1, "RUNNING"), event("b", 2, "SUCCEEDED", "s"), event("b", 3, "FAILED", error="late"), event("c", 1, "SUCCEEDED", "s")]
    got = {r.analysis_id: (r.status, r.started_at, r.finished_at, r.attempts, r.output_sha256, r.error_code) for r in ledger.normalization_states(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"a": ("RUNNING", 30, None, 2, None, None), "b": ("SUCCEEDED", 10, 20, 1, "s", None)}
