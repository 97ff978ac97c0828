"""Migrations: the chain of checksums, damaged logs, versions on disk, steps cut off and taken up again."""

import json
from dataclasses import replace

import pytest

from palimpsest.operators.migrations import Add, Create, Drop, Entry, MigrationError, Rekey, Rename, Retype, Step, VersionedTables, chained, status, verified

STEPS = [
    Step(1, "base", (Create("documents", "id int, name string, extra double"), Create("runs", "run int"))),
    Step(2, "legacy", (Rekey("analyses", ("doc", "version"), ("at DESC", "note")), Add("analyses", "attempts", "int", "0"))),
    Step(3, "names", (Rename("documents", "name", "title"), Add("documents", "name_length", "int", "length(title)"), Drop("documents", "extra"), Retype("analyses", "at", "int"))),
]


def entries(steps=STEPS, **change):
    return [Entry(s.number, s.name, c, "1.0", f"2024-01-0{s.number}") for s, c in zip(steps, chained(steps))]


def fails(steps, log):
    with pytest.raises(MigrationError) as e:
        verified(steps, log)
    return e.value.number


def test_the_chain():
    sums = chained(STEPS)
    assert len(set(sums)) == 3 and chained(STEPS[:2]) == sums[:2]
    other = [replace(STEPS[0], name="other"), *STEPS[1:]]
    assert all(a != b for a, b in zip(sums, chained(other)))  # a change is in all sums behind it
    with pytest.raises(MigrationError):
        chained([STEPS[0], STEPS[2]])
    assert verified(STEPS, entries()) == entries() and verified(STEPS, []) == [] and verified(STEPS, entries()[:2]) == entries()[:2]


def test_damaged_logs_fail_with_their_number():
    log = entries()
    assert fails(STEPS, [log[0], log[2]]) == 2  # a gap
    assert fails(STEPS, log[1:]) == 1
    assert fails(STEPS, [log[0], replace(log[1], checksum="0" * 64), log[2]]) == 2
    assert fails(STEPS, [log[0], replace(log[1], name="else"), log[2]]) == 2
    assert fails(STEPS, [*log, log[1]]) == 2  # twice
    assert fails(STEPS[:2], log) == 3  # from a newer release
    changed = [STEPS[0], replace(STEPS[1], changes=STEPS[1].changes[:1]), STEPS[2]]
    assert fails(changed, log) == 2
    assert fails([STEPS[0], STEPS[1], replace(STEPS[2], changes=())], log) == 3
    assert [e.checksum for e in verified(STEPS, [replace(e, checksum=None) for e in log])] == chained(STEPS)  # older entries have none
    assert status(STEPS, log[:1]) == {"applied": ["base"], "pending": ["legacy", "names"], "problem": None, "safe": True}
    assert status(STEPS, [log[0], log[2]])["safe"] is False and "step 2" in status(STEPS, [log[0], log[2]])["problem"]


@pytest.fixture()
def store(spark, tmp_path):
    store = VersionedTables(spark, f"{tmp_path}/ledger")
    analyses = [("a", "1", "5", "x"), ("a", "1", "7", "y"), ("a", "2", "z", "x"), (None, "1", "1", "x")]
    store.install({"analyses": spark.createDataFrame(analyses, "doc string, version string, at string, note string"), "documents": spark.createDataFrame([(1, "one"), (2, None)], "id int, name string")})
    return store


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_versions_on_disk(spark, store):
    assert store.log() == [] and sorted(store.tables()) == ["analyses", "documents"]
    assert store.migrate(STEPS[:1], "1.0") == ["base"]
    assert store.tables()["documents"].columns == ["id", "name", "extra"] and rows(store.tables()["runs"]) == []
    assert store.migrate(STEPS, "1.1") == ["legacy", "names"] and store.migrate(STEPS, "1.2") == []
    now = store.tables()
    assert rows(now["analyses"].select("doc", "version", "at", "note", "attempts")) == [("a", "1", 7, "y", 0), ("a", "2", None, "x", 0)]
    assert rows(now["documents"]) == [(1, "one", 3), (2, None, None)] and now["documents"].columns == ["id", "title", "name_length"]
    assert store.tables(1)["documents"].columns == ["id", "name", "extra"] and "runs" not in store.tables(0)
    assert [(e.number, e.release) for e in sorted(store.log(), key=lambda e: e.number)] == [(1, "1.0"), (2, "1.1"), (3, "1.1")]
    assert store.problems({"documents": ["title"], "analyses": ["doc"]}) == []
    assert store.problems({"documents": ["title", "b", "a"], "exports": ["x"]}) == ["missing table exports", "missing column documents.a", "missing column documents.b"]


def test_a_step_cut_off_is_done_again(spark, store):
    store.migrate(STEPS[:1], "1.0")
    spark.createDataFrame([("half",)], "doc string").write.parquet(f"{store.root}/tables/analyses/2")  # written, never in the log
    assert len(store.tables()["analyses"].columns) == 4  # readers don't see it
    bad = [*STEPS[:2], Step(3, "bad", (Rename("documents", "nothing", "x"),))]
    with pytest.raises(ValueError):
        store.migrate(bad, "1.1")
    assert len(store.log()) == 2 and "attempts" in store.tables()["analyses"].columns  # what came before it stays
    assert store.migrate(STEPS, "1.1") == ["names"]
    with pytest.raises(ValueError, match="no table"):
        Step(1, "x", (Drop("none", "c"),)).apply({}, spark)


def test_a_damaged_log_stops_everything(spark, store):
    store.migrate(STEPS[:2], "1.0")
    at = f"{store.root}/log/00001.json"
    entry = json.load(open(at))
    with open(at, "w") as out:
        json.dump(entry | {"checksum": "f" * 64}, out)
    crc = f"{store.root}/log/.00001.json.crc"
    import os

    if os.path.exists(crc):
        os.remove(crc)
    with pytest.raises(MigrationError, match="step 1"):
        store.migrate(STEPS, "1.1")
    assert len(store.log()) == 2
