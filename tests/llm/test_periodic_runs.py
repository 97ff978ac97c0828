"""Operator 11: runs against brute force, the contract's digests, hash clashes, long repetition, odd rows."""

import hashlib
import random
import time
import zlib

import pytest

from palimpsest.llm import periodic_runs as op
from palimpsest.llm.periodic_runs import Extensions, collapsed, lyndon_ends, runs_of
from tests.llm.conftest import WORD


def plain_runs(w, least=6, periods=4):
    """Every period tried at every place."""
    n, out = len(w), []
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length = i + q - start
            if i > start and length >= max(least, periods * q):
                if not any(w[start : start + length - r] == w[start + r : start + length] for r in range(1, q)):
                    out.append((start, length, q))
            i += i == start
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    milli = 1000 * best[1] // best[2] if runs else None
    return doc_id, len(runs), *best, milli, digest(lines), digest(" ".join(w for k, w in enumerate(words) if k not in gone))


NAMES = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query_equals_brute_force(spark, sf_dir, documents):
    got = {r.doc_id: tuple(r[c] for c in NAMES) for r in op.query(spark, sf_dir).collect()}
    assert len(got) == len(documents) and sum(r[1] > 0 for r in got.values()) > 10
    for d in documents:
        if len(WORD.findall(d.text or "")) < 1500:
            assert got[d.doc_id] == plain_row(d.doc_id, d.text)


def random_words(rng):
    letters = rng.choice([1, 2, 2, 3, 5])
    if rng.random() < 0.5:
        return [str(rng.randrange(letters)) for _ in range(rng.randint(0, 60))]
    out = []
    while len(out) < 50:
        out += [str(rng.randrange(letters)) for _ in range(rng.randint(1, 8))] * rng.randint(1, 7)
        out = out[: len(out) - rng.randint(0, 2)]
    return out


def test_random_words():
    rng = random.Random(11)
    for _ in range(3000):
        w = random_words(rng)
        assert runs_of(w) == plain_runs(w), w
        assert runs_of(w, 2, 3) == plain_runs(w, 2, 3), w


def test_ends_of_lyndon_words():
    rng = random.Random(5)
    for _ in range(300):
        keys = [rng.randrange(3) for _ in range(rng.randint(0, 25))]
        ends = lyndon_ends(keys, Extensions(keys).right)
        for i in range(len(keys)):
            lyndon = [j for j in range(i + 1, len(keys) + 1) if all(keys[i:j] < keys[k:j] for k in range(i + 1, j))]
            assert ends[i] == max(lyndon)


def test_clashing_hashes_change_nothing(monkeypatch):
    monkeypatch.setattr(op, "_MODULUS", 7)
    rng = random.Random(2)
    for _ in range(400):
        w = random_words(rng)
        w = w * 4 if rng.random() < 0.5 else w
        assert runs_of(w) == plain_runs(w)


def test_long_repetition_takes_linear_time():
    began = time.time()
    for unit in (["a"], ["a", "b", "a"], [f"w{i}" for i in range(20_000)]):
        words = ["x", *(unit * (200_000 // len(unit))), "y"]
        assert runs_of(words) == [(1, len(words) - 2, len(unit))]
    assert time.time() - began < 60


def test_collapsed_keeps_first_periods():
    assert collapsed("a b a b a b a b c".split(), [(0, 8, 2)]) == "a b c"
    assert runs_of(["a"] * 5) == [] and runs_of(["a"] * 6) == [(0, 6, 1)]
    assert runs_of("a b c".split() * 4) == [(0, 12, 3)] and runs_of("a b c".split() * 4, 6, 5) == []
    with pytest.raises(ValueError):
        runs_of(["a"] * 9, 4, 2)


def test_runs_that_overlap():
    w = ["a"] * 7 + ["b"] + ["a"] * 7 + ["b"] + ["a"] * 7 + ["b"] + ["a"] * 7 + ["b"]
    assert runs_of(w) == plain_runs(w) == [(0, 7, 1), (0, 32, 8), (8, 7, 1), (16, 7, 1), (24, 7, 1)]


def test_odd_rows(spark, odd_docs, no_docs):
    rows = odd_docs.selectExpr("*", "1 AS runs", "2 AS collapsed", "3 AS n_words")
    got = op.periodic_runs(rows, keep=("doc_id", "lang")).collect()
    assert len(got) == 10 and all(r.collapsed == "" and r.runs == [] for r in got if r.doc_id in (2, 3, 4))
    assert {len(r.runs) for r in got if r.doc_id in (5, 6)} == {len(runs_of([f"w{i % 7001}" for i in range(60_000)]))} == {1}
    assert op.periodic_runs(no_docs).collect() == []


def test_query_on_odd_rows(spark, tmp_path):
    docs = [(i, " ".join(random_words(random.Random(i)))) for i in range(60)] + [(3, None), (None, "a " * 9), (None, None), (24, ""), (24, " \t")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r[c] for c in NAMES) for r in op.query(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((plain_row(*d) for d in docs), key=str)
