"""Operator 6 against all pairs, with crowds, chains and odd rows."""

import random

import numpy as np
import pytest

from palimpsest.llm.ngram_join import block_links, jaccard_components, query, stage
from tests.llm.conftest import DOCS, LOWER, WORD


def plain(rows):
    """{row number: (n_shingles, component_id)} by comparing all pairs of sets."""
    sets = []
    for r in rows:
        w = WORD.findall((r[1] or "").translate(LOWER))
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return [(r[0], len(s), least.get(root(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets))]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs, **options).collect()]
    assert order(got) == order(plain(rows))


def made(n, seed, groups=6, long=60):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [[r.choice(words) for _ in range(r.randint(3, long))] for _ in range(groups)]
    rows = []
    for i in range(n):
        w = list(r.choice(base))
        for _ in range(r.randint(0, 3)):
            how = r.random()
            at = r.randrange(len(w))
            if how < 0.4:
                w[at] = r.choice(words)
            elif how < 0.7:
                w.insert(at, r.choice(words).upper())
            elif len(w) > 1:
                del w[at]
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_small_buckets(spark, seed):
    check(spark, made(90, seed, groups=25))


@pytest.mark.parametrize("seed", [3, 4])
def test_crowds_in_blocks(spark, seed):
    check(spark, made(150, seed, groups=3), hot=4, block=16)


def test_chain_of_links(spark):
    words = [f"c{i}" for i in range(400)]
    check(spark, [(i, " ".join(words[4 * i : 4 * i + 80])) for i in range(70)], hot=5, block=8)


def test_blocks_connect_as_pairs_do():
    r = np.random.default_rng(2)
    core = r.integers(0, 10**9, 60)
    sets = [np.unique(np.where(r.random(60) < 0.05, r.integers(0, 10**9, 60), core)) for _ in range(50)]
    edges = block_links(np.array([len(s) for s in sets], np.float32), sets, 80, width=16)
    parent = list(range(50))
    for a, b in edges:
        assert 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))
        parent = [parent[a] if p == parent[b] else p for p in parent]
    for a in range(50):
        for b in range(a):
            if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b])):
                assert parent[a] == parent[b]


def test_query(spark, sf_dir, documents):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in query(spark, sf_dir).collect()]
    assert order(got) == order(plain([(r.doc_id, r.text) for r in documents]))


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(odd_docs).collect()]
    assert order(got) == order(plain(rows))
    assert jaccard_components(no_docs).count() == 0
    kept = stage(spark, odd_docs, "").collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 2, 3, 4, 5, 7]


def test_null_ids_alone(spark):
    check(spark, [(None, "a b c d e f"), (None, "a b c d e f"), (None, None)])
    assert spark.createDataFrame([], DOCS).count() == 0


def test_stage_keeps_rows_not_ids(spark, odd_docs):
    """All rows are compared, those with null and repeated ids among them."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [
        (1, a), (2, a + " more"), (2, b), (3, b), (3, c),  # 2 and 3 name a copy and a text of its own
        (None, c + " more"), (None, "no copy of anything here at all"), (None, "found twice without any id"), (None, "found twice without any id"),
        (None, None), (None, ""), (4, ""), (4, ""), (4, None),
    ]
    docs = spark.createDataFrame([(*r, "en", "a", 1) for r in rows], DOCS)
    kept = [(r.doc_id, r.text) for r in stage(spark, docs, "").collect()]
    expected = [(1, a), (2, b), (3, c), (None, rows[6][1]), (None, rows[7][1]), *rows[9:]]
    assert sorted(kept, key=str) == sorted(expected, key=str)
    odd = [(r.doc_id, r.text) for r in odd_docs.collect()]
    left = [(r.doc_id, r.text) for r in stage(spark, odd_docs, "").collect()]
    assert sorted(left, key=str) == sorted([odd[0], *odd[2:8], odd[9]], key=str)
