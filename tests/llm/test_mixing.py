"""Operator 2: sizes and targets against a plain version; draws near targets; reruns; permutations."""

import numpy as np
import pytest

from palimpsest.llm.mixing import MixPlan, mix_counts, mix_texts, permute, query, shard_counts, targets_of
from tests.llm.conftest import DOCS, WORD


def plain_targets(sizes, weights):
    fixed = {}
    while True:
        rest = sum(sizes) - sum(fixed.values())
        free = [i for i in range(len(sizes)) if i not in fixed]
        share = {i: rest * weights[i] / sum(weights[j] for j in free) for i in free}
        over = [i for i in free if share[i] > 3 * sizes[i]]
        if not over:
            return [fixed.get(i, share.get(i)) for i in range(len(sizes))]
        fixed.update((i, 3.0 * sizes[i]) for i in over)


@pytest.mark.parametrize("sizes", [[10], [100, 5, 5, 1], [1, 1000], [0, 7, 900], [3, 3, 3, 3, 3, 3]])
def test_targets(sizes):
    weights = [(5.0, 2.0, 1.0)[i % 3] for i in range(len(sizes))]
    assert targets_of(sizes, weights) == pytest.approx(plain_targets(sizes, weights))


def test_query(spark, sf_dir, documents):
    rows = query(spark, sf_dir).collect()
    size = {r.doc_id: len(WORD.findall(r.text or "")) for r in documents}
    source = {r.doc_id: r.source for r in documents}
    names = sorted({r.source for r in documents}, key=lambda s: (s is None, s or ""))
    sums = [sum(size[d] for d in size if source[d] == s) for s in names]
    goals = dict(zip(names, plain_targets(sums, [(5.0, 2.0, 1.0)[i % 3] for i in range(len(names))])))
    taken = dict.fromkeys(names, 0)
    for r in rows:
        assert r["size"] == size[r.doc_id] and r.taken <= 3 * r["size"]
        assert r.source_size == sums[names.index(source[r.doc_id])] and r.target == pytest.approx(goals[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
    for s in names:
        assert abs(taken[s] - goals[s]) <= max(300, 0.03 * goals[s])
    again = query(spark, sf_dir)
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again.collect())


def test_layout_does_not_matter(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one = sorted((r.doc_id, r.taken) for r in mix_counts(docs).collect())
    assert one == sorted((r.doc_id, r.taken) for r in mix_counts(docs.repartition(7, "text")).collect())


def test_texts_hold_what_counts_say(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = {}
    for r in mix_texts(docs).collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(WORD.findall(r.text))
    assert words == {r.doc_id: r.taken for r in mix_counts(docs).collect() if r.taken}


def test_permutation_and_draws():
    for n in (1, 2, 3, 10, 257, 5000):
        for key in (1, 2**63 + 5):
            got = permute(np.arange(n), np.full(n, n), np.full(n, key, np.uint64))
            assert sorted(got.tolist()) == list(range(n))
    counts = shard_counts([1000, 10, 0, 333], 100, 5)
    assert counts.sum(axis=0).tolist() == [1000, 10, 0, 333] and counts.sum(axis=1).max() <= 100


def test_odd_rows(spark, odd_docs, no_docs):
    rows = mix_counts(odd_docs, plan=MixPlan(block_words=16)).collect()
    assert len(rows) == 10 and all(r.taken <= 3 * r["size"] for r in rows)
    assert {r["size"] for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert mix_counts(no_docs).count() == 0 and mix_texts(no_docs).count() == 0
    empty = spark.createDataFrame([(1, None, "en", "a", 0), (2, "", "en", None, 0)], DOCS)
    assert [r.taken for r in mix_counts(empty).collect()] == [0, 0]
