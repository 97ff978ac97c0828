"""Operators 7 and 10: held-out accuracy, gradients, and what labels may touch."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import quality_classifier, toxicity
from palimpsest.llm.toxicity import STRIDE, WINDOW, Network, Scorer, _sigmoid, windows_of, word_features, words_of
from tests.llm.conftest import DOCS, is_held_out

BIG = "/root/testdata/sf0.01"


def auc(scores, labels):
    s, y = np.array(scores), np.array(labels)
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    for v in np.unique(s):
        rank[s == v] = rank[s == v].mean()
    pos = (y == 1).sum()
    return (rank[y == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(y) - pos))


def held(spark, rows, label):
    y = {r.doc_id: r[label] for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    own = [r for r in rows if r.held_out and r.doc_id in y]
    return own, [y[r.doc_id] for r in own]


def test_toxicity_on_the_held_out_fold(spark, sf_dir):
    rows = toxicity.query(spark, BIG).collect()
    assert all(r.held_out == is_held_out(r.doc_id) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    own, y = held(spark, rows, "toxic")
    assert auc([r.score for r in own], y) > 0.75  # 45 toxic texts to learn from here; see the README for more
    assert np.mean([r.predicted == v for r, v in zip(own, y)]) > 0.9


def test_quality_on_the_held_out_fold(spark, sf_dir):
    rows = quality_classifier.query(spark, BIG).collect()
    own, y = held(spark, rows, "quality")
    assert auc([r.score for r in own], y) > 0.9
    assert np.mean([r.keep == (v == 1) for r, v in zip(own, y)]) > 0.85


def test_held_out_labels_are_never_read(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    turned = labels.withColumns({c: F.when(fold, 1 - F.col(c)).otherwise(F.col(c)) for c in ("toxic", "quality")})
    for fit in (lambda x: toxicity.fit_toxicity(docs, x)[0].p["out"], lambda x: quality_classifier.fit_quality(docs, x)[0].both):
        assert (fit(labels) == fit(turned)).all()


def test_gradient_is_that_of_the_loss():
    net = Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = sorted(set(words_of("some words that a window of the network reads in turn")))
    slots, grams, begin = word_features(words)
    r = np.random.default_rng(0)
    index, there = r.integers(0, len(words), (6, 3)), np.arange(6)[:, None] < np.array([6, 4, 1])
    y, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss():
        x = net.embed(slots, grams, begin)
        p = _sigmoid(net.logits(net.gates(x), index, there).astype(np.float64))
        return float((weight * -(y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / 3)

    grad = net.gradient(slots, grams, begin, index, there, y, weight)
    for name, at in (("out", 3), ("look", 2), ("uf", (1, 20)), ("ub", (2, 5)), ("wf", (0, 9)), ("cb", 4), ("word", (slots[0], 2)), ("char", (grams[1], 5))):
        kept, h = net.p[name][at], 1e-2
        net.p[name][at] = kept + h
        up = loss()
        net.p[name][at] = kept - h
        down = loss()
        net.p[name][at] = kept
        assert grad[name][at] == pytest.approx((up - down) / (2 * h), rel=0.05, abs=2e-5), name


def test_windows_overlap_and_cover():
    for n in (0, 1, 31, 32, 33, 48, 49, 1000):
        at = windows_of(n)
        assert at[0] == 0 and at[-1] + WINDOW >= n and all(b - a == STRIDE for a, b in zip(at, at[1:]))


def test_a_toxic_end_of_a_long_text_counts():
    net = Network(2)
    short, scorer = " ".join(f"t{i}" for i in range(16)), Scorer(net)
    long = " ".join(f"a{i}" for i in range(16 * 500)) + " " + short
    one, two = scorer([long, " ".join(f"a{i}" for i in range(16 * 500))])
    assert one >= min(two, one) and Scorer(net)([long])[0] == pytest.approx(one, abs=1e-6)


def test_odd_rows(spark, odd_docs, no_docs, sf_dir):
    net = Network(4)
    rows = toxicity.score_toxicity(odd_docs, net).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3, 4)}) == 1
    assert toxicity.score_toxicity(no_docs, net).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.fit_toxicity(odd_docs, none) == (None, 0.0)
    assert {r.predicted for r in toxicity.score_toxicity(odd_docs, None).collect()} == {0}
    assert quality_classifier.fit_quality(odd_docs, none) == (None, 1.0)
    assert {r.keep for r in quality_classifier.score_quality(odd_docs, None).collect()} == {True}
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    fitted = quality_classifier.fit_quality(docs, labels)
    assert quality_classifier.score_quality(odd_docs, *fitted).count() == 10
    assert quality_classifier.score_quality(no_docs, *fitted).count() == 0


def test_training_reads_every_window(monkeypatch):
    """The gradient is that of the highest of all windows of each text, also in texts of over a hundred windows."""
    r = np.random.default_rng(5)
    texts = [" ".join(f"{'ab'[k % 2]}{x}" for x in r.integers(0, 40, 2000)) for k in range(12)]
    own, steps = Network.gradient, []

    def watched(self, slots, grams, begin, index, there, y, weight):
        used = _sigmoid(self.logits(self.gates(self.embed(slots, grams, begin)), index, there))
        assert sorted(used.tolist()) == pytest.approx(sorted(Scorer(self)([*texts, None]).tolist()), abs=1e-5)
        steps.append(len(used))
        return own(self, slots, grams, begin, index, there, y, weight)

    monkeypatch.setattr(Network, "gradient", watched)
    Network().train(texts, [1, 0] * 6)
    assert steps == [13] * 6


def test_highest_of_all_windows_in_groups():
    net, r = Network(6), np.random.default_rng(7)
    docs = [[f"h{x}" for x in r.integers(0, 500, n)] for n in (0, 5, 700, 40, 2500)]
    alone = Scorer(net)
    expected = [windows_of(len(d))[int(np.argmax([alone([" ".join(d[s : s + WINDOW])])[0] for s in windows_of(len(d))]))] for d in docs]
    assert net.highest(docs) == net.highest(docs, group=7) == expected


def test_every_unlabelled_row_can_be_named(spark, monkeypatch):
    """More rows than the old pool's 3000, and a round names a share of them all."""
    labelled = [(i, ("Good words of a plain line number %d end here.\n" % i) * 9 if i % 2 else "!!! ### %d" % i, "en", "ab"[i % 2], 400 if i % 2 else 9) for i in range(80)]
    rest = [(1000 + i, ("Other words of a plain line number %d end so.\n" % i) * 9 if i % 2 else "??? $$$ %d" % i, "en", "ab"[i % 2], 400 if i % 2 else 9) for i in range(4000)]
    docs = spark.createDataFrame([*labelled, *rest, (None, "Without an id.", None, None, None)], DOCS)
    labels = spark.createDataFrame([(r[0], r[0] % 2, 0) for r in labelled], "doc_id long, quality int, toxic int")
    sizes, takes, own = [], [], quality_classifier.Pool.take

    def watched(self, rules):
        got = own(self, rules)
        sizes.append(self.size)
        takes.append(got[2])
        return got

    monkeypatch.setattr(quality_classifier.Pool, "take", watched)
    quality_classifier.fit_quality(docs, labels)
    assert set(sizes) == {1 + sum(not is_held_out(r[0]) for r in rest)} and sizes[0] > 3000
    assert sum(takes) > 6 * 60 and max(takes) <= 1.5 * max(60, 0.02 * sizes[0])
