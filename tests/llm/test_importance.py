"""Operator 13: features, weights, noise and ranks against a plain version; chunks; odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from palimpsest.llm.importance import Buckets, Resampling, importance_scores, query, resample, split_text
from tests.llm.conftest import LOWER

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, n=2):
    words = TERM.findall((text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def plain(docs, target, plan=Resampling()):
    bucket = lambda f: zlib.crc32(f.encode()) % plan.buckets
    s, t = Counter(), Counter()
    for texts, into in ((docs, s), (target, t)):
        for _, text in texts:
            into.update(map(bucket, features(text, plan.n)[1]))
    big, small = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big + plan.buckets) / ((s[b] + 1) * (small + plan.buckets))))
    rows = []
    for doc_id, text in docs:
        n_words, found = features(text, plan.n)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{plan.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words])
    able = sorted((r for r in rows if r[4] >= plan.least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2], r[1]))
    for k, r in enumerate(able):
        r.append(k + 1 if k < len(able) * plan.percent // 100 else None)
    return sorted(tuple(r[:4]) + (r[5] if len(r) > 5 else None,) for r in rows if r[0] is not None), sorted(tuple(r[1:4]) for r in rows if r[0] is None)


def test_query_equals_plain(spark, sf_dir, documents):
    target = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = sorted(tuple(r) for r in query(spark, sf_dir).select("doc_id", "n_features", "weight", "score", "rank").collect())
    assert got == plain([(r.doc_id, r.text) for r in documents], target)[0]
    drawn = [r[4] for r in got if r[4]]
    assert sorted(drawn) == list(range(1, len(drawn) + 1)) and len(drawn) > 20


@pytest.mark.parametrize("n", [1, 2, 3])
def test_chunks_hold_every_run_once(n):
    for size in (n, 5, 64):
        for count in (0, 1, size - 1, size, size + n - 2, size + n - 1, size + n, 3 * size, 3 * size + 1, 500):
            text = "  ".join(f"Wörd{i % 37}," for i in range(max(count, 0)))
            of, found, owned = Buckets(n, 1000), Counter(), 0
            for own, piece in split_text(text, size, n - 1):
                owned += own
                found.update(of(TERM.findall(piece.translate(LOWER)), own).tolist())
            assert owned == max(count, 0)
            assert found == Counter(zlib.crc32(f.encode()) % 1000 for f in features(text, n)[1])
    with pytest.raises(ValueError):
        list(split_text("a b", 1, 1))


def test_long_texts_in_chunks_weigh_as_whole_ones(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.5, size=k) % 5000) for k in (30, 900, 4000, 20_000)]
    docs, target = list(enumerate(texts)), [(0, "w1 w2 w3 w1 w2"), (1, None)]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(target, "item_id long, text string")
    for plan in (Resampling(chunk_words=256, long_chars=500), Resampling(), Resampling(n=3, buckets=97, chunk_words=100, long_chars=0)):
        got = sorted(tuple(r) for r in resample(*frames, plan).select("doc_id", "n_features", "weight", "score", "rank").collect())
        assert got == plain(docs, target, plan)[0]


def test_the_draw_leans_to_the_target(spark):
    near, far = "wind and water turn the old mill ", "profit margin outlook revised by analysts "
    docs = [(i, (near if i % 2 else far) * 5) for i in range(400)]
    out = resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, near * 3)], "item_id long, text string"))
    drawn = [r.doc_id for r in out.where("rank IS NOT NULL").collect()]
    assert len(drawn) == 100 and sum(d % 2 for d in drawn) > 80


def test_odd_rows(spark, odd_docs, no_docs):
    target = odd_docs.selectExpr("doc_id AS item_id", "text").limit(3)
    got = resample(odd_docs, target).collect()
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    expected, unnamed = plain(docs, [(r.item_id, r.text) for r in target.collect()])
    assert sorted((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got if r.doc_id is not None) == expected
    assert sorted((r.n_features, r.weight, r.score) for r in got if r.doc_id is None) == unnamed
    assert all(r.weight == 0 and r["rank"] is None for r in got if r.n_features == 0)
    assert resample(no_docs, target).collect() == []
    assert len(resample(odd_docs, spark.createDataFrame([], "item_id long, text string")).collect()) == 10


def test_rows_alike_get_ranks_of_their_own(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(5, text)] * 300 + [(None, text)] * 100, "doc_id long, text string")
    out = resample(docs, docs.selectExpr("1 AS item_id", "text").limit(1)).collect()
    assert sorted(r["rank"] for r in out if r["rank"]) == list(range(1, 101)) and len(out) == 400
    assert importance_scores(docs, docs.selectExpr("1 AS item_id", "text").limit(1)).select("score").distinct().count() == 2
