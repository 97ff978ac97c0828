"""Operator 4 against a plain scan of all windows."""

import hashlib
import random
import re
import time

import pytest

from palimpsest.llm.decontaminate import Block, WordHashes, contaminated_spans, query, stage
from tests.llm.conftest import LOWER

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORDS.findall((text or "").translate(LOWER))


def plain(docs, items):
    windows = {}
    for i, text in items:
        w = words_of(text)
        k = min(10, len(w))
        for p in range(len(w) - k + 1 if k else 0):
            windows.setdefault((k, tuple(w[p : p + k])), set()).add(str(i))
    sizes = {k for k, _ in windows}
    out = []
    for d, text in docs:
        w, hit, found = words_of(text), set(), set()
        for k in sizes:
            for p in range(len(w) - k + 1):
                if got := windows.get((k, tuple(w[p : p + k]))):
                    hit.update(range(p, p + k))
                    found |= got
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r[:4]))


def test_query(spark, sf_dir, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in query(spark, sf_dir).collect()]
    assert order(got) == order(plain([(r.doc_id, r.text) for r in documents], items))


@pytest.mark.parametrize("block_words", [2_000_000, 60])
def test_repetitive_texts(spark, block_words):
    r = random.Random(block_words)
    words = [f"v{i}" for i in range(4)] + ["\u00e9", "Z9"]
    text = lambda n: "-".join(r.choice(words) for _ in range(n))
    items = [(i, text(r.choice([0, 1, 3, 9, 10, 11, 40]))) for i in range(12)] + [(12, None), (3, "v1 v2 v1")]
    docs = [(i, text(r.choice([0, 2, 9, 10, 60, 300]))) for i in range(40)]
    docs += [(100 + i, f"{text(5)} {items[i % 12][1]} {text(5)}") for i in range(30)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = contaminated_spans(d, b, block_words=block_words).collect()
    expected = {x[0]: x for x in plain(docs, items)}
    for row in got:
        ids = hashlib.sha256(",".join(row.hit_items).encode()).hexdigest()
        assert (row.doc_id, row.n_words, row.n_hit, len(row.hit_items), ids, row.n_hit > 0) == expected[row.doc_id]
        assert row.n_hit == sum(s.end - s.start for s in row.hit_spans)


def test_odd_rows(spark, odd_docs, no_docs, tmp_path):
    none = spark.createDataFrame([], "item_id long, text string")
    rows = contaminated_spans(odd_docs, none).collect()
    assert len(rows) == 10 and not any(r.n_hit for r in rows)
    items = spark.createDataFrame([(None, "small text", 1), (2, None, 1), (3, "", 1)], "item_id long, text string, doc_id int")
    hit = contaminated_spans(odd_docs, items).where("n_hit > 0").collect()
    assert [(r.doc_id, r.n_hit) for r in hit] == [(1, 2), (1, 2)]
    assert contaminated_spans(no_docs, items).count() == 0
    items.select("item_id", "text").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = stage(spark, odd_docs, str(tmp_path))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"] and kept.count() == 8


def test_equal_words_cost_no_more_than_others():
    hashes = WordHashes()
    block = Block([(str(i), hashes(["a"] * 200)) for i in range(20)] + [("x", hashes([f"w{i % 50}" for i in range(5000)]))], 10, 5)
    start = time.process_time()
    spans, items = block.hits(hashes(["a"] * 20_000 + [f"w{i % 50}" for i in range(20_000)]))
    assert time.process_time() - start < 1
    assert spans.tolist() == [[0, 40_000]] and items == set(range(21))


def test_items_are_winnowed_and_every_shared_window_is_met():
    r, hashes = random.Random(7), WordHashes()
    text = lambda n: [f"u{r.randrange(3000)}" for _ in range(n)]
    items = [text(200) for _ in range(30)]
    block = Block([(str(i), hashes(w)) for i, w in enumerate(items)], 10, 5)
    assert len(block.prints) < 0.5 * 30 * 196
    for k in range(300):
        i, at = r.randrange(30), r.randrange(190)
        n = r.randint(10, min(200 - at, 40))
        spans, found = block.hits(hashes(text(r.randint(0, 30)) + items[i][at : at + n] + text(r.randint(0, 30))))
        assert i in found and spans[:, 1].max() - spans[:, 0].min() >= n


def test_long_items_and_clashing_names(spark):
    words = [f"k{i}" for i in range(400)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[5:14]))], "item_id long, text string")
    rows = [(i, " ".join(words[i : i + 10]), "x", 7) for i in range(0, 391, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hit_items string, n_hit long")
    got = contaminated_spans(docs, items, block_words=37).collect()
    assert all(r.n_hit == 10 and "1" in r.hit_items for r in got)
    assert [r.doc_id for r in got if "2" in r.hit_items] == []
    assert contaminated_spans(spark.createDataFrame([(1, " ".join(words[4:15]))], "doc_id long, text string"), items, block_words=37).first().hit_items == ["1", "2"]
