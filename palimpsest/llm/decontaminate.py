"""Benchmark decontamination (operator 4): winnowed fingerprints, joined and extended.

Words are hashed to 64 bits.  Of every ``window - gram + 1`` consecutive ``gram``-word hashes the
smallest is kept as a fingerprint (winnowing), so any ``window`` consecutive words that a document
shares with an item share a fingerprint: items and documents are both winnowed, and of equal
hashes both keep the rightmost.  Fingerprints of documents meet those of the items; each meeting is
extended to all windows around it, and those that an item has, by a hash of all their words, are
hits.  Items of fewer words than a window are one window of their own length; they meet by the hash
of all their words.  Look-ups are array operations on distinct hashes, so a text of equal words or a
phrase of many items costs no more than others.

The benchmark is the stated query set: it is read in blocks of at most ``block_words`` words
(a documented bound), one block at a time is sent to the tasks, and every document is scanned whole.

Defined results: null or word-free texts have no words, no hits and the digest of the empty list;
null, empty or word-free items never occur; items with equal ids are one in the list of ids;
repeated documents are judged row by row; texts of any length are scanned whole; an empty table of
documents gives none, without items nothing is hit; other columns are passed on unread.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.common import Scratch, bound_batches, sliced, table

WINDOW, GRAM = 10, 5
#: Most words of the benchmark in one block; 2 million words are about 60 MB in a task.
BLOCK_WORDS = 2_000_000
#: Words whose hashes a task remembers before it starts anew.
MEMO_WORDS = 150_000

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Lower-cased (A-Z only) words; with ASCII text ``lower`` is the same and faster."""
    if not text:
        return []
    return _WORD.findall(text.lower() if text.isascii() else text.translate(_LOWER))


class WordHashes:
    """64-bit word hashes with a bounded memory of those seen."""

    def __init__(self) -> None:
        self.seen: dict[str, int] = {}

    def __call__(self, words: list[str]) -> np.ndarray:
        seen = self.seen
        if len(seen) > MEMO_WORDS:
            seen.clear()
        try:
            return np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for w in words:
                if w not in seen:
                    seen[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A hash for every run of ``k`` words (empty if there are fewer)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for j in range(1, k):
        out = (out ^ (out >> np.uint64(29))) * _MULTIPLIER + h[j : n + j]
    return (out ^ (out >> np.uint64(32))) * _MULTIPLIER


def winnow(grams: np.ndarray, span: int) -> np.ndarray:
    """Positions of the smallest hash of every ``span`` consecutive ones (the rightmost of equals)."""
    n = len(grams) - span + 1
    if n <= 0:
        return np.arange(len(grams))
    low = grams[:n].copy()
    for j in range(1, span):
        np.minimum(low, grams[j : n + j], out=low)
    best = np.zeros(n, np.int64)
    for j in range(span):
        np.copyto(best, j, where=grams[j : n + j] == low)
    return np.unique(best + np.arange(n))


def _sorted_groups(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, where the owners of each begin (one more at the end), and the distinct owners of each."""
    order = np.lexsort((owners, keys))
    keys, owners = keys[order], owners[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
    keys, owners = keys[new], owners[new]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[at], np.append(at, len(keys)), owners


class Windows:
    """The windows of ``k`` words of a block's items, by hash, with the items that have each."""

    def __init__(self, k: int, hashes: list[np.ndarray], owners: list[int]) -> None:
        self.k = k
        each = [gram_hashes(h, k) for h in hashes]
        self.keys, self.begin, self.owner = _sorted_groups(np.concatenate(each), np.repeat(np.array(owners), [len(x) for x in each]))
        self.map = bitmap(self.keys)

    def hits(self, h: np.ndarray, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Which windows of a document's words (those at ``starts``, or all) are an item's, and the items."""
        found = gram_hashes(h, self.k)
        starts = np.arange(len(found)) if starts is None else starts
        starts = starts[in_map(self.map, found[starts])]
        at = np.searchsorted(self.keys, found[starts])
        same = self.keys[np.minimum(at, len(self.keys) - 1)] == found[starts]
        at = np.unique(at[same])
        items = [self.owner[i:j] for i, j in zip(self.begin[at].tolist(), self.begin[at + 1].tolist())]  # distinct windows
        return starts[same], np.unique(np.concatenate(items)) if items else np.empty(0, np.int64)


def bitmap(keys: np.ndarray) -> np.ndarray:
    """Over the 20 highest bits; keeps most hashes that aren't among the keys from the binary search."""
    out = np.zeros(1 << 20, bool)
    out[(keys >> np.uint64(44)).astype(np.int64)] = True
    return out


def in_map(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return bits[(hashes >> np.uint64(44)).astype(np.int64)]


class Block:
    """Fingerprints and windows of the items of one block, sorted for look-up."""

    def __init__(self, items: list[tuple[str | None, np.ndarray]], window: int, gram: int) -> None:
        self.window, self.gram, self.span = window, gram, window - gram + 1
        self.ids = [i for i, _ in items]
        long = [(k, h) for k, (_, h) in enumerate(items) if len(h) >= window]
        prints = [(g := gram_hashes(h, gram))[winnow(g, self.span)] for _, h in long]
        self.prints = np.unique(np.concatenate(prints)) if prints else np.empty(0, np.uint64)
        self.map = bitmap(self.prints)
        self.long = Windows(window, [h for _, h in long], [k for k, _ in long]) if long else None
        self.short = []
        for size in sorted({len(h) for _, h in items if 0 < len(h) < window}):
            own = [(k, h) for k, (_, h) in enumerate(items) if len(h) == size]
            self.short.append(Windows(size, [h for _, h in own], [k for k, _ in own]))

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, set[int]]:
        """Hit spans [start, end) of the document's words, merged, as rows of two; and the items that occur."""
        mark = None
        found: set[int] = set()
        starts: list[tuple[np.ndarray, int]] = []
        for windows in self.short:
            if len(h) >= windows.k:
                at, items = windows.hits(h)
                starts.append((at, windows.k))
                found.update(items.tolist())
        if self.long and len(h) >= self.window:
            grams = gram_hashes(h, self.gram)
            where = winnow(grams, self.span)
            where = where[in_map(self.map, grams[where])]
            at = np.searchsorted(self.prints, grams[where])
            where = where[self.prints[np.minimum(at, len(self.prints) - 1)] == grams[where]]
            if len(where):
                # a fingerprint is extended to every window around it; those that are an item's are hits
                around = np.zeros(len(h) + self.span, np.int64)
                np.add.at(around, np.maximum(where - self.span + 1, 0), 1)
                np.add.at(around, where + 1, -1)
                near = np.flatnonzero(np.cumsum(around)[: len(h) - self.window + 1])
                at, items = self.long.hits(h, near)
                starts.append((at, self.window))
                found.update(items.tolist())
        for at, k in starts:
            if len(at):
                mark = np.zeros(len(h) + 1, np.int64) if mark is None else mark
                mark[at] += 1
                np.add.at(mark, at + k, -1)
        if mark is None:
            return np.empty((0, 2), np.int64), found
        hit = np.concatenate([[False], np.cumsum(mark) > 0, [False]])
        edges = np.flatnonzero(hit[1:] != hit[:-1])
        return edges.reshape(-1, 2), found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _item_blocks(items: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> Iterator[list[tuple[str | None, np.ndarray]]]:
    """Items' ids and word hashes in blocks of at most ``block_words`` words, fetched block by block.

    An item longer than a block is cut into parts that share a window less one word, so none is lost.
    """
    hashes = WordHashes()
    block: list[tuple[str | None, np.ndarray]] = []
    total, step = 0, max(block_words, window)
    rows = items.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t"))
    for row in rows.toLocalIterator():
        h = hashes(words_of(row.t))
        for at in range(0, max(len(h) - window + 1, 1), step - window + 1):
            part = h[at : at + step]
            if block and total + len(part) > block_words:
                yield block
                block, total = [], 0
            block.append((row.i, part))
            total += len(part)
    yield block


_ADDED = ("n_words", "hit_spans", "n_hit", "hit_items")


def contaminated_spans(
    docs: DataFrame,
    items: DataFrame,
    *,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with n_words, hit_spans (word positions, merged), n_hit and hit_items (sorted distinct ids).

    Columns of ``docs`` with these four names are replaced.  Items without an id count in hit_spans
    and n_hit; there is no id of theirs to list.
    """
    if not 0 < gram <= window:
        raise ValueError("a fingerprint's words must fit into a window")
    bound_batches(docs.sparkSession)
    out, sent, scratch = docs.drop(*_ADDED), None, None
    for k, block in enumerate(_item_blocks(items, item_id, item_text, window, block_words)):
        if k:  # the blocks so far are done with before the next is sent: one is held at a time
            scratch = scratch or Scratch(docs.sparkSession)
            out = scratch(out, f"block-{k}")
            scratch.drop(f"block-{k - 1}")
            sent.destroy()
        sent = docs.sparkSession.sparkContext.broadcast(Block(block, window, gram))  # bounded by block_words
        out = _scan(out, text_col, sent, merge=k > 0)
    return out


def _scan(docs: DataFrame, text_col: str, sent, merge: bool = False) -> DataFrame:
    base = [f for f in docs.schema.fields if f.name not in _ADDED]
    own = T.StructType.fromDDL("n_words long, hit_spans array<struct<start:long,end:long>>, n_hit long, hit_items array<string>")
    schema = T.StructType([*base, *own.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hashes = sent.value, WordHashes()
        for batch in sliced(batches):
            count, spans, hit, items = [], [], [], []
            earlier = list(zip(batch.column("hit_spans").to_pylist(), batch.column("hit_items").to_pylist())) if merge else None
            for k, text in enumerate(batch.column(text_col).to_pylist()):
                h = hashes(words_of(text))
                s, found = known.hits(h)
                s, ids = [tuple(x) for x in s.tolist()], {known.ids[i] for i in found}
                if merge:
                    s = merged(s + [(x["start"], x["end"]) for x in earlier[k][0]])
                    ids |= set(earlier[k][1])
                count.append(len(h))
                spans.append([{"start": a, "end": b} for a, b in s])
                hit.append(sum(b - a for a, b in s))
                items.append(sorted(x for x in ids if x is not None))
            arrays = [batch.column(f.name) for f in base]
            arrays += [pa.array(count, pa.int64()), pa.array(spans, _SPANS), pa.array(hit, pa.int64()), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return docs.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contaminated_spans(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with a benchmark window go; null and word-free texts, null and repeated ids stay as they are; an empty table gives none."""
    found = contaminated_spans(docs.select("doc_id", "text", "lang", "source", "n_chars"), table(spark, sf_dir, "benchmark"))
    return found.where("n_hit = 0").select("doc_id", "text", "lang", "source", "n_chars")


def oracle_sql(window: int = WINDOW) -> str:
    """DuckDB SQL of the same result: an equality join of all windows."""
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS ws FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(ws), {window}) AS k, unnest(CASE WHEN len(ws) = 0 THEN []
        ELSE list_transform(range(1, greatest(len(ws) - {window} + 1, 1) + 1), lambda i: array_to_string(ws[i:i + {window} - 1], ' ')) END) AS win FROM b),
ks AS (SELECT DISTINCT k FROM bw),
dp AS (SELECT rid, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, ks WHERE len(ws) >= k),
dw AS (SELECT rid, i, k, array_to_string(ws[i:i + k - 1], ' ') AS win FROM dp),
hits AS (SELECT rid, i, dw.k, item FROM dw JOIN bw ON dw.win = bw.win AND dw.k = bw.k),
n AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS j FROM hits) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN its USING (rid)
"""
