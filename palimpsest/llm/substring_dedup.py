"""Substring dedup (operator 5): content-defined chunks, deduplicated by digest.

A gear hash rolls over a text's UTF-8 bytes (16 bits, so it knows the last 16 bytes).  A cut lies
where it is smallest among the ``reach`` positions to either side, between characters: cuts depend
on the bytes near them alone, lie more than ``reach`` bytes apart, and an insertion moves none but
those around it.  The cuts partition the whole text; its head and tail are chunks too, so equal
texts have equal chunks, however short.  Chunks are keyed by a 64-bit digest; one that occurs in
two or more rows is repeated.  Neighbouring repeated chunks join to spans, and spans of
``LEAST_WORDS`` words or more, or of a whole text, are reported: in all rows as repeats, and in all
rows but the first with the chunk as duplicates, which ``without_duplicates`` cuts out.

A digest that a third of all rows share is combined before the shuffle (smallest owner and count);
the repeated digests are written, so that both sides of their join are plain shuffles, which
adaptive execution splits where one key is hot.

Defined results: null and empty texts have no chunks; any other text has one at least; repetition
within one row alone is none; every row is a document of its own, also when ids are null or repeat
(the first row is that of the smallest doc_id, null ones last, then any one of equal ids); extra
columns are never read; texts of any length are cut whole; an empty table gives none.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import Scratch, materialize, sliced, table

REACH, LEAST_WORDS = 24, 12
_HIGHEST = 2**63 - 1


def _gear_table() -> np.ndarray:
    """256 pseudorandom 16-bit values from a rule."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(27))) >> np.uint64(48)).astype(np.uint16)


_GEAR = _gear_table()
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _lowest(h: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` consecutive values, by doubling."""
    low, have = h, 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    return low


def cuts(data: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Positions at which a chunk ends and the next begins, in order.

    The first 15 positions know fewer than 16 bytes and are no cuts; of equal smallest values the first is.
    """
    n = len(data)
    if n < 16 + 2 * reach:
        return np.empty(0, np.int64)
    h = _GEAR[data]
    for width in (1, 2, 4, 8):  # sums over 2, 4, 8 and 16 bytes
        h[width:] += h[:-width] << width  # the right side is computed before it is added
    h = h[15:-1].copy()  # a cut after byte i is decided by the hash at i; the text's end is none
    h[(data[16:] & 0xC0) == 0x80] = 0xFFFF  # a character goes on
    low = _lowest(h, reach)
    at = np.arange(reach, len(h) - reach)
    own = h[at]
    return at[(own < low[at - reach]) & (own <= low[at + 1]) & (own < 0xFFFF)] + 16


def chunks(text: str | None, reach: int = REACH) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Digest, bounds (bytes) and the words begun before each bound, of the chunks; and the number of words."""
    raw = (text or "").encode()
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return np.empty(0, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64), 0
    bounds = np.concatenate([[0], cuts(data, reach), [len(data)]])
    space = _SPACE[data]
    begins = ~space
    begins[1:] &= space[:-1]
    words = np.searchsorted(np.flatnonzero(begins), bounds)
    digest, places = xxhash.xxh3_64_intdigest, bounds.tolist()
    keys = np.fromiter((digest(raw[a:b]) for a, b in zip(places, places[1:])), np.uint64, len(places) - 1)
    return keys.view(np.int64), bounds, words, int(words[-1])


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values) if values else np.empty(0, np.int64), pa.int64()))


def _chunk_rows(docs: DataFrame, reach: int) -> DataFrame:
    """(row, doc_id, n_words, n_bytes, digests, spans, words) of ``docs`` (row, doc_id, text); spans and words hold two ints each."""
    names = ["row", "doc_id", "n_words", "n_bytes", "digests", "spans", "words"]

    def pairs(x: np.ndarray) -> np.ndarray:
        return (x[:-1].astype(np.int64) << 32) | x[1:].astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 500):
            found = [chunks(t, reach) for t in batch.column(2).to_pylist()]
            counts = [pa.array([x[3] for x in found], pa.int64()), pa.array([int(x[1][-1]) for x in found], pa.int64())]
            lists = [_lists([x[0] for x in found]), _lists([pairs(x[1]) for x in found]), _lists([pairs(x[2]) for x in found])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *counts, *lists], names)

    return docs.mapInArrow(run, "row long, doc_id long, n_words long, n_bytes long, digests array<long>, spans array<long>, words array<long>")


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _joined(owner: np.ndarray, span: np.ndarray, word: np.ndarray, sizes: np.ndarray, least_words: int) -> tuple[pa.Array, pa.Array]:
    """Words and spans of every owner 0, 1, ...: its touching chunks (sorted by owner and span) joined."""
    low, n = 2**32 - 1, len(sizes)
    start, end, u, v = span >> 32, span & low, word >> 32, word & low
    first = np.ones(len(span), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (start[1:] != end[:-1])
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(span)) - 1
    who, a, b, w = owner[at], start[at], end[last], v[last] - u[at]
    ok = (w >= least_words) | ((a == 0) & (b == sizes[who]))
    who, a, b, w = who[ok], a[ok], b[ok], w[ok]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(who, minlength=n))]).astype(np.int32)
    spans = pa.StructArray.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["start", "end"])
    return pa.array(np.bincount(who, w, minlength=n).astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), spans)


def _spans(hits: DataFrame, least_words: int) -> DataFrame:
    """(row, n_repeat_words, n_dup_words, repeats, duplicates) of hits (row, n_bytes, hits: array of (span, word, dup))."""
    names = ["row", "n_repeat_words", "n_dup_words", "repeats", "duplicates"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            own = batch.column(2)
            each = own.flatten()
            span, word = each.field("span").to_numpy(), each.field("word").to_numpy()
            dup = each.field("dup").to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(own)), own.value_lengths().to_numpy())
            order = np.lexsort((span, owner))
            owner, span, word, dup = owner[order], span[order], word[order], dup[order]
            sizes = batch.column(1).to_numpy()
            (a, repeats), (b, duplicates) = (_joined(owner[m], span[m], word[m], sizes, least_words) for m in (slice(None), dup))
            yield pa.RecordBatch.from_arrays([batch.column(0), a, b, repeats, duplicates], names)

    pair = "array<struct<start:long,end:long>>"
    return hits.mapInArrow(run, f"row long, n_repeat_words long, n_dup_words long, repeats {pair}, duplicates {pair}")


def _repeated(docs: DataFrame, reach: int, least_words: int) -> DataFrame:
    """``repeated_spans`` of ``docs`` (row, doc_id, text), with row; everything but the result is deleted again."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch(_chunk_rows(docs, reach), "chunks")
    owner = F.struct(F.coalesce("doc_id", F.lit(_HIGHEST)).alias("key"), "row")
    # a digest counts once per row; smallest owners and counts are combined before the shuffle
    known = rows.select(owner.alias("owner"), F.explode(F.array_distinct("digests")).alias("digest"))
    shared = known.groupBy("digest").agg(F.min("owner").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", F.col("first.row").alias("first"))
    shared = scratch(shared, "shared")
    each = rows.select("row", "n_bytes", F.explode(F.arrays_zip("digests", "spans", "words")).alias("c"))
    each = each.select("row", "n_bytes", F.col("c.digests").alias("digest"), F.col("c.spans").alias("span"), F.col("c.words").alias("word"))
    hits = each.join(shared, "digest").select("row", "n_bytes", F.struct("span", "word", (F.col("row") != F.col("first")).alias("dup")).alias("hit"))
    by_row = hits.groupBy("row").agg(F.first("n_bytes").alias("n_bytes"), F.collect_list("hit").alias("hits"))  # as many as the row has chunks
    found = _spans(by_row.select("row", "n_bytes", "hits"), least_words)
    none = F.expr("CAST(array() AS array<struct<start:bigint,end:bigint>>)")
    base = rows.select("row", "doc_id", "n_words", F.size("digests").cast("long").alias("n_chunks"))
    out = base.join(found, "row", "left").select(
        "row", "doc_id", "n_words", "n_chunks",
        F.coalesce("n_repeat_words", F.lit(0)).alias("n_repeat_words"), F.coalesce("n_dup_words", F.lit(0)).alias("n_dup_words"),
        F.coalesce("repeats", none).alias("repeats"), F.coalesce("duplicates", none).alias("duplicates"),
    )
    out = scratch(out, "result")
    scratch.drop("chunks", "shared")
    return out


def repeated_spans(docs: DataFrame, *, reach: int = REACH, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, n_words, n_chunks, n_repeat_words, n_dup_words, repeats, duplicates) for every row of ``docs``.

    repeats and duplicates are arrays of (start, end) byte offsets in the UTF-8 text, between characters.
    """
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")  # written with the chunks, so it stays
    return _repeated(keyed, reach, least_words).drop("row")


def without_duplicates(docs: DataFrame, *, reach: int = REACH, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` (doc_id, text and others) with ``text`` cut free of duplicate spans; every row stays."""
    tag = uuid.uuid4().hex
    key, cut_at = f"row_{tag}", f"cut_{tag}"
    docs = materialize(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    spans = _repeated(docs.select(F.col(key).alias("row"), "doc_id", "text"), reach, least_words)
    spans = spans.where("n_dup_words > 0").select(F.col("row").alias(key), F.col("duplicates").alias(cut_at))

    @F.pandas_udf("string")
    def cut(texts, own):
        out = []
        for text, spans_ in zip(texts, own):
            raw, kept, at = text.encode(), [], 0
            for s in spans_:
                kept.append(raw[at : s["start"]])
                at = s["end"]
            out.append(b"".join([*kept, raw[at:]]).decode())
        return type(texts)(out, dtype=object)

    joined = docs.join(spans, key, "left")
    same = joined.where(F.col(cut_at).isNull())
    changed = joined.where(F.col(cut_at).isNotNull()).withColumn("text", cut("text", cut_at))
    return same.union(changed).drop(key, cut_at)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents"))
