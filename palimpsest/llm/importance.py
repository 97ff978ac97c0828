"""Importance resampling towards a target (operator 13): hashed n-gram features, overlap chunks, Gumbel ranks.

Features are all runs of 1 to ``n`` consecutive words, hashed into ``buckets``.  The raw corpus and the
target texts are counted by bucket; a bucket's gain is the log ratio of both, a document's weight the
floored mean of the gains of its features.  Seeded Gumbel noise is added, and the highest scores of the
documents with ``least_words`` words or more are drawn: sampling without replacement in proportion to
the exponentiated weights, the same in every run.

Long texts are split at word boundaries into chunks that own ``chunk_words`` starting positions each
and carry ``n - 1`` words more, so every run starts in just one chunk and lies whole within it.  Chunks
are dealt over all tasks; their counts and gains are summed by document.  Only chunks of texts of more
than ``long_chars`` characters are shuffled, shorter ones are counted where they are read.

The driver sees one count for each bucket and the number of rows in each range of scores.

Defined results: null, empty and word-free texts have no features, weight 0, and are never drawn; a
null doc_id draws its noise as the empty string does and comes last among ties; every row is judged as
a document of its own, also when ids repeat (ties of one id go by their weight and features, then in
any order); an empty table gives none; an empty target has T = 0 and every t = 0; other columns are never read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import Scratch, bound_batches, keyed_rows, sliced, table
from palimpsest.llm.decontaminate import _LOWER, _WORD, words_of

#: Words whose checksums a task remembers before it starts anew.
MEMO_WORDS = 150_000


@dataclass(frozen=True)
class Resampling:
    n: int = 2
    buckets: int = 10_000
    seed: str = "7"
    least_words: int = 20
    percent: int = 25
    chunk_words: int = 8192
    long_chars: int = 60_000


class Buckets:
    """The buckets of all runs of 1 to ``n`` words: checksums of longer runs go on from those of shorter ones."""

    def __init__(self, n: int, buckets: int) -> None:
        self.n, self.buckets = n, buckets
        self.crc: dict[str, int] = {}
        self.tail: dict[str, bytes] = {}

    def __call__(self, words: list[str], own: int) -> np.ndarray:
        """Of the runs that start at the first ``own`` words."""
        crc, tail = self.crc, self.tail
        if len(crc) > MEMO_WORDS:
            crc.clear()
            tail.clear()
        for w in set(words).difference(crc):
            raw = w.encode()
            crc[w], tail[w] = zlib.crc32(raw), b" " + raw
        now = list(map(crc.__getitem__, words))
        found = now[:own]
        if self.n > 1:
            tails = list(map(tail.__getitem__, words))
            for k in range(1, self.n):
                now = list(map(zlib.crc32, tails[k:], now))  # a checksum of a run and the next word
                found += now[:own]
        return np.array(found, np.int64) % self.buckets


def split_text(text: str, chunk_words: int, carry: int) -> Iterator[tuple[int, str]]:
    """(owned starting positions, text) of the chunks of a text, each with up to ``carry`` words of the next."""
    if carry >= chunk_words:
        raise ValueError("a chunk must own more words than it carries")
    starts: list[int] = []  # of chunks not yet ended: two at most
    i = end = 0
    for m in _WORD.finditer(text.translate(_LOWER)):
        if i % chunk_words == 0:
            starts.append(m.start())
        end = m.end()
        i += 1
        if i > carry and (i - carry) % chunk_words == 0:
            yield chunk_words, text[starts.pop(0) : end]
    for k, at in enumerate(starts):
        yield min(chunk_words, i - (i - 1) // chunk_words * chunk_words if k == len(starts) - 1 else chunk_words), text[at:end]


def overlap_chunks(rows: DataFrame, plan: Resampling = Resampling()) -> DataFrame:
    """(row, doc_id, own, text) of rows (row, doc_id, text): whole short texts (own null) and the chunks of long ones, dealt anew."""
    long = F.coalesce(F.length("text"), F.lit(0)) > plan.long_chars
    short = rows.where(~long).select("row", "doc_id", F.lit(None).cast("long").alias("own"), "text")
    names = ["row", "doc_id", "own", "text"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in sliced(batches, 16):
            schema = schema or pa.schema([batch.schema.field(0).with_name("row"), ("doc_id", pa.int64()), ("own", pa.int64()), ("text", pa.string())])
            for k, text in enumerate(batch.column(2).to_pylist()):
                found = list(split_text(text, plan.chunk_words, plan.n - 1)) or [(0, "")]  # no word: a row still
                once = [batch.column(c).take(pa.array([k] * len(found))) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([*once, pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.string())], schema=schema)

    kind = rows.schema["row"].dataType.simpleString()
    chunks = rows.where(long).select("row", "doc_id", "text").mapInArrow(cut, f"row {kind}, doc_id long, own long, text string")
    return short.union(chunks.repartition(F.xxhash64("row", "text")).select(*names))


def bucket_counts(chunks: DataFrame, plan: Resampling = Resampling()) -> np.ndarray:
    """Features by bucket over chunks (own, text): a task counts its own, so at most ``buckets`` rows of it are shuffled."""
    n, buckets = plan.n, plan.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, total = Buckets(n, buckets), np.zeros(buckets, np.int64)
        for batch in sliced(batches):
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                total += np.bincount(of(words, len(words) if own is None else own), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    parts = chunks.select("own", "text").mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row for each bucket at most
        out[r.bucket] = r.n
    return out


def gains_of(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))) of every bucket."""
    n, big, small = len(raw), int(raw.sum()), int(target.sum())
    ratio = lambda s, t: float(t + 1) * float(big + n) / (float(s + 1) * float(small + n))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def weighed(chunks: DataFrame, gains: np.ndarray, plan: Resampling = Resampling()) -> DataFrame:
    """(row, doc_id, part, n_words, n_features, gain) of every row of ``overlap_chunks``' result; part: it is a chunk of a long text."""
    n, buckets = plan.n, plan.buckets
    sent = chunks.sparkSession.sparkContext.broadcast(gains)  # one number for each bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, gain = Buckets(n, buckets), sent.value
        for batch in sliced(batches):
            rows = []
            for own, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = words_of(text)
                own = len(words) if own is None else own
                found = of(words, own)
                rows.append((own, len(found), int(gain[found].sum())))
            columns = zip(*rows) if rows else [()] * 3
            arrays = [batch.column(0), batch.column(1), pa.array(np.array([x is not None for x in batch.column(2).to_pylist()], bool))]
            yield pa.RecordBatch.from_arrays([*arrays, *(pa.array(c, pa.int64()) for c in columns)], ["row", "doc_id", "part", "n_words", "n_features", "gain"])

    kind = chunks.schema["row"].dataType.simpleString()
    return chunks.mapInArrow(run, f"row {kind}, doc_id long, part boolean, n_words long, n_features long, gain long")


def summed(parts: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, n_features, weight): chunks of a document summed, short texts as they are."""
    totals = [F.sum(c).alias(c) for c in ("n_words", "n_features", "gain")]
    long = parts.where("part").groupBy("row").agg(F.first("doc_id").alias("doc_id"), *totals)
    names = ["row", "doc_id", "n_words", "n_features", "gain"]
    both = parts.where("NOT part").select(*names).union(long.select(*names))
    mean = F.expr("IF(n_features = 0, 0, (gain - pmod(gain, n_features)) div n_features)")  # exact, downwards
    return both.select("row", "doc_id", "n_words", "n_features", mean.alias("weight"))


def importance_scores(docs: DataFrame, target: DataFrame, *, target_text: str = "text", plan: Resampling = Resampling()) -> DataFrame:
    """(row, doc_id, n_words, n_features, weight, score) for every row of ``docs`` (doc_id, text); ``row`` is a key of the row."""
    bound_batches(docs.sparkSession)
    rows = keyed_rows(docs.select("doc_id", "text"), "row")
    chunks = overlap_chunks(rows, plan)
    wanted = target.select(F.monotonically_increasing_id().alias("row"), F.lit(None).cast("long").alias("doc_id"), F.col(target_text).alias("text"))
    gains = gains_of(bucket_counts(chunks, plan), bucket_counts(overlap_chunks(wanted, plan), plan))
    parts = Scratch(docs.sparkSession)(weighed(chunks, gains, plan), "parts")  # numbers only: short and long texts are read of it, the texts not again
    found = summed(parts)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{plan.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return found.withColumn("score", F.col("weight") + noise.cast("long"))


def ranked(scores: DataFrame, plan: Resampling = Resampling()) -> DataFrame:
    """``scores`` without ``row`` and with ``rank``: 1, 2, 3... of the drawn, null of the others.

    Rows are dealt by ranges of their order and written with the number of their range; a rank is the
    rows of the ranges before and the place within its own, so no task sees more than a range.
    """
    scratch = Scratch(scores.sparkSession)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc(), F.col("n_features")]
    spread = F.xxhash64("row")  # splits rows that are alike in all of these
    eligible = F.col("n_words") >= plan.least_words
    ranges = scratch(scores.where(eligible).withColumn("spread", spread).repartitionByRange(*order, "spread").withColumn("range", F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy("range").agg(F.count("*").alias("n"))  # one row for each range
    before = sizes.select("range", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    drawn = ranges.count() * plan.percent // 100
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order, "spread"))
    rank = F.col("before") + F.col("place")
    names = [c for c in scores.columns if c != "row"]
    top = ranges.withColumn("place", place).join(before, "range").select(*names, F.when(rank <= drawn, rank).cast("long").alias("rank"))
    return top.union(scores.where(~eligible).select(*names, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, plan: Resampling = Resampling(), target_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank): every row of ``docs``, the drawn ones ranked."""
    return ranked(importance_scores(docs, target, target_text=target_text, plan=plan), plan)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def oracle_sql(plan: Resampling = Resampling()) -> str:
    """The same in DuckDB SQL; a checksum is folded over the bits of a feature's bytes."""
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    runs = " UNION ALL ".join(f"SELECT side, rid, unnest(list_transform(range(1, len(ws) - {k - 2}), lambda i: array_to_string(ws[i:i + {k - 1}], ' '))) AS f FROM w WHERE len(ws) >= {k}" for k in range(1, plan.n + 1))
    return rf"""
WITH w AS (SELECT 0 AS side, row_number() OVER () AS rid, doc_id, {words} AS ws FROM documents
    UNION ALL SELECT 1, 0, NULL, {words} FROM benchmark),
feats AS ({runs}),
hexed AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM feats)),
bits AS (SELECT f, list_transform(range(0, 4 * length(x)), lambda k: ((('0x' || substr(x, (2 * (k // 8) + 1)::BIGINT, 2))::BIGINT) >> (k % 8)::BIGINT) & 1) AS bs FROM hexed),
hashed AS (SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, bs), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295) % {plan.buckets} AS bucket FROM bits),
placed AS (SELECT side, rid, bucket FROM feats JOIN hashed USING (f)),
counts AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM placed GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0)::DOUBLE AS big, coalesce(sum(t), 0)::DOUBLE AS small FROM counts),
gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (big + {plan.buckets}) / ((s + 1)::DOUBLE * (small + {plan.buckets}))))::BIGINT AS gain FROM counts, totals),
sums AS (SELECT rid, count(*) AS n, sum(gain) AS gain FROM placed JOIN gains USING (bucket) WHERE side = 0 GROUP BY rid),
scored AS (SELECT rid, doc_id, len(ws) AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(floor(gain::DOUBLE / n), 0)::BIGINT AS weight,
    coalesce(floor(gain::DOUBLE / n), 0)::BIGINT
    + floor(-1000.0 * ln(-ln((('0x' || substr(sha256('{plan.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
    FROM w LEFT JOIN sums USING (rid) WHERE side = 0),
top AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, weight DESC, n_features) AS r, count(*) OVER () AS n FROM scored WHERE n_words >= {plan.least_words})
SELECT doc_id, n_features, weight, score, CASE WHEN r <= n * {plan.percent} // 100 THEN r END AS rank
FROM scored LEFT JOIN top USING (rid)
"""
