"""Mixing sources to target weights (operator 2): blocks drawn per shard, joined by index.

Every source's words, document after document, form one stream that is cut into blocks of
``block_words`` words.  The output is a sequence of slots, ``shard_slots`` to a shard.  Each shard's
slots are shared over the sources by a multinomial draw whose weights are what the sources still
lack of their targets, so errors of early shards are made good by later ones.  A source's k-th slot
takes block ``permute(k mod blocks)`` of pass ``k div blocks``: a keyed Feistel permutation of the
block numbers, another one in each pass.  Slots meet blocks by (source, block number).

The order of a source's documents is that of a hash of id and text, so it doesn't depend on files or
partitions; reruns agree.  Positions come from sums over fixed hash buckets, not from one task per
source, so one source may hold most of the rows.

Defined results: null text has size 0; documents of size 0 take nothing; null source is a source,
last in order; repeated rows are documents of their own; an empty table gives an empty result;
long texts are cut into blocks' parts; columns but doc_id, source, lang and text are never read.
What the driver holds is bounded by sources and by shards times sources (8 bytes each).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import WORD, bound_batches, materialize, sliced, table

#: Fixed by the contract: the weights of the sources in order, repeated.
WEIGHTS = (5.0, 2.0, 1.0)
MOST_PASSES = 3


@dataclass(frozen=True)
class MixPlan:
    block_words: int = 128
    #: Slots of a shard; larger where there would be more than ``most_shards`` shards.
    shard_slots: int = 4096
    most_shards: int = 20_000
    #: Documents of one hash bucket of a source.
    bucket_rows: int = 2_000
    seed: int = 17


def targets_of(sizes: list[int], weights: list[float], cap: int = MOST_PASSES) -> list[float]:
    """Shares of sum(sizes) by weight, none above ``cap`` times its size; the excess goes to the others by weight."""
    left, open_ = float(sum(sizes)), set(range(len(sizes)))
    out = [0.0] * len(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total > cap * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = float(cap * sizes[i])
        left -= sum(out[i] for i in full)
        open_ -= set(full)
    return out


def shard_counts(slots: list[int], shard_slots: int, seed: int) -> np.ndarray:
    """counts[shard, source]: multinomial draws by what is still lacking; each column sums to its slots."""
    lacking = np.array(slots, np.int64)
    total = int(lacking.sum())
    rng = np.random.Generator(np.random.Philox(seed))
    shards = -(-total // shard_slots) if total else 0
    out = np.zeros((shards, len(slots)), np.int64)
    for s in range(shards):
        size = min(shard_slots, int(lacking.sum()))
        while size:
            drawn = np.minimum(rng.multinomial(size, lacking / lacking.sum()), lacking)
            out[s] += drawn
            lacking -= drawn
            size -= int(drawn.sum())
    return out


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def permute(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of 0..size-1: four Feistel rounds, walked until the value is below size."""
    x, n, key = index.astype(np.uint64), size.astype(np.uint64), key.astype(np.uint64)
    half = np.zeros(len(x), np.uint64)  # bits of a half: the smallest square of a power of two that holds size
    for b in range(1, 32):
        half[(np.uint64(1) << np.uint64(2 * b - 2)) < n] = b
    half = np.maximum(half, np.uint64(1))
    mask = (np.uint64(1) << half) - np.uint64(1)
    todo = np.arange(len(x))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = x[todo] >> h, x[todo] & m
        for r in range(4):
            left, right = right, left ^ (_scramble(right + k * np.uint64(2 * r + 1) + np.uint64(r)) & m)
        x[todo] = (left << h) | right
        todo = todo[x[todo] >= n[todo]]
    return x.astype(np.int64)


def sized(docs: DataFrame, text_col: str = "text", plan: MixPlan = MixPlan()) -> tuple[DataFrame, list[tuple], int]:
    """``docs`` with their sizes, and what the driver needs to know of the sources.

    Adds size and spread (a hash of id and text); also gives (source, src, size, target) of every source
    and the bucket count.
    """
    rows = docs.withColumns({"size": F.regexp_count(F.coalesce(text_col, F.lit("")), F.lit(WORD)).cast("long"), "spread": F.xxhash64("doc_id", text_col)})
    totals = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()  # one row per source
    totals = sorted(totals, key=lambda r: (r.source is None, r.source or ""))
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(totals))]
    goals = targets_of([r["size"] for r in totals], weights)
    sources = [(r.source, i, r["size"], goals[i]) for i, r in enumerate(totals)]
    buckets = max(1, -(-max((r.n for r in totals), default=1) // plan.bucket_rows))
    return rows, sources, buckets


_SOURCES = "source string, src int, source_size long, target double"


def positioned(rows: DataFrame, sources: list[tuple], buckets: int) -> DataFrame:
    """Add src, source_size, target and ``start``: the words before a document in its source's stream.

    ``rows`` has row, doc_id, source, size, spread; ``row`` only tells repeated rows apart.
    """
    known = rows.sparkSession.createDataFrame(sources, _SOURCES)
    rows = rows.join(F.broadcast(known), rows.source.eqNullSafe(known.source)).drop(known.source)  # one row per source
    rows = rows.withColumn("bucket", F.pmod("spread", F.lit(buckets)).cast("int"))
    sums = rows.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("src", "bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("base"))
    within = Window.partitionBy("src", "bucket").orderBy("spread", "doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return rows.join(base, ["src", "bucket"]).withColumn("start", F.col("base") + F.col("inner")).drop("base", "inner", "bucket")


def slots(spark: SparkSession, sources: list[tuple], plan: MixPlan = MixPlan()) -> DataFrame:
    """(shard, shards, slot, src, block): the block of every slot of the mix; shards is their number, slots count up in a source."""
    b = plan.block_words
    counts = [min(round(t * -(-n // b) / n), MOST_PASSES * -(-n // b)) if n else 0 for _, _, n, t in sources]  # by the mean words of a block
    per_shard = max(plan.shard_slots, -(-sum(counts) // plan.most_shards))
    drawn = shard_counts(counts, per_shard, plan.seed)
    first = np.cumsum(drawn, axis=0) - drawn
    shard, src = np.nonzero(drawn)
    blocks = np.array([max(1, -(-n // b)) for _, _, n, _ in sources] or [1], np.int64)
    cells = pd.DataFrame({"shard": shard.astype(np.int64), "src": src.astype(np.int32), "first": first[shard, src], "n": drawn[shard, src], "blocks": blocks[src] if len(src) else src})
    schema = "shard long, src int, first long, n long, blocks long"
    table_ = spark.createDataFrame(cells, schema) if len(cells) else spark.createDataFrame([], schema)
    each = table_.select("shard", "src", "blocks", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("k"))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            src, size, k = (batch.column(c).to_numpy() for c in ("src", "blocks", "k"))
            key = _scramble((k // np.maximum(size, 1)).astype(np.uint64) * np.uint64(1_000_003) + src.astype(np.uint64) + np.uint64(plan.seed * 0x9E3779B97F4A7C15 % 2**64))
            got = permute(k % np.maximum(size, 1), size, key)
            yield pa.RecordBatch.from_arrays([batch.column("shard"), batch.column("k"), batch.column("src"), pa.array(got, pa.int64())], ["shard", "slot", "src", "block"])

    drawn_ = each.mapInArrow(draw, "shard long, slot long, src int, block long")
    return drawn_.select("shard", F.lit(len(drawn)).cast("long").alias("shards"), "slot", "src", "block")


def pieces(rows: DataFrame, block_words: int) -> DataFrame:
    """One row for each block that a document reaches into: block, and its words [lo, hi) within the document."""
    last = F.col("start") + F.col("size") - 1
    b = F.lit(block_words)
    cut = rows.where("size > 0").withColumn("block", F.explode(F.sequence(F.expr(f"start div {block_words}"), (last / b).cast("long"))))
    lo = F.greatest(F.col("block") * b - F.col("start"), F.lit(0))
    hi = F.least((F.col("block") + 1) * b - F.col("start"), F.col("size"))
    return cut.withColumns({"lo": lo, "hi": hi})


def mix_counts(docs: DataFrame, text_col: str = "text", plan: MixPlan = MixPlan()) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every document."""
    spark = docs.sparkSession
    rows, sources, buckets = sized(docs.select("doc_id", "source", F.col(text_col).alias("text")), plan=plan)
    if not sources:
        return rows.select("doc_id", "source", "size", F.lit(0).cast("long").alias("source_size"), F.lit(0.0).alias("target"), F.lit(0).cast("long").alias("taken"))
    small = materialize(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", "size", "spread"), "sizes")
    placed = materialize(positioned(small, sources, buckets), "placed")
    draws = slots(spark, sources, plan).groupBy("src", "block").agg(F.count("*").alias("draws"))
    parts = pieces(placed.select("row", "src", "start", "size"), plan.block_words).select("row", "src", "block", (F.col("hi") - F.col("lo")).alias("w"))
    taken = parts.join(draws, ["src", "block"]).groupBy("row").agg(F.sum(F.col("w") * F.col("draws")).alias("taken"))
    out = placed.join(taken, "row", "left")
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mix_texts(docs: DataFrame, plan: MixPlan = MixPlan()) -> DataFrame:
    """The mix itself: (shard, shards, slot, src, part, doc_id, source, lang, text), one row per document's part of a slot's block.

    A part runs from its first word to the next part's first word, so parts of one document joined
    in order give the document back.
    """
    spark = docs.sparkSession
    bound_batches(spark, 1000)
    rows, sources, buckets = sized(docs.select("doc_id", "source", "lang", "text"), plan=plan)
    # one text for rows alike in all columns meets each of their places; it is shuffled once, by a digest of the row
    alike = F.md5(F.concat(F.to_json(F.struct("doc_id", "source", "lang"), {"ignoreNullFields": "false"}), F.coalesce("text", F.lit(""))))
    rows = rows.where("size > 0").withColumn("alike", F.unhex(alike))
    small = materialize(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", "lang", "size", "spread", "alike"), "sizes")
    placed = positioned(small, sources, buckets).select("doc_id", "source", "lang", "alike", "src", "start", "size")
    texts = rows.groupBy("alike").agg(F.first("text").alias("text"))
    texts = placed.join(texts, "alike").select("src", "start", "size", "doc_id", "source", "lang", "text")
    b = plan.block_words
    schema = "src int, block long, part long, lo long, doc_id long, source string, lang string, text string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        word = re.compile(r"[^ \t-\r]+")
        for batch in sliced(batches):
            out: list[list] = [[] for _ in range(8)]
            for r in batch.to_pylist():
                text, at = r["text"], [m.start() for m in word.finditer(r["text"])]
                first = r["start"] // b
                for block in range(first, (r["start"] + r["size"] - 1) // b + 1):
                    lo, hi = max(block * b - r["start"], 0), min((block + 1) * b - r["start"], r["size"])
                    part = text[at[lo] if lo else 0 : at[hi] if hi < len(at) else len(text)]
                    # parts of a block are in the order of their stream
                    for column, v in zip(out, (r["src"], block, max(r["start"], block * b), lo, r["doc_id"], r["source"], r["lang"], part)):
                        column.append(v)
                if len(out[0]) >= 5_000:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, out)), cut_schema)
                    out = [[] for _ in range(8)]
            yield pa.RecordBatch.from_pydict(dict(zip(names, out)), cut_schema)

    names = ["src", "block", "part", "lo", "doc_id", "source", "lang", "text"]
    cut_schema = pa.schema([("src", pa.int32()), ("block", pa.int64()), ("part", pa.int64()), ("lo", pa.int64()), ("doc_id", pa.int64()), ("source", pa.string()), ("lang", pa.string()), ("text", pa.string())])
    parts = texts.mapInArrow(cut, schema)
    return slots(spark, sources, plan).join(parts, ["src", "block"]).select("shard", "shards", "slot", "src", "part", "doc_id", "source", "lang", "text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_counts(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the parts of documents that the mix takes, as often as it takes them.

    Rows are in the mix's order: by shard, in a shard by a hash of slot and source, in a slot by
    place in its block; files are in that order too.  Texts without words give no part; null ids, sources and
    languages stay null; alike rows are drawn each for itself; an empty table gives none.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    mixed = mix_texts(docs).withColumn("turn", F.pmod(F.xxhash64("slot", "src"), F.lit(1 << 20)))
    # shards are alike in size and turns are spread evenly, so equal ranges of both need no sample of the rows
    at = (F.col("shard") + F.col("turn") / F.lit(float(1 << 20))) / F.col("shards")
    mixed = mixed.repartitionById(parts, F.floor(at * parts).cast("int"))
    mixed = mixed.sortWithinPartitions("shard", "turn", "src", "slot", "part")
    return mixed.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))
