"""Order-dependent operators: packing, batching, islands, offsets.

Folds run inside one row's array or inside one key's window, so keys are independent and the work
spreads over partitions.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

# Texts whose chunks are Python objects at the same time.
TEXTS_AT_ONCE = 64


def pack(sizes: Column, target: int, most: int) -> Column:
    """Group number of each unit: a new group begins before a unit that would exceed ``most`` and after ``target`` is reached."""
    start = F.struct(F.array().cast("array<int>").alias("groups"), F.lit(0).alias("group"), F.lit(0).alias("held"))

    def step(acc: Column, size: Column) -> Column:
        fresh = (acc["held"] > 0) & (acc["held"] + size > most)
        group = acc["group"] + fresh.cast("int")
        held = F.when(fresh, size).otherwise(acc["held"] + size)
        full = held >= target
        return F.struct(
            F.concat(acc["groups"], F.array(group)).alias("groups"),
            (group + full.cast("int")).alias("group"),
            F.when(full, F.lit(0)).otherwise(held).alias("held"),
        )

    return F.aggregate(sizes, start, step, lambda acc: acc["groups"])


def sentences(col: Column) -> Column:
    """Text split behind sentence ends that precede a capital, a digit or a bracket."""
    return F.split(col, SENTENCE_END)


# Fixed value: where a text may be cut into sentences.
SENTENCE_END = r"(?<=[.!?])\s+(?=[A-Z0-9(\[])"
_SENTENCE_END = re.compile(SENTENCE_END)


def groups_of(sizes: list[int], target: int, most: int, later: int = 0) -> Iterator[tuple[int, int]]:
    """(start, end) of groups of units: each ends where it reaches ``target`` or where the next unit wouldn't fit into ``most``.

    Found in the running sums of the sizes; a unit of its own may exceed ``most``.  From the second group on,
    ``later`` is held by something else.
    """
    total = list(accumulate(sizes, initial=0))
    at = 0
    while at < len(sizes):
        full = bisect_left(total, total[at] + target, at + 1)
        fits = bisect_right(total, total[at] + most - (later if at else 0)) - 1
        end = max(at + 1, min(full, fits))
        yield at, end
        at = end


def words_in(text: str) -> int:
    return len(text.split())


def split_text(text: str, target: int, most: int) -> list[str]:
    """A text of more than ``most`` words in parts: sentences packed, longer ones cut every ``most`` words and kept apart."""
    if words_in(text) <= most:
        return [text]
    sentences_ = filter(None, map(str.strip, _SENTENCE_END.split(text.strip())))
    parts: list[str] = []
    for is_long, some in groupby(sentences_, key=lambda x: words_in(x) > most):
        run = list(some)
        if is_long:
            parts += [" ".join(own[k : k + most]) for own in map(str.split, run) for k in range(0, len(own), most)]
        else:
            parts += [" ".join(run[a:b]) for a, b in groups_of([words_in(x) for x in run], target, most)]
    return parts


def packed(texts: list[str], target: int, most: int) -> list[tuple[str, int, list[int]]]:
    """(text, words, indices of texts) of the groups of all parts of ``texts``."""
    if texts and sum(map(len, texts)) < 10 * target and (whole := sum(map(words_in, texts))) < target and whole <= most:  # one group
        return [("\n\n".join(map(str.strip, texts)), whole, list(range(len(texts))))]
    parts = [(k, part.strip()) for k, text in enumerate(texts) for part in split_text(text, target, most)]
    sizes = [words_in(part) for _, part in parts]
    return [("\n\n".join(p for _, p in parts[a:b]), sum(sizes[a:b]), [k for k, _ in parts[a:b]]) for a, b in groups_of(sizes, target, most)]


def chunk_texts(docs: DataFrame, *, target: int = 200, most: int = 300, text_col: str = "text") -> DataFrame:
    """(doc_id, chunk_index, chunk_id, words, content): the chunks of every row, cut at sentences; rows are apart even if ids repeat.

    Texts without words have none.  One pass without a shuffle, linear in a text; TEXTS_AT_ONCE texts are in memory at a time.
    """

    rows = docs.select("doc_id", F.col(text_col).alias("text"))
    schema = StructType([StructField("doc_id", rows.schema["doc_id"].dataType), *StructType.fromDDL("chunk_index int, words int, content string")])
    types = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(k, TEXTS_AT_ONCE)
                made = [(at, n, words, content) for at, x in enumerate(part.column(1)) if (text := x.as_py()) for n, (content, words, _) in enumerate((g for g in packed([text], target, most) if g[1]), 1)]
                at, *columns = zip(*made) if made else ((),) * 4
                ids = part.column(0).take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, f.type) for c, f in zip(columns, list(types)[1:]))], schema=types)

    each = rows.mapInArrow(run, schema)
    ident = F.concat(F.col("doc_id").cast("string"), F.lit(":chunk:"), F.format_string("%04d", "chunk_index"))
    return each.select("doc_id", "chunk_index", ident.alias("chunk_id"), "words", "content")


def batch_numbers(sizes: Column, most_rows: Column, most_size: Column) -> Column:
    """Batch of each unit, from 1: a new one begins before a unit that would exceed either bound."""
    start = F.struct(F.array().cast("array<int>").alias("out"), F.lit(1).alias("batch"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("held"))

    def step(acc: Column, size: Column) -> Column:
        fresh = (acc["n"] > 0) & ((acc["n"] >= most_rows) | (acc["held"] + size > most_size))
        batch = acc["batch"] + fresh.cast("int")
        return F.struct(
            F.concat(acc["out"], F.array(batch)).alias("out"), batch.alias("batch"),
            F.when(fresh, F.lit(1)).otherwise(acc["n"] + 1).alias("n"), F.when(fresh, size).otherwise(acc["held"] + size).cast("long").alias("held"),
        )

    return F.aggregate(sizes, start, step, lambda acc: acc["out"])


def running_offset(rows: DataFrame, key: str, order: str, size: Column, gap: int = 2) -> DataFrame:
    """Add ``span_start``: the sizes of all earlier rows of the key, each with ``gap`` behind it."""
    earlier = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("span_start", F.coalesce(F.sum(size + gap).over(earlier), F.lit(0)).cast("long"))


def contiguous_runs(rows: DataFrame, key: str, order: str, value: Column) -> DataFrame:
    """Add ``run``: 1, 2, ... for stretches of equal ``value`` within a key."""
    w = Window.partitionBy(key).orderBy(order)
    changed = F.coalesce((~value.eqNullSafe(F.lag(value).over(w))).cast("int"), F.lit(1))
    first = F.row_number().over(w) == 1
    return rows.withColumn("_c", F.when(first, 1).otherwise(changed)).withColumn("run", F.sum("_c").over(w)).drop("_c")


def merge_intervals(rows: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """(key, island, start_day, end_day, gap_days, next_day): intervals joined if at most one day apart.

    gap_days and next_day tell of the days that lie between an island and the next one.
    """
    w = Window.partitionBy(key).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col(start) > F.date_add(before, 1)), 1).otherwise(0)
    islands = rows.withColumn("_o", opens).withColumn("island", F.sum("_o").over(w)).groupBy(key, "island").agg(F.min(start).alias("start_day"), F.max(end).alias("end_day"))
    after = F.lead("start_day").over(Window.partitionBy(key).orderBy("island"))
    return islands.withColumn("gap_days", F.coalesce(F.datediff(after, "end_day") - 1, F.lit(0))).withColumn("next_day", F.date_add("end_day", 1))


def bounded_batches(rows: DataFrame, key: str, order: str, size: Column, most_rows: int, most_size: int, overhead: int = 0) -> DataFrame:
    """Add ``batch`` (from 1) within each key: it closes before a row that would exceed either bound.

    A row larger than ``most_size`` alone is a batch of its own with ``oversized`` set.
    """
    units = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), size.cast("long").alias("size")))).alias("units"))
    start = F.struct(F.array().cast("array<int>").alias("out"), F.lit(1).alias("batch"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("held"))

    def step(acc: Column, u: Column) -> Column:
        own = u["size"] + overhead
        fresh = (acc["n"] > 0) & ((acc["n"] >= most_rows) | (acc["held"] + own > most_size))
        batch = acc["batch"] + fresh.cast("int")
        return F.struct(
            F.concat(acc["out"], F.array(batch)).alias("out"), batch.alias("batch"),
            F.when(fresh, F.lit(1)).otherwise(acc["n"] + 1).alias("n"), F.when(fresh, own).otherwise(acc["held"] + own).alias("held"),
        )

    numbered = units.withColumn("out", F.aggregate("units", start, step, lambda acc: acc["out"]))
    each = numbered.select(key, F.explode(F.arrays_zip("units", "out")).alias("z")).select(key, F.col("z.units.at").alias(order), F.col("z.out").alias("batch"))
    return rows.join(each, [key, order]).withColumn("oversized", size + overhead > most_size)
