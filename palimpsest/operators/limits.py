"""Rate limit by windows that a key's first request opens.

A key's first request opens a window; every request counts in it, the denied ones too, until ``width`` has
passed since its start, and the next request after that opens the next one.  Windows of a key hang on each
other from its first request on, so they can't be read off a clock or from gaps.

The chain is cut into blocks of time.  A window that was open when a block begins ends within the block's
first ``width``, so the block's own chain begins at one of the few requests up to there: for each of them
(an entry) one sorted pass over the block tells where its chain ends.  A second pass, over the entries
alone, walks from block to block and finds the window that each begins with; a third numbers the requests.
Requests of a hot key are so spread over as many tasks as they span blocks, none of which holds a key or
a block in memory: passes keep the windows open at a time, one for each different time within ``width``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Chains:
    """The windows of one block for every entry: chains that open a window at the same time are one from there on."""

    def __init__(self, begin: int, width: int) -> None:
        self.zone, self.width, self.rows, self.latest, self.past_zone = begin + width, width, 0, None, False
        self.open: deque[tuple[int, int, list[int]]] = deque()  # start of the window, rows before it, entries

    def add(self, t: int) -> None:
        if t != self.latest:
            self.latest, entries = t, []
            while self.open and self.open[0][0] + self.width <= t:
                entries += self.open.popleft()[2]
            if t < self.zone or not self.past_zone:
                self.past_zone = t >= self.zone
                entries.append(t)
            if entries:
                self.open.append((t, self.rows, entries))
        self.rows += 1

    def ends(self) -> list[tuple[int, int, int]]:
        """(entry, start of the last window, rows in it) of every entry, in order."""
        return sorted((e, start, self.rows - before) for start, before, entries in self.open for e in entries)


def _runs(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, list]]:
    """Rows of sorted batches one by one, as (first ``width`` columns, the others)."""
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            yield row[:width], row[width:]


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], size: int = 10_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held) if held else [()] * len(names), kinds)], names)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield made()
            held = []
    yield made()


def _entries(rows: DataFrame, width: int, block: int) -> DataFrame:
    """(k, block, entry, last, n_last, n) of rows (k, block, t)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ended(group, chains):
            return [(*group, *e, chains.rows) for e in chains.ends()]

        def found():
            now, chains = None, None
            for group, (t,) in _runs(batches, 2):
                if group != now:
                    if chains:
                        yield from ended(now, chains)
                    now, chains = group, Chains(group[1] * block, width)
                chains.add(t)
            if chains:
                yield from ended(now, chains)

        yield from _batches(found(), ["k", "block", "entry", "last", "n_last", "n"], [pa.string(), *[pa.int64()] * 5])

    return rows.mapInArrow(run, "k string, block long, entry long, last long, n_last long, n long")


def _carried(entries: DataFrame, width: int) -> DataFrame:
    """(k, block, start, n): the window that is open, and the rows in it, when a block begins; nulls for a key's first block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            now, block, start, n, own = None, None, None, 0, []

            def after():
                at = bisect_left(own, (start + width,)) if start is not None else 0
                return (own[at][1], own[at][2]) if at < len(own) else (start, n + own[-1][3])

            for (k, b), e in _runs(batches, 2):
                if (k, b) != (now, block):
                    start, n = (None, 0) if k != now else after()
                    now, block, own = k, b, []
                    yield k, b, start, n
                own.append(e)

        yield from _batches(found(), ["k", "block", "start", "n"], [pa.string(), *[pa.int64()] * 3])

    return entries.mapInArrow(run, "k string, block long, start long, n long")


def limited_requests(rows: DataFrame, key: str, time: str, limit: int, *, tie: str, width_seconds: int = 60, block_seconds: int | None = None) -> DataFrame:
    """``rows`` with window_start, request_number (from 1 in its window) and allowed (up to ``limit`` of a window).

    Requests of one time count in the order of ``tie``, those alike in it in any order.  Null keys are one key; a row without a time isn't
    a request: its three columns are null.  Columns of ``rows`` with these names are replaced.  An empty table gives none.
    """
    width = width_seconds * 1_000_000
    block = max(block_seconds or 60 * width_seconds, width_seconds) * 1_000_000
    added = ["window_start", "request_number", "allowed"]
    rows = rows.drop(*added)
    t = F.unix_micros(F.col(time).cast("timestamp"))
    # a null key and an empty one are two
    keyed = rows.select(F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("")).alias("_k"), F.floor(t / block).alias("_block"), t.alias("_t"), F.struct(*rows.columns).alias("_row"), F.col(tie).alias("_tie"))
    known = keyed.where("_t IS NOT NULL")
    place = ["_k", "_block"]
    ordered = known.select(*place, "_t").repartition(*place).sortWithinPartitions(*place, "_t")
    entries = _entries(ordered, width, block)
    carried = _carried(entries.repartition("k").sortWithinPartitions("k", "block", "entry"), width)
    carried = carried.select(F.col("k").alias("_k"), F.col("block").alias("_block"), F.lit(0).alias("_kind"), F.col("start").alias("_t"), F.col("n").alias("_n"))
    both = known.select(*place, F.lit(1).alias("_kind"), "_t", F.lit(None).cast("long").alias("_n"), "_tie", "_row").unionByName(carried, allowMissingColumns=True)
    both = both.repartition(*place).sortWithinPartitions(*place, "_kind", "_t", "_tie").select("_kind", "_t", "_n", "_row")
    schema = T.StructType([both.schema["_row"], *T.StructType.fromDDL("_start long, _number long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, n = None, 0
        for batch in batches:
            keep, starts, numbers = [], [], []
            for k, (kind, t, before) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)))):
                if not kind:  # a block begins
                    start, n = t, before
                    continue
                if start is None or t >= start + width:
                    start, n = t, 0
                n += 1
                keep.append(k)
                starts.append(start)
                numbers.append(n)
            own = batch.column(3).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([own, pa.array(starts, pa.int64()), pa.array(numbers, pa.int64())], ["_row", "_start", "_number"])

    out = both.mapInArrow(run, schema)
    out = out.select("_row.*", F.timestamp_micros("_start").alias("window_start"), F.col("_number").alias("request_number"), (F.col("_number") <= limit).alias("allowed"))
    none = keyed.where("_t IS NULL").select("_row.*", F.lit(None).cast("timestamp").alias("window_start"), F.lit(None).cast("long").alias("request_number"), F.lit(None).cast("boolean").alias("allowed"))
    return out.union(none)
