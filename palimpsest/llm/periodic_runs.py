"""Periodic run detection (operator 11): a Lyndon stack under both orders, extended by rolling-hash comparisons.

A text's words become ids, numbered as they first occur; only their equality and any one order of them
matter.  The stack is scanned from right to left: the longest Lyndon word that starts at a word grows by
the words on the stack as long as the suffix at its start is smaller than theirs.  Every run has a Lyndon
root in the order, plain or reversed, in which the word behind the run is smaller than the one a period
before it (the text's end is smallest in both), and that root is the longest Lyndon word at its start.  A
run of four periods or more holds two such roots one after the other, so only starts whose word and the
word behind it are equally long are extended, to both sides, to the whole run.

Suffixes are compared by the length of their common extension: a few words directly, then a binary
search over rolling hashes (modulo 2^61 - 1, kept as sums of a prefix and built only for texts that need
them); the words found equal are compared directly once more, so a clash of hashes can't change a result.
What is verified is remembered by distance, so repeats of one word or phrase take time in proportion to
their length.  There is no suffix array.

A text is one task's work and takes memory in proportion to its words; nothing is shuffled.

Defined results: null, empty and word-free texts have no words, no runs and an empty collapsed text;
rows are judged one by one, so null or repeated ids, repeated rows and ties change nothing; an empty
table gives none; columns other than the text and those in ``keep`` are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.common import WORD, bound_batches, sliced, table

LEAST_WORDS, LEAST_PERIODS = 6, 4
_MODULUS, _BASE, _DIRECT = 2**61 - 1, 0x1B873593CC9E2D51 % (2**61 - 1), 8
_WORDS = re.compile(r"[^ \t-\r]+")


class Extensions:
    """Longest common extensions to the right and to the left of two places of a text, ``i`` before ``j``."""

    def __init__(self, ids: list[int]) -> None:
        self.ids, self.n = ids, len(ids)
        self.array = np.array(ids, np.int64)
        self.sums: list[int] | None = None
        self.powers: list[int] = []
        #: Of a distance: the latest stretch [low, high) whose words equal those at that distance, and that ends there.
        self.known: dict[int, tuple[int, int]] = {}

    def _hashes(self) -> list[int]:
        if self.sums is None:
            self.sums = list(accumulate(self.ids, lambda h, x: (h * _BASE + x + 1) % _MODULUS, initial=0))
            self.powers = list(accumulate(range(self.n), lambda p, _: p * _BASE % _MODULUS, initial=1))
        return self.sums

    def _search(self, low: int, high: int, i: int, j: int, step: int) -> int:
        """The largest length up to ``high`` at which hashes are equal, ``low`` being known to be; step 1 to the right, -1 to the left."""
        sums, powers = self._hashes(), self.powers

        def same(k: int) -> bool:
            a, b = (i, j) if step > 0 else (i - k, j - k)
            return (sums[a + k] - sums[b + k] - (sums[a] - sums[b]) * powers[k]) % _MODULUS == 0

        reach = low
        while reach < high:  # doubles first: most extensions are short
            reach = min(2 * reach, high)
            if not same(reach):
                break
            low = reach
        else:
            return high
        high = reach - 1
        while low < high:
            middle = (low + high + 1) // 2
            if same(middle):
                low = middle
            else:
                high = middle - 1
        return low

    def right(self, i: int, j: int) -> int:
        """How many words from ``i`` on equal those from ``j`` on."""
        ids, most, k = self.ids, self.n - j, 0
        near = most if most < _DIRECT else _DIRECT
        while k < near and ids[i + k] == ids[j + k]:
            k += 1
        if k < _DIRECT or k == most:
            return k
        low, high = self.known.get(j - i, (-1, -1))
        if low <= i + k <= high:
            return high - i
        ahead = i < low  # the stretch that is known lies ahead: it is enough to come to its begin
        length = self._search(k, min(most, low - i) if ahead else most, i, j, 1)
        length = self._verified(i, j, length)
        if ahead and i + length == low:
            length = high - i
        self.known[j - i] = (i, i + length)
        return length

    def left(self, i: int, j: int) -> int:
        """How many words before ``i`` equal those before ``j``."""
        ids, k = self.ids, 0
        near = min(i, _DIRECT)
        while k < near and ids[i - k - 1] == ids[j - k - 1]:
            k += 1
        if k < _DIRECT or k == i:
            return k
        length = self._search(k, i, i, j, -1)
        differ = self.array[i - length : i] != self.array[j - length : j]
        return length if not differ.any() else int(np.argmax(differ[::-1]))

    def _verified(self, i: int, j: int, length: int) -> int:
        differ = self.array[i : i + length] != self.array[j : j + length]
        return length if not differ.any() else int(np.argmax(differ))


def lyndon_ends(keys: list[int], right) -> list[int]:
    """Where the longest Lyndon word from each place on ends, in the order of ``keys``; ``right`` compares equal keys' suffixes."""
    n = len(keys)
    ends = [n] * n
    for i in range(n - 1, -1, -1):
        x, j = keys[i], i + 1
        while j < n:
            y = keys[j]
            if x == y:
                k = right(i, j)
                if j + k == n or keys[i + k] > keys[j + k]:  # the suffix at j is a prefix of the one at i, or smaller
                    break
            elif x > y:
                break
            j = ends[j]
        ends[i] = j
    return ends


def runs_of(words: list[str], least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run, by start and period; ``least_periods`` is 3 at least."""
    if least_periods < 3:
        raise ValueError("two whole roots one after the other are sure only from three periods on")
    n = len(words)
    if n < least_words:
        return []
    number: dict[str, int] = {}
    ids = [number.setdefault(w, len(number)) for w in words]
    if len(number) == n:
        return []  # no word occurs twice
    extend = Extensions(ids)
    found: set[tuple[int, int, int]] = set()
    for keys in (ids, [-x for x in ids]):
        ends = np.array(lyndon_ends(keys, extend.right))
        size = ends - np.arange(n)
        inner = np.flatnonzero(ends < n)
        next_ = ends[inner]
        roots = inner[(size[inner] == size[next_]) & (extend.array[inner] == extend.array[next_])]
        past: dict[int, int] = {}  # of a period: the end of the latest stretch that was extended
        for i, p in zip(roots.tolist(), size[roots].tolist()):
            if i + p < past.get(p, 0):
                continue
            end = i + p + extend.right(i, i + p)
            if end >= i + 2 * p:
                past[p] = end
                start = i - extend.left(i, i + p)
                if end - start >= max(least_words, least_periods * p):
                    found.add((start, end - start, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return " ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return " ".join(words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist())


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """``docs``' columns ``keep`` with n_words, runs (start, length, period in words) and collapsed, the text without repetition."""
    bound_batches(docs.sparkSession)
    source = docs.select(*(F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)), F.col(text_col).alias("own_text"))
    own = T.StructType.fromDDL("n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    schema = T.StructType([*source.schema.fields[:-1], *own.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 128):
            count, runs, rest = [], [], []
            for text in batch.column(len(keep)).to_pylist():
                words = _WORDS.findall(text or "")
                found = runs_of(words, least_words, least_periods)
                count.append(len(words))
                runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                rest.append(collapsed(words, found))
            arrays = [*(batch.column(i) for i in range(len(keep))), pa.array(count, pa.int64()), pa.array(runs, _RUNS), pa.array(rest, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    out = source.mapInArrow(run, schema)
    return out.select(*(F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)), *own.names)


def with_periods(doc_id: Column, text: Column) -> Column:
    """The contract's texts: of one document in ten, the words from a place on repeat from there with a period, both given by its id."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    made = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")
    return F.when((h % 10 == 0) & (n > 0), made).otherwise(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = periodic_runs(docs.select("doc_id", with_periods(F.col("doc_id"), F.col("text")).alias("text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    line = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")), F.lit("\n"))), "")
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-longest.start).alias("start"),
        longest.length.alias("length"),
        (-longest.period).alias("period"),
        F.expr("CAST(NULL AS BIGINT)").alias("exponent_milli"),
        F.sha2(line, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).withColumn("exponent_milli", F.expr("1000 * length div period"))
