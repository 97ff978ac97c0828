"""N-gram Jaccard join (operator 6): vertical partitioning with exact results.

A document's set holds the 64-bit hashes of its distinct word shingles; the order of hashes is the
global n-gram order.  Documents with equal sets form a class, and one text stands for each.

Candidates.  With threshold t, two sets that link share an n-gram within their first
``n - ceil(t * n) + 1`` n-grams of any common order.  The order used is the hash order with n-grams
found in more than ``hot`` classes moved to its end, so passages that many documents share don't
bring those together.  Pairs of a small bucket are counted; with c common prefix n-grams a pair's
overlap is at most c plus what lies behind a prefix, and pairs that can't reach the threshold go.
Classes that
share large buckets form a crowd; a crowd is cut into blocks by set size and hash, and pairs of
blocks are compared whole, fragment by fragment, giving a spanning forest of their links, so
neither the pairs nor the links of a crowd are ever written out.

Verification.  The global order is cut into ``fragments`` ranges of equal width.  Overlaps of the
candidate pairs are counted in each fragment separately and summed per pair.

Defined results: null, empty and word-free texts have no set, no links, and are their own
component; a text with fewer words than a shingle is one shingle; repeated rows are copies of one
class; a null doc_id takes part but never names a component unless all of its ids are null; texts of any length are compared whole; an empty table gives
none; columns but doc_id, text and the row key are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import Scratch, bound_batches, keyed_rows, sliced, table
from palimpsest.llm.components import components
from palimpsest.llm.decontaminate import WordHashes, gram_hashes

SHINGLE = 5
PERCENT = 80
#: Buckets of more classes than this are hot.
HOT = 20
#: Ranges of the global order in verification.
FRAGMENTS = 8
#: Classes of a crowd in one block.
BLOCK = 1024
#: Up to so many text keys (8 bytes each) are sent to the tasks; beyond, texts are joined.
SENT_KEYS = 2_000_000

_WORDS = re.compile(r"[^ \t-\r]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text: str | None, hashes: WordHashes, k: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a text's ``k``-word shingles (signed, in the global order)."""
    if not text:
        return np.empty(0, np.int64)
    words = _WORDS.findall(text.lower() if text.isascii() else text.translate(_LOWER))
    if not words:
        return np.empty(0, np.int64)
    grams = gram_hashes(hashes(words), min(k, len(words)))
    if len(words) < k:
        grams = grams ^ np.uint64(len(words))  # shorter sequences never equal a shingle
    return np.unique(grams.view(np.int64))


def prefix_size(n: int, percent: int) -> int:
    return n - (-(-percent * n // 100)) + 1


def _list_of(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))


def _heads(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Every row's set size, set digest, and the first n-grams of its set, a few more than its prefix; its row key stays, if it has one."""
    held = [c for c in docs.columns if c != "text"]
    kinds = dict(docs.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in held) + ", sig binary, n int, head array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in sliced(batches):
            sigs, sizes, heads = [], [], []
            for text in batch.column("text").to_pylist():
                s = shingle_set(text, hashes, k)
                n = len(s)
                p = prefix_size(n, percent)
                sigs.append(xxhash.xxh3_128_digest(s.tobytes()) if n else None)
                sizes.append(n)
                heads.append(s[: p + 4 + p // 8] if n else s)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in held), pa.array(sigs, pa.binary()), pa.array(sizes, pa.int32()), _list_of(heads)],
                [*held, "sig", "n", "head"],
            )

    return docs.mapInArrow(run, schema)


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(cid, n, toks) of the classes in ``wanted`` (cid, tid), from one text each."""
    if wanted.count() <= SENT_KEYS:
        # texts that aren't asked for stay where they are read: their keys' hashes are met there, at most SENT_KEYS of them
        keys = wanted.select(F.xxhash64("tid").alias("h")).distinct()
        docs = docs.withColumn("h", F.xxhash64("tid")).join(F.broadcast(keys), "h", "left_semi").select("tid", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in sliced(batches):
            toks = [shingle_set(t, hashes, k) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("cid"), _list_of(toks)], ["cid", "toks"])
            pa.default_memory_pool().release_unused()

    one = docs.select("tid", "text").dropDuplicates(["tid"]).join(wanted, "tid").select("cid", "text")
    return one.mapInArrow(run, "cid long, toks array<long>").withColumn("n", F.size("toks"))


def _enough(a: str, b: str, percent: int) -> str:
    """SQL for the least overlap of sets of sizes a and b: ceil(percent * (a + b) / (100 + percent))."""
    return f"ceil({percent} * ({a} + {b}) / {100 + percent})"


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, fragments: int) -> DataFrame:
    """The (a, b) of ``pairs`` that link: partial overlaps by fragment, summed per pair."""
    width = 2**64 // fragments

    def inside(i: int):
        low, high = -(2**63) + i * width, -(2**63) + (i + 1) * width
        return lambda x: (x >= low) & ((x < high) if i < fragments - 1 else F.lit(True))

    part = F.array(*(F.struct(F.lit(i).alias("frag"), F.filter("toks", inside(i)).alias("toks")) for i in range(fragments)))
    parts = sets.select("cid", "n", F.explode(part).alias("p")).select("cid", "n", "p.frag", "p.toks").where(F.size("toks") > 0)
    left = parts.select(F.col("cid").alias("a"), F.col("n").alias("na"), "frag", F.col("toks").alias("ta"))
    right = parts.select(F.col("cid").alias("b"), F.col("n").alias("nb"), "frag", F.col("toks").alias("tb"))
    partial = pairs.select("a", "b").join(right, "b").join(left, ["a", "frag"])
    counted = partial.select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).alias("o"))
    summed = counted.groupBy("a", "b").agg(F.max("na").alias("na"), F.max("nb").alias("nb"), F.sum("o").alias("o"))
    return summed.where(f"100 * o >= {percent} * (na + nb - o)").select("a", "b", "o")


def _labels(links: DataFrame, scratch: Scratch) -> DataFrame:
    return scratch(components(links.select(F.col("a").alias("src"), F.col("b").alias("dst"))), "labels")


def _apart(pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The pairs whose ends lie in different components so far."""
    if labels is None:
        return pairs
    la, lb = (labels.select(F.col("node").alias(x), F.col("component").alias(f"l{x}")) for x in "ab")
    return pairs.join(la, "a", "left").join(lb, "b", "left").where("coalesce(la, a) <> coalesce(lb, b)").select("a", "b")


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the graph of a boolean matrix."""
    n, edges = len(linked), []
    new = np.ones(n, bool)
    for root in range(n):
        if not new[root]:
            continue
        new[root] = False
        queue = [root]
        while queue:
            x = queue.pop()
            near = np.flatnonzero(linked[x] & new)
            new[near] = False
            edges += [(x, y) for y in near.tolist()]
            queue += near.tolist()
    return edges


def block_links(sizes: np.ndarray, sets: list[np.ndarray], percent: int, width: int = 4096) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets``: overlaps are summed over ranges of the n-gram order."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    grams, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    useful = times > 1
    column = np.cumsum(useful) - 1
    own, at = owner[useful[at]], column[at[useful[at]]]
    overlap = np.zeros((n, n), np.float32)
    order = np.argsort(at, kind="stable")
    own, at = own[order], at[order]
    for low in range(0, int(useful.sum()), width):
        i, j = np.searchsorted(at, [low, low + width])
        part = np.zeros((n, width), np.float32)
        part[own[i:j], at[i:j] - low] = 1
        overlap += part @ part.T
    overlap, sizes = overlap.astype(np.float64), sizes.astype(np.float64)  # counts are exact in 32 bits, a hundred times them aren't
    linked = 100 * overlap >= percent * (sizes[:, None] + sizes[None, :] - overlap)
    np.fill_diagonal(linked, False)
    return _forest(linked)


def _crowd_links(large: DataFrame, sets: DataFrame, percent: int, block: int, scratch: Scratch) -> DataFrame:
    """(a, b): links that connect what is linked among the classes of large buckets (g, cid, n, hub)."""
    stars = large.where("hub <> cid").select(F.col("hub").alias("src"), F.col("cid").alias("dst")).distinct()
    crowd = components(stars).select(F.col("node").alias("cid"), F.col("component").alias("crowd"))
    # sets that link differ in size by 100 / percent at most, so by one step of such a scale
    step = F.floor(F.log("n") / F.log(F.lit(100.0 / percent)) + F.lit(1e-9)).cast("int")
    member = scratch(crowd.join(sets.select("cid", "n"), "cid").withColumn("step", step), "crowds")
    blocks = member.groupBy("crowd", "step").agg(F.expr(f"CAST(ceil(count(*) / {block}) AS INT)").alias("blocks"))
    member = member.join(blocks, ["crowd", "step"]).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    above = blocks.select("crowd", (F.col("step") - 1).alias("step"), F.col("blocks").alias("above"))
    below = blocks.select("crowd", (F.col("step") + 1).alias("step"), F.col("blocks").alias("below"))
    near = member.join(above, ["crowd", "step"], "left").join(below, ["crowd", "step"], "left")
    # block i of step low meets block j of the same step or, if up, of the next
    same = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.col("step").alias("low"), F.lit(0).alias("up"), F.least(k, "block").alias("i"), F.greatest(k, "block").alias("j")))
    up = F.transform(F.sequence(F.lit(0), F.coalesce("above", F.lit(0)) - 1), lambda k: F.struct(F.col("step").alias("low"), F.lit(1).alias("up"), F.col("block").alias("i"), k.alias("j")))
    down = F.transform(F.sequence(F.lit(0), F.coalesce("below", F.lit(0)) - 1), lambda k: F.struct((F.col("step") - 1).alias("low"), F.lit(1).alias("up"), k.alias("i"), F.col("block").alias("j")))
    none = F.slice(same, 1, 0)
    meets = F.concat(same, F.when(F.col("above") > 0, up).otherwise(none), F.when(F.col("below") > 0, down).otherwise(none))
    dealt = near.select("cid", "crowd", F.explode(meets).alias("m")).select("cid", "crowd", "m.low", "m.up", "m.i", "m.j")
    dealt = dealt.join(sets.select("cid", "n", "toks"), "cid")

    def run(rows: pa.Table) -> pa.Table:
        cid, sizes = rows.column("cid").to_numpy(), rows.column("n").to_numpy().astype(np.float32)
        toks = rows.column("toks").combine_chunks()
        flat, cuts = toks.flatten().to_numpy(), np.cumsum(toks.value_lengths().to_numpy())[:-1]
        edges = block_links(sizes, np.split(flat, cuts), percent)
        return pa.table({"a": pa.array([cid[x] for x, _ in edges], pa.int64()), "b": pa.array([cid[y] for _, y in edges], pa.int64())})

    return dealt.groupBy("crowd", "low", "up", "i", "j").applyInArrow(run, "a long, b long")


def jaccard_components(
    docs: DataFrame, *, k: int = SHINGLE, percent: int = PERCENT, hot: int = HOT, fragments: int = FRAGMENTS, block: int = BLOCK, row_key: str | None = None
) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) for every row of ``docs`` (doc_id, text).

    class_id is the smallest doc_id with an equal set, component_id the smallest reachable by links.
    With ``row_key`` (a column of any sortable kind, different in every row) also row_key and stays: true for every row
    without words and for one row of each component, that of the smallest doc_id (null ones last), then row_key.
    """
    bound_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession)
    keyed = [F.col(row_key).alias("row_key")] if row_key else []
    docs = docs.select("doc_id", *keyed, "text", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("tid"))
    rows = scratch(_heads(docs, k, percent), "heads")
    first = [F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")).alias("first")] if row_key else []
    classes = rows.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("class_id"), F.any_value(F.struct("tid", "n", "head")).alias("r"), *first)
    classes = scratch(
        classes.select(F.monotonically_increasing_id().alias("cid"), "sig", "class_id", "r.tid", "r.n", "r.head", *(["first"] if row_key else [])), "classes"
    )

    grams = classes.select("cid", "n", F.explode("head").alias("g"))
    counts = scratch(grams.groupBy("g").agg(F.count("*").alias("df")).where("df > 1"), "counts")
    hot_grams = counts.where(F.col("df") > hot).select("g")
    p = F.expr(f"n - CAST(ceil({percent} * n / 100) AS INT) + 1")

    # classes whose head has too few n-grams that aren't hot need their whole set
    n_hot = grams.join(hot_grams, "g").groupBy("cid").agg(F.count("*").alias("n_hot"))
    crowded = classes.select("cid", "tid", "n", F.size("head").alias("held")).join(n_hot, "cid")
    deep = scratch(crowded.where(p > F.col("held") - F.col("n_hot")).select("cid", "tid"), "deep")
    deep_sets = scratch(_sets(docs, deep, k), "deep-sets")
    deep_grams = deep_sets.select("cid", "n", F.explode("toks").alias("g"))

    # the prefixes in the order with hot n-grams last; n-grams of a single class are left out
    flagged = hot_grams.withColumn("is_hot", F.lit(True))
    order = Window.partitionBy("cid").orderBy("is_hot", "g")
    deep_rank = deep_grams.join(flagged, "g", "left").withColumn("is_hot", F.coalesce("is_hot", F.lit(False)))
    deep_prefix = scratch(deep_rank.withColumn("at", F.row_number().over(order)).where(F.col("at") <= p).select("g", "cid", "n", "is_hot"), "deep-prefix")
    usual = classes.join(deep, "cid", "left_anti").select("cid", "n", F.posexplode("head").alias("at", "g"))
    shared = counts.select("g").union(deep_prefix.select("g")).distinct()
    usual = usual.join(shared, "g").join(flagged, "g", "left").withColumn("is_hot", F.coalesce("is_hot", F.lit(False)))
    before = F.sum(F.col("is_hot").cast("int")).over(Window.partitionBy("cid").orderBy("at"))
    usual = usual.withColumn("hot_before", before).where(~F.col("is_hot") & (F.col("at") - F.col("hot_before") < p)).select("g", "cid", "n", "is_hot")
    prefix = scratch(usual.union(deep_prefix), "prefixes")

    scratch.drop("counts", "deep-prefix")
    sizes = prefix.groupBy("g").agg(F.count("*").alias("size"), F.min("cid").alias("hub")).where("size > 1")
    small = prefix.join(sizes.where(F.col("size") <= hot).select("g"), "g").select("g", "cid", "n")
    large = scratch(prefix.join(sizes.where(F.col("size") > hot), "g").select("g", "cid", "n", "hub"), "large")
    any_large = not large.isEmpty()

    # pairs of small buckets, by how many prefix n-grams they share
    rest = lambda x: f"({x} - ({x} - CAST(ceil({percent} * {x} / 100) AS INT) + 1))"  # noqa: E731  behind the prefix
    x, y = small.select("g", F.col("cid").alias("a"), F.col("n").alias("na")), small.select("g", F.col("cid").alias("b"), F.col("n").alias("nb"))
    met = x.join(y, "g").where(f"a < b AND 100 * least(na, nb) >= {percent} * greatest(na, nb)")
    met = met.groupBy("a", "b").agg(F.count("*").alias("c"), F.max("na").alias("na"), F.max("nb").alias("nb"))
    found = scratch(met.where(f"c + greatest({rest('na')}, {rest('nb')}) >= {_enough('na', 'nb', percent)}").select("a", "b"), "pairs")

    ends = [found.select(F.col("a").alias("cid")), found.select(F.col("b").alias("cid"))] + ([large.select("cid")] if any_large else [])
    needed = reduce(DataFrame.union, ends).distinct()
    missing = classes.join(needed, "cid", "left_semi").join(deep, "cid", "left_anti").select("cid", "tid")
    sets = scratch(_sets(docs, scratch(missing, "missing"), k).select("cid", "n", "toks").union(deep_sets.select("cid", "n", "toks")), "sets")

    # each class against the smallest it met, and crowds; then what is still apart
    links = _verified(found.groupBy("b").agg(F.min("a").alias("a")), sets, percent, fragments).select("a", "b")
    if any_large:
        links = links.union(_crowd_links(large, sets, percent, block, scratch))
    links = scratch(links, "links")
    labels = None if links.isEmpty() else _labels(links, scratch)
    later = scratch(_apart(found, labels), "apart")
    if not later.isEmpty():
        more = scratch(_verified(later, sets, percent, fragments).select("a", "b"), "links")
        if not more.isEmpty():
            labels = _labels(links.union(more), scratch)

    named = classes.select("sig", "class_id", "cid", *(["first"] if row_key else []))
    if labels is not None:
        named = named.join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
        least = named.groupBy("component").agg(F.min("class_id").alias("component_id"), *([F.min("first").alias("first")] if row_key else []))
        named = named.drop("first").join(least, "component").select("sig", "class_id", "component_id", *(["first"] if row_key else []))
    else:
        named = named.select("sig", "class_id", F.col("class_id").alias("component_id"), *(["first"] if row_key else []))
    out = rows.select("doc_id", *(["row_key"] if row_key else []), "sig", F.col("n").cast("long").alias("n_shingles")).join(named, "sig", "left")
    empty = F.col("n_shingles") == 0
    stays = ["row_key", (empty | (F.col("row_key") == F.col("first.row_key"))).alias("stays")] if row_key else []
    out = out.select("doc_id", "n_shingles", *(F.when(empty, F.col("doc_id")).otherwise(F.col(c)).alias(c) for c in ("class_id", "component_id")), *stays)
    out = scratch(out, "result")
    scratch.drop(*(label for label in tuple(scratch.made) if label != "result"))
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each component stays, that of its smallest doc_id; all rows without words stay.

    Rows, not ids, are kept: each has its place in the files of ``docs`` as a key (or is written with one, if
    ``docs`` isn't read from Parquet files), so null and repeated ids lose nothing.
    """
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = keyed_rows(docs.select(*columns), "row_key")
    gone = jaccard_components(rows, row_key="row_key").where("NOT stays").select("row_key")
    return rows.join(gone, "row_key", "left_anti").select(*columns)


def oracle_sql(k: int = SHINGLE, percent: int = PERCENT) -> str:
    """DuckDB SQL: an inverted index of all shingles over classes of equal sets, and a closure of the links."""
    return rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT rid, doc_id, CASE WHEN len(ws) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(range(1, greatest(len(ws) - {k} + 1, 1) + 1),
    lambda i: array_to_string(ws[i:i + {k} - 1], ' ')))) END AS g FROM d),
c AS (SELECT g, len(g) AS n, min(rid) AS cid, min(doc_id) AS low FROM s WHERE len(g) > 0 GROUP BY g),
t AS (SELECT cid, n, unnest(g) AS w FROM c),
o AS (SELECT x.cid AS a, y.cid AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS o FROM t x JOIN t y USING (w)
    WHERE x.cid < y.cid AND 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) GROUP BY ALL),
l AS (SELECT a, b FROM o WHERE 100 * o >= {percent} * (na + nb - o)),
both_ways AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
comp AS (SELECT reach.a AS cid, min(c.low) AS component_id FROM reach JOIN c ON c.cid = reach.b GROUP BY reach.a)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, CASE WHEN len(s.g) = 0 THEN s.doc_id ELSE c.low END AS class_id,
    CASE WHEN len(s.g) = 0 THEN s.doc_id ELSE coalesce(comp.component_id, c.low) END AS component_id
FROM s LEFT JOIN c ON s.g = c.g LEFT JOIN comp ON comp.cid = c.cid
"""
