"""Personal data (operator 12): identifiers by pattern, and terms that disclose them by corpus co-occurrence.

Base spans are e-mail addresses, IP addresses, payment cards and phone numbers.  Each value found is a
protected entity.  A term (a word, or two words in a row, A-Z lower-cased) co-occurs with it in a row if
it lies within ``reach`` words of a mention.  With row counts over the whole corpus, of n rows in all,

    information of an entity  IC(e) = log2(n / rows(e))
    disclosed by a term       PMI(e; t) = log2(n * rows(e, t) / (rows(e) * rows(t)))

and IC - PMI = log2(rows(t) / rows(e, t)) bits of doubt are left to who reads the term.  A term is
disclosing if that is at most ``general_bits`` (it is generalised: replaced by its kind), or at most
``remove_bits`` (it is removed), wherever it stands; if PMI is at least ``least_bits`` (an entity that
most rows have is no secret); and if the two meet in ``least_texts`` different texts, so that copies of
one text are no evidence.

Work on Spark: one pass finds mentions and the terms around them; pairs are counted with combining
before the shuffle, by entity, term and a digest of the text, so a hot entity is spread.  A second pass
counts the rows of candidate terms, a third finds the disclosing ones; both look terms up in a bitmap of
fixed size first and then join, so the terms themselves are never sent to the driver or the tasks.

Defined results: null, empty and word-free texts have no spans; rows are judged one by one and count
each, also when they repeat or share an id; a null doc_id changes nothing; an empty table gives none;
of overlapping term spans one is made, removed if one of them is; terms never reach into base spans, which
may overlap each other; texts of any length are scanned once in each pass, in time linear in them; other
columns are never read (``sanitised`` passes them on).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import Scratch, bound_batches, materialize, sliced, table
from palimpsest.llm.decontaminate import _LOWER, gram_hashes

BASE_KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("generalised", "removed")

#: Fixed by the contract: the patterns of the four kinds.  An address is found from its @, an IP address from the begin of a run of digits.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
#: Words, and what mentions are overwritten with; of texts in a row also what stands between them.
_TOKEN = re.compile(r"\x01+|[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TOKENS = re.compile(r"[\x01\x02]|[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Characters of texts that a task looks through at a time (or one text), and words whose hashes it remembers.
_AT_A_TIME, _MEMO_WORDS = 1_000_000, 200_000


@dataclass(frozen=True)
class Disclosure:
    reach: int = 8
    least_texts: int = 3
    least_bits: float = 3.0
    general_bits: float = 1.0
    remove_bits: float = 0.152  # nine rows in ten that have the term have the entity beside it


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        domain, left = _DOMAIN.match(text, at + 1), at
        while domain and left > last and text[left - 1] in _LOCAL:
            left -= 1
        if left < at:
            last = domain.end()
            yield left, last
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base, by kind as listed, then start."""
    out = [("email", a, b) for a, b in emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _NOT_DIGIT.sub("", m.group())) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return out


def entity(kind: str, value: str) -> int:
    """A 64-bit key of an entity: the kind and the value as one would compare it."""
    value = value.lower() if kind == "email" else value if kind == "ip" else _NOT_DIGIT.sub("", value)
    return xxhash.xxh3_64_intdigest(f"{kind}:{value}")


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Lower-cased ``text`` in which every character of a span is the mark."""
    text = text.lower() if text.isascii() else text.translate(_LOWER)
    if not spans:
        return text
    parts, at = [], 0
    for _, a, b in sorted(spans, key=lambda s: s[1:]):
        parts += [text[at:a], "\x01" * (b - max(a, at))]
        at = max(at, b)
    return "".join([*parts, text[at:]])


class Hashes:
    """64-bit hashes of words, with a bounded memory of those seen."""

    def __init__(self) -> None:
        self.seen: dict[str, int] = {}

    def __call__(self, words: list[str]) -> np.ndarray:
        seen = self.seen
        if len(seen) > _MEMO_WORDS:
            seen.clear()
        for w in set(words).difference(seen):
            seen[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))


def hashed_terms(words: list[str], hashes: Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of a masked text's one- and two-word terms by place, and whether each is free of mentions."""
    one = hashes(words)
    free = np.fromiter((w[0] != "\x01" for w in words), bool, len(words))
    return one, gram_hashes(one, 2), free, free[:-1] & free[1:]


_SLOT_BITS = 22


def bitmap(terms: DataFrame) -> np.ndarray:
    """Which of 2**22 slots the terms' hashes fall into; the driver gets 65,536 numbers at most."""
    slot = F.shiftrightunsigned("term", 64 - _SLOT_BITS).cast("int")
    rows = terms.select((slot / 64).cast("int").alias("w"), F.pmod(slot, F.lit(64)).alias("b")).groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("v")).toArrow()
    words = np.zeros(1 << (_SLOT_BITS - 6), np.int64)
    words[rows.column("w").to_numpy()] = rows.column("v").to_numpy()
    return np.unpackbits(words.astype("<i8").view(np.uint8), bitorder="little").astype(bool)


_MARKS = [np.uint64(xxhash.xxh3_64_intdigest(x)) for x in "\x01\x02"]


def found_terms(texts: list[str], bits: np.ndarray, hashes: Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, token, words) of every term of one or two words in the bitmap, of masked ``texts`` looked through in one go.

    A token counts as ``_TOKENS`` has them, so a mark counts once for each of its characters.
    """
    one = hashes(_TOKENS.findall("\x02".join(texts)))
    if not len(one):
        return (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))
    between = one == _MARKS[1]
    word = ~between & (one != _MARKS[0])
    slot = lambda h: bits[(h >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)]
    two = gram_hashes(one, 2)
    at = [np.flatnonzero(slot(one) & word), np.flatnonzero(slot(two) & word[:-1] & word[1:]) if len(two) else np.empty(0, np.int64)]
    every = np.concatenate(at)
    ends = np.flatnonzero(between)
    text = np.searchsorted(ends, every)
    first = np.concatenate([[0], ends + 1])[text]
    return text, np.concatenate([one[at[0]], two[at[1]]]), every - first, np.repeat([1, 2], [len(at[0]), len(at[1])])


def _some_texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(place of the first, texts) of runs of rows with at most ``_AT_A_TIME`` characters, or one row."""
    first, held, size = 0, [], 0
    for k, text in enumerate(column.to_pylist()):
        if held and size + len(text or "") > _AT_A_TIME:
            yield first, held
            first, held, size = k, [], 0
        held.append(text or "")
        size += len(text or "")
    if held:
        yield first, held


def mentions(docs: DataFrame, plan: Disclosure = Disclosure()) -> DataFrame:
    """(entity, term, digest): once for every row, entity in it and term near a mention; term 0 stands for the entity itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in sliced(batches):
            rows: list[np.ndarray] = [np.empty((0, 3), np.uint64)]
            for text in batch.column(0).to_pylist():
                spans = base_spans(text or "")
                if not spans:
                    continue
                own = masked(text, spans)
                one, two, free, both = hashed_terms(_TOKEN.findall(own), hashes)
                begins = np.fromiter((m.start() for m in _TOKEN.finditer(own)), np.int64, len(one))
                near: dict[int, list[np.ndarray]] = {}
                for kind, a, b in spans:
                    # tokens before and behind the mention's own
                    left, right = int(np.searchsorted(begins, a)), int(np.searchsorted(begins, b))
                    found = near.setdefault(entity(kind, text[a:b]), [np.zeros(1, np.uint64)])
                    for lo, hi in ((max(left - plan.reach, 0), left), (right, right + plan.reach)):
                        found.append(one[lo:hi][free[lo:hi]])
                        found.append(two[lo : max(hi - 1, lo)][both[lo : max(hi - 1, lo)]])
                digest = np.uint64(xxhash.xxh3_64_intdigest(own))
                for key, found in near.items():
                    terms = np.unique(np.concatenate(found))
                    rows.append(np.stack([np.full(len(terms), key, np.uint64), terms, np.full(len(terms), digest)], axis=1))
            out = np.concatenate(rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(out[:, k]) for k in range(3)], ["entity", "term", "digest"])

    return docs.select("text").mapInArrow(run, "entity long, term long, digest long")


_FLUSH = 200_000


def term_rows(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """(term, n): rows by term, of terms in the bitmap; counted in parts by each task."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bits, held, n = Hashes(), sent.value, [], 0

        def counted() -> pa.RecordBatch:
            terms, counts = np.unique(np.concatenate(held or [np.empty(0, np.uint64)]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(counts.astype(np.int64))], ["term", "n"])

        for batch in batches:
            for _, some in _some_texts(batch.column(0)):
                text, term, _, _ = found_terms([masked(x, base_spans(x)) for x in some], bits, hashes)
                order = np.lexsort((term, text))  # a term counts once in a text
                text, term = text[order], term[order]
                new = np.ones(len(term), bool)
                new[1:] = (term[1:] != term[:-1]) | (text[1:] != text[:-1])
                held.append(term[new])
                n += int(new.sum())
                if n > _FLUSH:
                    yield counted()
                    held, n = [], 0
        yield counted()

    return docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def disclosing_terms(docs: DataFrame, plan: Disclosure = Disclosure()) -> DataFrame:
    """(term, action, entity, pmi, doubt): every disclosing term with what it discloses most surely, in a written table."""
    scratch = Scratch(docs.sparkSession)
    total = docs.count()
    alike = mentions(docs, plan).groupBy("entity", "term", "digest").agg(F.count("*").alias("n"))
    pairs = scratch(alike.groupBy("entity", "term").agg(F.sum("n").alias("n"), F.count("*").alias("texts")).where(F.col("texts") >= plan.least_texts), "pairs")
    alone = pairs.where("term = 0").select("entity", F.col("n").alias("entity_rows"))
    pairs_ = pairs.where("term <> 0")
    rows = term_rows(docs, bitmap(pairs_.select("term")))
    met = pairs_.join(alone, "entity").join(rows.withColumnRenamed("n", "term_rows"), "term")
    doubt = F.log2(F.col("term_rows") / F.col("n"))
    met = met.withColumns({"doubt": doubt, "pmi": F.log2(F.lit(float(max(total, 1))) / F.col("entity_rows")) - doubt})
    met = met.where((F.col("doubt") <= plan.general_bits) & (F.col("pmi") >= plan.least_bits))
    best = met.groupBy("term").agg(F.min(F.struct("doubt", (-F.col("pmi")).alias("minus"), "entity")).alias("b"))
    action = F.when(F.col("b.doubt") <= plan.remove_bits, "removed").otherwise("generalised")
    found = best.select("term", action.alias("action"), F.col("b.entity").alias("entity"), (-F.col("b.minus")).alias("pmi"), F.col("b.doubt").alias("doubt"))
    found = scratch(found, "terms")
    scratch.drop("pairs")
    return found


_SPAN = "array<struct<kind:string,start:long,end:long>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _occurrences(rows: DataFrame, bits: np.ndarray) -> DataFrame:
    """(row, doc_id, base, places) of rows (row, doc_id, text): base spans, and the places of terms in the bitmap."""
    sent = rows.sparkSession.sparkContext.broadcast(bits)  # of fixed size
    places_ = pa.list_(pa.struct([("term", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bits = Hashes(), sent.value
        for batch in batches:
            for k, some in _some_texts(batch.column(2)):
                spans = [base_spans(x) for x in some]
                lower = [masked(x, own) for x, own in zip(some, spans)]
                places: list[list[dict]] = [[] for _ in some]
                where: tuple[int, list] = (-1, [])
                hits = sorted(zip(*(x.tolist() for x in found_terms(lower, bits, hashes))))
                for text, term, token, n in hits:
                    if where[0] != text:
                        where = text, [m.span() for m in _TOKENS.finditer(lower[text])]
                    places[text].append({"term": term - (term >> 63 << 64), "start": where[1][token][0], "end": where[1][token + n - 1][1]})
                base = [[{"kind": kind, "start": a, "end": b} for kind, a, b in own] for own in spans]
                part = batch.slice(k, len(some))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(base, _SPANS), pa.array(places, places_)], ["row", "doc_id", "base", "places"])

    return rows.mapInArrow(run, f"row long, doc_id long, base {_SPAN}, places array<struct<term:long,start:long,end:long>>")


def merged_terms(hits: list[tuple[int, int, str]]) -> list[tuple[str, int, int]]:
    """Term spans (kind, start, end) by kind, then start, of hits (start, end, action): overlapping ones are one."""
    out: list[list] = []
    for a, b, action in sorted(hits):
        if out and a < out[-1][2]:
            out[-1][2] = max(out[-1][2], b)
            out[-1][0] = max(out[-1][0], action)  # "removed" is the greater word
        else:
            out.append([action, a, b])
    return sorted((tuple(x) for x in out), key=lambda s: (TERM_KINDS.index(s[0]), s[1]))


def _private(rows: DataFrame, plan: Disclosure) -> DataFrame:
    """(row, doc_id, spans) of rows (row, doc_id, text)."""
    scratch = Scratch(rows.sparkSession)
    terms = disclosing_terms(rows.select("text"), plan)
    found = scratch(_occurrences(rows, bitmap(terms.select("term"))), "found")
    each = found.where("size(places) > 0").select("row", F.explode("places").alias("p")).select("row", "p.term", "p.start", "p.end")
    hits = each.join(terms.select("term", "action"), "term").groupBy("row").agg(F.collect_list(F.struct("start", "end", "action")).alias("hits"))  # of one text

    @F.pandas_udf(_SPAN)
    def joined(column):
        return column.map(lambda own: [{"kind": k, "start": a, "end": b} for k, a, b in merged_terms([(h["start"], h["end"], h["action"]) for h in own])])

    hits = hits.select("row", joined("hits").alias("terms"))
    both = found.select("row", "doc_id", "base").join(hits, "row", "left")
    return both.select("row", "doc_id", F.concat("base", F.coalesce("terms", F.expr(f"CAST(array() AS {_SPAN.replace('long', 'bigint')})"))).alias("spans"))


def private_spans(docs: DataFrame, plan: Disclosure = Disclosure()) -> DataFrame:
    """(doc_id, spans) for every row of ``docs`` (doc_id, text): spans (kind, start, end) in code points, by kind, then start."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")  # written with the spans, so it stays
    return _private(rows, plan).drop("row")


def rewritten(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with its spans replaced by their kinds, a generalised term by what it looks like, a removed one by nothing."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a < at:  # overlaps the span before
            at = max(at, b)
            continue
        term = text[a:b]
        general = "[NUMBER]" if term[0].isdigit() else "[NAME]" if term[0].isupper() else "[TERM]"
        out += [text[at:a], {"generalised": general, "removed": ""}.get(kind, f"[{kind.upper()}]")]
        at = b
    return "".join([*out, text[at:]])


def sanitised(docs: DataFrame, plan: Disclosure = Disclosure()) -> DataFrame:
    """``docs`` (doc_id, text and others) with ``text`` free of its spans; every row stays, null texts stay null."""
    bound_batches(docs.sparkSession)
    tag = uuid.uuid4().hex
    key, found_at = f"row_{tag}", f"spans_{tag}"
    docs = materialize(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    spans = _private(docs.select(F.col(key).alias("row"), "doc_id", "text"), plan).where("size(spans) > 0")

    @F.pandas_udf("string")
    def cut(texts, own):
        return type(texts)([rewritten(t, [(s["kind"], s["start"], s["end"]) for s in o]) for t, o in zip(texts, own)], dtype=object)

    joined = docs.join(spans.select(F.col("row").alias(key), F.col("spans").alias(found_at)), key, "left")
    same, changed = joined.where(F.col(found_at).isNull()), joined.where(F.col(found_at).isNotNull())
    return same.union(changed.withColumn("text", cut("text", found_at))).drop(key, found_at)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = private_spans(table(spark, sf_dir, "documents"))
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    of = lambda *kinds: F.filter("spans", lambda s: s.kind.isin(*kinds))
    base = of(*BASE_KINDS)
    return out.select("doc_id", *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS), F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))
