"""Token-ID / binary output (operator 1): documents to compressed id files and back.

Documents are dealt by ranges of doc_id and sorted, tokenized, and written as records of whole
documents.  A record holds a directory (doc ids and lengths) and blocks of at most BLOCK_IDS ids;
each block is coded by itself (see ``context_coder``) and carries checksums of its bytes and ids.
Records are rows of a Parquet table in the shared folder, so a lost executor's records are written
again by Spark's commit protocol.  Reading decodes record by record and verifies every checksum.

Tokenizing.  Texts are cut where a byte-level tokenizer's own split has a bound for certain (see
``pieces``), each distinct piece is encoded by the tokenizers library and remembered by the worker, and
a document's ids are the joined ids of its pieces.  Tokenizers of other kinds encode texts whole.

Defined results: null text is empty (its end id only); null doc ids come first; repeated rows are
kept, in the order of a hash of their text; a text of any length is encoded whole, in parts of bounded
size; an empty table gives an empty table; columns but doc_id and text are never read.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import bound_batches, materialize, table
from palimpsest.llm.context_coder import BLOCK_IDS, decode_block, encode_block

END_ID = 2
VOCABULARY = "byte_bpe_50k.json"
#: A worker remembers the last so many pieces, and those of them it met again.
MEMO_PIECES = 600_000
#: Bytes of text whose pieces are held at a time (one text may be longer).
SLICE_BYTES = 5_000_000
_MAGIC = b"PALTOK2\0"
_RECORD = struct.Struct("<8sIQI")  # magic, documents, ids, ids of the vocabulary
_CRC = struct.Struct("<I")  # crc32 of that and of the directory


def tokenizer_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Text around which white space isn't a single space or line end: there the text is cut at safe spaces only.
_ODD = "[ \\n][ \\n]|[\\t\\v\\f\\r\\x1c-\\x1f\\x85\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Behind a letter (of the first 592 characters) and at its piece's end, a mark is a piece of its own.
_MARKS = [".", ",", ";", ":", "!", "?"]
_MARKED = "[A-Za-z\\x{aa}\\x{b5}\\x{ba}\\x{c0}-\\x{d6}\\x{d8}-\\x{f6}\\x{f8}-\\x{24f}][.,;:!?]$"
#: Pieces that can be encoded in one text: a space and letters.
_SPACED = re.compile(" [^\\W\\d_]+")
_JOINED = 100
#: Pieces given to the tokenizer in one call; each is some 500 bytes of its results.
_CALL = 20_000


def pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All pieces of the texts in one array, and how many each text has.

    A byte-level tokenizer with the usual split begins anew at a single space between two characters
    that aren't white space, and makes a single line end between two such a token of its own, so cuts
    before such spaces and around such line ends change no id.  Texts with other white space are cut
    at the safe spaces alone.
    """
    odd = pc.match_substring_regex(texts, _ODD)
    plain = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n\0")
    if pc.any(odd).as_py():
        at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        other = [_SAFE_SPACE.sub("\0 ", t) for t in texts.take(pa.array(at)).to_pylist()]
        plain = pc.replace_with_mask(plain, odd, pa.array(other, texts.type))
    parts = pc.split_pattern(plain, "\0")
    return parts.flatten(), parts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def joined(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ranges of ``pool`` one behind the other."""
    ends = np.cumsum(size)
    return pool[np.repeat(start - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)]


class Encoder:
    """Ids of whole texts as uint32 arrays; remembers pieces, at most two generations of ``memo`` (``MEMO_PIECES``).

    Texts are cut into pieces only for a tokenizer whose own split is known to have bounds there
    (byte-level, no normalizer, no added token in the text); any other encodes them whole.
    """

    def __init__(self, path: str, memo: int | None = None) -> None:
        import os

        self.memo = memo

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Texts with one of these are encoded whole; the last is what cuts are marked with.
        self.apart = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content] + ["\0"]
        self.n_ids = self.tokenizer.get_vocab_size(with_added_tokens=True)
        told = json.loads(self.tokenizer.to_str())
        split, model = told.get("pre_tokenizer") or {}, told["model"]
        self.cuts = (
            not told.get("normalizer") and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
            and model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
        )
        self.spaced = np.zeros(self.n_ids, bool)
        for token, at in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.spaced[at] = token.startswith("\u0120")  # how a byte-level vocabulary writes a space
        self._renew()
        self.before = ({}, *self._ranges)
        if self.cuts:
            self._learn(_MARKS)

    def _renew(self) -> None:
        self.known: dict[str, int] = {}  # place among the ranges
        self._ranges = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32))  # start, size, ids

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, new: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        start, size, pool = self._ranges
        starts = len(pool) + np.cumsum(sizes) - sizes
        self._ranges = tuple(map(np.concatenate, ((start, starts), (size, sizes), (pool, ids))))

    def _learn(self, new: list[str]) -> None:
        """Remembers ``new``, which the memory lacks: from the generation before, or encoded."""
        before, start, size, pool = self.before
        old = [p for p in new if p in before]
        if old:
            at = np.fromiter(map(before.__getitem__, old), np.int64, len(old))
            self._add(old, size[at], joined(pool, start[at], size[at]))
        fresh = [p for p in new if p not in before]
        spaced = [p for p in fresh if p[:1] == " " and _SPACED.fullmatch(p)]
        for k in range(0, len(spaced), _CALL):
            self._add_spaced(spaced[k : k + _CALL])
        rest = [p for p in fresh if p not in self.known]
        for k in range(0, len(rest), _CALL):
            some = rest[k : k + _CALL]
            got = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            self._add(some, np.array(list(map(len, got)), np.int64), np.array(list(chain.from_iterable(got)), np.uint32))

    def _add_spaced(self, some: list[str]) -> None:
        """Encodes pieces of a space and letters in one text after another of many: each piece's ids begin at an id with a space."""
        texts = ["".join(some[k : k + _JOINED]) for k in range(0, len(some), _JOINED)]
        ids = np.concatenate([np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts])
        begin = np.flatnonzero(self.spaced[ids])
        if len(begin) != len(some):
            raise ValueError("the tokenizer doesn't split at spaces")
        self._add(some, np.diff(np.append(begin, len(ids))), ids)

    def _cut(self, texts: pa.Array) -> list[np.ndarray]:
        if len(self.known) > (self.memo or MEMO_PIECES):
            self.before = (self.known, *self._ranges)
            self._renew()
            self._learn(_MARKS)
        every, counts = pieces(texts)
        codes = every.dictionary_encode()
        distinct = codes.dictionary
        marked = pc.match_substring_regex(distinct, _MARKED)
        stems = pc.if_else(marked, pc.utf8_slice_codeunits(distinct, 0, -1), distinct).dictionary_encode()
        words, known = stems.dictionary.to_numpy(zero_copy_only=False).tolist(), self.known
        found = list(map(known.get, words))
        new = [p for p, at in zip(words, found) if at is None]
        if new:
            self._learn(new)
            found = [known[p] if at is None else at for p, at in zip(words, found)]
        start, size, pool = self._ranges
        place = np.array(found, np.int64)[stems.indices.to_numpy()]
        # a distinct piece is its stem and the mark, if it has one (else no ids of the first mark)
        mark = pc.index_in(pc.utf8_slice_codeunits(distinct, -1), pa.array(_MARKS, distinct.type)).fill_null(0).to_numpy(zero_copy_only=False)
        mark = np.array([known[m] for m in _MARKS])[mark]
        both = np.stack([place, mark], 1).ravel()
        sizes = size[both]
        sizes[1::2] *= marked.to_numpy(zero_copy_only=False)
        pool = joined(pool, start[both], sizes)
        size = sizes[::2] + sizes[1::2]
        start = np.cumsum(size) - size
        at = codes.indices.to_numpy()
        sizes = size[at]
        flat = joined(pool, start[at], sizes)
        cuts = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)]
        return np.split(flat, cuts[:-1])

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        texts = pc.fill_null(texts, "")
        whole = reduce(pc.or_, (pc.match_substring(texts, x) for x in self.apart)) if self.cuts else pa.array([True] * len(texts), pa.bool_())
        if not pc.any(whole).as_py():
            return self._cut(texts) if len(texts) else []
        out: list = [None] * len(texts)
        for mask, encode in ((whole, lambda some: self._whole(some.to_pylist())), (pc.invert(whole), self._cut)):
            at = np.flatnonzero(mask.to_numpy(zero_copy_only=False))
            if len(at):
                for k, ids in zip(at.tolist(), encode(texts.take(pa.array(at)))):
                    out[k] = ids
        return out


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, memo: int | None = None) -> Encoder:
    """One per worker process, vocabulary and memory; workers outlive tasks."""
    if (path, memo) not in _ENCODERS:
        _ENCODERS[path, memo] = Encoder(path, memo)
    return _ENCODERS[path, memo]


def pack_record(doc_ids: list[int | None], ids: list[np.ndarray], n_ids: int) -> bytes:
    lengths = np.array([len(x) for x in ids], "<u8")
    keys = np.array([x or 0 for x in doc_ids], "<i8")
    none = np.packbits([x is None for x in doc_ids])
    flat = np.concatenate(ids)
    head = _RECORD.pack(_MAGIC, len(ids), len(flat), n_ids) + keys.tobytes() + lengths.tobytes() + none.tobytes()
    blocks = [encode_block(flat[k : k + BLOCK_IDS], n_ids) for k in range(0, len(flat), BLOCK_IDS)]
    return b"".join([head, _CRC.pack(zlib.crc32(head)), *blocks])


def unpack_record(data: bytes) -> tuple[list[int | None], list[np.ndarray]]:
    """Doc ids and ids of a record; ValueError if anything in it was changed, cut off or added."""
    view = memoryview(data)
    if len(view) < _RECORD.size:
        raise ValueError("damaged record")
    magic, n_docs, n, n_ids = _RECORD.unpack_from(view)
    at, size = _RECORD.size, _RECORD.size + 16 * n_docs + -(-n_docs // 8)
    if magic != _MAGIC or len(view) < size + _CRC.size or zlib.crc32(view[:size]) != _CRC.unpack_from(view, size)[0]:
        raise ValueError("damaged record")
    keys = np.frombuffer(view[at : at + 8 * n_docs], "<i8")
    lengths = np.frombuffer(view[at + 8 * n_docs : at + 16 * n_docs], "<u8").astype(np.int64)
    none = np.unpackbits(np.frombuffer(view[at + 16 * n_docs : size], np.uint8))[:n_docs]
    if lengths.sum() != n:
        raise ValueError("damaged record")
    at = size + _CRC.size
    flat = np.empty(n, np.int64)
    done = 0
    while done < n:
        ids, used = decode_block(view[at:], n_ids)
        if done + len(ids) > n:
            raise ValueError("damaged record")
        flat[done : done + len(ids)] = ids
        done, at = done + len(ids), at + used
    if at != len(view):
        raise ValueError("damaged record")
    return [None if x else int(k) for k, x in zip(keys, none)], np.split(flat, np.cumsum(lengths)[:-1])


def by_bytes(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of rows whose texts have at most ``most`` bytes together, or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right"))
        to = max(to, at + 1)
        yield at, to - at
        at = to


def encode_documents(docs: DataFrame, *, vocabulary: str | None = None, end_id: int = END_ID, order: tuple[str, ...] = ("doc_id",), memo: int | None = None, batch_rows: int = 5000) -> DataFrame:
    """(part, seq, n_docs, n_tokens, payload): records of ``docs`` (doc_id, text) in ascending order of the columns ``order``."""
    bound_batches(docs.sparkSession, batch_rows)
    path = vocabulary or tokenizer_path()
    rows = docs.select("doc_id", "text", *(c for c in order if c != "doc_id"))
    keys = [F.col(c).asc_nulls_first() for c in order]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys, F.xxhash64("text")).select("doc_id", "text")
    end = np.array([end_id], np.uint32)
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encode, seq = TaskContext.get().partitionId(), encoder(path, memo), 0
        keys: list[int | None] = []
        ids: list[np.ndarray] = []
        held = 0

        def record() -> pa.RecordBatch:
            payload = pack_record(keys, ids, max(encode.n_ids, end_id + 1))
            return pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], "n_docs": [len(keys)], "n_tokens": [held], "payload": [payload]}, schema)

        for batch in batches:
            for k, n in by_bytes(batch.column(1)):
                some = batch.slice(k, n)
                for key, found in zip(some.column(0).to_pylist(), encode(some.column(1))):
                    own = np.concatenate([found, end])
                    if keys and held + len(own) > BLOCK_IDS:
                        yield record()
                        seq += 1
                        keys, ids, held = [], [], 0
                    keys.append(key)
                    ids.append(own)
                    held += len(own)
        if keys:
            yield record()

    return ordered.mapInArrow(run, "part int, seq int, n_docs long, n_tokens long, payload binary")


def decode_documents(records: DataFrame) -> DataFrame:
    """(part, seq, pos, doc_id, ids) of every document of the records."""
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("pos", pa.int32()), ("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, seq, keys, ids in _decoded(batches):
            n = len(keys)
            yield pa.RecordBatch.from_pydict({"part": [part] * n, "seq": [seq] * n, "pos": range(n), "doc_id": keys, "ids": [x.astype(np.int32) for x in ids]}, schema)

    return records.select("part", "seq", "payload").mapInArrow(run, "part int, seq int, pos int, doc_id long, ids array<int>")


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), *unpack_record(batch.column(2)[k].as_py())


def token_index(records: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the decoded records."""
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("inner", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, seq, keys, ids in _decoded(batches):
            n, sizes = len(keys), np.array([len(x) for x in ids], np.int64)
            crcs = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
            yield pa.RecordBatch.from_pydict(
                {"part": [part] * n, "seq": [seq] * n, "inner": np.cumsum(sizes) - sizes, "doc_id": keys, "n_tokens": sizes, "ids_crc32": crcs}, schema
            )

    rows = records.select("part", "seq", "payload").mapInArrow(run, "part int, seq int, inner long, doc_id long, n_tokens long, ids_crc32 long")
    sizes = records.select("part", "seq", "n_tokens")
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row for each written partition, then one for each record within its partition
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", earlier(Window.orderBy("part")).alias("before"))
    inside = sizes.withColumnRenamed("n_tokens", "n").select("part", "seq", earlier(Window.partitionBy("part").orderBy("seq")).alias("ahead"))
    base = inside.join(parts, "part").select("part", "seq", (F.col("before") + F.col("ahead")).alias("base"))
    return rows.join(base, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_index(materialize(encode_documents(table(spark, sf_dir, "documents")), "tokens"))


def in_place(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with (file, row): where each row is in the files it was read from, or else in the partitions."""
    try:
        return docs.select("doc_id", "text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException:  # not read from Parquet files
        return docs.select("doc_id", "text", F.lit("").alias("file"), F.monotonically_increasing_id().alias("row"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the ids of all rows in the order of ``docs`` (the mix's), written, read back and indexed.

    Null texts count as empty, null and repeated ids are kept, an empty table gives none.
    Executors have the memory of four stages before behind them: fewer pieces are remembered than in the query.
    """
    return token_index(materialize(encode_documents(in_place(docs), order=("file", "row"), memo=150_000, batch_rows=1500), "tokens"))
