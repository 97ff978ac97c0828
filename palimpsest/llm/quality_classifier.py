"""Quality classifier (operator 10): co-training of a text view and a metadata view.

The text view reads words: the presence of hashed words, and of twelve statistics of the whole text
cut into steps, gives log-odds (naive Bayes), and a logistic regression weighs those and the
statistics.  The metadata view is a logistic regression of lang, source and the size's step.  For
``ROUNDS`` rounds both are fitted, each names the unlabelled documents it is surest of, and those go
with its labels into the other's counts.  Labelled rows kept back from all rounds then calibrate both
views and fit the weights that combine them; every document is scored by the combination.

The fit uses at most ``PER_CLASS`` labelled documents of each class outside the held-out fold (a
documented bound, chosen by hash) and, without labels, every other one outside the fold: one pass writes the
features of all documents to the shared folder, and each round scores all of them there and counts
what it names.  Only counts come to the driver: by step of the margin, by word slot and label, or by
metadata cell and label, all of fixed number.  Whole texts are read.

Defined results: null text counts as empty, null lang and source as values of their own, null
n_chars as 0; repeated rows are scored row by row; without labels of both classes every score is
the share of label 1 (1 if there are no labels, so nothing is rejected); texts of any length are read whole; an empty table
gives none; columns but those named are never read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import materialize, sliced, table
from palimpsest.llm.labelled import held_out, sample_labelled

PER_CLASS, ROUNDS = 800, 6
#: Unlabelled documents that a view names in a round: this share of them all, or so many if that is more.
SHARE, PER_ROUND = 0.02, 60
#: A view is sure beyond this margin; margins are counted in steps of 1 / STEPS.
SURE, STEPS = 2.0, 100
#: Rows whose features are spread out at a time.
BLOCK = 20_000
META_SLOTS = 64
#: Hashed words; then the steps of the statistics.
WORD_SLOTS, BINS = 1 << 14, 8

_WORD = re.compile(r"[^ \t-\r]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")
_RUN = re.compile(r"[!?]{2,}")
TEXT_FEATURES = 12


def text_features(text: str | None) -> list[float]:
    """Statistics of a whole text, each roughly within 0 and 1."""
    text = text or ""
    words = _WORD.findall(text)
    n = len(words)
    if not n:
        return [0.0] * TEXT_FEATURES
    lines = [x for x in text.split("\n") if x.strip()]
    chars = sum(map(len, words))
    different = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    return [
        min(np.log1p(n) / 10, 1.5),
        min(n / 50, 1.0),
        chars / n / 10,
        len(_SYMBOL.findall(text)) / chars,
        len(_RUN.findall(text)) / n,
        sum(c.isupper() for c in text) / chars,
        sum(c.isdigit() for c in text) / chars,
        len(different) / n,
        pairs / max(n - 1, 1),
        different.most_common(1)[0][1] / n,
        len(set(lines)) / max(len(lines), 1),
        sum(x.rstrip()[-1] in ".!?:;…" for x in lines) / max(len(lines), 1),
    ]


def word_slots(text: str | None, stats: list[float]) -> np.ndarray:
    """The distinct slots of a text's lower-cased words, and those of its statistics, in order."""
    words = {w.strip(".,;:!?()\"'") for w in (text or "").lower().split()}
    own = {xxhash.xxh32_intdigest(w) % WORD_SLOTS for w in words}
    return np.array(sorted(own) + [WORD_SLOTS + BINS * k + min(int(v * BINS), BINS - 1) for k, v in enumerate(stats)], np.int32)


N_SLOTS = WORD_SLOTS + BINS * TEXT_FEATURES


def meta_values(lang: str | None, source: str | None, n_chars: int | None) -> list[int]:
    """The cell of a document's metadata: slots of lang and source, and the step of its size."""
    size = round(4 * math.log1p(max(n_chars or 0, 0)))
    return [*(zlib.crc32(f"{field}={value}".encode()) % META_SLOTS for field, value in (("lang", lang), ("source", source))), size]


def spread(values: np.ndarray) -> np.ndarray:
    """The metadata view's features of rows of ``meta_values``."""
    x = np.zeros((len(values), META_SLOTS + 4))
    for k in (0, 1):
        np.add.at(x, (np.arange(len(values)), values[:, k].astype(np.int64)), 1)
    size = values[:, 2] / 4
    x[:, META_SLOTS:] = np.column_stack([size / 10, (size / 10) ** 2, size < 6, size == 0])
    return x


@dataclass
class Rows:
    """Features of some rows: statistics, word slots one behind the other with each row's count, metadata cells."""

    x: np.ndarray
    slots: np.ndarray
    sizes: np.ndarray
    m: np.ndarray

    def __len__(self) -> int:
        return len(self.x)

    def some(self, where: np.ndarray) -> Rows:
        return Rows(self.x[where], self.slots[np.repeat(where, self.sizes)], self.sizes[where], self.m[where])

    def means(self, odds: np.ndarray) -> np.ndarray:
        """The mean log-odds of each row's words and of its statistics' steps."""
        owner = np.repeat(np.arange(len(self)), self.sizes)
        own, word = odds[self.slots], self.slots < WORD_SLOTS
        out = np.zeros((len(self), 2))
        for k, kind in enumerate((word, ~word)):
            n = np.bincount(owner[kind], minlength=len(self))
            out[:, k] = np.bincount(owner[kind], own[kind], minlength=len(self)) / np.maximum(n, 1)
        return out


def unpacked(batch: pa.RecordBatch) -> tuple[Rows, np.ndarray]:
    x, m = (batch.column(c).flatten().to_numpy().reshape(-1, k) for c, k in (("x", TEXT_FEATURES), ("m", 3)))
    w = batch.column("w")
    return Rows(x, w.flatten().to_numpy(), w.value_lengths().to_numpy().astype(np.int64), m), batch.column("h").to_numpy()


def log_odds(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Of label 1 against 0 for a present slot; counts (2, slots) and totals (2) are weights of documents."""
    share = (counts + 0.5) / (totals[:, None] + 1)
    return np.log(share[1]) - np.log(share[0])


def as_is(values: np.ndarray) -> np.ndarray:
    return values


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-2, steps: int = 30, features=as_is) -> np.ndarray:
    """Weights (the last is the intercept's) by Newton steps over blocks of rows."""
    weight = np.ones(len(x)) if weight is None else weight
    size = features(x[:1]).shape[1] + 1
    w = np.zeros(size)
    penalty = np.full(size, ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        gradient, curve = penalty * w, np.diag(penalty)
        for k in range(0, len(x), BLOCK):
            part = features(x[k : k + BLOCK])
            z, own = np.column_stack([part, np.ones(len(part))]), weight[k : k + BLOCK]
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            gradient = gradient + z.T @ (own * (p - y[k : k + BLOCK]))
            curve = curve + (z * (own * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def margin(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


@dataclass
class TextView:
    odds: np.ndarray
    weights: np.ndarray

    def margins(self, rows: Rows) -> np.ndarray:
        return margin(np.column_stack([rows.means(self.odds), rows.x]), self.weights)

    @staticmethod
    def fit(rows: Rows, y: np.ndarray, named_counts: np.ndarray, named_totals: np.ndarray) -> TextView:
        """``named_counts`` (2, slots) and ``named_totals`` (2) are what rows named by the other view add."""
        label = y.astype(int)
        own = np.zeros((2, N_SLOTS))
        np.add.at(own, (np.repeat(label, rows.sizes), rows.slots), 1)
        counts, totals = own + named_counts, np.bincount(label, minlength=2) + named_totals
        # a labelled row is weighed by the log-odds of all others
        begin = np.concatenate([[0], np.cumsum(rows.sizes)])
        means = np.empty((len(y), 2))
        for i in range(len(y)):
            part = rows.slots[begin[i] : begin[i + 1]]
            k, less = label[i], totals.copy()
            less[k] -= 1
            c = counts[:, part].copy()
            c[k] -= 1
            odds, word = log_odds(c, less), part < WORD_SLOTS
            means[i] = odds[word].sum() / max(word.sum(), 1), odds[~word].mean()
        return TextView(log_odds(counts, totals), fit_logistic(np.column_stack([means, rows.x]), y))


@dataclass
class MetaView:
    weights: np.ndarray

    def margins(self, rows: Rows) -> np.ndarray:
        return margin(spread(rows.m), self.weights)


@dataclass
class CoTrained:
    text: TextView
    meta: MetaView
    text_scale: np.ndarray  # calibration: slope and intercept
    meta_scale: np.ndarray
    both: np.ndarray

    def scores(self, rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of the text view, of the metadata view and of both."""
        t, m = (margin(view.margins(rows)[:, None], scale) for view, scale in ((self.text, self.text_scale), (self.meta, self.meta_scale)))
        b = margin(np.column_stack([t, m]), self.both)
        return tuple(1 / (1 + np.exp(-v)) for v in (t, m, b))


@dataclass
class Rule:
    """What a view names in a round: rows beyond the cuts, and of those in the cuts' own step a part by hash."""

    kind: str  # of the view: t or m
    view: TextView | MetaView
    up: tuple[int, float]
    down: tuple[int, float]


def _steps(rows: Rows, view: TextView | MetaView) -> tuple[np.ndarray, np.ndarray]:
    s = view.margins(rows)
    return s, np.floor(np.abs(s) * STEPS).astype(np.int64) * np.sign(s).astype(np.int64)


def drawn(h: np.ndarray, k: int) -> np.ndarray:
    """A number from 0 to 1 for each hash, independent for each ``k``."""
    z = h.view(np.uint64) + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z >> np.uint64(44)) / float(1 << 20)


def named(rules: list[Rule], rows: Rows, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``rules`` names each row first (-1: none), and the label it gives."""
    by, label = np.full(len(h), -1), np.zeros(len(h), np.int64)
    for k, rule in enumerate(rules):
        u = drawn(h, k)
        s, step = _steps(rows, rule.view)
        up = (s > SURE) & ((step > rule.up[0]) | ((step == rule.up[0]) & (u < rule.up[1])))
        down = (s < -SURE) & ((step < rule.down[0]) | ((step == rule.down[0]) & (u < rule.down[1])))
        own = (by < 0) & (up | down)
        by[own], label[own] = k, up[own]
    return by, label


def cut(counts: dict[int, int], most: int) -> tuple[int, float]:
    """(step, part): the steps beyond it and that part of its own rows hold ``most`` rows, surest first."""
    for step in sorted(counts, key=abs, reverse=True):
        if counts[step] >= most:
            return step, most / counts[step]
        most -= counts[step]
    return 0, 0.0


class Pool:
    """All rows whose labels aren't read (x, m, w, h), scored in Spark; the driver gets counts of a fixed number of kinds."""

    def __init__(self, rows: DataFrame) -> None:
        self.rows, self.size = rows, rows.count()

    def _counts(self, of_batch, keys: str) -> list:
        """Sums of n by ``keys`` (DDL names of long columns) over ``of_batch``'s (keys..., n) arrays of each batch."""
        names = keys.split()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in of_batch(*unpacked(batch))], [*names, "n"])

        each = self.rows.mapInArrow(run, ", ".join(f"{k} long" for k in [*names, "n"]))
        return each.groupBy(*names).agg(F.sum("n").alias("n")).collect()

    def counts(self, rules: list[Rule], view: TextView | MetaView) -> dict[int, int]:
        """How many rows that no rule has named lie in each step that the view is sure of."""

        def of_batch(rows: Rows, h: np.ndarray):
            s, step = _steps(rows, view)
            return np.unique(step[(named(rules, rows, h)[0] < 0) & (np.abs(s) > SURE)], return_counts=True)

        return {r.step: r.n for r in self._counts(of_batch, "step")}

    def take(self, rules: list[Rule]) -> tuple[np.ndarray, np.ndarray, int]:
        """What the last rule names, for the other view: (keys, counts) by cell and label, or by slot and label with a total as slot -1."""
        cells = rules[-1].kind == "t"

        def of_batch(rows: Rows, h: np.ndarray):
            by, label = named(rules, rows, h)
            own = by == len(rules) - 1
            some, label = rows.some(own), label[own]
            if cells:
                keys = np.column_stack([some.m, label]).astype(np.int64)
            else:
                slot = np.concatenate([some.slots, np.full(len(some), -1)])
                keys = np.column_stack([slot, np.concatenate([np.repeat(label, some.sizes), label])]).astype(np.int64)
            kinds, n = np.unique(keys, axis=0, return_counts=True)
            return [*kinds.T, n]

        names = "lang source size label" if cells else "slot label"
        got = sorted(self._counts(of_batch, names))
        keys = np.array([list(r)[:-1] for r in got], np.int64).reshape(-1, len(names.split()))
        n = np.array([r.n for r in got], np.int64)
        return keys, n, int(n.sum() if cells else n[keys[:, 0] == -1].sum())


def co_train(row: Rows, y: np.ndarray, pool: Pool, rounds: int = ROUNDS, share: float = SHARE, per_round: int = PER_ROUND) -> CoTrained:
    """``y`` labels ``row``; every fourth row is kept back for calibration."""
    back = np.arange(len(y)) % 4 == 3
    if len(np.unique(y[back])) < 2 or len(np.unique(y[~back])) < 2:
        back[:] = False
    calibrate = back if back.any() else ~back
    own, label = row.some(~back), y[~back]
    ones = label.mean()
    most = max(per_round, round(share * pool.size))
    heavy = 0.5 * per_round / most  # all named rows together weigh no more than they would if each round named per_round
    slots, totals = np.zeros((2, N_SLOTS)), np.zeros(2)
    cells, cell_labels, cell_weights = [own.m], [label], [np.ones(len(label))]
    rules: list[Rule] = []

    def fit() -> dict[str, TextView | MetaView]:
        meta = fit_logistic(np.concatenate(cells), np.concatenate(cell_labels), np.concatenate(cell_weights), features=spread)
        return {"t": TextView.fit(own, label, slots, totals), "m": MetaView(meta)}

    for _ in range(rounds if pool.size else 0):
        views = fit()
        for kind in ("t", "m"):
            counts = pool.counts(rules, views[kind])
            if not counts:
                continue
            up, down = ({x: n for x, n in counts.items() if (x > 0) == side} for side in (True, False))
            rules.append(Rule(kind, views[kind], cut(up, round(most * ones)), cut(down, round(most * (1 - ones)))))
            keys, n, _ = pool.take(rules)
            if kind == "t":
                cells.append(keys[:, :3])
                cell_labels.append(keys[:, 3].astype(float))
                cell_weights.append(heavy * n)
            else:
                whole = keys[:, 0] == -1
                np.add.at(slots, (keys[~whole, 1], keys[~whole, 0]), heavy * n[~whole])
                np.add.at(totals, keys[whole, 1], heavy * n[whole])
    views = fit()
    c = {k: view.margins(row.some(calibrate)) for k, view in views.items()}
    scale = {k: fit_logistic(c[k][:, None], y[calibrate], ridge=0.1) for k in views}
    both = fit_logistic(np.column_stack([margin(c[k][:, None], scale[k]) for k in views]), y[calibrate], ridge=0.1)
    return CoTrained(views["t"], views["m"], scale["t"], scale["m"], both)


def features_of(docs: DataFrame) -> DataFrame:
    """(doc_id, x, m, w, h) for every row of ``docs``: statistics, metadata cell, word slots of whole texts, and a hash of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            ids, text, lang, source, size = batch.columns
            texts = text.to_pylist()
            x = [text_features(t) for t in texts]
            w = [word_slots(t, v) for t, v in zip(texts, x)]
            m = [meta_values(*v) for v in zip(lang.to_pylist(), source.to_pylist(), size.to_pylist())]
            lists = [pa.array(x, pa.list_(pa.float64())), pa.array(m, pa.list_(pa.int32())), pa.array(w, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([ids, *lists], ["doc_id", "x", "m", "w"])

    rows = docs.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long"))
    return rows.mapInArrow(run, "doc_id long, x array<double>, m array<int>, w array<int>").withColumn("h", F.xxhash64("doc_id", "x", "m", "w"))


def fit_features(features: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[CoTrained | None, float]:
    """The model (None without both classes) from written ``features``, and the share of label 1 in the sample."""
    rows = sample_labelled(features, labels, "quality", per_class, ["doc_id", "x", "m", "w"])
    share = sum(r.label for r in rows) / len(rows) if rows else 1.0
    if share in (0.0, 1.0):
        return None, share
    rows = sorted(rows, key=lambda r: zlib.crc32(f"order {r.doc_id}".encode()))
    spark = features.sparkSession
    sample = spark.createDataFrame([(r.doc_id,) for r in rows], "doc_id long")
    # every document that gives no label, read where its features lie; the sample is of 2 * per_class ids at most
    pool = Pool(features.where(~held_out()).join(F.broadcast(sample), "doc_id", "left_anti").select("x", "m", "w", "h"))
    sizes = np.array([len(r.w) for r in rows], np.int64)
    known = Rows(np.array([r.x for r in rows]), np.array([s for r in rows for s in r.w], np.int32), sizes, np.array([r.m for r in rows]))
    return co_train(known, np.array([r.label for r in rows], float), pool), share


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[CoTrained | None, float]:
    return fit_features(materialize(features_of(docs), "features"), labels, per_class)


def score_features(features: DataFrame, model: CoTrained | None, share: float = 1.0) -> DataFrame:
    """(doc_id, held_out, p_text, p_meta, score, keep) for every row of ``features``."""
    if model is None:
        p = F.lit(float(share))
        out = features.select("doc_id", p.alias("p_text"), p.alias("p_meta"), p.alias("score"))
    else:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, _ = unpacked(batch)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, pa.float64()) for v in model.scores(rows))], ["doc_id", "p_text", "p_meta", "score"])

        out = features.mapInArrow(run, "doc_id long, p_text double, p_meta double, score double")
    return out.select("doc_id", held_out().alias("held_out"), "p_text", "p_meta", "score", (F.col("score") >= 0.5).alias("keep"))


def score_quality(docs: DataFrame, model: CoTrained | None, share: float = 1.0) -> DataFrame:
    """The same for every row of ``docs``."""
    return score_features(features_of(docs), model, share)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = materialize(features_of(table(spark, sf_dir, "documents")), "features")
    return score_features(features, *fit_features(features, table(spark, sf_dir, "labels")))
