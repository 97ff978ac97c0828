"""Toxicity (operator 7): a bidirectional gated recurrent network in numpy.

Inputs of a word are a hashed word vector plus the mean of its hashed character n-gram vectors (with
marks for its ends), so unseen forms of known stems count.  A forward and a backward GRU read a
window of ``WINDOW`` words; attention pools their states into one logit.  All overlapping windows of
a whole text are scored, ``STRIDE`` words apart, and the text's score is its highest window's.

Training is on at most ``PER_CLASS`` documents of each class outside the held-out fold (a documented
bound), by Adam on the highest of all windows of each document; fixed seeds, on the driver.  Only words and
n-grams whose document counts differ between the classes beyond chance have vectors that aren't zero
(the first component begins as that difference), so the network can't learn rare words by heart.

Defined results: null, empty and word-free texts get the score of a window without words; repeated
rows are scored row by row; without labels of both classes every score is the share of label 1
(0 if there are no labels); all windows of a text of any length are scored; an empty table gives none;
other columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import table
from palimpsest.llm.labelled import held_out, sample_labelled

WINDOW, STRIDE = 32, 16
PER_CLASS, EPOCHS = 800, 6
#: Windows read at a time.
GROUP = 2048
DIM, HIDDEN = 12, 8
#: Standard errors by which the document counts of a word and of an n-gram must differ between classes.
WORD_Z, CHAR_Z = 3.0, 2.0
WORD_SLOTS, CHAR_SLOTS, GRAMS = 1 << 13, 1 << 14, (3, 4, 5)
MEMO_WORDS = 250_000

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word slot of each word; n-gram slots of all words in a row; where each word's begin.

    The n-grams are all runs of GRAMS characters of ``^word$``, hashed without a loop over words.
    """
    text = "".join(f"^{w}$" for w in words)
    code = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    size = np.array([len(w) + 2 for w in words], np.int64)
    first = np.cumsum(size) - size
    word = np.repeat(np.arange(len(words)), size)
    mixed = (code + np.uint64(7)) * np.uint64(0x9E3779B97F4A7C15)
    place = np.arange(len(code)) - first[word]
    whole = np.add.reduceat((mixed ^ (mixed >> np.uint64(29))) * (place.astype(np.uint64) * np.uint64(2) + np.uint64(0xD6E8FEB86659FD93)), first) if len(words) else np.empty(0, np.uint64)
    slots, owners = [], []
    for k in GRAMS:
        n = len(code) - k + 1
        if n <= 0:
            continue
        h = mixed[:n].copy()
        for j in range(1, k):
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + mixed[j : n + j]
        ok = np.flatnonzero(word[:n] == word[k - 1 :])
        slots.append(((h[ok] ^ (h[ok] >> np.uint64(33))) * np.uint64(0x94D049BB133111EB) >> np.uint64(32)).astype(np.int64) % CHAR_SLOTS)
        owners.append(word[ok])
    owner = np.concatenate(owners) if owners else np.empty(0, np.int64)
    order = np.argsort(owner, kind="stable")
    grams = np.concatenate(slots)[order] if slots else owner
    begin = np.searchsorted(owner[order], np.arange(len(words)))
    return ((whole ^ (whole >> np.uint64(31))) >> np.uint64(20)).astype(np.int64) % WORD_SLOTS, grams, begin


def windows_of(n: int) -> list[int]:
    """Where the overlapping windows of ``n`` words begin; one even if there are no words."""
    return list(range(0, max(n - (WINDOW - STRIDE), 1), STRIDE))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def contrast(docs: list[np.ndarray], y: np.ndarray, size: int) -> np.ndarray:
    """How far the share of label-1 documents differs for each slot, in standard errors less a half count; 0 if it is in under 3."""
    counts = np.zeros((2, size))
    for slots, label in zip(docs, y):
        counts[int(label), np.unique(slots)] += 1
    n, (b, a) = len(docs), counts
    ones = float((y == 1).sum())
    df = a + b
    p = df / n
    gap = a - ones * p
    spread = np.sqrt(np.maximum(ones * (n - ones) / n * p * (1 - p), 1e-9))
    return np.where(df >= 3, np.sign(gap) * np.maximum(np.abs(gap) - 0.5, 0) / spread, 0)


class Network:
    def __init__(self, seed: int = 3) -> None:
        r = np.random.default_rng(seed)
        draw = lambda *shape, scale: r.normal(0, scale, shape).astype(np.float32)
        self.p = {"word": draw(WORD_SLOTS, DIM, scale=0.1), "char": draw(CHAR_SLOTS, DIM, scale=0.3)}
        for d in "fb":
            self.p |= {f"w{d}": draw(DIM, 3 * HIDDEN, scale=0.4), f"u{d}": draw(HIDDEN, 3 * HIDDEN, scale=0.3), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"look": draw(2 * HIDDEN, scale=0.5), "out": draw(2 * HIDDEN, scale=0.5), "bias": np.zeros(1, np.float32)}

    def embed(self, slots: np.ndarray, grams: np.ndarray, begin: np.ndarray) -> np.ndarray:
        if not len(slots):
            return np.zeros((0, DIM), np.float32)
        count = np.diff(np.append(begin, len(grams)))
        return self.p["word"][slots] + np.add.reduceat(self.p["char"][grams], begin) / count[:, None]

    def gates(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """What words give to the gates of both directions."""
        return {d: (x @ self.p[f"w{d}"] + self.p[f"c{d}"]).astype(np.float32) for d in "fb"}

    def read(self, table_: np.ndarray, index: np.ndarray, there: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States (T, N, H) of direction ``d``; index and there (words, not padding) are (T, N)."""
        u = self.p[f"u{d}"]
        uzr, un = u[:, : 2 * HIDDEN], u[:, 2 * HIDDEN :]
        t_, n = index.shape
        h, out, full = np.zeros((n, HIDDEN), np.float32), np.empty((t_, n, HIDDEN), np.float32), there.all(axis=1)
        for t in range(t_) if d == "f" else range(t_ - 1, -1, -1):
            x = table_[index[t]]
            zr = _sigmoid(x[:, : 2 * HIDDEN] + h @ uzr)
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            new = np.tanh(x[:, 2 * HIDDEN :] + (r * h) @ un)
            moved = z * (new - h)
            if not full[t]:
                moved *= there[t][:, None]
            if keep is not None:
                keep.append((t, h, z, r, new))
            h = h + moved
            out[t] = h
        return out

    def pool(self, states: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits, attention (T, N) and pooled states of windows; a window without words pools to zero."""
        look = states @ self.p["look"]
        look = np.where(there, look, -1e9)
        a = np.exp(look - look.max(axis=0)) * there
        a /= np.maximum(a.sum(axis=0), 1e-9)
        pooled = np.einsum("tn,tnh->nh", a, states)
        return pooled @ self.p["out"] + self.p["bias"][0], a, pooled

    def logits(self, tables: dict[str, np.ndarray], index: np.ndarray, there: np.ndarray) -> np.ndarray:
        states = np.concatenate([self.read(tables[d], index, there, d) for d in "fb"], axis=2)
        return self.pool(states, there)[0]

    def highest(self, docs: list[list[str]], group: int = GROUP) -> list[int]:
        """Where the highest of all windows of each text begins; ``group`` windows are read at a time."""
        top, best = np.full(len(docs), -np.inf), [0] * len(docs)
        every = ((j, at) for j, words in enumerate(docs) for at in windows_of(len(words)))
        while some := list(islice(every, group)):
            vocabulary: dict[str, int] = {}
            index = np.zeros((WINDOW, len(some)), np.int64)
            there = np.zeros((WINDOW, len(some)), bool)
            for n, (j, at) in enumerate(some):
                span = docs[j][at : at + WINDOW]
                index[: len(span), n] = [vocabulary.setdefault(w, len(vocabulary)) for w in span]
                there[: len(span), n] = True
            if not vocabulary:
                continue
            logit = self.logits(self.gates(self.embed(*word_features(list(vocabulary)))), index, there)
            for (j, at), value in zip(some, logit.tolist()):
                if value > top[j]:
                    top[j], best[j] = value, at
        return best

    def gradient(self, slots, grams, begin, index: np.ndarray, there: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
        """Gradients of the weighted cross-entropy of windows, by back-propagation through time."""
        x = self.embed(slots, grams, begin)
        tables, kept = self.gates(x), {"f": [], "b": []}
        states = np.concatenate([self.read(tables[d], index, there, d, kept[d]) for d in "fb"], axis=2)
        logit, a, pooled = self.pool(states, there)
        g = ((_sigmoid(logit) - y) * weight / len(y)).astype(np.float32)
        grad = {"bias": np.array([g.sum()], np.float32), "out": pooled.T @ g}
        d_pooled = g[:, None] * self.p["out"]
        d_states = a[:, :, None] * d_pooled
        score = np.einsum("tnh,nh->tn", states, d_pooled)
        d_look = a * (score - (a * score).sum(axis=0))
        d_states += d_look[:, :, None] * self.p["look"]
        grad["look"] = np.einsum("tn,tnh->h", d_look, states)
        dx = np.zeros_like(x)
        for k, d in enumerate("fb"):
            u, w = self.p[f"u{d}"], self.p[f"w{d}"]
            own = d_states[:, :, k * HIDDEN : (k + 1) * HIDDEN]
            du, d_table = np.zeros_like(u), np.zeros_like(tables[d])
            dh = np.zeros(own.shape[1:], np.float32)
            for t, h, z, r, new in reversed(kept[d]):
                dh = dh + own[t]
                move = dh * there[t][:, None]
                dz, dnew = move * (new - h) * z * (1 - z), move * z * (1 - new * new)
                drh = dnew @ u[:, 2 * HIDDEN :].T
                dr = drh * h * r * (1 - r)
                du[:, 2 * HIDDEN :] += (r * h).T @ dnew
                gates = np.concatenate([dz, dr], axis=1)
                du[:, : 2 * HIDDEN] += h.T @ gates
                dh = dh - move * z + drh * r + gates @ u[:, : 2 * HIDDEN].T
                np.add.at(d_table, index[t], np.concatenate([gates, dnew], axis=1))
            grad |= {f"u{d}": du, f"w{d}": x.T @ d_table, f"c{d}": d_table.sum(axis=0)}
            dx += d_table @ w.T
        word = np.zeros_like(self.p["word"])
        np.add.at(word, slots, dx)
        count = np.diff(np.append(begin, len(grams)))
        char = np.zeros_like(self.p["char"])
        np.add.at(char, grams, np.repeat(dx / count[:, None], count, axis=0))
        return grad | {"word": word, "char": char}

    def train(self, texts: list[str | None], labels: list[int], epochs: int = EPOCHS, batch: int = 24, rate: float = 0.012, seed: int = 11) -> None:
        r = np.random.default_rng(seed)
        none = len(texts) // 50 + 1  # texts without words count as label 0
        docs = [words_of(t) for t in texts] + [[]] * none
        y = np.array([*labels, *[0] * none], np.float32)
        weights = np.where(y == 1, 1.0, 1.5).astype(np.float32)  # the sample holds more of label 1 than the corpus
        own_slots = [word_features(sorted(set(d)))[:2] for d in docs]
        told = {}
        for k, (name, least) in enumerate((("word", WORD_Z), ("char", CHAR_Z))):
            z = contrast([x[k] for x in own_slots], y, len(self.p[name]))
            told[name] = (np.abs(z) >= least)[:, None]
            self.p[name] *= told[name]
            self.p[name][:, 0] += np.clip(z / 8, -1, 1) * told[name][:, 0]
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        step = 0
        for epoch in range(epochs):
            order, now = r.permutation(len(docs)), rate * (1 - epoch / (epochs + 1))
            for k in range(0, len(order), batch):
                own = order[k : k + batch]
                best = self.highest([docs[i] for i in own])
                spans = [docs[i][at : at + WINDOW] for i, at in zip(own, best)]
                vocabulary: dict[str, int] = {}
                index = np.zeros((WINDOW, len(spans)), np.int64)
                there = np.zeros((WINDOW, len(spans)), bool)
                for j, s in enumerate(spans):
                    index[: len(s), j] = [vocabulary.setdefault(w, len(vocabulary)) for w in s]
                    there[: len(s), j] = True
                if not vocabulary:
                    continue
                features = word_features(list(vocabulary))
                grad = self.gradient(*features, index, there, y[own], weights[own])
                step += 1
                for name, g in grad.items():
                    g = g * told[name] if name in told else g
                    m, v = moments[name]
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    self.p[name] -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)


class Scorer:
    """Scores texts; remembers the gate inputs of words it has seen."""

    def __init__(self, net: Network) -> None:
        self.net = net
        self._forget()

    def _forget(self) -> None:
        self.row: dict[str, int] = {}
        self.tables = {d: np.zeros((1 << 12, 3 * HIDDEN), np.float32) for d in "fb"}

    def _learn(self, new: list[str]) -> None:
        gates = self.net.gates(self.net.embed(*word_features(new)))
        first, end = len(self.row), len(self.row) + len(new)
        for d in "fb":
            while len(self.tables[d]) < end:
                self.tables[d] = np.concatenate([self.tables[d], np.zeros_like(self.tables[d])])
            self.tables[d][first:end] = gates[d]
        self.row.update(zip(new, range(first, end)))

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """The highest window probability of each text."""
        out = np.full(len(texts), -np.inf)
        spans: list[np.ndarray] = []
        owner: list[int] = []

        def flush() -> None:
            index = np.zeros((WINDOW, len(spans)), np.int64)
            there = np.zeros((WINDOW, len(spans)), bool)
            for j, s in enumerate(spans):
                index[: len(s), j], there[: len(s), j] = s, True
            np.maximum.at(out, owner, self.net.logits(self.tables, index, there))
            spans.clear()
            owner.clear()

        for k in range(0, len(texts), 128):
            group = [words_of(t) for t in texts[k : k + 128]]
            new = set().union(*group).difference(self.row)
            if new and len(self.row) + len(new) > MEMO_WORDS and self.row:
                if spans:
                    flush()
                self._forget()
                new = set().union(*group)
            if new:
                self._learn(list(new))
            get = self.row.__getitem__
            for i, words in enumerate(group, k):
                ids = np.fromiter(map(get, words), np.int64, len(words))
                for s in windows_of(len(words)):
                    spans.append(ids[s : s + WINDOW])
                    owner.append(i)
                if len(spans) >= GROUP:
                    flush()
        if spans:
            flush()
        return _sigmoid(out)


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[Network | None, float]:
    """The trained network (None without both classes) and the share of label 1 in the sample."""
    rows = sample_labelled(docs, labels, "toxic", per_class, ["doc_id", "text"])
    share = sum(r.label for r in rows) / len(rows) if rows else 0.0
    if share in (0.0, 1.0):
        return None, share
    net = Network()
    net.train([r.text for r in rows], [r.label for r in rows])
    return net, share


def score_toxicity(docs: DataFrame, net: Network | None, share: float = 0.0) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text)."""
    if net is None:
        out = docs.select("doc_id", F.lit(float(share)).alias("score"))
    else:
        sent = docs.sparkSession.sparkContext.broadcast(net)  # fixed size, about 1 MB

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = Scorer(sent.value)
            for batch in batches:
                for k in range(0, batch.num_rows, 2000):
                    some = batch.slice(k, 2000)
                    yield pa.RecordBatch.from_arrays([some.column(0), pa.array(scorer(some.column(1).to_pylist()), pa.float64())], ["doc_id", "score"])

        out = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_toxicity(docs, *fit_toxicity(docs, table(spark, sf_dir, "labels")))
