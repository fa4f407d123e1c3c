"""Convolutional classifier for toxic documents.

A word's vector is the sum of hashed vectors: of the word under two independent hashes (a rare
word that meets a toxic one in one table does not in the other) and of its first 4 and 6 bytes,
which words of one family share.  Filters over one, two and three
words, the maximum of each over the text, and a logistic output, trained in numpy on a bounded
sample of labelled rows.  The output is calibrated for each language, which is told from the
text by its function words.

A filter over k words is a sum of k products, one for each word and place; the executors look
these products up by bucket and add them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base, bytewords
from tidemark.llm.labelled import Sample, drawn

_U = np.uint64
BITS = 15
BUCKETS = 1 << BITS
WIDTHS = (1, 2, 3)
PLACES = sum(WIDTHS)
#: Bytes at the beginning of a word that have vectors of their own.
BEGINNINGS = (4, 6)
TABLES = 2 + len(BEGINNINGS)
#: Words looked at together.
CHUNK = 1 << 16

_WORDS = np.array([c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)], np.uint8)

#: Frequent function words that tell a language.
FUNCTION_WORDS = {
    "en": "the of and to in is that it for was with as on be by are this from at",
    "de": "der die und das den von zu mit ist im des auf ein eine nicht dem als für sich",
    "fr": "le la les de des et du un une que qui dans pour pas sur par est au avec",
    "es": "el los las que en y un una por con para del se no su lo al es como",
}


@dataclass(frozen=True)
class Training:
    sample: Sample = Sample(per_class=2000, max_bytes=12_000)
    size: int = 16
    filters: int = 8
    epochs: int = 8
    rate: float = 0.08
    seed: int = 11
    #: Every so manieth document of the sample is left for calibration.
    calibration: int = 5
    #: A language with fewer calibration documents of a label uses the common calibration.
    least: int = 8


@dataclass(frozen=True)
class Model:
    tables: tuple[np.ndarray, ...]
    offsets: np.ndarray
    out: np.ndarray
    bias: float
    #: Language (None for all others) to slope and shift of the logit.
    calibration: dict = field(default_factory=dict)
    empty: float = 0.0


def _function_words() -> tuple[np.ndarray, np.ndarray, list[str]]:
    langs = list(FUNCTION_WORDS)
    rows = [(bytewords.word_hashes(np.frombuffer(w.encode(), np.uint8))[0], k) for k, lang in enumerate(langs) for w in FUNCTION_WORDS[lang].split()]
    rows.sort()
    return np.array([h for h, _ in rows], _U), np.array([k for _, k in rows]), langs


_FUNCTION = _function_words()


def words_of(buf: np.ndarray) -> np.ndarray:
    """Hashes of each word and of its beginnings, one row for each of BEGINNINGS after the word's own."""
    return bytewords.word_hashes(_WORDS[buf], beginnings=BEGINNINGS)


def language(words: np.ndarray) -> str | None:
    """The language with most function words among the word hashes; None without any."""
    keys, owner, langs = _FUNCTION
    if not len(words):
        return None
    left, right = np.searchsorted(keys, words), np.searchsorted(keys, words, side="right")
    votes = np.zeros(len(langs), np.int64)
    for step in range(int((right - left).max(initial=0))):
        at = left + step
        votes += np.bincount(owner[at[at < right]], minlength=len(langs))
    return langs[int(votes.argmax())] if votes.any() else None


def buckets(words: np.ndarray) -> np.ndarray:
    """Bucket of each word in each table, with room for the widest filter; BUCKETS is the empty word."""
    out = np.full((TABLES, max(words.shape[1], WIDTHS[-1])), BUCKETS, np.int64)
    n = words.shape[1]
    out[0, :n] = words[0] >> _U(64 - BITS)
    out[1, :n] = (words[0] >> _U(8)) & _U(BUCKETS - 1)
    out[2:, :n] = words[1:] >> _U(64 - BITS)
    return out


class Network:
    """Vectors, filters (PLACES x size x filters) and the output while they are trained."""

    def __init__(self, training: Training):
        rng = np.random.default_rng(training.seed)
        d, f = training.size, training.filters
        self.rng, self.filters = rng, f
        self.vectors = [np.vstack([rng.normal(0, 0.1, (BUCKETS, d)), np.zeros((1, d))]).astype(np.float32) for _ in range(TABLES)]
        self.kernel = rng.normal(0, 0.5, (PLACES, d, f)).astype(np.float32)
        self.offsets = np.zeros(len(WIDTHS) * f, np.float32)
        self.out = np.where(np.arange(len(WIDTHS) * f) % 4 < 3, 0.3, -0.3).astype(np.float32)
        self.bias = np.float32(-1)
        self.seen = {"v": [np.full((BUCKETS + 1, d), 1e-3, np.float32) for _ in range(TABLES)], "k": np.full(self.kernel.shape, 1e-2, np.float32)}
        self.seen |= {"c": np.full(len(self.offsets), 1e-2, np.float32), "o": np.full(len(self.out), 1e-2, np.float32), "b": np.float32(1e-2)}

    def pooled(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximum and its place for each filter, and the word vectors."""
        x = sum(v[row] for v, row in zip(self.vectors, ids))
        products = x @ self.kernel.transpose(1, 0, 2).reshape(x.shape[1], -1)
        return *_pool(products, self.filters), x

    def step(self, ids: np.ndarray, label: int, rate: float) -> None:
        top, place, x = self.pooled(ids)
        act = top + self.offsets
        on = act > 0
        hidden = np.where(on, act, 0.1 * act)
        p = 1 / (1 + np.exp(-np.clip(self.out @ hidden + self.bias, -30, 30)))
        g = np.float32(p - label)
        back = g * self.out * np.where(on, 1, 0.1).astype(np.float32)
        self.seen["o"] += (g * hidden) ** 2
        self.out -= rate * g * hidden / np.sqrt(self.seen["o"])
        self.seen["b"] += g * g
        self.bias -= rate * g / np.sqrt(self.seen["b"])
        self.seen["c"] += back * back
        self.offsets -= rate * back / np.sqrt(self.seen["c"])
        at, f = 0, self.filters
        for w, width in enumerate(WIDTHS):
            cols = slice(w * f, (w + 1) * f)
            for k in range(width):
                rows = place[cols] + k
                grad_x = back[cols][:, None] * self.kernel[at + k].T
                grad_k = (x[rows] * back[cols][:, None]).T
                self.seen["k"][at + k] += grad_k * grad_k
                self.kernel[at + k] -= rate * grad_k / np.sqrt(self.seen["k"][at + k])
                real = rows[ids[0, rows] < BUCKETS]
                grad = grad_x[ids[0, rows] < BUCKETS]
                for table, seen, row in zip(self.vectors, self.seen["v"], ids):
                    np.add.at(seen, row[real], grad * grad)
                    np.add.at(table, row[real], -rate * grad / np.sqrt(seen[row[real]]))
            at += width

    def logit(self, ids: np.ndarray) -> float:
        act = self.pooled(ids)[0] + self.offsets
        return float(self.out @ np.where(act > 0, act, 0.1 * act) + self.bias)


def _pool(products: np.ndarray, f: int) -> tuple[np.ndarray, np.ndarray]:
    tops, places, at = [], [], 0
    for width in WIDTHS:
        n = len(products) - width + 1
        total = products[:n, at * f : (at + 1) * f]
        for k in range(1, width):
            total = total + products[k : n + k, (at + k) * f : (at + k + 1) * f]
        best = total.argmax(axis=0)
        places.append(best)
        tops.append(total[best, np.arange(f)])
        at += width
    return np.concatenate(tops), np.concatenate(places)


def _platt(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic fit, with the usual smoothed targets."""
    pos, neg = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.column_stack([logits, np.ones_like(logits)])
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (weights * (p - target)) + 1e-2 * (theta - [1.0, 0.0])
        hess = (x * (weights * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-2 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        theta = theta - np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return max(float(theta[0]), 1e-3), float(theta[1])


def learned(docs: DataFrame, labels: DataFrame, column: str = "toxic", training: Training = Training()) -> Model:
    """Model of ``column`` from labelled rows outside fold 0; with less than two labels a constant one.

    Null labels, ids and texts are left out, and so are texts longer than the sample allows.  A row
    that is given several times may be drawn several times; ties of the sample go by the hash of id and
    text, so reruns agree.  Empty tables give the constant model.
    """
    sample, counts = drawn(docs, labels, column, training.sample)
    total = sum(counts.values())
    prior = (counts.get(1, 0) + 1) / (total + 2)
    words_udf = F.arrow_udf(lambda texts: pa.array([words_of(b).ravel().view(np.int64) for b in base.byte_rows(texts)], pa.list_(pa.int64())), "array<long>")
    found = sample.repartition(16).select("label", words_udf(F.col("text")).alias("words")).toArrow() if min(counts.get(0, 0), counts.get(1, 0)) else None
    f = training.filters
    if found is None or not found.num_rows:
        blank = np.zeros((BUCKETS + 1, PLACES * f), np.float32)
        return Model((blank,) * TABLES, np.zeros(len(WIDTHS) * f, np.float32), np.zeros(len(WIDTHS) * f, np.float32), float(np.log(prior / (1 - prior))), {}, prior)
    truth = found["label"].to_numpy()
    texts = [x.values.to_numpy().view(_U).reshape(TABLES - 1, -1) for x in found["words"].combine_chunks()]
    order = sorted((k for k in range(len(texts)) if texts[k].size), key=lambda k: (int(bytewords.mix(texts[k]).sum()), texts[k].size, truth[k]))
    texts, truth = [texts[k] for k in order], truth[order]
    inputs = [buckets(t) for t in texts]
    fitted = [k for k in range(len(texts)) if k % training.calibration]
    network = Network(training)
    for epoch in range(training.epochs):
        rate = training.rate * (1 - 0.9 * epoch / training.epochs)
        for k in network.rng.permutation(fitted):
            network.step(inputs[k], int(truth[k]), rate)
    flat = network.kernel.transpose(1, 0, 2).reshape(training.size, -1)
    model = Model(tuple((v @ flat).astype(np.float32) for v in network.vectors), network.offsets, network.out, float(network.bias), {}, prior)
    held = [k for k in range(len(texts)) if not k % training.calibration] or list(range(len(texts)))
    logits, langs = np.array([network.logit(inputs[k]) for k in held]), np.array([language(texts[k][0]) or "" for k in held])
    own = truth[held]
    # weights give the sample the shares of all labelled rows
    weights = np.where(own == 1, counts[1] / max(1, truth.sum()), counts[0] / max(1, (1 - truth).sum()))
    weights = weights / weights.mean()
    model.calibration[None] = _platt(logits, own, weights)
    for lang in FUNCTION_WORDS:
        mine = langs == lang
        if min(own[mine].sum(), (1 - own[mine]).sum()) >= training.least:
            model.calibration[lang] = _platt(logits[mine], own[mine], weights[mine])
    return model


def score(buf: np.ndarray, model: Model) -> float:
    words = words_of(buf)
    if not words.size:
        return model.empty
    ids = buckets(words)
    f = model.tables[0].shape[1] // PLACES
    top = np.full(len(WIDTHS) * f, -np.inf, np.float32)
    step = CHUNK - WIDTHS[-1] + 1
    for a in range(0, ids.shape[1] - WIDTHS[-1] + 1, step):
        products = sum(t[row[a : a + CHUNK]] for t, row in zip(model.tables, ids))
        top = np.maximum(top, _pool(products, f)[0])
    act = top + model.offsets
    logit = float(model.out @ np.where(act > 0, act, 0.1 * act) + model.bias)
    slope, shift = model.calibration.get(language(words[0]), model.calibration.get(None, (1.0, 0.0)))
    return float(1 / (1 + np.exp(-np.clip(slope * logit + shift, -60, 60))))


def score_column(docs: DataFrame, model: Model) -> Column:
    """Score of ``text``, 0 to 1, higher where label 1 is likelier; of a text without words the share of label 1.

    Equal texts have equal scores.  A very long text is scored whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([score(b, shared.value) for b in base.byte_rows(texts)], pa.float64())

    return F.arrow_udf(run, "double")(F.col("text"))


def thresholds(model: Model, at: float = 0.5) -> dict[str | None, float]:
    """For each language the raw logit at which the calibrated score reaches ``at``."""
    want = float(np.log(at / (1 - at)))
    return {lang: (want - shift) / slope for lang, (slope, shift) in model.calibration.items()}
