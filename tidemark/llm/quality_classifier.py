"""Supervised subword embeddings: is a document of good quality?

A document is the mean of learned vectors of its hashed words and hashed character n-grams
(n = 3 to 5, within a word with its bounds); that a word repeats the one before it is one more
feature.  A softmax over the mean gives the classes.  Both are trained together by
stochastic gradient descent in numpy on a bounded sample of labelled rows.  For two classes, the
softmax of a mean of vectors is the logistic of a mean of one number per feature, so the
executors need just one number per bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base, bytewords
from tidemark.llm.labelled import Sample, drawn

_U = np.uint64
NGRAMS = (3, 4, 5)
BITS = 18
BUCKETS = 1 << BITS
#: One more feature, where the word before was the same; it counts as about all n-grams of a word.
REPEAT, REPEAT_TIMES = BUCKETS, 16


@dataclass(frozen=True)
class Training:
    sample: Sample = Sample()
    size: int = 16
    epochs: int = 12
    rate: float = 0.2
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """Score of a text: logistic of ``bias`` and the mean of ``weights`` over its features."""

    weights: np.ndarray
    bias: float
    #: Score of a text without any word.
    empty: float


def _bucket(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((h * bytewords.GOLDEN) >> _U(64 - BITS)).astype(np.int32)


def features(buf: np.ndarray):
    """Bucket numbers of all features of a text, block by block."""
    for block in bytewords.blocks(buf):
        values, space = bytewords.code_points(block)
        starts, ends = bytewords.edges(space)
        words = bytewords.span_hashes(values, starts, ends)
        yield _bucket(words)
        yield np.full(REPEAT_TIMES * int((words[1:] == words[:-1]).sum()), REPEAT, np.int32)
        with np.errstate(over="ignore"):
            h, inner = values, np.ones(len(values), bool)
            for n in range(2, NGRAMS[-1] + 1):
                h = h[:-1] * _U(bytewords.RADIX) + values[n - 1 :]
                if n > 2:
                    inner = (inner[:-1] if n > 3 else np.ones(len(values) - 2, bool)) & ~space[n - 2 : len(space) - 1]
                if n in NGRAMS:
                    yield _bucket(h[inner] + _U(n))


def bag(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found = np.concatenate(list(features(buf)))
    return np.unique(found, return_counts=True)


def _bags(texts: pa.Array) -> pa.Array:
    rows = [bag(b) for b in base.byte_rows(texts)]
    return base.struct(ids=pa.array([r[0] for r in rows], pa.list_(pa.int32())), counts=pa.array([r[1].astype(np.int32) for r in rows], pa.list_(pa.int32())))


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, training: Training) -> tuple[np.ndarray, np.ndarray]:
    """Vectors (BUCKETS + 1 x size) and output weights (classes x size + bias), by gradient descent with AdaGrad steps."""
    rng = np.random.default_rng(training.seed)
    vectors = rng.uniform(-1, 1, (BUCKETS + 1, training.size)).astype(np.float32) / training.size
    seen = np.full(BUCKETS + 1, 1e-8, np.float32)
    out, out_seen = np.zeros((2, training.size + 1), np.float32), np.full((2, training.size + 1), 1e-2, np.float32)
    shares = [(c / c.sum()).astype(np.float32) for _, c in bags]
    for epoch in range(training.epochs):
        rate = training.rate * (1 - epoch / training.epochs)
        for k in rng.permutation(len(bags)):
            ids, share = bags[k][0], shares[k]
            mean = np.append(share @ vectors[ids], np.float32(1))
            logits = out @ mean
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[k]] -= 1
            back = p @ out[:, :-1]
            step = np.outer(p, mean)
            out_seen += step * step
            out -= rate * step / np.sqrt(out_seen)
            norm = float(back @ back) / training.size
            seen[ids] += share * share * norm
            vectors[ids] -= (rate * share / np.sqrt(seen[ids]))[:, None] * back
    return vectors, out


def learned(docs: DataFrame, labels: DataFrame, column: str = "quality", training: Training = Training()) -> Model:
    """Model of ``column`` from labelled rows outside fold 0; with less than two labels a constant one.

    Null labels, ids and texts are left out, and so are texts longer than the sample allows.  A row
    that is given several times may be drawn several times; ties of the sample go by the hash of id and
    text, so reruns agree.  Empty tables give the constant model.
    """
    sample, counts = drawn(docs, labels, column, training.sample)
    total = sum(counts.values())
    prior = (counts.get(1, 0) + 1) / (total + 2)
    shift = float(np.log(prior / (1 - prior)))
    bags_of = F.arrow_udf(_bags, "ids array<int>, counts array<int>")
    found = sample.repartition(16).select("label", bags_of(F.col("text")).alias("b")).select("label", "b.*").toArrow() if min(counts.get(0, 0), counts.get(1, 0)) else None
    if found is None or not found.num_rows:
        return Model(np.zeros(BUCKETS + 1, np.float32), shift, prior)
    labels_of = found["label"].to_numpy()
    bags = []
    for ids, times in zip(found["ids"].combine_chunks(), found["counts"].combine_chunks()):
        bags.append((ids.values.to_numpy(), times.values.to_numpy()))
    order = sorted(range(len(bags)), key=lambda k: (len(bags[k][0]), bags[k][0].tobytes(), bags[k][1].tobytes(), labels_of[k]))
    order = [k for k in order if len(bags[k][0])]
    vectors, out = fit([bags[k] for k in order], labels_of[order], training)
    drawn_share = max(int(labels_of[order].sum()), 1) / max(int((1 - labels_of[order]).sum()), 1)
    lean = out[1] - out[0]
    # the sample holds the labels in other shares than the labelled rows
    return Model(vectors @ lean[:-1], float(lean[-1]) + shift - float(np.log(drawn_share)), prior)


def score(buf: np.ndarray, model: Model) -> float:
    total, n = 0.0, 0
    for part in features(buf):
        total += float(model.weights[part].sum(dtype=np.float64))
        n += len(part)
    if not n:
        return model.empty
    return float(1 / (1 + np.exp(-np.clip(model.bias + total / n, -60, 60))))


def score_column(docs: DataFrame, model: Model) -> Column:
    """Score of ``text``, 0 to 1, higher where label 1 is likelier; of a null or empty text the share of label 1.

    Equal texts have equal scores.  A very long text is scored whole, block by block.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([score(b, shared.value) for b in base.byte_rows(texts)], pa.float64())

    return F.arrow_udf(run, "double")(F.col("text"))


def kept_documents(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The documents whose score reaches ``threshold``, with the columns they had."""
    return docs.filter(score_column(docs, model) >= threshold)
