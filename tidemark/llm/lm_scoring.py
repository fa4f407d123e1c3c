"""Language-model scores from the lattice of subword segmentations.

The pieces and scores of an existing vocabulary (a SentencePiece file, read where it lies) give
each piece a prior probability.  A word is all ways to cut it into pieces: a log-space forward
recursion over its positions sums them up to the word's marginal probability.  Rounds of
expectation over all training words, each as often as it occurs (the same lattice, forward and
backward), re-weight the pieces to the corpus; the pieces themselves stay as they are.

The score of a text is the product of its words' marginals and its end:

    P(text) = P(end) * product of (1 - P(end)) lattice(w),    P(end) = (c_end + 1/2) / (N + 1)

A further column interpolates the marginals with word counts by absolute discounting, so a
new word gets what the discounts leave, shared out by the lattice:

    P'(w) = (max(c - D, 0) + (D T + 1/2) lattice(w)) / (N + 1)

with c the count of w, T the number of distinct training words, N all training tokens and D from
the numbers of words seen once and twice.

Marginals are worked out once for each distinct word.  Words of at least ``min_share`` of all
tokens (so at most 1 / min_share of them) are scored where the text is; only the others are
sent by word to their scores.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base, bytewords

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: The mark of a word's beginning in the vocabulary.
START = "▁"
_LOWER = bytes(bytewords.LOWER)
_U = np.uint64


@dataclass(frozen=True)
class Settings:
    vocabulary: str = VOCABULARY
    folds: int = 5
    held_out: int = 1
    #: Weight of the prior in the re-weighting, in pieces.
    prior: float = 1000.0
    rounds: int = 3
    min_share: float = 1e-5


class Lattice:
    """Pieces with log probabilities (natural)."""

    #: Piece numbers besides the vocabulary: no such piece, and a character that has none.
    NONE, UNKNOWN = 0, 1
    #: Longer words are worked on one at a time.
    LONG = 40
    SLOT_BITS = 20
    SPREAD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

    def __init__(self, pieces: list[str], logs: np.ndarray):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.logs = np.concatenate([[-np.inf, 0.0], logs])
        self.logs[self.UNKNOWN] = 4 * float(logs.min(initial=-10.0))  # as four bytes of the rarest kind
        self.hashes = np.zeros(len(pieces) + 2, _U)
        for at, same in _by_length(pieces, ""):
            values, h = _values(same), None
            for v in values:
                h = _extended(h, v)
            self.hashes[at + 2] = h
        # a piece stands in the first table, or where that slot is taken, in the second
        self.slots = [np.zeros(1 << self.SLOT_BITS, np.int32) for _ in self.SPREAD]
        for k in range(2, len(self.hashes)):
            for table, by in zip(self.slots, self.SPREAD):
                slot = int(self.hashes[k]) * by % (1 << 64) >> (64 - self.SLOT_BITS)
                if not table[slot]:
                    table[slot] = k
                    break
            else:
                raise ValueError("too many pieces for the tables")

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Piece numbers by hash."""
        out = np.zeros(h.shape, np.int32)
        with np.errstate(over="ignore"):
            for table, by in zip(self.slots, self.SPREAD):
                k = table[(h * _U(by)) >> _U(64 - self.SLOT_BITS)]
                np.copyto(out, k, where=self.hashes[k] == h)
        return out

    @classmethod
    def read(cls, path: str) -> Lattice:
        """Vocabulary whose scores are minus the rank: by Zipf's law the probability falls as 1 / (1 + rank)."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        plain = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        weights = np.array([1 / (1 + max(0.0, -model.get_score(i))) for i in plain])
        return cls([model.id_to_piece(i) for i in plain], np.log(weights / weights.sum()))

    def reweighted(self, counts: np.ndarray, prior: float) -> Lattice:
        """Pieces by expected counts (numbered as in ``logs``) and ``prior`` pieces of the present probabilities."""
        weights = counts[2:] + prior * np.exp(self.logs[2:])
        return Lattice(self.pieces, np.log(weights / weights.sum()))

    def _cells(self, words: list[str]) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Piece numbers (cell x word) of words of one length, and (first start, first cell) of the cells that end at each place."""
        values, n = _values(words), len(words[0])
        spans, cells = [], 0
        for j in range(1, n + 1):
            spans.append((max(0, j - self.longest), cells))
            cells += j - spans[-1][0]
        found = np.zeros((cells, len(words)), np.int32)
        for i in range(n):
            h = None
            for j in range(i + 1, min(n, i + self.longest) + 1):
                h = _extended(h, values[j - 1])
                first, cell = spans[j - 1]
                found[cell + i - first] = self._find(h)
        for j, (first, cell) in enumerate(spans, 1):
            single = found[cell + j - 1 - first]
            np.maximum(single, self.UNKNOWN, out=single)
        return found, spans

    def _long(self, word: str) -> tuple[list[list[tuple[int, int]]], list[float]]:
        """Arcs (start, piece) by their end, and the forward logs, of one long word."""
        arcs: list[list[tuple[int, int]]] = [[]]
        out = [0.0]
        found = np.zeros((self.longest, len(word)), np.int32)  # by length and start
        h, values = None, _values([word])[:, 0]
        for k in range(min(self.longest, len(word))):
            h = values if h is None else _extended(h[:-1], values[k:])
            found[k, : len(h)] = self._find(h)
        for j in range(1, len(word) + 1):
            here = [(i, p) for i in range(max(0, j - self.longest), j) if (p := int(found[j - i - 1, i]) or (i == j - 1) * self.UNKNOWN)]
            terms = [out[i] + self.logs[p] for i, p in here]
            top = max(terms)
            out.append(top + math.log(sum(math.exp(t - top) for t in terms)))
            arcs.append(here)
        return arcs, out

    def marginals(self, words: list[str]) -> np.ndarray:
        """Natural log of the probability of each word, over all its segmentations."""
        out = np.zeros(len(words))
        for at, same in _by_length(words):
            if len(same[0]) > self.LONG:
                out[at] = [self._long(w)[1][-1] for w in same]
                continue
            found, spans = self._cells(same)
            scores = self.logs[found]
            before = np.zeros((len(spans) + 1, len(same)))
            for j, (first, cell) in enumerate(spans, 1):
                before[j] = _log_sum(before[first:j] + scores[cell : cell + j - first])
            out[at] = before[-1]
        return out

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected number of each piece in the words, each taken ``counts`` times.

        Forward and backward sums of probabilities; a word too unlikely for them is done in logs.
        """
        total = np.zeros(len(self.logs))
        chance = np.exp(self.logs)
        for at, same in _by_length(words):
            if len(same[0]) > self.LONG:
                for k, w in zip(at, same):
                    self._add_long(w, counts[k], total)
                continue
            found, spans = self._cells(same)
            arcs = chance[found]
            before = np.zeros((len(spans) + 1, len(same)))
            after = np.zeros_like(before)
            before[0], after[-1] = 1, 1
            for j, (first, cell) in enumerate(spans, 1):
                before[j] = (before[first:j] * arcs[cell : cell + j - first]).sum(axis=0)
            for j in range(len(spans), 0, -1):  # all arcs from j on are in ``after`` by then
                first, cell = spans[j - 1]
                after[first:j] += arcs[cell : cell + j - first] * after[j]
            lost = before[-1] < 1e-250
            scale = np.where(lost, 0, counts[at] / np.where(lost, 1, before[-1]))
            for j, (first, cell) in enumerate(spans, 1):
                arcs[cell : cell + j - first] *= before[first:j] * (after[j] * scale)
            total += np.bincount(found.ravel(), arcs.ravel(), minlength=len(total))
            for k in np.flatnonzero(lost):
                self._add_long(same[k], counts[at[k]], total)
        return total

    def _add_long(self, word: str, count: float, total: np.ndarray) -> None:
        arcs, before = self._long(word)
        after = [-math.inf] * len(before)
        after[-1] = 0.0
        for j in range(len(word), 0, -1):
            for i, p in arcs[j]:
                step = self.logs[p] + after[j]
                top, low = max(after[i], step), min(after[i], step)
                after[i] = top + math.log1p(math.exp(low - top))
                total[p] += count * math.exp(before[i] + step - before[-1])


def _values(words: list[str]) -> np.ndarray:
    """A random 64-bit value for each character (place x word) of words of one length."""
    chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1)
    with np.errstate(over="ignore"):
        return bytewords.mix(chars.T.astype(_U))


def _extended(h: np.ndarray | None, values: np.ndarray) -> np.ndarray:
    """Hashes of strings with one more character."""
    with np.errstate(over="ignore"):
        return values if h is None else h * _U(bytewords.RADIX) + values


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=0)
    with np.errstate(invalid="ignore", divide="ignore"):
        return top + np.log(np.exp(x - np.where(np.isfinite(top), top, 0)).sum(axis=0))


def _by_length(words: list[str], mark: str = START):
    """(places, words with ``mark`` before them) of each length."""
    groups: dict[int, list[int]] = defaultdict(list)
    for k, w in enumerate(words):
        groups[len(w)].append(k)
    for places in groups.values():
        for a in range(0, len(places), 2000):
            part = places[a : a + 2000]
            yield np.array(part), [mark + words[k] for k in part]


def _word_counts(batches):
    """(word, count in training documents, count in all) of one task."""
    trained: Counter = Counter()
    others: Counter = Counter()

    def flush():
        words = list(trained) + [w for w in others if w not in trained]
        for a in range(0, len(words), 50_000):
            part = words[a : a + 50_000]
            n = [trained.get(w, 0) for w in part]
            total = [k + others.get(w, 0) for w, k in zip(part, n)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array(n, pa.int64()), pa.array(total, pa.int64())], names=["word", "n", "total"])
        trained.clear()
        others.clear()

    for batch in batches:
        for train, buf in zip(batch.column("train").to_pylist(), base.byte_rows(batch.column("text"))):
            (trained if train else others).update(buf.tobytes().translate(_LOWER).split())
        if len(trained) + len(others) > 500_000:
            yield from flush()
    yield from flush()


def _expectation(shared):
    def run(batches):
        lattice = shared.value
        total = np.zeros(len(lattice.logs))
        for batch in batches:
            words = [w.decode("utf-8", "replace") for w in batch.column("word").to_pylist()]
            if words:
                total += lattice.expected(words, batch.column("n").to_numpy().astype(np.float64))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["piece", "expected"])

    return run


@dataclass(frozen=True)
class Totals:
    tokens: int
    ends: int
    words: int
    discount: float
    #: Words of all documents, also those that are not learned from.
    occurrences: int = 0

    def base(self, count):
        """log10 of the add-half estimate."""
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.words + (1 if self.ends else 0) + 1)))

    def marginal(self, marginal: np.ndarray) -> np.ndarray:
        """log10 of a word's share: no end, and the lattice's marginal."""
        return (math.log1p(-(10 ** self.end())) + marginal) / math.log(10)

    def interpolated(self, count: np.ndarray, marginal: np.ndarray) -> np.ndarray:
        """log10 of P'(w)."""
        left = math.log(self.discount * self.words + 0.5)
        with np.errstate(divide="ignore"):
            seen = np.log(np.maximum(count - self.discount, 0))
        return (np.logaddexp(seen, left + marginal) - math.log(self.tokens + 1)) / math.log(10)

    def end(self) -> float:
        return math.log10((self.ends + 0.5) / (self.tokens + 1))


_SCORES = "word binary, n long, total long, base double, score double, mixed double"


def _word_scores(shared, totals: Totals):
    def run(batches):
        lattice = shared.value
        for batch in batches:
            raw, n = batch.column("word"), batch.column("n").to_numpy()
            marginal = lattice.marginals([w.decode("utf-8", "replace") for w in raw.to_pylist()]) if len(n) else np.zeros(0)
            found = [totals.base(n), totals.marginal(marginal), totals.interpolated(n, marginal)]
            yield pa.RecordBatch.from_arrays([raw, batch.column("n"), batch.column("total"), *[pa.array(x, pa.float64()) for x in found]], names=["word", "n", "total", "base", "score", "mixed"])

    return run


_SUMS = ("base", "score", "mixed")
_PARTS = "n_tokens long, known long, base double, score double, mixed double, words array<binary>, times array<int>"


def _doc_parts(shared, totals: Totals):
    """Sums over the frequent words of a text, and its other words."""
    ends = float(totals.base(totals.ends)), totals.end(), totals.end()

    def run(texts: pa.Array) -> pa.Array:
        frequent = shared.value
        rows = []
        for buf in base.byte_rows(texts):
            counts = Counter(buf.tobytes().translate(_LOWER).split())
            known, (b, s, m) = int(totals.ends > 0), ends
            rest, times = [], []
            for w, k in counts.items():
                at = frequent.get(w)
                if at is None:
                    rest.append(w)
                    times.append(k)
                else:
                    known += k * at[0]
                    b += k * at[1]
                    s += k * at[2]
                    m += k * at[3]
            rows.append((sum(counts.values()) + 1, known, b, s, m, rest, times))
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int32())]
        columns = list(zip(*rows)) if rows else [[]] * len(kinds)
        return base.struct(**{n: pa.array(list(c), t) for n, c, t in zip(("n_tokens", "known", *_SUMS, "words", "times"), columns, kinds)})

    return run


def learned(docs: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, Totals]:
    """Scores of every word of ``docs``, written, and the totals of the training documents."""
    spark = docs.sparkSession
    train = base.fold("doc_id", settings.folds) != settings.held_out
    counted = docs.select("text", train.alias("train")).mapInArrow(_word_counts, "word binary, n long, total long")
    counted = counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    words = base.written(counted, "word-counts")
    sums = words.agg(F.sum("n"), F.count_if(F.col("n") > 0), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2), F.sum("total")).first()
    ends = docs.filter(train).count()
    once, twice = sums[2], sums[3]
    totals = Totals((sums[0] or 0) + ends, ends, sums[1], once / (once + 2 * twice) if once and twice else 0.5, sums[4] or 0)
    lattice = Lattice.read(settings.vocabulary)
    seen = words.filter("n > 0").select("word", "n")
    for _ in range(settings.rounds):
        shared = spark.sparkContext.broadcast(lattice)
        expected = seen.mapInArrow(_expectation(shared), "piece long, expected double").groupBy("piece").agg(F.sum("expected").alias("expected"))
        counts = np.zeros(len(lattice.logs))
        for r in expected.collect():  # at most the vocabulary
            counts[r.piece] = r.expected
        lattice = lattice.reweighted(counts, settings.prior)
    fitted = spark.sparkContext.broadcast(lattice)
    scores = words.mapInArrow(_word_scores(fitted, totals), _SCORES)
    return base.written(scores, "word-scores"), totals


def scored(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, interpolated_score.

    Scores are log10 of the probability of the text and its end.  A null or empty text is its end
    alone; a null id counts as empty text in the fold.  Each of several equal rows is scored and
    trained on.  Without training documents the lattice with its prior weights scores alone; no
    documents, no rows.  A text is counted whole, in memory that grows with its distinct words.
    """
    spark = docs.sparkSession
    scores, totals = learned(docs, settings)
    limit = max(1.0, totals.occurrences * settings.min_share)
    top = scores.filter(F.col("total") >= limit).select("word", (F.col("n") > 0).cast("int").alias("known"), *_SUMS).toArrow()  # at most 1 / min_share
    frequent = dict(zip(top["word"].to_pylist(), zip(*(top[c].to_pylist() for c in ("known", *_SUMS)))))
    parts = F.arrow_udf(_doc_parts(spark.sparkContext.broadcast(frequent), totals), _PARTS)
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row_id"), parts(F.col("text")).alias("p"))
    rows = base.written(rows.select("doc_id", "row_id", "p.*"), "text-parts")
    rare = rows.select("row_id", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row_id", F.col("x.words").alias("word"), F.col("x.times").alias("k"))
    joined = rare.join(scores.filter(F.col("total") < limit), "word")
    known = F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("rare_known")
    sums = joined.groupBy("row_id").agg(known, *[F.sum(F.col("k") * F.col(c)).alias(f"rare_{c}") for c in _SUMS])
    whole = rows.select("doc_id", "row_id", "n_tokens", "known", *_SUMS).join(sums, "row_id", "left")
    with_rare = lambda c: F.col(c) + F.coalesce(f"rare_{c}", F.lit(0))
    return whole.select(
        "doc_id",
        (base.fold("doc_id", settings.folds) == settings.held_out).alias("held_out"),
        "n_tokens",
        with_rare("known").alias("n_known"),
        F.lit(totals.tokens).cast("long").alias("train_tokens"),
        with_rare("base").alias("base_score"),
        with_rare("score").alias("score"),
        with_rare("mixed").alias("interpolated_score"),
    )
