"""Quality rules by distribution divergence.

The histograms of a document over character classes and over common words are compared with
those of each language by the Jensen-Shannon distance.  The references come from all documents:
the sums of the class histograms by ``lang``, and the words that hold at least ``min_share`` of
a language's words (so there are at most 1 / min_share of them).  A document is held against the
large languages and its own, however rare that is.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base, bytewords

#: Character classes of a UTF-8 byte; bytes inside a character count for none.
CLASSES = ("space", "line", "lower", "upper", "digit", "stop", "symbol", "other_ascii", "wide")
_NONE = len(CLASSES)


def _byte_classes() -> np.ndarray:
    out = np.full(256, CLASSES.index("other_ascii"), np.uint8)
    out[[9, 11, 12, 13, 32]] = CLASSES.index("space")
    out[10] = CLASSES.index("line")
    out[ord("a") : ord("z") + 1] = CLASSES.index("lower")
    out[ord("A") : ord("Z") + 1] = CLASSES.index("upper")
    out[ord("0") : ord("9") + 1] = CLASSES.index("digit")
    out[[ord(c) for c in ".,;:?'\"()-"]] = CLASSES.index("stop")
    out[[ord(c) for c in "#*$%&|<>"]] = CLASSES.index("symbol")
    out[0x80:0xC0] = _NONE
    out[0xC0:] = CLASSES.index("wide")
    return out


BYTE_CLASS = _byte_classes()
_WORD = re.compile(base.WORD.encode())


@dataclass(frozen=True)
class Rules:
    """Limits.  Distances are Jensen-Shannon distances to base 2, from 0 to 1.

    ``min_chars`` and ``min_words`` guard short texts, whose histograms are chance: below
    them the comparison is left out, and the document passes it.
    """

    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5
    max_char_distance: float = 0.30
    max_word_distance: float = 0.40
    min_chars: int = 400
    min_common_words: int = 60
    min_share: float = 1 / 250
    min_lang_share: float = 1 / 200


@dataclass(frozen=True)
class References:
    """Histograms by language; ``words`` are the common words of all of them.

    ``own`` has the class histogram and word shares of each language under ``min_lang_share``;
    only its own documents are held against it.
    """

    langs: tuple[str, ...] = ()
    chars: np.ndarray = field(default_factory=lambda: np.zeros((0, len(CLASSES))))
    words: dict[bytes, int] = field(default_factory=dict)
    #: langs x (words + 1): shares of the language's own common words, the rest in the last column.
    shares: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))
    own: dict[str, tuple[np.ndarray, dict[bytes, float]]] = field(default_factory=dict)


def distances(p: np.ndarray, qs: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of histogram ``p`` to each row of ``qs``."""
    m = (p + qs) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=-1)
        right = np.where(qs > 0, qs * np.log2(qs / m), 0).sum(axis=-1)
    return np.sqrt(np.clip((left + right) / 2, 0, 1))


def char_histogram(buf: np.ndarray) -> np.ndarray:
    out = np.zeros(len(CLASSES) + 1, np.int64)
    for block in bytewords.blocks(buf):
        out += np.bincount(BYTE_CLASS[block], minlength=len(CLASSES) + 1)
    return out[: len(CLASSES)]


def _tallies(batches):
    """Class and word counts by language of one task, as (lang, key, n) rows; classes have keys without text."""
    chars: dict[str, np.ndarray] = {}
    words: dict[str, Counter] = {}

    def flush():
        for lang, counts in words.items():
            keys = list(counts)
            for at in range(0, len(keys), 50_000):
                part = keys[at : at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part)), pa.array([-1] * len(part), pa.int32()), pa.array(part, pa.binary()), pa.array([counts[k] for k in part], pa.int64())],
                    names=["lang", "kind", "word", "n"],
                )
        words.clear()

    for batch in batches:
        for lang, buf in zip(batch.column("lang").to_pylist(), base.byte_rows(batch.column("text"))):
            total = chars.setdefault(lang, np.zeros(len(CLASSES), np.int64))
            total += char_histogram(buf)
            words.setdefault(lang, Counter()).update(buf.tobytes().translate(_LOWER).split())
        if sum(map(len, words.values())) > 500_000:
            yield from flush()
    yield from flush()
    for lang, counts in chars.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(counts)), pa.array(np.arange(len(counts), dtype=np.int32)), pa.array([b""] * len(counts), pa.binary()), pa.array(counts)],
            names=["lang", "kind", "word", "n"],
        )


_LOWER = bytes(bytewords.LOWER)


def references(docs: DataFrame, rules: Rules = Rules()) -> References:
    """Language references from all documents; rows with a null lang or text count for none.

    What reaches the driver is the class histogram of each language and its words of at least
    ``min_share``, so at most 9 + 1 / min_share rows a language.  No documents, no references.
    """
    tallies = (
        docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
        .select("lang", "text")
        .mapInArrow(_tallies, "lang string, kind int, word binary, n long")
        .groupBy("lang", "kind", "word")
        .agg(F.sum("n").alias("n"))
    )
    tallies = base.written(tallies, "language-tallies")  # once: the totals decide which words are common
    totals = tallies.filter("kind = -1").groupBy("lang").agg(F.sum("n").alias("total"))
    every = totals.agg(F.sum("total")).first()[0] or 0
    known = totals.withColumn("large", F.col("total") >= every * rules.min_lang_share)
    found = (
        tallies.join(F.broadcast(known), "lang")  # one row a language
        .filter((F.col("kind") >= 0) | (F.col("n") >= F.col("total") * rules.min_share))
        .select("lang", "kind", "word", "n", "total", "large")
        .collect()
    )
    own: dict[str, tuple[np.ndarray, dict[bytes, float]]] = {}
    for r in found:
        if not r.large:
            counts, common = own.setdefault(r.lang, (np.zeros(len(CLASSES)), {}))
            if r.kind >= 0:
                counts[r.kind] = r.n
            else:
                common[bytes(r.word)] = r.n / r.total
    for counts, _ in own.values():
        counts /= max(counts.sum(), 1)
    found = [r for r in found if r.large]
    langs = tuple(sorted({r.lang for r in found}))
    words = {w: i for i, w in enumerate(sorted({bytes(r.word) for r in found if r.kind < 0}))}
    chars, shares = np.zeros((len(langs), len(CLASSES))), np.zeros((len(langs), len(words) + 1))
    for r in found:
        if r.kind >= 0:
            chars[langs.index(r.lang), r.kind] = r.n
        else:
            shares[langs.index(r.lang), words[bytes(r.word)]] = r.n / r.total
    chars /= np.maximum(chars.sum(axis=1, keepdims=True), 1)
    shares[:, -1] = 1 - shares.sum(axis=1)
    return References(langs, chars, words, shares, own)


def repeated_words(ids: np.ndarray, n: int) -> int:
    """How many words lie in windows of ``n`` words that occur at least twice (exact; ids count from 0)."""
    if len(ids) <= n:
        return 0
    size = int(ids.max()) + 1
    code, span = ids, size
    for k in range(1, n):
        if span * size >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
            span = int(code.max()) + 1
        code, span = code[:-1] * size + ids[k:], span * size
    ordered = np.argsort(code, kind="stable")
    same = code[ordered[1:]] == code[ordered[:-1]]
    if not same.any():
        return 0
    again = np.zeros(len(code), bool)
    again[ordered[1:][same]] = True
    again[ordered[:-1][same]] = True
    depth = np.zeros(len(ids) + 1, np.int64)
    depth[:-n] += again
    depth[n:] -= again
    return int((np.cumsum(depth[:-1]) > 0).sum())


def word_ids(words: list[bytes]) -> tuple[np.ndarray, dict[bytes, int]]:
    """Number of each word by first appearance."""
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    return ids, seen


def duplicate_lines(buf: bytes) -> int:
    lines = [x for x in buf.split(b"\n") if x.strip(b"\t\n\x0b\x0c\r ")]
    return len(lines) - len(set(lines))


#: Result columns and their Arrow types.
FIELDS = {
    "n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(), "n_repeat_words": pa.int64(),
    "char_distance": pa.float64(), "word_distance": pa.float64(), "base_failed": pa.bool_(), "kept": pa.bool_(),
}


def _word_distance(seen: dict[bytes, int], times: list[int], n: int, shares: dict[bytes, float]) -> float:
    """Distance of the words of a text to those of one language."""
    found = dict.fromkeys(shares, 0)
    for w, k in seen.items():
        if (low := w.translate(_LOWER)) in found:
            found[low] += times[k]
    p, q = np.array([*found.values(), 0.0]) / n, np.array([*shares.values(), 0.0])
    p[-1], q[-1] = 1 - p.sum(), 1 - q.sum()
    return float(distances(p, q[None, :])[0])


def judge(buf: np.ndarray, refs: References, rules: Rules, lang: str | None = None) -> tuple:
    """The measures of one text and the verdict; distances are null where a guard leaves them out.

    They are also null where ``lang`` is a language without references; a null ``lang`` is held
    against the large languages.
    """
    raw = buf.tobytes()
    words = raw.split()
    ids, seen = word_ids(words)
    n = len(words)
    counts = char_histogram(buf)
    symbols = int(counts[CLASSES.index("symbol")])
    word_chars = len(buf) - int((BYTE_CLASS[buf] == _NONE).sum()) - int(counts[0] + counts[1])
    repeats = repeated_words(ids, rules.window)
    failed = n < rules.min_words or 100 * repeats > rules.max_repeat_percent * n
    char_d = word_d = None
    own_ref = refs.own.get(lang)
    if len(refs.langs) and (lang is None or lang in refs.langs or own_ref):
        total = int(counts.sum())
        if total >= rules.min_chars:
            char_d = float(distances(counts / total, refs.chars).min())
            if own_ref:
                char_d = min(char_d, float(distances(counts / total, own_ref[0][None, :])[0]))
        if n >= rules.min_common_words:
            found = np.zeros(len(refs.words) + 1)
            times = np.bincount(ids, minlength=len(seen)).tolist()
            for w, k in seen.items():
                at = refs.words.get(w.translate(_LOWER))
                if at is not None:
                    found[at] += times[k]
            own = np.where(refs.shares[:, :-1] > 0, found[:-1] / n, 0)
            hist = np.column_stack([own, 1 - own.sum(axis=1)])
            word_d = float(min(distances(h, q[None, :])[0] for h, q in zip(hist, refs.shares)))
            if own_ref:
                word_d = min(word_d, _word_distance(seen, times, n, own_ref[1]))
    passed = (char_d is None or char_d <= rules.max_char_distance) and (word_d is None or word_d <= rules.max_word_distance)
    return n, word_chars, symbols, duplicate_lines(raw), repeats, char_d, word_d, failed, passed and not failed


def judged(docs: DataFrame, refs: References | None = None, rules: Rules = Rules()) -> DataFrame:
    """``docs`` with the columns of FIELDS (a column of the same name is replaced).

    A null or empty text has no words and fails the base rules.  Each row is judged alone, so
    repeated rows get the same verdict.  Rows are never moved.  ``refs`` default to those of
    ``docs`` itself; without any reference the base rules alone decide.
    """
    refs = references(docs, rules) if refs is None else refs
    shared = docs.sparkSession.sparkContext.broadcast(refs)

    def run(texts: pa.Array, langs: pa.Array) -> pa.Array:
        own = iter(langs.to_pylist())
        return base.per_text(lambda buf: judge(buf, shared.value, rules, next(own)), list(FIELDS), list(FIELDS.values()))(texts)

    kinds = {pa.int64(): "long", pa.float64(): "double", pa.bool_(): "boolean"}
    udf = F.arrow_udf(run, ", ".join(f"{n} {kinds[t]}" for n, t in FIELDS.items())).asNondeterministic()
    return base.with_results(docs, udf(F.col("text"), F.col("lang")), list(FIELDS))


def kept_documents(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with the columns they had."""
    refs = references(docs, rules)
    shared = docs.sparkSession.sparkContext.broadcast(refs)
    keep = F.arrow_udf(lambda texts, langs: pa.array([judge(b, shared.value, rules, x)[-1] for b, x in zip(base.byte_rows(texts), langs.to_pylist())], pa.bool_()), "boolean")
    return docs.filter(keep(F.col("text"), F.col("lang")))
