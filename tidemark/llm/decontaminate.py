"""Benchmark decontamination with one Aho-Corasick automaton.

Words are the runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased.
Each word of the benchmark is one symbol; every window of ``window`` consecutive words of an
item (all words of a shorter item) is a pattern.  The automaton reads the symbols of a text
once; hits are word numbers, which map back to character offsets of the original text.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base

WINDOW = 10
#: Words of one block of the benchmark; its automaton is sent to the executors.
BLOCK_WORDS = 1_000_000

#: Bytes of words as they are or lower-cased, all others as space.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_SPAN = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Symbols are code points from here on (above the surrogates).
_FIRST = 0xE000


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_TABLE).split()


class Patterns:
    """The windows of one block of items, and the automaton that finds them."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.symbols: dict[bytes, str] = {}
        owners: dict[str, set] = defaultdict(set)
        for item_id, text in items:
            symbols = [self.symbols.setdefault(w, chr(_FIRST + len(self.symbols))) for w in words_of((text or "").encode())]
            width = min(window, len(symbols))
            for i in range(len(symbols) - width + 1) if width else ():
                owners["".join(symbols[i : i + width])].add(item_id)
        self.automaton = ahocorasick.Automaton()
        for key, ids in owners.items():
            self.automaton.add_word(key, (len(key), tuple(ids)))
        if owners:
            self.automaton.make_automaton()
        self.empty = not owners

    def hits(self, raw: bytes) -> tuple[int, list[tuple[int, int, tuple]]]:
        """Number of words, and (first word, past the last, item ids) of each occurrence."""
        words = words_of(raw)
        if self.empty or not words:
            return len(words), []
        line = "".join(map(self.symbols.get, words, repeat("\x00")))
        return len(words), [(end + 1 - n, end + 1, ids) for end, (n, ids) in self.automaton.iter(line)]


_BUILT: dict = {}


def _patterns(shared, window: int) -> Patterns:
    """Built once in each Python worker from the broadcast items."""
    key = shared.value[0], window
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Patterns(shared.value[1], window)
    return _BUILT[key]


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple]]:
    """The items in blocks of at most ``block_words`` words (a longer item is a block of its own).

    The driver holds one block at a time.
    """
    block, size = [], 0
    for row in benchmark.filter(F.col("text").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), "text").toLocalIterator():
        n = len(words_of(row.text.encode()))
        if block and size + n > block_words:
            yield block
            block, size = [], 0
        block.append((row.item_id, row.text))
        size += n
    if block:
        yield block


def char_offsets(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets of word ranges in the original text."""
    edges = [(m.start(), m.end()) for m in _SPAN.finditer(raw)]
    at = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    return [(int(at[edges[a][0]]) - 1, int(at[edges[b - 1][1] - 1])) for a, b in spans]


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


_SPANS = "array<struct<start:long,end:long,first_word:long,last_word:long,item_ids:array<string>>>"
_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("item_ids", pa.list_(pa.string()))]))


def _scan(shared, window: int):
    def run(texts: pa.Array) -> pa.Array:
        patterns = _patterns(shared, window)
        counts, found = [], []
        for buf in base.byte_rows(texts):
            raw = buf.tobytes()
            n, hits = patterns.hits(raw)
            offsets = char_offsets(raw, [(a, b) for a, b, _ in hits]) if hits else []
            counts.append(n)
            found.append([{"start": s, "end": e, "first_word": a, "last_word": b, "item_ids": [i for i in ids if i is not None]} for (s, e), (a, b, ids) in zip(offsets, hits)])
        return base.struct(n_words=pa.array(counts, pa.int64()), hits=pa.array(found, _ARROW))

    return run


def scanned(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``n_words`` and ``hits`` (offsets in characters and words, item ids).

    One pass over the texts for each block of the benchmark; rows are never moved.  A null or
    empty text has no words; an item of null text has no window; an item of null id is found
    but names no id.  Items of the same id count as one.  Repeated rows are each scanned.  A very
    long text is scanned whole; no documents give no rows, and without items nothing is hit.  An item
    may have about a million different words.
    """
    spark = docs.sparkSession
    parts = []
    for items in item_blocks(benchmark, block_words):
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, items))
        parts.append(F.arrow_udf(_scan(shared, window), f"n_words long, hits {_SPANS}")(F.col("text")))
    if not parts:
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, []))
        parts.append(F.arrow_udf(_scan(shared, window), f"n_words long, hits {_SPANS}")(F.col("text")))
    result = F.struct(parts[0]["n_words"].alias("n_words"), reduce(lambda a, b: F.concat(a, b), [p["hits"] for p in parts]).alias("hits"))
    return base.with_results(docs, result, ["n_words", "hits"])


def _digest(hits: pa.Array) -> pa.Array:
    n_hit, n_items, digests = [], [], []
    for row in hits.to_pylist():
        row = row or []
        ids = sorted({i for h in row for i in h["item_ids"]})
        n_hit.append(sum(b - a for a, b in merged([(h["first_word"], h["last_word"]) for h in row])))
        n_items.append(len(ids))
        digests.append(hashlib.sha256(",".join(ids).encode()).hexdigest())
    return base.struct(n_hit=pa.array(n_hit, pa.int64()), n_items=pa.array(n_items, pa.int64()), items_sha256=pa.array(digests, pa.string()))


def digested(found: DataFrame) -> DataFrame:
    """``scanned`` rows with the number of hit words and items and a digest of the items."""
    udf = F.arrow_udf(_digest, "n_hit long, n_items long, items_sha256 string")
    out = base.with_results(found, udf(F.col("hits")), ["n_hit", "n_items", "items_sha256"])
    return out.withColumn("contaminated", F.col("n_hit") > 0)


def cut_out(text: str | None, hits: list) -> str | None:
    """The text without its hits."""
    if not text or not hits:
        return text
    out, at = [], 0
    for a, b in merged([(h["start"], h["end"]) for h in hits]):
        out.append(text[at:a])
        at = b
    return "".join(out) + text[at:]


def _clean(shared, window: int):
    def run(texts: pa.Array) -> pa.Array:
        patterns = _patterns(shared, window)
        return pa.array([not patterns.hits(b.tobytes())[1] for b in base.byte_rows(texts)], pa.bool_())

    return run


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without a benchmark window, with the columns they had."""
    clean = docs
    for items in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, items))
        clean = clean.filter(F.arrow_udf(_clean(shared, window), "boolean")(F.col("text")))
    return clean
