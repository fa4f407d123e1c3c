"""Periodic runs of words, by recompression.

A run is a stretch of words with smallest period q, of at least 2 q words, that cannot be made
longer.  All texts of a batch become one sequence of symbols, with a symbol of its own between
texts, and the sequence is compressed again and again: first every block of one repeated symbol
becomes a symbol (block compression), then the symbols are parted at random into left and right
ones and every left-right pair becomes a symbol (pair compression).  The names are exact, so equal
stretches get equal names wherever they stand, but for a symbol or block at either end: together the
levels are a run-length grammar of the texts.

How far two places agree (LCE) is read off the grammar: level by level upwards while the symbols
agree, then down to the first word that differs; both take a step or two a level.  A run of period p
holds two neighbouring places of the grid 0, p, 2p, ...; so for every p the grid's neighbours that
agree are extended to both sides, and those with p words of agreement are runs.  These are about
n ln n pairs a text, of which only those with a few equal words are looked at any further.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base


@dataclass(frozen=True)
class Settings:
    #: Words that a run must have at least.  At least 8, as fewer equal words could escape the first look.
    least: int = 12
    #: Words of the texts that are compressed together (a longer text is alone).
    together: int = 300_000


@dataclass(frozen=True)
class Level:
    """Symbols of a level; where each symbol of the next level starts, and which one each symbol is in."""

    symbols: np.ndarray
    starts: np.ndarray
    inside: np.ndarray
    blocks: bool


def _named(left: np.ndarray, right: np.ndarray, first: int) -> tuple[np.ndarray, int]:
    """Names from ``first`` on for pairs of numbers, equal for equal pairs; and the next free name."""
    names, which = np.unique(left.astype(np.int64) << 32 | right, return_inverse=True)
    return (first + which).astype(np.int32), first + len(names)


def _level(symbols: np.ndarray, first: np.ndarray, blocks: bool) -> Level:
    """``first`` tells which symbols begin one of the next level."""
    inside = np.cumsum(first, dtype=np.int32) - np.int32(1)
    starts = np.append(np.flatnonzero(first), len(symbols)).astype(np.int32)
    return Level(symbols, starts, np.append(inside, np.int32(len(starts) - 1)), blocks)


def _coins(symbols: np.ndarray, turn: int) -> np.ndarray:
    """A coin for each symbol, the same for equal symbols, tossed anew each turn."""
    with np.errstate(over="ignore"):
        h = symbols.astype(np.uint32) + np.uint32(turn * 0x9E3779B9 & 0xFFFFFFFF)
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            h ^= h >> np.uint32(shift)
            h *= np.uint32(factor)
    return h >> np.uint32(31) == 1


def grammar(symbols: np.ndarray, borders: int) -> list[Level]:
    """Levels of the recompression; symbols under ``borders`` stand between texts and never join others."""
    levels, free, turn = [], int(symbols.max(initial=0)) + 1, 0
    symbols = symbols.astype(np.int32)
    while True:
        first = np.ones(len(symbols), bool)
        np.not_equal(symbols[1:], symbols[:-1], out=first[1:])
        if not first.all():
            level = _level(symbols, first, True)
            sizes = np.diff(level.starts)
            next_ = symbols[level.starts[:-1]]
            long = np.flatnonzero(sizes > 1)
            next_[long], free = _named(next_[long], sizes[long], free)
            levels.append(level)
            symbols = next_
        word = symbols >= borders
        if not (word[1:] & word[:-1]).any():
            levels.append(_level(symbols, np.ones(len(symbols), bool), False))
            return levels
        turn += 1
        right = _coins(symbols, turn)
        pair = (word & ~right)[:-1] & (word & right)[1:]
        first = np.ones(len(symbols), bool)
        first[1:] = ~pair
        level = _level(symbols, first, False)
        next_ = symbols[level.starts[:-1]]
        at = np.flatnonzero(pair)
        next_[level.inside[at]], free = _named(symbols[at], symbols[at + 1], free)
        levels.append(level)
        symbols = next_


def agreement(levels: list[Level], i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
    """How many symbols from places ``i`` and ``j`` on (or before them) are equal; the places differ, and borders end it."""
    back = 0 if forward else 1  # the symbol looked at is at the place, or before it
    sign = 1 - 2 * back
    a, b = i.astype(np.int64), j.astype(np.int64)
    height = np.zeros(len(a), np.int32)
    at = np.arange(len(a))
    top = len(levels) - 1
    for h, level in enumerate(levels):
        s, starts, inside = level.symbols, level.starts, level.inside
        x, y = a[at], b[at]
        equal = s[x - back] == s[y - back]
        if h == top:
            # only borders are next to each other here: equal symbols are whole texts
            while equal.any():
                x[equal] += sign
                y[equal] += sign
                equal = s[x - back] == s[y - back]
            a[at], b[at], height[at] = x, y, h
            break
        differ = at[~equal]
        height[differ] = h
        at, x, y = at[equal], x[equal], y[equal]
        if not len(at):
            break
        uneven = (starts[inside[x]] != x) | (starts[inside[y]] != y)
        if level.blocks:
            u, v = x[uneven], y[uneven]
            p, q = inside[u - back] + 1 - back, inside[v - back] + 1 - back
            left, right = np.abs(starts[p] - u), np.abs(starts[q] - v)
            step = np.minimum(left, right)
            x[uneven] += sign * step
            y[uneven] += sign * step
            stopped = np.zeros(len(at), bool)
            stopped[uneven] = left != right
        else:
            x[uneven] += sign
            y[uneven] += sign
            stopped = np.zeros(len(at), bool)
        a[at], b[at] = x, y
        height[at[stopped]] = h
        at, x, y = at[~stopped], x[~stopped], y[~stopped]
        a[at], b[at] = inside[x], inside[y]
    for h in range(int(height.max(initial=0)) - 1, -1, -1):
        level = levels[h]
        at = np.flatnonzero(height > h)
        p, q = a[at], b[at]
        x, y = level.starts[p].astype(np.int64), level.starts[q].astype(np.int64)
        equal = level.symbols[x - back] == level.symbols[y - back]
        if level.blocks:
            step = np.minimum(np.abs(level.starts[p + sign] - x), np.abs(level.starts[q + sign] - y))
            step[~equal] = 0
        else:
            step = equal.astype(np.int64)
        a[at], b[at] = x + sign * step, y + sign * step
    return np.abs(a - i)


#: Grid neighbours of texts up to here are looked up: (place, period) in the order of the place.
SHORT = 4096


def _grid(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(later place, period) of all neighbours on grids of a text of ``n`` words, about two million at a time."""
    periods = np.arange(1, n // 2 + 1, dtype=np.int64)
    counts = (n - 1) // periods
    cuts = np.searchsorted(np.cumsum(counts), np.arange(0, counts.sum(), 2_000_000)[1:], "right")
    for p, c in zip(np.split(periods, cuts), np.split(counts, cuts)):
        if len(p):
            k = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c) + 1
            period = np.repeat(p, c)
            yield k * period, period


_TABLE: list[np.ndarray] = []


def _table() -> list[np.ndarray]:
    """Places and periods of all grids below SHORT in the order of the place, and how many there are below each place."""
    if not _TABLE:
        parts = list(_grid(2 * SHORT))
        place, period = (np.concatenate(c) for c in zip(*parts))
        inside = np.flatnonzero(place < SHORT)
        order = inside[np.argsort(place[inside], kind="stable")]
        below = np.searchsorted(place[order], np.arange(SHORT + 1))
        _TABLE.extend([place[order].astype(np.int32), period[order].astype(np.int32), below])
    return _TABLE


def _neighbours(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(earlier place, period) of the grid neighbours with equal words."""
    n = len(words)
    if n <= SHORT:
        place, period, below = _table()
        grids = [(place[: below[n]], period[: below[n]])]
    else:
        grids = _grid(n)
    for place, period in grids:
        hit = np.flatnonzero(words[place] == words[place - period])
        if len(hit):
            yield place[hit] - period[hit], period[hit]


def runs_of(texts: list[np.ndarray], settings: Settings = Settings()) -> list[np.ndarray]:
    """(start, length, period) of the runs of each text, by start, then period; texts are word numbers from 0."""
    borders = len(texts) + 6  # three of them at either end, so that a look at three neighbours stays inside
    parts, origin, at = [np.arange(3)], [], 3
    for k, words in enumerate(texts):
        origin.append(at)
        parts += [words + borders, [6 + k]]
        at += len(words) + 1
    symbols = np.concatenate([*parts, np.arange(3, 6)]).astype(np.int32)
    found: list[list[np.ndarray]] = [[], [], []]
    for k, words in enumerate(texts):
        if len(words) < settings.least:
            continue
        for i, p in _neighbours(words):
            i = i.astype(np.int64) + origin[k]
            j = i + p
            # six words of agreement around the pair at least: two after it, or three before it
            after = (symbols[i + 1] == symbols[j + 1]) & (symbols[i + 2] == symbols[j + 2])
            ahead = (symbols[i - 1] == symbols[j - 1]) & (symbols[i - 2] == symbols[j - 2]) & (symbols[i - 3] == symbols[j - 3])
            keep = after | ahead
            for column, values in zip(found, (np.full(int(keep.sum()), k), i[keep], p[keep].astype(np.int64))):
                column.append(values)
    out = [np.zeros((0, 3), np.int64)] * len(texts)
    if not found[0]:
        return out
    text, i, period = (np.concatenate(c) for c in found)
    if not len(text):
        return out
    levels = grammar(symbols, borders)
    whole = []
    for a in range(0, len(text), 1 << 20):
        t, x, p = text[a : a + (1 << 20)], i[a : a + (1 << 20)], period[a : a + (1 << 20)]
        ahead, after = agreement(levels, x, x + p, False), agreement(levels, x, x + p, True)
        full = (ahead + after >= p) & (ahead + after + p >= settings.least)
        start = x[full] - ahead[full]
        whole.append(np.unique(np.stack([t[full], start, (p + ahead + after)[full], p[full]], axis=1), axis=0))
    rows = np.unique(np.concatenate(whole), axis=0)
    # the same stretch is found with multiples of its period: the least one counts
    least = np.ones(len(rows), bool)
    least[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[least]
    rows[:, 1] -= np.array(origin)[rows[:, 0]]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    ends = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1))
    for k in np.unique(rows[:, 0]):
        out[k] = rows[ends[k] : ends[k + 1], 1:]
    return out


def collapsed(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay when each run keeps its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:n]) == 0


_RESULT = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _scan(settings: Settings):
    def run(texts: pa.Array) -> pa.Array:
        counts, lists, kept = [], [], []

        def flush(group: list[list[bytes]]) -> None:
            numbers: defaultdict = defaultdict()
            numbers.default_factory = numbers.__len__
            coded = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in group]
            for words, runs in zip(group, runs_of(coded, settings)):
                counts.append(len(words))
                lists.append(runs)
                if len(runs):
                    words = [w for w, stay in zip(words, collapsed(len(words), runs)) if stay]
                kept.append(b" ".join(words))

        group, size = [], 0
        for buf in base.byte_rows(texts):
            words = buf.tobytes().split()
            if group and size + len(words) > settings.together:
                flush(group)
                group, size = [], 0
            group.append(words)
            size += len(words)
        if group:
            flush(group)
        ends = np.concatenate([[0], np.cumsum([len(r) for r in lists], dtype=np.int64)]).astype(np.int32)
        rows = np.concatenate([np.zeros((0, 3), np.int64), *lists])
        fields = base.struct(start=pa.array(rows[:, 0]), length=pa.array(rows[:, 1]), period=pa.array(rows[:, 2]))
        return base.struct(n_words=pa.array(counts, pa.int64()), runs=pa.ListArray.from_arrays(pa.array(ends), fields), collapsed=pa.array(kept, pa.binary()).cast(pa.string()))

    return run


def detected(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed``; columns of these names are replaced.

    Words are parted by ASCII white space.  ``runs`` has start (word number from 0), length and
    period of each run, by start, then period.  ``collapsed`` has the words joined by one space
    without those that any run holds after its first period.  A null or empty text has no words, no
    runs and an empty ``collapsed``; a text of fewer than ``least`` words has no runs.  Rows are
    worked on one by one and never moved, so equal rows give equal results; no rows, none come out.
    A long text is worked on whole: memory grows with it, at about 150 bytes a word.
    """
    return base.with_results(docs, F.arrow_udf(_scan(settings), _RESULT)(F.col("text")), ["n_words", "runs", "collapsed"])


def longest(runs: Column) -> Column:
    """The run of greatest length, the smallest start, then period, among equals; null where there is none."""
    return F.array_min(F.transform(runs, lambda r: F.struct((-r["length"]).alias("short"), r["start"].alias("start"), r["period"].alias("period"))))


def listed(runs: Column) -> Column:
    """``start,length,period`` and a line feed for each run, in one text."""
    line = lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))
    return F.array_join(F.transform(runs, line), "")
