"""Words and n-grams of UTF-8 bytes as numpy arrays.

White space is ASCII white space (0x20, 0x09-0x0D), so a multi-byte character is never cut.
Everything works on blocks of at most about a megabyte, cut at white space, so that the
memory of a very long text is bounded (a single longer word is a block of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
GOLDEN = _U(0x9E3779B97F4A7C15)
#: An odd multiplier and its inverse modulo 2^64.
RADIX = 0xD6E8FEB86659FD93
INVERSE = pow(RADIX, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix64 generator: one 64-bit value to another, evenly spread."""
    x = x + GOLDEN
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


with np.errstate(over="ignore"):
    #: A random 64-bit value for each byte.
    BYTE = mix(np.arange(256, dtype=_U))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, _U(base))
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[str, np.ndarray] = {}


#: Random values of code points; those beyond the first plane share their lower half's.
CODE_POINT = BYTE[:0]


def code_points(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A random 64-bit value for each character, and where white space is; a space stands at both ends."""
    global CODE_POINT
    if not len(CODE_POINT):
        with np.errstate(over="ignore"):
            CODE_POINT = mix(np.arange(1 << 16, dtype=_U) + _U(1 << 20))
            CODE_POINT[[9, 10, 11, 12, 13]] = CODE_POINT[32]
    chars = np.frombuffer((b" " + buf.tobytes() + b" ").decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    return CODE_POINT[chars & 0xFFFF], (chars < 128) & SPACE[chars & 0x7F]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """RADIX^i and RADIX^-i for i < n, kept and grown as needed."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, 1 << 14, 0 if have is None else min(2 * len(have), BLOCK + 4096))
        _POWERS["up"], _POWERS["down"] = _powers(RADIX, size), _powers(INVERSE, size)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def blocks(buf: np.ndarray, size: int = BLOCK) -> Iterator[np.ndarray]:
    """Consecutive pieces of ``buf``, cut before white space."""
    start, n = 0, len(buf)
    while n - start > size:
        end = start + size
        back = np.flatnonzero(SPACE[buf[start + 1 : end]])
        if len(back):
            end = start + 1 + int(back[-1])
        else:
            while end < n and not SPACE[buf[end]]:
                end += 1
        yield buf[start:end]
        start = end
    yield buf[start:]


def edges(space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without white space; there must be white space at both ends."""
    edge = np.diff(space.view(np.int8))
    return np.flatnonzero(edge == -1) + 1, np.flatnonzero(edge == 1) + 1


def spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = ~SPACE[buf]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of random 64-bit ``values``: equal values, equal hash."""
    if not len(starts):
        return np.zeros(0, _U)
    with np.errstate(over="ignore"):
        up, down = powers(len(values))
        total = np.zeros(len(values) + 1, _U)
        np.cumsum(values * up, out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U))


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes."""
    return span_hashes(BYTE[buf], starts, ends)


def word_hashes(buf: np.ndarray, beginnings: tuple[int, ...] = ()) -> np.ndarray:
    """Hashes of all words of a text, in order; with ``beginnings``, rows for the first so many bytes follow."""
    out = []
    for block in blocks(buf):
        starts, ends = spans(block)
        rows = [hashes(block, starts, ends)] + [hashes(block, starts, np.minimum(ends, starts + n)) for n in beginnings]
        out.append(np.stack(rows) if beginnings else rows[0])
    return out[0] if len(out) == 1 else np.concatenate(out, axis=-1)


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of ``n`` consecutive word hashes."""
    if len(words) < n:
        return np.zeros(0, _U)
    with np.errstate(over="ignore"):
        out = words[: len(words) - n + 1].copy()
        for k in range(1, n):
            out = out * _U(RADIX) + words[k : len(words) - n + 1 + k]
        return mix(out)
