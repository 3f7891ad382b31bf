"""Vectorised word hashing over whole texts.

Words are runs of bytes other than space and 0x09-0x0D.  A word's 64-bit hash is a polynomial in
its bytes taken from one prefix sum over the buffer, so no Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SEGMENT = 1 << 18

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser; spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first ``n`` powers of the base (or of its inverse) modulo 2**64."""
    key = "inverse" if inverse else "base"
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = max(n, SEGMENT + 1)
        have = np.full(size, _INVERSE if inverse else _BASE, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 1 << 22:
            _powers[key] = have
    return have[:n]


_held: dict = {}


def held(key, make):
    """What a worker keeps from task to task: one thing, made anew when another is asked for."""
    if key not in _held:
        release()
        _held[key] = make()
    return _held[key]


def release() -> None:
    """Drop what the worker keeps; called where another operator's tasks begin, as workers outlive operators."""
    _held.clear()


def _spaces(buf: np.ndarray) -> np.ndarray:
    return (buf == 32) | ((buf - np.uint8(9)) <= 4)


def _segment(buf: np.ndarray, bounds: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of texts laid end to end; ``bounds`` are text starts."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = ~_spaces(buf)
    cut = np.zeros(n + 1, dtype=bool)
    cut[bounds[bounds <= n]] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_LOWER if lower else _BYTE)[buf] * powers(n), out=sums[1:])
    value = (sums[ends] - sums[starts]) * powers(n + 1, True)[starts]
    return starts, ends, mix64(value + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def hash_words(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` and the start of each text's words (length n + 1)."""
    parts, counts = [], np.zeros(len(texts) + 1, dtype=np.int64)
    group: list[bytes] = []
    first = size = 0

    def flush(upto: int) -> None:
        nonlocal group, first, size
        if group:
            lengths = np.fromiter(map(len, group), np.int64, len(group))
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            starts, _, hashes = _segment(np.frombuffer(b"".join(group), np.uint8), bounds, lower)
            parts.append(hashes)
            np.add.at(counts, first + 1 + np.searchsorted(bounds, starts, "right") - 1, 1)
        group, first, size = [], upto, 0

    for i, text in enumerate(texts):
        if len(text) > SEGMENT:
            flush(i)
            for piece in pieces(text):
                _, _, hashes = _segment(np.frombuffer(piece, np.uint8), np.zeros(1, np.int64), lower)
                parts.append(hashes)
                counts[i + 1] += len(hashes)
            first = i + 1
            continue
        if size + len(text) > SEGMENT:
            flush(i)
        group.append(text)
        size += len(text)
    flush(len(texts))
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.cumsum(counts)


def pieces(text: bytes) -> Iterator[bytes]:
    """A long text in parts of about SEGMENT bytes, cut where a word ends."""
    at = 0
    while at < len(text):
        end = min(len(text), at + SEGMENT)
        while end < len(text) and text[end] != 32 and not 9 <= text[end] <= 13:
            end += 1
        yield text[at:end]
        at = end


def shingles(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Hashes of a text's runs of ``width`` words; the whole sequence if it is shorter."""
    n = len(words)
    if not n:
        return words
    size = min(n, width)
    total = np.zeros(n - size + 1, dtype=np.uint64)
    for j in range(size):
        total = mix64(total + words[j : n - size + 1 + j])
    return mix64(total + np.uint64(size if n < width else 0x51ED270B))


def column_bytes(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes, null as empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]
