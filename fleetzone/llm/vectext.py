"""Vectorised text helpers: word hashes and ragged gathers over byte buffers.

All functions are pure numpy on one bounded chunk; Spark decides which rows
reach which task.
"""

from __future__ import annotations

import numpy as np

#: ASCII white space of the word rule ``[^\x20\x09-\x0D]+``.
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE_VALUE = np.random.RandomState(7).randint(1, 1 << 62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
CHUNK = 1 << 20
_POW: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POW or len(_POW[0]) < n:
        size = max(n, 1 << 16)
        up = np.full(size, _BASE)
        up[0] = 1
        down = np.full(size, _BASE_INV)
        down[0] = 1
        _POW[:] = [np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)]
    return _POW[0], _POW[1]


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One 64-bit hash per byte span ``buf[start:end]`` (equal bytes, equal hash)."""
    up, down = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[buf] * up[:len(buf)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the white-space separated words of ``buf``."""
    edge = np.diff(np.concatenate(([True], _IS_SPACE[buf], [True])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def _hash_chunk(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    buf = _LOWER[buf]
    start, end = word_spans(buf)
    return start, span_hashes(buf, start, end)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the A-Z lower-cased words of each text, one after another.

    Returns ``(hashes, offsets)``; text i has ``hashes[offsets[i]:offsets[i+1]]``.
    Works through the texts in chunks of about ``CHUNK`` bytes, cut at white
    space, so a very long text needs no more than its own word hashes.
    """
    parts, counts, i = [], np.zeros(len(texts) + 1, np.int64), 0
    while i < len(texts):
        if len(texts[i]) > CHUNK:
            text, at, n = np.frombuffer(texts[i], np.uint8), 0, 0
            while at < len(text):
                stop = min(at + CHUNK, len(text))
                while stop < len(text):
                    gap = np.flatnonzero(_IS_SPACE[text[stop:stop + CHUNK]])
                    if len(gap):
                        stop += int(gap[0])
                        break
                    stop = min(stop + CHUNK, len(text))
                parts.append(_hash_chunk(text[at:stop])[1])
                n += len(parts[-1])
                at = stop
            counts[i + 1] = n
            i += 1
            continue
        j, size = i, 0
        while j < len(texts) and len(texts[j]) <= CHUNK and size + len(texts[j]) <= CHUNK:
            size += len(texts[j]) + 1
            j += 1
        j = max(j, i + 1)
        start, h = _hash_chunk(np.frombuffer(b" ".join(texts[i:j]) + b" ", np.uint8))
        ends = np.cumsum([len(t) + 1 for t in texts[i:j]])
        counts[i + 1:j + 1] = np.bincount(np.searchsorted(ends, start, side="right"), minlength=j - i)
        parts.append(h)
        i = j
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.cumsum(counts)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenate ``values[starts[i]:starts[i]+lengths[i]]`` for every i."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    index = np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
    return values[index]
