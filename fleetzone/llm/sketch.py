"""SetSketch registers: build, band and estimate (numpy).

Every element of a set starts a Poisson process over the registers; a
register keeps its smallest arrival, stored on an exponential scale and
truncated to 16 bits.  Register-wise maxima of two sketches are the sketch of
the union, and equal registers become likelier with the Jaccard similarity.
"""

from __future__ import annotations

import numpy as np

from fleetzone.llm.vectext import mix

REGISTERS = 128
BASE = 1.001
RATE = 20.0
TOP = 65535
BAND_ROWS = 4
BANDS = REGISTERS // BAND_ROWS
_STEP = np.uint64(0x9E3779B97F4A7C15)


def distinct_shingles(words: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``size``
    make one shingle of the whole sequence, no words make none."""
    out = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        w = words[a:b]
        if len(w) == 0:
            out.append(np.zeros(0, np.uint64))
            continue
        k = min(size, len(w))
        s = np.full(len(w) - k + 1, np.uint64(k))
        for i in range(k):
            s = mix(s * _STEP + w[i:len(w) - k + 1 + i])
        out.append(np.unique(s))
    return out


def build(sets: list[np.ndarray]) -> np.ndarray:
    """Registers (uint16, one row per set) of all sets at once; an empty set has zeros."""
    sizes = np.array([len(s) for s in sets], np.int64)
    regs = np.full(len(sets) * REGISTERS, np.inf)
    limit = np.where(sizes > 0, np.inf, 0.0)
    doc = np.repeat(np.arange(len(sets)), sizes)
    state = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    at = np.zeros(len(state))
    level = 0
    while len(state):
        state = state + _STEP
        r = mix(state)
        at -= np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / REGISTERS
        alive = at < limit[doc]
        doc, state, at, r = doc[alive], state[alive], at[alive], r[alive]
        np.minimum.at(regs, doc * REGISTERS + (r & np.uint64(REGISTERS - 1)).astype(np.int64), at)
        level += 1
        if level < 8 or level % 8 == 0:
            open_docs = np.unique(doc)
            limit[open_docs] = regs.reshape(-1, REGISTERS)[open_docs].max(axis=1)
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(regs / RATE) / np.log(BASE))
    return np.clip(np.nan_to_num(k, neginf=0), 0, TOP).astype(np.uint16).reshape(-1, REGISTERS)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of ``BAND_ROWS`` registers (band number mixed in)."""
    rows = regs.reshape(len(regs), BANDS, BAND_ROWS).astype(np.uint64)
    key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(regs), 1))
    for i in range(BAND_ROWS):
        key = mix(key * _STEP + rows[:, :, i])
    return key.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of register rows ``a`` and ``b``.

    Uses how many registers of a are above, below and equal to b's, with the
    known set sizes.  The log-likelihood is concave in J, so a bisection on
    its slope finds the maximum.
    """
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - above - below
    u = na / (na + nb)
    v = 1 - u
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)

    scale = (BASE - 1) / BASE
    logb = np.log(BASE)

    def slope(j):
        x, y = np.maximum(u - v * j, 1e-12), np.maximum(v - u * j, 1e-12)
        p, q = -np.log1p(-x * scale) / logb, -np.log1p(-y * scale) / logb
        dp, dq = -v * scale / (1 - x * scale) / logb, -u * scale / (1 - y * scale) / logb
        return above * dp / p + below * dq / q - same * (dp + dq) / np.maximum(1 - p - q, 1e-12)

    for _ in range(20):
        mid = (low + high) / 2
        up = slope(mid) > 0
        low, high = np.where(up, mid, low), np.where(up, high, mid)
    return (low + high) / 2
