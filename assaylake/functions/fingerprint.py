"""The public 64-bit FarmHash fingerprint, over Arrow batches.

Its sums and products wrap at 64 bits, which column arithmetic under ANSI settings can only imitate: built of 32-bit halves bound
by higher-order functions it took some nine times as long. numpy's unsigned words wrap by themselves, so the keys of a batch
are computed together, one class of lengths after the other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The three multipliers and the seed of the published algorithm.
K0 = np.uint64(0xC3A5C85C97CB3127)
K1 = np.uint64(0xB492B66FBE98F273)
K2 = np.uint64(0x9AE16A3B2F90404F)
SEED = np.uint64(81)

Words = np.ndarray  # of unsigned 64-bit numbers


def _turned(x: Words, right: int) -> Words:
    return (x >> np.uint64(right)) | (x << np.uint64(64 - right))


def _stirred(x: Words) -> Words:
    return x ^ (x >> np.uint64(47))


def _pair_hash(u: Words, v: Words, factor: Words) -> Words:
    first = _stirred((u ^ v) * factor)
    return _stirred((v ^ first) * factor) * factor


class _Texts:
    """Rows of one class of lengths: numbers are read at places counted from each text's start."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        self.data, self.starts, self.sizes = data, starts, sizes
        self.n = sizes.astype(np.uint64)

    def part(self, rows: np.ndarray) -> _Texts:
        return _Texts(self.data, self.starts[rows], self.sizes[rows])

    def at(self, place: np.ndarray | int, size: int = 8) -> Words:
        """Little-endian numbers of ``size`` bytes."""
        found = np.zeros((len(self.starts), 8), dtype=np.uint8)
        found[:, :size] = self.data[(self.starts + place)[:, None] + np.arange(size)]
        return found.view("<u8")[:, 0]


def _to_3(t: _Texts) -> Words:
    first, middle, last = t.at(0, 1), t.at(t.sizes >> 1, 1), t.at(t.sizes - 1, 1)
    return _stirred((first + (middle << np.uint64(8))) * K2 ^ (t.n + (last << np.uint64(2))) * K0) * K2


def _to_7(t: _Texts) -> Words:
    return _pair_hash(t.n + (t.at(0, 4) << np.uint64(3)), t.at(t.sizes - 4, 4), K2 + t.n * np.uint64(2))


def _to_16(t: _Texts) -> Words:
    factor = K2 + t.n * np.uint64(2)
    a, b = t.at(0) + K2, t.at(t.sizes - 8)
    return _pair_hash(_turned(b, 37) * factor + a, (_turned(a, 25) + b) * factor, factor)


def _ends(t: _Texts, leading: np.uint64) -> tuple[Words, Words, Words, Words]:
    """Two words for the first and last 16 bytes, with the factor and the first of the words read."""
    factor = K2 + t.n * np.uint64(2)
    a, b, c, d = t.at(0) * leading, t.at(8), t.at(t.sizes - 8) * factor, t.at(t.sizes - 16) * K2
    return _turned(a + b, 43) + _turned(c, 30) + d, a + _turned(b + K2, 18) + c, factor, a


def _to_32(t: _Texts) -> Words:
    u, v, factor, _ = _ends(t, K1)
    return _pair_hash(u, v, factor)


def _to_64(t: _Texts) -> Words:
    y, v, factor, a = _ends(t, K2)
    z = _pair_hash(y, v, factor)
    e, f = t.at(16) * factor, t.at(24)
    g, h = (y + t.at(t.sizes - 32)) * factor, (z + t.at(t.sizes - 24)) * factor
    return _pair_hash(_turned(e + f, 43) + _turned(g, 30) + h, e + _turned(f + a, 18) + g, factor)


def _weak(t: _Texts, place: np.ndarray, a: Words, b: Words) -> tuple[Words, Words]:
    """Two words from 32 bytes and two words."""
    a = a + t.at(place)
    inner = t.at(place + 8) + t.at(place + 16)
    last = t.at(place + 24)
    b = _turned(b + a + last, 21)
    return a + inner + last, b + _turned(a + inner, 44) + a


def _round(t: _Texts, place: np.ndarray, state: Words, factor: Words | np.uint64, weight: np.uint64) -> Words:
    """The state, seven words a row, after the 64 bytes at ``place``."""
    v1, v2, w1, w2, x, y, z = state
    x = _turned(x + y + v1 + t.at(place + 8), 37) * factor ^ w2 * weight
    y = _turned(y + v2 + t.at(place + 48), 42) * factor + v1 * weight + t.at(place + 40)
    z = _turned(z + w1, 33) * factor
    first = _weak(t, place, v2 * factor, x + w1)
    second = _weak(t, place + 32, z + w2, y + t.at(place + 16))
    return np.stack([*first, *second, z, y, x])  # x and z change places


def _beyond_64(t: _Texts) -> Words:
    """Rounds of 64 bytes, and a closing one over the last 64. Rows that are through with their rounds wait."""
    y = SEED * K1 + np.uint64(113)
    state = np.zeros((7, len(t.n)), dtype=np.uint64)
    state[4], state[5], state[6] = SEED * K2 + t.at(0), y, _stirred(y * K2 + np.uint64(113)) * K2
    rounds = (t.sizes - 1) // 64
    for i in range(int(rounds.max())):
        going = np.flatnonzero(rounds > i)
        state[:, going] = _round(t.part(going), np.full(len(going), 64 * i), state[:, going], K1, np.uint64(1))
    factor = K1 + ((state[6] & np.uint64(0xFF)) << np.uint64(1))
    state[2] += (t.n - np.uint64(1)) & np.uint64(63)
    state[0] += state[2]
    state[2] += state[0]
    v1, v2, w1, w2, x, y, z = _round(t, t.sizes - 64, state, factor, np.uint64(9))
    return _pair_hash(_pair_hash(v1, w1, factor) + _stirred(y) * K0 + z, _pair_hash(v2, w2, factor) + x, factor)


# Longest text of each class.
CLASSES = [(3, _to_3), (7, _to_7), (16, _to_16), (32, _to_32), (64, _to_64), (np.inf, _beyond_64)]


def fingerprints(texts: pa.Array) -> pa.Array:
    """Signed 64-bit fingerprints of an Arrow array of strings; null stays null."""
    held = texts.cast(pa.large_binary())
    _, offsets, data = held.buffers()
    places = np.frombuffer(offsets, dtype=np.int64)[held.offset : held.offset + len(held) + 1]
    content = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    starts, sizes = places[:-1], np.diff(places)
    found = np.full(len(held), K2)  # of the empty text
    least = 1
    with np.errstate(over="ignore"):
        for most, hashed in CLASSES:
            rows = np.flatnonzero((sizes >= least) & (sizes <= most))
            if len(rows):
                found[rows] = hashed(_Texts(content, starts[rows], sizes[rows]))
            least = most + 1
    return pa.array(found.view(np.int64), mask=held.is_null().to_numpy(zero_copy_only=False))


_fingerprints = F.arrow_udf(fingerprints, T.LongType())


def fingerprint64(value: Column) -> Column:
    """Signed 64-bit fingerprint of the UTF-8 bytes of a text of any length. NULL stays NULL."""
    return _fingerprints(value.cast("string"))
