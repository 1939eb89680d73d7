"""Vectorised text primitives on Arrow batches: words, hashes and shingles from UTF-8 bytes.

A batch's texts are read as one byte array.  Words are runs of bytes outside a
separator set; since the separators are ASCII, byte and character views agree.
A span's 64-bit hash is made of two polynomials in its bytes, taken from running
sums, then mixed; equal spans hash alike wherever they stand.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are handled in slices of about this many bytes (one longer text is one slice).
SLICE_BYTES = 1 << 18
#: Two primes below 2^31, and a base modulo each for either hash.
_PRIMES = (2_147_483_647, 2_147_483_629)
_BASES = ((1_193_548_321, 903_115_477), (1_640_531_527, 712_947_031))
#: Byte values are below 2^12 and powers below 2^31, so that a running sum over this many bytes fits 64 bits.
_REDUCE = 1 << 20
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Byte classes: True where a byte belongs to a word ``[^\x20\x09-\x0D]+``.
WORD_BYTES = ~_WHITE
_power: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(which: int, fold: bool) -> np.ndarray:
    """A value from 1 to 4095 for each byte, all different."""
    v = np.argsort(mix64(np.arange(1 + 4095 * which, 4096 + 4095 * which, dtype=np.uint64))).astype(np.uint64)[:256] + np.uint64(1)
    if fold:
        v[65:91] = v[97:123]
    return v


_VALUES = {(w, fold): _byte_values(w, fold) for w in (0, 1) for fold in (False, True)}


def _series(base: int, prime: int, size: int) -> np.ndarray:
    """base^0, base^1, ... modulo the prime, twice as many at each step."""
    out = np.ones(1, np.uint64)
    while len(out) < size:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), prime)) % np.uint64(prime)])
    return out[:size].astype(np.uint32)


def _powers(which: int, i: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, kept for the largest slice so far."""
    key = which, i
    if key not in _power or len(_power[key][0]) < n:
        size, base, prime = max(n, SLICE_BYTES + 1024), _BASES[which][i], _PRIMES[i]
        _power[key] = _series(base, prime, size), _series(pow(base, -1, prime), prime, size)
    return _power[key]


@dataclass
class Texts:
    """A slice of texts as bytes: text i is ``buf[bounds[i]:bounds[i + 1]]``."""

    first: int
    buf: np.ndarray
    bounds: np.ndarray

    @property
    def count(self) -> int:
        return len(self.bounds) - 1

    def raw(self, i: int) -> bytes:
        return self.buf[self.bounds[i]:self.bounds[i + 1]].tobytes()


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[Texts]:
    """Cut a string column (null: empty) into slices of whole texts."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, off, data = column.buffers()
    bounds = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + max_bytes, side="right")) - 1)
        j = min(j, len(column))
        yield Texts(i, data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i])
        i = j
    pa.default_memory_pool().release_unused()  # a batch's buffers go back before the next one comes


class Spans:
    """Hashes of byte spans from running sums; ``fold`` reads A-Z as a-z, ``which`` (0 or 1) chooses one of two hashes.

    A span's hash joins its polynomials modulo two primes; a power of two as modulus would let long
    regular words collide whatever the base.
    """

    def __init__(self, buf: np.ndarray, fold: bool = False, which: int = 0):
        values = _VALUES[which, fold][buf]
        self._one_piece = len(buf) <= _REDUCE
        self._parts = []
        for i, prime in enumerate(_PRIMES):
            up, down = _powers(which, i, len(buf) + 1)
            total = np.zeros(len(buf) + 1, dtype=np.uint64)
            carry = np.uint64(0)
            for at in range(0, len(buf), _REDUCE):
                end = min(at + _REDUCE, len(buf))
                part = total[at + 1:end + 1]
                np.cumsum(values[at:end] * up[at:end], out=part)
                part += carry
                carry = part[-1] % np.uint64(prime)
            self._parts.append((np.uint64(prime), total, down))

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        for (prime, total, down), shift in zip(self._parts, (np.uint64(0), np.uint64(31))):
            if self._one_piece:  # the running sum never falls
                between = (total[end] - total[start]) % prime
            else:
                between = (total[end] % prime + prime - total[start] % prime) % prime
            out += between * down[start] % prime << shift
        return mix64(out)


@dataclass
class Words:
    """Word spans of a slice; ``first[i]:first[i + 1]`` are the words of text i."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(t: Texts, inside: np.ndarray = WORD_BYTES) -> Words:
    """Maximal runs of ``inside`` bytes, never across two texts."""
    w = inside[t.buf]
    edge = np.zeros(len(t.buf) + 1, dtype=bool)
    edge[t.bounds] = True
    begins, ends = w.copy(), w.copy()
    if len(w):
        begins[1:] &= ~w[:-1] | edge[1:-1]
        ends[:-1] &= ~w[1:] | edge[1:-1]
    start = np.flatnonzero(begins)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(start, t.bounds))


_PLACE = mix64(np.arange(11, 43, dtype=np.uint64)) | np.uint64(1)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k consecutive values (``len - k + 1`` of them, at least none)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = hashes[:n] * _PLACE[0]
    for j in range(1, k):
        out = out + hashes[j:j + n] * _PLACE[j]
    return mix64(out + np.uint64(k))


def shingle_sets(t: Texts, k: int = 5, fold: bool = True) -> Iterator[np.ndarray]:
    """For each text its sorted distinct k-word shingle hashes.

    A text of 1 to k-1 words has its whole sequence as one shingle; one
    without words has none.
    """
    w = words(t)
    h = Spans(t.buf, fold).hash(w.start, w.end)
    g = grams(h, k)
    for i in range(t.count):
        a, b = int(w.first[i]), int(w.first[i + 1])
        if b - a >= k:
            yield np.unique(g[a:b - k + 1])
        elif b > a:
            yield grams(h[a:b], b - a)
        else:
            yield np.zeros(0, dtype=np.uint64)
