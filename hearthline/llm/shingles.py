"""Hashed sets of word shingles, computed for many texts at once."""

from __future__ import annotations

import numpy as np

SHINGLE = 5
_U = np.uint64
_MASK = (1 << 64) - 1
#: A-Z lower-cased; blanks are a space and the five characters from tab to carriage return.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IS_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Places of a word whose numbers are kept in a table.
_PLACES = 256
_SPREAD = [_U((0xD6E8FEB86659FD93 * (2 * k + 1) + 0x632BE59BD9B4E019 * k * k) & _MASK | 1) for k in range(SHINGLE)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _numbers(place: np.ndarray, byte: np.ndarray, key: int) -> np.ndarray:
    """A scrambled number for a byte at a place of a word; ``key`` makes independent ones."""
    return mixed(mixed(((place.astype(np.uint64) << _U(8)) | byte) * _U(0x9E3779B97F4A7C15) + _U(key + 1)) + _U(0xB5297A4D3C2B1F0F))


_tables: dict[int, np.ndarray] = {}


def _table(key: int) -> np.ndarray:
    if key not in _tables:
        places, bytes_ = np.divmod(np.arange(_PLACES << 8), 256)
        _tables[key] = _numbers(places, bytes_.astype(np.uint64), key)
    return _tables[key]


def word_hashes(text: str, key: int = 0) -> np.ndarray:
    """A 64-bit hash of every word, in order: the sum of a random number for each byte at its place, scrambled."""
    raw = np.frombuffer(text.encode().translate(_LOWER), np.uint8)
    inside = ~_IS_BLANK[raw]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    starts, ends = edges[::2], edges[1::2]
    size = ends - starts
    total = np.cumsum(size)
    place = np.arange(total[-1] if len(total) else 0) - np.repeat(total - size, size)
    byte = raw[inside].astype(np.int64)
    sums = np.zeros(len(byte) + 1, np.uint64)
    if len(place) and size.max() > _PLACES:
        np.cumsum(_numbers(place, byte.astype(np.uint64), key), out=sums[1:])
    else:
        np.cumsum(_table(key)[(place << 8) | byte], out=sums[1:])
    return mixed(sums[total] - sums[total - size] + size.astype(np.uint64))


def shingle_set(text: str | None, seed: int = 0, key: int = 0) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles; under five words the whole sequence is one.

    ``key`` chooses independent hashes of the words.
    """
    if not text:
        return np.zeros(0, np.uint64)
    w = word_hashes(text, key)
    n = len(w)
    if n == 0:
        return np.zeros(0, np.uint64)
    if n < SHINGLE:
        total = _U(n)
        for k in range(n):
            total = total + w[k : k + 1] * _SPREAD[k]
        return mixed(mixed(total) + _U(n) + _U(seed))
    total = np.zeros(n - SHINGLE + 1, np.uint64)
    for k in range(SHINGLE):
        total += w[k : n - SHINGLE + 1 + k] * _SPREAD[k]
    h = np.sort(mixed(total + _U(seed)))
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def digest(h: np.ndarray) -> int:
    """A 64-bit number that tells the set; signed, as Spark's longs."""
    total = int(mixed(h).sum(dtype=np.uint64)) ^ len(h)
    return int(np.uint64((total * 0xFF51AFD7ED558CCD) & _MASK).astype(np.int64))
