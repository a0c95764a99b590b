"""64-bit hashes of the words of many texts at once, words split at ASCII white space.

A word's hash is a polynomial of random numbers that stand for its bytes. Sums up to every
byte give the polynomials of all words by one subtraction each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1_000_000

_RANDOM = np.random.default_rng(64).integers(0, 2**64, 256, dtype=np.uint64)
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BASE = 0x9E3779B97F4A7C15
_FOLD = np.uint64(0xBF58476D1CE4E5B9)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * _FOLD
    return x ^ (x >> np.uint64(29))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < count:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out


class _Powers:
    """Powers of the base and of its inverse, as many as the longest stretch so far needs."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def grow(cls, count: int) -> None:
        if len(cls.up) < count:
            cls.up = _powers(_BASE, count)
            cls.down = _powers(pow(_BASE, -1, 1 << 64), count)


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[pa.Array]:
    """Slices of about ``most`` bytes, never less than one whole text. Memory that Arrow keeps for later
    is given back after each, as several workers share an executor's."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
        yield texts.slice(start, end - start)
        pa.default_memory_pool().release_unused()
        start = end


def _stretches(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of the bytes of about a chunk, cut at white space."""
    start = 0
    while start < len(data):
        end = min(len(data), start + CHUNK_BYTES)
        while end < len(data):
            spaces = np.flatnonzero(_SPACE[data[end : end + CHUNK_BYTES]])
            if len(spaces):
                end += int(spaces[0])
                break
            end = min(len(data), end + CHUNK_BYTES)
        yield start, end
        start = end


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and the places among them where each text's
    words start, with the end of the last. Null texts have no words; ``lower`` lowers A to Z."""
    texts = pc.fill_null(texts, "")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data else np.empty(0, np.uint8)
    bounds = bounds.astype(np.int64) - bounds[0]
    first = np.zeros(len(raw) + 1, bool)  # where a text starts
    first[bounds] = True
    hashes, starts = [], []
    for begin, end in _stretches(raw):
        part = raw[begin:end]
        if lower:
            part = _LOWER[part]
        space = _SPACE[part]
        new = first[begin:end]
        begins = ~space
        begins[1:] &= space[:-1] | new[1:]
        ends = ~space
        ends[:-1] &= space[1:] | new[1:]
        at, to = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        _Powers.grow(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_RANDOM[part] * _Powers.up[: len(part)], out=sums[1:])
        hashes.append(mix((sums[to] - sums[at]) * _Powers.down[at] + (to - at).astype(np.uint64)))
        starts.append(at + begin)
    found = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    places = np.concatenate(starts) if starts else np.empty(0, np.int64)
    return found, np.searchsorted(places, bounds)
